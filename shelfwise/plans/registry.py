"""The registered catalog queries, each with the SQL that gives the same rows."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .views import with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def registered(sql: str | None, *views: str):
    """Register a query under its function's name; ``sql`` may read the derived ``views``."""

    def add(query):
        QUERIES[query.__name__] = query
        if sql is not None:
            ORACLES[query.__name__] = with_views(sql, *views) if views else sql
        return query

    return add


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder's name in the folder that the session's executors share; a local session without one gets a temporary folder."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = tempfile.gettempdir()
    return f"{shared}/{name}-{uuid.uuid4().hex}"


def read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")
