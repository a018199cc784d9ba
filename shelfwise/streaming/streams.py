"""Incremental runs as streams."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from ..operators.merging import insert_ignore, keep_last, merge_upsert
from ..sources.pointers import delete_folder, read_pointer, swap_pointer


#: What the folders of a merged table are named after.
PLACES = ("merge_source", "merge_batch", "merge_bucket")


def ingest_landed(spark: SparkSession, landing: str, schema: str | StructType, target: str, checkpoint: str, file_format: str = "json") -> None:
    """Append every landed row to a Parquet table once, however often the run is repeated."""
    rows = spark.readStream.schema(schema).format(file_format).load(landing).withColumn("file", F.col("_metadata.file_path"))
    rows.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def _merged_batches(rows: DataFrame, path: str, checkpoint: str, keys: Sequence[str], buckets: int, merge: Callable[[DataFrame | None, DataFrame], DataFrame]) -> None:
    """Merge each micro-batch into the table at ``path``, which lies in ``buckets`` buckets by a hash of the keys.

    Only the buckets that a batch's keys fall into are read, merged and written
    anew, to the batch's own folder; then the pointer takes them up, all at
    once.  A batch that is repeated after the pointer named it does nothing,
    and one that is repeated before writes the same folder again.  Several
    streams, told apart by their checkpoints, may feed a table, one after the other.
    """
    source = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def take(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        state = read_pointer(spark, path) or {"batches": {}, "buckets": buckets, "current": {}, "previous": {}}
        if state["buckets"] != buckets:
            raise ValueError(f"the table at {path} has {state['buckets']} buckets")
        if number <= state["batches"].get(source, -1):
            return
        bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
        touched = sorted(r[0] for r in batch.select(bucket.alias("b")).distinct().collect())  # at most one number a bucket
        if not touched:
            return
        have = [state["current"][str(b)] for b in touched if str(b) in state["current"]]
        base = spark.read.option("basePath", path).parquet(*(f"{path}/{f}" for f in have)).drop(*PLACES) if have else None
        folder = f"merge_source={source}/merge_batch={number}"
        placed = merge(base, batch).withColumn("merge_bucket", bucket).repartition(min(len(touched), int(spark.conf.get("spark.sql.shuffle.partitions"))), "merge_bucket")
        placed.write.mode("overwrite").partitionBy("merge_bucket").parquet(f"{path}/{folder}")
        now = state["current"] | {str(b): f"{folder}/merge_bucket={b}" for b in touched}
        swap_pointer(spark, path, {"batches": state["batches"] | {source: number}, "buckets": buckets, "current": now, "previous": state["current"]})
        for old in set(state["previous"].values()) - set(now.values()) - set(state["current"].values()):
            delete_folder(spark, f"{path}/{old}")  # neither this state nor the one before reads it

    rows.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def stream_upsert(rows: DataFrame, path: str, checkpoint: str, keys: Sequence[str], seq: str, buckets: int = 64) -> None:
    """Merge the last row of a key of every micro-batch into the table: its columns replace the row's, other columns stay.  ``merged`` reads the table."""

    def merge(base: DataFrame | None, batch: DataFrame) -> DataFrame:
        last = keep_last(batch, keys, seq)
        return last if base is None else merge_upsert(base, last, keys)

    _merged_batches(rows, path, checkpoint, keys, buckets, merge)


def stream_insert_ignore(rows: DataFrame, path: str, checkpoint: str, keys: Sequence[str], seq: str, buckets: int = 64) -> None:
    """Add the first row of each key that the table lacks, from every micro-batch.  ``merged`` reads the table."""

    def merge(base: DataFrame | None, batch: DataFrame) -> DataFrame:
        return insert_ignore(batch.limit(0) if base is None else base, batch, keys, seq)

    _merged_batches(rows, path, checkpoint, keys, buckets, merge)


def merged(spark: SparkSession, path: str) -> DataFrame:
    """The table that the merging streams make: one row a key, as of the last batch that was taken up whole."""
    state = read_pointer(spark, path)
    if state is None:
        raise FileNotFoundError(f"no batch has been merged at {path}")
    folders = sorted(set(state["current"].values()))
    return spark.read.option("basePath", path).option("mergeSchema", "true").parquet(*(f"{path}/{f}" for f in folders)).drop(*PLACES)


def first_within_watermark(rows: DataFrame, keys: Sequence[str], at: str = "ts", delay: str = "1 day") -> DataFrame:
    """Insert-ignore with bounded state: repeats within the delay are dropped."""
    return rows.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, delay).dropDuplicatesWithinWatermark(list(keys))


def stream_credits(calls: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Credits of each key and UTC day; a day is given out when the watermark passes it, later calls are dropped."""
    timed = calls.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    by_day = timed.groupBy("key_id", F.window("ts", "1 day").alias("w"))
    windowed = by_day.agg(F.sum(F.col("credits").cast("long")).alias("credits"), F.count(F.lit(1)).alias("calls"))
    return windowed.select("key_id", F.to_date("w.start").alias("day"), "credits", "calls")


def use_rocksdb(spark: SparkSession) -> None:
    """State with a time to live needs Spark's RocksDB store."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class Streaks(StatefulProcessor):
    """A key's streak of network failures and when it last called; both are dropped, and the key forgotten, once it is silent for ``ttl_ms``.

    Time is that of the calls: the watermark, which waits ``delay`` for late ones.
    A row is given out for each key and micro-batch, with ``abort`` only in the
    batch in which the streak reaches the threshold.
    """

    def __init__(self, threshold: int, ttl_ms: int) -> None:
        self.threshold, self.ttl_ms = threshold, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("streak", "streak int, last_ms long")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        streak, last = self.state.get() if self.state.exists() else (0, 0)
        before, calls = streak, pd.concat(list(rows)).sort_values(["ts", "event_id"])
        crossed = False
        for outcome in calls["outcome"]:
            streak = 0 if outcome == "ok" else streak + (outcome == "network")
            before, crossed = streak, crossed or (before < self.threshold <= streak)
        last = max(last, int(calls["ts"].max().value // 1_000_000))
        self.state.update((int(streak), last))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(last + self.ttl_ms)
        yield pd.DataFrame({"key_id": [key[0]], "streak": [int(streak)], "abort": [bool(crossed)]})

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        self.state.clear()
        yield from ()

    def close(self) -> None:
        pass


def stream_streaks(calls: DataFrame, threshold: int = 15, ttl: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """Each key's failure streak after every micro-batch that has calls of it, from state that is forgotten when a key is silent for ``ttl``.

    Calls of a batch are taken by (ts, event_id); those older than the watermark
    are dropped.  ``abort`` is true once, where a streak crosses the threshold.
    """
    use_rocksdb(calls.sparkSession)
    ttl_ms = int(pd.Timedelta(ttl).total_seconds() * 1000)
    timed = calls.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    return timed.groupBy("key_id").transformWithStateInPandas(Streaks(threshold, ttl_ms), "key_id long, streak int, abort boolean", "update", "eventTime")
