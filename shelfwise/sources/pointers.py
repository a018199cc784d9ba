"""A small file that names the folders of which a table consists at present.

Writers make new folders and then swap the file, so readers see all of the old
state or all of the new one.
"""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.sql import SparkSession


def _context(spark: SparkSession, path: str) -> tuple[Any, Any, Any]:
    """Hadoop's view of the file system that holds ``path``; whatever Spark can write to, this can."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, at.getFileSystem(conf), jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.getFileSystem(conf).getUri(), conf)


def read_pointer(spark: SparkSession, path: str) -> dict[str, Any] | None:
    """What the pointer of the table at ``path`` says, or None before the first swap."""
    jvm, fs, _ = _context(spark, path)
    at = jvm.org.apache.hadoop.fs.Path(path, "CURRENT")
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        return json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def swap_pointer(spark: SparkSession, path: str, value: dict[str, Any]) -> None:
    """Replace the pointer by one rename; a reader, or a writer that is lost before it, meets the old one."""
    jvm, fs, context = _context(spark, path)
    name = jvm.org.apache.hadoop.fs.Path
    new = name(path, f".CURRENT.{uuid.uuid4().hex}")
    stream = fs.create(new, False)
    stream.write(bytearray(json.dumps(value, sort_keys=True).encode()))
    stream.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    context.rename(new, name(path, "CURRENT"), how)


def delete_folder(spark: SparkSession, path: str) -> None:
    jvm, fs, _ = _context(spark, path)
    fs.delete(jvm.org.apache.hadoop.fs.Path(path), True)


def exists(spark: SparkSession, path: str) -> bool:
    jvm, fs, _ = _context(spark, path)
    return bool(fs.exists(jvm.org.apache.hadoop.fs.Path(path)))
