"""Writers: compact packages, manifests, run logs, gated publishing."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.merging import keep_last, replace_rows
from .pointers import delete_folder, read_pointer, swap_pointer

#: The columns of a compact package.
COMPACT_COLUMNS = ("id", "name", "set_name", "card_number", "hp", "set_id", "set_code", "image_url", "updated_at", "rarity", "types", "tflite_emb_q")


#: Layout: each of both keys is cut into at most this many ranges of about equal size, from a sample of so many rows.
RANGES, SAMPLE = 256, 50_000


def _edges(df: DataFrame, key: list[str], share: float) -> list[tuple]:
    """Keys that part a sample of rows into RANGES equal ranges; they are only as good as the sample, and nothing but the layout depends on them."""
    rows = sorted(tuple(x or "" for x in r) for r in df.select(*key).sample(share, seed=7).limit(2 * SAMPLE).collect())
    return sorted({rows[len(rows) * k // RANGES] for k in range(1, RANGES)}) if rows else []


def _rank(key: list[str], edges: list[tuple]) -> Column:
    """How many of ``edges`` are at most a row's key: among every sixteenth first, then among those after it."""
    shown = F.struct(*(F.coalesce(c, F.lit("")).alias(c) for c in key))
    listed = lambda some: F.array(*(F.struct(*(F.lit(v).alias(c) for c, v in zip(key, e))) for e in some))
    upto = lambda some: F.size(F.filter(some, lambda e: e <= shown))
    if len(edges) < 16:
        return upto(listed(edges)) if edges else F.lit(0)
    coarse = upto(listed(edges[15::16])) * 16
    return coarse + upto(F.slice(listed(edges), coarse + 1, F.lit(15)))


def _interleaved(x: Column, y: Column, bits: int = 8) -> Column:
    """The place on a Z-order curve: the bits of both numbers in turn, x first."""
    place = F.lit(0)
    for k in range(bits):
        for shift, n in ((2 * k + 1, x), (2 * k, y)):
            place = place.bitwiseOR(F.call_function("shiftleft", F.call_function("shiftright", n, F.lit(k)).bitwiseAND(F.lit(1)), F.lit(shift)))
    return place


def write_compact(df: DataFrame, path: str, partitions: int | None = None) -> None:
    """One row per id in the fixed columns, laid out so that lookups by name and by (set, number) both skip files and row groups.

    Both keys are cut into ranges of about equal size, and rows are placed
    along a Z-order curve over the two: each file then holds few names and few
    sets, so of n files either lookup meets about the square root of n.  Row
    groups keep the least and greatest value of each column, and Bloom filters
    of ids and names.  Of rows with one id the last updated stays, of equal
    ones the greatest by their columns.
    """
    rows = keep_last(df.select(*COMPACT_COLUMNS), ["id"], F.struct("updated_at", *(c for c in COMPACT_COLUMNS if c not in ("id", "updated_at"))))
    share = min(1.0, SAMPLE / max(1, df.count()))
    by_name, by_number = ["name"], ["set_id", "card_number"]
    place = _interleaved(_rank(by_name, _edges(df, by_name, share)), _rank(by_number, _edges(df, by_number, share)))
    placed = rows.withColumn("_place", place)
    laid = placed.repartitionByRange(partitions, "_place", "name") if partitions else placed.repartitionByRange("_place", "name")
    written = laid.sortWithinPartitions("_place", "name", "set_id", "card_number").drop("_place").write.mode("overwrite")
    written.option("parquet.bloom.filter.enabled#id", "true").option("parquet.bloom.filter.enabled#name", "true").parquet(path)


def lookup(package: DataFrame, names: Sequence[str] = (), numbers: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """Rows of a package with one of the names, or one of the (set_id, card_number); the conditions reach the scan."""
    asked = [F.col("name").isin(*names)] if names else []
    for set_id in sorted({s for s, _ in numbers}):
        asked.append((F.col("set_id") == set_id) & F.col("card_number").isin(*(n for s, n in numbers if s == set_id)))
    condition = F.lit(False)
    for a in asked:
        condition = condition | a
    return package.where(condition)


def write_manifest(spark: SparkSession, path: str, values: Mapping[str, str], version: int) -> DataFrame:
    """Upsert key/value pairs; every version is written beside the last, so a reader never meets a half-written one."""
    new = spark.createDataFrame(sorted(values.items()), "key string, value string")
    merged = replace_rows(spark.read.parquet(f"{path}/v{version - 1}"), new, ["key"]) if version > 1 else new
    merged.coalesce(1).write.mode("overwrite").parquet(f"{path}/v{version}")
    return spark.read.parquet(f"{path}/v{version}")


def append_run_event(events: DataFrame, path: str) -> None:
    """Append events (run_id, seq, event, at, status, counters) to a run log; its state is the latest event of each run."""
    events.write.mode("append").parquet(path)


def stage(df: DataFrame, path: str, manifest: Mapping[str, str] | None = None) -> str:
    """Write a new version beside the published one, with its manifest; nobody reads it until it is published.  Its name."""
    version = f"v-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{version}/rows")
    if manifest is not None:
        df.sparkSession.createDataFrame(sorted(manifest.items()), "key string, value string").coalesce(1).write.parquet(f"{path}/{version}/manifest")
    return version


def package_faults(df: DataFrame, vector: str = "tflite_emb_q", vector_bytes: int | None = None) -> list[str]:
    """What keeps a package from being published, from ``validate_package``: nothing for a sound one."""
    row = validate_package(df, vector).first()
    faults = {
        "no rows": row["n_rows"] == 0,
        "repeated ids": row["repeated_ids"] > 0,
        "missing names": row["null_names"] > 0,
        "vectors of another length": vector_bytes is not None and row["n_vectors"] > 0 and row["avg_bytes"] != vector_bytes,
    }
    return [name for name, there in faults.items() if there]


def release(spark: SparkSession, path: str, version: str) -> None:
    """Make a staged version the published one; the version before stays, older ones are deleted."""
    old = read_pointer(spark, path)
    swap_pointer(spark, path, {"current": version, "previous": old and old["current"]})
    if old and old["previous"]:
        delete_folder(spark, f"{path}/{old['previous']}")


def publish(df: DataFrame, path: str, faults: Callable[[DataFrame], list[str]] = package_faults, manifest: Mapping[str, str] | None = None) -> str:
    """Stage, validate what was written, then swap.  With a fault the published version stays, the staged one goes, and ValueError says why."""
    spark, version = df.sparkSession, stage(df, path, manifest)
    found = faults(spark.read.parquet(f"{path}/{version}/rows"))
    if found:
        delete_folder(spark, f"{path}/{version}")
        raise ValueError(f"not published: {', '.join(found)}")
    release(spark, path, version)
    return version


def roll_back(spark: SparkSession, path: str) -> None:
    """Publish the version before again."""
    now = read_pointer(spark, path)
    if not now or not now["previous"]:
        raise ValueError(f"no version before the present one at {path}")
    swap_pointer(spark, path, {"current": now["previous"], "previous": now["current"]})


def published(spark: SparkSession, path: str, part: str = "rows") -> DataFrame:
    """The published version's rows, or its ``manifest``; the version is chosen now and stays until the version after the next is published."""
    now = read_pointer(spark, path)
    if now is None:
        raise FileNotFoundError(f"nothing is published at {path}")
    return spark.read.parquet(f"{path}/{now['current']}/{part}")


def publish_if_changed(summary: DataFrame, df: DataFrame, path: str, faults: Callable[[DataFrame], list[str]] = package_faults, manifest: Mapping[str, str] | None = None) -> bool:
    """``publish`` only if the run created or updated anything (one row with ``changed``)."""
    row = summary.select("changed").first()
    if row is None or not row["changed"]:
        return False
    publish(df, path, faults, manifest)
    return True


def validate_package(df: DataFrame, vector: str = "tflite_emb_q") -> DataFrame:
    """Rows, vectors, their mean length in bytes, repeated ids and missing names: one row."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(vector).alias("n_vectors"),
        F.avg(F.octet_length(vector)).alias("avg_bytes"),
        (F.count("id") - F.count_distinct("id")).alias("repeated_ids"),
        F.count_if(F.col("name").isNull()).alias("null_names"),
    )
