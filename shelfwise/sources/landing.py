"""Readers of landed catalog files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

COUNTERS = ("created", "updated", "skipped", "failed")


def page_items(body: Column, item_schema: str) -> Column:
    """The items of a page whose ``data`` is an array, one object, or missing (no items)."""
    data = F.get_json_object(body, "$.data")
    first = F.substring(F.ltrim(data), 1, 1)
    return F.when(first == "[", F.from_json(data, f"array<{item_schema}>")).when(first == "{", F.array(F.from_json(data, item_schema)))


def explode_pages(pages: DataFrame, item_schema: str, body: str = "body") -> DataFrame:
    """One row per item, with its position in the page (from 1); null entries of an array are left out."""
    keep = [c for c in pages.columns if c != body]
    rows = pages.select(*keep, F.posexplode(page_items(F.col(body), item_schema)).alias("position", "item"))
    return rows.where("item IS NOT NULL").withColumn("position", F.col("position") + 1)


def read_api_pages(spark: SparkSession, path: str, item_schema: str) -> DataFrame:
    """Landed response files, one page a file."""
    pages = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("body"))
    return explode_pages(pages, item_schema)


def read_table(spark: SparkSession, source: str, columns: list[str], where: str | None = None, file_format: str = "parquet", **options: str) -> DataFrame:
    """Chosen columns and rows of a table; both reach the scan."""
    df = spark.read.format(file_format).options(**options).load(source)
    return (df.where(where) if where else df).select(*columns)


def name_list(lists: DataFrame, json: str = "value") -> DataFrame:
    """(position from 1, name) of a JSON array of names, beside the list's other columns."""
    keep = [c for c in lists.columns if c != json]
    return lists.select(*keep, F.posexplode(F.from_json(json, "array<string>")).alias("p", "name")).select(*keep, (F.col("p") + 1).alias("position"), "name")


def read_name_list(spark: SparkSession, path: str) -> DataFrame:
    return name_list(spark.read.text(path, wholetext=True))


#: An asset's id is its file's name without ending, or else the value of the last folder ``key=value``.
ASSET_ID = r"([^/=]+?)(?:\.[^./]*|/part-[^/]*)$"


def list_assets(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(item_id, path, length) of binary files; no content is read.  Spark's reader leaves empty files out."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    return files.select(F.regexp_extract("path", ASSET_ID, 1).alias("item_id"), "path", "length")


def read_assets(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, content, item_id) of all binary files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content", F.regexp_extract("path", ASSET_ID, 1).alias("item_id"))


def pending_assets(spark: SparkSession, pending: DataFrame, path: str, glob: str = "*", limit: int | None = None) -> DataFrame:
    """(item_id, path, length) of the files of pending items, by ids alone; the first ``limit`` of them by item."""
    found = list_assets(spark, path, glob).join(pending.select(F.col("item_id").cast("string").alias("item_id")).distinct(), "item_id", "left_semi")
    return found if limit is None else found.orderBy("item_id", "path").limit(limit)


def asset_contents(spark: SparkSession, assets: DataFrame, most: int = 100_000) -> DataFrame:
    """(item_id, path, content) of listed files, and of no others: their paths are the scan's input.

    The driver holds the paths, so one call takes at most ``most`` of them;
    longer lists go in several calls, as in ``all_contents``.
    """
    paths = [r["path"] for r in assets.select("path").limit(most + 1).collect()]
    if len(paths) > most:
        raise ValueError(f"more than {most} files at once")
    if not paths:
        return spark.createDataFrame([], "item_id string, path string, content binary")
    files = spark.read.format("binaryFile").load(paths)
    return files.select(F.regexp_extract("path", ASSET_ID, 1).alias("item_id"), "path", "content")


def all_contents(spark: SparkSession, assets: DataFrame, wave: int = 50_000) -> DataFrame:
    """As ``asset_contents``, for lists of any length: one scan for about ``wave`` files, all of them united.

    The list is worked out once.  The driver knows every file, as for any scan
    of so many, but never holds the paths of more than some ``wave`` as rows.
    """
    listed = assets.persist()
    try:
        waves = max(1, -(-listed.count() // wave))
        scans = [asset_contents(spark, listed.where(F.pmod(F.xxhash64("path"), F.lit(waves)) == k), 2 * wave + 1000) for k in range(waves)]
    finally:
        listed.unpersist()
    return reduce(DataFrame.unionByName, scans)


def parse_progress_log(lines: DataFrame, column: str = "value") -> DataFrame:
    """Counters of lines such as ``page=3 cards=250 created=750 updated=0 skipped=0 failed=2``; other lines are left out."""
    kept = lines.where(F.col(column).rlike(r"\bcreated=\d+"))
    return kept.select(*(F.nullif(F.regexp_extract(column, rf"\b{name}=(\d+)", 1), F.lit("")).try_cast("long").alias(name) for name in ("page", *COUNTERS)))


def page_totals(pages: DataFrame, body: str = "body") -> DataFrame:
    """``pages`` with ``items`` (how many its ``data`` holds) and ``total_count`` (what the server says there is; 0 if it doesn't) in place of the text."""
    data = F.get_json_object(body, "$.data")
    first = F.substring(F.ltrim(data), 1, 1)
    items = F.when(first == "[", F.size(F.array_compact(F.from_json(data, "array<string>")))).when(first == "{", 1).otherwise(0)
    total = F.coalesce(F.get_json_object(body, "$.totalCount").try_cast("long"), F.lit(0).cast("long"))
    return pages.withColumns({"items": items.cast("long"), "total_count": total}).drop(body)


def missing_pages(totals: DataFrame, page_size: int, group: str = "set_id", page: str = "page") -> DataFrame:
    """(group, first_missing, last_missing): the gaps between the pages that landed and those that the server's total asks for.

    Pages count from 1.  A page without items hasn't landed.  Of differing
    totals the largest counts.  A group's pages form islands; a gap stands
    before each island and after the last, so nothing is expanded, and a page
    landed twice changes nothing.
    """
    ends = totals.groupBy(group).agg(F.ceil(F.max("total_count") / page_size).cast("long").alias("_last"))
    there = totals.where("items > 0").select(group, F.col(page).cast("long").alias("_page")).distinct()
    marks = there.unionByName(ends.select(group, (F.col("_last") + 1).alias("_page")))
    before = F.coalesce(F.lag("_page").over(Window.partitionBy(group).orderBy("_page")), F.lit(0))
    gaps = marks.withColumn("_before", before).join(ends, group)
    last = F.least(F.col("_page") - 1, F.col("_last"))
    return gaps.select(group, (F.col("_before") + 1).alias("first_missing"), last.alias("last_missing")).where("first_missing <= last_missing")


def completeness(totals: DataFrame, page_size: int, group: str = "set_id", page: str = "page") -> DataFrame:
    """A row per group: pages expected and landed, items landed (a page landed twice counts its largest), the server's total, and whether all is there.

    A page that is neither the last nor full is short: where there is one, the
    group isn't complete even if all its pages landed.
    """
    by_page = totals.groupBy(group, F.col(page).cast("long").alias("_page")).agg(F.max("items").alias("items"), F.max("total_count").alias("total_count"))
    sums = by_page.groupBy(group).agg(F.max("total_count").alias("server_total"), F.sum("items").alias("items"), F.count_if(F.col("items") > 0).alias("landed_pages"))
    return sums.select(group, F.ceil(F.col("server_total") / page_size).cast("long").alias("expected_pages"), "landed_pages", "items", "server_total", (F.col("items") >= F.col("server_total")).alias("complete"))
