"""A stored token index: postings in blocks of ids, found by token and joined by block."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .progress import token_index

#: Ids of one block lie within a span of so many.
SPAN = 1 << 12


def postings(df: DataFrame, id_col: str, text_col: str, span: int = SPAN) -> DataFrame:
    """(token, block, first_id, last_id, n, offsets): the ids of a token in a block, as the first and the distances of all to it.

    Blocks are spans of ids, so a token that all rows have fills many rows of
    at most ``span`` ids, in as many tasks; a token never gathers in one place.
    Distances are small numbers, which Parquet packs into a few bits each.
    """
    pairs = token_index(df, id_col, text_col).where("id IS NOT NULL").select("token", F.col("id").cast("long").alias("id"))
    blocks = pairs.groupBy("token", F.floor(F.col("id") / span).cast("long").alias("block")).agg(F.array_sort(F.collect_set("id")).alias("ids"))
    first = F.element_at("ids", 1)
    offsets = F.transform("ids", lambda i: (i - first).cast("int"))
    return blocks.select("token", "block", first.alias("first_id"), F.element_at("ids", -1).alias("last_id"), F.size("ids").alias("n"), offsets.alias("offsets"))


def write_index(df: DataFrame, id_col: str, text_col: str, path: str, span: int = SPAN, partitions: int | None = None) -> None:
    """Write the postings in the order of tokens, so that a search reads the row groups of its tokens alone."""
    rows = postings(df, id_col, text_col, span)
    laid = rows.repartitionByRange(partitions, "token", "block") if partitions else rows.repartitionByRange("token", "block")
    laid.sortWithinPartitions("token", "block").write.mode("overwrite").option("parquet.bloom.filter.enabled#token", "true").parquet(path)


def search_index(spark: SparkSession, path: str, words: Sequence[str]) -> DataFrame:
    """Ids of the rows that have all words (any case); no words find nothing.

    The scan gets the tokens.  Blocks that lack a token, or in which the
    tokens' ranges of ids don't meet, go before any id is unpacked.
    """
    wanted = sorted({w.lower() for w in words})
    rows = spark.read.parquet(path).where(F.col("token").isin(*wanted) if wanted else F.lit(False))
    posting = F.struct("n", "first_id", "offsets")
    met = rows.groupBy("block").agg(F.count(F.lit(1)).alias("tokens"), F.max("first_id").alias("low"), F.min("last_id").alias("high"), F.collect_list(posting).alias("lists"))
    met = met.where((F.col("tokens") == len(wanted)) & (F.col("low") <= F.col("high")))
    # within a block: the rarest token's ids that stand in all other lists
    ids = lambda p: F.filter(F.transform(p["offsets"], lambda o: p["first_id"] + o), lambda i: i.between(F.col("low"), F.col("high")))
    lists = F.transform(F.array_sort("lists"), ids)
    common = F.aggregate(F.slice(lists, 2, len(wanted)), F.element_at(lists, 1), lambda a, b: F.array_intersect(a, b))
    return met.select(F.explode(common).alias("id"))
