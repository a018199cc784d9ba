"""Exact deduplication with a two-pass Bloom filter, in DataFrame functions only.

Rows stay where they are, at any size of the table: they are written once,
bucketed by the input partition that holds them, so what is joined to them by
partition moves alone.

Pass 1 gives every text two positions in a bit array.  A partition names each
of its positions once, with a count; these shuffle by position, and a bit is
set where two rows or more want it.  Each partition gets its part of the array
back, folded to what its set bits need.  Pass 2 tests both bits of every row:
a row with one that isn't set is certainly unique and passes straight through.
Only the others shuffle, and of equal texts only one line a partition does
until their largest id and their number are known.  False positives of the
filter cost work but never change a result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bit_arrays, cut, ensure_checkpoint_dir, fresh, has_bit, numbered, place_of, table

#: Bits of the filter for each row; two positions a row give about 1.4 % false positives.
BITS_PER_ROW = 16
SHA, PLACE, ROW = "sha_", "place_", "row_"


def digest(text: Column) -> Column:
    """Lowercase hex SHA-256 of the whole text in UTF-8; a null text counts as empty."""
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def positions(sha: Column, bits: int) -> tuple[Column, Column]:
    return F.pmod(F.xxhash64(sha), F.lit(bits)), F.pmod(F.xxhash64(sha, F.lit(7)), F.lit(bits))


def filter_bits(n_rows: int) -> int:
    return max(1 << 16, 1 << (max(1, n_rows * BITS_PER_ROW) - 1).bit_length())


def settled(rows: DataFrame, place: str) -> DataFrame:
    """``rows`` as files in the shared folder, bucketed by ``place``, the partition that holds them: no row moves for it, or for a join on it.

    Spark knows buckets of tables only, so the files are registered, read, and
    the catalog's entry dropped at once; the files stay.
    """
    spark = rows.sparkSession
    ensure_checkpoint_dir(spark)
    name = f"settled_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows.write.bucketBy(buckets, place).format("parquet").option("path", f"{spark.sparkContext.getCheckpointDir()}/{name}").saveAsTable(name)
    found = spark.table(name)
    found.schema  # resolved while the entry is there
    spark.sql(f"DROP TABLE {name}")
    return found


def at_place(rows: DataFrame, side: DataFrame, place: str) -> DataFrame:
    """``rows`` with the array of their place; the rows don't move."""
    key = fresh(rows, "at_")
    return rows.join(side.withColumnRenamed(place, key).hint("shuffle_hash"), F.col(place) == F.col(key)).drop(key)


def possible(rows: DataFrame, sha: str, place: str, flag: str, bits: int | None = None) -> DataFrame:
    """Both passes over settled ``rows``: the same with a boolean ``flag``, false only for texts that are certainly unique."""
    bits = bits or filter_bits(rows.count())
    wanted = rows.select(place, F.explode(F.array(*positions(F.col(sha), bits))).alias("at")).groupBy(place, "at").agg(F.count(F.lit(1)).alias("n"))
    everywhere = wanted.select(place, "at", F.sum("n").over(Window.partitionBy("at")).alias("n"))
    marks = cut(everywhere.where("n > 1").select(place, "at"))
    most = marks.groupBy(place).count().agg(F.max("count")).first()[0] or 0
    folded = min(bits, max(64, 1 << (most * BITS_PER_ROW - 1).bit_length()) if most else 64)
    arrays = cut(bit_arrays(marks.select(place, (F.col("at") % folded).alias("at")), rows.select(place).distinct(), place, max(1, folded // 64)))
    first, second = (at % folded for at in positions(F.col(sha), bits))
    words = fresh(rows, "words_")
    return at_place(rows, arrays.withColumnRenamed("words", words), place).withColumn(flag, has_bit(words, first) & has_bit(words, second)).drop(words)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the largest doc_id stays.  A null text equals the empty
    one.  Rows that repeat both id and text count in group_size and share one
    fate.  A row without id is kept only if its whole group has none (keep_id
    is then null).  An empty table gives no rows; texts of any length count
    whole; columns other than id and text play no part.
    """
    rows = settled(docs.select(F.col(id_col).cast("long").alias("doc_id"), digest(F.col(text_col)).alias(SHA), F.spark_partition_id().alias(PLACE)), PLACE)
    marked = possible(rows, SHA, PLACE, "maybe", bits)
    alone = marked.where("NOT maybe").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), F.col(SHA).alias("text_sha256"))
    shared = marked.where("maybe").select("doc_id", SHA, PLACE)
    by_text = Window.partitionBy(SHA)
    mine = shared.groupBy(PLACE, SHA).agg(F.max("doc_id").alias("id"), F.count(F.lit(1)).alias("n"))
    groups = mine.select(PLACE, SHA, F.max("id").over(by_text).alias("keep_id"), F.sum("n").over(by_text).alias("group_size"))
    joined = shared.join(groups, [PLACE, SHA]).select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col(SHA).alias("text_sha256"))
    return alone.unionByName(joined)


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int | None = None) -> DataFrame:
    """``docs`` with one row of each text, that of the largest doc_id, and all its columns.

    Of rows that repeat both, or of a group without ids, one stays.  A null
    text equals the empty one; texts of any length count whole; an empty table
    stays empty; other columns, whatever their names, play no part.  The whole
    rows are written once and never shuffle: each partition gets a bit for
    every row that it has to drop.
    """
    plain, id_, text = numbered(docs), f"c{place_of(docs, id_col)}", f"c{place_of(docs, text_col)}"
    sha, place, row, gone = SHA, PLACE, ROW, "gone_"
    number = F.monotonically_increasing_id() % (1 << 33)  # within the partition
    whole = settled(plain.withColumns({sha: digest(F.col(text)), place: F.spark_partition_id(), row: number}), place)
    rows = whole.select(F.col(id_).cast("long").alias("id"), F.col(row).alias(ROW), F.col(sha).alias(SHA), F.col(place).alias(PLACE))
    # within a partition, then over all of them: the largest id (null before any), and of its rows one
    shared = possible(rows, SHA, PLACE, "maybe", bits).where("maybe").select(F.coalesce("id", F.lit(-(1 << 63))).alias("id"), ROW, SHA, PLACE)
    mine = shared.groupBy(PLACE, SHA).agg(F.max("id").alias("id"), F.max_by(ROW, "id").alias("of"))
    best = F.max(F.struct("id", PLACE, "of")).over(Window.partitionBy(SHA))
    stays = mine.select(PLACE, SHA, best.alias("best"))
    drop = shared.join(stays, [PLACE, SHA]).where((F.col(PLACE) != F.col(f"best.{PLACE}")) | (F.col(ROW) != F.col("best.of")))
    most = rows.agg(F.max(ROW)).first()[0] or 0
    arrays = cut(bit_arrays(drop.select(PLACE, F.col(ROW).alias("at")), rows.select(PLACE).distinct(), PLACE, most // 64 + 1))
    marked = at_place(whole, arrays.select(F.col(PLACE).alias(place), F.col("words").alias(gone)), place)
    return marked.where(~has_bit(gone, F.col(row))).select(*plain.columns).toDF(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


ORACLE = """
WITH t AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text_sha256)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, t.text_sha256
FROM t JOIN g USING (text_sha256)
"""
