"""How five document filters interact in every order, by difference arrays over Lehmer ranks.

Each document fails a subset of the filters, its mask; only numbers of
documents by part and mask are counted.  An order's Lehmer rank is its place
among all 120 in lexicographic order.  A mask leaves an order at its first
filter in that order.  The orders that begin with the same filters, none of
them in the mask but the last, are neighbours: they fill one interval of ranks.
So a mask's number of documents is added where such an interval begins and
subtracted where it ends, at the interval's step, and a running sum over the
ranks gives what each step of each order removes.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, table

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
COUNTS = ("n", "good", "toxic")


def intervals(filters: str = FILTERS) -> list[tuple[int, int, int, int]]:
    """(mask, step, first rank, last rank + 1): where orders that begin alike remove the documents of a mask."""
    found = []

    def descend(mask: int, before: str, begin: int) -> None:
        left = [f for f in filters if f not in before]
        width = factorial(len(left) - 1)
        for digit, f in enumerate(left):
            at = begin + digit * width  # digit by digit the Lehmer code of the orders that begin with before + f
            if mask >> filters.index(f) & 1:
                found.append((mask, len(before) + 1, at, at + width))
            elif len(left) > 1:
                descend(mask, before + f, at)

    for mask in range(1, 1 << len(filters)):
        descend(mask, "", 0)
    return found


def failures(text: Column) -> dict[str, Column]:
    """The filters that look at a text alone."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    return {
        "A": n < 200,
        "B": F.lit(100) * distinct < F.lit(50) * n,
        "C": F.lit(100) * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > F.lit(2) * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): how many documents of a part fail exactly the filters of a mask, and have a label.

    Only (id, hash, part, mask) of a document ever shuffles: to the labels by
    id, and, one line for equal ones, to the smallest id of its text.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text.alias("text"))
    alone = sum((F.when(fails, 1 << FILTERS.index(f)).otherwise(0) for f, fails in failures(F.col("text")).items()), F.lit(0))
    sha = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    # rows without id look for labels in many tasks, not in one
    salt = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(0)
    seen = rows.select("doc_id", "part", alone.cast("int").alias("mask"), sha.alias("sha"), salt.alias("salt"))
    marked = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"), F.lit(0).cast("long").alias("salt"))
    marked = marked.agg(F.coalesce(F.max((F.col("quality") == 1).cast("int")), F.lit(0)).alias("good"), F.coalesce(F.max((F.col("toxic") == 1).cast("int")), F.lit(0)).alias("toxic"))
    labelled = seen.join(marked, ["doc_id", "salt"], "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("good", "toxic")})
    # equal texts fail the same of A to D: a line a text, part and labels, with its smallest id and how many rows have that
    same_id = labelled.groupBy("doc_id", "salt", "sha", "part", "mask", "good", "toxic").agg(F.count(F.lit(1)).alias("n"))
    by_text = same_id.groupBy("sha", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min("doc_id").alias("first"), F.min_by("n", "doc_id").alias("at_first"), F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("without_id"),
    )
    least = F.min("first").over(Window.partitionBy("sha"))
    # rows without id have no smaller id before them; of the others only those with the text's smallest id pass E
    passing = F.col("without_id") + F.when(F.col("first") == least, F.col("at_first")).otherwise(0)
    both = by_text.withColumn("passing", passing).select(
        "part", "good", "toxic", F.explode(F.array(F.struct("mask", F.col("passing").alias("n")), F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - F.col("passing")).alias("n")))).alias("x")
    )
    counted = both.select("part", "x.mask", "x.n", (F.col("good") * F.col("x.n")).alias("good"), (F.col("toxic") * F.col("x.n")).alias("toxic")).where("n > 0")
    return counted.groupBy("part", "mask").agg(*(F.sum(c).alias(c) for c in COUNTS))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    Whole texts count, however long; a null text is the empty one, a null
    source the empty part.  Rows that repeat an id and a text are documents of
    their own, of which none has a smaller id than another; a row without id
    has no label and is never a copy.  A document with several labels is good
    or toxic if one of them says so.  An empty table gives no rows; other
    columns play no part.
    """
    spark = docs.sparkSession
    counts = cut(masks(docs, labels))  # at most 32 rows a part; read several times
    has = lambda k: F.col("mask").bitwiseAND(F.lit(1 << k)) > 0
    fails = [F.sum(F.when(has(k), F.col("n")).otherwise(0)).alias(f"fails{k}") for k in range(5)]
    only = [F.sum(F.when(F.col("mask") == 1 << k, F.col("n")).otherwise(0)).alias(f"only{k}") for k in range(5)]
    parts = counts.groupBy("part").agg(F.sum("n").alias("total"), *fails, *only)
    parts = parts.withColumn("fails", F.array(*(f"fails{k}" for k in range(5)))).withColumn("only", F.array(*(f"only{k}" for k in range(5))))
    ends = spark.createDataFrame([(m, s, r, sign) for m, s, a, b in intervals() for r, sign in ((a, 1), (b, -1)) if r < len(ORDERS)], "mask int, step int, rank int, sign int")
    places = spark.createDataFrame([(r, s + 1, o, o[s], FILTERS.index(o[s])) for r, o in enumerate(ORDERS) for s in range(5)], "rank int, step int, filter_order string, filter string, k int")
    changes = counts.join(F.broadcast(ends), "mask")
    given = changes.select("part", "step", "rank", *((F.col(c) * F.col("sign")).alias(c) for c in COUNTS))
    steps = F.explode(F.sequence(F.lit(1), F.lit(5))).alias("step")
    grid = parts.select("part", steps).select("part", "step", F.explode(F.sequence(F.lit(0), F.lit(len(ORDERS) - 1))).alias("rank"), *(F.lit(0).cast("long").alias(c) for c in COUNTS))
    change = given.unionByName(grid).groupBy("part", "step", "rank").agg(*(F.sum(c).alias(c) for c in COUNTS))
    over_ranks = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    removed = change.select("part", "step", "rank", *(F.sum(c).over(over_ranks).alias(c) for c in COUNTS)).join(F.broadcast(places), ["rank", "step"])
    over_steps = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    summed = removed.withColumn("gone", F.sum("n").over(over_steps)).withColumn("shapley", F.sum("n").over(Window.partitionBy("part", "k")))
    whole = summed.join(parts.select("part", "total", "fails", "only"), "part")
    return whole.select(
        "part", "filter_order", "step", (F.col("total") - F.col("gone")).alias("kept"), F.col("n").alias("removed"), (F.get("fails", F.col("k")) - F.col("n")).alias("redundant"),
        F.get("only", F.col("k")).alias("unique_fails"), F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"), "shapley",
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, part, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d),
l AS (SELECT doc_id, coalesce(max(CAST(quality = 1 AS INT)), 0) AS good, coalesce(max(CAST(toxic = 1 AS INT)), 0) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT w.part, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic,
  (CASE WHEN len(words) < 200 THEN 'A' ELSE '' END) || (CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END)
  || (CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 2 * length(text) THEN 'C' ELSE '' END)
  || (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END)
  || (CASE WHEN w.doc_id > min(w.doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END) AS failed
  FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
m AS (SELECT part, failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
o AS (SELECT a.c || b.c || c.c || d.c || e.c AS filter_order FROM x a, x b, x c, x d, x e
  WHERE b.c <> a.c AND c.c NOT IN (a.c, b.c) AND d.c NOT IN (a.c, b.c, c.c) AND e.c NOT IN (a.c, b.c, c.c, d.c)),
s AS (SELECT filter_order, CAST(step AS INT) AS step, substr(filter_order, step, 1) AS f, substr(filter_order, 1, step) AS upto, substr(filter_order, 1, step - 1) AS before FROM o, (SELECT unnest(range(1, 6)) AS step)),
r AS (SELECT part, filter_order, step, f,
  sum(CASE WHEN translate(failed, upto, '') = failed THEN n ELSE 0 END) AS kept,
  sum(CASE WHEN contains(failed, f) AND translate(failed, before, '') = failed THEN n ELSE 0 END) AS removed,
  sum(CASE WHEN contains(failed, f) AND translate(failed, before, '') <> failed THEN n ELSE 0 END) AS redundant,
  sum(CASE WHEN failed = f THEN n ELSE 0 END) AS unique_fails,
  sum(CASE WHEN contains(failed, f) AND translate(failed, before, '') = failed THEN good ELSE 0 END) AS good_lost,
  sum(CASE WHEN contains(failed, f) AND translate(failed, before, '') = failed THEN toxic ELSE 0 END) AS toxic_lost
  FROM m, s GROUP BY ALL)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley FROM r
"""
