"""Counts, budgets, pages, streaks and states of incremental runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def distinct_products(cards: DataFrame) -> DataFrame:
    return cards.where("product_id IS NOT NULL").select("product_id").distinct()


def run_summary(classified: DataFrame, existing: DataFrame) -> DataFrame:
    """created, updated, skipped, failed and changed: accepted rows count as updated where their id existed before."""
    there = existing.select(F.col("id").alias("_id")).distinct()
    joined = classified.join(there, F.col("id") == F.col("_id"), "left")
    accepted = F.col("status") == "accepted"
    found = joined.agg(
        F.count_if(accepted & F.col("_id").isNull()).alias("created"),
        F.count_if(accepted & F.col("_id").isNotNull()).alias("updated"),
        F.count_if(F.col("status") == "skipped").alias("skipped"),
        F.count_if(F.col("status") == "failed").alias("failed"),
    )
    return found.withColumn("changed", F.col("created") + F.col("updated") > 0)


def write_observed(classified: DataFrame, existing: DataFrame, path: str) -> dict[str, int]:
    """Write the accepted rows and count all of them on the way: ``run_summary`` of what was written, without a second scan.

    ``classified`` has id and status.  A task that is repeated counts once.
    """
    there = existing.select(F.col("id").alias("_id")).distinct()
    joined = classified.join(there, F.col("id") == F.col("_id"), "left")
    accepted, counters = F.col("status") == "accepted", Observation()
    observed = joined.observe(
        counters,
        F.count_if(accepted & F.col("_id").isNull()).alias("created"),
        F.count_if(accepted & F.col("_id").isNotNull()).alias("updated"),
        F.count_if(F.col("status") == "skipped").alias("skipped"),
        F.count_if(F.col("status") == "failed").alias("failed"),
        F.count(F.lit(1)).alias("fetched"),
    )
    observed.where(accepted).drop("_id", "status").write.mode("overwrite").parquet(path)
    return dict(counters.get)


def close_observed(spark: SparkSession, run_id: int | str, counters: dict[str, int], finished_at: str, stopped: bool = False, **rest: int | str | None) -> DataFrame:
    """The event that closes a run, from counters taken while it wrote; ``rest`` are other columns of RUN_CLOSED."""
    found = {"rows_fetched": counters["fetched"], "rows_upserted": counters["created"] + counters["updated"], "finished_at": finished_at} | rest
    values = [F.lit(found.get(c)).cast("string" if c in ("error_message", "finished_at") else "long").alias(c) for c in RUN_CLOSED]
    one = spark.range(1).select(F.lit(run_id).alias("run_id"), F.lit("stopped" if stopped else "completed").alias("status"), *values)
    return close_runs(one)


def call_credits(body_total: Column, header: Column, requested: Column) -> Column:
    """A call's credits: the body's total, else the header's, else 0; and 0 falls back to what was requested."""
    return F.coalesce(F.nullif(F.coalesce(body_total, header, F.lit(0)), F.lit(0)), requested)


def credits_per_day(calls: DataFrame, credits: str = "credits") -> DataFrame:
    """Credits and calls of each key and UTC day; every day starts afresh."""
    return calls.groupBy("key_id", F.to_date("ts").alias("day")).agg(F.sum(F.col(credits).cast("long")).alias("credits"), F.count(F.lit(1)).alias("calls"))


def completed_sets(ids: DataFrame, column: str = "set_id") -> DataFrame:
    """One row: the distinct whole-number ids, sorted; others are left out."""
    return ids.agg(F.array_sort(F.collect_set(F.col(column).try_cast("int"))).alias("completed"))


def add_to_set(array: Column, value: Column) -> Column:
    return F.array_sort(F.array_union(array, F.array(value)))


def coverage(backlog: DataFrame) -> DataFrame:
    """Sets done and open, rows skipped, and whether all sets are done.

    Skipped are the existing rows of done sets and, of an open one, those
    before its start offset where that is above 0 and, with a known count,
    below it.  ``start_offset`` is the existing rows unless there is such a column.
    """
    offset = F.col("start_offset") if "start_offset" in backlog.columns else F.col("existing")
    partly = (offset > 0) & (F.coalesce(F.col("card_count") <= 0, F.lit(True)) | (offset < F.col("card_count")))
    skipped = F.when(F.col("done"), F.col("existing")).when(partly, offset).otherwise(0)
    return backlog.agg(F.count_if("done").alias("sets_done"), F.count_if(~F.col("done")).alias("sets_open"), F.sum(skipped).cast("long").alias("rows_skipped"), F.every("done").alias("complete"))


def against_server(groups: DataFrame) -> DataFrame:
    """One row over ``completeness`` of all groups: items that are there, the server's total, and whether they reach it."""
    sums = groups.agg(F.sum("items").alias("local_items"), F.sum("server_total").alias("server_total"))
    return sums.withColumn("complete", F.col("local_items") >= F.col("server_total"))


def links_by_href(links: DataFrame, *within: str) -> DataFrame:
    """Of each href (``within`` columns such as a page) the first text that isn't empty and the last image; only hrefs with both."""
    text, image = F.when(F.col("text") != "", F.col("text")), F.when(F.col("img") != "", F.col("img"))
    grouped = links.groupBy(*within, "href").agg(
        F.min_by(text, F.when(text.isNotNull(), F.col("pos"))).alias("name"),
        F.max_by(image, F.when(image.isNotNull(), F.col("pos"))).alias("image"),
        F.min("pos").alias("position"),
    )
    return grouped.where("name IS NOT NULL AND image IS NOT NULL")


def mean_vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """Element-wise means, by one aggregate over whole vectors at any width: partial sums only, nothing is exploded."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    whole = array_to_vector(F.transform(vector, lambda x: x.cast("double")))
    return df.where(F.col(vector).isNotNull()).groupBy(key).agg(Summarizer.mean(whole).alias("mean")).withColumn("mean", vector_to_array("mean"))


def percentile_bounds(df: DataFrame, key: str, value: str, low: float = 0.02, high: float = 0.98) -> DataFrame:
    """Exact percentiles with linear interpolation."""
    return df.groupBy(key).agg(F.percentile(value, F.lit(low)).alias("low"), F.percentile(value, F.lit(high)).alias("high"))


def running_cost(requests: DataFrame, cost: str, group: str, group_order: Sequence[Column], order: Sequence[Column]) -> DataFrame:
    """``requests`` with ``before``, what all requests before cost: groups in their order, requests in theirs within a group.

    Sums are made level by level: within each group, over the groups that
    share the first column of their order (the sets of a release year), and
    over that column's values; only these values meet in one task.
    """
    columns = {f"_o{k}": c for k, c in enumerate(group_order)} or {"_o0": F.lit(0)}
    sums = requests.withColumns(columns).groupBy(group, *columns).agg(F.sum(cost).alias("_sum"))
    first, *later = columns
    upto = lambda w: F.coalesce(F.sum("_sum").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    values = sums.groupBy(F.col(first).alias("_first")).agg(F.sum("_sum").alias("_sum"))
    bases = values.select("_first", upto(Window.orderBy(F.asc_nulls_last("_first"))).alias("_base"))
    sharing = Window.partitionBy(first).orderBy(*(F.asc_nulls_last(n) for n in later), group)
    placed = sums.withColumn("_upto", upto(sharing)).join(bases, F.col(first).eqNullSafe(F.col("_first")))
    offsets = placed.select(F.col(group).alias("_group"), (F.col("_base") + F.col("_upto")).alias("_offset"))
    inside = Window.partitionBy(group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = requests.join(offsets, F.col(group) == F.col("_group")).drop("_group")
    return joined.withColumn("before", (F.col("_offset") + F.coalesce(F.sum(cost).over(inside), F.lit(0))).cast("long")).drop("_offset")


def within_budget(running: DataFrame, cost: str, maximum: Column, used: Column | None = None, remaining: Column | None = None, reserve: int = 0) -> DataFrame:
    """The requests of a run that are made, from ``running_cost``, with ``used``, what is used after each.

    A run stops before the first request that would pass the maximum, given
    what was used before the run, and after one that leaves no more than the
    reserve of what remained at its start.  Costs are positive, so what is made
    is a prefix of the run.
    """
    start = F.lit(0) if used is None else used
    rows = running.withColumn("used", (start + F.col("before") + F.col(cost)).cast("long")).where(F.col("used") <= maximum)
    return (rows if remaining is None else rows.where((F.col("before") == 0) | (remaining - F.col("before") > reserve))).drop("before")


def run_status(requests: DataFrame, made: DataFrame) -> DataFrame:
    """One row: how many requests were asked for and made, and ``stopped`` unless all were, else ``completed``."""
    both = requests.select(F.lit(1).alias("asked"), F.lit(0).alias("done")).unionByName(made.select(F.lit(0).alias("asked"), F.lit(1).alias("done")))
    sums = both.agg(F.coalesce(F.sum("asked"), F.lit(0)).alias("asked"), F.coalesce(F.sum("done"), F.lit(0)).alias("made"))
    return sums.withColumn("status", F.when(F.col("made") < F.col("asked"), "stopped").otherwise("completed"))


def granted(running: DataFrame, cost: str, maximum: Column) -> DataFrame:
    """What each request of a run gets, from ``running_cost``, when the last one may be cut short."""
    return running.withColumn("granted", F.greatest(F.lit(0), F.least(F.col(cost), maximum - F.col("before"))).cast("long")).drop("before")


def failure_streaks(calls: DataFrame, threshold: int = 15) -> DataFrame:
    """The network failures of each key since its last success, at every call; other failures leave the streak unchanged."""
    by = Window.partitionBy("key_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    island = calls.withColumn("_island", F.sum(F.when(F.col("outcome") == "ok", 1).otherwise(0)).over(by))
    inside = Window.partitionBy("key_id", "_island").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    return island.withColumn("streak", F.sum(F.when(F.col("outcome") == "network", 1).otherwise(0)).over(inside)).withColumn("abort", F.col("streak") >= threshold).drop("_island")


def latest_state(events: DataFrame, keys: Sequence[str], at: str, seq: str) -> DataFrame:
    """The last event of each key; each task sends one row a key."""
    rest = [c for c in events.columns if c not in keys]
    last = events.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(at, seq)).alias("_e"))
    return last.select(*keys, *(F.col(f"_e.{c}").alias(c) for c in rest))


#: What opens a run, and what closes it.
RUN_OPENED = ("job_name", "language", "endpoint", "params", "started_at")
RUN_CLOSED = ("rows_fetched", "rows_upserted", "api_calls_consumed", "daily_remaining", "minute_remaining", "error_message", "finished_at")


def open_runs(runs: DataFrame) -> DataFrame:
    """Events that open runs: run_id and RUN_OPENED, status running, seq 0."""
    return runs.select("run_id", F.lit(0).cast("long").alias("seq"), F.lit("running").alias("status"), *RUN_OPENED)


def close_runs(results: DataFrame) -> DataFrame:
    """Events that close runs: run_id, status and RUN_CLOSED, seq 1."""
    return results.select("run_id", F.lit(1).cast("long").alias("seq"), "status", *RUN_CLOSED)


def run_states(events: DataFrame) -> DataFrame:
    """Each run with the last value that any of its events gave for a column."""
    given = [c for c in events.columns if c not in ("run_id", "seq")]
    return events.groupBy("run_id").agg(*(F.max_by(c, F.when(F.col(c).isNotNull(), F.col("seq"))).alias(c) for c in given))


def in_release_order(sets: DataFrame, limit: int = 10_000) -> DataFrame:
    return sets.orderBy(F.asc_nulls_last("release_year"), "name", "set_id").limit(limit)


def stalest_products(cards: DataFrame, stamp: str, limit: int = 30_000) -> DataFrame:
    """Distinct products of the rows scraped longest ago, never scraped ones first."""
    rows = cards.where("product_id IS NOT NULL").orderBy(F.asc_nulls_first(stamp), "id").limit(limit)
    return rows.select("product_id").distinct()


def plan_pages(backlog: DataFrame, limit: int) -> DataFrame:
    """A row per page that remains: start offset, page number, page size.  An unknown count (0) gives one open page."""
    from_ = F.col("start_offset")
    known = F.when(F.col("card_count") > 0, F.col("card_count").cast("long"))
    ends = F.coalesce(known, from_ + limit)
    todo = backlog.where(F.coalesce(F.col("card_count") <= 0, F.lit(True)) | (from_ < F.col("card_count")))
    pages = todo.withColumn("page_start", F.explode(F.sequence(from_, ends - 1, F.lit(limit).cast("long"))))
    return pages.withColumn("page_no", F.floor((F.col("page_start") - from_) / limit).cast("long") + 1).withColumn("page_size", F.least(F.lit(limit).cast("long"), ends - F.col("page_start")))


def catalog_order(cards: DataFrame, sets: DataFrame) -> DataFrame:
    """Cards with ``place``: by the set's release, then the number's leading digits as a number, then as text."""
    joined = cards.join(sets.select("set_id", "release_year"), "set_id")
    digits = F.nullif(F.regexp_extract("number", r"^(\d+)", 1), F.lit("")).try_cast("int")
    by = Window.partitionBy("set_id").orderBy(F.asc_nulls_last(digits), "number", "id")
    return joined.withColumn("place", F.row_number().over(by)).orderBy(F.asc_nulls_last("release_year"), "set_id", "place")


def token_index(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(token, id) pairs: an inverted index that never gathers a frequent token's ids in one row."""
    from ..functions.scalars import tokens

    return df.select(F.explode(tokens(F.col(text_col))).alias("token"), F.col(id_col).alias("id"))


def search_tokens(index: DataFrame, words: Sequence[str] | DataFrame) -> DataFrame:
    """Ids that have all words: given ones in any case, or the few tokens of a table's column ``token``, which stay in Spark."""
    if isinstance(words, DataFrame):
        wanted = words.select("token").distinct()
        number = F.broadcast(wanted.agg(F.count(F.lit(1)).alias("_wanted")))  # one row; a null is a token that no row has
        found = index.join(F.broadcast(wanted), "token").groupBy("id").agg(F.count_distinct("token").alias("n"))
        return found.crossJoin(number).where(F.col("n") == F.col("_wanted")).select("id")
    wanted = sorted({w.lower() for w in words})
    return index.where(F.col("token").isin(*wanted)).groupBy("id").agg(F.count_distinct("token").alias("n")).where(F.col("n") == len(wanted)).select("id")
