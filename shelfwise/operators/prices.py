"""Price histories to current prices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from .merging import fan_out_prices


def latest_buckets(history: DataFrame) -> DataFrame:
    """The last bucket of each (product, result): by date, and of equal dates the later place.

    History has product_id, result_pos, variant, cond, bucket_date, bucket_pos
    (any value with an order, a struct too), market, low.  Date and place are
    compared as they are, so no place reaches into the next date, however
    large; bad dates (null) are no buckets.
    """
    rows = history.where("bucket_date IS NOT NULL")
    last = F.max_by(F.struct("bucket_date", "market", "low"), F.struct("bucket_date", "bucket_pos"))
    grouped = rows.groupBy("product_id", "result_pos", "variant", "cond").agg(last.alias("_last")).select("*", "_last.*")
    return grouped.select("product_id", "result_pos", "variant", "cond", "bucket_date", "market", "low")


def first_priced_variant(latest: DataFrame) -> DataFrame:
    """Of each product and normalised variant the first near-mint result whose last bucket has a price; a low of 0 or less is null.

    A product's results have different places (``result_pos``).
    """
    priced = latest.where(S.near_mint(F.col("cond")) & (F.col("market") > 0)).withColumn("variant_key", S.normalize_variant(F.col("variant"))).where("variant_key IS NOT NULL")
    first = priced.groupBy("product_id", "variant_key").agg(F.min("result_pos").alias("result_pos"), F.min_by("market", "result_pos").alias("market"), F.min_by("low", "result_pos").alias("low"))
    return first.withColumn("low", F.when(F.col("low") > 0, F.col("low")))


def price_maps(variants: DataFrame) -> DataFrame:
    """product_id, prices (variant to market and low, in the order of the results) and best_price.  A product has few variants."""
    in_order = F.array_sort(F.collect_list(F.struct("result_pos", "variant_key", "market", "low")))
    entries = F.transform(in_order, lambda e: F.struct(e["variant_key"], F.struct(e["market"].alias("market"), e["low"].alias("low"))))
    return variants.groupBy("product_id").agg(F.map_from_entries(entries).alias("prices")).withColumn("best_price", S.best_history_price(F.col("prices")))


def current_prices(history: DataFrame) -> DataFrame:
    """All three steps; products without a usable price have no row."""
    return price_maps(first_priced_variant(latest_buckets(history)))


#: A landed price history, as its source names the fields.  Prices are numbers or text, so they are read as text.
BUCKET = "struct<bucketStartDate:string, marketPrice:string, lowSalePrice:string>"
HISTORY = f"struct<result: array<struct<variant: string, condition: string, buckets: array<{BUCKET}>>>>"


def read_histories(bodies: DataFrame, body: str = "body") -> DataFrame:
    """``bodies`` with ``results`` (array of variant, condition, buckets) in place of each response's text; no results where it has none or is no JSON."""
    results = F.from_json(body, HISTORY)["result"]
    return bodies.withColumn("results", F.coalesce(results, F.array().cast(f"array<struct<variant:string,condition:string,buckets:array<{BUCKET}>>>"))).drop(body)


def _price(text: Column) -> Column:
    """A price as a number: missing, empty and unreadable ones are 0, as no price is."""
    return F.coalesce(F.trim(text).try_cast("double"), F.lit(0.0))


def _day(bucket: Column) -> Column:
    """The day on which a bucket starts, or null where that can't be read."""
    return F.try_to_date(bucket["bucketStartDate"], "yyyy-M-d")


def _last_bucket(buckets: Column) -> Column:
    """The last bucket with a readable date, of equal dates the one that stands later: (date, pos, market, low), or null."""

    def dated(bucket: Column, at: Column) -> Column:
        return F.struct(_day(bucket).alias("date"), at.alias("pos"), _price(bucket["marketPrice"]).alias("market"), _price(bucket["lowSalePrice"]).alias("low"))

    return F.array_max(F.filter(F.transform(buckets, dated), lambda b: b["date"].isNotNull()))


def latest_nested(histories: DataFrame) -> DataFrame:
    """A row per product and result, with its last bucket: the rows of ``latest_buckets`` straight from nested ``results``.

    Higher-order functions work within a product's row, so nothing shuffles;
    results without a readable bucket have no row.
    """

    def with_last(r: Column, at: Column) -> Column:
        return F.struct((at + 1).alias("result_pos"), r["variant"].alias("variant"), r["condition"].alias("cond"), _last_bucket(r["buckets"]).alias("last"))

    last = F.transform("results", with_last)
    rows = histories.select("product_id", F.explode(F.filter(last, lambda r: r["last"].isNotNull())).alias("r"))
    return rows.select("product_id", "r.result_pos", "r.variant", "r.cond", F.col("r.last.date").alias("bucket_date"), "r.last.market", "r.last.low")


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is worked out once a row: through a generator, neither filters nor later columns copy its expression, as they do through a projection."""
    return df.select("*", F.inline(F.array(F.struct(value.alias(name)))))


def nested_prices(histories: DataFrame) -> DataFrame:
    """product_id, prices, best_price and bad_buckets (buckets without a readable date) from nested ``results``, one row per row and without a shuffle.

    The near-mint results come in their order; the first of each normalised
    variant whose last bucket has a price counts.  A product without any has an
    empty map and a best price of 0.
    """
    near = F.filter("results", lambda r: S.near_mint(r["condition"]))
    keyed = F.transform(near, lambda r: F.struct(S.normalize_variant(r["variant"]).alias("key"), _last_bucket(r["buckets"]).alias("last")))
    rows = _once(histories, "_priced", F.filter(keyed, lambda r: r["key"].isNotNull() & (r["last"]["market"] > 0)))
    firsts = F.filter("_priced", lambda r, at: F.array_position(F.col("_priced.key"), r["key"]) == at + 1)
    entries = F.transform(firsts, lambda r: F.struct(r["key"], F.struct(r["last"]["market"].alias("market"), F.when(r["last"]["low"] > 0, r["last"]["low"]).alias("low"))))
    bad = F.aggregate("results", F.lit(0).cast("long"), lambda s, r: s + F.size(F.filter(F.coalesce(r["buckets"], F.array()), lambda b: _day(b).isNull())))
    found = _once(rows.withColumn("bad_buckets", bad), "prices", F.map_from_entries(entries))
    return found.select("product_id", "prices", S.best_history_price(F.col("prices")).alias("best_price"), "bad_buckets")


def refresh_from_histories(cards: DataFrame, histories: DataFrame, at: Column) -> DataFrame:
    """The whole refresh of cards from nested histories, one a product: only the fan-out to the cards joins anything."""
    return fan_out_prices(cards, nested_prices(histories).where(F.size("prices") > 0), at)
