"""Registered queries of landed responses: nested price histories and the completeness of paged sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import merging, prices, progress
from ..sources import landing
from .registry import read, registered
from .views import view

#: Landed histories: a response a product, whose results are its (line, variant, condition) and whose buckets are its orders; some dates are
#: unreadable, every third price is text, and of an order's buckets the one with the higher price stands later.
BAD_DATE = "ord % 17 = 3"


def _landed_histories(spark, d):
    history = view(spark, d, "price_history")
    shown = lambda c: f"case when ord % 3 = 0 then concat('\"', cast({c} as string), '\"') else cast({c} as string) end"
    bucket = F.expr(
        f"""concat('{{"bucketStartDate":"', case when {BAD_DATE} then 'soon' else cast(bucket_date as string) end, '","marketPrice":', {shown('market')}, ',"lowSalePrice":', {shown('low')}, '}}')"""
    )
    buckets = history.groupBy("product_id", "line_no", "variant", "cond").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "market", "low", bucket.alias("json")))), lambda b: b["json"]).alias("buckets"))
    result = F.concat(F.lit('{"variant":"'), "variant", F.lit('","condition":"'), "cond", F.lit('","buckets":['), F.array_join("buckets", ","), F.lit("]}"))
    results = buckets.groupBy("product_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "variant", "cond", result.alias("json")))), lambda r: r["json"]).alias("results"))
    return results.select("product_id", F.concat(F.lit('{"count":1,"result":['), F.array_join("results", ","), F.lit("]}")).alias("body"))


LATEST = f"""latest AS (SELECT product_id, line_no, variant, cond, max(bucket_date) AS bucket_date, arg_max({{'m': market, 'l': low}}, {{'d': bucket_date, 'o': ord, 'm': market, 'l': low}}) AS b
 FROM price_history WHERE NOT ({BAD_DATE}) GROUP BY 1,2,3,4)"""


@registered("WITH " + LATEST + " SELECT product_id, variant, cond, bucket_date, b.m AS market, b.l AS low FROM latest", "price_history")
def w1_nested(spark, d):
    """The last bucket of every result, from responses as they land."""
    found = prices.latest_nested(prices.read_histories(_landed_histories(spark, d)))
    return found.select("product_id", "variant", "cond", "bucket_date", "market", "low")


@registered(
    f"""WITH b AS (SELECT product_id, count(*) FILTER ({BAD_DATE}) AS bad_buckets FROM price_history GROUP BY product_id)
SELECT product_id, bad_buckets FROM b WHERE bad_buckets > 0""",
    "price_history",
)
def w1_bad_dates(spark, d):
    """Buckets whose date can't be read, counted for each product; they stop nothing."""
    found = prices.nested_prices(prices.read_histories(_landed_histories(spark, d)))
    return found.where("bad_buckets > 0").select("product_id", "bad_buckets")


NESTED_REFRESH = "WITH " + LATEST + """,
k AS (SELECT product_id, row_number() OVER (PARTITION BY product_id ORDER BY line_no, variant, cond) AS pos, b.m AS market, b.l AS low, CASE variant
  WHEN 'Reverse Holofoil' THEN 'reverseholofoil' WHEN 'Foil' THEN 'foil' WHEN 'Normal' THEN 'normal' WHEN 'Unlimited' THEN 'normal'
  WHEN '1st Edition Holofoil' THEN '1steditionholofoil' ELSE 'holofoil' END AS variant_key FROM latest WHERE cond <> 'Lightly Played' AND b.m > 0),
f AS (SELECT product_id, variant_key, pos, market, CASE WHEN low > 0 THEN low END AS low FROM (SELECT *, row_number()
  OVER (PARTITION BY product_id, variant_key ORDER BY pos) AS r FROM k) WHERE r = 1),
best AS (SELECT product_id, coalesce(max(CASE WHEN variant_key='holofoil' THEN market END), max(CASE WHEN variant_key='normal' THEN market END), max(CASE
  WHEN variant_key='reverseholofoil' THEN market END), max(CASE
  WHEN variant_key='1steditionholofoil' THEN market END), arg_min(market, pos)) AS best_price, string_agg(variant_key, ',' ORDER BY pos) AS variants FROM f
  GROUP BY product_id)"""


@registered(
    NESTED_REFRESH
    + """ SELECT c.id, coalesce(b.best_price, c.price) AS price, b.variants, CASE WHEN b.product_id IS NOT NULL THEN '2024-06-01 00:00:00' END AS scraped_at
FROM cards c LEFT JOIN best b ON c.product_id=b.product_id""",
    "price_history", "cards",
)
def w1_nested_refresh(spark, d):
    """The price refresh of all cards from responses as they land."""
    histories = prices.read_histories(_landed_histories(spark, d))
    rows = prices.refresh_from_histories(view(spark, d, "cards"), histories, F.lit("2024-06-01").cast("timestamp"))
    return rows.select("id", "price", F.array_join(F.map_keys("prices"), ",").alias("variants"), F.col("scraped_at").cast("string").alias("scraped_at"))


#: Pages of 20 cards of each set as they land; some are missing, some are empty, one is landed twice, and totals are text now and then.
TOTALS = """t AS (SELECT set_id, set_no, count(*) AS total FROM (SELECT s.set_id, s.set_no, c.id FROM sets s JOIN cards c ON s.set_id = c.set_id) GROUP BY ALL),
p AS (SELECT set_id, set_no, total, i AS page, least(20, total - 20 * (i - 1)) AS held FROM t, generate_series(1, 2000) s(i) WHERE 20 * (i - 1) < total),
landed AS (SELECT set_id, set_no, total, page, CASE WHEN (set_no + page) % 7 = 2 THEN 0 ELSE held END AS items FROM p WHERE (set_no * 3 + page) % 5 <> 1
  AND NOT (set_no % 6 = 1 AND page BETWEEN 2 AND 4))"""


def _landed_pages(spark, d):
    cards, sets = view(spark, d, "cards"), view(spark, d, "sets")
    totals = cards.join(sets.select("set_id", "set_no"), "set_id").groupBy("set_id", "set_no").agg(F.count(F.lit(1)).alias("total"))
    pages = totals.withColumn("page", F.explode(F.sequence(F.lit(1).cast("long"), F.ceil(F.col("total") / 20))))
    landed = pages.where("(set_no * 3 + page) % 5 <> 1 AND NOT (set_no % 6 = 1 AND page BETWEEN 2 AND 4)")
    held = F.expr("case when (set_no + page) % 7 = 2 then 0 else least(20, total - 20 * (page - 1)) end").cast("int")
    data = F.concat(F.lit("["), F.repeat(F.lit('{"id":"x"},'), held - 1), F.when(held > 0, '{"id":"x"}').otherwise(""), F.lit("]"))
    body = F.concat(F.lit('{"data":'), F.when(held == 0, "null").otherwise(data), F.lit(',"totalCount":'), F.expr("case when page % 2 = 0 then concat('\"', total, '\"') else cast(total as string) end"), F.lit("}"))
    bodies = landed.select("set_id", "page", body.alias("body"))
    return bodies.unionByName(bodies.where("page = 1"))


@registered(
    "WITH " + TOTALS + """, e AS (SELECT set_id, max(ceil(total / 20.0)) AS last FROM landed GROUP BY set_id),
x AS (SELECT e.set_id, i AS page FROM e, generate_series(1, 2000) s(i) WHERE i <= last AND NOT EXISTS (SELECT 1 FROM landed l WHERE l.set_id = e.set_id AND l.page = i
  AND l.items > 0)),
g AS (SELECT set_id, page, page - row_number() OVER (PARTITION BY set_id ORDER BY page) AS island FROM x)
SELECT set_id, min(page) AS first_missing, max(page) AS last_missing FROM g GROUP BY set_id, island""",
    "sets", "cards",
)
def s1_missing_pages(spark, d):
    """Ranges of pages that the server's total asks for and that haven't landed."""
    return landing.missing_pages(landing.page_totals(_landed_pages(spark, d)), 20)


@registered(
    "WITH " + TOTALS + """ SELECT set_id, CAST(max(ceil(total / 20.0)) AS BIGINT) AS expected_pages, count(*) FILTER (items > 0) AS landed_pages,
  CAST(sum(items) AS BIGINT) AS items, max(total) AS server_total, sum(items) >= max(total) AS complete
FROM landed GROUP BY set_id""",
    "sets", "cards",
)
def s1_completeness(spark, d):
    return landing.completeness(landing.page_totals(_landed_pages(spark, d)), 20)


@registered(
    "WITH " + TOTALS + """ SELECT CAST(sum(i) AS BIGINT) AS local_items, CAST(sum(m) AS BIGINT) AS server_total, sum(i) >= sum(m) AS complete
FROM (SELECT sum(items) AS i, max(total) AS m FROM landed GROUP BY set_id)""",
    "sets", "cards",
)
def a12_server_total(spark, d):
    """Whether what is there reaches what the server says there is, over all sets."""
    return progress.against_server(landing.completeness(landing.page_totals(_landed_pages(spark, d)), 20))


BACKLOG = "WITH b AS (SELECT s.*, coalesce(n, 0) AS existing, (card_count > 0 AND coalesce(n,0) >= card_count) OR set_no IN (15, 22) AS done FROM sets s LEFT JOIN (SELECT set_id, count(*) AS n FROM cards WHERE id%3<>0 OR set_id LIKE '%4' GROUP BY set_id) c ON s.set_id=c.set_id)"


@registered(
    BACKLOG + """, o AS (SELECT *, CASE WHEN set_no = 12 THEN greatest(existing, 30) ELSE existing END AS start_offset FROM b)
SELECT count(*) FILTER (done) AS sets_done, count(*) FILTER (NOT done) AS sets_open,
 CAST(sum(CASE WHEN done THEN existing WHEN start_offset > 0 AND (card_count <= 0 OR start_offset < card_count) THEN start_offset ELSE 0 END) AS BIGINT) AS rows_skipped, bool_and(done) AS complete
FROM o""",
    "sets", "cards",
)
def a12_start_offsets(spark, d):
    """Coverage of a run that starts each open set where its rows or its checkpoint end; the checkpoint is on one set."""
    from ..functions import scalars as S

    backlog = merging.backlog(view(spark, d, "sets"), view(spark, d, "cards").where("id%3<>0 OR set_id LIKE '%4'"), [15, 22])
    offset = S.start_offset("existing", F.col("existing"), F.expr("case when set_no = 12 then 30 end"), F.lit(True))
    return progress.coverage(backlog.withColumn("start_offset", offset))
