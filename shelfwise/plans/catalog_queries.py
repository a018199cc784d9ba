"""Registered queries of the catalog jobs, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import blobs
from ..functions import scalars as S
from ..operators import html_links, mapping, merging, prices, progress
from ..sources import landing, publishing
from . import landing_queries, mapping_queries, run_queries  # noqa: F401, register their own
from .registry import ORACLES, QUERIES, read, registered  # noqa: F401
from .views import view

# ---------------------------------------------------------------- sources

PAGE = """concat('{"data":', case p_partkey%3 when 0 then concat('[{"id":"c', cast(p_partkey as string), '","name":"', p_name, '"},null,{"id":"d', cast(p_partkey as string), '"}]')
 when 1 then concat('{"id":"c', cast(p_partkey as string), '","name":"', p_name, '"}') else 'null' end, ',"metadata":{"hasMore":', case when p_partkey%2=0 then 'true' else 'false' end, '}}')"""


@registered("""
SELECT p_partkey AS page, 1 AS position, concat('c', cast(p_partkey as varchar)) AS id, p_name AS name FROM part WHERE p_partkey%3 < 2
UNION ALL SELECT p_partkey, 3, concat('d', cast(p_partkey as varchar)), NULL FROM part WHERE p_partkey%3 = 0""")
def s1_landed_pages(spark, d):
    pages = read(spark, d, "part").select(F.col("p_partkey").alias("page"), F.expr(PAGE).alias("body"))
    return landing.explode_pages(pages, "struct<id:string,name:string>").select("page", "position", "item.id", "item.name")


@registered("SELECT p_partkey, p_name FROM part WHERE p_size > 25")
def s2_read_table(spark, d):
    return landing.read_table(spark, f"{d}/part.parquet", ["p_partkey", "p_name"], "p_size > 25")


@registered("SELECT p_partkey AS list_id, 1 AS position, p_name AS name FROM part UNION ALL SELECT p_partkey, 2, p_brand FROM part")
def s3_name_list(spark, d):
    return landing.name_list(read(spark, d, "part").select(F.col("p_partkey").alias("list_id"), F.to_json(F.array("p_name", "p_brand")).alias("value")))


LOG = "concat('page=', cast(o_orderkey as string), ' cards=250 created=', cast(o_custkey%7 as string), ' updated=', cast(o_custkey%5 as string), ' skipped=0 failed=', cast(o_orderkey%3 as string))"


@registered(
    """SELECT o_orderkey AS page, o_custkey%7 AS created, o_custkey%5 AS updated, CAST(0 AS BIGINT) AS skipped, o_orderkey%3 AS failed
FROM orders WHERE o_orderstatus <> 'P'"""
)
def s5_progress_log(spark, d):
    lines = read(spark, d, "orders").select(F.expr(f"case when o_orderstatus = 'P' then 'done' else {LOG} end").alias("value"))
    return landing.parse_progress_log(lines)


RUNS = "SELECT event_id % 500 AS run_id, min(event_id) AS first, max(event_id) AS last, count(*) AS n, sum(credits) AS credits FROM calls GROUP BY 1"


@registered(
    f"""WITH r AS ({RUNS})
SELECT run_id, CASE WHEN run_id % 7 = 0 THEN 'running' WHEN run_id % 2 = 0 THEN 'completed' ELSE 'stopped' END AS status, 'cards' AS job_name,
 CASE WHEN run_id % 3 = 0 THEN 'ja' ELSE 'en' END AS language, '/cards' AS endpoint, cast(first as varchar) AS params, '2024-01-01' AS started_at,
 CASE WHEN run_id % 7 <> 0 THEN n END AS rows_fetched, CASE WHEN run_id % 7 <> 0 THEN n - 1 END AS rows_upserted, CAST(CASE
  WHEN run_id % 7 <> 0 THEN credits END AS BIGINT) AS api_calls_consumed,
 CAST(NULL AS BIGINT) AS daily_remaining, CASE WHEN run_id % 7 <> 0 THEN 60 END AS minute_remaining, CASE WHEN run_id % 7 <> 0
  AND run_id % 2 = 1 THEN 'budget' END AS error_message,
 CASE WHEN run_id % 7 <> 0 THEN cast(last as varchar) END AS finished_at FROM r""",
    "calls",
)
def s8_run_log(spark, d):
    """Runs opened, all but some closed, and the state of each."""
    by_run = view(spark, d, "calls").groupBy((F.col("event_id") % 500).alias("run_id"))
    sums = F.count(F.lit(1)).alias("n"), F.sum("credits").cast("long").alias("credits")
    runs = by_run.agg(F.min("event_id").alias("first"), F.max("event_id").alias("last"), *sums)
    opened = runs.selectExpr("run_id", "'cards' AS job_name", "CASE WHEN run_id % 3 = 0 THEN 'ja' ELSE 'en' END AS language", "'/cards' AS endpoint", "cast(first as string) AS params", "'2024-01-01' AS started_at")
    closed = runs.where("run_id % 7 <> 0").selectExpr(
        "run_id", "CASE WHEN run_id % 2 = 0 THEN 'completed' ELSE 'stopped' END AS status", "n AS rows_fetched", "n - 1 AS rows_upserted", "credits AS api_calls_consumed",
        "cast(null as bigint) AS daily_remaining", "60 AS minute_remaining", "CASE WHEN run_id % 2 = 1 THEN 'budget' END AS error_message", "cast(last as string) AS finished_at",
    )
    return progress.run_states(progress.open_runs(opened).unionByName(progress.close_runs(closed), allowMissingColumns=True))


# ---------------------------------------------------------------- mapping

QUANTIZED = "list_transform(embedding, lambda x: CAST(least(greatest(round_even((CAST(x AS DOUBLE)+1.0)*127.5, 0), 0), 255) AS INTEGER))"


@registered(f"SELECT vec_id, label, array_to_string({QUANTIZED}, ',') AS quantized FROM embeddings")
def p8_compact_projection(spark, d):
    return mapping.compact_projection(read(spark, d, "embeddings"), ["vec_id", "label"]).withColumn("quantized", F.array_join(F.col("quantized").cast("array<string>"), ","))


# ---------------------------------------------------------------- filters

INCOMING = "SELECT id, set_id, name, number, rarity, image_url, product_id, price + 1 AS price, 1 AS seq FROM cards WHERE id%4=0 UNION ALL SELECT id, set_id, name, number, rarity, image_url, product_id, price + 2, 2 FROM cards WHERE id%20=0"


def _base(spark, d):
    return view(spark, d, "cards").where("id % 10 <> 0")


def _incoming(spark, d):
    cards = view(spark, d, "cards")
    first = cards.where("id % 4 = 0").withColumn("price", F.col("price") + 1).withColumn("seq", F.lit(1))
    return first.unionByName(cards.where("id % 20 = 0").withColumn("price", F.col("price") + 2).withColumn("seq", F.lit(2)))


@registered(f"""WITH inc AS ({INCOMING}), base AS (SELECT * FROM cards WHERE id%10<>0)
SELECT inc.id, seq, CASE WHEN base.id IS NOT NULL THEN 'skipped' WHEN coalesce(inc.image_url,'')='' THEN 'failed' ELSE 'accepted' END AS status FROM inc LEFT
  JOIN base ON inc.id=base.id""", "cards")
def f1_classify_incoming(spark, d):
    return merging.classify_incoming(_incoming(spark, d), _base(spark, d)).select("id", "seq", "status")


@registered("SELECT id FROM cards WHERE image_url IS NULL", "cards")
def f2_pending(spark, d):
    return merging.pending(view(spark, d, "cards"), "image_url").select("id")


@registered("SELECT id, set_id FROM cards WHERE image_url IS NOT NULL AND product_id IS NULL ORDER BY id LIMIT 500", "cards")
def f3_pending_product_ids(spark, d):
    return merging.pending_product_ids(view(spark, d, "cards").withColumnRenamed("image_url", "url"), limit=500).select("id", "set_id")


@registered("SELECT id FROM cards WHERE image_url IS NOT NULL AND product_id IS NULL AND set_id = 'Brand#13'", "cards")
def f3_pending_product_ids_of_set(spark, d):
    return merging.pending_product_ids(view(spark, d, "cards").withColumnRenamed("image_url", "url"), "Brand#13").select("id")


def _numbered(spark, d):
    return view(spark, d, "sets").withColumn("language", F.expr("CASE WHEN set_no % 2 = 0 THEN 'japanese' ELSE 'english' END")).withColumn("numeric_id", F.expr("CASE WHEN set_no % 5 <> 0 THEN set_no END"))


@registered("SELECT set_id, set_no AS numeric_id FROM sets WHERE set_no % 2 = 1 AND set_no % 5 <> 0", "sets")
def f4_numbered_sets(spark, d):
    return merging.numbered_sets(_numbered(spark, d), "english").select("set_id", "numeric_id")


@registered("SELECT set_id, set_no AS numeric_id FROM sets WHERE set_no = 12", "sets")
def f4_one_set(spark, d):
    return merging.numbered_sets(_numbered(spark, d), "japanese", 12).select("set_id", "numeric_id")


@registered(
    """SELECT cond, count(*) AS n
FROM price_history WHERE lower(cond) LIKE '%near mint%' OR lower(cond) LIKE '%nm%' OR lower(cond) LIKE '%unplayed%' GROUP BY cond""",
    "price_history",
)
def f5_near_mint(spark, d):
    return view(spark, d, "price_history").where(S.near_mint(F.col("cond"))).groupBy("cond").agg(F.count(F.lit(1)).alias("n"))


@registered(f"""WITH inc AS ({INCOMING}), c AS (SELECT id, count(*) AS n FROM inc GROUP BY id)
SELECT inc.id, seq, concat_ws(',', CASE WHEN coalesce(image_url,'')='' THEN 'not-null:image_url' END, CASE
  WHEN set_id NOT IN ('Brand#11','Brand#12') THEN 'enum:set_id' END, CASE WHEN n>1 THEN 'duplicate' END) AS reasons FROM inc JOIN c ON inc.id=c.id""", "cards")
def f6_constraints(spark, d):
    checked = merging.check_constraints(_incoming(spark, d), ["image_url"], {"set_id": ["Brand#11", "Brand#12"]}, ["id"])
    return checked.select("id", "seq", F.concat_ws(",", "reasons").alias("reasons"))


KEY_STATES = "SELECT key_id, CASE key_id%3 WHEN 0 THEN 'active' WHEN 1 THEN 'rate_limited' ELSE 'disabled' END AS status, CASE WHEN key_id%2=0 THEN date '2024-01-01' ELSE date '2024-01-02' END AS state_day, key_id%40 AS remaining FROM (SELECT DISTINCT key_id FROM calls) k WHERE key_id%5<>0"


def _key_states(spark, d):
    return view(spark, d, "calls").select("key_id").distinct().where("key_id % 5 <> 0").selectExpr("key_id", "CASE key_id%3 WHEN 0 THEN 'active' WHEN 1 THEN 'rate_limited' ELSE 'disabled' END AS status", "CASE WHEN key_id%2=0 THEN date '2024-01-01' ELSE date '2024-01-02' END AS state_day", "key_id%40 AS remaining")


@registered(f"""WITH st AS ({KEY_STATES}), k AS (SELECT DISTINCT key_id FROM calls)
SELECT k.key_id, CASE WHEN state_day <> date '2024-01-02' THEN NULL ELSE remaining END AS remaining FROM k LEFT JOIN st ON k.key_id=st.key_id
  WHERE status IS NULL OR (status<>'disabled' AND (state_day<>date '2024-01-02' OR status='active'))""", "calls")
def f7_usable_keys(spark, d):
    keys = view(spark, d, "calls").select("key_id").distinct()
    return merging.usable_keys(keys, _key_states(spark, d), F.lit("2024-01-02").cast("date"))


# ---------------------------------------------------------------- joins, merges, updates


@registered("SELECT set_id, name FROM sets WHERE set_id NOT IN (SELECT set_id FROM cards WHERE set_id NOT LIKE '%3')", "sets", "cards")
def j1_sets_to_scrape(spark, d):
    return merging.sets_to_scrape(view(spark, d, "sets"), view(spark, d, "cards").where("set_id NOT LIKE '%3'")).select("set_id", "name")


@registered(f"WITH inc AS ({INCOMING}) SELECT DISTINCT id FROM inc WHERE id%10=0", "cards")
def j2_new_ids(spark, d):
    return merging.new_ids(_incoming(spark, d), _base(spark, d)).select("id").distinct()


#: The price refresh in SQL: last bucket, near mint, first priced result of a variant, best price.
REFRESH = """WITH lb AS (SELECT product_id, line_no, variant, cond, arg_max({'m': market, 'l': low}, {'d': bucket_date, 'o': ord, 'm': market, 'l': low}) AS b
  FROM price_history GROUP BY 1,2,3,4),
k AS (SELECT product_id, line_no, line_no*64 + list_position(['1st Edition Holofoil','Foil','Non-Holo','Normal','Reverse Holofoil','Unlimited'], variant)*8 + list_position(['Lightly Played','Near Mint','Unopened NM','Unplayed'], cond) AS pos, b.m AS market, b.l AS low, CASE variant WHEN 'Reverse Holofoil' THEN 'reverseholofoil' WHEN 'Foil' THEN 'foil' WHEN 'Normal' THEN 'normal' WHEN 'Unlimited' THEN 'normal' WHEN '1st Edition Holofoil' THEN '1steditionholofoil' ELSE 'holofoil' END AS variant_key FROM lb WHERE cond <> 'Lightly Played' AND b.m > 0),
f AS (SELECT product_id, variant_key, line_no AS result_pos, pos, market, CASE WHEN low > 0 THEN low END AS low FROM (SELECT *, row_number()
  OVER (PARTITION BY product_id, variant_key ORDER BY pos) AS r FROM k) WHERE r = 1),
best AS (SELECT product_id, coalesce(max(CASE WHEN variant_key='holofoil' THEN market END), max(CASE WHEN variant_key='normal' THEN market END), max(CASE
  WHEN variant_key='reverseholofoil' THEN market END), max(CASE WHEN variant_key='1steditionholofoil' THEN market END), arg_min(market, pos), 0.0) AS best_price,
  string_agg(variant_key, ',' ORDER BY pos) AS variants FROM f GROUP BY product_id)"""


#: A result is a line number, variant and condition; a product's results get places in this order.
PLACES = ("1st Edition Holofoil", "Foil", "Non-Holo", "Normal", "Reverse Holofoil", "Unlimited")
CONDITIONS = ("Lightly Played", "Near Mint", "Unopened NM", "Unplayed")


def _history(spark, d):
    """Places of results, and of buckets: of equal dates the later order, then the higher price, then the higher low price is later."""
    place = lambda column, values: F.array_position(F.array(*map(F.lit, values)), F.col(column))
    result = F.col("line_no") * 64 + place("variant", PLACES) * 8 + place("cond", CONDITIONS)
    bucket = F.struct("ord", "market", "low")
    return view(spark, d, "price_history").withColumn("result_pos", result).withColumn("bucket_pos", bucket)


SHOWN_MAP = "string_agg(variant_key || '=' || cast(cast(round(market*100) as bigint) as varchar) || '/' || coalesce(cast(cast(round(low*100) as bigint) as varchar), '-'), ',' ORDER BY pos)"


@registered(REFRESH + f""", maps AS (SELECT product_id, {SHOWN_MAP} AS prices FROM f GROUP BY product_id)
SELECT c.id, c.product_id, coalesce(b.best_price, c.price) AS price, m.prices, CASE WHEN b.product_id IS NOT NULL THEN '2024-06-01 00:00:00' END AS scraped_at
FROM cards c LEFT JOIN best b ON c.product_id=b.product_id LEFT JOIN maps m ON c.product_id=m.product_id""", "price_history", "cards")
def price_refresh(spark, d):
    """J3 over W1, W2, A8 and M2: the whole price refresh, with the price map and its time."""
    rows = merging.fan_out_prices(view(spark, d, "cards"), prices.current_prices(_history(spark, d)), F.lit("2024-06-01").cast("timestamp"))
    cents = lambda c: F.round(c * 100).cast("long").cast("string")
    shown = F.transform(F.map_entries("prices"), lambda e: F.concat(e["key"], F.lit("="), cents(e["value"]["market"]), F.lit("/"), F.coalesce(cents(e["value"]["low"]), F.lit("-"))))
    return rows.select("id", "product_id", "price", F.array_join(shown, ",").alias("prices"), F.col("scraped_at").cast("string").alias("scraped_at"))


@registered(REFRESH + " SELECT product_id, variants, best_price FROM best", "price_history")
def a8_price_maps(spark, d):
    return prices.current_prices(_history(spark, d)).select("product_id", F.array_join(F.map_keys("prices"), ",").alias("variants"), "best_price")


@registered(
    """SELECT product_id, line_no, variant, cond, max(bucket_date) AS bucket_date, arg_max(market, {'d': bucket_date, 'o': ord, 'm': market, 'l': low}) AS market
FROM price_history GROUP BY 1,2,3,4""",
    "price_history",
)
def w1_latest_bucket(spark, d):
    return prices.latest_buckets(_history(spark, d)).select("product_id", F.floor(F.col("result_pos") / 64).cast("int").alias("line_no"), "variant", "cond", "bucket_date", "market")


@registered(REFRESH + " SELECT product_id, variant_key, result_pos, market, low FROM f", "price_history")
def w2_first_priced_variant(spark, d):
    return prices.first_priced_variant(prices.latest_buckets(_history(spark, d))).withColumn("result_pos", F.floor(F.col("result_pos") / 64).cast("int"))


@registered("""WITH r AS (SELECT p_name AS name, min(p_partkey) AS right_id FROM part WHERE p_size > 30 GROUP BY p_name), l AS (SELECT set_no AS left_id, CASE set_no%3
  WHEN 0 THEN lower(name) WHEN 1 THEN concat(substr(lower(name), 5, 4), ':', substr(lower(name), 9)) ELSE substr(lower(name), 5, 3) END AS a FROM sets)
SELECT left_id, arg_min(right_id, right_id) AS right_id FROM l
  JOIN r ON contains(lower(r.name), a) OR contains(a, lower(r.name)) OR contains(lower(r.name), replace(a, ':', '')) GROUP BY left_id""", "sets")
def j5_match_names(spark, d):
    right = read(spark, d, "part").where("p_size > 30").groupBy(F.col("p_name").alias("name")).agg(F.min("p_partkey").alias("right_id")).withColumn("position", F.col("right_id"))
    name = F.expr("CASE set_no%3 WHEN 0 THEN name WHEN 1 THEN concat(substr(name, 5, 4), ':', substr(name, 9)) ELSE substr(name, 5, 3) END")
    return merging.match_names(view(spark, d, "sets").select(F.col("set_no").alias("left_id"), name.alias("name")), right)


BACKLOG = "WITH b AS (SELECT s.*, coalesce(n, 0) AS existing, (card_count > 0 AND coalesce(n,0) >= card_count) OR set_no IN (15, 22) AS done FROM sets s LEFT JOIN (SELECT set_id, count(*) AS n FROM cards WHERE id%3<>0 OR set_id LIKE '%4' GROUP BY set_id) c ON s.set_id=c.set_id)"


def _backlog(spark, d):
    return merging.backlog(view(spark, d, "sets"), view(spark, d, "cards").where("id%3<>0 OR set_id LIKE '%4'"), [15, 22])


@registered(BACKLOG + " SELECT set_id, existing, done, greatest(card_count - existing, 0) AS remaining FROM b", "sets", "cards")
def j6_backlog(spark, d):
    return _backlog(spark, d).select("set_id", "existing", "done", "remaining")


@registered("SELECT id, CASE WHEN id%4=0 THEN id+7 ELSE product_id END AS product_id FROM cards", "cards")
def j7_patch_columns(spark, d):
    patches = view(spark, d, "cards").where("id % 4 = 0").select("id", (F.col("id") + 7).alias("product_id"))
    return merging.patch_columns(view(spark, d, "cards"), patches, "id").select("id", "product_id")


LAST = f"last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS r FROM ({INCOMING})) WHERE r = 1)"


@registered(
    f"""WITH {LAST}, base AS (SELECT *
FROM cards WHERE id%10<>0) SELECT coalesce(base.id, last.id) AS id, base.name,
 CASE WHEN last.id IS NOT NULL THEN last.price ELSE base.price END AS price
FROM base
FULL JOIN last ON base.id=last.id""",
    "cards",
)
def u1_merge_upsert(spark, d):
    last = merging.keep_last(_incoming(spark, d), ["id"], "seq").select("id", "price")
    return merging.merge_upsert(_base(spark, d), last, ["id"]).select("id", "name", "price")


@registered("SELECT id, name, CASE WHEN id%10<>0 THEN price ELSE price+1 END AS price FROM cards WHERE id%10<>0 OR id%4=0", "cards")
def u2_insert_ignore(spark, d):
    return merging.insert_ignore(_base(spark, d), _incoming(spark, d), ["id"], "seq").select("id", "name", "price")


@registered(f"WITH {LAST} SELECT id, NULL AS rarity, price FROM last UNION ALL SELECT id, rarity, price FROM cards WHERE id%10<>0 AND id%4<>0", "cards")
def u3_replace_rows(spark, d):
    last = merging.keep_last(_incoming(spark, d), ["id"], "seq").drop("seq", "rarity")
    return merging.replace_rows(_base(spark, d), last, ["id"]).select("id", "rarity", "price")


@registered(
    f"""WITH st AS ({KEY_STATES}) SELECT key_id, CASE WHEN remaining>0 AND status='rate_limited' THEN 'active' ELSE status END AS status
FROM st""",
    "calls",
)
def u4_conditional_update(spark, d):
    states = _key_states(spark, d)
    return merging.conditional_update(states, (F.coalesce("remaining", F.lit(0)) > 0) & (F.col("status") == "rate_limited"), {"status": F.lit("active")}).select("key_id", "status")


@registered("SELECT id, CASE WHEN id%6=0 THEN NULL WHEN id%4=0 THEN 'new' ELSE name END AS name, rarity FROM cards", "cards")
def u5_sparse_patch(spark, d):
    patches = view(spark, d, "cards").where("id%6=0 OR id%4=0").select("id", F.create_map(F.lit("name"), F.when(F.col("id") % 6 != 0, "new")).alias("patch"))
    return merging.sparse_patch(view(spark, d, "cards"), patches, "id", ["name", "rarity"]).select("id", "name", "rarity")


# ---------------------------------------------------------------- aggregations


@registered("SELECT set_id, count(*) AS n FROM cards GROUP BY set_id", "cards")
def a1_counts(spark, d):
    return progress.count_by(view(spark, d, "cards"), "set_id")


@registered("SELECT DISTINCT product_id FROM cards WHERE product_id IS NOT NULL", "cards")
def a2_distinct_products(spark, d):
    return progress.distinct_products(view(spark, d, "cards"))


@registered("SELECT DISTINCT set_id FROM cards WHERE set_id IS NOT NULL AND set_id <> ''", "cards")
def a3_sets_with_cards(spark, d):
    return merging.sets_with_cards(view(spark, d, "cards"))


@registered(
    """SELECT count(*) AS n_rows, count(embedding) AS n_vectors, avg(len(embedding))::DOUBLE AS avg_bytes, count(vec_id)-count(DISTINCT vec_id) AS repeated_ids,
 count(*) FILTER (label IS NULL) AS null_names
FROM embeddings"""
)
def a4_validate_package(spark, d):
    packed = S.pack_bytes(S.quantize(F.col("embedding"))).alias("tflite_emb_q")
    return publishing.validate_package(read(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").cast("string").alias("name"), packed))


@registered(f"""WITH inc AS ({INCOMING}) SELECT count(*) FILTER (coalesce(image_url,'')<>'' AND id%10=0) AS created, count(*) FILTER (coalesce(image_url,'')<>''
  AND id%10<>0) AS updated, CAST(0 AS BIGINT) AS skipped, count(*) FILTER (coalesce(image_url,'')='') AS failed, true AS changed FROM inc""", "cards")
def a5_run_summary(spark, d):
    return progress.run_summary(merging.classify_incoming(_incoming(spark, d), _base(spark, d), force=True), _base(spark, d))


@registered(
    """SELECT key_id, cast(ts as date) AS day, CAST(sum(CASE WHEN credits=0 THEN 5 ELSE credits END) AS BIGINT) AS credits, count(*) AS calls
FROM calls GROUP BY 1,2""",
    "calls",
)
def a6_credits_per_day(spark, d):
    calls = view(spark, d, "calls").withColumn("credits", progress.call_credits(F.col("credits"), F.lit(None).cast("int"), F.lit(5)))
    return progress.credits_per_day(calls)


@registered(
    """SELECT label, i AS pos, CAST(round(avg(CAST(embedding[i] AS DOUBLE))*1000) AS BIGINT) AS mean_milli
FROM embeddings, generate_series(1, 64) s(i) GROUP BY label, i"""
)
def a7_mean_vectors(spark, d):
    means = progress.mean_vectors(read(spark, d, "embeddings"), "label", "embedding")
    return means.select("label", F.posexplode("mean").alias("p", "m")).select("label", (F.col("p") + 1).cast("long").alias("pos"), F.round(F.col("m") * 1000).cast("long").alias("mean_milli"))


@registered("SELECT string_agg(cast(n as varchar), ',' ORDER BY n) AS completed FROM (SELECT DISTINCT set_no AS n FROM sets WHERE set_no%2=0)", "sets")
def a9_completed_sets(spark, d):
    ids = view(spark, d, "sets").select(F.when(F.col("set_no") % 2 == 0, F.col("set_no").cast("string")).otherwise(F.col("name")).alias("set_id"))
    return progress.completed_sets(ids).select(F.array_join(F.col("completed").cast("array<string>"), ",").alias("completed"))


@registered("SELECT l_suppkey, quantile_cont(l_quantity, 0.02) AS low, quantile_cont(l_quantity, 0.98) AS high FROM lineitem GROUP BY l_suppkey")
def a10_percentile_bounds(spark, d):
    return progress.percentile_bounds(read(spark, d, "lineitem"), "l_suppkey", "l_quantity")


@registered(
    BACKLOG
    + """ SELECT count(*) FILTER (done) AS sets_done,
 count(*) FILTER (NOT done) AS sets_open,
 CAST(sum(CASE WHEN done THEN existing WHEN existing > 0 AND (card_count <= 0 OR existing < card_count) THEN existing ELSE 0 END) AS BIGINT) AS rows_skipped, bool_and(done) AS complete
FROM b""",
    "sets", "cards",
)
def a12_coverage(spark, d):
    return progress.coverage(_backlog(spark, d))


# ---------------------------------------------------------------- windows, order, pages, sets


@registered(f"WITH {LAST} SELECT id, price, seq FROM last", "cards")
def w3_keep_last(spark, d):
    return merging.keep_last(_incoming(spark, d), ["id"], "seq").select("id", "price", "seq")


PAGES = BACKLOG + """, p AS (SELECT set_id, card_count, least(existing, 40) AS start_offset FROM b WHERE NOT done),
pages AS (SELECT set_id, start_offset + 50*i AS page_start, i+1 AS page_no, CASE
  WHEN card_count<=0 THEN 50 ELSE least(50, card_count - (start_offset + 50*i)) END AS page_size
 FROM p, generate_series(0, 2000) s(i) WHERE CASE WHEN card_count<=0 THEN i=0 ELSE start_offset + 50*i < card_count END)"""


def _pages(spark, d):
    return progress.plan_pages(_backlog(spark, d).where("NOT done").withColumn("start_offset", F.least("existing", F.lit(40))), 50)


@registered(PAGES + " SELECT set_id, page_start, page_no, page_size FROM pages", "sets", "cards")
def o4_page_plan(spark, d):
    return _pages(spark, d).select("set_id", "page_start", "page_no", "page_size")


RUN = PAGES + ", run AS (SELECT pages.*, CAST(coalesce(sum(page_size) OVER (ORDER BY release_year NULLS LAST, name, pages.set_id, page_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before FROM pages JOIN sets ON pages.set_id = sets.set_id)"


def _run(spark, d):
    """The pages of all sets in the order of a run, with what those before cost."""
    pages = _pages(spark, d)
    return progress.running_cost(pages, "page_size", "set_id", [F.col("release_year"), F.col("name")], [F.col("page_no")])


@registered(RUN + " SELECT set_id, page_no, 30 + before + page_size AS used FROM run WHERE 30 + before + page_size <= 700", "sets", "cards")
def w4_within_budget(spark, d):
    """A budget over a whole run, which ends within a later set; 30 credits are used before."""
    return progress.within_budget(_run(spark, d), "page_size", F.lit(700), F.lit(30)).select("set_id", "page_no", "used")


@registered(RUN + " SELECT set_id, page_no, before + page_size AS used FROM run WHERE before = 0 OR 500 - before > 100", "sets", "cards")
def w4_reserve(spark, d):
    """A run that stops once no more than the reserve remains."""
    return progress.within_budget(_run(spark, d), "page_size", F.lit(10**9), remaining=F.lit(500), reserve=100).select("set_id", "page_no", "used")


@registered(
    RUN
    + """ SELECT count(*) AS asked,
 count(*) FILTER (before + page_size <= 700) AS made,
 CASE WHEN bool_and(before + page_size <= 700) THEN 'completed' ELSE 'stopped' END AS status
FROM run""",
    "sets", "cards",
)
def w4_run_status(spark, d):
    run = _run(spark, d)
    return progress.run_status(run, progress.within_budget(run, "page_size", F.lit(700)))


@registered(RUN + " SELECT set_id, page_no, CAST(greatest(0, least(page_size, 700 - before)) AS BIGINT) AS granted FROM run", "sets", "cards")
def w5_granted(spark, d):
    return progress.granted(_run(spark, d), "page_size", F.lit(700)).select("set_id", "page_no", "granted")


@registered("""WITH i AS (SELECT *, sum(CASE WHEN outcome='ok' THEN 1 ELSE 0 END) OVER (PARTITION BY key_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS g
  FROM calls),
s AS (SELECT *, sum(CASE WHEN outcome='network' THEN 1 ELSE 0 END) OVER (PARTITION BY key_id, g ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS streak FROM i)
SELECT event_id, key_id, CAST(streak AS BIGINT) AS streak, streak >= 3 AS abort FROM s""", "calls")
def w6_failure_streaks(spark, d):
    return progress.failure_streaks(view(spark, d, "calls"), 3).select("event_id", "key_id", "streak", "abort")


@registered("SELECT key_id, arg_max(outcome, {'t': ts, 'e': event_id}) AS outcome, max(ts) AS ts FROM calls GROUP BY key_id", "calls")
def w7_latest_state(spark, d):
    return progress.latest_state(view(spark, d, "calls").select("key_id", "ts", "event_id", "outcome"), ["key_id"], "ts", "event_id").select("key_id", "outcome", "ts")


@registered("SELECT set_id, release_year FROM sets ORDER BY release_year ASC NULLS LAST, name, set_id LIMIT 10000", "sets")
def o1_release_order(spark, d):
    return progress.in_release_order(view(spark, d, "sets")).select("set_id", "release_year")


@registered(
    """SELECT DISTINCT product_id
FROM (SELECT product_id
FROM cards WHERE product_id IS NOT NULL ORDER BY image_url ASC NULLS FIRST, id LIMIT 30000)""",
    "cards",
)
def o2_stalest_products(spark, d):
    return progress.stalest_products(view(spark, d, "cards"), "image_url")


@registered("SELECT id FROM cards ORDER BY id LIMIT 100", "cards")
def o3_first_by_id(spark, d):
    return view(spark, d, "cards").select("id").orderBy("id").limit(100)


@registered(
    """SELECT id, c.set_id, CAST(row_number() OVER (PARTITION BY c.set_id ORDER BY CAST(number AS INT), number, id) AS INTEGER) AS place
FROM cards c JOIN sets s ON c.set_id=s.set_id""",
    "sets", "cards",
)
def o5_catalog_order(spark, d):
    return progress.catalog_order(view(spark, d, "cards"), view(spark, d, "sets")).select("id", "set_id", "place")


@registered("SELECT id, name, NULL AS english_name, rarity FROM cards WHERE id%2=0 UNION ALL SELECT id, name, 'x', NULL FROM cards WHERE id%2=1", "cards")
def x1_union_catalogs(spark, d):
    cards = view(spark, d, "cards")
    return cards.where("id%2=0").select("id", "name", "rarity").unionByName(cards.where("id%2=1").select("id", "name", F.lit("x").alias("english_name")), allowMissingColumns=True)


@registered("SELECT id FROM cards EXCEPT SELECT id FROM cards WHERE id%10<>0", "cards")
def x2_id_difference(spark, d):
    return view(spark, d, "cards").select("id").subtract(_base(spark, d).select("id"))


@registered(
    """SELECT set_id,
 CASE WHEN set_no < 15 THEN concat(cast(set_no as varchar), ',15,22') WHEN set_no IN (15,22) THEN '15,22'
  WHEN set_no < 22 THEN concat('15,', cast(set_no as varchar), ',22') ELSE concat('15,22,', cast(set_no as varchar)) END AS completed
FROM sets""",
    "sets",
)
def x3_add_to_set(spark, d):
    return view(spark, d, "sets").select("set_id", F.array_join(progress.add_to_set(F.array(F.lit(15), F.lit(22)), F.col("set_no")).cast("array<string>"), ",").alias("completed"))


# ---------------------------------------------------------------- scalar functions


@registered(
    """SELECT variant,
 CASE variant WHEN 'Reverse Holofoil' THEN 'reverseholofoil' WHEN 'Foil' THEN 'foil' WHEN 'Normal' THEN 'normal' WHEN 'Unlimited' THEN 'normal'
  WHEN '1st Edition Holofoil' THEN '1steditionholofoil' ELSE 'holofoil' END AS variant_key, count(*) AS n
FROM price_history GROUP BY 1,2""",
    "price_history",
)
def m3_normalize_variant(spark, d):
    return view(spark, d, "price_history").groupBy("variant", S.normalize_variant(F.col("variant")).alias("variant_key")).agg(F.count(F.lit(1)).alias("n"))


@registered("SELECT p_partkey, CASE WHEN p_partkey%4=3 OR p_partkey=0 THEN NULL ELSE p_partkey END AS product_id FROM part")
def m4_product_id(spark, d):
    url = F.expr("case p_partkey%4 when 0 then concat('https://x/product/', p_partkey, '/') when 1 then concat('https://x/a+b?productId=', p_partkey) when 2 then concat('https://r/?u=https%3A%2F%2Fx%2Fproduct%2F', p_partkey) else concat('https://x/%zz/', p_partkey) end")
    return read(spark, d, "part").select("p_partkey", S.extract_product_id(url).alias("product_id"))


@registered("SELECT id, CASE WHEN id%3=0 THEN number WHEN id%5=0 THEN concat(number,'/9') ELSE concat(number,'/180') END AS shown FROM cards", "cards")
def m5_display_number(spark, d):
    number = F.expr("case when id%5=0 and id%3<>0 then concat(number,'/9') else number end")
    return view(spark, d, "cards").select("id", S.display_number(number, F.expr("case when id%3<>0 then 180 end")).alias("shown"))


@registered(
    """SELECT page_id, CASE WHEN length(e)=0 OR length(e)>4 THEN 'png' ELSE e END AS extension
FROM (SELECT page_id, split_part(list_last(string_split(url, '.')), '?', 1) AS e
FROM pages)"""
)
def m7_asset_names(spark, d):
    return read(spark, d, "pages").select("page_id", S.asset_extension(F.col("url")).alias("extension"))


@registered(
    """SELECT p_partkey,
 CASE WHEN p_partkey%3=0 THEN CAST(p_size AS INTEGER) END AS strict,
 CASE WHEN p_partkey%3<2 THEN CAST(p_size AS INTEGER) END AS lenient
FROM part"""
)
def m8_to_int(spark, d):
    text = F.expr("case p_partkey%3 when 0 then concat(' ', p_size, ' ') when 1 then concat(p_size, '.7hp') else concat('x', p_size) end")
    return read(spark, d, "part").select("p_partkey", S.to_int_strict(text).alias("strict"), S.to_int_lenient(text).alias("lenient"))


@registered("SELECT p_partkey, CASE WHEN p_partkey%2=0 THEN concat('a|', cast(p_size as varchar)) END AS listed FROM part")
def m9_text_array(spark, d):
    json = F.expr("""case when p_partkey%2=0 then concat('["a",', p_size, ']') else '"a"' end""")
    return read(spark, d, "part").select("p_partkey", F.array_join(S.text_array(json), "|").alias("listed"))


@registered(
    BACKLOG
    + """ SELECT set_id,
 CAST(CASE WHEN set_no%3=0 THEN 7 ELSE 0 END AS BIGINT) AS by_checkpoint,
 CAST(CASE WHEN set_no%3=0 AND set_no%2=0 THEN greatest(existing, 7) ELSE existing END AS BIGINT) AS by_existing
FROM b""",
    "sets", "cards",
)
def m11_start_offset(spark, d):
    at, today = F.expr("case when set_no%3=0 then 7 end"), F.expr("set_no%2=0")
    offsets = [S.start_offset(policy, F.col("existing"), at, today).alias(f"by_{policy}") for policy in ("checkpoint", "existing")]
    return _backlog(spark, d).select("set_id", *offsets)


@registered(
    """SELECT event_id, CASE WHEN event_id%4=1 THEN 'disabled' WHEN event_id%3=0 THEN 'rate_limited' ELSE 'failed' END AS class
FROM events WHERE event_type='error'"""
)
def m12_classify_failure(spark, d):
    errors = read(spark, d, "events").where("event_type = 'error'")
    return errors.select("event_id", S.classify_failure(F.expr("case when event_id%3=0 then 429 else 500 end"), F.expr("case when event_id%4=1 then 'Bad API Key' end")).alias("class"))


@registered(
    f"""WITH st AS ({KEY_STATES}) SELECT key_id,
 CASE WHEN remaining <= 10 THEN 'rate_limited' ELSE 'active' END AS status, greatest(remaining-10, 0) AS may_spend
FROM st""",
    "calls",
)
def m13_key_state(spark, d):
    return _key_states(spark, d).select("key_id", S.key_status_after_call(F.col("remaining"), 10).alias("status"), S.grantable(F.col("remaining"), 10).alias("may_spend"))


STALE = "status='rate_limited' AND state_day<>date '2024-01-02'"


@registered(f"""WITH st AS ({KEY_STATES}), k AS (SELECT DISTINCT key_id FROM calls)
SELECT k.key_id, CASE WHEN st.key_id IS NULL OR ({STALE}) THEN 'active' ELSE status END AS status, date '2024-01-02' AS state_day, CAST(CASE
  WHEN st.key_id IS NULL OR ({STALE}) THEN 0 ELSE remaining*2 END AS BIGINT) AS credits_used,
 CASE WHEN NOT ({STALE}) THEN remaining END AS remaining, CASE WHEN NOT ({STALE}) THEN 'then' END AS rate_limited_at, CASE
  WHEN NOT ({STALE}) THEN 'error' END AS last_error FROM k LEFT JOIN st ON k.key_id = st.key_id""", "calls")
def m14_rollover_keys(spark, d):
    states = _key_states(spark, d).selectExpr("*", "cast(remaining*2 as bigint) AS credits_used", "'then' AS rate_limited_at", "'error' AS last_error")
    return merging.rollover_keys(view(spark, d, "calls").select("key_id").distinct(), states, F.lit("2024-01-02").cast("date"))


@registered("""SELECT p_partkey, replace(p_name, '  ', ' ') AS name, CASE
  WHEN p_partkey%2=0 THEN 'https://x/a' ELSE concat('https://base/', p_brand) END AS url, p_partkey%3=0 AS is_link
FROM (SELECT p_partkey, p_brand, replace(p_name, ' ', '  ') AS p_name FROM part)""")
def m15_normalize_link(spark, d):
    parts = read(spark, d, "part").withColumn("text", F.concat(F.lit("\n\t "), F.replace("p_name", F.lit(" "), F.lit("  ")), F.lit(" \r\n")))
    src = F.expr("CASE WHEN p_partkey%2=0 THEN 'https://x/a' ELSE concat('/', p_brand) END")
    href = F.expr("CASE p_partkey%3 WHEN 0 THEN '/card/x' WHEN 1 THEN 'https://x/card/x' ELSE '/sets/x' END")
    return parts.select("p_partkey", S.normalize_link(F.col("text")).alias("name"), S.absolute_url(src, "https://base").alias("url"), S.is_item_link(href).alias("is_link"))


@registered(
    """SELECT vec_id,
 CAST(round(sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE)*CAST(x AS DOUBLE))))*1000) AS BIGINT) AS norm_milli,
 CAST(round(100 * embedding[1] / sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE)*CAST(x AS DOUBLE))))) AS BIGINT) AS first_percent
FROM embeddings"""
)
def m16_l2_normalize(spark, d):
    square = lambda v: F.aggregate(v, F.lit(0.0).cast("double"), lambda s, x: s + x.cast("double") * x.cast("double"))
    norm = F.round(F.sqrt(square(F.col("embedding"))) * 1000).cast("long")
    first = F.round(F.element_at(S.l2_normalize(F.col("embedding")), 1) * 100).cast("long")
    return read(spark, d, "embeddings").select("vec_id", norm.alias("norm_milli"), first.alias("first_percent"))


@registered(f"SELECT vec_id, list_sum({QUANTIZED})::BIGINT AS total FROM embeddings")
def m17_quantize(spark, d):
    return read(spark, d, "embeddings").select("vec_id", F.aggregate(S.quantize(F.col("embedding")), F.lit(0).cast("long"), lambda s, x: s + x).alias("total"))


@registered("""WITH b AS (SELECT label, quantile_cont(CAST(x AS DOUBLE), 0.02) AS low, quantile_cont(CAST(x AS DOUBLE), 0.98) AS high
  FROM (SELECT label, unnest(embedding) AS x FROM embeddings) GROUP BY label)
SELECT vec_id, CAST(list_sum(list_transform(embedding, lambda x: floor(least(greatest((CAST(x AS DOUBLE)-low)*255.0/(high-low), 0.0), 255.0)))) AS BIGINT) AS total
  FROM embeddings e JOIN b ON e.label=b.label""")
def m18_contrast_stretch(spark, d):
    vectors = read(spark, d, "embeddings")
    bounds = progress.percentile_bounds(vectors.select("label", F.explode("embedding").alias("x")).withColumn("x", F.col("x").cast("double")), "label", "x")
    stretched = S.contrast_stretch(F.col("embedding"), F.col("low"), F.col("high"))
    total = F.aggregate(stretched, F.lit(0.0).cast("double"), lambda s, x: s + x).cast("long")
    return vectors.join(bounds, "label").select("vec_id", total.alias("total"))


@registered("""SELECT vec_id, variant, CAST(list_sum(list_transform(embedding, lambda x: floor(least(abs((CAST(x AS DOUBLE)*255.0)*a+b), 255.0)))) AS BIGINT) AS total
  FROM embeddings, (VALUES ('original',1.0::DOUBLE,0.0::DOUBLE),('brighter',1.0,30.0),('darker',1.0,-30.0),('contrast',1.2,0.0)) v(variant,a,b)""")
def m19_photometric_variants(spark, d):
    pixels = F.transform("embedding", lambda x: x.cast("double") * 255.0)
    variants = read(spark, d, "embeddings").select("vec_id", F.explode(S.photometric_variants(pixels)).alias("v"))
    return variants.select("vec_id", "v.variant", F.aggregate("v.vector", F.lit(0.0).cast("double"), lambda s, x: s + F.floor(x)).cast("long").alias("total"))


@registered(
    """SELECT p_partkey AS id
FROM part WHERE list_contains(string_split_regex(lower(p_name), '[^a-z0-9]+'), split_part((SELECT lower(min(p_name))
FROM part), ' ', 1))"""
)
def m20_search_tokens(spark, d):
    """Parts whose names have the first word of the first name; the word is found in the same run."""
    parts = read(spark, d, "part")
    word = parts.agg(F.split(F.lower(F.min("p_name")), " ")[0].alias("token"))
    return progress.search_tokens(progress.token_index(parts, "p_partkey", "p_name"), word)


@registered(
    """SELECT token, count(*) AS n
FROM (SELECT DISTINCT p_partkey, unnest(string_split_regex(lower(p_name), '[^a-z0-9]+')) AS token
FROM part) WHERE token <> '' GROUP BY token"""
)
def m20_token_index(spark, d):
    return progress.token_index(read(spark, d, "part"), "p_partkey", "p_name").groupBy("token").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- blobs and pages


@registered(f"SELECT vec_id, list_sum({QUANTIZED})::BIGINT AS total FROM embeddings")
def v1_blob_codec(spark, d):
    """To a float32 blob, back, and to one byte each; the bytes' sum equals that of m17."""
    blob = read(spark, d, "embeddings").select("vec_id", blobs.encode_blob("embedding").alias("b")).select("vec_id", blobs.pack_quantized(blobs.decode_blob(64)("b")).alias("q"))
    value = lambda k: F.conv(F.hex(F.substring("q", k, F.lit(1))), 16, 10).cast("long")
    total = F.aggregate(F.sequence(F.lit(1), F.length("q")), F.lit(0).cast("long"), lambda s, k: s + value(k))
    return blob.select("vec_id", total.alias("total"))


#: Anchors of pages, whose hrefs and texts are plain: some get an image, some pages a second anchor without a text.
IMAGED = "regexp_replace(html, '<a href=\"([^\"]*)\">', '<a href=\"{0}\"><img alt=x src=\"{0}.png\"></a><a href=\"/card{0}\"><img src=\"/last{0}.png\"> '{1})"
ANCHORS = """anchors AS (SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) AS INTEGER) AS pos, href, text, img FROM (
 SELECT page_id, i, regexp_extract(a, '^<a href="([^"]*)"', 1) AS href, regexp_replace(a, '<[^>]*>', '', 'g') AS text, regexp_extract(a, 'src="([^"]*)"', 1) AS img
 FROM (SELECT page_id, generate_subscripts(l, 1) AS i, unnest(l) AS a FROM (SELECT page_id, regexp_extract_all({0}, '<a href="[^"]*">.*?</a>', 0, 's') AS l
  FROM pages))))"""


@registered("WITH " + ANCHORS.format("html") + " SELECT page_id, pos, href, text, img FROM anchors")
def v3_anchors(spark, d):
    return html_links.extract_anchors(read(spark, d, "pages"))


@registered("WITH " + ANCHORS.format(IMAGED.format("\\1", ", 'g'")) + """,
 links AS (SELECT page_id, pos, href, replace(trim(text), '  ', ' ') AS text, CASE WHEN img LIKE 'http%' OR img = '' THEN img ELSE 'https://base' || img END AS img
  FROM anchors WHERE contains(href, '/card/') AND NOT starts_with(href, 'http'))
SELECT page_id, href, arg_min(text, pos) FILTER (text <> '') AS name, arg_max(img, pos) FILTER (img <> '') AS image FROM links GROUP BY page_id, href HAVING
  count(*) FILTER (text <> '') > 0 AND count(*) FILTER (img <> '') > 0""")
def a11_links_by_href(spark, d):
    """M15 and A11 over V3: of each item link of a page its first text and last image."""
    pages = read(spark, d, "pages").select("page_id", F.expr(IMAGED.format("$1", "")).alias("html"))
    links = html_links.extract_anchors(pages).where(S.is_item_link(F.col("href")))
    image = F.when(F.col("img") != "", S.absolute_url(F.col("img"), "https://base"))
    links = links.select("page_id", "pos", "href", S.normalize_link(F.col("text")).alias("text"), image.alias("img"))
    return progress.links_by_href(links, "page_id").select("page_id", "href", "name", "image")
