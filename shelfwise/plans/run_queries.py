"""Registered queries of jobs that write: each writes to a new folder that the executors share and returns what is read back."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import embedding, merging, progress, search
from ..sources import landing, publishing
from ..streaming import streams
from .registry import read, registered, scratch
from .views import view

# ---------------------------------------------------------------- packages


def _package(spark, d):
    cards = view(spark, d, "cards")
    columns = {c: F.lit(None).cast("string") for c in publishing.COMPACT_COLUMNS} | {
        "id": F.col("id").cast("string"), "name": F.col("name"), "set_name": F.concat(F.lit("set "), "set_id"), "card_number": F.col("number"), "set_id": F.col("set_id"), "image_url": F.col("image_url"),
        "rarity": F.col("rarity"), "updated_at": F.lit("2024-06-01"), "tflite_emb_q": F.unhex(F.lpad(F.hex("id"), 16, "0")),
    }
    return cards.select(*(v.alias(k) for k, v in columns.items()))


NAMES, NUMBERS = ("small ring", "blue bolt"), (("Brand#13", "7"), ("Brand#13", "119"), ("Brand#4", "2"))


@registered(
    """SELECT cast(id as varchar) AS id, name, set_id, number AS card_number, name IN ('small ring', 'blue bolt') AS by_name
FROM cards WHERE name IN ('small ring', 'blue bolt') OR (set_id = 'Brand#13' AND number IN ('7', '119')) OR (set_id = 'Brand#4' AND number = '2')""",
    "cards",
)
def s6_lookup(spark, d):
    """A package is written, and looked up by name and by set and number."""
    path = scratch(spark, "package")
    publishing.write_compact(_package(spark, d), path, 16)
    package = spark.read.parquet(path)
    found = publishing.lookup(package, NAMES).select("id", F.lit(True).alias("by_name")).unionByName(publishing.lookup(package, numbers=NUMBERS).select("id", F.lit(False).alias("by_name")))
    return package.join(found.groupBy("id").agg(F.max("by_name").alias("by_name")), "id").select("id", "name", "set_id", "card_number", "by_name")


@registered("SELECT cast(id as varchar) AS id, name, '2024-06-01' AS generated_at, 'parts' AS source FROM cards WHERE id % 3 <> 0", "cards")
def s9_published(spark, d):
    """Of three packages the first is published, the second has repeated ids and isn't, the third changes nothing and isn't."""
    path, package = scratch(spark, "published"), _package(spark, d)
    manifest = {"generated_at": "2024-06-01", "source": "parts", "schema_version": "1"}
    publishing.publish(package.where("cast(id as int) % 3 <> 0"), path, manifest=manifest)
    try:
        publishing.publish(package.unionByName(package), path)
    except ValueError:
        pass
    else:
        raise AssertionError("a package with repeated ids was published")
    publishing.publish_if_changed(spark.range(1).select(F.lit(False).alias("changed")), package, path)
    says = publishing.published(spark, path, "manifest").groupBy().pivot("key", ["generated_at", "source"]).agg(F.first("value"))
    return publishing.published(spark, path).select("id", "name").crossJoin(F.broadcast(says))  # one row of two values


@registered(
    """SELECT 'generated_at' AS key, '2024-06-02' AS value UNION ALL SELECT 'source', 'parts' UNION ALL SELECT 'rows', cast(count(*) as varchar) FROM cards""",
    "cards",
)
def s7_manifest(spark, d):
    """A manifest of two versions, in which the second replaces and adds keys."""
    path = scratch(spark, "manifest")
    publishing.write_manifest(spark, path, {"generated_at": "2024-06-01", "source": "parts"}, 1)
    rows = view(spark, d, "cards").count()
    return publishing.write_manifest(spark, path, {"generated_at": "2024-06-02", "rows": str(rows)}, 2)


# ---------------------------------------------------------------- a run's log

INCOMING = "SELECT id, image_url, 1 AS seq FROM cards WHERE id%4=0 UNION ALL SELECT id, image_url, 2 FROM cards WHERE id%20=0"


@registered(
    f"""WITH inc AS ({INCOMING}), s AS (SELECT count(*) AS n, count(*) FILTER (id % 10 <> 0 AND id % 3 <> 1) AS skipped, count(*) FILTER (NOT (id % 10 <> 0
  AND id % 3 <> 1) AND coalesce(image_url, '') <> '') AS accepted FROM inc)
SELECT 1 AS run_id, 'cards' AS job_name, 'completed' AS status, n AS rows_fetched, accepted AS rows_upserted, '2024-06-01' AS finished_at, accepted AS rows_written
  FROM s""",
    "cards",
)
def s8_observed_run(spark, d):
    """A run is opened, written and closed with the counters that were taken while it wrote."""
    cards = view(spark, d, "cards")
    first = cards.where("id % 4 = 0").withColumn("seq", F.lit(1))
    incoming = first.unionByName(cards.where("id % 20 = 0").withColumn("seq", F.lit(2)))
    existing, path = cards.where("id % 10 <> 0 AND id % 3 <> 1"), scratch(spark, "run")
    opened = progress.open_runs(spark.range(1).selectExpr("1 AS run_id", "'cards' AS job_name", "'en' AS language", "'/cards' AS endpoint", "'{}' AS params", "'2024-05-31' AS started_at"))
    publishing.append_run_event(opened, f"{path}/log")
    counters = progress.write_observed(merging.classify_incoming(incoming, existing), existing, f"{path}/rows")
    publishing.append_run_event(progress.close_observed(spark, 1, counters, "2024-06-01"), f"{path}/log")
    states = progress.run_states(spark.read.option("mergeSchema", "true").parquet(f"{path}/log"))
    written = spark.read.parquet(f"{path}/rows").agg(F.count(F.lit(1)).alias("rows_written"))
    return states.select("run_id", "job_name", "status", "rows_fetched", "rows_upserted", "finished_at").crossJoin(F.broadcast(written))  # one row


# ---------------------------------------------------------------- assets and vectors


def _landed_assets(spark, d) -> str:
    """A file for each supplier, in a folder named after it."""
    path = scratch(spark, "assets")
    rows = read(spark, d, "supplier").select("s_suppkey", F.repeat("s_name", (F.col("s_suppkey") % 7 + 1).cast("int")).alias("value"))
    rows.repartition(4, "s_suppkey").write.partitionBy("s_suppkey").text(path)
    return path


@registered("SELECT cast(s_suppkey as varchar) AS item_id, CAST(length(s_name) * (s_suppkey % 7 + 1) + 1 AS BIGINT) AS length, md5(repeat(s_name, CAST(s_suppkey % 7 + 1 AS INT)) || chr(10)) AS content FROM supplier WHERE s_nationkey < 10")
def s4_pending_assets(spark, d):
    """The bytes of pending items alone, found by path."""
    path = _landed_assets(spark, d)
    pending = read(spark, d, "supplier").where("s_nationkey < 10").select(F.col("s_suppkey").alias("item_id"))
    listed = landing.pending_assets(spark, pending, path)
    return landing.all_contents(spark, listed).select("item_id", F.length("content").cast("long").alias("length"), F.md5("content").alias("content"))


def _byte_kinds():
    """A plain model: how many small letters, capital letters, digits and blanks a content has, and how many bytes."""
    kind = np.full(256, 4)
    kind[97:123], kind[65:91], kind[48:58], kind[32] = 0, 1, 2, 3
    return lambda contents: np.stack([[*np.bincount(kind[np.frombuffer(c, np.uint8)], minlength=5)[:4], len(c)] for c in contents]).astype(float)


@registered(
    r"""WITH c AS (SELECT page_id, [length(regexp_replace(html, '[^a-z]', '', 'g')), length(regexp_replace(html, '[^A-Z]', '', 'g')), length(regexp_replace(html, '[^0-9]', '', 'g')), length(regexp_replace(html, '[^ ]', '', 'g')), octet_length(encode(html))] AS v FROM pages WHERE html IS NOT NULL)
SELECT page_id, list_transform(v, lambda x: CAST(round_even(100 * x / sqrt(list_sum(list_transform(v, lambda y: y * y::DOUBLE))), 0) AS INTEGER))::VARCHAR AS vector
  FROM c"""
)
def v2_embed(spark, d):
    """Vectors of pages' bytes from a model that each worker loads once."""
    assets = read(spark, d, "pages").where("html IS NOT NULL").select(F.col("page_id").alias("item_id"), F.col("html").cast("binary").alias("content"))
    found = embedding.embed_assets(assets, _byte_kinds, batch_bytes=1 << 20, model="byte kinds").where("ok")
    hundredths = F.transform("vector", lambda x: F.bround(x.cast("double") * 100).cast("int").cast("string"))
    return found.select(F.col("item_id").cast("long").alias("page_id"), F.concat(F.lit("["), F.array_join(hundredths, ", "), F.lit("]")).alias("vector"))


# ---------------------------------------------------------------- a stored index


@registered("SELECT p_partkey AS id, 2 AS words FROM part WHERE list_contains(string_split_regex(lower(p_name), '[^a-z0-9]+'), 'blue') AND list_contains(string_split_regex(lower(p_name), '[^a-z0-9]+'), 'bolt') UNION ALL SELECT p_partkey, 1 FROM part WHERE list_contains(string_split_regex(lower(p_name), '[^a-z0-9]+'), 'ring')")
def m20_stored_index(spark, d):
    """The token index of all names is written, and searched for two words and for one."""
    path = scratch(spark, "index")
    search.write_index(read(spark, d, "part"), "p_partkey", "p_name", path, span=256)
    pairs = search.search_index(spark, path, ["Blue", "bolt"]).select("id", F.lit(2).alias("words"))
    return pairs.unionByName(search.search_index(spark, path, ["ring"]).select("id", F.lit(1).alias("words")))


# ---------------------------------------------------------------- streams


def _stream(spark: SparkSession, d: str, name: str = "events") -> DataFrame:
    """A table as a stream of the files it has now; the pattern matches a file and a folder alike."""
    path = f"{d}/{name}.parque[t]"
    return spark.readStream.schema(read(spark, d, name).schema).parquet(path)


def _batches(spark: SparkSession, d: str) -> DataFrame:
    """Events as a stream of three batches, one after the other: those whose ids leave 0, 1 and 2 when divided by three."""
    path, events = scratch(spark, "landed"), read(spark, d, "events")
    for k in range(3):
        events.where(F.col("event_id") % 3 == k).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(path)


@registered("SELECT event_id, user_id, event_type FROM events")
def t1_ingest(spark, d):
    """Two runs over what has landed: each row once."""
    path = scratch(spark, "ingest")
    for _ in range(2):
        streams.ingest_landed(spark, f"{d}/events.parque[t]", read(spark, d, "events").schema, f"{path}/table", f"{path}/checkpoint", "parquet")
    return spark.read.parquet(f"{path}/table").select("event_id", "user_id", "event_type")


@registered("SELECT user_id, arg_max(event_id, {'b': event_id % 3, 'e': event_id}) AS event_id, arg_max(event_type, {'b': event_id % 3, 'e': event_id}) AS event_type FROM events GROUP BY user_id")
def t2_stream_upsert(spark, d):
    """Three batches are merged into a table in buckets: the last row of each key."""
    path = scratch(spark, "upserts")
    streams.stream_upsert(_batches(spark, d).select("user_id", "event_id", "event_type"), f"{path}/table", f"{path}/checkpoint", ["user_id"], "event_id", buckets=8)
    return streams.merged(spark, f"{path}/table")


@registered("SELECT user_id, arg_min(event_id, {'b': event_id % 3, 'e': event_id}) AS event_id, arg_min(event_type, {'b': event_id % 3, 'e': event_id}) AS event_type FROM events GROUP BY user_id")
def t3_stream_insert_ignore(spark, d):
    """Three batches are merged into a table in buckets: the first row of each key."""
    path = scratch(spark, "inserts")
    streams.stream_insert_ignore(_batches(spark, d).select("user_id", "event_id", "event_type"), f"{path}/table", f"{path}/checkpoint", ["user_id"], "event_id", buckets=8)
    return streams.merged(spark, f"{path}/table")


def _calls(spark, d):
    return view(spark, d, "calls", _stream(spark, d))


#: Each partition of a stream's state is a store of its own, which takes its time to start: these tables have few keys.
STATE_PARTITIONS = 16


def _drained(df: DataFrame, path: str, mode: str) -> DataFrame:
    write = lambda batch, number: batch.write.mode("overwrite").parquet(f"{path}/rows/batch={number}")
    conf, key = df.sparkSession.conf, "spark.sql.shuffle.partitions"
    before = conf.get(key)
    conf.set(key, str(min(int(before), STATE_PARTITIONS)))  # a query keeps the number with which it starts
    try:
        df.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    finally:
        conf.set(key, before)
    return df.sparkSession.read.schema(df.schema).parquet(f"{path}/rows").drop("batch")


@registered("SELECT key_id, cast(ts as date) AS day, CAST(sum(credits) AS BIGINT) AS credits, count(*) AS calls FROM calls GROUP BY 1, 2 HAVING cast(ts as date) + INTERVAL 1 DAY <= (SELECT max(ts) FROM calls) - INTERVAL 1 HOUR", "calls")
def t4_stream_credits(spark, d):
    """Credits of each key and day, of the days that the watermark has passed."""
    return _drained(streams.stream_credits(_calls(spark, d)), scratch(spark, "credits"), "append")


@registered("""WITH i AS (SELECT *, sum(CASE WHEN outcome='ok' THEN 1 ELSE 0 END) OVER (PARTITION BY key_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS g
  FROM calls),
s AS (SELECT *, sum(CASE WHEN outcome='network' THEN 1 ELSE 0 END) OVER (PARTITION BY key_id, g ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS streak FROM i)
SELECT key_id, CAST(arg_max(streak, {'t': ts, 'e': event_id}) AS INTEGER) AS streak, bool_or(streak = 3 AND outcome = 'network') AS abort FROM s
  GROUP BY key_id""", "calls")
def t5_stream_streaks(spark, d):
    """Each key's streak, from state in the RocksDB store."""
    return _drained(streams.stream_streaks(_calls(spark, d), 3, ttl="3650 days"), scratch(spark, "streaks"), "update")


# ---------------------------------------------------------------- names of assets


@registered("""SELECT page_id, concat(cast(page_id as varchar), '.', e) AS path, concat('https://store.example/storage/v1/object/public/logos/', cast(page_id as varchar), '.', e) AS public_url
FROM (SELECT page_id, CASE WHEN length(x)=0 OR length(x)>4 THEN 'png' ELSE x END AS e FROM (SELECT page_id, split_part(list_last(string_split(url, '.')), '?', 1) AS x
  FROM pages))""")
def m7_public_urls(spark, d):
    path = S.asset_path(F.col("url"), F.col("page_id").cast("string"))
    return read(spark, d, "pages").select("page_id", path.alias("path"), S.public_url("https://store.example", "logos", path).alias("public_url"))
