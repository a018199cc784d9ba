"""Streams: each landed row once, merges whose work follows the batch, late calls, state that ends."""

import json
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import merging, progress
from shelfwise.plans.views import view
from shelfwise.sources.pointers import read_pointer
from shelfwise.streaming import streams

SCHEMA = "id int, price double, seq int"


def land(spark, rows, path, schema=SCHEMA):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(path)


def drain(df, name, tmp_path, mode):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).option("checkpointLocation", str(tmp_path / f"checkpoint-{name}")).start()
    q.awaitTermination()
    return df.sparkSession.table(name)


def test_ingest_takes_each_row_once(spark, tmp_path):
    landed, target, state = (str(tmp_path / n) for n in ("in", "out", "cp"))
    land(spark, [(1, 1.0, 1), (1, 2.0, 2), (2, 3.0, 1)], landed)
    for _ in range(2):
        streams.ingest_landed(spark, landed, SCHEMA, target, state)
    assert spark.read.parquet(target).count() == 3
    land(spark, [(9, 1.0, 1)], landed)
    streams.ingest_landed(spark, landed, SCHEMA, target, state)
    assert spark.read.parquet(target).count() == 4


def test_merges(spark, tmp_path):
    landed, up, first = (str(tmp_path / n) for n in ("in", "up", "first"))
    land(spark, [(1, 1.0, 1), (1, 2.0, 2), (2, 3.0, 1)], landed)
    rows = spark.readStream.schema(SCHEMA).json(landed)
    both = lambda: [sorted((r["id"], r["price"]) for r in streams.merged(spark, path).collect()) for path in (up, first)]

    def run():
        streams.stream_upsert(rows, up, str(tmp_path / "c1"), ["id"], "seq", buckets=4)
        streams.stream_insert_ignore(rows, first, str(tmp_path / "c2"), ["id"], "seq", buckets=4)

    for _ in range(2):
        run()
        assert both() == [[(1, 2.0), (2, 3.0)], [(1, 1.0), (2, 3.0)]]
    land(spark, [(2, 9.0, 0), (3, 7.0, 5)], landed)
    run()
    assert both() == [[(1, 2.0), (2, 9.0), (3, 7.0)], [(1, 1.0), (2, 3.0), (3, 7.0)]]
    with pytest.raises(Exception, match="buckets"):
        land(spark, [(4, 1.0, 1)], landed)
        streams.stream_upsert(rows, up, str(tmp_path / "c1"), ["id"], "seq", buckets=8)


def test_columns_that_a_batch_lacks_stay(spark, tmp_path):
    wide, narrow, up = (str(tmp_path / n) for n in ("wide", "narrow", "up"))
    land(spark, [(1, 1.0, 1), (2, 3.0, 1)], wide)
    streams.stream_upsert(spark.readStream.schema(SCHEMA).json(wide).withColumn("note", F.lit("kept")), up, str(tmp_path / "c"), ["id"], "seq", buckets=2)
    land(spark, [(2, 8.0, 2)], narrow)
    streams.stream_upsert(spark.readStream.schema(SCHEMA).json(narrow), up, str(tmp_path / "c3"), ["id"], "seq", buckets=2)
    assert sorted((r["id"], r["price"], r["note"]) for r in streams.merged(spark, up).collect()) == [(1, 1.0, "kept"), (2, 8.0, "kept")]


def test_only_touched_buckets_are_read_and_written(spark, tmp_path):
    landed, up, cp = (str(tmp_path / n) for n in ("in", "up", "c"))
    land(spark, [(k, float(k), 1) for k in range(4000)], landed)
    rows = spark.readStream.schema(SCHEMA).json(landed)
    streams.stream_upsert(rows, up, cp, ["id"], "seq", buckets=32)
    before = read_pointer(spark, up)["current"]
    assert len(before) == 32
    size = lambda folder: sum(f.stat().st_size for f in Path(up, folder).glob("*.parquet"))
    whole = sum(map(size, before.values()))
    land(spark, [(7, 70.0, 2), (8, 80.0, 2), (90001, 1.0, 1)], landed)
    streams.stream_upsert(rows, up, cp, ["id"], "seq", buckets=32)
    after = read_pointer(spark, up)["current"]
    changed = [b for b in after if after[b] != before[b]]
    assert 1 <= len(changed) <= 3 and sum(size(after[b]) for b in changed) < whole / 5
    assert {p.name for p in Path(up).glob("*/merge_batch=1/merge_bucket=*")} == {f"merge_bucket={b}" for b in changed}
    got = {r["id"]: r["price"] for r in streams.merged(spark, up).collect()}
    assert got == {k: float(k) for k in range(4000)} | {7: 70.0, 8: 80.0, 90001: 1.0}
    # the state before stays for its readers, the one before that goes with the third batch
    land(spark, [(7, 71.0, 3)], landed)
    streams.stream_upsert(rows, up, cp, ["id"], "seq", buckets=32)
    mine = next(b for b in changed if "merge_batch=2" in read_pointer(spark, up)["current"][b])
    assert not Path(up, before[mine]).exists() and Path(up, after[mine]).exists()


def test_a_batch_that_was_lost_before_the_swap_is_repeated(spark, tmp_path, monkeypatch):
    landed, up, cp = (str(tmp_path / n) for n in ("in", "up", "c"))
    land(spark, [(1, 1.0, 1), (2, 2.0, 1)], landed)
    rows = spark.readStream.schema(SCHEMA).json(landed)
    streams.stream_upsert(rows, up, cp, ["id"], "seq", buckets=2)
    land(spark, [(1, 5.0, 2), (3, 3.0, 1)], landed)

    def lost(*a):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(streams, "swap_pointer", lost)
        with pytest.raises(Exception, match="lost"):
            streams.stream_upsert(rows, up, cp, ["id"], "seq", buckets=2)
    assert sorted((r["id"], r["price"]) for r in streams.merged(spark, up).collect()) == [(1, 1.0), (2, 2.0)]
    streams.stream_upsert(rows, up, cp, ["id"], "seq", buckets=2)
    assert sorted((r["id"], r["price"]) for r in streams.merged(spark, up).collect()) == [(1, 5.0), (2, 2.0), (3, 3.0)]


def test_first_within_watermark(spark, tmp_path):
    path = str(tmp_path / "in")
    land(spark, [(1, "2024-01-01 00:00:00"), (1, "2024-01-01 01:00:00"), (2, "2024-01-01 02:00:00")], path, "id int, ts string")
    rows = streams.first_within_watermark(spark.readStream.schema("id int, ts string").json(path), ["id"])
    assert sorted(r["id"] for r in drain(rows, "firsts", tmp_path, "append").collect()) == [1, 2]


def calls_stream(spark, tmp_path, *files):
    path = str(tmp_path / "calls")
    for k, rows in enumerate(files):
        Path(path).mkdir(exist_ok=True)
        Path(path, f"{k}.json").write_text("\n".join(json.dumps(dict(zip(("event_id", "key_id", "ts", "credits", "outcome"), r))) for r in rows))
        os.utime(Path(path, f"{k}.json"), (1_700_000_000 + 10 * k,) * 2)  # files are taken by their times
    return spark.readStream.schema("event_id long, key_id long, ts string, credits int, outcome string").option("maxFilesPerTrigger", 1).option("latestFirst", "false").json(path)


def test_late_calls_are_dropped(spark, tmp_path):
    """A call of a day that the watermark has passed no longer counts."""
    stream = calls_stream(
        spark, tmp_path, [(1, 1, "2024-01-01 10:00:00", 5, "ok")], [(2, 1, "2024-01-03 10:00:00", 7, "ok")], [(4, 1, "2024-01-03 09:30:00", 2, "ok")], [(3, 1, "2024-01-01 23:00:00", 100, "ok")], [(5, 1, "2024-01-09 00:00:00", 1, "ok")]
    )
    got = {str(r["day"]): (r["credits"], r["calls"]) for r in drain(streams.stream_credits(stream), "late", tmp_path, "append").collect()}
    assert got == {"2024-01-01": (5, 1), "2024-01-03": (9, 2)}


def test_streaks_cross_once_and_state_ends(spark, tmp_path):
    net = lambda n, key, at: [(100 * key + i, key, f"{at}:{i:02d}", 1, "network") for i in range(n)]
    stream = calls_stream(
        spark, tmp_path, net(2, 1, "2024-01-01 00:00") + net(1, 2, "2024-01-01 00:00"), net(2, 1, "2024-01-01 01:00"), net(1, 1, "2024-01-01 02:00"),
        [(900, 3, "2024-01-09 00:00:00", 1, "ok")], [(901, 3, "2024-01-09 00:00:01", 1, "ok")], net(1, 1, "2024-01-09 02:00"),
    )
    rows = drain(streams.stream_streaks(stream, 3), "streaks", tmp_path, "update").collect()
    of = lambda key: [(r["streak"], r["abort"]) for r in rows if r["key_id"] == key]
    assert of(1) == [(2, False), (4, True), (5, False), (1, False)]  # crossed once; after a day of silence the streak is forgotten
    assert of(2) == [(1, False)] and of(3) == [(0, False), (0, False)]
    state = spark.read.format("statestore").option("stateVarName", "streak").load(str(tmp_path / "checkpoint-streaks"))
    assert {r["key"]["key_id"] for r in state.collect()} == {1, 3}  # key 2 is no longer kept


def test_stream_twins(spark, tmp_path, sf_dir):
    """Credits and streaks as streams over several batches equal their batch twins."""
    calls = view(spark, sf_dir, "calls").withColumn("ts", F.col("ts").cast("string"))
    path = str(tmp_path / "calls")
    calls.repartitionByRange(4, "ts").write.parquet(path)
    files = sorted(Path(path).glob("part-*"))
    for k, f in enumerate(files):
        os.utime(f, (1_700_000_000 + 10 * k,) * 2)
    stream = spark.readStream.schema(calls.schema).option("maxFilesPerTrigger", 1).parquet(path)
    got, seen = {}, 0
    for r in drain(streams.stream_streaks(stream, 3, ttl="3650 days"), "twin", tmp_path, "update").collect():
        got[r["key_id"]] = r["streak"]
        seen += 1
    last = merging.keep_last(progress.failure_streaks(calls, 3).select("key_id", F.struct("ts", "event_id").alias("at"), "streak"), ["key_id"], "at")
    want = {r["key_id"]: r["streak"] for r in last.collect()}
    assert got == want and seen > len(want)
    batch = {(r["key_id"], r["day"]): r["credits"] for r in progress.credits_per_day(calls).collect()}
    got = {(r["key_id"], r["day"]): r["credits"] for r in drain(streams.stream_credits(stream), "credits", tmp_path, "append").collect()}
    assert got and all(batch[k] == v for k, v in got.items())
