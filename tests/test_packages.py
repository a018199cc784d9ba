"""Packages: layout, publication in two phases, manifests; the stored index; assets and embedding."""

import re
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from shelfwise.operators import embedding, merging, progress, search
from shelfwise.sources import landing, publishing
from shelfwise.sources.pointers import read_pointer


def package(spark, n, sets=40, names=500):
    row = {c: F.lit("x") for c in publishing.COMPACT_COLUMNS}
    row |= {
        "id": F.col("id").cast("string"), "name": F.format_string("name %04d", F.col("id") * 7919 % names), "set_id": F.format_string("set %02d", F.col("id") * 104729 % sets),
        "card_number": F.format_string("%03d", F.floor(F.col("id") / sets).cast("long")), "tflite_emb_q": F.lit(b"\x01\x02"),
    }
    return spark.range(n).select(*(v.alias(c) for c, v in row.items()))


def row_groups(path):
    for f in sorted(Path(path).glob("*.parquet")):
        meta = pq.ParquetFile(f).metadata
        at = {meta.schema.column(k).name: k for k in range(meta.num_columns)}
        for g in range(meta.num_row_groups):
            stats = {c: meta.row_group(g).column(at[c]).statistics for c in ("name", "set_id", "card_number")}
            yield {c: (s.min, s.max) for c, s in stats.items()}


def test_both_lookups_touch_few_row_groups(spark, tmp_path):
    publishing.write_compact(package(spark, 20_000), str(tmp_path / "p"), 64)
    groups = list(row_groups(tmp_path / "p"))
    assert 48 <= len(groups) <= 80
    met = lambda c, v: sum(g[c][0] <= v <= g[c][1] for g in groups)
    names = [met("name", f"name {k:04d}") for k in range(0, 500, 9)]
    sets = [met("set_id", f"set {k:02d}") for k in range(40)]
    assert max(names) <= 20 and max(sets) <= 20 and np.mean(names) <= 12 and np.mean(sets) <= 16
    rows = spark.read.parquet(str(tmp_path / "p"))
    assert rows.count() == 20_000
    assert publishing.lookup(rows, ["name 0007", "name 0100"]).count() == 80
    assert [r["id"] for r in publishing.lookup(rows, numbers=[("set 03", "001")]).collect()] == [r["id"] for r in rows.where("set_id = 'set 03' AND card_number = '001'").collect()] != []
    assert publishing.lookup(rows).count() == 0
    plan = publishing.lookup(rows, ["name 0007"])._jdf.queryExecution().toString()
    assert "PushedFilters" in plan and "EqualTo(name,name 0007)" in plan.replace("In(name, [name 0007])", "EqualTo(name,name 0007)")


def test_compact_keeps_the_last_row_of_an_id(spark, tmp_path):
    some = package(spark, 20)
    twice = some.withColumn("updated_at", F.lit("w")).unionByName(some.withColumn("updated_at", F.lit("y")).withColumn("name", F.lit(None).cast("string")))
    publishing.write_compact(twice, str(tmp_path / "c"), 3)
    rows = spark.read.parquet(str(tmp_path / "c")).collect()
    assert len(rows) == 20 and {(r["updated_at"], r["name"]) for r in rows} == {("y", None)}
    publishing.write_compact(some.where("false"), str(tmp_path / "empty"))
    assert spark.read.parquet(str(tmp_path / "empty")).count() == 0


def test_publication_in_two_phases(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "p")
    with pytest.raises(FileNotFoundError):
        publishing.published(spark, path)
    publishing.publish(package(spark, 10), path, manifest={"schema_version": "1"})
    assert publishing.published(spark, path).count() == 10
    version = publishing.stage(package(spark, 20), path)  # a reader between the phases
    assert publishing.published(spark, path).count() == 10
    reader = publishing.published(spark, path)
    publishing.release(spark, path, version)
    assert publishing.published(spark, path).count() == 20 and reader.count() == 10  # it goes on with the version that it has begun
    for bad, why in ((package(spark, 5).unionByName(package(spark, 5)), "repeated ids"), (package(spark, 5).withColumn("name", F.lit(None).cast("string")), "missing names"), (package(spark, 0), "no rows")):
        with pytest.raises(ValueError, match=why):
            publishing.publish(bad, path)
        assert publishing.published(spark, path).count() == 20
    with pytest.raises(ValueError, match="another length"):
        publishing.publish(package(spark, 5), path, lambda df: publishing.package_faults(df, vector_bytes=3))

    def lost(*a):
        raise RuntimeError("lost")

    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(publishing, "swap_pointer", lost)
        publishing.publish(package(spark, 30), path)
    assert publishing.published(spark, path).count() == 20
    publishing.roll_back(spark, path)
    assert publishing.published(spark, path).count() == 10 and dict(map(tuple, publishing.published(spark, path, "manifest").collect())) == {"schema_version": "1"}
    publishing.publish(package(spark, 40), path)
    publishing.publish(package(spark, 50), path)
    now = read_pointer(spark, path)
    assert publishing.published(spark, path).count() == 50 and Path(path, now["previous"]).exists()


def test_publish_only_if_changed(spark, tmp_path):
    quiet, loud = (spark.createDataFrame([(c,)], "changed boolean") for c in (False, True))
    path = str(tmp_path / "p")
    assert not publishing.publish_if_changed(quiet, package(spark, 5), path) and not Path(path).exists()
    assert publishing.publish_if_changed(loud, package(spark, 5), path) and publishing.published(spark, path).count() == 5


def test_observed_counters_equal_the_summary(spark, tmp_path):
    cards = spark.range(100).select("id", F.when(F.col("id") % 7 > 0, "u").alias("image_url"))
    existing = cards.where("id % 3 = 0")
    for force in (False, True):
        classified = merging.classify_incoming(cards.where("id % 2 = 0"), existing, force)
        counters = progress.write_observed(classified, existing, str(tmp_path / "rows"))
        want = progress.run_summary(classified, existing).first().asDict()
        assert {k: counters[k] for k in ("created", "updated", "skipped", "failed")} == {k: want[k] for k in ("created", "updated", "skipped", "failed")} and counters["fetched"] == 50
        assert spark.read.parquet(str(tmp_path / "rows")).count() == want["created"] + want["updated"]
    event = progress.close_observed(spark, 7, counters, "t1", stopped=True, error_message="budget").first()
    assert (event["run_id"], event["status"], event["rows_fetched"], event["error_message"], event["daily_remaining"]) == (7, "stopped", 50, "budget", None)


def test_index_of_hot_and_rare_tokens(spark, tmp_path):
    rows = [(k, f"all {'even' if k % 2 == 0 else 'odd'} n{k % 100} All") for k in range(3000)] + [(5_000_000_000, "all far"), (None, "all lost"), (-5, "all below"), (4000, None), (4001, "")]
    df = spark.createDataFrame(rows, "id long, text string")
    search.write_index(df, "id", "text", str(tmp_path / "i"), span=128, partitions=4)
    stored = spark.read.parquet(str(tmp_path / "i"))
    hot = stored.where("token = 'all'").agg(F.count("*").alias("blocks"), F.max("n").alias("most"), F.sum("n").alias("n")).first()
    assert (hot["blocks"], hot["most"], hot["n"]) == (26, 128, 3002)
    find = lambda *words: sorted(r["id"] for r in search.search_index(spark, str(tmp_path / "i"), words).collect())
    assert find("ALL", "even", "n4") == list(range(4, 3000, 100)) and find("odd", "n4") == [] and find("far", "all") == [5_000_000_000]
    assert find("all") == sorted(r[0] for r in rows if r[0] is not None and r[1] and "all" in r[1]) and find("nowhere", "all") == [] and find() == []
    plan = search.search_index(spark, str(tmp_path / "i"), ["even", "n4"])._jdf.queryExecution().toString()
    assert "In(token, [even,n4])" in plan


def write_assets(path, contents):
    path.mkdir(exist_ok=True)
    for name, content in contents.items():
        (path / f"{name}.bin").write_bytes(content)


def test_errors_are_rows_and_batches_are_cut_by_bytes(spark, tmp_path):
    def histogram():
        def embed(contents):
            if any(c == b"\xff" for c in contents):
                raise ValueError("not an image")
            return np.stack([np.bincount(np.frombuffer(c, np.uint8) % 4, minlength=4)[:4] for c in contents]).astype(float)

        return embed

    write_assets(tmp_path / "a", {"a": b"\x01\x02\x02", "b": b"\xff", "c": b"", "d": b"\x03" * 5000})
    assets = landing.read_assets(spark, str(tmp_path / "a"), "*.bin")
    rows = {r["item_id"]: r for r in embedding.embed_assets(assets, histogram, batch_bytes=100).collect()}
    assert rows["a"]["ok"] and abs(sum(x * x for x in rows["a"]["vector"]) - 1) < 1e-6 and rows["d"]["vector"] == [0, 0, 0, 1] and "c" not in rows  # the reader leaves empty files out
    assert not rows["b"]["ok"] and "not an image" in rows["b"]["error"]
    batch = assets.coalesce(1).toArrow().combine_chunks().to_batches()[0]
    assert [max(1, sum(len(c) for c in p["content"].to_pylist())) <= 100 or p.num_rows == 1 for p in embedding.byte_slices(batch, 100)].count(False) == 0


def test_contents_are_read_for_pending_items_alone(spark, tmp_path):
    write_assets(tmp_path / "a", {f"i{k}": bytes([k]) * (k + 1) for k in range(20)})
    pending = spark.createDataFrame([("i3",), ("i7",), ("i7",), ("gone",), (None,)], "item_id string")
    listed = landing.pending_assets(spark, pending, str(tmp_path / "a"))
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string,length:bigint>" in plan and sorted((r["item_id"], r["length"]) for r in listed.collect()) == [("i3", 4), ("i7", 8)]
    contents = landing.asset_contents(spark, listed)
    assert sorted((r["item_id"], bytes(r["content"])) for r in contents.collect()) == [("i3", b"\x03" * 4), ("i7", b"\x07" * 8)]
    assert landing.asset_contents(spark, listed.where("false")).count() == 0
    assert [r["item_id"] for r in landing.pending_assets(spark, pending, str(tmp_path / "a"), limit=1).collect()] == ["i3"]
    with pytest.raises(ValueError):
        landing.asset_contents(spark, listed, most=1)


def test_contents_of_long_lists_come_in_waves(spark, tmp_path):
    write_assets(tmp_path / "a", {f"i{k}": bytes([k]) * (k + 1) for k in range(40)})
    listed = landing.list_assets(spark, str(tmp_path / "a"))
    contents = landing.all_contents(spark, listed, wave=10)
    assert len(re.findall(r"Relation \[.*binaryFile|Relation.*binaryfile", contents._jdf.queryExecution().analyzed().toString(), re.I)) > 1
    assert sorted((r["item_id"], bytes(r["content"])) for r in contents.collect()) == sorted((f"i{k}", bytes([k]) * (k + 1)) for k in range(40))
    assert landing.all_contents(spark, listed.where("false")).count() == 0


def failing(first, last):
    """A model whose network is down for items of one of these sizes."""

    def load():
        def embed(contents):
            if any(first <= len(c) <= last for c in contents):
                raise ConnectionError("down")
            return np.ones((len(contents), 2))

        return embed

    return load


def test_network_failures_in_a_row_end_the_run(spark, tmp_path):
    write_assets(tmp_path / "a", {f"i{k:02d}": b"x" * (k + 1) for k in range(40)})
    pending = spark.range(40).select(F.format_string("i%02d", "id").alias("item_id"))
    results, run = str(tmp_path / "r"), lambda load, name, **k: embedding.embed_pending(spark, pending, str(tmp_path / "a"), str(tmp_path / "r"), load, wave=10, tasks=1, batch_bytes=1, model=name, **k)
    assert run(failing(1, 99), "none", most_failures=3) == "aborted"
    rows = embedding.embedded(spark, results).collect()
    assert 4 <= len(rows) <= 20 and not any(r["ok"] for r in rows)  # one wave alone
    assert sorted({r["error"].split(":")[0] for r in rows}) == ["NetworkError", "Skipped"] and sum(r["error"].startswith("NetworkError") for r in rows) == 3
    assert run(failing(5, 5), "some", most_failures=3) == "completed"
    rows = {r["item_id"]: r for r in embedding.embedded(spark, results).collect()}
    assert len(rows) == 40 and [k for k, r in rows.items() if not r["ok"]] == ["i04"]
    files = len(list(Path(results).glob("wave-*")))
    assert run(failing(0, 0), "last", most_failures=3) == "completed"  # what is left, and nothing else
    assert len(list(Path(results).glob("wave-*"))) == files + 1 and all(r["ok"] for r in embedding.embedded(spark, results).collect())
    assert run(failing(0, 0), "last") == "completed" and len(list(Path(results).glob("wave-*"))) == files + 1


def test_a_worker_loads_a_model_once(spark, tmp_path):
    loads = tmp_path / "loads"
    loads.mkdir()

    def load():
        import tempfile

        tempfile.mkstemp(dir=str(loads))
        return lambda contents: np.ones((len(contents), 2))

    rows = spark.range(64).select(F.col("id").alias("item_id"), F.lit(b"x").alias("content")).repartition(16)
    for _ in range(2):
        assert embedding.embed_assets(rows, load, batch_bytes=1, model="once").where("ok").count() == 64
    assert 1 <= len(list(loads.iterdir())) <= 8  # workers, not tasks (32) or batches
