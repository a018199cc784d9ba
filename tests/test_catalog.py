"""Semantic traps, properties and streams of the catalog jobs, on literal rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.functions import blobs
from shelfwise.functions import scalars as S
from shelfwise.operators import html_links, merging, prices, progress
from shelfwise.sources import landing, publishing


def values(spark, column, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_best_catalog_price(spark):
    rows = [('{"holofoil":{"market":3.5}}',), ('{"holofoil":{"market":null,"mid":2}}',), ('{"holofoil":{"market":"5","mid":2}}',), ('{"holofoil":{"market":-1,"mid":2},"normal":{"market":7}}',), ('{"holofoil":{"market":0,"mid":4}}',), ('{"holofoil":{"market":"","mid":4}}',), ("{}",), (None,)]
    assert values(spark, S.best_catalog_price(F.col("p")), rows, "p string") == [3.5, 2.0, 0.0, 7.0, 4.0, 4.0, 0.0, 0.0]


def test_normalize_variant_and_condition(spark):
    names = [("Foil",), ("Non-Holo",), ("1st Edition",), ("Unlimited",), ("Cosmos",), ("--",), (None,)]
    assert values(spark, S.normalize_variant(F.col("v")), names, "v string") == ["foil", "holofoil", "1steditionnormal", "normal", "cosmos", None, None]
    assert values(spark, S.near_mint(F.col("c")), [("Near Mint",), ("played",), ("UNPLAYED",), ("inmost",), (None,)], "c string") == [True, False, True, True, False]


def test_product_id(spark):
    urls = [("https://x/product/12/a",), ("https://r?u=https%3A%2F%2Fx%2Fproduct%2F7",), ("https://x?a=1&productId=9",), ("https://x/%zz/product/3",), ("https://x/product/0",), (None,)]
    assert values(spark, S.extract_product_id(F.col("u")), urls, "u string") == [12, 7, 9, 3, None, None]


def test_to_int(spark):
    text = [(" 12 ",), ("120abc",), ("12.7",), ("x",), (None,)]
    assert values(spark, S.to_int_strict(F.col("t")), text, "t string") == [12, None, None, None, None]
    assert values(spark, S.to_int_lenient(F.col("t")), text, "t string") == [12, 120, 12, None, None]


def test_vectors(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0]), (2, [3.0, 4.0]), (3, [-1.0, 1.0])], "id int, v array<float>")
    unit = {r[0]: r[1] for r in df.select("id", S.l2_normalize(F.col("v"))).collect()}
    assert unit[1] == [0.0, 0.0] and np.allclose(unit[2], [0.6, 0.8])
    assert {r[0]: r[1] for r in df.select("id", S.quantize(F.col("v"))).collect()}[3] == [0, 255]
    packed = df.where("id = 3").select(blobs.pack_quantized(blobs.decode_blob(2)(blobs.encode_blob("v")))).first()[0]
    assert list(packed) == [0, 255]
    assert df.select(blobs.decode_blob(3)(blobs.encode_blob("v"))).first()[0] is None
    mixed = spark.createDataFrame([(1, [1.0, 2.0, 3.0]), (2, None), (3, []), (4, [0.5])], "id int, v array<float>").coalesce(1)
    assert [r[1] for r in mixed.select("id", blobs.decode_blob(1)(blobs.encode_blob("v")).alias("v")).orderBy("id").collect()] == [[1.0], None, None, [0.5]]
    assert [r[1] for r in mixed.select("id", blobs.pack_quantized("v").alias("v")).orderBy("id").collect()] == [b"\xff\xff\xff", None, b"", b"\xbf"]
    assert [r[1] for r in mixed.select("id", S.pack_bytes(S.quantize(F.col("v"))).alias("v")).orderBy("id").collect()] == [b"\xff\xff\xff", None, b"", b"\xbf"]
    wide = spark.createDataFrame([(k % 2, [float(k)] * 1280) for k in range(6)], "id int, v array<float>")
    assert {r["id"]: (len(r["mean"]), r["mean"][7]) for r in progress.mean_vectors(wide, "id", "v").collect()} == {0: (1280, 2.0), 1: (1280, 3.0)}
    dark = df.select(F.explode(S.photometric_variants(F.array(F.lit(10.0)))).alias("v")).select("v.*").where("variant = 'darker'").first()
    assert dark["vector"] == [20.0]


def test_latest_bucket_ties_and_no_fallback(spark):
    rows = [(1, 1, "Normal", "nm", "2024-01-02", 1, 5.0, 0.0), (1, 1, "Normal", "nm", "2024-01-02", 2, 6.0, 0.0), (1, 2, "Holofoil", "nm", "2024-01-01", 1, 9.0, 1.0), (1, 2, "Holofoil", "nm", "2024-01-03", 2, 0.0, 1.0)]
    history = spark.createDataFrame(rows, "product_id long, result_pos int, variant string, cond string, d string, bucket_pos int, market double, low double").withColumn("bucket_date", F.to_date("d"))
    row = prices.current_prices(history).first()
    assert row["best_price"] == 6.0 and list(row["prices"]) == ["normal"] and row["prices"]["normal"]["low"] is None


def test_latest_bucket_of_large_and_near_places(spark):
    """A large place stays within its date; F2, F5, F6: prices less than a cent apart, and low prices of equal ones, settle a tie as the SQL does."""
    order = lambda day, ord_, market, low: (1, 1, "Normal", "nm", day, (ord_, market, low), market, low)
    kind = "product_id long, result_pos int, variant string, cond string, d string, bucket_pos struct<ord:long,market:double,low:double>, market double, low double"
    for rows, want in (
        ([order("2024-01-02", 7, 5.0, 1.0), order("2024-01-01", 1 << 40, 6.0, 1.0)], ("2024-01-02", 5.0, 1.0)),
        ([order("2024-01-02", 7, 0.57, 1.0), order("2024-01-02", 7, 0.56, 1.0), order("2024-01-02", 7, 0.565, 1.0)], ("2024-01-02", 0.57, 1.0)),
        ([order("2024-01-02", 7, 5.0, 2.0), order("2024-01-02", 7, 5.0, 3.0), order("2024-01-02", 7, 5.0, 1.0)], ("2024-01-02", 5.0, 3.0)),
    ):
        for given in (rows, rows[::-1]):
            row = prices.latest_buckets(spark.createDataFrame(given, kind).coalesce(1).withColumn("bucket_date", F.to_date("d"))).first()
            assert (str(row["bucket_date"]), row["market"], row["low"]) == want


def test_price_queries_of_large_orders_equal_their_sql(spark, tmp_path):
    """Order numbers beyond 2^19, and one order's line that stands twice with a price of 0, against DuckDB."""
    import datetime

    import duckdb

    from shelfwise.plans.catalog_queries import ORACLES, QUERIES

    line = lambda k, order, day, price, discount, tax: (4 * order, k, 1, price, discount, tax, "N", "O", datetime.datetime(2024, 1, day))
    rows = [line(1, 1, 2, 10.0, 0.1, 0.0), line(1, 600_000, 1, 20.0, 0.1, 0.0), line(2, 5, 2, 10.0, 0.0, 0.0), line(2, 5, 2, 30.0, 0.0, 0.5), line(3, 5, 2, 0.57, 0.1, 0.0), line(3, 5, 2, 0.56, 0.1, 0.0), line(4, 5, 2, 30.0, 0.1, 0.5), line(4, 5, 2, 30.0, 0.1, 0.0)]
    kind = "l_orderkey long, l_partkey long, l_linenumber int, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    spark.createDataFrame(rows, kind).coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    db = duckdb.connect()
    db.execute(f"create view lineitem as select * from '{tmp_path}/lineitem.parquet/*.parquet'")
    for name in ("a8_price_maps", "w1_latest_bucket", "w2_first_priced_variant"):
        want = db.execute(ORACLES[name])
        columns = [c[0] for c in want.description]
        assert sorted(map(tuple, QUERIES[name](spark, str(tmp_path)).select(*columns).collect())) == sorted(want.fetchall()), name


def test_search_takes_its_words_from_a_table(spark, tmp_path):
    """the searched word follows the names, and several tokens must all be there."""
    from shelfwise.plans.catalog_queries import QUERIES

    parts = spark.createDataFrame([(1, "Zinc Ring"), (2, "amber, ZINC"), (3, "Amber ring"), (4, "Cobalt AMBER-zinc ring"), (5, None)], "p_partkey long, p_name string")
    parts.write.parquet(str(tmp_path / "part.parquet"))
    ids = lambda df: sorted(r["id"] for r in df.collect())
    assert ids(QUERIES["m20_search_tokens"](spark, str(tmp_path))) == [2, 3, 4]
    index = progress.token_index(parts, "p_partkey", "p_name")
    words = lambda *w: spark.createDataFrame([(x,) for x in w], "token string")
    assert ids(progress.search_tokens(index, words("zinc", "ring", "zinc"))) == ids(progress.search_tokens(index, ["Zinc", "ring"])) == [1, 4]
    assert ids(progress.search_tokens(index, words("zinc", None))) == ids(progress.search_tokens(index, words())) == ids(progress.search_tokens(index, words("tin"))) == []


def test_upserts_are_idempotent(spark):
    base = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id int, name string, kept string")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "id int, name string")
    once = merging.merge_upsert(base, new, ["id"])
    twice = merging.merge_upsert(once, new, ["id"])
    assert sorted(once.collect()) == sorted(twice.collect()) == [(1, "a", "x"), (2, "B", "y"), (3, "C", None)]
    replaced = merging.replace_rows(base, new, ["id"])
    assert sorted(replaced.collect())[1] == (2, "B", None)
    ignored = merging.insert_ignore(base, new.withColumn("seq", F.lit(1)), ["id"], "seq")
    assert sorted(r["name"] for r in ignored.collect()) == ["C", "a", "b"]
    patch = spark.createDataFrame([(1, {"name": None})], "id int, patch map<string,string>")
    assert sorted(merging.sparse_patch(base, patch, "id", ["name", "kept"]).collect())[0] == (1, None, "x")


def test_match_names_equals_nested_loop(spark):
    left, right = ["base set", "", "fossil: two", "xy", "z", "Fossil: Tw", ":", "a:b", "Jungle", "ng", "set: y", "nothing at all"], ["Jungles", "Fossil Two Box", "xyz", "fossil", ":z", "ab", "Set", "a very long set name", "set yard", "jungle"]
    a = spark.createDataFrame(list(enumerate(left)), "left_id int, name string")
    b = spark.createDataFrame([(100 + k, k, n) for k, n in enumerate(right)], "right_id int, position int, name string")
    want = {}
    for i, x in enumerate(left):
        x = x.lower()
        hits = [100 + k for k, y in enumerate(n.lower() for n in right) if y in x or x in y or x.replace(":", "") in y]
        if hits:
            want[i] = hits[0]
    for k in (2, 3, 5):
        assert dict(map(tuple, merging.match_names(a, b, k=k).collect())) == want
    assert merging.match_names(a.limit(0), b).count() == merging.match_names(a, b.limit(0)).count() == 0


def test_budget_and_pages(spark):
    backlog = spark.createDataFrame([("a", 130, 40), ("b", 0, 5), ("c", 10, 10)], "set_id string, card_count int, start_offset long")
    pages = progress.plan_pages(backlog, 50)
    assert sorted(map(tuple, pages.select("set_id", "page_start", "page_size").collect())) == [("a", 40, 50), ("a", 90, 40), ("b", 5, 50)]
    run = progress.running_cost(pages, "page_size", "set_id", [], [F.col("page_no")])
    made = lambda *a, **k: sorted((r["set_id"], r["page_start"], r["used"]) for r in progress.within_budget(run, "page_size", *a, **k).collect())
    assert made(F.lit(100)) == [("a", 40, 50), ("a", 90, 90)]
    assert made(F.lit(140), F.lit(20)) == [("a", 40, 70), ("a", 90, 110)]
    assert made(F.lit(999), remaining=F.lit(130), reserve=80) == [("a", 40, 50)]
    assert [r["granted"] for r in progress.granted(run, "page_size", F.lit(60)).orderBy("set_id", "page_no").collect()] == [50, 10, 0]
    assert tuple(progress.run_status(run, progress.within_budget(run, "page_size", F.lit(100))).first()) == (3, 2, "stopped")
    assert tuple(progress.run_status(run, run).first()) == (3, 3, "completed")


def test_numbered_sets_and_pending(spark):
    sets = spark.createDataFrame([("a", "english", 1), ("b", "english", None), ("c", "japanese", 3)], "set_id string, language string, numeric_id int")
    assert [r["set_id"] for r in merging.numbered_sets(sets, "english").collect()] == ["a"]
    for unknown in (2, 3):
        with pytest.raises(ValueError):
            merging.numbered_sets(sets, "english", unknown)


def test_rollover(spark):
    states = spark.createDataFrame([(1, "rate_limited", "d1", 9, 1, "t", "e"), (2, "rate_limited", "d2", 9, 1, "t", "e"), (3, "disabled", "d1", 9, 1, "t", "e")], "key_id int, status string, state_day string, credits_used int, remaining int, rate_limited_at string, last_error string")
    keys = spark.createDataFrame([(k,) for k in (1, 2, 3, 4)], "key_id int")
    got = merging.rollover_keys(keys, states, F.lit("d2")).orderBy("key_id").collect()
    assert [tuple(r) for r in got] == [(1, "active", "d2", 0, None, None, None), (2, "rate_limited", "d2", 9, 1, "t", "e"), (3, "disabled", "d2", 9, 1, "t", "e"), (4, "active", "d2", 0, None, None, None)]


def test_run_log(spark, tmp_path):
    opened = progress.open_runs(spark.createDataFrame([(1, "j", "en", "/c", "{}", "t0"), (2, "j", "en", "/c", "{}", "t0")], "run_id int, job_name string, language string, endpoint string, params string, started_at string"))
    closed = progress.close_runs(spark.createDataFrame([(1, "completed", 5, 4, 3, 2, 1, None, "t1")], "run_id int, status string, rows_fetched int, rows_upserted int, api_calls_consumed int, daily_remaining int, minute_remaining int, error_message string, finished_at string"))
    publishing.append_run_event(opened, str(tmp_path / "log"))
    publishing.append_run_event(closed, str(tmp_path / "log"))
    events = spark.read.option("mergeSchema", "true").parquet(str(tmp_path / "log"))
    got = {r["run_id"]: r for r in progress.run_states(events).collect()}
    assert (got[1]["status"], got[1]["job_name"], got[1]["rows_upserted"], got[1]["error_message"]) == ("completed", "j", 4, None) and got[2]["status"] == "running"


def test_links(spark):
    texts = [("\n Name  two \t",), ("\u00a0x\u2003",), ("  ",), (None,)]
    assert values(spark, S.normalize_link(F.col("t")), texts, "t string") == ["Name two", "x", "", None]
    assert values(spark, S.is_item_link(F.col("h")), [("/card/x",), ("http://y/card/x",), ("/sets",)], "h string") == [True, False, False]


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "p").mkdir()
    for k, body in enumerate(['{"data":[{"id":"a"},null,{"id":"b"}]}', '{"data":{"id":"c"}}', "{}"]):
        (tmp_path / "p" / f"{k}.json").write_text(body)
    assert sorted(r["item"]["id"] for r in landing.read_api_pages(spark, str(tmp_path / "p"), "struct<id:string>").collect()) == ["a", "b", "c"]
    (tmp_path / "names.json").write_text('["x","y"]')
    assert [tuple(r) for r in landing.read_name_list(spark, str(tmp_path / "names.json")).collect()] == [(1, "x"), (2, "y")]
    manifest = str(tmp_path / "m")
    publishing.write_manifest(spark, manifest, {"source": "a", "at": "1"}, 1)
    assert dict(map(tuple, publishing.write_manifest(spark, manifest, {"at": "2"}, 2).collect())) == {"source": "a", "at": "2"}
    cards = spark.range(20).select(F.col("id").cast("string").alias("id"), *(F.lit("x").alias(c) for c in publishing.COMPACT_COLUMNS[1:-1]), F.lit(b"\x01\x02").alias("tflite_emb_q"))
    publishing.write_compact(cards, str(tmp_path / "c"))
    check = publishing.validate_package(spark.read.parquet(str(tmp_path / "c"))).first()
    assert (check["n_rows"], check["avg_bytes"], check["repeated_ids"]) == (20, 2.0, 0)


def test_anchors(spark):
    pages = spark.createDataFrame([(1, '<a href="/card/x"><img src="/l.png"></a> <a href="/card/x">Na<b>me</b></a><a>no</a>'), (2, None)], "page_id long, html string")
    links = html_links.extract_anchors(pages)
    assert [tuple(r)[2:] for r in links.orderBy("pos").collect()] == [("/card/x", "", "/l.png"), ("/card/x", "Name", "")]
    more = spark.createDataFrame([(3, "<!-- <a href='/no'>x</a> --><A class=b HREF='/a?x=1&amp;y=2'>A &lt;B&gt;<img src=1.png><IMG alt='' src='2.png'></A><abbr>z</abbr><a data-href='n'>no</a><a href=/c>open<a name=k href=\"/d\">Line\nbreak</a >")], "page_id long, html string")
    assert [tuple(r)[1:] for r in html_links.extract_anchors(more).orderBy("pos").collect()] == [(1, "/a?x=1&y=2", "A <B>", "2.png"), (2, "/c", "open", ""), (3, "/d", "Line\nbreak", "")]
    assert tuple(progress.links_by_href(links).select("href", "name", "image").first()) == ("/card/x", "Name", "/l.png")
