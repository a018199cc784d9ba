"""Nested price histories and paged responses on literal rows."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import prices, progress
from shelfwise.sources import landing

NEAR = '"condition":"Near Mint"'


def plan_of(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def bucket(date, market, low='"1"'):
    return f'{{"bucketStartDate":{date},"marketPrice":{market},"lowSalePrice":{low}}}'


def result(variant, buckets, condition=NEAR):
    return f'{{"variant":"{variant}",{condition},"buckets":[{",".join(buckets)}]}}'


def history(*results):
    return '{"result":[' + ",".join(results) + "]}"


@pytest.fixture(scope="module")
def bodies(spark):
    rows = [
        (1, history(result("Holofoil", [bucket('"2024-01-02"', '"7.5"'), bucket('"2024-01-10"', 3, 0), bucket('"2024-01-10"', "4.25", "null")]), result("holofoil", [bucket('"2024-02-01"', 9)]))),
        (2, history(result("Normal", [bucket('"2024-01-02"', 5), bucket('"soon"', 8), bucket("null", 8), bucket('"2024-1-3"', '" 6 "')]))),
        (3, history(result("Normal", [bucket('"2024-01-02"', 5), bucket('"2024-01-03"', "null")]), result("Foil", [bucket('"2024-01-01"', 2)], '"condition":"Lightly Played"'), result("--", [bucket('"2024-01-01"', 2)]))),
        (4, history(result("Reverse Holofoil", []), '{"variant":null,"condition":"NM","buckets":null}')),
        (5, "{}"), (6, None), (7, "no json"), (8, history(result("Normal", [bucket('"2024-13-40"', 5)]), result("1st Edition", [bucket('"2024-01-01"', '"x"')]), result("Cosmos", [bucket('"2023-12-31"', 2.5)]))),
    ]
    return spark.createDataFrame(rows, "product_id long, body string")


def test_nested_prices(bodies):
    got = {r["product_id"]: r for r in prices.nested_prices(prices.read_histories(bodies)).collect()}
    maps = {k: {v: (p["market"], p["low"]) for v, p in r["prices"].items()} for k, r in got.items()}
    assert maps == {1: {"holofoil": (4.25, None)}, 2: {"normal": (6.0, 1.0)}, 3: {}, 4: {}, 5: {}, 6: {}, 7: {}, 8: {"cosmos": (2.5, 1.0)}}
    assert {k: r["bad_buckets"] for k, r in got.items()} == {1: 0, 2: 2, 3: 0, 4: 0, 5: 0, 6: 0, 7: 0, 8: 1}
    assert {k: r["best_price"] for k, r in got.items()} == {1: 4.25, 2: 6.0, 3: 0.0, 4: 0.0, 5: 0.0, 6: 0.0, 7: 0.0, 8: 2.5}


def test_nested_equals_flat(bodies):
    """The flat jobs over exploded buckets give the same prices."""
    nested = prices.read_histories(bodies)
    results = nested.select("product_id", F.posexplode("results").alias("result_pos", "r")).select("product_id", "result_pos", "r.variant", F.col("r.condition").alias("cond"), F.posexplode("r.buckets").alias("bucket_pos", "b"))
    number = lambda c: F.coalesce(F.trim(c).try_cast("double"), F.lit(0.0))
    flat = results.select("product_id", "result_pos", "variant", "cond", "bucket_pos", F.try_to_date("b.bucketStartDate", "yyyy-M-d").alias("bucket_date"), number(F.col("b.marketPrice")).alias("market"), number(F.col("b.lowSalePrice")).alias("low"))
    want = {r["product_id"]: (r["prices"], r["best_price"]) for r in prices.current_prices(flat).collect()}
    assert {r["product_id"]: (r["prices"], r["best_price"]) for r in prices.nested_prices(nested).where(F.size("prices") > 0).collect()} == want
    latest = lambda df: sorted(map(str, df.select("product_id", "variant", "cond", "bucket_date", "market", "low").collect()))
    assert latest(prices.latest_nested(nested)) == latest(prices.latest_buckets(flat))


def test_nothing_shuffles_before_the_fan_out(spark, bodies, tmp_path):
    bodies.write.parquet(str(tmp_path / "landed"))
    landed = prices.read_histories(spark.read.parquet(str(tmp_path / "landed")))
    for df in (prices.latest_nested(landed), prices.nested_prices(landed)):
        assert "Exchange" not in plan_of(df) and "Python" not in plan_of(df)


def test_each_bucket_is_read_once(spark, bodies, tmp_path):
    """the filter on the map, the best price and the map itself share one evaluation of the buckets."""
    bodies.write.parquet(str(tmp_path / "landed"))
    found = prices.nested_prices(prices.read_histories(spark.read.parquet(str(tmp_path / "landed")))).where(F.size("prices") > 0)
    plan = found.select("product_id", "prices", "best_price")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_max(") == 1 and plan.count("from_json(") + plan.count("jsontostructs(") + plan.count("JsonToStructs") <= 1


def test_refresh_leaves_other_cards_alone(spark, bodies):
    cards = spark.createDataFrame([(10, 1, 1.0), (11, 1, 2.0), (12, 3, 3.0), (13, None, 4.0), (14, 99, 5.0)], "id long, product_id long, price double")
    rows = {r["id"]: r for r in prices.refresh_from_histories(cards, prices.read_histories(bodies), F.lit("2024-06-01").cast("timestamp")).collect()}
    assert {k: r["price"] for k, r in rows.items()} == {10: 4.25, 11: 4.25, 12: 3.0, 13: 4.0, 14: 5.0}
    assert {k for k, r in rows.items() if r["scraped_at"]} == {10, 11}


def test_missing_pages_and_completeness(spark):
    page = lambda n, total: '{"data":[' + ",".join(['{"id":"x"}'] * n) + f'],"totalCount":{total}}}'
    rows = [
        ("all", 1, page(10, 12)), ("all", 2, page(2, 12)), ("all", 2, page(2, 12)),
        ("gaps", 2, page(10, 95)), ("gaps", 5, page(10, '"95"')), ("gaps", 6, page(10, 80)), ("gaps", 9, '{"data":[],"totalCount":95}'),
        ("short", 1, page(4, 15)), ("short", 2, page(5, 15)), ("none", 1, '{"totalCount":30}'), ("one", 1, '{"data":{"id":"x"},"totalCount":1}'), ("untold", 1, '{"data":[{"id":"x"},null]}'), ("more", 3, page(10, 10)), ("bad", 1, None),
    ]
    totals = landing.page_totals(spark.createDataFrame(rows, "set_id string, page int, body string"))
    gaps = sorted(map(tuple, landing.missing_pages(totals, 10).collect()))
    assert gaps == [("gaps", 1, 1), ("gaps", 3, 4), ("gaps", 7, 10), ("more", 1, 1), ("none", 1, 3)]
    got = {r["set_id"]: tuple(r)[1:] for r in landing.completeness(totals, 10).collect()}
    assert got == {"all": (2, 2, 12, 12, True), "gaps": (10, 3, 30, 95, False), "short": (2, 2, 9, 15, False), "none": (3, 0, 0, 30, False), "one": (1, 1, 1, 1, True), "untold": (0, 1, 1, 0, True), "more": (1, 1, 10, 10, True), "bad": (0, 0, 0, 0, True)}
    assert tuple(progress.against_server(landing.completeness(totals, 10)).first()) == (63, 163, False)
    assert landing.missing_pages(totals.where("false"), 10).count() == landing.completeness(totals.where("false"), 10).count() == 0


def test_coverage_counts_start_offsets(spark):
    rows = [("done", 10, 12, True, 12), ("part", 10, 4, False, 4), ("ahead", 10, 4, False, 7), ("past", 10, 9, False, 10), ("open", 0, 5, False, 5), ("unknown", None, 3, False, 3), ("new", 10, 0, False, 0)]
    backlog = spark.createDataFrame(rows, "set_id string, card_count int, existing long, done boolean, start_offset long")
    assert tuple(progress.coverage(backlog).first()) == (1, 6, 12 + 4 + 7 + 5 + 3, False)
    assert progress.coverage(backlog.drop("start_offset")).first()["rows_skipped"] == 12 + 4 + 4 + 9 + 5 + 3
