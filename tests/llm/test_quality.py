"""The quality classifier: held-out rows, plain versions of its vectors and probabilities, awkward rows."""

import math
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import quality
from shelfwise.llm.quality import Network, Units


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    return quality.train(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def plain_units(units, text):
    words = [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", text)]
    known, forms, out = units.words.to_pylist(), units.shapes.to_pylist(), []
    for k, w in enumerate(words):
        kinds = ["A" if 65 <= b < 91 else "a" if 97 <= b < 123 or b >= 128 else "0" if 48 <= b < 58 else chr(b) for b in w]
        shape = "".join(c for i, c in enumerate(kinds) if not i or kinds[i - 1] != c).encode()
        out.append(0 if k and words[k - 1] == w else 2 + known.index(w) if w in known else 2 + len(known) + forms.index(shape) if shape in forms else 1)
    return out


def test_units_vectors_and_scores_equal_plain_ones(spark, sf_dir, model):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").limit(40).collect()
    column = pa.array([*(r["text"] for r in rows), "", None, "  ", "a a a A1!! é漢字 ☃", "x" * 3000])
    unit, text = model.units(column)
    plain = [plain_units(model.units, t or "") for t in column.to_pylist()]
    assert [unit[text == k].tolist() for k in range(len(column))] == plain
    index, sums = quality.index_vectors(len(model.units)), defaultdict(lambda: np.zeros(quality.WIDTH))
    for us in plain:
        for i, u in enumerate(us):
            for j in (i - 2, i - 1, i + 1, i + 2):
                if 0 <= j < len(us):
                    sums[u] += index[us[j]]
    got = quality.neighbour_sums(unit, text, index)
    assert all(np.array_equal(got[u], sums[u]) for u in range(len(index)))
    p, net = model(column), model.network
    for us, score in zip(plain, p):
        x = np.zeros(quality.WIDTH + 1)
        for u in us:
            x[:-1] += model.vectors[u] / len(us)
        x[-1] = math.log(1 + len(us))
        h = [math.tanh(sum(a * b for a, b in zip((x - net.mean) / net.scale, net.inner[:, k])) + net.bias[k]) for k in range(quality.HIDDEN)]
        z = sum(a * b for a, b in zip(h, net.outer)) + net.last
        assert abs(score - 1 / (1 + math.exp(-z / net.temperature))) < 1e-4


def test_held_out_rows(spark, sf_dir, model):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.score(docs, model).join(labels, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    test = [r for r in rows if r["held_out"]]
    assert len(test) > 10 and np.mean([r["predicted"] == r["quality"] for r in test]) >= 0.9


def test_learns_from_no_held_out_label(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    some = docs.where("doc_id <= 60")
    flipped = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (quality.score(some, quality.train(docs, x)).orderBy("doc_id").collect() for x in (labels, flipped))
    assert a == b


def test_gradient_step_lowers_loss_and_temperature_is_best():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, quality.WIDTH + 1))
    y = (x[:, 0] + 0.3 * rng.normal(size=300) > 0).astype(float)
    net = Network.train(x, y)
    assert np.mean((net(x) > 0.5) == y) > 0.95
    z = rng.normal(size=500) * 6
    y = (rng.random(500) < 1 / (1 + np.exp(-z / 3))).astype(float)
    loss = lambda t: np.mean(np.logaddexp(0, z / t) - y * z / t)
    assert loss(quality.fit_temperature(z, y)) <= min(loss(t) for t in np.arange(0.5, 8, 0.05)) + 1e-6


def test_odd_rows_and_empty_tables(spark, sf_dir, model):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "word " * 30_000), (4, "word " * 30_000), (None, "no id"), (5, "x" * 200_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("score", "y", "units", "kind", "lang", "a.b")})
    got = {(r["doc_id"], r["held_out"], r["score"]) for r in quality.score(docs, model).collect()}
    assert len(got) == 6 and all(0 <= s <= 1 for *_, s in got) and len({s for i, _, s in got if i in (1, 2, 3)}) == 1
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (4, None, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert quality.score(docs.where("false"), model).count() == 0
    assert {r["score"] for r in quality.score(docs, quality.train(docs, labels.where("false"))).collect()} == {0.5}
    assert {r["predicted"] for r in quality.score(docs, quality.train(docs, labels)).collect()} == {1}
    assert isinstance(Units(pa.array([], pa.large_binary()), pa.array([], pa.large_binary()))(pa.array(["a b"]))[0], np.ndarray)
