"""Toxicity categories by a classifier chain.

The categories of ``CATEGORIES`` are predicted one after the other by linear
models over words and word beginnings.  Each later model also reads the earlier
categories' probabilities; it is trained with out-of-fold predictions of those,
so that it sees in training what it will see in use.  Training reads at most
``MAX_LABELLED`` labelled documents, drawn by a hash of their ids; features are
counted and chosen in Spark, and the driver gets only the chosen ones.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import blocks, cut, numbered, place_of, table, texts

#: Categories in the order of the chain, as conditions over the labels' columns.
CATEGORIES = {"low_quality": "quality = 0", "toxic": "toxic = 1", "severe": "toxic = 1 AND quality = 0"}
#: The category that decides.
DECIDING = "toxic"
MAX_LABELLED = 6000
#: Features per category, and the least G-squared statistic that admits one.
MAX_FEATURES = 300
LEAST_G2 = 15.0
FOLDS = 5
THRESHOLD = 0.5

WORD = re.compile(r"[^\W\d_]+")


def features(text: str) -> set[str]:
    """A text's words in lower case (marked w) and their first four and five characters (4, 5)."""
    words = set(WORD.findall(text.lower()))
    return {"w" + w for w in words} | {"4" + w[:4] for w in words if len(w) > 4} | {"5" + w[:5] for w in words if len(w) > 5}


def _sample(docs: DataFrame, labels: DataFrame, categories: dict[str, str], limit: int) -> DataFrame:
    """(doc_id, text, one 0/1 column per category) of labelled documents; rows with a null label take no part."""
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), *(F.expr(c).cast("int").alias(f"y{k}") for k, c in enumerate(categories.values()))).dropna()
    marks = marks.groupBy("doc_id").agg(*(F.max(f"y{k}").alias(f"y{k}") for k in range(len(categories))))
    drawn = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)  # at most ``limit`` small rows
    # an id with several texts teaches the least of them, so the bound holds
    return texts(docs).join(F.broadcast(drawn), "doc_id").groupBy(*drawn.columns).agg(F.min("text").alias("text"))


def _choose(sample: DataFrame, n_categories: int, max_features: int) -> list[str]:
    """The features that tell a category best, by the G-squared statistic over all sampled documents."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, limit=1 << 20):
                found = [sorted(features(t)) for t in part["text"].to_pylist()]
                rows = np.repeat(np.arange(len(found)), [len(f) for f in found])
                every, names = pa.array([x for f in found for x in f], pa.string()), [f"y{k}" for k in range(n_categories)]
                yield pa.RecordBatch.from_arrays([every, *(part[y].take(pa.array(rows)) for y in names)], ["feature", *names])

    ys = [f"y{k}" for k in range(n_categories)]
    totals = sample.agg(F.count(F.lit(1)).alias("n"), *(F.sum(y).alias(y) for y in ys)).first()
    counted = sample.mapInArrow(words, "feature string, " + ", ".join(f"{y} int" for y in ys)).groupBy("feature").agg(F.count(F.lit(1)).alias("n"), *(F.sum(y).alias(y) for y in ys)).where("n >= 3")
    n, scored = float(totals["n"]), []
    for k, y in enumerate(ys):
        pos = float(totals[y] or 0)
        if 0 < pos < n:
            have, lack = F.col("n"), n - F.col("n")
            cells = ((F.col(y), have * (pos / n)), (have - F.col(y), have * (1 - pos / n)), (pos - F.col(y), lack * (pos / n)), (lack - pos + F.col(y), lack * (1 - pos / n)))
            g2 = sum((F.when(seen > 0, 2 * seen * F.log(seen / expected)).otherwise(0.0) for seen, expected in cells), F.lit(0.0))
            scored.append(F.struct(F.lit(k).alias("category"), g2.alias("g2")))
    if not scored:
        return []
    rows = counted.select("feature", F.explode(F.array(*scored)).alias("s")).select("feature", "s.*").where(F.col("g2") >= LEAST_G2)
    place = F.row_number().over(Window.partitionBy("category").orderBy(F.desc("g2"), "feature"))
    best = rows.withColumn("place", place).where(F.col("place") <= max_features).select("category", "place", "feature").collect()
    return list(dict.fromkeys(r["feature"] for r in sorted(best)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 12) -> np.ndarray:
    """Weights (the last one is the intercept) of a ridge logistic regression, by Newton's method."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    penalty = np.full(a.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        slope = a.T @ (p - y) + penalty * w
        curve = (a.T * (p * (1 - p))) @ a + np.diag(penalty)
        move = np.linalg.solve(curve, slope)
        w -= move
        if np.abs(move).max() < 1e-4:
            break
    return w


def predict(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))


@dataclass
class Chain:
    """Chosen features, and each category's weights over them, the earlier probabilities and 1."""

    names: list[str]
    vocabulary: dict[str, int]
    weights: list[np.ndarray]

    @staticmethod
    def train(names: list[str], vocabulary: dict[str, int], x: np.ndarray, y: np.ndarray, folds: int = FOLDS) -> Chain:
        if not len(x):  # nothing is known of any category
            return Chain(names, vocabulary, [np.append(np.zeros(x.shape[1] + k), -30.0) for k in range(len(names))])
        fold = np.arange(len(x)) % folds
        weights, earlier = [], np.zeros((len(x), 0))
        for k in range(len(names)):
            inputs, out = np.hstack([x, earlier]), np.zeros(len(x))
            for f in range(folds):
                rest = fold != f
                if rest.any() and not rest.all():
                    out[~rest] = predict(inputs[~rest], logistic(inputs[rest], y[rest, k]))
            weights.append(logistic(inputs, y[:, k]))
            earlier = np.hstack([earlier, out[:, None]])
        return Chain(names, vocabulary, weights)

    def __call__(self, documents: list[str]) -> np.ndarray:
        """Probabilities, a column per category."""
        n = len(self.vocabulary)
        by = {m: {f[1:]: j for f, j in self.vocabulary.items() if f[0] == m} for m in "w45"}
        whole, four, five = (by[m] for m in "w45")
        x = np.zeros((len(documents), n))
        for row, text in zip(x, documents):
            words = set(WORD.findall(text.lower()))
            hits = [whole[w] for w in whole.keys() & words]
            if four:
                hits += [four[p] for p in four.keys() & {w[:4] for w in words if len(w) > 4}]
            if five:
                hits += [five[p] for p in five.keys() & {w[:5] for w in words if len(w) > 5}]
            row[hits] = 1.0
        for w in self.weights:
            x = np.hstack([x, predict(x, w)[:, None]])
        return x[:, n:]


def train(docs: DataFrame, labels: DataFrame, categories: dict[str, str] | None = None, limit: int = MAX_LABELLED) -> Chain:
    """A chain trained on labelled documents; with one class only it gives about that class's share, without any document 0."""
    categories = categories or CATEGORIES
    sample = cut(_sample(docs, labels, categories, limit))
    vocabulary = {f: k for k, f in enumerate(_choose(sample, len(categories), MAX_FEATURES))}
    ys = [f"y{k}" for k in range(len(categories))]

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch):
                hits = [sorted(vocabulary[f] for f in features(t) & vocabulary.keys()) for t in part["text"].to_pylist()]
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(hits, pa.list_(pa.int32())), *(part[y] for y in ys)], ["doc_id", "hits", *ys])

    rows = sample.mapInArrow(match, "doc_id long, hits array<int>, " + ", ".join(f"{y} int" for y in ys)).toArrow().sort_by("doc_id")
    x, y = np.zeros((rows.num_rows, len(vocabulary))), np.stack([rows[c].to_numpy() for c in ys], axis=1).astype(float)
    for row, hits in zip(x, rows["hits"].to_pylist()):
        row[hits] = 1.0
    return Chain.train(list(categories), vocabulary, x, y)


def score(docs: DataFrame, chain: Chain, threshold: float = THRESHOLD, deciding: str = DECIDING) -> DataFrame:
    """One row per row of ``docs``: doc_id, a probability p_<category> each, and ``toxic``.

    Whole texts count, however long; a null or empty text has no feature and
    gets the intercepts' probabilities; repeated rows get the same values;
    columns other than id and text play no part.  An empty table gives no rows.
    """
    names = ["doc_id", *(f"p_{n}" for n in chain.names), "toxic"]
    at = chain.names.index(deciding)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch):
                p = chain(part["text"].to_pylist())
                yield pa.RecordBatch.from_arrays([part["doc_id"], *(pa.array(c, pa.float64()) for c in p.T), pa.array(p[:, at] >= threshold)], names)

    return texts(docs).mapInArrow(run, ", ".join(["doc_id long", *(f"{n} double" for n in names[1:-1]), "toxic boolean"]))


def reject_toxic(docs: DataFrame, chain: Chain, threshold: float = THRESHOLD, deciding: str = DECIDING) -> DataFrame:
    """The rows of ``docs``, with all columns, whose text isn't toxic.

    A null or empty text has no feature and is judged by the intercepts alone.
    Texts of any length count whole, repeated rows share one fate, an empty
    table stays empty, and other columns, whatever their names, play no part.
    """
    at, place, plain = chain.names.index(deciding), place_of(docs, "text"), numbered(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, column=place):
                p = chain([t or "" for t in part.column(place).to_pylist()])
                yield part.filter(pa.array(p[:, at] < threshold))

    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))
