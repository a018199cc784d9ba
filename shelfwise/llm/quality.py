"""Quality scores from random-indexing word vectors, pooled per document, and a small calibrated network.

A word counts as itself if the sample has it often enough, else by its shape
(runs of upper-case letters, other letters, digits, and each other sign), and a
word that repeats the one before it as a repeat.  Every such unit has an index
vector with a few random signs; its word vector is the sum of the index vectors
that stand next to it in the sample.  A document is the mean of its words'
vectors, with its length; a network with one hidden layer gives a logit, and a
temperature fitted on rows that the network did not learn from makes it a
probability.  Training reads at most ``MAX_LABELLED`` labelled documents, drawn
by a hash of their ids; scoring reads all documents, whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blocks, cut, flat_utf8, table, texts
from .language import held_out
from .merging import distinct_words

#: Labelled documents that teach; tasks that read them; known words and shapes, and in how many documents each occurs at least.
MAX_LABELLED, TRAIN_TASKS = 6000, 8
MAX_WORDS, MAX_SHAPES, LEAST_DOCS = 4000, 300, 5
#: Width of a vector, signs of an index vector, and neighbours on each side.
WIDTH, SIGNS, REACH = 96, 8, 2
HIDDEN, STEPS, RATE, DECAY = 24, 400, 0.01, 1e-3
#: Of so many labelled rows one is kept for the temperature.
KEPT_FOR_TEMPERATURE = 5
SAME, OTHER = 0, 1

SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
SHAPE = np.arange(256, dtype=np.uint8)
SHAPE[65:91] = ord("A")
SHAPE[97:123] = SHAPE[128:] = ord("a")
SHAPE[48:58] = ord("0")


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all texts, and each word's start, end and text."""
    flat, offsets = flat_utf8(column)
    inside = ~SPACE[flat]
    filled = offsets[:-1] < offsets[1:]
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    first, last = offsets[:-1][filled], offsets[1:][filled] - 1
    begin[first], end[last] = inside[first], inside[last]
    start = np.flatnonzero(begin)
    return flat, start, np.flatnonzero(end) + 1, np.searchsorted(offsets, start, side="right") - 1


def shapes(words: pa.Array) -> pa.Array:
    """Each word's shape: the kinds of its bytes, runs of one kind as one."""
    if not len(words):
        return pa.array([], pa.large_binary())
    flat, offsets = flat_utf8(words.cast(pa.large_binary()).view(pa.large_string()))
    kind = SHAPE[flat]
    keep = np.ones(len(kind), bool)
    keep[1:] = kind[1:] != kind[:-1]
    keep[offsets[:-1][offsets[:-1] < len(kind)]] = True
    at = np.concatenate([np.zeros(1, np.int64), np.cumsum(keep)])[offsets]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(at), pa.py_buffer(kind[keep])])


@dataclass
class Units:
    """Known words and shapes; units are numbered: repeat, anything else, the words, the shapes."""

    words: pa.Array
    shapes: pa.Array

    def __len__(self) -> int:
        return 2 + len(self.words) + len(self.shapes)

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The unit and the text of every word."""
        flat, start, end, text = tokens(column)
        if not len(start):
            return np.zeros(0, np.int64), text
        _, number, distinct = distinct_words(flat, start, end)
        distinct = distinct.cast(pa.large_binary())
        word, shape = (pc.index_in(x, value_set=y).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64) for x, y in ((distinct, self.words), (shapes(distinct), self.shapes)))
        unit = np.where(word >= 0, 2 + word, np.where(shape >= 0, 2 + len(self.words) + shape, OTHER))[number]
        again = (number[1:] == number[:-1]) & (text[1:] == text[:-1])
        unit[1:][again] = SAME
        return unit, text


def index_vectors(n: int) -> np.ndarray:
    """A row of a few random signs for each unit, always the same ones."""
    rng, out = np.random.default_rng(5), np.zeros((n, WIDTH), np.float32)
    for row in out:
        row[rng.choice(WIDTH, SIGNS, replace=False)] = rng.choice([-1.0, 1.0], SIGNS)
    return out


def neighbour_sums(unit: np.ndarray, text: np.ndarray, index: np.ndarray) -> np.ndarray:
    """For each unit, the sum of the index vectors within reach of its places."""
    out, n = np.zeros(index.shape), len(index)
    for d in range(1, REACH + 1):
        same = text[d:] == text[:-d]
        for a, b in ((unit[:-d][same], unit[d:][same]), (unit[d:][same], unit[:-d][same])):
            keys, times = np.unique(a * n + b, return_counts=True)
            for lo in range(0, len(keys), 1 << 15):
                k = keys[lo : lo + (1 << 15)]
                np.add.at(out, k // n, index[k % n] * times[lo : lo + (1 << 15), None])
    return out


def pooled(unit: np.ndarray, text: np.ndarray, n_texts: int, vectors: np.ndarray) -> np.ndarray:
    """A row for each text: the mean of its words' vectors, and the logarithm of their number; an empty text has zeros."""
    n, out = len(vectors), np.zeros((n_texts, vectors.shape[1] + 1))
    keys, times = np.unique(text * n + unit, return_counts=True)
    for lo in range(0, len(keys), 1 << 15):
        k, t = keys[lo : lo + (1 << 15)], times[lo : lo + (1 << 15), None]
        owner = k // n
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        out[owner[first], :-1] += np.add.reduceat(vectors[k % n] * t, first, axis=0)
    size = np.bincount(text, minlength=n_texts)
    out[:, :-1] /= np.maximum(size, 1)[:, None]
    out[:, -1] = np.log1p(size)
    return out


@dataclass
class Network:
    """Two layers over standardised inputs; ``temperature`` divides the logit."""

    mean: np.ndarray
    scale: np.ndarray
    inner: np.ndarray
    bias: np.ndarray
    outer: np.ndarray
    last: float
    temperature: float = 1.0

    @staticmethod
    def train(x: np.ndarray, y: np.ndarray) -> Network:
        """Full-batch steps (Adam) on four fifths of the rows, the temperature on the rest."""
        rng, n = np.random.default_rng(3), len(y)
        mean, scale = (x.mean(axis=0), x.std(axis=0) + 1e-6) if n else (np.zeros(x.shape[1]), np.ones(x.shape[1]))
        net = Network(mean, scale, rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), 0.0)
        if not 0 < y.sum() < n:  # one class at most: its smoothed share, for any text
            net.last = float(np.log((y.sum() + 1) / (n - y.sum() + 1)))
            net.inner[:] = 0
            return net
        rest = np.arange(n) % KEPT_FOR_TEMPERATURE > 0
        if not 0 < y[rest].sum() < rest.sum():
            rest[:] = True
        params = [net.inner, net.bias, net.outer, np.zeros(1)]
        moment, square = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        a, target = (x[rest] - mean) / scale, y[rest]
        for step in range(1, STEPS + 1):
            h = np.tanh(a @ params[0] + params[1])
            slope = (_sigmoid(h @ params[2] + params[3]) - target) / len(target)
            back = slope[:, None] * params[2] * (1 - h * h)
            grads = [a.T @ back + DECAY * params[0], back.sum(axis=0), h.T @ slope + DECAY * params[2], np.array([slope.sum()])]
            for p, g, m, s in zip(params, grads, moment, square):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
        net.last = float(params[3][0])
        if not rest.all():
            net.temperature = fit_temperature(net.logits(x[~rest]), y[~rest])
        return net

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(((x - self.mean) / self.scale) @ self.inner + self.bias) @ self.outer + self.last

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(x) / self.temperature)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * z)


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature from 1/2 to 8 with the least log loss, by golden-section search over its logarithm."""

    def loss(t: float) -> float:
        z = logits / np.exp(t)
        return float(np.mean(np.logaddexp(0, z) - y * z))

    lo, hi, part = np.log(0.5), np.log(8.0), (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = hi - part * (hi - lo), lo + part * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


@dataclass
class Model:
    units: Units
    vectors: np.ndarray
    network: Network

    def __call__(self, column: pa.Array) -> np.ndarray:
        unit, text = self.units(column)
        return self.network(pooled(unit, text, len(column), self.vectors))


def _sample(docs: DataFrame, labels: DataFrame, limit: int) -> DataFrame:
    """(doc_id, text, y) of labelled documents that aren't held out; ids with several labels or texts teach the greatest label and the least text."""
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("quality") == 1).cast("int").alias("y")).dropna().where(~held_out(F.col("doc_id")))
    drawn = marks.groupBy("doc_id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)  # at most ``limit`` small rows
    return texts(docs).join(F.broadcast(drawn), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))


def train(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> Model:
    """A model from at most ``limit`` labelled documents that aren't held out; without any, all scores are 0.5.

    The driver gets the known units with their vectors, and one vector for
    each sampled document.
    """
    sample = cut(_sample(docs, labels, limit).repartition(TRAIN_TASKS, "doc_id"))

    def occurring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch):
                flat, start, end, text = tokens(part["text"])
                if not len(start):
                    continue
                _, number, distinct = distinct_words(flat, start, end)
                distinct = distinct.cast(pa.large_binary())
                form, names = shapes(distinct).dictionary_encode(), []
                for kind, codes, values in ((0, number, distinct), (1, form.indices.to_numpy(zero_copy_only=False).astype(np.int64)[number], form.dictionary)):
                    docs_with = np.bincount(np.unique(text * len(values) + codes) % len(values), minlength=len(values))
                    names.append(pa.RecordBatch.from_arrays([pa.array(np.full(len(values), kind, np.int32)), values.cast(pa.binary()), pa.array(docs_with)], ["kind", "name", "n"]))
                yield from names

    counts = sample.mapInArrow(occurring, "kind int, name binary, n long").groupBy("kind", "name").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_DOCS)
    chosen = [counts.where(F.col("kind") == k).orderBy(F.desc("n"), "name").limit(most).toArrow()["name"].combine_chunks().cast(pa.large_binary()) for k, most in ((0, MAX_WORDS), (1, MAX_SHAPES))]
    units = Units(*chosen)
    index = index_vectors(len(units))

    def learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch):
                unit, text = units(part["text"])
                sums, there = neighbour_sums(unit, text, index), np.unique(unit)
                rows = pa.FixedSizeListArray.from_arrays(pa.array(sums[there].ravel()), WIDTH).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([pa.array(there), rows], ["unit", "sums"])

    # whole numbers, so any order of summing gives the same
    summed = sample.mapInArrow(learned, "unit long, sums array<double>").groupBy("unit").agg(Summarizer.sum(array_to_vector("sums")).alias("s")).select("unit", vector_to_array("s").alias("s")).toArrow()
    vectors = np.zeros(index.shape)
    if summed.num_rows:
        vectors[summed["unit"].to_numpy()] = summed["s"].combine_chunks().flatten().to_numpy().reshape(-1, WIDTH)
    vectors = (vectors / np.maximum(np.linalg.norm(vectors, axis=1), 1e-9)[:, None]).astype(np.float32)

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch):
                unit, text = units(part["text"])
                x = pooled(unit, text, part.num_rows, vectors)
                yield pa.RecordBatch.from_arrays([part["doc_id"], part["y"], pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), WIDTH + 1).cast(pa.list_(pa.float64()))], ["doc_id", "y", "x"])

    known = sample.mapInArrow(described, "doc_id long, y int, x array<double>").toArrow().sort_by("doc_id")
    x = known["x"].combine_chunks().flatten().to_numpy().reshape(-1, WIDTH + 1) if known.num_rows else np.zeros((0, WIDTH + 1))
    return Model(units, vectors, Network.train(x, known["y"].to_numpy().astype(float)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Whole texts count, however long; a null text is the empty one, which has
    the score of a text without words.  Repeated rows get equal values; columns
    other than id and text play no part.  An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch):
                p = model(part["text"])
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    found = texts(docs).mapInArrow(run, "doc_id long, score double, predicted int")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))
