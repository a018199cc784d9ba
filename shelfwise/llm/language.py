"""Language identification with a bidirectional gated recurrent network over bytes.

The network is trained in numpy by backpropagation through time and labels
every byte position from both sides; a document's probabilities are the mean
over all its positions.  Texts run in windows of ``WINDOW`` bytes, many in
lock-step, and both directions start ``CONTEXT`` bytes before their window, so
that no position is labelled without what surrounds it; all positions of the
whole text count once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blocks, flat_utf8, numbered, place_of, table, texts
from .merging import ranges

WINDOW = 256
CONTEXT = 24
HIDDEN = 8
#: Training reads at most one document of each of so many hash buckets per language,
#: and of each at most this many windows of this length.
BUCKETS = 160
TRAIN_WINDOWS = 4
TRAIN_LENGTH = 40
STEPS = 160
UNKNOWN = "und"
#: Letters are characters of Unicode's categories L*.
LETTER = regex.compile(r"\p{L}")
PAD = 256


def held_out(doc_id: Column) -> Column:
    """Documents that training never sees; a null id isn't among them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


@dataclass
class Network:
    """Weights of both directions, and of the labels over both hidden states; languages in order."""

    languages: list[str]
    gates: list[np.ndarray]  # per direction, 257 x 3H: update, reset, candidate for each byte; the last row is padding
    inner: list[np.ndarray]  # per direction, H x 3H
    label: np.ndarray  # 2H x languages
    bias: np.ndarray

    @staticmethod
    def fresh(languages: list[str], hidden: int = HIDDEN, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        draw = lambda *shape: (rng.normal(0, 0.3, shape)).astype(np.float32)
        return Network(languages, [draw(257, 3 * hidden) for _ in range(2)], [draw(hidden, 3 * hidden) for _ in range(2)], draw(2 * hidden, len(languages)), np.zeros(len(languages), np.float32))

    def states(self, rows: np.ndarray, side: int, keep: list | None = None) -> np.ndarray:
        """Hidden states (length, lanes, H) of windows (length, lanes) read from one side."""
        steps, lanes = rows.shape
        inner, gates, h3 = self.inner[side], self.gates[side], self.inner[side].shape[0]
        u_zr, u_n = np.ascontiguousarray(inner[:, : 2 * h3]), np.ascontiguousarray(inner[:, 2 * h3 :])
        g_zr, g_n = np.ascontiguousarray(gates[:, : 2 * h3]), np.ascontiguousarray(gates[:, 2 * h3 :])
        h = np.zeros((lanes, h3), np.float32)
        out = np.empty((steps, lanes, h3), np.float32)
        for t in range(steps) if side == 0 else range(steps - 1, -1, -1):
            x = rows[t]
            zr = h @ u_zr
            zr += g_zr[x]
            zr *= 0.5
            np.tanh(zr, out=zr)
            zr *= 0.5
            zr += 0.5
            z, r = zr[:, :h3], zr[:, h3:]
            c = h @ u_n
            n = np.tanh(r * c + g_n[x])
            if keep is not None:
                keep.append((t, h, z, r, c, n))
            h = n + z * (h - n)
            out[t] = h
        return out

    def probabilities(self, rows: np.ndarray) -> np.ndarray:
        """Each position's probabilities (length, lanes, languages)."""
        h = self.label.shape[0] // 2
        logits = self.states(rows, 0) @ self.label[:h]
        logits += self.states(rows, 1) @ self.label[h:]
        logits += self.bias
        logits -= logits.max(axis=2, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=2, keepdims=True)
        return logits

    def parameters(self) -> list[np.ndarray]:
        return [*self.gates, *self.inner, self.label, self.bias]

    def gradients(self, rows: np.ndarray, target: np.ndarray) -> list[np.ndarray]:
        """Of the mean cross-entropy over all positions, by backpropagation through time."""
        steps, lanes = rows.shape
        h = self.inner[0].shape[0]
        kept: list[list] = [[], []]
        states = [self.states(rows, s, kept[s]) for s in range(2)]
        logits = states[0] @ self.label[:h] + states[1] @ self.label[h:] + self.bias
        logits -= logits.max(axis=2, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(axis=2, keepdims=True)
        p[:, np.arange(lanes), target] -= 1.0
        p /= steps * lanes
        d_label = np.concatenate([np.einsum("tlh,tlk->hk", s, p) for s in states])
        d_gates, d_inner = [], []
        for s in range(2):
            dx, du = np.zeros_like(self.gates[s]), np.zeros_like(self.inner[s])
            carry = np.zeros((lanes, h), np.float32)
            for t, before, z, r, c, n in reversed(kept[s]):
                d = carry + p[t] @ self.label[s * h : (s + 1) * h].T
                dn = d * (1 - z) * (1 - n * n)
                dz = d * (before - n) * z * (1 - z)
                dr = dn * c * r * (1 - r)
                at_gates = np.concatenate([dz, dr, dn], axis=1)
                at_inner = np.concatenate([dz, dr, dn * r], axis=1)
                du += before.T @ at_inner
                for k in range(3 * h):
                    dx[:, k] += np.bincount(rows[t], at_gates[:, k], 257)
                carry = d * z + at_inner @ self.inner[s].T
            d_gates.append(dx)
            d_inner.append(du)
        return [*d_gates, *d_inner, d_label, p.sum(axis=(0, 1))]

    def fit(self, windows: np.ndarray, target: np.ndarray, steps: int = STEPS, batch: int = 192, rate: float = 0.03, seed: int = 11) -> None:
        """Adam over random batches, an equal number of each language."""
        rng = np.random.default_rng(seed)
        of = [np.flatnonzero(target == k) for k in range(len(self.languages))]
        first = [np.zeros_like(p) for p in self.parameters()]
        second = [np.zeros_like(p) for p in self.parameters()]
        for step in range(1, steps + 1):
            chosen = np.concatenate([rng.choice(o, -(-batch // len(of))) for o in of])
            now = rate * (1 - step / (steps + 1)) + 0.002
            for p, g, m, v in zip(self.parameters(), self.gradients(windows[:, chosen], target[chosen]), first, second):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= (now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        for g in self.gates:  # padding keeps the state: the update gate is shut
            g[PAD] = 0.0
            g[PAD, : g.shape[1] // 3] = 60.0

    def documents(self, flat: np.ndarray, offsets: np.ndarray, lanes: int = 4096) -> np.ndarray:
        """Mean probabilities (documents, languages) over all positions of each text; empty texts get zeros."""
        sizes = np.diff(offsets)
        count = -(-sizes // WINDOW)
        owner = np.repeat(np.arange(len(sizes)), count)
        start = offsets[:-1][owner] + WINDOW * ranges(np.zeros(len(sizes), np.int64), count)
        stop = np.minimum(start + WINDOW, offsets[1:][owner])
        begin, end = np.maximum(start - CONTEXT, offsets[:-1][owner]), np.minimum(stop + CONTEXT, offsets[1:][owner])
        total = np.zeros((len(sizes), len(self.languages)))
        by_length = np.argsort(end - begin, kind="stable")
        for lo in range(0, len(start), lanes):
            part = by_length[lo : lo + lanes]
            at = begin[part][None, :] + np.arange(int((end - begin)[part].max()))[:, None]
            rows = np.where(at < end[part][None, :], flat[np.minimum(at, len(flat) - 1)].astype(np.int64), PAD)
            p = self.probabilities(rows)
            p *= ((at >= start[part][None, :]) & (at < stop[part][None, :]))[:, :, None]
            np.add.at(total, owner[part], p.sum(axis=0, dtype=np.float64))
        return total / np.maximum(sizes, 1)[:, None]


def train(docs: DataFrame, steps: int = STEPS) -> Network:
    """A network from texts and languages of documents that aren't held out.

    Bounded: per language at most ``BUCKETS`` documents, the one with the least
    hash in each bucket, chosen over ids alone; only their texts are then read,
    and of each at most ``TRAIN_WINDOWS`` windows of ``TRAIN_LENGTH`` bytes.  A
    shorter text with a letter is repeated to fill one window.  So what the
    driver gets grows with the number of languages, not with the documents.
    Without any such document the network knows no language.
    """
    usable = docs.select("doc_id", "lang", "text").where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    ids = usable.select("lang", F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id").alias("h"))
    drawn = ids.groupBy("lang", F.pmod("h", F.lit(BUCKETS)).alias("b")).agg(F.min_by("doc_id", "h").alias("doc_id")).select(F.col("doc_id").alias("_drawn"))
    sample = usable.join(F.broadcast(drawn), F.col("doc_id").cast("long") == F.col("_drawn"), "left_semi")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch):
                found = []
                for k, lang, text in zip(part["doc_id"].to_pylist(), part["lang"].to_pylist(), part["text"].to_pylist()):
                    data = text.encode()
                    if len(data) < TRAIN_LENGTH and LETTER.search(text):  # repeated up to a whole window
                        data = ((data + b" ") * TRAIN_LENGTH)[:TRAIN_LENGTH]
                    for j in range(min(TRAIN_WINDOWS, len(data) // TRAIN_LENGTH)):
                        at = (len(data) - TRAIN_LENGTH) * j // max(1, TRAIN_WINDOWS - 1)
                        found.append((k, lang, data[at : at + TRAIN_LENGTH]))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), (pa.int64(), pa.string(), pa.binary()))], ["doc_id", "lang", "data"])

    drawn_texts = sample.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text")
    rows = drawn_texts.mapInArrow(windows, "doc_id long, lang string, data binary").toArrow()
    rows = rows.sort_by([(c, "ascending") for c in ("lang", "doc_id", "data")])
    languages = sorted(set(rows["lang"].to_pylist()))
    network = Network.fresh(languages)
    if languages:
        data = np.frombuffer(b"".join(rows["data"].to_pylist()), np.uint8).reshape(-1, TRAIN_LENGTH).T.astype(np.int64)
        target = np.searchsorted(np.array(languages), np.array(rows["lang"].to_pylist()))
        network.fit(np.ascontiguousarray(data), target, steps)
    return network


def label_texts(network: Network, column: pa.Array) -> tuple[list[str], np.ndarray]:
    """Language and probability of each text; ``und`` with 0 where the text is null or has no letter."""
    flat, offsets = flat_utf8(column)
    if not network.languages or not len(flat):
        return [UNKNOWN] * len(column), np.zeros(len(column))
    p = network.documents(flat, offsets)
    best = p.argmax(axis=1)
    lettered = np.array([bool(t and LETTER.search(t)) for t in column.to_pylist()], bool)
    return [network.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered)], np.where(lettered, np.clip(p.max(axis=1), 0, 1), 0.0)


def identify(docs: DataFrame, network: Network) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score.

    Only the text is read; null texts and those without a letter are ``und``
    with score 0.  Repeated rows get equal values.  Texts of any length count
    whole; an empty table gives no rows; columns other than id and text play
    no part.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch):
                names, score = label_texts(network, part["text"])
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(names, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])

    found = texts(docs).mapInArrow(run, "doc_id long, lang_pred string, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, network: Network, least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, with all columns, whose language is known with probability ``least`` or more.

    Null and empty texts, and those without a letter, go.  Texts of any length
    count whole, repeated rows share one fate, an empty table stays empty, and
    other columns, whatever their names, play no part.
    """
    place, plain = place_of(docs, "text"), numbered(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, column=place):
                _, score = label_texts(network, part.column(place))
                yield part.filter(pa.array(score >= least))

    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, train(docs))
