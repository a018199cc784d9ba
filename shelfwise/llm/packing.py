"""Packing token sequences into windows of a fixed size by non-negative least squares.

Every task packs what its partition holds, as a stream, so nothing shuffles.
A document is cut into whole windows and a rest.  Rests are held until
``HELD`` of them are there.  Then the combinations of two or three lengths
that fill a window exactly are listed, repeat counts x >= 0 with
``|A x - histogram|`` least are solved for, rounded to whole counts that the
supply allows, and filled.  What remains is packed greedily: the longest rest
that fits, and where none fits, a cut closes the window.  The rests of the last
window are cut into sequences with a power of two as length, which need no
padding.
"""

from __future__ import annotations

import json
from bisect import bisect_right, insort
from collections import defaultdict
from collections.abc import Iterator
from functools import cached_property
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLOCK_BYTES, blocks, table, texts
from .merging import BatchMerger, distinct_words, pair_arrays, ranges
from .token_counts import NUMBER, SPACE, byte_alphabet, character_classes

VOCABULARY = "word_bpe_49k.json"
WINDOW = 2048
END_ID = 1
#: Rests that a task holds at once, at most a window of ids each.
HELD = 8192
#: Lengths of which three may make up a combination: the most frequent ones.
FREQUENT = 64

#: Sequences that a batch of results holds, of a window of ids each: 1 MB.
SENT = 128

Piece = tuple[int | None, int, bytes, int]  # document, place in it, ids (4 bytes each), the document's ids


def combinations(histogram: np.ndarray, window: int, frequent: int = FREQUENT) -> np.ndarray:
    """Rows of up to three lengths (0: none) that are in the histogram and add up to the window."""
    have = np.flatnonzero(histogram)
    low = have[have <= window // 2]
    two = low[histogram[window - low] > 0]
    rows = [np.stack([two, window - two, np.zeros_like(two)], axis=1)]
    top = np.sort(have[np.argsort(-histogram[have], kind="stable")[:frequent]])
    a, b = (x.ravel() for x in np.meshgrid(top, top, indexing="ij"))
    c = window - a - b
    fits = (a <= b) & (c >= 1) & (c < window)
    a, b, c = a[fits], b[fits], c[fits]
    fits = histogram[c] > 0
    rows.append(np.unique(np.sort(np.stack([a[fits], b[fits], c[fits]], axis=1), axis=1), axis=0))
    return np.concatenate(rows).astype(np.int64)


def solve_counts(rows: np.ndarray, histogram: np.ndarray, steps: int = 150) -> np.ndarray:
    """x >= 0 with the least squares of A x - histogram, where A counts a length in a combination; accelerated projected gradients."""
    n, width = len(rows), len(histogram)
    target = histogram.astype(float)
    target[0] = 0.0

    def forward(x: np.ndarray) -> np.ndarray:
        y = np.bincount(rows.ravel(), np.repeat(x, rows.shape[1]), width)
        y[0] = 0.0
        return y

    back = lambda y: y[rows].sum(axis=1) - y[0] * (rows == 0).sum(axis=1)
    probe = np.ones(n)
    for _ in range(12):  # the largest eigenvalue of A'A bounds the step
        probe = back(forward(probe))
        size = np.linalg.norm(probe)
        probe /= size
    x, y, t = np.zeros(n), np.zeros(n), 1.0
    for _ in range(steps):
        new = np.maximum(0.0, y - back(forward(y) - target) / (1.05 * size))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y, x, t = new + (t - 1) / t_new * (new - x), new, t_new
    return x


def round_counts(x: np.ndarray, rows: np.ndarray, histogram: np.ndarray) -> np.ndarray:
    """Whole repeat counts near x that the supply of each length allows, largest fractions rounded up first."""
    supply = histogram.astype(np.int64)
    supply[0] = 1 << 60
    counts = np.zeros(len(x), np.int64)
    down = np.floor(x + 1e-6).astype(np.int64)
    for order, want in ((np.argsort(-down, kind="stable"), down), (np.argsort(-(x - down), kind="stable"), np.ones_like(down))):
        for j in order:
            need: dict[int, int] = defaultdict(int)
            for length in rows[j]:
                need[int(length)] += length > 0
            can = min([int(want[j]), *(int(supply[k]) // int(v) for k, v in need.items() if v)])
            if can > 0:
                counts[j] += can
                for k, v in need.items():
                    supply[k] -= can * int(v)
    return counts


class Packer:
    """Takes documents' ids and gives lists of pieces, a list for each sequence."""

    def __init__(self, window: int = WINDOW, held: int = HELD) -> None:
        self.window, self.held = window, held
        self.rests: list[Piece] = []

    def add(self, document: int | None, ids: bytes) -> Iterator[list[Piece]]:
        n, w = len(ids) // 4, self.window
        whole = n - n % w
        for at in range(0, whole, w):
            yield [(document, at, ids[4 * at : 4 * (at + w)], n)]
        if n > whole:
            self.rests.append((document, whole, ids[4 * whole :], n))
            if len(self.rests) >= self.held:
                yield from self.pack()

    def pack(self) -> Iterator[list[Piece]]:
        """Fill windows from the rests held; less than a window remains held."""
        w = self.window
        histogram = np.bincount([len(p[2]) // 4 for p in self.rests], minlength=w)
        shelf: dict[int, list[Piece]] = defaultdict(list)
        for p in reversed(self.rests):
            shelf[len(p[2]) // 4].append(p)
        rows = combinations(histogram, w)
        if len(rows):
            for row, count in zip(rows.tolist(), round_counts(solve_counts(rows, histogram), rows, histogram).tolist()):
                for _ in range(count):
                    yield [shelf[length].pop() for length in row if length]
        yield from self._greedy(shelf)

    def _greedy(self, shelf: dict[int, list[Piece]]) -> Iterator[list[Piece]]:
        lengths = sorted(k for k, v in shelf.items() if v)
        left = sum(k * len(shelf[k]) for k in lengths)
        while left >= self.window:
            room, sequence = self.window, []
            while room:
                k = bisect_right(lengths, room) - 1
                length = lengths[max(k, 0)]
                piece = shelf[length].pop()
                if not shelf[length]:
                    lengths.pop(max(k, 0))
                if length > room:  # nothing fits: a cut closes the window
                    document, start, ids, n = piece
                    rest = (document, start + room, ids[4 * room :], n)
                    piece = (document, start, ids[: 4 * room], n)
                    if not shelf[length - room]:
                        insort(lengths, length - room)
                    shelf[length - room].append(rest)
                    length = room
                sequence.append(piece)
                room -= length
            left -= self.window
            yield sequence
        self.rests = [p for k in lengths for p in shelf[k]]

    def finish(self) -> Iterator[list[Piece]]:
        """The last sequences, with a power of two as length each."""
        if sum(len(p[2]) // 4 for p in self.rests) >= self.window:
            yield from self.pack()
        left = sum(len(p[2]) // 4 for p in self.rests)
        queue = self.rests[::-1]
        while left:
            room = 1 << (left.bit_length() - 1)
            left -= room
            sequence = []
            while room:
                document, start, ids, n = queue.pop()
                if len(ids) // 4 > room:
                    queue.append((document, start + room, ids[4 * room :], n))
                    ids = ids[: 4 * room]
                room -= len(ids) // 4
                sequence.append((document, start, ids, n))
            yield sequence
        self.rests = []


class WordTables(NamedTuple):
    """What a task needs of a vocabulary to encode common texts: some 0.8 MB, where the parsed file takes some 25."""

    symbol: np.ndarray  # a byte's id
    last: np.ndarray  # its id at a word's end
    pairs: tuple[np.ndarray, np.ndarray]
    special: list[str]


def word_tables(tokenizer_json: str) -> WordTables:
    spec = json.loads(tokenizer_json)
    model, vocab = spec["model"], spec["model"]["vocab"]
    alphabet = {b: c for c, b in byte_alphabet().items()}
    pairs = {}
    for rank, pair in enumerate(model["merges"]):
        left, right = pair.split(" ") if isinstance(pair, str) else pair
        pairs[vocab[left], vocab[right]] = (rank, vocab[left + right])
    symbol = np.array([vocab[alphabet[b]] for b in range(256)])
    last = np.array([vocab[alphabet[b] + model["end_of_word_suffix"]] for b in range(256)])
    return WordTables(symbol, last, pair_arrays(pairs), [t["content"] for t in spec["added_tokens"]])


class WordIds:
    """Ids of whole texts as the library gives them.

    Texts of common characters, which the normaliser can only lower-case, are
    cut into pre-tokens by the vocabulary's pattern, evaluated over arrays of
    character classes; each distinct pre-token of a block is merged once, all
    of them together.  The library encodes all other texts, and is loaded when
    the first of them comes.
    """

    def __init__(self, tokenizer_json: str, kinds: bytes, tables: WordTables | None = None) -> None:
        self.source = tokenizer_json
        self.symbol, self.last, pairs, self.special = tables or word_tables(tokenizer_json)
        self.merge = BatchMerger(pairs)
        self.kinds = np.frombuffer(kinds, np.uint8)
        # Latin letters, dashes and quotes, and Han characters compose with nothing of their own kind
        self.lower = np.zeros(0x110000, np.uint32)
        for lo, hi in ((0x01, 0x130), (0x131, 0x300), (0x2010, 0x2028), (0x2030, 0x205F), (0x4E00, 0xA000)):
            self.lower[lo:hi] = [ord(chr(c).lower()) for c in range(lo, hi)]

    @cached_property
    def library(self):
        from tokenizers import Tokenizer

        library = Tokenizer.from_str(self.source)
        library.no_truncation()
        library.no_padding()
        return library

    def _starts(self, points: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where pre-tokens start, and where characters belong to any."""
        kind, n = self.kinds[points], len(points)
        inside = kind != SPACE
        start = inside & (first | (kind != np.roll(kind, 1)) | (kind == NUMBER))
        last = np.roll(first, -1)
        quote = np.flatnonzero(start & (points == 39) & ~last)
        if len(quote):
            one = points[quote + 1]
            short = np.isin(one, [ord(c) for c in "stmd"])
            two = np.where(~short & ~last[quote + 1], points[np.minimum(quote + 2, n - 1)], 0)
            long = ((two == ord("e")) & ((one == ord("r")) | (one == ord("v")))) | ((two == ord("l")) & (one == ord("l")))
            start[quote[short | long] + 1] = False
            for hit, width in ((short, 2), (long, 3)):
                ends = quote[hit] + width
                ends = ends[ends < n]
                start[ends] = inside[ends]
        return start, inside

    def _common(self, points: np.ndarray, lengths: np.ndarray) -> list[bytes]:
        ends = np.cumsum(lengths)
        first = np.zeros(len(points) + 1, bool)
        first[ends - lengths] = True
        start, inside = self._starts(points, first[:-1])
        at = np.flatnonzero(start)
        stop = np.flatnonzero(inside & np.concatenate([start[1:] | ~inside[1:] | first[1:-1], [True]])) + 1
        held = np.searchsorted(at, np.concatenate([[0], ends]))
        flat = np.frombuffer(points.astype("<u4", copy=False).tobytes().decode("utf-32-le").encode(), np.uint8)
        width = 1 + (points > 0x7F).astype(np.uint8) + (points > 0x7FF)
        place = np.zeros(len(points) + 1, np.int32 if len(flat) < 1 << 31 else np.int64)
        np.cumsum(width, dtype=place.dtype, out=place[1:])
        lo, hi = place[at].astype(np.int64), place[stop].astype(np.int64)
        del points, first, start, inside, at, stop, width, place  # merging has large arrays of its own
        one, number, _ = distinct_words(flat, lo, hi)
        lo, size = lo[one], (hi - lo)[one]
        symbols = self.symbol[flat[ranges(lo, size)]]
        tails = np.cumsum(size) - 1
        symbols[tails] = self.last[flat[lo + size - 1]]
        ids, counts = self.merge(symbols, size)
        begin = np.cumsum(counts) - counts
        every = ids.astype("<u4")[ranges(begin[number], counts[number])]
        before = np.concatenate([[0], np.cumsum(counts[number])])[held]
        return [every[a:b].tobytes() for a, b in zip(before[:-1].tolist(), before[1:].tolist())]

    def __call__(self, documents: list[str]) -> list[bytes]:
        out = [b""] * len(documents)
        points = [self.lower[np.frombuffer(d.encode("utf-32-le"), np.uint32)] for d in documents]
        common = [k for k, p in enumerate(points) if len(p) and p.all() and not any(s in documents[k] for s in self.special)]
        if common:
            lengths = np.array([len(points[k]) for k in common])
            joined = [np.concatenate([points[k] for k in common])]
            del points
            for k, ids in zip(common, self._common(joined.pop(), lengths)):
                out[k] = ids
        other = [k for k in sorted(set(range(len(documents))) - set(common)) if documents[k]]
        if other:
            for k, code in zip(other, self.library.encode_batch_fast([documents[k] for k in other], add_special_tokens=False)):
                out[k] = np.array(code.ids, "<u4").tobytes()
        return out


SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, window: int = WINDOW, held: int = HELD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids (4 bytes each, little-endian).

    A document's ids are its text's and then ``end_id``; a null or empty text
    has the end id alone.  Repeated rows are packed once each, rows without id
    keep null.  A text of any length is packed whole, in pieces of one window
    and a rest.  Columns other than id and text play no part.  An empty table
    gives no rows.  Sequence ids are unique, not
    gapless; how documents meet in sequences depends on the input's partitions.
    """
    source = Path(tokenizer_path).read_text()
    kinds, tables = character_classes(), word_tables(source)
    tail = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = WordIds(source, kinds, tables)  # kept for the task alone, since a worker goes on to other operators
        packer, sequence_id = Packer(window, held), TaskContext.get().partitionId() << 40
        out: list[tuple] = []

        def ready() -> pa.RecordBatch:
            kinds = [pa.int64()] * 6 + [pa.binary()]
            batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], SCHEMA.replace(" long", "").replace(" binary", "").split(", "))
            out.clear()
            return batch

        def place(sequences: Iterator[list[Piece]]) -> Iterator[pa.RecordBatch]:
            """Batches of about ``SENT`` sequences' pieces; packing what is held gives thousands at once."""
            nonlocal sequence_id
            for sequence in sequences:
                offset = 0
                for document, start, ids, n in sequence:
                    length = len(ids) // 4
                    out.append((document, start, length, n, sequence_id, offset, ids))
                    offset += length
                sequence_id += 1
                if sequence_id % SENT == 0 or len(out) >= HELD:
                    yield ready()

        for batch in batches:
            for part in blocks(batch, limit=BLOCK_BYTES // 2):
                for document, ids in zip(part["doc_id"].to_pylist(), encode(part["text"].to_pylist())):
                    yield from place(packer.add(document, ids + tail))
        yield from place(packer.finish())
        if out:
            yield ready()

    return texts(docs, id_col, text_col).mapInArrow(run, SCHEMA)


def digests(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY)))
