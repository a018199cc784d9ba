"""SentencePiece encoding and decoding for merge-type vocabularies.

The encoder is the agenda algorithm: all adjacent symbol pairs that the
vocabulary can merge wait by score, then by place; the best pair is merged and
its new neighbours join the agenda.  No entry of such a vocabulary holds the
word mark after another character, so no merge crosses the start of a word, and
each distinct word of a block (with the marks before it) is encoded once; the
agendas of many words advance together, a merge a round (``BatchMerger``).  A
round costs as much as the word is long, so words over ``HEAP_LENGTH``
characters get an agenda of their own, a heap.
Words that a worker hasn't met before are checked against the sentencepiece
library, in batches; its ids would be used if they differed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import blocks, segment_sums, table, texts
from .merging import BatchMerger, distinct_words

VOCABULARY = "piece_bpe_32k.model"
MARK = "▁"
#: A worker remembers the ids of so many words, by their bytes; longer words than this aren't remembered.
REMEMBERED = 400_000
LONG_BYTES = 256
#: Words of more characters than this are encoded one by one over a heap.
HEAP_LENGTH = 256


class AgendaEncoder:
    """Ids of texts by merging adjacent pairs in the order of their scores."""

    def __init__(self, model: bytes, check: bool = True) -> None:
        from sentencepiece import SentencePieceProcessor

        self.library, self.check = SentencePieceProcessor(model_proto=model), check
        size = self.library.get_piece_size()
        kind = lambda k: self.library.is_control(k) or self.library.is_unknown(k) or self.library.is_byte(k) or self.library.is_unused(k)
        self.pieces = [self.library.id_to_piece(k) for k in range(size)]
        #: (minus the score, id) of each entry that merges can give
        self.scores = {p: (-self.library.get_score(k), k) for k, p in enumerate(self.pieces) if not kind(k)}
        if any(MARK in p.lstrip(MARK) for p in self.scores):
            raise ValueError("the vocabulary has entries that run across words")
        self.bytes = [self.library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.byte_of = {k: bytes([b]) for b, k in enumerate(self.bytes)}
        self.surface = [p.replace(MARK, " ") for p in self.pieces]
        order = {s: rank for rank, s in enumerate(sorted({s for s, _ in self.scores.values()}))}
        pairs = {}
        for p, (s, k) in self.scores.items():
            for j in range(1, len(p)):
                if p[:j] in self.scores and p[j:] in self.scores:
                    pairs[self.scores[p[:j]][1], self.scores[p[j:]][1]] = (order[s], k)
        self.merge = BatchMerger(pairs)
        self.symbol = -2 - np.arange(0x110000)  # characters outside the vocabulary: kept apart, bytes later
        for p, (_, k) in self.scores.items():
            if len(p) == 1:
                self.symbol[ord(p)] = k
        self.symbol[32] = self.symbol[ord(MARK)]
        self.decimal = [str(k) for k in range(size)]
        self.known: dict[bytes, tuple[int, str, str]] = {}
        self.differing = 0

    def word(self, text: str) -> list[int]:
        """The agenda: (score, place, length of both) of mergeable neighbours; entries whose symbols have changed are passed over."""
        text = text.replace(" ", MARK)
        scores, symbols, n = self.scores, list(text), len(text)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = [(s[0], k, 2) for k in range(n - 1) if (s := scores.get(text[k : k + 2]))]
        heapify(agenda)
        while agenda:
            _, k, length = heappop(agenda)
            right = after[k]
            if not symbols[k] or right >= n or len(symbols[k]) + len(symbols[right]) != length:
                continue
            symbols[k] += symbols[right]
            symbols[right] = ""
            after[k] = nxt = after[right]
            if nxt < n:
                before[nxt] = k
                if s := scores.get(joined := symbols[k] + symbols[nxt]):
                    heappush(agenda, (s[0], k, len(joined)))
            if (left := before[k]) >= 0 and (s := scores.get(joined := symbols[left] + symbols[k])):
                heappush(agenda, (s[0], left, len(joined)))
        ids: list[int] = []
        for symbol in symbols:
            if symbol:
                if s := scores.get(symbol):
                    ids.append(s[1])
                else:
                    ids += [self.bytes[b] for b in symbol.encode()]
        return ids

    def decode(self, ids: list[int]) -> str:
        """The text of ids, with a blank for every mark; runs of byte entries are UTF-8."""
        if self.byte_of.keys().isdisjoint(ids):
            return "".join([self.surface[k] for k in ids])
        return b"".join([self.byte_of.get(k) or self.surface[k].encode() for k in ids]).decode("utf-8", "replace")

    def _encode(self, words: list[str]) -> list[list[int]]:
        batch = iter(self._encode_many([w for w in words if len(w) <= HEAP_LENGTH]))
        return [next(batch) if len(w) <= HEAP_LENGTH else self.word(w) for w in words]

    def _encode_many(self, words: list[str]) -> list[list[int]]:
        flat = self.symbol[np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)]
        ids, counts = self.merge(flat, np.fromiter(map(len, words), np.int64, len(words)))
        odd = np.unique(np.repeat(np.arange(len(words)), counts)[ids < 0]).tolist()
        ends, ids = np.cumsum(counts).tolist(), ids.tolist()
        out = [ids[a:b] for a, b in zip([0, *ends[:-1]], ends)]
        for k in odd:
            out[k] = [j for i in out[k] for j in ([i] if i >= 0 else [self.bytes[b] for b in chr(-2 - i).encode()])]
        return out

    def _entries(self, words: list[str]) -> list[tuple[int, str, str]]:
        """(how many ids, the ids in decimal, decoded text) of new words, after a look at the library's ids."""
        found = self._encode(words)
        if self.check:  # the library puts a mark before every text but the empty one
            some = [k for k, w in enumerate(words) if w not in (MARK, " ")]
            for k, ids in zip(some, self.library.encode([words[k][1:] for k in some], num_threads=1)):
                if ids != found[k]:
                    self.differing += 1
                    found[k] = ids
        name = self.decimal.__getitem__
        return [(len(ids), ",".join(map(name, ids)), self.decode(ids)) for ids in found]

    def __call__(self, documents: list[str]) -> list[tuple[int, str, str]]:
        """(n_tokens, decimal ids joined by commas, decoded text) of each document."""
        marked = [" " + d if d else "" for d in documents]
        whole = "".join(marked)
        points = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        ends = np.cumsum([len(m) for m in marked])
        first = np.zeros(len(points) + 1, bool)
        first[ends[np.array([len(m) for m in marked]) > 0]] = True
        first[0] = True
        mark = (points == 32) | (points == ord(MARK))
        at = np.flatnonzero(first[:-1] | (mark & ~np.roll(mark, 1)))
        if not len(points):
            return [(0, "", "") for _ in documents]
        stop = np.concatenate([at[1:], [len(points)]])
        width = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
        place = np.concatenate([[0], np.cumsum(width)])
        _, number, words = distinct_words(np.frombuffer(whole.encode(), np.uint8), place[at], place[stop])
        words = words.to_pylist()
        if len(self.known) > REMEMBERED:
            self.known.clear()
        entries = [self.known.get(word) for word in words]
        new = [k for k, entry in enumerate(entries) if entry is None]
        for k, entry in zip(new, self._entries([words[k].decode() for k in new])):
            entries[k] = entry
            if len(words[k]) <= LONG_BYTES:
                self.known[words[k]] = entry
        counts, text, shown = zip(*entries)
        sizes = np.array(counts, np.int64)[number]
        cuts = np.searchsorted(at, np.concatenate([[0], ends]))
        totals, number = segment_sums(sizes, cuts).tolist(), number.tolist()
        out = []
        for n, a, b in zip(totals, cuts[:-1].tolist(), cuts[1:].tolist()):
            mine = number[a:b]
            out.append((n, ",".join([text[k] for k in mine]), "".join([shown[k] for k in mine])[1:]))
        return out


_encoders: dict[int, AgendaEncoder] = {}


def encode_decode(docs: DataFrame, model_path: str, check: bool = True, digest: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids (decimal, joined by commas) and decoded text of every row; with ``digest``, SHA-256 of the last two.

    Equal to the sentencepiece library without begin and end ids.  A null or
    empty text has no ids; repeated rows are encoded again; texts of any length
    count whole; ids and other columns play no part.  An empty table gives no
    rows.
    """
    model = Path(model_path).read_bytes()
    key = hash((model, check))
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] if digest else ["doc_id", "n_tokens", "ids", "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoders.get(key) or _encoders.setdefault(key, AgendaEncoder(model, check))
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for batch in batches:
            for part in blocks(batch):
                found = encode(part["text"].to_pylist())
                ids, decoded = [f[1] for f in found], [f[2] for f in found]
                if digest:
                    ids, decoded = map(sha, ids), map(sha, decoded)
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array([f[0] for f in found], pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())], names)

    return texts(docs, id_col, text_col).mapInArrow(run, f"doc_id long, n_tokens long, {names[2]} string, {names[3]} string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), digest=True)
