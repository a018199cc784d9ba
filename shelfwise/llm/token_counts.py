"""Token counts of a byte-level BPE vocabulary by a compiled finite-state transducer.

Two deterministic machines stand in a row.  The first cuts a text into
pre-tokens: its lookahead is one character, so it is evaluated in closed form
over arrays of character classes.  The second reads the bytes of a pre-token.
Its state holds what later merges can depend on: for each place from which a
vocabulary entry may still run on, the token that ended there and the count up
to there.  Each transition carries the change of the token count, so the counts
of a text are a plain sum over its bytes.  States are made when first reached
(subset construction on demand) and kept in a dense table; when it is full, it
starts anew, within a text too, with only the states that are in use.

A block of texts is cut into chunks of equal size that run in lock-step, as if
a pre-token started with each.  A chunk's state map sends any entry state to an
exit state and a count; it is the same for all entry states from the first
pre-token start on, and from where a run from the true entry state meets the
first run.  A scan over the chunks then composes the maps: the exit state of one
is the entry state of the next, for which the few bytes up to there are run.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLOCK_BYTES, blocks, segment_sums, table, texts

VOCABULARY = "byte_bpe_50k.json"
CHUNK = 512
#: States of one worker's table; when they are used up, the table starts anew with those in use (at most one a chunk of a block).
MAX_STATES = 240_000

LETTER, NUMBER, OTHER, SPACE = 0, 1, 2, 3


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies, by its usual rule."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


@cache
def character_classes() -> bytes:
    """The class of every code point as the library's byte-level pre-tokenizer treats it: one probe string a class.

    A character that stays joined to letters on both sides is a letter, and so
    on; what joins nothing is white space.
    """
    from tokenizers.pre_tokenizers import ByteLevel

    split = ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    kinds = np.full(0x110000, OTHER, np.uint8)
    #: Planes 4 to 13 have no characters, 15 and 16 are for private use: all of class OTHER.
    points = np.concatenate([np.arange(0xD800), np.arange(0xE000, 0x40000), np.arange(0xE0000, 0xE1000)])
    for lo in range(0, len(points), 50_000):
        part = points[lo : lo + 50_000]
        left = np.ones(len(part), bool)
        for kind, probe in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")):
            text = probe + probe.join(map(chr, part)) + probe
            starts = np.zeros(len(text) + 1, bool)
            starts[[a for _, (a, _) in split(text)]] = True
            at = 1 + 2 * np.arange(len(part))
            joined = ~starts[at] & ~starts[at + 1] & left
            kinds[part[joined]] = kind
            left &= ~joined
        kinds[part[left]] = SPACE
    return kinds.tobytes()


def pre_token_starts(points: np.ndarray, first: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Where pre-tokens start, for the code points of many texts in one array; ``first`` marks the texts' starts."""
    n = len(points)
    kind = kinds[points]
    space, blank = kind == SPACE, points == 32
    last = np.roll(first, -1)  # the next character belongs to another text, or there is none
    before, after = np.roll(kind, 1), np.roll(kind, -1)
    before_blank = np.roll(blank, 1) & ~first
    before_space = np.roll(space, 1) & ~first
    after_word = (after != SPACE) & ~last
    start = first.copy()
    start |= ~space & ~before_space & (kind != before)  # another class
    start |= ~space & before_space & ~before_blank  # after a line break or the like
    start |= space & ~before_space  # a run of white space
    start |= space & after_word  # its last character goes with what follows, or stands alone
    # 's 't 'm 'd 're 've 'll where a pre-token starts
    quote = np.flatnonzero(start & (points == 39) & ~last)
    if len(quote):
        one = points[quote + 1]
        short = np.isin(one, [ord(c) for c in "stmd"])
        can = ~short & ~last[quote + 1]
        two = np.where(can, points[np.minimum(quote + 2, n - 1)], 0)
        long = can & (((two == ord("e")) & ((one == ord("r")) | (one == ord("v")))) | ((one == ord("l")) & (two == ord("l"))))
        start[quote[short | long] + 1] = False
        for hit, width in ((short, 2), (long, 3)):
            ends = quote[hit] + width
            start[ends[ends < n]] = True
    return start


def pairs_of(merges: list, plain) -> list[tuple[bytes, bytes]]:
    return [(plain(a), plain(b)) for a, b in merges]


class Transducer:
    """The machine over the bytes of pre-tokens, with states made on demand."""

    ROOT = 0

    def __init__(self, tokenizer_json: str, max_states: int = MAX_STATES) -> None:
        model = json.loads(tokenizer_json)["model"]
        alphabet = byte_alphabet()
        plain = lambda s: bytes(alphabet[c] for c in s)
        self.tokens = {plain(t) for t in model["vocab"] if all(c in alphabet for c in t)}
        pairs = [p.split(" ") if isinstance(p, str) else p for p in model["merges"]]
        self.rank = {pair: k for k, pair in enumerate(pairs_of(pairs, plain))}
        self.prefixes = {t[:k] for t in self.tokens for k in range(1, len(t) + 1)}
        self.tokens |= {bytes([b]) for b in range(256)}
        self.parts = {a + b: (k, a, b) for k, (a, b) in reversed(list(enumerate(pairs_of(pairs, plain))))}
        self.agree: dict[tuple[bytes, bytes], bool] = {}
        self.max_states, self.full = max_states, False
        self.reset()

    def reset(self) -> None:
        self.keys: list[tuple] = []
        self.ids: dict[tuple, int] = {}
        self.column = np.full(256, -1, np.int64)
        self.width, self.used = 128, 0
        self.table = np.full((4096, self.width), -1, np.int32)
        self._intern((b"", (0, None, 0)))
        self.full = False

    def _intern(self, key: tuple) -> int:
        found = self.ids.get(key)
        if found is None:
            found = self.ids[key] = len(self.keys)
            self.keys.append(key)
            if found >= len(self.table):
                self.table = np.concatenate([self.table, np.full_like(self.table, -1)])
            self.full |= found >= self.max_states
        return found

    def columns(self, flat: np.ndarray) -> np.ndarray:
        """The table's column of each byte; bytes get theirs when first seen."""
        seen = np.flatnonzero(np.bincount(flat, minlength=256))
        for b in seen[self.column[seen] < 0]:
            if self.used == self.width:
                self.table = np.concatenate([self.table, np.full_like(self.table, -1)], axis=1)
                self.width *= 2
            self.column[b] = self.used
            self.used += 1
        return self.column[flat]

    def _adjacent(self, a: bytes, b: bytes) -> bool:
        """Whether tokens a and b can stand side by side: their bytes are encoded as just these two.

        Merges are undone from the last one back, on either side of the border
        between a and b; if at any time the two symbols there can merge before
        the side that is longer comes about, they would have.
        """
        known = self.agree.get((a, b))
        if known is None:
            if len(self.agree) > 400_000:
                self.agree.clear()
            known = self.agree[a, b] = self._stay(a, b)
        return known

    def _stay(self, left: bytes, right: bytes) -> bool:
        """Both sides are merged in the order of ranks, from the left; a merge over the border must never come first."""
        until = 1 << 30  # the symbols at the border stand side by side until the merge of this rank
        after = False  # ... and at that rank, too: of equal ranks the left one is merged first
        while True:
            rank = self.rank.get((left, right))
            if rank is not None and (rank < until or rank == until and after):
                return False
            l_rank, r_rank = (self.parts[x][0] if len(x) > 1 else -1 for x in (left, right))
            if l_rank < 0 and r_rank < 0:
                return True
            if l_rank > r_rank:
                until, after, left = l_rank, False, self.parts[left][2]
            else:  # of two equal merges the left one came first
                until, after, right = r_rank, True, self.parts[right][1]

    def step(self, state: int, byte: int) -> int:
        """Make the transition: the next state times 32, plus 16, plus the change of the count."""
        text, *open_at = self.keys[state]
        add, found, still = bytes([byte]), None, []
        for length, token, count in open_at:
            run = text[len(text) - length :] + add
            if run in self.prefixes or len(run) == 1:
                still.append((length + 1, token, count))
                if found is None and run in self.tokens and (token is None or self._adjacent(token, run)):
                    found = run, count + 1
        token, change = found
        key = (*((length, t, count - change) for length, t, count in still), (0, token, 0))
        longest = max(length for length, _, _ in key)
        state_to = self._intern(((text + add)[len(text) + 1 - longest :], *key))
        return state_to * 32 + 16 + change

    def _renew(self, *live: np.ndarray) -> None:
        """Start the table anew with the states in ``live``, whose numbers are changed there."""
        keys, column, used = self.keys, self.column, self.used
        width = self.width
        self.reset()
        self.column, self.used, self.width = column, used, width
        self.table = np.full((4096, width), -1, np.int32)
        for states in live:
            old, where = np.unique(states, return_inverse=True)
            states[...] = np.array([self._intern(keys[k]) for k in old.tolist()], np.int64)[where].reshape(states.shape)
        self.full = False

    def _run(self, state: np.ndarray, column: np.ndarray, byte: np.ndarray) -> np.ndarray:
        at = state * self.width + column
        moved = self.table.ravel().take(at)
        lacking = np.flatnonzero(moved < 0)
        if len(lacking):
            _, one = np.unique(at[lacking], return_index=True)
            for k in lacking[one]:
                result = self.step(int(state[k]), int(byte[k]))  # may put a larger table in place
                self.table[int(state[k]), int(column[k])] = result
            moved = self.table.ravel().take(at)
        return moved

    def _one(self, state: int, column: int, byte: int) -> int:
        moved = int(self.table[state, column])
        if moved < 0:
            moved = self.step(state, byte)
            self.table[state, column] = moved
        return moved

    def changes(self, flat: np.ndarray, start: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
        """The change of the token count at each byte; ``start`` marks the bytes where pre-tokens start."""
        n = len(flat)
        lanes = -(-n // chunk)
        grid = lambda a, fill: np.ascontiguousarray(np.concatenate([a, np.full(lanes * chunk - n, fill, a.dtype)]).reshape(lanes, chunk).T)
        column, byte, begins = grid(self.columns(flat), 0), grid(flat, 0), grid(start, False)
        out, path = np.zeros((chunk, lanes), np.int8), np.empty((chunk, lanes), np.int32)
        # every chunk as if a pre-token started with it
        state = np.full(lanes, self.ROOT, np.int64)
        for k in range(chunk):
            if self.full:
                self._renew(state)
                path[:k] = -1  # states of the table before
            moved = self._run(np.where(begins[k], self.ROOT, state), column[k], byte[k])
            state = (moved >> 5).astype(np.int64)
            out[k], path[k] = (moved & 31) - 16, state
        # the scan: a chunk's true entry state is followed up to its first start, or to where it meets the first run
        has = begins.any(axis=0)
        head = np.where(has, begins.argmax(axis=0), chunk).tolist()
        for at in np.flatnonzero(~begins[0]).tolist():
            if not at:
                continue
            now, met = int(state[at - 1]), False
            for k in range(head[at]):
                if self.full:
                    live = np.array([now])
                    self._renew(live, state)
                    now = int(live[0])
                    path[:] = -1
                moved = self._one(now, int(column[k, at]), int(byte[k, at]))
                now = moved >> 5
                out[k, at] = (moved & 31) - 16
                if path[k, at] == now:
                    met = True
                    break
            if not met and not has[at]:
                state[at] = now
        return out.T.ravel()[:n]


def counter(tokenizer_json: str, kinds: bytes):
    """A function from lists of texts to arrays of token counts."""
    machine = Transducer(tokenizer_json)
    table_of_kinds = np.frombuffer(kinds, np.uint8)
    special = [t["content"] for t in json.loads(tokenizer_json)["added_tokens"]]
    cuts = re.compile("|".join(re.escape(s) for s in sorted(special, key=len, reverse=True))) if special else None

    def count(documents: list[str]) -> np.ndarray:
        extra = np.zeros(len(documents), np.int64)
        pieces, owner = [], []
        for k, text in enumerate(documents):
            parts = cuts.split(text) if cuts and any(s in text for s in special) else [text]
            extra[k] = len(parts) - 1  # a special string is one token, and texts end there
            for part in parts:
                if part:
                    pieces.append(part)
                    owner.append(k)
        if not pieces:
            return extra
        points = np.frombuffer("".join(pieces).encode("utf-32-le"), np.uint32)
        ends = np.cumsum([len(p) for p in pieces])
        first = np.zeros(len(points), bool)
        first[0] = True
        first[ends[:-1]] = True
        starts = pre_token_starts(points, first, table_of_kinds)
        width = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
        place = np.cumsum(width) - width
        flat = np.frombuffer("".join(pieces).encode(), np.uint8)
        begin = np.zeros(len(flat), bool)
        begin[place[starts]] = True
        bounds = np.concatenate([place, [len(flat)]])[np.concatenate([[0], ends])]
        np.add.at(extra, owner, segment_sums(machine.changes(flat, begin), bounds))
        return extra

    return count


_counters: dict[int, object] = {}


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes and n_tokens of every row, as the tokenizers library counts them for a byte-level BPE file.

    Null and empty texts have no tokens; repeated rows are counted again; the
    order, ids and other columns play no part.  Texts of any length count
    whole, with bounded memory beside the text.  An empty table gives no rows.
    """
    source = Path(tokenizer_path).read_text()
    kinds = character_classes()
    key = hash(source)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counters.get(key) or _counters.setdefault(key, counter(source, kinds))
        for batch in batches:
            for part in blocks(batch, limit=BLOCK_BYTES):
                documents = part["text"].to_pylist()
                yield pa.RecordBatch.from_arrays([part["doc_id"], pc.binary_length(part["text"]).cast(pa.int64()), pa.array(count(documents), pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    return texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY)).withColumn("over_limit", F.col("n_tokens") > 1024)
