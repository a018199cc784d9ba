"""Phrases whose words stand together more often than their parts let expect.

Every word of a corpus begins one sequence: its language, itself and up to
three words that follow it in its piece.  A task sorts the sequences of a shard
and makes them an automaton with counts; it is cut where ranges of sequences
begin, and each range's parts of all shards are united in one task.  Where the
corpus needs more ranges than the driver chooses, each is cut into finer ones
in a second step.  A phrase
occurs as often as sequences begin with it, so one sum over each state's
continuations gives the counts of phrases of all lengths.  A phrase that spans
two ranges is first or last of its length in each, and is summed over them.
Counts of the candidates' parts come from composing the automaton of what is
asked with that of the frequent phrases, bucket by bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .automata import Counts, sorted_symbols, with_own_symbols
from .common import blocks, cut, flat_utf8, hot_keys, table
from .merging import distinct_words

#: Longest phrase in words, least count of a candidate, and how many phrases of a language are reported.
LONGEST, LEAST, TOP = 4, 30, 2000
#: A shard's automaton is cut and sent after so many words; a range gets about so many of all shards' words.
SHARD_WORDS, RANGE_WORDS = 1_000_000, 1_500_000
#: Ranges are chosen from sequences of a sample, so many a document and so many a range; only their balance depends on it.
SAMPLE_WORDS, SAMPLE_RANGE = 32, 16
#: At least so many documents are in the sample, and the driver chooses so many ranges at most; beyond, each is cut once more where it lies.
SAMPLE_DOCS, MAX_RANGES = 2000, 1 << 15
#: What a range is cut by comes from its first parts, until they have so many states.
CUT_STATES = 1_000_000
#: A united automaton is made whenever so many states wait for it.
MERGE_STATES = 4_000_000
#: Rows (asked parts and frequent phrases) of a bucket.
BUCKET_ROWS = 200_000

WORD, SPACE, END = 0, 1, 2
KIND = np.zeros(256, np.uint8)
KIND[list(b" \t")] = SPACE
KIND[list(b".,;:!?\n\x0b\x0c\r")] = END
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_places(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes of all texts, each word's start and end, its piece (ascending) and its text."""
    flat, offsets = flat_utf8(column)
    flat = LOWER[flat]
    kind = KIND[flat]
    inside = kind == WORD
    filled = offsets[:-1] < offsets[1:]
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    first, last = offsets[:-1][filled], offsets[1:][filled] - 1
    begin[first], end[last] = inside[first], inside[last]
    start = np.flatnonzero(begin)
    text = np.searchsorted(offsets, start, side="right") - 1
    piece = np.searchsorted(np.flatnonzero(kind == END), start) + text
    return flat, start, np.flatnonzero(end) + 1, piece, text


class Shard:
    """Words of a few blocks, until they become one automaton."""

    def __init__(self) -> None:
        self.dictionaries: list[pa.Array] = []
        self.words: list[np.ndarray] = []
        self.pieces: list[np.ndarray] = []
        self.langs: list[np.ndarray] = []
        self.names: list[pa.Array] = []
        self.size = self.n_symbols = self.n_pieces = self.n_names = 0

    def add(self, part: pa.RecordBatch) -> None:
        flat, start, end, piece, text = word_places(part["text"])
        if not len(start):
            return
        _, number, dictionary = distinct_words(flat, start, end)
        names = part["lang"].dictionary_encode()
        self.dictionaries.append(dictionary.cast(pa.large_binary()))
        self.words.append((number + self.n_symbols).astype(np.int32))
        self.pieces.append((piece + self.n_pieces).astype(np.int64))
        self.names.append(names.dictionary.cast(pa.binary()).cast(pa.large_binary()))
        self.langs.append((names.indices.to_numpy(zero_copy_only=False)[text] + self.n_names).astype(np.int32))
        self.size += len(start)
        self.n_symbols += len(dictionary)
        self.n_names += len(names.dictionary)
        self.n_pieces += int(piece[-1]) + 1

    def sequences(self, splitters: list[tuple[bytes, ...]]) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
        """Symbols in byte order, the distinct sequences in order, how often each occurs, and before which each splitter stands."""
        extra = pa.array([s for x in splitters for s in x], pa.large_binary())
        symbols, place = sorted_symbols(pa.concat_arrays([*self.dictionaries, *self.names, extra]))
        word = place[np.concatenate(self.words)] + 1  # 0 is no word
        lang = place[self.n_symbols + np.concatenate(self.langs)]
        piece = np.concatenate(self.pieces)
        n, r = len(word), len(splitters)
        columns = np.zeros((LONGEST + 1, n + r), np.int64)
        columns[0, :n], columns[1, :n] = lang, word
        for k in range(1, LONGEST):
            same = piece[k:] == piece[:-k]
            columns[k + 1, : n - k][same] = word[k:][same]
        at = self.n_symbols + self.n_names
        for j, x in enumerate(splitters):
            columns[: len(x), n + j] = place[at : at + len(x)]
            columns[1 : len(x), n + j] += 1
            at += len(x)
        # ranks of the first three and of the last two columns, in one number
        head = columns[0]
        for c in columns[1:3]:
            keys, head = np.unique(head << 32 | c, return_inverse=True)
        heads = keys
        tails, tail = np.unique(columns[3] << 32 | columns[4], return_inverse=True)
        both = head << 32 | tail
        keys = np.sort(both[:n])
        new = np.ones(n, bool)
        new[1:] = keys[1:] != keys[:-1]
        first = np.flatnonzero(new)
        keys, counts = keys[first], np.diff(np.append(first, n))
        bounds = np.searchsorted(keys, both[n:])
        # back to columns: any row of a head or tail gives its symbols
        one_head, one_tail = np.zeros(len(heads), np.int64), np.zeros(len(tails), np.int64)
        one_head[head], one_tail[tail] = np.arange(n + r), np.arange(n + r)
        rows = np.concatenate([columns[:3, one_head[keys >> 32]], columns[3:, one_tail[keys & 0xFFFFFFFF]]]).T
        rows[:, 1:] -= 1
        return symbols, rows, counts, bounds


def prepared(docs: DataFrame) -> DataFrame:
    """(lang, text): a null language as ``und``, a null text as the empty one; other columns play no part."""
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def boundaries(docs: DataFrame, partitions: int, range_words: int = RANGE_WORDS, most: int = MAX_RANGES) -> tuple[list[tuple[bytes, ...]], int]:
    """Sequences at which ranges begin, so that each holds about ``range_words`` words, and into how many finer ones each must be cut (1: none).

    A sample of the documents tells.  The driver gets some SAMPLE_RANGE
    sequences a range, so at most about ``most`` * SAMPLE_RANGE of them.
    """

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch):
                flat, start, end, piece, text = word_places(part["text"])
                n = np.bincount(text, minlength=part.num_rows)
                langs, keys, weights, at = part["lang"].to_pylist(), [], [], 0
                for k, words in enumerate(n.tolist()):
                    for i in range(at, at + words, -(-words // SAMPLE_WORDS) or 1):
                        stop = i + 1
                        while stop < at + words and stop < i + LONGEST and piece[stop] == piece[i]:
                            stop += 1
                        keys.append([langs[k].encode(), *(flat[start[j] : end[j]].tobytes() for j in range(i, stop))])
                        weights.append(float(-(-words // SAMPLE_WORDS)))
                    at += words
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.list_(pa.binary())), pa.array(weights, pa.float64())], ["key", "weight"])

    n = docs.count()

    def drawn(size: int) -> tuple[list, float]:
        share = min(1.0, size / max(1, n))
        rows = prepared(docs).sample(share, seed=11).mapInArrow(some, "key array<binary>, weight double").toArrow()
        found = sorted(zip((tuple(k) for k in rows["key"].to_pylist()), rows["weight"].to_pylist()))
        return found, sum(w for _, w in found) / share

    found, words = drawn(SAMPLE_DOCS)
    wanted = max(partitions, int(words / range_words) + 1)
    ranges = min(wanted, most)
    if ranges * SAMPLE_RANGE > SAMPLE_DOCS * SAMPLE_WORDS:
        found, _ = drawn(ranges * SAMPLE_RANGE // SAMPLE_WORDS)
    up_to = list(accumulate(w for _, w in found))
    at = np.searchsorted(up_to, up_to[-1] * np.arange(1, ranges) / ranges) if found else []
    return sorted({found[min(k, len(found) - 1)][0] for k in at}), -(-wanted // ranges)


def frequent_phrases(docs: DataFrame, least: int = LEAST, shard_words: int = SHARD_WORDS, range_words: int = RANGE_WORDS, most: int = MAX_RANGES) -> DataFrame:
    """(lang, words, phrase, f): all phrases of 1 to LONGEST words with f of at least ``least``; with 0 words, a language's number of words."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    splitters, fine = boundaries(docs, partitions, range_words, most)
    ranges = len(splitters) + 1

    def cut_up(shard: Shard) -> Iterator[pa.RecordBatch]:
        symbols, rows, counts, bounds = shard.sequences(splitters)
        edges = [0, *bounds.tolist(), len(rows)]
        for k, (lo, hi) in enumerate(zip(edges, edges[1:])):
            if hi > lo:
                data = with_own_symbols(symbols, rows[lo:hi], counts[lo:hi]).dump()
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([data], pa.binary())], ["range", "data"])
        pa.default_memory_pool().release_unused()

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard()
        for batch in batches:
            for part in blocks(batch):
                shard.add(part)
                if shard.size >= shard_words:
                    yield from cut_up(shard)
                    shard = Shard()
        if shard.size:
            yield from cut_up(shard)

    def finer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Cuts the parts of one range at sequences that its first parts give; they come in a fixed order, so a repeated task cuts alike."""
        first, states, cuts = [], 0, None

        def give(part: Counts) -> Iterator[pa.RecordBatch]:
            for k, piece in part.cut(cuts):
                yield pa.RecordBatch.from_arrays([pa.array([number * fine + k], pa.int64()), pa.array([piece.dump()], pa.binary())], ["range", "data"])

        def chosen() -> list[tuple[bytes, ...]]:
            together = Counts.union(first)
            rows, counts = together.sequences()
            at = np.unique(np.searchsorted(np.cumsum(counts), counts.sum() * np.arange(1, fine) / fine))
            return [tuple(together.symbols[int(x)].as_py() for x in rows[k] if x >= 0) for k in at]

        for batch in batches:
            for k in range(batch.num_rows):
                number, part = batch["range"][k].as_py(), Counts.load(batch["data"][k].as_py())
                if cuts is None:
                    first.append(part)
                    states += sum(map(len, part.label))
                    if states >= CUT_STATES:
                        cuts = chosen()
                        for x in first:
                            yield from give(x)
                        first.clear()
                else:
                    yield from give(part)
        if first:
            cuts = chosen()
            for x in first:
                yield from give(x)

    def united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The parts of a range stand one after the other."""
        waiting, states, limit, now = [], 0, MERGE_STATES, None
        for batch in batches:
            for k in range(batch.num_rows):
                number = batch["range"][k].as_py()
                if waiting and number != now:
                    yield from _reported(Counts.union(waiting), least)
                    waiting, states, limit = [], 0, MERGE_STATES
                now = number
                waiting.append(Counts.load(batch["data"][k].as_py()))
                states += sum(map(len, waiting[-1].label))
                if states > limit:
                    waiting = [Counts.union(waiting)]
                    states = sum(map(len, waiting[0].label))
                    limit = max(MERGE_STATES, 2 * states)
        if waiting:
            yield from _reported(Counts.union(waiting), least)

    parts = prepared(docs).mapInArrow(shards, "range long, data binary").repartitionById(ranges, F.col("range").cast("int"))
    if fine > 1:
        cut_again = parts.sortWithinPartitions("data").mapInArrow(finer, "range long, data binary")
        parts = cut_again.repartition(max(partitions, min(ranges * fine, 8 * ranges)), "range").sortWithinPartitions("range")
    found = parts.mapInArrow(united, "lang string, words int, phrase string, f long")
    return found.groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f")).where((F.col("words") == 0) | (F.col("f") >= least))


def _reported(counts: Counts, least: int) -> Iterator[pa.RecordBatch]:
    """Phrases of a range: the frequent ones, and the first and last of each length, of which other ranges may hold a part."""
    for d, weight in enumerate(counts.weights()):
        keep = weight >= (least if d else 0)
        keep[:1], keep[-1:] = True, True
        states = np.flatnonzero(keep)
        for lo in range(0, len(states), 1 << 16):
            part = states[lo : lo + (1 << 16)]
            columns = [counts.symbols.take(pa.array(c)) for c in counts.paths(d, part).T]
            space = pa.scalar(b" ", pa.large_binary())
            phrase = pc.binary_join_element_wise(*columns[1:], space) if d else pa.array([b""] * len(part), pa.large_binary())
            lang, phrase = (x.cast(pa.large_string()).cast(pa.string()) for x in (columns[0], phrase))
            yield pa.RecordBatch.from_arrays([lang, pa.array(np.full(len(part), d, np.int32)), phrase, pa.array(weight[part])], ["lang", "words", "phrase", "f"])


def _sequence_rows(lang: pa.ChunkedArray, phrase: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Symbols, the distinct sequences (language, words) in order, and the place of each row among them."""
    phrase = phrase.combine_chunks().cast(pa.large_string())
    words = pc.split_pattern(phrase, " ")
    lengths = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    names = lang.combine_chunks().cast(pa.large_string())
    symbols, place = sorted_symbols(pa.concat_arrays([x.cast(pa.large_binary()) for x in (names, words.flatten())]))
    rows = np.full((len(lengths), LONGEST + 1), -1, np.int64)
    rows[:, 0] = place[: len(names)]
    rows[:, 1:][np.arange(LONGEST)[None, :] < lengths[:, None]] = place[len(names) :]
    order = np.lexsort(rows.T[::-1])
    ordered = rows[order]
    new = np.ones(len(rows), bool)
    new[1:] = (ordered[1:] != ordered[:-1]).any(axis=1)
    number = np.empty(len(rows), np.int64)
    number[order] = np.cumsum(new) - 1
    return symbols, ordered[new], number


def looked_up(asked: pa.Table, known: pa.Table) -> pa.Table:
    """``asked`` (lang, phrase, a, side, part) with f, the count of its part: both as automata, composed."""
    if not len(asked):
        return pa.table({c: asked[c] for c in ("lang", "phrase", "a", "side")} | {"f": pa.array([], pa.int64())})
    symbols, rows, number = _sequence_rows(known["lang"], known["part"])
    weights = np.zeros(len(rows), np.int64)
    weights[number] = known["f"].to_numpy()
    transducer = Counts.of_sorted(symbols, rows, weights)
    symbols, rows, number = _sequence_rows(asked["lang"], asked["part"])
    acceptor = Counts.of_sorted(symbols, rows, np.ones(len(rows), np.int64))
    # here each phrase is a sequence of its own: what ends in a state is its count
    given = transducer.compose(acceptor, transducer.ends)
    lengths, f = (rows >= 0).sum(axis=1), np.zeros(len(rows), np.int64)
    for d, values in enumerate(given):
        f[lengths == d + 1] = values[acceptor.ends[d] > 0]
    return pa.table({c: asked[c] for c in ("lang", "phrase", "a", "side")} | {"f": pa.array(f[number])})


def part_counts(asked: DataFrame, frequent: DataFrame) -> DataFrame:
    """``asked`` (lang, phrase, a, side, part) with the count of each part; parts that are asked very often are dealt over several tasks."""
    spark, total = asked.sparkSession, asked.count()
    hot = hot_keys(asked.groupBy("lang", "part").agg(F.count(F.lit(1)).alias("n")), ["lang", "part"], "n", total)
    known = frequent.where("words > 0").select(F.col("lang").alias("lang"), F.col("phrase").alias("part"), F.col("f").alias("f"))
    if hot is None:
        asked, known = (x.withColumn("deal", F.lit(0).cast("long")) for x in (asked, known))
    else:
        parts = F.coalesce("_parts", F.lit(1)).cast("long")
        asked = asked.join(F.broadcast(hot), ["lang", "part"], "left").withColumn("deal", F.pmod(F.xxhash64("phrase"), parts)).drop("_parts")
        known = known.join(F.broadcast(hot), ["lang", "part"], "left").withColumn("deal", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop("_parts")
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // BUCKET_ROWS + 1)
    bucket = F.pmod(F.xxhash64("lang", "part", "deal"), F.lit(buckets)).alias("bucket")
    left, right = asked.select(bucket, *(F.col(c).alias(c) for c in ("lang", "phrase", "a", "side", "part"))), known.select(bucket, "lang", "part", "f")
    return left.groupBy("bucket").cogroup(right.groupBy("bucket")).applyInArrow(looked_up, "lang string, phrase string, a long, side int, f long")


def _wide(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(20,0)")


def mine(docs: DataFrame, least: int = LEAST, top: int = TOP, shard_words: int = SHARD_WORDS, range_words: int = RANGE_WORDS, most: int = MAX_RANGES) -> DataFrame:
    """The ``top`` collocations of each language: lang, rank, phrase, a, l, r, n, score, and k, the words before the cut.

    Whole texts count, however long; a null text is the empty one, a null
    language ``und``.  Rows that repeat are documents of their own.  A language
    without a candidate, and an empty table, give no rows.  Equal scores are
    ranked by a, then by the phrase's bytes.  Columns other than text and lang
    play no part.
    """
    frequent = cut(frequent_phrases(docs, least, shard_words, range_words, most))
    candidates = frequent.where("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"))
    words = F.split("phrase", " ")
    piece = lambda first, n: F.array_join(F.slice(words, first, n), " ")
    inner = {n: F.array(*(piece(at, m) for m in range(2, n) for at in range(1, n - m + 2))) for n in range(3, LONGEST + 1)}
    shorter = candidates.where("words > 2").select("lang", F.explode(F.coalesce(*(F.when(F.col("words") == n, x) for n, x in inner.items()))).alias("phrase"), "a")
    longest = shorter.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = candidates.join(longest, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (F.lit(100) * _wide("longer") < F.lit(80) * _wide("a")))
    sides = {n: F.array(*(F.struct(F.lit(2 * k + s).alias("side"), p.alias("part")) for k in range(1, n) for s, p in enumerate((piece(1, k), piece(k + 1, n - k))))) for n in range(2, LONGEST + 1)}
    asked = kept.select("lang", "phrase", "a", F.explode(F.coalesce(*(F.when(F.col("words") == n, x) for n, x in sides.items()))).alias("x")).select("lang", "phrase", "a", "x.side", "x.part")
    counted = part_counts(asked, frequent).groupBy("lang", "phrase", "a").pivot("side", list(range(2, 2 * LONGEST))).agg(F.max("f"))
    cuts = [
        F.when(F.col(str(2 * k)).isNotNull(), F.struct(F.expr(f"CAST(a AS DECIMAL(20,0)) * 2000000 DIV (CAST(`{2 * k}` AS DECIMAL(20,0)) + `{2 * k + 1}`)").alias("score"), F.lit(k).alias("k"), F.col(str(2 * k)).alias("l"), F.col(str(2 * k + 1)).alias("r")))
        for k in range(1, LONGEST)
    ]
    scored = counted.select("lang", "phrase", "a", F.array_min(F.array_compact(F.array(*cuts))).alias("c")).select("lang", "phrase", "a", "c.*")
    # the best of a language within each deal first: no task ranks a whole language
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    deal = F.pmod(F.xxhash64("phrase"), F.lit(64))
    some = scored.withColumn("deal", deal).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "deal").orderBy(*order))).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    totals = frequent.where("words = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "k")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM t),
g AS (SELECT lang, words, array_to_string(w[i:i+words-1], ' ') AS phrase FROM (SELECT lang, w, words, unnest(range(1, len(w) - words + 2)) AS i FROM p, (SELECT unnest([1, 2, 3, 4]) AS words) WHERE len(w) >= words)),
f AS (SELECT lang, words, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 30),
n AS (SELECT lang, count(*) AS n FROM g WHERE words = 1 GROUP BY lang),
c AS (SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE words > 1),
u AS (SELECT lang, array_to_string(w[i:i+m-1], ' ') AS phrase, max(a) AS longer FROM (SELECT lang, w, a, m, unnest(range(1, len(w) - m + 2)) AS i FROM c, (SELECT unnest([2, 3]) AS m) WHERE m < len(w)) GROUP BY ALL),
k AS (SELECT c.*, unnest(range(1, words)) AS k FROM c LEFT JOIN u USING (lang, phrase) WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a),
s AS (SELECT k.lang, k.phrase, k.a, k.k, x.f AS l, y.f AS r, (2000000::HUGEINT * k.a) // (x.f + y.f) AS score FROM k
  JOIN f x ON x.lang = k.lang AND x.phrase = array_to_string(k.w[1:k.k], ' ') JOIN f y ON y.lang = k.lang AND y.phrase = array_to_string(k.w[k.k+1:], ' ')),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS o FROM s) WHERE o = 1)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score, CAST(k AS INT) AS k
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b) JOIN n USING (lang) WHERE rank <= 2000
"""
