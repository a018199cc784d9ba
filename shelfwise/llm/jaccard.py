"""Exact n-gram Jaccard join by partitioning the universe of shingles.

Documents are sets of word shingles, each known by a 128-bit digest of its
words; sets link when their Jaccard similarity is at least T.  Two sets of sizes a <= c that link differ in at most
(1 - T) / (1 + T) * (a + c) shingles, which is at most H for all pairs whose
smaller set lies in one size band.  A hash deals all shingles to m segments.
A segment either indexes its subset alone (it finds partners that don't differ
there) or also all subsets with one shingle left out (partners that differ in
one).  If the first kind counts 1 and the second 2 and the sum over the
segments is H + 1, then by the pigeonhole principle every pair that links
shares a signature.  ``allocate`` chooses the mix of each band by cost.  A set
emits signatures for its own band and, as the larger one of a pair, for the
band below.

Sets with equal shingles form classes first, and only class representatives
are joined.  A signature's bucket is not expanded into pairs.  First every
member meets the smallest, then the largest member, candidates are verified
exactly, and the links found are closed into components.  Then only members
outside a bucket's main component meet the members of other components.
A pair is dropped before verification only where it cannot link: by the
sets' sizes, or by more differing bits of their parity sketches (each shingle
flips one of 512 bits, and in sets of more than 512 also one of a number of
bits that grows with the set) than they may differ in shingles.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import KEYS, bit_arrays, blocks, cut, flat_utf8, frequent, fresh, has_bit, hot_keys, mix64, segment_sums, spread_join, table, texts, word_hashes
from .merging import ranges

WORDS = 3
#: T = NUM / DEN
NUM, DEN = 90, 100
SKETCH_LONGS = 8
#: Tasks shingle blocks of about so many bytes of text.
SHINGLE_BYTES = 1 << 18


def bands(limit: int, num: int = NUM, den: int = DEN) -> np.ndarray:
    """Upper ends of the size bands: the next end is the largest size that can link with any in the band, at least one more."""
    ends = [1]
    while ends[-1] < limit:
        ends.append(max(ends[-1] + 1, ends[-1] * den // num))
    return np.array(ends)


#: One-deletion neighbourhoods are considered only for segments of so many shingles, which are hardly ever empty.
DELETION_SIZE = 12


def allocate(lower: int, upper: int, num: int = NUM, den: int = DEN) -> tuple[int, int, int]:
    """(segments, how many of them also index one-deletion neighbourhoods, spare) for a band whose smaller sets have ``lower`` to ``upper`` shingles.

    The cost of a choice is its signatures and, for each segment, the chance
    partners it would find; those fall quickly with the shingles in a segment.

    Empty segments would tie unrelated sets together.  With ``spare`` segments
    more than the pigeonhole principle needs, ``spare + 1`` segments of a
    linked pair are equal.  So a set with at most ``spare`` empty segments
    needs no signature of them: one of the equal ones isn't empty.  Only the
    very few sets with more empty segments index those, too.
    """
    larger = upper * den // num
    differ = (den - num) * (upper + larger) // (den + num)
    if differ == 0:
        return 0, 0, 0  # only equal sets link
    best = None
    for deletions in range((differ + 1) // 2 + 1):
        segments = differ + 1 - deletions
        size = larger / segments
        if deletions and lower / segments < DELETION_SIZE:
            break
        cost = (segments - deletions) * (1 + 64 * 2.0 ** -size) + deletions * (1 + size) * (1 + 64 * 2.0 ** -(size - 1))
        if best is None or cost < best[0]:
            best = (cost, segments, deletions)
    _, segments, deletions = best
    spare = 0
    if not deletions:
        for _ in range(3):  # more segments are smaller, so more of them are empty
            mean = (segments + spare) * (1 - 1 / (segments + spare)) ** lower if segments + spare > 1 else 0.0
            spare = int(np.ceil(mean + 3 * mean**0.5))
    return segments + spare, deletions, spare


class Shingler:
    """Shingle sets of many texts at once, as distinct 128-bit digests in two arrays."""

    def __init__(self, words: int = WORDS) -> None:
        self.words = words
        low = np.arange(256, dtype=np.uint8)
        low[65:91] += 32
        self.low = low
        blank = np.zeros(256, bool)
        blank[[32, *range(9, 14)]] = True
        self.blank = blank

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Both halves of all sets' digests, and each text's size; shorter texts have one shingle, those without words none."""
        flat, offsets = flat_utf8(column)
        flat = self.low[flat]
        inside = ~self.blank[flat]
        begins = np.zeros(len(flat) + 1, bool)
        begins[offsets[:-1]] = True
        before = np.concatenate([[False], inside[:-1]]) if len(flat) else inside
        start = np.flatnonzero(inside & (begins[:-1] | ~before))
        end = np.flatnonzero(inside & np.concatenate([begins[1:-1] | ~inside[1:], [True]])) + 1 if len(flat) else start
        halves = word_hashes(flat, start, end)
        bounds = np.searchsorted(start, offsets)
        n = np.diff(bounds)
        owner = np.repeat(np.arange(len(n)), n)
        # a shingle starts at each word that has enough after it, or at the first one of a short text
        place = np.arange(len(start)) - bounds[:-1][owner]
        starts = np.flatnonzero((place + self.words <= n[owner]) | (place == 0))
        left = (n[owner] - place)[starts]  # words from there on
        codes = [np.zeros(len(starts), np.uint64) for _ in halves]
        for k in range(self.words):
            have = np.flatnonzero(left > k)
            for code, half, (key, other) in zip(codes, halves, KEYS):
                code[have] = mix64((code[have] ^ half[starts[have] + k]) * key + other)
        first, second, owner = *codes, owner[starts]
        order = np.lexsort((first, owner))
        same = (first[order][1:] == first[order][:-1]) & (owner[order][1:] == owner[order][:-1])
        if (same & (second[order][1:] != second[order][:-1])).any():  # half a digest in common
            order = np.lexsort((second, first, owner))
        first, second, owner = first[order], second[order], owner[order]
        keep = np.ones(len(first), bool)
        keep[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1]) | (owner[1:] != owner[:-1])
        return first[keep], second[keep], np.bincount(owner[keep], minlength=len(n))


class Signer:
    """Class hashes, sketches and signatures of shingle sets."""

    def __init__(self, num: int = NUM, den: int = DEN) -> None:
        self.num, self.den = num, den
        self.ends = bands(1 << 10, num, den)
        self._plan()

    def _grow(self, size: int) -> None:
        if self.ends[-1] >= size:
            return
        while self.ends[-1] < size:
            self.ends = bands(int(self.ends[-1]) * 4, self.num, self.den)
        self._plan()

    def _plan(self) -> None:
        lower = [1, *(self.ends[:-1] + 1)]
        self.plans = [allocate(int(a), int(b), self.num, self.den) for a, b in zip(lower, self.ends)]

    def classes(self, first: np.ndarray, second: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A 128-bit digest of every set, a sum over its shingles' digests each."""
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        parts = (mix64(first ^ mix64(second + np.uint64(0x51))), mix64(second ^ mix64(first + np.uint64(0xA7))))
        return tuple(mix64(segment_sums(p, offsets, np.uint64)).astype(np.int64) for p in parts)

    def sketches(self, code: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        owner = np.repeat(np.arange(len(sizes)), sizes)
        bit = (mix64(code + np.uint64(0x3C)) & np.uint64(64 * SKETCH_LONGS - 1)).astype(np.int64)
        odd = np.bincount(owner * 64 * SKETCH_LONGS + bit, minlength=len(sizes) * 64 * SKETCH_LONGS).astype(np.uint8) & 1
        return np.packbits(odd.reshape(len(sizes), -1), axis=1, bitorder="little").view("<i8")

    def wide_sketches(self, code: np.ndarray, sizes: np.ndarray) -> pa.Array:
        """Lists of longs with one bit or more for each shingle, always a power of two; empty for sets that SKETCH_LONGS can tell apart."""
        least = 2 * SKETCH_LONGS
        longs = np.where(sizes > 64 * SKETCH_LONGS, 2 ** np.ceil(np.log2(np.maximum(sizes / 64, least))).astype(np.int64), 0)
        offsets, begin = np.cumsum(sizes) - sizes, np.cumsum(longs) - longs
        out = np.zeros(int(longs.sum()), np.int64)
        for n in np.unique(longs[longs > 0]).tolist():
            sets = np.flatnonzero(longs == n)
            owner = np.repeat(np.arange(len(sets)), sizes[sets])
            bit = (mix64(code[ranges(offsets[sets], sizes[sets])] + np.uint64(0x3C)) & np.uint64(64 * n - 1)).astype(np.int64)
            odd = np.bincount(owner * 64 * n + bit, minlength=len(sets) * 64 * n).astype(np.uint8) & 1
            out[ranges(begin[sets], longs[sets])] = np.packbits(odd, bitorder="little").view("<i8")
        return _lists(out, longs)

    def signatures(self, code: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All signatures, and how many each set has."""
        self._grow(int(sizes.max(initial=1)))
        own = np.searchsorted(self.ends, sizes)
        offsets = np.cumsum(sizes) - sizes
        parts, owners = [], []
        segment_hash, term = mix64(code + np.uint64(0xE1)), mix64(code + np.uint64(0x77))
        for step in (0, 1):  # as the smaller set of a pair, and as the larger one
            band = own - step
            for b in np.unique(band[(band >= 0) & (sizes > 0)]).tolist():
                segments, deletions, spare = self.plans[b]
                if not segments:
                    continue
                sets = np.flatnonzero((band == b) & (sizes > 0))
                rows = ranges(offsets[sets], sizes[sets])
                owner = np.repeat(np.arange(len(sets)), sizes[sets])
                segment = (segment_hash[rows] % np.uint64(segments)).astype(np.int64)
                cell = owner * segments + segment
                order = np.argsort(cell, kind="stable")
                bounds = np.searchsorted(cell[order], np.arange(len(sets) * segments + 1))
                sums = segment_sums(term[rows][order], bounds, np.uint64)
                salt = mix64(np.arange(segments).astype(np.uint64) + np.uint64((b + 1) << 32))
                filled = np.diff(bounds) > 0
                lacking = segments - filled.reshape(-1, segments).sum(axis=1)
                emit = filled | np.repeat(lacking > spare, segments)
                parts.append(mix64(sums + np.tile(salt, len(sets)))[emit])
                owners.append(np.repeat(sets, segments)[emit])
                near = np.flatnonzero(segment < deletions)
                if len(near):
                    parts.append(mix64(sums[cell[near]] - term[rows][near] + salt[segment[near]]))
                    owners.append(sets[owner[near]])
        if not parts:
            return np.zeros(0, np.int64), np.zeros(len(sizes), np.int64)
        owner = np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        return np.concatenate(parts)[order].astype(np.int64), np.bincount(owner, minlength=len(sizes))


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.LargeListArray.from_arrays(np.concatenate([[0], np.cumsum(counts)]), pa.array(values)).cast(pa.list_(pa.int64()))


SKETCH = [f"s{k}" for k in range(SKETCH_LONGS)]


def _described(docs: DataFrame, words: int) -> DataFrame:
    """One row per document: size, class hashes and sketches."""
    names = ["doc_id", "n", "h1", "h2", *SKETCH]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, sign = Shingler(words), Signer()
        for batch in batches:
            for part in blocks(batch, limit=SHINGLE_BYTES):
                code, second, sizes = shingle(part["text"])
                h1, h2 = sign.classes(code, second, sizes)
                numbers = [sizes, h1, h2, *map(np.ascontiguousarray, sign.sketches(code, sizes).T)]
                yield pa.RecordBatch.from_arrays([part["doc_id"], *map(pa.array, numbers), sign.wide_sketches(code, sizes)], [*names, "wide"])

    return docs.mapInArrow(run, ", ".join(f"{n} long" for n in names) + ", wide array<long>")


def _signed(docs: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """(id, sig): all signatures of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, sign = Shingler(words), Signer(num, den)
        for batch in batches:
            for part in blocks(batch, limit=SHINGLE_BYTES):
                code, _, sizes = shingle(part["text"])
                code, counts = sign.signatures(code, sizes)
                yield pa.RecordBatch.from_arrays([part["doc_id"].take(pa.array(np.repeat(np.arange(len(counts)), counts))), pa.array(code)], ["id", "sig"])

    return docs.mapInArrow(run, "id long, sig long")


#: So many signatures are counted within a Python task at once.
COUNTED = 1 << 17


def _counted(docs: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """(sig, n): how many sets have each signature.

    Tasks count a bounded number of signatures at a time and send each once
    for that, so a signature that very many sets share stays small, and no
    table of all of a task's signatures is held.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, sign, held, size = Shingler(words), Signer(num, den), [], 0

        def counted() -> pa.RecordBatch:
            sigs, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(sigs), pa.array(n)], ["sig", "n"])

        for batch in batches:
            for part in blocks(batch, limit=SHINGLE_BYTES):
                code, _, sizes = shingle(part["text"])
                held.append(sign.signatures(code, sizes)[0])
                size += len(held[-1])
                if size >= COUNTED:
                    yield counted()
                    size = 0
        if held:
            yield counted()

    return docs.mapInArrow(run, "sig long, n long").repartition("sig").groupBy("sig").agg(F.sum("n").alias("n"))


#: Lists of ids with at most so many rows are broadcast (some 40 bytes a row in memory, and one in a job); longer ones are joined by a shuffle.
BROADCAST_ROWS = 500_000
#: Bits of the filter of shared signatures, at most; it is broadcast, in so many parts.
FILTER_BITS = 1 << 29
FILTER_PARTS = 64


def _bounded(keys: DataFrame) -> DataFrame:
    """A table of one key and flags, broadcast if a count shows that it is small."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys


def _shared(docs: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """(id, sig) of the signatures that two sets or more have, and few others.

    Signatures are counted from partial counts.  Those that are shared set
    two bits each in a filter of at most ``FILTER_BITS``; with ever more of them
    it lets more other rows pass, which are alone in their buckets later.
    """
    shared = cut(_counted(docs, words, num, den).where("n > 1").select("sig"))
    signed = _signed(docs, words, num, den)
    bits = min(FILTER_BITS, max(1 << 13, 1 << (max(1, shared.count()) * 32 - 1).bit_length())) // FILTER_PARTS
    part = F.pmod("sig", F.lit(FILTER_PARTS)).alias("part")
    first, second = F.pmod(F.xxhash64("sig"), F.lit(bits)), F.pmod(F.xxhash64("sig", F.lit(7)), F.lit(bits))
    parts = shared.sparkSession.range(FILTER_PARTS).select(F.col("id").alias("part"))
    arrays = cut(bit_arrays(shared.select(part, F.explode(F.array(first, second)).alias("at")), parts, "part", bits // 64))
    return signed.withColumn("part", part).join(F.broadcast(arrays), "part").where(has_bit("words", first) & has_bit("words", second)).select("id", "sig")


def _sets(docs: DataFrame, words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(words)
        for batch in batches:
            for part in blocks(batch, limit=SHINGLE_BYTES):
                first, second, sizes = shingle(part["text"])
                yield pa.RecordBatch.from_arrays([part["doc_id"], part["is_a"], part["is_b"], *(_lists(h.astype(np.int64), sizes) for h in (first, second))], ["id", "is_a", "is_b", "first", "second"])

    return docs.mapInArrow(run, "id long, is_a boolean, is_b boolean, first array<long>, second array<long>")


def _may_link(a: str, b: str, num: int, den: int) -> Column:
    """False only for pairs that cannot link: sizes, and the sketches' differing bits against the differences allowed."""
    x, y = (lambda c: F.col(f"{a}.{c}")), (lambda c: F.col(f"{b}.{c}"))
    differing = reduce(lambda p, q: p + q, [F.bit_count(x(s).bitwiseXOR(y(s))) for s in SKETCH])
    return (F.least(x("n"), y("n")) * den >= F.greatest(x("n"), y("n")) * num) & (differing * (den + num) <= (x("n") + y("n")) * (den - num))


def _may_link_wide(a: str, b: str, num: int, den: int) -> Column:
    """False only for pairs that cannot link by their wide sketches; the longer one of two is folded to the other's length."""
    p, q = F.col(f"{a}.wide"), F.col(f"{b}.wide")

    def fold(w: Column) -> Column:
        half = F.shiftright(F.size(w), 1)
        return F.zip_with(F.slice(w, F.lit(1), half), F.slice(w, half + 1, half), lambda u, v: u.bitwiseXOR(v))

    def differing(v: Column, w: Column) -> Column:
        return F.aggregate(F.zip_with(v, w, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda total, bits: total + bits)

    bits = F.when(F.size(p) == F.size(q), differing(p, q)).when(F.size(p) == 2 * F.size(q), differing(fold(p), q)).when(F.size(q) == 2 * F.size(p), differing(p, fold(q))).otherwise(0)
    return bits * (den + num) <= (F.col(f"{a}.n") + F.col(f"{b}.n")) * (den - num)


def components(links: DataFrame) -> DataFrame:
    """(id, component) of the ids in ``links`` (a, b): the smallest id reachable, by alternating large and small stars.

    Neighbourhoods are aggregated to their smallest id and joined back; the
    links of a hub are dealt over several tasks.
    """
    edges = cut(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before, n_links = None, edges.count()

    def with_least(rows: DataFrame, total: int) -> DataFrame:
        """(a, b, m): each link with the smallest neighbour of a, or a itself."""
        least = rows.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")).select("a", F.least("a", "m").alias("m"), "n")
        return spread_join(rows, least.select("a", "m"), ["a"], hot_keys(least, ["a"], "n", total))

    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # large star: larger neighbours are tied to the smallest of the neighbourhood
        edges = cut(with_least(both, 2 * n_links).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
        # small star: smaller neighbours and the node itself are, too
        ends = F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))
        edges = cut(with_least(edges, n_links).select(F.explode(ends).alias("e")).select("e.a", "e.b").where("a <> b").distinct())
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == before:
            break
        before, n_links = tuple(now), now[0]
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))


def near_groups(docs: DataFrame, words: int = WORDS, num: int = NUM, den: int = DEN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    Two documents link when den * |intersection| >= num * |union|.  Shingles
    count as equal when the 128-bit digests of their words are.  Null and
    empty texts, and those without a word, have no shingles, link with nothing
    and are components of their own.  Rows that share an id are one document
    with the links of each; a row without id links with nothing and its
    component is null.  Texts of any length count whole.  An empty table gives
    no rows; columns other than id and text play no part.
    """
    plain = texts(docs, id_col, text_col)
    described = cut(_described(plain, words))
    real = described.where("n > 0 AND doc_id IS NOT NULL")
    same = ["n", "h1", "h2"]
    groups = cut(real.groupBy(*same).agg(F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("copies")))
    hot_sets = hot_keys(groups, same, "copies", real.count())
    homes_of = spread_join(real.select("doc_id", *same), groups.drop("copies"), same, hot_sets).select("doc_id", "id")
    copies = cut(homes_of.groupBy("doc_id").agg(F.max(F.col("doc_id") == F.col("id")).alias("own"), F.min("id").alias("lo"), F.max("id").alias("hi")).where("NOT own OR lo < hi"))
    # signatures are made twice, for the counts and for the members: as a table they take as much disk as the texts
    firsts = plain.where("doc_id IS NOT NULL").join(_bounded(copies.where("NOT own").select("doc_id")), "doc_id", "left_anti")
    # buckets with two members or more
    members = cut(_shared(firsts, words, num, den).distinct())
    buckets = cut(members.groupBy("sig").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count(F.lit(1)).alias("size")).where("lo < hi"))
    hot_buckets = hot_keys(buckets, ["sig"], "size", members.count())
    used = cut(members.select("id").distinct())
    lite = cut(real.select(F.col("doc_id").alias("id"), "n", *SKETCH, "wide").join(_bounded(used), "id", "left_semi"))

    def hubs(pairs: DataFrame) -> list[DataFrame | None]:
        """The hot ids among the first, and among the second members of pairs."""
        total = pairs.count()
        return [frequent(pairs, k, total) for k in ("a", "b")]

    def plausible(pairs: DataFrame) -> DataFrame:
        """Distinct candidate pairs (a, b) that sizes and sketches allow."""
        pairs = cut(pairs.distinct())
        x, y = (lite.select(F.col("id").alias(k), F.struct("n", *SKETCH, "wide").alias(s)) for k, s in (("a", "x"), ("b", "y")))
        hot_a, hot_b = hubs(pairs)
        met = spread_join(spread_join(pairs, x, ["a"], hot_a), y, ["b"], hot_b)
        return met.where(_may_link("x", "y", num, den) & _may_link_wide("x", "y", num, den)).select("a", "b")

    def verified(pairs: DataFrame) -> DataFrame:
        """The links among distinct candidate pairs (a, b), exactly; only sets of their members are built and sent."""
        sides = F.explode(F.array(F.struct(F.col("a").alias("doc_id"), F.lit(True).alias("left")), F.struct(F.col("b").alias("doc_id"), F.lit(False).alias("left"))))
        wanted = cut(pairs.select(sides.alias("s")).select("s.*").groupBy("doc_id").agg(F.bool_or("left").alias("is_a"), F.bool_or(~F.col("left")).alias("is_b")))
        sets = cut(_sets(plain.join(_bounded(wanted), "doc_id"), words))
        left = sets.where("is_a").select(F.col("id").alias("a"), F.col("first").alias("a1"), F.col("second").alias("a2"))
        right = sets.where("is_b").select(F.col("id").alias("b"), F.col("first").alias("b1"), F.col("second").alias("b2"))
        # by both halves of the digests: neither can count a shingle that the sets don't share unless it collides
        both = F.least(F.size(F.array_intersect("a1", "b1")), F.size(F.array_intersect("a2", "b2")))
        hot_a, hot_b = hubs(pairs)
        met = spread_join(spread_join(pairs, left, ["a"], hot_a), right, ["b"], hot_b)
        return met.where(both * den >= num * (F.size("a1") + F.size("b1") - both)).select("a", "b").distinct()

    with_both = F.array(F.struct(F.col("lo").alias("a"), F.col("id").alias("b")), F.struct(F.col("id").alias("a"), F.col("hi").alias("b")))
    met = spread_join(members, buckets.select("sig", "lo", "hi"), ["sig"], hot_buckets)
    stars = met.select(F.explode(with_both).alias("p")).select("p.a", "p.b").where("a < b")
    # an id with several texts ties their classes together
    ties = None
    several = copies.where("lo < hi")
    if not several.isEmpty():
        ties = several.join(homes_of, "doc_id").select(F.col("lo").alias("a"), F.col("id").alias("b")).where("a < b").distinct()
    checked = cut(plausible(stars))
    links = verified(checked)
    links = cut(links.unionByName(ties) if ties is not None else links)
    found = components(links)
    placed = members.join(found, "id", "left").select("sig", "id", F.coalesce("component", "id").alias("c"))
    mixed = placed.groupBy("sig").agg(F.min("c").alias("main"), F.max("c").alias("other")).where("main < other")
    open_ = cut(spread_join(placed, mixed.select("sig", "main"), ["sig"], hot_buckets).join(lite.drop("wide"), "id"))
    x = open_.where("c <> main").select("sig", F.struct("id", "c", "n", *SKETCH).alias("x"))
    y = open_.select("sig", F.struct("id", "c", "n", *SKETCH).alias("y"))
    rest = spread_join(y, x, ["sig"], hot_buckets).where((F.col("x.c") > F.col("y.c")) & _may_link("x", "y", num, den))
    # pairs that the first round found not to link need no second check
    open_pairs = rest.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct().join(checked, ["a", "b"], "left_anti")
    open_pairs = cut(plausible(open_pairs))
    if not open_pairs.isEmpty():
        found = components(links.unionByName(verified(open_pairs)))
    homes = groups.join(found, "id", "left").select(*same, F.coalesce("component", "id").alias("home"))
    linked = spread_join(real.select("doc_id", *same), homes, same, hot_sets).select("doc_id", F.col("n").alias("n_shingles"), F.col("home").alias("component_id"))
    alone = described.where("n = 0 OR doc_id IS NULL").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)


def drop_near_copies(docs: DataFrame, words: int = WORDS, num: int = NUM, den: int = DEN) -> DataFrame:
    """``docs``, all columns, with one document of each component: the one with the smallest id.

    Rows without id stay, and so do null and empty texts and those without a
    word, which link with nothing.  Rows that repeat the id that stays all
    stay.  Texts of any length count whole, an empty table stays empty, and
    other columns, whatever their names, play no part.
    """
    key = fresh(docs, "_gone")
    gone = cut(near_groups(docs, words, num, den).where("component_id <> doc_id").select(F.col("doc_id").alias(key)).distinct())
    return docs.join(_bounded(gone), docs["doc_id"] == F.col(key), "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"))
