"""Exact top-k search by inner product with pivot-table elimination.

By the triangle inequality a candidate's distance to a query is at least the
largest difference of their distances to any pivot, and with the norms that
bounds the inner product from above.  Candidates stand in cells, by their
nearest pivot, and cells in blocks.

A query first meets its own block, where the candidates that are about as far
from its nearest pivot as itself give it a floor: the score of its k-th best so
far.  A cell is left out if its range of distances says that none of its
vectors can reach the floor; the query is sent to the other blocks only.  In
every block, its own included, the pivots are looked at a few at a time, as
long as they eliminate candidates; the remaining ones are evaluated in the
order of their bounds, until no bound reaches the k-th best score.  Where the
pivots eliminate hardly anything, as among vectors that lie evenly in many
dimensions, what they leave is evaluated at once.

Floors and scores are whole numbers.  Distances and bounds are floats, so they
are given what rounding can take from them (``unsure``, ``slack``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, mix64, table

SCALE = 64
K = 20
EVERY = 20
#: Pivots of each width of vectors, and how many are looked at together.
PIVOTS, STEP = 64, 8
#: About so many candidates and queries of one block, and how many give a first floor.
CANDIDATES, QUERIES, FIRST = 2048, 2048, 64
#: A query without a floor.
NO_FLOOR = -(1 << 63)
EPS = float(np.finfo(float).eps)


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, v): floor(scale * x) of each component; vectors that are null, or hold null or non-finite ones, are left out."""
    x = F.col(vector_col)
    sound = x.isNotNull() & F.col(id_col).isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vectors.where(sound).select(F.col(id_col).cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long")).alias("v"))


def choose_pivots(vectors: DataFrame, count: int = PIVOTS) -> dict[int, np.ndarray]:
    """By width of vectors: pivots spread out by farthest-first choice from a bounded sample (40 vectors a pivot, by a hash of their ids)."""
    rows = [r["v"] for r in vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(40 * count).collect()]
    found = {}
    for width in {len(v) for v in rows}:
        sample = np.array([v for v in rows if len(v) == width], float)
        chosen = [0]
        nearest = np.linalg.norm(sample - sample[0], axis=1)
        while len(chosen) < min(count, len(sample)):
            chosen.append(int(nearest.argmax()))
            nearest = np.minimum(nearest, np.linalg.norm(sample - sample[chosen[-1]], axis=1))
        found[width] = sample[chosen]
    return found


def distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    v = vectors.astype(float)
    return np.sqrt(np.maximum(0.0, (v * v).sum(1)[:, None] + (pivots * pivots).sum(1)[None] - 2 * v @ pivots.T))


def unsure(width: int, *norms: float) -> float:
    """How far a distance may be off, for vectors and pivots of such squared norms: the root of what rounding does to its square."""
    return float(np.sqrt(8 * (width + 4) * EPS * sum(norms)))


def slack(width: int, norms):
    """How far a bound on a score, half a sum of ``norms`` less a square, may be off."""
    return 1e-6 + 4 * (width + 4) * EPS * norms


def exact(vectors: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers; in floats only where those are exact."""
    if vectors.size and queries.size and float(np.abs(vectors).max()) * float(np.abs(queries).max()) * max(1, vectors.shape[1]) < 2**53:
        return (vectors.astype(float) @ queries.astype(float).T).astype(np.int64)
    return vectors @ queries.T


def best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids."""
    if len(score) > 4 * k:
        least = np.partition(score, len(score) - k)[len(score) - k]
        some = np.flatnonzero(score >= least)
        return some[np.lexsort((ids[some], -score[some]))[:k]]
    return np.lexsort((ids, -score))[:k]


def search_block(
    queries: np.ndarray,
    query_ids: np.ndarray,
    floors: np.ndarray,
    vectors: np.ndarray,
    ids: np.ndarray,
    pivots: np.ndarray,
    k: int = K,
    counts: dict | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each query's k best vectors but its own that reach its floor, as (query number, id, score).

    ``counts``, if given, learns how many candidates were there, how many the pivots left, and how many were evaluated.
    """
    t_v, t_q, width = distances(vectors, pivots), distances(queries, pivots), vectors.shape[1]
    n_v, n_q = (vectors.astype(float) ** 2).sum(1), (queries.astype(float) ** 2).sum(1)
    off = 2 * unsure(width, max(n_v.max(initial=0.0), n_q.max(initial=0.0)), float((pivots * pivots).sum(1).max(initial=0.0)))
    floors = floors.astype(np.int64)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    whole, evaluated, left_over = [], 0, 0

    def give(q: int, rows: np.ndarray, score: np.ndarray) -> None:
        out.append((np.full(len(rows), q), ids[rows], score))

    def others(q: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = rows[ids[rows] != query_ids[q]]
        return rows, exact(vectors[rows], queries[q : q + 1])[:, 0]

    for q in range(len(queries)):
        floor = int(floors[q])
        if floor == NO_FLOOR and len(ids) > 4 * FIRST and FIRST > k:
            p = int(t_q[q].argmin())
            _, score = others(q, np.argpartition(np.abs(t_v[:, p] - t_q[q, p]), FIRST)[:FIRST])
            evaluated += FIRST
            floor = int(np.partition(score, len(score) - k)[len(score) - k]) if len(score) >= k else NO_FLOOR
        rows, gap, most = np.arange(len(ids)), np.zeros(len(ids)), n_q[q] + n_v + slack(width, n_q[q] + n_v)
        if floor != NO_FLOOR:
            for at in range(0, len(pivots), STEP):
                gap = np.maximum(gap, np.abs(t_v[rows, at : at + STEP] - t_q[q, at : at + STEP]).max(axis=1) - off)
                keep = (most[rows] - gap * gap) / 2 >= floor
                few = np.count_nonzero(keep) > 0.98 * len(rows)
                rows, gap = rows[keep], gap[keep]
                if few:
                    break
        left_over += len(rows)
        if 2 * len(rows) > len(ids):
            whole.append((q, floor))
            continue
        bound = (most[rows] - gap * gap) / 2
        order = np.argsort(-bound, kind="stable")
        rows, bound = rows[order], bound[order]
        kept, scores, at, step = np.zeros(0, np.int64), np.zeros(0, np.int64), 0, 64
        while at < len(rows) and bound[at] >= floor:
            now, score = others(q, rows[at : at + step])
            evaluated += len(now)
            at, step = at + step, step * 2
            kept, scores = np.concatenate([kept, now]), np.concatenate([scores, score])
            top = best(scores, ids[kept], k)
            kept, scores = kept[top], scores[top]
            if len(scores) == k:
                floor = max(floor, int(scores.min()))
        give(q, kept, scores)
    for lo in range(0, len(whole), 256):
        part = whole[lo : lo + 256]
        score = exact(vectors, queries[[q for q, _ in part]])
        evaluated += score.size
        for (q, floor), column in zip(part, score.T):
            rows = np.flatnonzero((ids != query_ids[q]) & (column >= floor))
            top = best(column[rows], ids[rows], k)
            give(q, rows[top], column[rows[top]])
    if counts is not None:
        for name, n in (("there", len(ids) * len(queries)), ("left", left_over), ("evaluated", evaluated)):
            counts[name] = counts.get(name, 0) + n
    return tuple(np.concatenate([o[j] for o in out]).astype(np.int64) if out else np.zeros(0, np.int64) for j in range(3))


@dataclass
class Cells:
    """Of one width: each cell's range of distances to its pivot, largest norm, first block and number of blocks."""

    low: np.ndarray
    high: np.ndarray
    heavy: np.ndarray
    first: np.ndarray
    parts: np.ndarray

    @staticmethod
    def of(rows: list, size: int) -> Cells:
        """Small cells share a block, large ones are dealt over several; ``rows``: (cell, n, low, high, heavy)."""
        n = 1 + max(r["cell"] for r in rows)
        cells = Cells(np.full(n, np.inf), np.full(n, -np.inf), np.zeros(n), np.zeros(n, np.int64), np.zeros(n, np.int64))
        block, filled = 0, 0
        for r in sorted(rows, key=lambda r: r["cell"]):
            c, parts = r["cell"], -(-r["n"] // size)
            if filled and filled + r["n"] > size:
                block, filled = block + 1, 0
            cells.low[c], cells.high[c], cells.heavy[c], cells.first[c], cells.parts[c] = r["low"], r["high"], r["heavy"], block, parts
            block, filled = (block, filled + r["n"]) if parts == 1 else (block + parts, 0)
        return cells

    def block(self, cell: np.ndarray, ids: np.ndarray) -> np.ndarray:
        return self.first[cell] + (mix64(ids.astype(np.uint64)) % np.maximum(self.parts[cell], 1).astype(np.uint64)).astype(np.int64)

    def reach(self, t: np.ndarray, norm: float, floor: int, pivots: np.ndarray) -> np.ndarray:
        """The blocks of cells that may hold a vector that reaches the floor; ``t``: a query's distances to the pivots."""
        width = pivots.shape[1]
        off = 2 * unsure(width, max(norm, float(self.heavy.max())), float((pivots * pivots).sum(1).max(initial=0.0)))
        gap = np.maximum(0.0, np.maximum(t[: len(self.low)] - self.high, self.low - t[: len(self.low)]) - off)
        sums = norm + self.heavy
        some = np.flatnonzero((self.parts > 0) & ((sums + slack(width, sums) - gap * gap) / 2 >= floor))
        return np.unique(np.concatenate([self.first[c] + np.arange(self.parts[c]) for c in some] or [np.zeros(0, np.int64)]))


def by_width(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(width, row numbers, vectors) of each width in a batch."""
    column = batch["v"]
    widths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    for width in np.unique(widths).tolist():
        rows = np.flatnonzero(widths == width)
        yield width, rows, column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(rows), width)


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's k highest inner products; queries: ids divisible by ``every``.

    Unsound vectors (see ``quantised``) are neither queries nor candidates.  A
    query never meets its own id, so repeated rows of one id don't find each
    other; a repeated candidate row counts once per row, and a repeated query
    row brings no second result.  Of equal scores the smaller id ranks first.  Vectors meet those of their own width only.
    Scores are exact as long as they fit into 64 bits.  Other columns play no
    part; an empty table gives no rows.
    """
    sound = cut(quantised(vectors, id_col, vector_col))
    pivots = choose_pivots(sound)

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for width, rows, v in by_width(batch):
                part = batch.take(pa.array(rows))
                t = distances(v, pivots[width]) if width in pivots else np.zeros((len(v), 1))
                cell = t.argmin(axis=1)
                numbers = (np.full(len(v), width), cell, t[np.arange(len(v)), cell], (v.astype(float) ** 2).sum(1))
                yield pa.RecordBatch.from_arrays([part["vec_id"], part["v"], *map(pa.array, numbers)], ["vec_id", "v", "w", "cell", "d", "norm"])

    located = cut(sound.mapInArrow(locate, "vec_id long, v array<long>, w long, cell long, d double, norm double"))
    stats = located.groupBy("w", "cell").agg(F.count(F.lit(1)).alias("n"), F.min("d").alias("low"), F.max("d").alias("high"), F.max("norm").alias("heavy")).collect()
    cells = {w: Cells.of([r for r in stats if r["w"] == w], CANDIDATES) for w in {r["w"] for r in stats}}
    chosen = located.where(F.pmod("vec_id", F.lit(every)) == 0).dropDuplicates(["vec_id", "v"])
    q_blocks = max(1, -(-chosen.count() // QUERIES))
    head = "w long, block long, q long, "

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Candidates with their block."""
        for batch in batches:
            w, cell, ids = (batch[c].to_numpy(zero_copy_only=False) for c in ("w", "cell", "vec_id"))
            block = np.zeros(len(w), np.int64)
            for width in np.unique(w).tolist():
                at = np.flatnonzero(w == width)
                block[at] = cells[width].block(cell[at], ids[at])
            yield pa.RecordBatch.from_arrays([batch["w"], pa.array(block), batch["vec_id"], batch["v"]], ["w", "block", "vec_id", "v"])

    def travel(own: bool):
        """Queries at their own block, or at all others that their floor doesn't rule out."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                cell, floor = (batch[c].to_numpy(zero_copy_only=False) for c in ("cell", "floor"))
                for width, rows, v in by_width(batch):
                    ids = batch["vec_id"].to_numpy(zero_copy_only=False)[rows]
                    home = cells[width].block(cell[rows], ids)
                    t = distances(v, pivots[width]) if width in pivots else np.zeros((len(v), 1))
                    norm = (v.astype(float) ** 2).sum(1)
                    goals = [np.array([h]) if own else np.setdiff1d(cells[width].reach(t[k], norm[k], int(floor[rows[k]]), pivots.get(width, np.zeros((1, width)))), [h]) for k, h in enumerate(home.tolist())]
                    at = rows[np.repeat(np.arange(len(rows)), [len(g) for g in goals])]
                    some = batch.take(pa.array(at))
                    parts = np.uint64(1 if own else q_blocks)  # a block has few queries of its own
                    q = (mix64(some["vec_id"].to_numpy(zero_copy_only=False).astype(np.uint64) + np.uint64(1)) % parts).astype(np.int64)
                    block = np.concatenate([*goals, np.zeros(0, np.int64)]).astype(np.int64)
                    numbers = [np.full(len(at), width), block, q]
                    yield pa.RecordBatch.from_arrays([*map(pa.array, numbers), some["vec_id"], some["v"], some["floor"]], ["w", "block", "q", "vec_id", "v", "floor"])

        return run

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        ids, width = left["vec_id"].to_numpy(), len(left["v"].iloc[0])
        stack = lambda v: np.stack(v.to_numpy()).astype(np.int64).reshape(len(v), width)
        q, found, score = search_block(stack(left["v"]), ids, left["floor"].to_numpy(), stack(right["v"]), right["vec_id"].to_numpy(), pivots.get(width, np.zeros((1, width))), k)
        return pd.DataFrame({"query_id": ids[q], "vec_id": found, "score": score})

    candidates = located.select("w", "cell", "vec_id", "v").mapInArrow(settle, "w long, block long, vec_id long, v array<long>")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def search(queries: DataFrame, own: bool) -> DataFrame:
        sent = queries.select("vec_id", "v", "cell", "floor").mapInArrow(travel(own), head + "vec_id long, v array<long>, floor long")
        if own:
            there = candidates.withColumn("q", F.lit(0).cast("long"))
        else:  # a block goes only where queries have been sent to it
            sent = cut(sent)
            there = candidates.join(sent.select(*(F.col(c).alias(c) for c in ("w", "block", "q"))).distinct(), ["w", "block"])
        met = sent.groupBy("w", "block", "q").cogroup(there.groupBy("w", "block", "q")).applyInPandas(meet, "query_id long, vec_id long, score long")
        return met.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)

    first = cut(search(chosen.withColumn("floor", F.lit(NO_FLOOR)), own=True))
    floors = first.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("floor"))
    again = chosen.join(floors, "vec_id", "left").withColumn("floor", F.coalesce("floor", F.lit(NO_FLOOR)))
    both = first.drop("rank").unionByName(search(again, own=False).drop("rank"))
    return both.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""
