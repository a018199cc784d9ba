"""Batch inference over landed assets, with the model given by the caller."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import landing
from ..sources.pointers import exists

Embed = Callable[[list[bytes]], np.ndarray]

SCHEMA = "item_id string, ok boolean, vector array<float>, error string"
FIELDS = pa.schema([("item_id", pa.string()), ("ok", pa.bool_()), ("vector", pa.list_(pa.float32())), ("error", pa.string())])
#: A model gets contents of at most so many bytes at once, or a single longer one.
BATCH_BYTES = 8 << 20
#: Failures that the network, and not an item, is to blame for; so many in a row end a run.
NETWORK = (ConnectionError, TimeoutError)
MOST_FAILURES = 15
#: How an error row of the network begins, and what rows say that a run didn't get to.
NETWORK_ERROR, ABORTED = "NetworkError", "Skipped: aborted after network failures in a row"

_MODELS: dict[str, Embed] = {}


def _model(key: str, load: Callable[[], Embed]) -> Embed:
    """Each Python worker loads a model once, however many batches and tasks it works on."""
    if key not in _MODELS:
        _MODELS[key] = load()
    return _MODELS[key]


def _unit(v: np.ndarray) -> np.ndarray:
    norm = float(np.linalg.norm(v))
    return (v / norm if norm else v).astype(np.float32)


def byte_slices(batch: pa.RecordBatch, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most ``limit`` bytes of content each, or a single longer one."""
    sizes = np.cumsum(np.nan_to_num(pc.binary_length(batch["content"]).to_numpy(zero_copy_only=False).astype(float)))
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(sizes, (sizes[lo - 1] if lo else 0.0) + limit, side="right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def _rows(embed: Embed, items: list[str], contents: list[bytes | None], streak: int, most: int) -> tuple[list[tuple], int]:
    """Result rows and the streak after them.  Where the whole batch fails its items are tried one by one."""
    if streak < most:
        try:
            return [(i, True, _unit(np.asarray(v, np.float64)), None) for i, v in zip(items, embed(contents), strict=True)], 0
        except Exception:  # one of them is bad
            pass
    out = []
    for item, content in zip(items, contents):
        if streak >= most:
            out.append((item, False, None, ABORTED))
            continue
        try:
            out.append((item, True, _unit(np.asarray(embed([content])[0], np.float64)), None))
            streak = 0
        except NETWORK as e:
            streak += 1
            out.append((item, False, None, f"{NETWORK_ERROR}: {type(e).__name__}: {e}"))
        except Exception as e:  # the item's own fault leaves the streak as it is
            out.append((item, False, None, f"{type(e).__name__}: {e}"))
    return out, streak


def embed_assets(assets: DataFrame, load: Callable[[], Embed], batch_bytes: int = BATCH_BYTES, most_failures: int = MOST_FAILURES, model: str | None = None) -> DataFrame:
    """One row per asset (item_id, content): its vector, of length 1, or the error.  A bad item never fails the job.

    ``load`` gives a function of a list of contents; a worker calls it once
    for each ``model``, a name that stands for it.  A task that meets
    ``most_failures`` network failures in a row tries no further item and says
    so in their rows.  Null and empty contents go to the model like any other.
    """
    key = model or uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        embed, streak = _model(key, load), 0
        for batch in batches:
            for part in byte_slices(batch, batch_bytes):
                rows, streak = _rows(embed, part["item_id"].to_pylist(), part["content"].to_pylist(), streak, most_failures)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), FIELDS.types)], schema=FIELDS)

    return assets.select(F.col("item_id").cast("string").alias("item_id"), "content").mapInArrow(run, SCHEMA)


def embedded(spark: SparkSession, results: str) -> DataFrame:
    """A row for each item that a run at ``results`` has tried: its vector if any try gave one, else an error."""
    if not exists(spark, results):
        return spark.createDataFrame([], SCHEMA)
    rows = spark.read.schema(SCHEMA).parquet(f"{results}/wave-*")
    best = rows.groupBy("item_id").agg(F.max_by(F.struct("ok", "vector", "error"), F.col("ok").cast("int")).alias("r"))
    return best.select("item_id", "r.*")


def embed_pending(
    spark: SparkSession, pending: DataFrame, assets: str, results: str, load: Callable[[], Embed], wave: int = 10_000, tasks: int | None = None,
    batch_bytes: int = BATCH_BYTES, most_failures: int = MOST_FAILURES, model: str | None = None,
) -> str:
    """Embed the files of pending items (item_id), in waves of about ``wave`` files one after the other, and add each wave's rows to ``results``.

    Items with a vector in ``results`` are done, so a run that was lost goes on
    where it ended.  Once a task of a wave has given up after network failures
    in a row, no further wave starts: the run is ``aborted``, what it has
    finished stays, and the rest is still pending.  Otherwise it is
    ``completed``.  Items without a file have no row.
    """
    done = embedded(spark, results).where("ok").select("item_id")
    todo = landing.pending_assets(spark, pending, assets).join(done, "item_id", "left_anti").persist()
    try:
        waves = -(-todo.count() // wave)
        for k in range(waves):
            mine = todo.where(F.pmod(F.xxhash64("item_id"), F.lit(waves)) == k)
            contents = landing.asset_contents(spark, mine, 4 * wave + 1000)
            place = f"{results}/wave-{uuid.uuid4().hex}"
            embed_assets(contents.repartition(tasks) if tasks else contents, load, batch_bytes, most_failures, model or results).write.parquet(place)
            if not spark.read.schema(SCHEMA).parquet(place).where(F.col("error") == ABORTED).isEmpty():
                return "aborted"
        return "completed"
    finally:
        todo.unpersist()
