"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Python tasks work through a batch of rows in blocks of about so many bytes of text.
BLOCK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id, text), a null text as the empty one: other columns, whatever their names, play no part."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` doesn't have yet."""
    have = {c.lower() for c in df.columns}
    while base.lower() in have:
        base += "_"
    return base


def numbered(docs: DataFrame) -> DataFrame:
    """The same rows with columns c0, c1, ...: names with dots, or in any case, then do no harm."""
    return docs.toDF(*(f"c{k}" for k in range(len(docs.columns))))


def place_of(docs: DataFrame, column: str) -> int:
    """Where a column stands, its name in any case, as Spark finds it."""
    return [c.lower() for c in docs.columns].index(column.lower())


def release_memory() -> None:
    """Give freed memory back: the workers of an executor share its memory, and stay when their tasks have ended."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def blocks(batch: pa.RecordBatch, column: str | int = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``limit`` bytes in ``column``, or a single longer row."""
    sizes = np.cumsum(np.nan_to_num(np.asarray(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False), float)))
    lo, n = 0, batch.num_rows
    while lo < n:
        base = sizes[lo - 1] if lo else 0.0
        hi = max(lo + 1, int(np.searchsorted(sizes, base + limit, side="right")))
        yield batch.slice(lo, hi - lo)
        lo = hi
    release_memory()


def flat_utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all strings of an Arrow column in one array, and where each string starts (n + 1 offsets)."""
    strings = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset : strings.offset + len(strings) + 1]
    data = strings.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


def segment_sums(values: np.ndarray, offsets: np.ndarray, dtype=np.int64) -> np.ndarray:
    """Sums of ``values`` between successive offsets; empty ranges give 0."""
    total = np.concatenate([np.zeros(1, dtype), np.cumsum(values, dtype=dtype)])
    return total[offsets[1:]] - total[offsets[:-1]]


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """The cluster names a shared folder in spark.checkpoint.dir; only a local session without one gets its own."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    named = sc.getConf().get("spark.checkpoint.dir", None)
    if named is None and not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="shelfwise-checkpoint-"))


def cut(df: DataFrame) -> DataFrame:
    """The same rows, written to the shared checkpoint folder, so that a lost executor costs no recomputation."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: A key is hot with more than one of so many parts of all rows, and more than so many rows.
HOT_KEYS = 200
HOT_ROWS = 500


def hot_keys(counts: DataFrame, keys: list[str], count: str, total: int) -> DataFrame | None:
    """(keys, _parts) of the keys that more than 1 / HOT_KEYS of ``total`` rows share, and more than HOT_ROWS, or None without any.

    They are at most HOT_KEYS, and their parts at most 2 * HOT_KEYS.
    """
    limit = max(HOT_ROWS, total // HOT_KEYS)
    if total <= limit:
        return None
    hot = counts.where(F.col(count) > limit).select(*keys, F.ceil(F.col(count) / limit).cast("int").alias("_parts"))
    rows = hot.collect()
    return counts.sparkSession.createDataFrame(rows, hot.schema) if rows else None


def frequent(rows: DataFrame, key: str, total: int) -> DataFrame | None:
    """As ``hot_keys``, for one column of ``rows``; counts come from a sketch of each task, so hardly anything shuffles."""
    if total <= max(HOT_ROWS, total // HOT_KEYS):
        return None
    top = rows.agg(F.expr(f"approx_top_k({key}, {2 * HOT_KEYS}, {64 * HOT_KEYS})").alias("top")).select(F.explode("top").alias("t"))
    counts = rows.sparkSession.createDataFrame(top.select(F.col("t.item").alias(key), F.col("t.count").alias("n")).collect(), f"{key} {dict(rows.dtypes)[key]}, n long")
    return hot_keys(counts, [key], "n", total)


def spread_join(rows: DataFrame, side: DataFrame, keys: list[str], hot: DataFrame | None) -> DataFrame:
    """``rows`` joined with ``side`` on ``keys``; the rows of a hot key are dealt over several tasks, which all get the side's rows of that key."""
    if hot is None:
        return rows.join(side, keys)
    hot = F.broadcast(hot)
    others = [c for c in rows.columns if c not in keys]
    dealt = rows.join(hot, keys, "left").withColumn("_part", F.pmod(F.xxhash64(*others), F.coalesce("_parts", F.lit(1)))).drop("_parts")
    copied = side.join(hot, keys, "left").withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_parts", F.lit(1)).cast("long") - 1))).drop("_parts")
    return dealt.join(copied, [*keys, "_part"]).drop("_part")


def bit_arrays(marks: DataFrame, places: DataFrame, place: str, words: int) -> DataFrame:
    """(place, words): for every place an array of ``words`` longs with the bits ``at`` of its marks (place, at) set."""
    word = F.shiftright("at", 6)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("at") % 64).cast("int"))
    given = marks.select(place, word.alias("word"), bit.alias("bits"))
    none = places.select(place, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(words - 1).cast("long"))).alias("word"), F.lit(0).cast("long").alias("bits"))
    filled = given.unionByName(none).groupBy(place, "word").agg(F.bit_or("bits").alias("bits"))
    return filled.groupBy(place).agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda w: w["bits"]).alias("words"))


def has_bit(words: str, at: Column) -> Column:
    return F.getbit(F.element_at(words, (F.shiftright(at, 6) + 1).cast("int")), (at % 64).cast("int")) == 1


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and shift), for uint64 arrays."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def word_array(flat: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.LargeBinaryArray:
    """Byte ranges of one array, in order and without common bytes, as an Arrow array of their own."""
    edge = np.zeros(len(flat) + 1, np.int8)
    edge[start] += 1
    edge[end] -= 1
    packed = flat[np.cumsum(edge[:-1], dtype=np.int8).view(bool)]
    offsets = np.concatenate([np.zeros(1, np.int64), np.cumsum(end - start, dtype=np.int64)])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(packed)])


#: Longer byte ranges are hashed one by one, with BLAKE2b.
LANE_BYTES = 64
KEYS = [(np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)), (np.uint64(0x8EBC6AF09C88C6E3), np.uint64(0x589965CC75374CC3))]


def word_hashes(flat: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128-bit hashes of many byte ranges of one array, as two arrays of 64 bits.

    Two chains run over a range's eight-byte lanes; each lane goes through a
    multiplication and a finaliser with keys of its chain, so neither
    depends on the other.  Ranges over ``LANE_BYTES`` get a BLAKE2b digest.
    """
    size = end - start
    out = [mix64(size.astype(np.uint64) * key + other) for key, other in KEYS]
    padded = np.concatenate([flat, np.zeros(8, np.uint8)])
    lanes = np.ndarray((len(flat) + 1,), "<u8", padded, 0, (1,))
    active = np.flatnonzero((size > 0) & (size <= LANE_BYTES))
    for at in range(0, LANE_BYTES, 8):
        active = active[size[active] > at]
        if not len(active):
            break
        lane = lanes[start[active] + at]
        short = np.minimum(size[active] - at, 8)
        lane &= np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - (short * 8).astype(np.uint64))
        for h, (key, other) in zip(out, KEYS):
            h[active] = mix64((h[active] ^ lane) * key + other)
    for k in np.flatnonzero(size > LANE_BYTES).tolist():
        digest = hashlib.blake2b(flat[start[k] : end[k]].tobytes(), digest_size=16).digest()
        out[0][k], out[1][k] = np.frombuffer(digest, "<u8")
    return out[0], out[1]
