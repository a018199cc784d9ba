"""Vector blobs: little-endian float32 to arrays and arrays to bytes, a whole Arrow batch at a time."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, FloatType


def _filled(values: pd.Series, there: np.ndarray, rows: list) -> pd.Series:
    out = np.empty(len(values), object)
    out[:] = None
    for at, row in zip(np.flatnonzero(there), rows):
        out[at] = row
    return pd.Series(out)


def decode_blob(dimension: int):
    """binary -> array<float>: the first ``dimension`` float32 values; null for a null or short blob."""

    @F.pandas_udf(ArrayType(FloatType()))
    def decode(blobs: pd.Series) -> pd.Series:
        there = blobs.str.len().fillna(0).to_numpy() >= 4 * dimension
        joined = b"".join(b[: 4 * dimension] for b in blobs[there])
        return _filled(blobs, there, list(np.frombuffer(joined, "<f4").reshape(-1, dimension)))

    return decode


def _packed(vectors: pd.Series, change, width: int) -> pd.Series:
    """All vectors of a batch changed as one array, then cut into their bytes."""
    there = vectors.notna().to_numpy()
    some = vectors[there].to_list()
    data = change(np.concatenate([*some, np.zeros(0)])).tobytes()
    ends = np.cumsum([0, *map(len, some)]) * width
    return _filled(vectors, there, [data[a:b] for a, b in zip(ends[:-1], ends[1:])])


@F.pandas_udf(BinaryType())
def encode_blob(vectors: pd.Series) -> pd.Series:
    """array<float> -> binary of little-endian float32."""
    return _packed(vectors, lambda v: v.astype("<f4"), 4)


@F.pandas_udf(BinaryType())
def pack_quantized(vectors: pd.Series) -> pd.Series:
    """array<float> in -1 .. 1 -> one byte each, halves to even."""
    return _packed(vectors, lambda v: np.clip(np.rint((v.astype(np.float64) + 1.0) * 127.5), 0, 255).astype(np.uint8), 1)
