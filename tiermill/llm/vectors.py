"""Vector columns as arrays: what the operators on embeddings share.

A vector takes part if it has the common length, which is the one that most
non-empty vectors have (of several the smallest), and all its components are
finite numbers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Scale of whole-number components, and the largest of them: products, their
#: sums over a vector and a hundred times those fit 64 bits.
SCALE, LARGEST = 256.0, 1 << 20


def common_length(df: DataFrame, vector: str) -> int:
    """The length that most vectors have; 0 if there is none."""
    size = df.where(F.col(f"`{vector}`").isNotNull()).select(F.size(F.col(f"`{vector}`")).alias("size")).where("size > 0")
    most = size.groupBy("size").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "size").first()
    return most[0] if most else 0


def finite_rows(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the vectors that take part, and their components as doubles."""
    size = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    at = np.flatnonzero(size == dim) if dim else np.zeros(0, dtype=np.int64)
    if not len(at):
        return at, np.zeros((0, dim))
    flat = pc.fill_null(column.take(pa.array(at)).flatten().cast(pa.float64()), float("nan"))
    x = flat.to_numpy(zero_copy_only=False).reshape(len(at), dim)
    good = np.isfinite(x).all(axis=1)
    return at[good], x[good]


def whole(x: np.ndarray) -> np.ndarray:
    """``floor(256 * x)`` as 64-bit integers."""
    q = np.floor(SCALE * x)
    if q.size and max(q.max(), -q.min()) > LARGEST:
        raise ValueError(f"a component is outside of +-{LARGEST / SCALE:g}")
    return q.astype(np.int64)


def pack_rows(q: np.ndarray) -> list[bytes]:
    """Each row as bytes, all in the smallest integer type that holds them."""
    kind = next(k for k in (np.int16, np.int32) if not q.size or (q.max() <= np.iinfo(k).max and q.min() >= np.iinfo(k).min))
    raw, step = np.ascontiguousarray(q.astype(kind)).tobytes(), q.shape[1] * np.dtype(kind).itemsize
    return [raw[i:i + step] for i in range(0, len(raw), step)]


def unpack_rows(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of pack_rows, which may come from several of its calls."""
    raw = column.to_pylist()
    out = np.empty((len(raw), dim), dtype=np.int64)
    size = np.array([len(r) for r in raw])
    for kind in (np.int16, np.int32):
        own = np.flatnonzero(size == dim * np.dtype(kind).itemsize)
        if len(own):
            out[own] = np.frombuffer(b"".join(raw[i] for i in own), dtype=kind).reshape(len(own), dim)
    return out
