"""Helpers shared by the operators of this subpackage.

A word is a maximal run of bytes other than ASCII white space
(``[^\\x20\\x09-\\x0D]+``).  ``bytes.split()`` cuts exactly there, and
``bytes.lower()`` lower-cases exactly A-Z, so the words of a text are taken
from its UTF-8 form.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from tiermill import session

#: Text handled at once inside a task; longer single documents count as one.
BATCH_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, read whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    session.checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def partitions(spark: SparkSession) -> int:
    """Shuffle partitions of the session, which the deployment sizes by its data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def texts_of(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column."""
    return column.cast(pa.binary()).to_pylist()


def pieces(texts: list[bytes | None], limit: int = BATCH_BYTES):
    """Index ranges of about ``limit`` bytes of text, one document at least."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text or b"")
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def text_slices(column: pa.Array, limit: int = BATCH_BYTES):
    """(first, end, texts) of stretches of a string column of about ``limit`` bytes."""
    size = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(column):
        done = size[start - 1] if start else 0
        end = min(len(column), int(np.searchsorted(size, done + limit)) + 1)
        yield start, end, texts_of(column.slice(start, end - start))
        start = end


def word_hashes(texts: list[bytes | None], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words, and the number of words of each text."""
    words: list[bytes] = []
    counts = np.zeros(len(texts), dtype=np.int64)
    for i, text in enumerate(texts):
        if text:
            own = (text.lower() if lower else text).split()
            counts[i] = len(own)
            words += own
    return hash_words(words), counts


def hash_words(words: list[bytes]) -> np.ndarray:
    if not words:
        return np.zeros(0, dtype=np.uint64)
    box = np.empty(len(words), dtype=object)
    box[:] = words
    return pd.util.hash_array(box, categorize=False)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finalizer (constants of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(words: np.ndarray, size: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Hash of each run of ``size`` consecutive words; empty if there are fewer.
    The order of the words counts: each place multiplies by the odd ``base``."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            out = out * np.uint64(base) + words[k:k + n]
        return mix(out)


def starts_of(counts: np.ndarray) -> np.ndarray:
    """First index of each document in the concatenation."""
    return np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64) if len(counts) else counts
