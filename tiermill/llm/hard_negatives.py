"""Hard negatives by blocked exact multiplication.

All rows stand in candidate tiles, the anchors (the stated query set) in blocks,
both as whole-number matrices.  Each tile meets each block once: their scores
are a product of two int64 matrices, multiplied by Strassen's recursion with
zero padding.  A task keeps, for each anchor it meets, heaps of the few
best, which it merges tile by tile; Spark merges those of different tasks.

Two passes: the first finds each anchor's positives, the second the negatives
in the score window of each positive.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiermill.llm.common import cut
from tiermill.llm.vectors import common_length, finite_rows, pack_rows, unpack_rows, whole

#: Candidates in a tile, anchors in a block, and blocks that one task may hold.
TILE, BLOCK, BLOCKS = 4096, 512, 16
#: Below this size in any dimension, matrices are multiplied directly.
LEAF = 32

_SHEET = "ids binary, labels binary, x binary"


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """Exact product of int64 matrices; odd sizes are padded with zeros.  The
    caller sees to it that the result, and Strassen's sums, fit 64 bits."""
    m, k = a.shape
    n = b.shape[1]
    if min(m, k, n) <= leaf:
        return _product(a, b)
    if m % 2 or k % 2 or n % 2:
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
        b = np.pad(b, ((0, k % 2), (0, n % 2)))
    i, j, l = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :l], b[:j, l:], b[j:, :l], b[j:, l:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * i, 2 * l), dtype=np.int64)
    out[:i, :l] = p1 + p4 - p5 + p7
    out[:i, l:] = p3 + p5
    out[i:, :l] = p2 + p4
    out[i:, l:] = p1 - p2 + p3 + p6
    return out[:m, :n]


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Leaf of the recursion.  Where all sums stay below 2**53 a product of doubles
    is the same whole number and takes a fraction of the time."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


class Heaps:
    """The ``size`` best (score, id) of each of n keys: higher scores first, ties
    by smaller id.  Merging is associative, so tiles may come in any order."""

    def __init__(self, n: int, size: int):
        self.n, self.size = n, size
        self.key, self.score, self.id = (np.zeros(0, dtype=np.int64) for _ in range(3))
        #: Score of the last of a full heap: anything below cannot enter.
        self.bar = np.full(n, np.iinfo(np.int64).min)

    def merge(self, key: np.ndarray, score: np.ndarray, id_: np.ndarray) -> None:
        able = score >= self.bar[key]
        if not able.any():
            return
        key, score, id_ = (np.concatenate([old, new[able]]) for old, new in ((self.key, key), (self.score, score), (self.id, id_)))
        order = np.lexsort((id_, -score, key))
        key = key[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        place = np.arange(len(key)) - np.repeat(first, np.diff(np.append(first, len(key))))
        best = place < self.size
        self.key, self.score, self.id = key[best], score[order][best], id_[order][best]
        full = place[best] == self.size - 1
        self.bar[self.key[full]] = self.score[full]


def _sheet(ids: np.ndarray, labels: np.ndarray, x: np.ndarray) -> tuple[bytes, bytes, bytes]:
    return ids.astype("<i8").tobytes(), labels.astype("<i8").tobytes(), b"".join(pack_rows(x))


def _open(ids: bytes, labels: bytes, x: bytes, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    own = np.frombuffer(ids, "<i8")
    step = len(x) // max(1, len(own))
    return own, np.frombuffer(labels, "<i8"), unpack_rows(pa.array([x[i:i + step] for i in range(0, len(x), step)], pa.binary()), dim)


def _sheets(rows: DataFrame, dim: int, size: int) -> DataFrame:
    """Rows (id, label, vector) as sheets of up to ``size`` rows; vectors that take
    no part are left out."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        n = 0

        def sheet(own) -> pa.RecordBatch:
            values = _sheet(*(np.concatenate(c) for c in zip(*own, strict=True)))
            return pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in values], names=["ids", "labels", "x"])

        for batch in batches:
            for i in range(0, batch.num_rows, size):
                piece = batch.slice(i, size)
                at, x = finite_rows(piece.column(2), dim)
                ids, labels = (piece.column(c).to_numpy(zero_copy_only=False)[at].astype(np.int64) for c in range(2))
                held.append((ids, labels, whole(x)))
                n += len(at)
                if n >= size:
                    whole_ = [np.concatenate(c) for c in zip(*held, strict=True)]
                    yield sheet([[c[:size] for c in whole_]])
                    held, n = [tuple(c[size:] for c in whole_)], n - size
        if n:
            yield sheet(held)

    return rows.mapInArrow(gather, _SHEET)


_HEAP = "block long, key int, score long, id long"


def _merged(heaps: dict[int, Heaps]) -> Iterator[pa.RecordBatch]:
    for block, h in heaps.items():
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h.key), block), pa.int64()), pa.array(h.key.astype(np.int32)), pa.array(h.score), pa.array(h.id)],
                                         names=["block", "key", "score", "id"])


def _first(heaps: DataFrame, size: int) -> DataFrame:
    """The ``size`` best of each (block, key) over all tasks, with their rank; Spark
    limits each task's rows before it shuffles them."""
    order = Window.partitionBy("block", "key").orderBy(F.desc("score"), "id")
    return heaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)


def _met(tiles: DataFrame, blocks: DataFrame) -> DataFrame:
    """Each candidate tile with each block of the query set.  Neither side is
    hinted: Spark broadcasts blocks that are small enough, and else pairs
    partitions without a shuffle."""
    return tiles.crossJoin(blocks)


def mine_negatives(df: DataFrame, anchor: Column, label: Column, vector: str = "embedding", vec_id: str = "vec_id", positives: int = 5,
                   negatives: int = 5, least: int = 80) -> DataFrame:
    """For each anchor and each of its positives, the first ``negatives`` rows of
    another label with ``least * p <= 100 * score <= 100 * p``, where p is the positive's score.

    ``anchor`` and ``label`` are expressions over ``df``; an anchor's positives are
    its first ``positives`` other rows of equal label.  Scores are integer inner
    products of ``floor(256 * x)``; higher ones come first, ties by smaller id.
    Rows: anchor_id, positive_id, rank (from 1), negative_id, positive_score,
    negative_score.  An anchor without positives, and a positive without
    negatives, give no row.

    Rows with a null id, label or vector, with a vector of another than the common
    length or with a null or non-finite component take no part; components beyond
    +-4096 raise.  Rows that share an id are rows of their own, and each of them is
    an anchor if that id is one; but no anchor meets its own id.  Columns of other
    names are ignored.
    """
    dim = common_length(df, vector)
    rows = df.select(F.col(f"`{vec_id}`").cast("long").alias("id"), label.cast("long").alias("label"), F.col(f"`{vector}`").alias("vector"),
                     anchor.alias("anchor")).where("id is not null and label is not null and vector is not null")
    tiles = cut(_sheets(rows.select("id", "label", "vector"), dim, TILE).withColumnsRenamed({"ids": "t_ids", "labels": "t_labels", "x": "t_x"}))
    asked = rows.where("anchor").select("id", "label", "vector")
    parts = -(-asked.count() // (BLOCK * BLOCKS)) or 1
    blocks = cut(_sheets(asked.repartition(parts), dim, BLOCK).withColumn("block", F.monotonically_increasing_id()))

    def scores(row: dict) -> tuple[tuple[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        a_ids, a_labels, a = _open(row["ids"], row["labels"], row["x"], dim)
        t_ids, t_labels, t = _open(row["t_ids"], row["t_labels"], row["t_x"], dim)
        s = strassen(a, np.ascontiguousarray(t.T))
        return (s, a_labels[:, None] == t_labels[None], a_ids[:, None] != t_ids[None]), (a_ids, t_ids)

    def singly(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield {c: batch.column(c)[i].as_py() for c in batch.schema.names}

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[int, Heaps] = {}
        for row in singly(batches):
            (s, same, other), (a_ids, t_ids) = scores(row)
            h = heaps.setdefault(row["block"], Heaps(len(a_ids), positives))
            at, c = np.nonzero(same & other & (s >= h.bar[:, None]))
            h.merge(at, s[at, c], t_ids[c])
        yield from _merged(heaps)

    found = cut(_first(_met(tiles, blocks).mapInArrow(best, _HEAP), positives))
    windows = found.groupBy("block").agg(F.collect_list("key").alias("w_key"), F.collect_list("rank").alias("w_rank"), F.collect_list("score").alias("w_score"))
    ruled = cut(blocks.join(windows, "block"))

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[int, Heaps] = {}
        for row in singly(batches):
            (s, same, other), (a_ids, t_ids) = scores(row)
            low, high = np.ones((len(a_ids), positives), dtype=np.int64), np.zeros((len(a_ids), positives), dtype=np.int64)
            at, rank, p = (np.array(row[c], dtype=np.int64) for c in ("w_key", "w_rank", "w_score"))
            low[at, rank - 1], high[at, rank - 1] = -(-least * p // 100), p
            h = heaps.setdefault(row["block"], Heaps(len(a_ids) * positives, negatives))
            bar = np.maximum(low, h.bar.reshape(low.shape))
            open_ = low <= high
            floor = np.where(open_, bar, np.iinfo(np.int64).max).min(axis=1)
            roof = np.where(open_, high, np.iinfo(np.int64).min).max(axis=1)
            at, c = np.nonzero((s >= floor[:, None]) & (s <= roof[:, None]) & ~same & other)
            score = s[at, c]
            for r in range(positives):
                fits = (score >= low[at, r]) & (score <= high[at, r])
                h.merge(at[fits] * positives + r, score[fits], t_ids[c[fits]])
        yield from _merged(heaps)

    hard = _first(_met(tiles, ruled).mapInArrow(within, _HEAP), negatives).select(
        "block", F.col("key").alias("window"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    told = found.select("block", "key", (F.col("key") * positives + F.col("rank") - 1).alias("window"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = np.frombuffer(ids, "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), block)), pa.array(np.arange(len(own), dtype=np.int32)), pa.array(own)], names=["block", "key", "anchor_id"])

    anchors = blocks.select("block", "ids").mapInArrow(names, "block long, key int, anchor_id long")
    return (hard.join(told, ["block", "window"]).join(anchors, ["block", "key"])
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
