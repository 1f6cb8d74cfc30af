"""Histogram sort into shards of near equal bytes.

Rows are ordered by the key (hash of the text, hash of the id), so equal texts
stand together and a large group of copies can still be cut in its middle.
Instead of sorting first, candidate boundaries ("cuts") are probed: each round
counts exactly the bytes and rows between neighbouring cuts over all partitions
and draws new cuts only from the intervals that still hold an unmet target.
When every shard boundary is within tolerance of its target, the rows are
exchanged once, by the interval they fall into.  Intervals are held small in
rows as well, so that no task numbers a whole shard.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tiermill.llm.common import cut, partitions

#: Cuts drawn at a time from an interval that holds an unmet target.
DRAWN = 64


def _place(h: np.ndarray, g: np.ndarray, cuts: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Number of cuts at or below each key (h, g)."""
    ch, cg = cuts
    first, last = np.searchsorted(ch, h, "left"), np.searchsorted(ch, h, "right")
    out = first.copy()
    tied = np.flatnonzero(last > first)
    for a in np.unique(first[tied]):
        rows = tied[first[tied] == a]
        out[rows] = a + np.searchsorted(cg[a:last[rows[0]]], g[rows], "right")
    return out


def _count(keyed: DataFrame, cuts: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Exact bytes and rows of each of the ``len(cuts) + 1`` intervals."""
    n = len(cuts[0]) + 1

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size, rows = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        for b in batches:
            at = _place(b["h"].to_numpy(), b["g"].to_numpy(), cuts)
            np.add.at(size, at, b["size"].to_numpy())
            rows += np.bincount(at, minlength=n)
        own = np.flatnonzero(rows)
        yield pd.DataFrame({"cell": own, "bytes": size[own], "rows": rows[own]})

    found = (keyed.select("h", "g", "size").mapInPandas(partial, "cell long, bytes long, rows long")
             .groupBy("cell").agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")).toPandas())
    size, rows = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    size[found["cell"]], rows[found["cell"]] = found["bytes"], found["rows"]
    return size, rows


def _draw(keyed: DataFrame, cuts: tuple[np.ndarray, np.ndarray], rate: np.ndarray, salt: int) -> list[tuple[int, int]]:
    """Distinct keys drawn by their hash, at the given rate in each interval."""

    def drawn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            h, g = b["h"].to_numpy(), b["g"].to_numpy()
            r = rate[_place(h, g, cuts)]
            with np.errstate(over="ignore"):
                x = (h ^ np.int64(salt)) * np.int64(-7046029254386353131) + g * np.int64(-4417276706812531889)
                x = (x.view(np.uint64) ^ (x.view(np.uint64) >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            yield b.loc[(x >> np.uint64(11)).astype(np.float64) < r * 2.0 ** 53, ["h", "g"]]

    return [tuple(r) for r in keyed.select("h", "g").mapInPandas(drawn, "h long, g long").distinct().collect()]


def histogram_shards(df: DataFrame, text: str = "text", doc_id: str = "doc_id", shards: int = 8,
                     tolerance: float = 0.001) -> DataFrame:
    """Deal ``df`` into ``shards`` key ranges of near equal bytes.

    A row weighs the UTF-8 bytes of its text plus 1.  Each shard boundary lies
    within ``tolerance`` of a shard's bytes from its target, or at the nearest
    key if a single key weighs more.  Returns doc_id, size, text_crc32, shard
    and slot (the place in the shard, gapless from 0, in key order).

    Null text counts as empty (size 1, crc 0).  Rows with a null id have a key
    each, after the hash of the text, so any number of them can be cut.
    Rows that repeat an id and a text have one key, stay in one shard and get
    neighbouring slots.  An empty table gives no rows.  Other columns are
    ignored, whatever their names.

    The driver holds only the cuts: about four a shuffle partition and
    ``DRAWN`` for each unmet target.
    """
    spark = df.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    keyed = cut(df.select(F.col(doc_id).alias("doc_id"), (F.octet_length(body) + F.lit(1)).cast("long").alias("size"),
                          F.crc32(body.cast("binary")).alias("text_crc32"), F.xxhash64(body).alias("h"),
                          F.when(F.col(doc_id).isNull(), F.xxhash64(F.monotonically_increasing_id())).otherwise(F.xxhash64(F.col(doc_id))).alias("g")))
    cells = max(shards, partitions(spark))
    ch = np.linspace(-2.0 ** 63, 2.0 ** 63, 4 * cells + 1)[1:-1].astype(np.int64)
    cuts = (ch, np.full(len(ch), -2 ** 63, dtype=np.int64))
    known: set[tuple[int, int] | None] = set()  # cuts that begin an interval of one key
    misses: dict[tuple[int, int] | None, int] = {}  # draws without a new key, by interval
    for salt in count(1):  # each round adds a cut, raises a rate or ends an interval
        size, rows = _count(keyed, cuts)
        below = np.concatenate([[0], np.cumsum(size)])
        total, each = below[-1], max(1, rows.sum() // cells)
        targets = total * np.arange(1, shards) / shards
        at = np.searchsorted(below, targets, "right") - 1  # the interval that holds each target
        off = np.minimum(targets - below[at], below[np.minimum(at + 1, len(size))] - targets)
        unmet = {int(i) for i in at[off > tolerance * total / shards]} | {int(i) for i in np.flatnonzero(rows > 2 * each)}
        keys = list(zip(cuts[0].tolist(), cuts[1].tolist(), strict=True))
        unmet = {i for i in unmet if (keys[i - 1] if i else None) not in known and rows[i] > 1}
        if not unmet:
            break
        rate = np.zeros(len(size))
        for i in unmet:
            rate[i] = min(1.0, DRAWN * 2.0 ** misses.get(keys[i - 1] if i else None, 0) / rows[i])
        new = set(_draw(keyed, cuts, rate, salt)) - set(keys)
        met = set(_place(*np.array(sorted(new), dtype=np.int64).reshape(-1, 2).T, cuts).tolist())
        for i in unmet - met:
            begin = keys[i - 1] if i else None
            if rate[i] == 1.0:  # every key of the interval was drawn, and is a cut already
                known.add(begin)
            else:
                misses[begin] = misses.get(begin, 0) + 1
        keys = sorted(set(keys) | new)
        cuts = (np.array([k[0] for k in keys], dtype=np.int64), np.array([k[1] for k in keys], dtype=np.int64))

    ends = np.array([below[i] if targets[j] - below[i] <= below[i + 1] - targets[j] else below[i + 1]
                     for j, i in enumerate(np.minimum(at, len(size) - 1))])
    shard_of = np.searchsorted(ends, below[:-1], "right") if total else np.zeros(len(size), dtype=np.int64)
    before = np.concatenate([[0], np.cumsum(rows)])[:-1]
    first = np.array([before[np.searchsorted(shard_of, s, "left")] for s in shard_of])
    cell = pd.DataFrame({"cell": np.arange(len(size)), "shard": shard_of.astype(np.int32), "base": before - first})
    cell = cell[rows > 0]

    def dealt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(cell=_place(b["h"].to_numpy(), b["g"].to_numpy(), cuts))

    placed = keyed.mapInPandas(dealt, keyed.schema.simpleString()[7:-1] + ",cell:bigint")
    # one row an interval: its size is bound by the cuts, not by the data
    bounds = F.broadcast(spark.createDataFrame(cell, "cell long, shard int, base long"))
    order = Window.partitionBy("cell").orderBy("h", "g", "doc_id")
    return (placed.withColumn("n", F.row_number().over(order)).join(bounds, "cell")
            .select("doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("n") - 1).alias("slot")))
