"""Packing token pieces into sequences: dominance reduction, then best fit.

Pieces of equal length are alike, so the instance is the histogram of lengths
(at most one entry a length up to the capacity, whatever the number of
documents).  Martello and Toth's reduction fixes small sets that dominate every
other way to fill a sequence; best fit decreasing packs what is left.  Both
work on counts and give a list of fillings with multiplicities.  The pieces
then look up their places by their rank among the pieces of their length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tiermill.llm.common import cut, partitions, text_slices
from tiermill.llm.tokens import word_ids

TOKENIZER = "word_bpe_49k.json"
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Where the installed vocabulary file of that name is, on any worker."""
    import public_tokenizers
    return public_tokenizers.path(name)


def token_pieces(df: DataFrame, text: str = "text", doc_id: str = "doc_id", capacity: int = 2048, end_id: int = 0,
                 tokenizer: str = TOKENIZER, with_ids: bool = False) -> DataFrame:
    """The pieces of each document: its ids, then ``end_id``; documents longer
    than ``capacity`` are cut there, and only those.  ``tokenizer`` is a path,
    or the name of an installed vocabulary.  With ``with_ids`` a column ``ids``
    (array of int) follows.  Null text is empty: one piece holding ``end_id``."""
    schema = PIECES + (", ids array<int>" if with_ids else "")
    end = int(end_id).to_bytes(4, "little")

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = word_ids(tokenizer if "/" in tokenizer else tokenizer_path(tokenizer))
        names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.list_(pa.int32())] * with_ids
        for b in batches:
            for i, j, texts in text_slices(b.column(1)):
                columns: list[list] = [[] for _ in names]
                for key, body in zip(b.column(0).slice(i, j - i).to_pylist(), texts, strict=True):
                    stream = ids_of(body or b"") + end
                    for k, at in enumerate(range(0, len(stream), 4 * capacity)):
                        part = stream[at:at + 4 * capacity]
                        row = [key, k, at // 4, len(part) // 4, zlib.crc32(part)]
                        if with_ids:
                            row.append(np.frombuffer(part, dtype="<u4").astype(np.int32))
                        for column, v in zip(columns, row, strict=True):
                            column.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(cut_up, schema)


def reduce_dominated(counts: np.ndarray, capacity: int) -> list[tuple[list[int], int]]:
    """Fix dominating sets; ``counts`` (by length) keeps what is left.

    For the longest piece j let k be the longest that fits beside it.  {j, k}
    dominates every filling with j if it is exactly full, or if no filling adds
    more to j than k does: no two pieces fit beside j, or the fullest two do
    not exceed k and no three fit.  With no partner at all, {j} is fixed.
    """
    fixed: list[tuple[list[int], int]] = []

    def largest(most: int) -> int:
        own = np.flatnonzero(counts[:max(most, 0) + 1])
        return int(own[-1]) if len(own) else 0

    def smallest(n: int) -> int | None:
        """Sum of the n shortest pieces."""
        total = 0
        for length in np.flatnonzero(counts):
            take = min(n, int(counts[length]))
            total, n = total + take * int(length), n - take
            if not n:
                return total
        return None

    def fullest_two(room: int) -> int:
        best, own = 0, np.flatnonzero(counts[:room + 1])
        lo, hi = 0, len(own) - 1
        while lo <= hi:
            a, b = int(own[lo]), int(own[hi])
            if a + b > room or lo == hi and counts[a] < 2:
                hi -= 1
            else:
                best, lo = max(best, a + b), lo + 1
        return best

    for j in range(capacity, 0, -1):
        while counts[j]:
            room = capacity - j
            counts[j] -= 1
            k = largest(room)
            if not k:
                counts[j] += 1
                fixed.append(([j], int(counts[j])))
                counts[j] = 0
                continue
            two, three = smallest(2), smallest(3)
            wins = j + k == capacity or two is None or two > room or \
                ((three is None or three > room) and fullest_two(room) <= k)
            counts[j] += 1
            if not wins:
                break
            n = int(counts[j]) // 2 if k == j else int(min(counts[j], counts[k]))
            fixed.append(([j, k], n))
            counts[j] -= n
            counts[k] -= n
    return fixed


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[list[int], int]]:
    """Best fit decreasing on counts: each piece goes to the open sequence with
    the least room that still takes it."""
    open_: dict[int, list[tuple[list[int], int]]] = {}
    done: list[tuple[list[int], int]] = []

    def put(filling: list[int], n: int) -> None:
        room = capacity - sum(filling)
        (open_.setdefault(room, []) if room else done).append((filling, n))

    for length in range(capacity, 0, -1):
        left = int(counts[length])
        while left:
            room = min((r for r in open_ if r >= length), default=None)
            if room is None:
                each = capacity // length
                if left >= each:
                    put([length] * each, left // each)
                    left %= each
                else:
                    put([length] * left, 1)
                    left = 0
                continue
            filling, n = open_[room].pop()
            if not open_[room]:
                del open_[room]
            each = min(room // length, left)  # its room stays the least while it is filled
            full = min(n, left // each)
            put(filling + [length] * each, full)
            left -= full * each
            if n > full:
                put(filling, n - full)
    return done + [x for own in open_.values() for x in own]


def fillings(counts: np.ndarray, capacity: int) -> list[tuple[list[int], int]]:
    """All fillings with their multiplicities for a histogram of lengths."""
    left = counts.copy()
    return reduce_dominated(left, capacity) + best_fit(left, capacity)


def _places(plan: list[tuple[list[int], int]]) -> pd.DataFrame:
    """For each length, ranges of ranks and where they go: a rank r from
    ``rank`` on has the sequence ``base + (r - rank) // each`` and there the
    offset ``at + (r - rank) % each * length``."""
    seen: dict[int, int] = {}
    rows, base = [], 0
    for filling, n in plan:
        at, i = 0, 0
        while i < len(filling):
            length, each = filling[i], 1
            while i + each < len(filling) and filling[i + each] == length:
                each += 1
            rank = seen.get(length, 0)
            rows.append((length, rank, rank + n * each, base, each, at))
            seen[length] = rank + n * each
            at, i = at + each * length, i + each
        base += n
    return pd.DataFrame(rows, columns=["length", "rank", "rank_end", "base", "each", "at"], dtype=np.int64)


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """Add sequence_id and offset to rows with doc_id, piece and length.

    Empty input gives no rows; repeated rows are packed each for itself.  The
    histogram and the fillings are bound by the capacity; both pass the driver.
    """
    spark = pieces.sparkSession
    groups = 4 * partitions(spark)
    grouped = pieces.withColumn("_g", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(groups)).cast("int"))
    sizes = cut(grouped.groupBy("_g", "length").agg(F.count(F.lit(1)).alias("_n")))
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in sizes.groupBy("length").agg(F.sum("_n")).collect():
        counts[length] = n
    places = _places(fillings(counts, capacity))
    by_length = {int(k): v.to_numpy() for k, v in places.groupby("length")}

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            length, rank = b["length"].to_numpy(), b.pop("_r").to_numpy()
            seq, offset = np.zeros(len(b), dtype=np.int64), np.zeros(len(b), dtype=np.int64)
            for own in np.unique(length):
                p, rows = by_length[int(own)], np.flatnonzero(length == own)
                hit = p[np.searchsorted(p[:, 1], rank[rows], "right") - 1]
                step = rank[rows] - hit[:, 1]
                seq[rows], offset[rows] = hit[:, 3] + step // hit[:, 4], hit[:, 5] + step % hit[:, 4] * own
            yield b.assign(sequence_id=seq, offset=offset)

    before = Window.partitionBy("length").orderBy("_g").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.withColumn("_first", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    rank = F.row_number().over(Window.partitionBy("_g", "length").orderBy("doc_id", "piece")) - 1
    ranked = grouped.withColumn("_r", rank).join(first, ["_g", "length"])
    ranked = ranked.select(*pieces.columns, (F.col("_r") + F.col("_first")).cast("long").alias("_r"))
    out = pieces.schema.simpleString()[7:-1] + ",sequence_id:bigint,offset:bigint"
    return ranked.mapInPandas(placed, out)


def pack_documents(df: DataFrame, text: str = "text", doc_id: str = "doc_id", capacity: int = 2048, end_id: int = 0,
                   tokenizer: str = TOKENIZER) -> DataFrame:
    """Tokenize and pack whole documents; one row a piece.

    Null ids are kept, null texts are one piece of ``end_id``, other columns
    are ignored whatever their names."""
    return pack(cut(token_pieces(df, text, doc_id, capacity, end_id, tokenizer)), capacity)
