"""Line dedup by pairwise alignment.

A common block is a run of neighbouring lines of ``block_words`` words or more.  Documents
that share one are paired by the hashes of its least runs: from each line on, and up
to each line, the shortest run of so many words.  Every line of a block lies in such
a run that is within the block, and each later document is paired with the earliest
document that has the run.  So a run of k documents makes k - 1 pairs, not k * k,
however many documents have it, and no block is lost to a third document.
Documents that are smaller than a block are paired by their lines of ``anchor_words`` words or more,
by two neighbouring lines and, if they have one line only, by that.

Each pair is aligned by patience diff over all its lines: equal ends are taken
off, lines that are unique on both sides are matched in their longest ascending
chain, and the stretches between them are aligned in the same way.  A run that both have
but in another order, so that the alignment leaves it out, is aligned by itself.  Runs of
neighbouring aligned lines are common blocks; those of ``block_words`` words or
more, and any that is the whole later document, are deleted from the later one.
All is judged on the texts as they come in.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermill.llm.common import cut, fresh, hash_words, mix, text_slices

_LINES = "doc_id long, sig long, lines array<long>, words array<int>, kinds array<int>, keys array<long>"


def _ascending(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest chain ascending in both, of pairs ascending in the first."""
    tails: list[int] = []
    ends: list[int] = []
    back: list[int] = [-1] * len(pairs)
    for i, (_, y) in enumerate(pairs):
        k = bisect_left(tails, y)
        back[i] = ends[k - 1] if k else -1
        if k == len(tails):
            tails.append(y)
            ends.append(i)
        else:
            tails[k], ends[k] = y, i
    out, i = [], ends[-1] if ends else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned places (in ``b``, in ``a``) of two line sequences."""
    found: list[tuple[int, int]] = []
    work = [(0, len(a), 0, len(b))]
    while work:
        i, j, k, m = work.pop()
        while i < j and k < m and a[i] == b[k]:
            found.append((k, i))
            i, k = i + 1, k + 1
        while i < j and k < m and a[j - 1] == b[m - 1]:
            found.append((m - 1, j - 1))
            j, m = j - 1, m - 1
        if i >= j or k >= m:
            continue
        in_a, in_b = Counter(a[i:j]), Counter(b[k:m])
        at = {x: p for p, x in enumerate(a[i:j], i) if in_a[x] == 1 and in_b.get(x) == 1}
        chain = _ascending([(p, at[x]) for p, x in enumerate(b[k:m], k) if x in at])
        if chain:
            for (y, x), (y2, x2) in zip([(k - 1, i - 1), *chain], [*chain, (m, j)], strict=True):
                work.append((x + 1, x2, y + 1, y2))
            found += chain
    return sorted(found)


def blocks(aligned: list[tuple[int, int]], words: list[int], block_words: int) -> list[int]:
    """Lines of the later document in common blocks that are large enough."""
    out: list[int] = []
    run: list[int] = []
    whole = len(aligned) == len(words)
    for y, x in [*aligned, (-9, -9)]:
        if run and not (y == run[-1] + 1 and x == last + 1):
            if whole or sum(words[p] for p in run) >= block_words:
                out += run
            run = []
        run.append(y)
        last = x
    return out


def least_runs(words: np.ndarray, block_words: int) -> np.ndarray:
    """(first, last) of the shortest runs of ``block_words`` words from each line on and up to each line."""
    total = np.cumsum(words)
    before = total - words
    first = np.arange(len(words))
    last = np.searchsorted(total, before + block_words)
    on = np.stack([first, last], axis=1)[last < len(words)]
    start = np.searchsorted(before, total - block_words, "right") - 1
    up = np.stack([start, first], axis=1)[total >= block_words]
    return np.unique(np.concatenate([on, up]), axis=0)


_BASE, _BACK = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)


def run_hashes(lines: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """Hash of each run of lines, whatever stands around it."""
    with np.errstate(over="ignore"):
        power = np.cumprod(np.full(len(lines) + 1, _BASE, dtype=np.uint64))
        back = np.cumprod(np.full(len(lines) + 1, _BACK, dtype=np.uint64))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(lines * back[:-1])])
        own = (sums[runs[:, 1] + 1] - sums[runs[:, 0]]) * power[runs[:, 0]]
        return mix(own + (runs[:, 1] - runs[:, 0]).astype(np.uint64))


def anchors(lines: np.ndarray, words: np.ndarray, anchor_words: int, block_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of a document, and whether it looks for owners of them (2) or
    only has them (1)."""
    runs = least_runs(words, block_words)
    at = np.arange(len(words))
    one = at[(words >= anchor_words) & (words < block_words)]
    two = at[:-1][words[:-1] + words[1:] < block_words]
    small = np.concatenate([np.stack([one, one], axis=1), np.stack([two, two + 1], axis=1)])
    keys = np.concatenate([run_hashes(lines, runs), run_hashes(lines, small), mix(lines + np.uint64(1)) if len(lines) == 1 else lines[:0]])
    seeks = np.full(len(keys), 2 if words.sum() < block_words else 1)
    seeks[:len(runs)] = 2
    keys, first = np.unique(keys, return_index=True)
    return keys, seeks[first].astype(np.int32)


def moved(a: list[int], b: list[int], words: list[int], block_words: int, done: list[int]) -> list[int]:
    """Lines of ``b`` in least runs that ``a`` holds as well, if any is not in ``done``."""
    size = dict(zip(b, words, strict=True))
    held, left = set(), []
    for k, x in enumerate([*a, None]):
        if x in size:
            left.append(k)
        elif left:
            own = np.array([size[a[i]] for i in left])
            held.update(tuple(a[left[i]:left[j] + 1]) for i, j in least_runs(own, block_words))
            left = []
    out = set(done)
    for i, j in least_runs(np.array(words), block_words):
        if tuple(b[i:j + 1]) in held:
            out.update(range(i, j + 1))
    return sorted(out)


def line_table(df: DataFrame, text: str, doc_id: str, anchor_words: int, block_words: int) -> DataFrame:
    """For each row with an id: hashes and word counts of its lines that hold a
    word, and its anchors."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, texts in text_slices(b.column(2)):
                rows: list[list] = [[] for _ in range(4)]
                for body in texts:
                    own = [x for x in (line.split() for line in (body or b"").split(b"\n")) if x]
                    h = hash_words([b" ".join(x) for x in own])
                    n = np.array([len(x) for x in own], dtype=np.int64)
                    keys, kinds = anchors(h, n, anchor_words, block_words)
                    for column, v in zip(rows, (h.view(np.int64), n.astype(np.int32), kinds, keys.view(np.int64)), strict=True):
                        column.append(v)
                kinds_ = [pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), b.column(1).slice(i, j - i), *map(pa.array, rows, kinds_)],
                                                 names=["doc_id", "sig", "lines", "words", "kinds", "keys"])

    rows = df.where(F.col(doc_id).isNotNull()).select(
        F.col(doc_id).cast("long").alias("doc_id"), _signature(text).alias("sig"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(read, _LINES).dropDuplicates(["doc_id", "sig"])


def _signature(text: str) -> Column:
    """Tells the texts of one id apart."""
    return F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit("")))


def pairs_of(lines: DataFrame) -> DataFrame:
    """(later, earlier): each document with the earliest owner of each key it looks for."""
    keys = lines.select("doc_id", F.explode(F.arrays_zip("kinds", "keys")).alias("x")).select("doc_id", F.col("x.kinds").alias("kind"), F.col("x.keys").alias("key"))
    first = keys.groupBy("key").agg(F.min("doc_id").alias("earlier"), F.max("doc_id").alias("latest"))
    told = first.where("earlier < latest").select("key", "earlier")
    return keys.where("kind = 2").join(told, "key").where("earlier < doc_id").select(F.col("doc_id").alias("later"), "earlier").distinct()


def aligned_lines(df: DataFrame, text: str, doc_id: str, anchor_words: int, block_words: int) -> DataFrame:
    """For each later document (doc_id, sig): the numbers of its deleted lines,
    among those that hold a word, and the earlier documents they stand in."""
    lines = cut(line_table(df, text, doc_id, anchor_words, block_words))
    pairs = pairs_of(lines)
    own = lines.select("doc_id", "sig", "lines", "words")
    both = (pairs.join(own.withColumnsRenamed({"doc_id": "later", "lines": "b"}), "later")
            .join(own.drop("words", "sig").withColumnsRenamed({"doc_id": "earlier", "lines": "a"}), "earlier"))

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            later, sigs, earlier, found = [], [], [], []
            for x, sig, y, mine, words, theirs in zip(*(b.column(c).to_pylist() for c in ("later", "sig", "earlier", "b", "words", "a")), strict=True):
                hit = blocks(patience(theirs, mine), words, block_words)
                if len(hit) < len(mine):
                    hit = moved(theirs, mine, words, block_words, hit)
                if hit:
                    later.append(x)
                    sigs.append(sig)
                    earlier.append(y)
                    found.append(hit)
            yield pa.RecordBatch.from_arrays([pa.array(later, pa.int64()), pa.array(sigs, pa.int64()), pa.array(earlier, pa.int64()), pa.array(found, pa.list_(pa.int32()))],
                                             names=["doc_id", "sig", "earlier", "gone"])

    hits = both.select("later", "sig", "earlier", "b", "words", "a").mapInArrow(align, "doc_id long, sig long, earlier long, gone array<int>")
    # a later document has at most as many earlier ones as it has anchors
    return hits.groupBy("doc_id", "sig").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("gone")))).alias("gone"),
                                      F.array_sort(F.collect_set("earlier")).alias("sources"))


def line_dedup(df: DataFrame, text: str = "text", doc_id: str = "doc_id", anchor_words: int = 5, block_words: int = 10) -> DataFrame:
    """``df`` with the common blocks deleted from ``text``, and three columns more:
    n_lines and n_removed (lines that hold a word) and sources (ids of the
    earlier documents).  Columns of these names are replaced.

    Lines are equal if their words are; lines without a word are never aligned
    or deleted.  Null and empty texts have no lines and come back as they are.
    Rows with a null id are neither source nor target.  Rows that share an id
    are not compared with each other; what an earlier document holds of any of
    them is deleted from the row that has it.  Other columns pass through.
    """
    gone = aligned_lines(df, text, doc_id, anchor_words, block_words)
    added = ("n_lines", "n_removed", "sources")
    keep = [f for f in df.schema if f.name not in added]
    names = [f.name for f in keep]
    schema = ",".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep) + ",n_lines long,n_removed long,sources array<long>"
    id_, sig_, gone_, sources_ = (fresh(df, c) for c in ("_id_", "_sig_", "_gone_", "_sources_"))
    raw = df.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{doc_id}`").cast("long").alias(id_), _signature(text).alias(sig_))
    told = gone.select(F.col("doc_id").alias(id_), F.col("sig").alias(sig_), F.col("gone").alias(gone_), F.col("sources").alias(sources_))
    met = raw.join(told, [id_, sig_], "left").drop(id_, sig_)

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, totals, removed = [], [], []
            column = b.column(names.index(text))
            for i, j, slice_ in text_slices(column):
                for body, off in zip(slice_, b.column(gone_).slice(i, j - i).to_pylist(), strict=True):
                    lines = (body or b"").split(b"\n")
                    held = [k for k, line in enumerate(lines) if line.split()]
                    drop = {held[k] for k in off or () if k < len(held)}
                    totals.append(len(held))
                    removed.append(len(drop))
                    texts.append(b"\n".join(x for k, x in enumerate(lines) if k not in drop).decode() if drop else None if body is None else body.decode())
            out = [pa.array(texts, column.type) if c == text else b.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*out, pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), b.column(sources_)], names=[*names, *added])

    return met.mapInArrow(rebuild, schema)
