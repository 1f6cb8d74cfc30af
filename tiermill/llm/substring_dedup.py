"""Exact repeats across documents by fixed-block anchors.

Any run of ``window`` words holds a whole block of ``block = (window + 1) // 2``
words that begins at a multiple of ``block`` in its document.  So the index
holds only the non-overlapping blocks of each document, and every rolling window
of ``block`` words of every document probes it.  A hit is a block that two
documents share.  Each hit is extended: the ``window``-word runs around it are
compared by 128-bit value over all documents, and the smallest id that has each
of them is found.  Neighbouring runs that an earlier document has merge into
maximal repeats.

Documents are dealt into groups by the hash of their ids.  A group sorts what it
has and sends one row for each hash range, with each value once, so a passage
that stands in a third of all documents costs a row entry a group.  Index and
probes travel as 32 bits within their range: a chance agreement only adds a run
to be compared, it cannot change the result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.llm.blobs import pack, pack_sorted, range_of, run_numbers, runs, spans, unpack, unpack_sorted
from tiermill.llm.common import mix, partitions, pieces, starts_of, texts_of, window_hashes, word_hashes

_PROBES = "part int, g int, value binary, aligned binary, several binary"
_BITS = "g int, part int, bits binary, a binary, b binary, owner binary"
_RUNS = "part int, g int, a binary, b binary, owner binary"
#: Second base of the word-order hash, for the other 64 bits of a run.
_BASE = 0xD1342543DE82EF95


@dataclass
class Group:
    """The documents of a group that have an id, in order of their ids."""

    rows: np.ndarray  # their places in the table
    ids: np.ndarray
    texts: list[bytes | None]
    words: np.ndarray
    counts: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)


def _group(t: pa.Table) -> Group:
    ids = t.column("doc_id").to_pylist()
    rows = np.array(sorted((i for i, x in enumerate(ids) if x is not None), key=ids.__getitem__), dtype=np.int64)
    raw = texts_of(t.column("text").combine_chunks())
    texts = [raw[i] for i in rows]
    parts = [word_hashes(texts[i:j]) for i, j in pieces(texts)]
    words = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, dtype=np.uint64)
    counts = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, dtype=np.int64)
    return Group(rows, np.array([ids[i] for i in rows], dtype=np.int64), texts, words, counts)


def _whole(g: Group, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places where a run of ``size`` words lies within a document, and its document."""
    doc = g.doc
    at = np.flatnonzero(doc[:max(0, len(doc) - size + 1)] == doc[size - 1:]) if len(doc) >= size else np.zeros(0, dtype=np.int64)
    return at, doc[at]


@dataclass
class Probes:
    """The distinct probe values of a group, in order of part and value."""

    at: np.ndarray  # places of the probes, in order of their value
    number: np.ndarray  # the distinct value of each
    part: np.ndarray
    value: np.ndarray
    aligned: np.ndarray
    several: np.ndarray  # whether two documents of the group have it


def _probes(g: Group, block: int, parts: int) -> Probes:
    at, doc = _whole(g, block)
    h = window_hashes(g.words, block)[at] if len(at) else np.zeros(0, dtype=np.uint64)
    part = range_of(h, parts)
    key = (part << np.uint64(32)) | (mix(h) >> np.uint64(32))
    order = np.argsort(key, kind="stable")
    key, at, doc = key[order], at[order], doc[order]
    first = runs(key)
    number = run_numbers(first, len(key))
    aligned = (at - starts_of(g.counts)[doc]) % block == 0
    last = np.append(first[1:], len(key)) - 1
    some = np.logical_or.reduceat(aligned, first) if len(first) else aligned
    return Probes(at, number, (key[first] >> np.uint64(32)).astype(np.int64), key[first] & np.uint64(0xFFFFFFFF),
                  some, doc[first] != doc[last] if len(first) else some)


def _binary(rows: list[tuple], schema: str) -> pa.Table:
    names = [x.strip().split(" ") for x in schema.split(",")]
    kinds = {"int": pa.int32(), "binary": pa.binary()}
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.table([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, names, strict=True)], names=[n for n, _ in names])


def _candidates(g: Group, bits: dict[int, bytes], window: int, block: int, parts: int) -> tuple[np.ndarray, ...]:
    """The runs around all hits: their places and both hashes, in order of the
    hashes, and the first index and number of each distinct run."""
    p = _probes(g, block, parts)
    hit = np.zeros(len(p.part), dtype=bool)
    for part, i, j in spans(p.part):
        if part in bits:
            hit[i:j] = np.unpackbits(np.frombuffer(bits[part], dtype=np.uint8), count=j - i).astype(bool)
    mark = np.zeros(len(g.words) + 1, dtype=np.int64)
    mark[p.at[hit[p.number]] + 1] = 1
    seen = np.cumsum(mark)  # hits before each place
    at, doc = _whole(g, window)
    keep = seen[at + window - block + 1] > seen[at]
    at, doc = at[keep], doc[keep]
    if len(at):
        a, b = window_hashes(g.words, window)[at], window_hashes(g.words, window, _BASE)[at]
    else:
        a = b = np.zeros(0, dtype=np.uint64)
    order = np.lexsort((b, a))  # stable, so the smallest id of a run comes first
    at, doc, a, b = at[order], doc[order], a[order], b[order]
    first = runs(a, b)
    return at, doc, a, b, first, run_numbers(first, len(a))


def substring_dedup(df: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = 13) -> DataFrame:
    """Remove every word inside a run of ``window`` words that a document with a
    smaller id has too, judged on the texts as they come in.

    Returns one row for each row of ``df``: doc_id, n_words, n_removed, spans
    (maximal removed stretches, as word numbers [start, end)) and kept (the
    words left, joined by one space).

    Null and empty texts have no words.  A row with a null id is neither a
    source nor a target: nothing is removed from it.  Rows that share an id are
    judged each for itself and never against each other.  Other columns are
    ignored, whatever their names.
    """
    block = (window + 1) // 2
    parts = partitions(df.sparkSession)
    groups = 2 * parts
    rows = df.select(F.pmod(F.xxhash64(F.col(doc_id)), F.lit(groups)).cast("int").alias("g"),
                     F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    docs = rows.where(F.col("doc_id").isNotNull())

    def probe(t: pa.Table) -> pa.Table:
        p = _probes(_group(t), block, parts)
        own = t.column("g")[0].as_py()
        return _binary([(part, own, pack_sorted(p.value[i:j]), np.packbits(p.aligned[i:j]).tobytes(), np.packbits(p.several[i:j]).tobytes())
                        for part, i, j in spans(p.part)], _PROBES)

    def hits(t: pa.Table) -> pa.Table:
        rows = t.to_pydict()
        values = [unpack_sorted(v) for v in rows["value"]]
        sizes = [len(v) for v in values]
        flags = [np.concatenate([np.unpackbits(np.frombuffer(f, dtype=np.uint8), count=n) for f, n in zip(rows[c], sizes, strict=True)]).astype(bool)
                 for c in ("aligned", "several")]
        value = np.concatenate(values)
        order = np.argsort(value, kind="stable")
        first = runs(value[order])
        many = np.diff(np.append(first, len(value))) > 1
        found = np.logical_or.reduceat(flags[0][order], first) & (many | np.logical_or.reduceat(flags[1][order], first))
        hit = np.zeros(len(value), dtype=bool)
        hit[order] = found[run_numbers(first, len(value))]
        ends = np.cumsum(sizes)
        return _binary([(g, part, np.packbits(hit[e - n:e]).tobytes(), None, None, None) for g, part, n, e in
                        zip(rows["g"], rows["part"], sizes, ends, strict=True) if hit[e - n:e].any()], _BITS)

    def extend(t: pa.Table, bits: pa.Table) -> pa.Table:
        if not t.num_rows:
            return _binary([], _RUNS)
        g = _group(t)
        _, doc, a, b, first, _ = _candidates(g, dict(zip(*(bits.column(c).to_pylist() for c in ("part", "bits")), strict=True)), window, block, parts)
        a, b, owner = a[first], b[first], g.ids[doc[first]].view(np.uint64)
        own = t.column("g")[0].as_py()
        return _binary([(part, own, pack_sorted(a[i:j]), pack(b[i:j]), pack(owner[i:j])) for part, i, j in spans(range_of(a, parts).astype(np.int64))], _RUNS)

    def owners(t: pa.Table) -> pa.Table:
        rows = t.to_pydict()
        own = [unpack_sorted(x) for x in rows["a"]]
        a, b = np.concatenate(own), np.concatenate([unpack(x) for x in rows["b"]])
        owner = np.concatenate([unpack(x) for x in rows["owner"]]).view(np.int64)
        order = np.lexsort((b, a))
        first = runs(a[order], b[order])
        least = np.empty(len(a), dtype=np.int64)
        least[order] = np.minimum.reduceat(owner[order], first)[run_numbers(first, len(a))]
        ends, out = np.cumsum([len(x) for x in own]), []
        for g, part, x, e in zip(rows["g"], rows["part"], own, ends, strict=True):
            at = np.arange(e - len(x), e)
            at = at[least[at] < owner[at]]
            if len(at):
                out.append((g, part, None, pack_sorted(a[at]), pack(b[at]), pack(least[at].view(np.uint64))))
        return _binary(out, _BITS)

    def remove(t: pa.Table, found: pa.Table) -> pa.Table:
        g = _group(t)
        rows = found.to_pydict()
        bits = {p: x for p, x in zip(rows["part"], rows["bits"], strict=True) if x is not None}
        at, doc, a, b, first, number = _candidates(g, bits, window, block, parts)
        least = g.ids[doc[first]]
        told = [(x, y, z) for x, y, z in zip(rows["a"], rows["b"], rows["owner"], strict=True) if x is not None]
        if told:
            ta, tb = np.concatenate([unpack_sorted(x[0]) for x in told]), np.concatenate([unpack(x[1]) for x in told])
            tc = np.concatenate([unpack(x[2]) for x in told]).view(np.int64)
            both_a, both_b = np.concatenate([a[first], ta]), np.concatenate([b[first], tb])
            both = np.concatenate([least, tc])
            order = np.lexsort((both_b, both_a))
            heads = runs(both_a[order], both_b[order])
            low = np.empty(len(both), dtype=np.int64)
            low[order] = np.minimum.reduceat(both[order], heads)[run_numbers(heads, len(both))]
            least = low[:len(least)]
        covered = at[least[number] < g.ids[doc]]
        edge = np.zeros(len(g.words) + 1, dtype=np.int64)
        np.add.at(edge, covered, 1)
        np.add.at(edge, covered + window, -1)
        gone = np.cumsum(edge[:-1]) > 0
        n = t.num_rows
        n_words, n_removed, kept, spans = [0] * n, [0] * n, [""] * n, [[] for _ in range(n)]
        raw = texts_of(t.column("text").combine_chunks())
        first_word = starts_of(g.counts)
        own_of = {int(r): k for k, r in enumerate(g.rows)}
        for r in range(n):
            words = (raw[r] or b"").split()
            n_words[r] = len(words)
            if r in own_of:
                off = gone[first_word[own_of[r]]:first_word[own_of[r]] + len(words)]
                if off.any():
                    n_removed[r] = int(off.sum())
                    step = np.flatnonzero(np.diff(np.concatenate([[False], off, [False]]).astype(np.int8)))
                    spans[r] = [{"start": int(x), "end": int(y)} for x, y in step.reshape(-1, 2)]
                    words = [w for w, x in zip(words, off, strict=True) if not x]
            kept[r] = b" ".join(words).decode()
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.table({"doc_id": t.column("doc_id"), "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()),
                         "spans": pa.array(spans, span), "kept": pa.array(kept, pa.string())})

    index = docs.groupBy("g").applyInArrow(probe, _PROBES)
    bits = index.groupBy("part").applyInArrow(hits, _BITS)
    around = docs.groupBy("g").cogroup(bits.groupBy("g")).applyInArrow(extend, _RUNS)
    first = around.groupBy("part").applyInArrow(owners, _BITS)
    out = "doc_id long, n_words long, n_removed long, spans array<struct<start:long,end:long>>, kept string"
    judged = docs.groupBy("g").cogroup(bits.unionByName(first).groupBy("g")).applyInArrow(remove, out)
    # rows without an id take no part and stay where they are, however many
    words = F.coalesce(F.regexp_extract_all(F.col("text"), F.lit(r"([^\x20\x09-\x0D]+)"), 1), F.array().cast("array<string>"))
    alone = rows.where(F.col("doc_id").isNull()).select("doc_id", words.alias("words")).select(
        "doc_id", F.size("words").cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_removed"),
        F.array().cast("array<struct<start:long,end:long>>").alias("spans"), F.array_join("words", " ").alias("kept"))
    return judged.unionByName(alone)
