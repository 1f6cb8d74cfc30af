"""Exact Jaccard join on word shingles: size-aware, heavy and light.

Shingles travel once, by hash range, many to a row.  Each range finds the
shingles that two documents share; only those go on, since a shingle of one
document can never count towards an intersection.  A document's shared shingles
are ordered by the number of documents that have them, rarest first.

Light sets (few shingles): two sets of sizes m <= n are similar exactly if they
share ``c(m, n)`` shingles, so each set enumerates its subsets of that size for
every size it may meet, and equal subsets are links.  Heavy sets: two similar
sets share one of their first ``n - need(n) + 1`` shingles, so each set scans
the inverted lists of those; two sets that meet there are compared only if both
have enough shingles from that one on (positional filter).  The boundary between the two is the size at which
the estimated number of subsets and list entries together is least; any boundary
gives the same links.

Only classes are asked for, so a list of k members need not be expanded into all
its pairs: first, all are compared with the most central member, twice; then
only pairs whose documents are still in different classes are made and compared, in
rounds: a sixty-fourth of them, an eighth, and all.  Lists that lie within one class
leave between the rounds.  Every pair is compared, or its two classes have become
one before, so the classes are exact.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.llm.blobs import pack, pack_sorted, range_of, run_numbers, runs, spans, unpack, unpack_sorted
from tiermill.llm.common import cut, mix, partitions, pieces, starts_of, text_slices, window_hashes, word_hashes
from tiermill.llm.components import components

#: Text in bytes whose shingles are sorted together; a worker's arrays take many times as much.
SORT_BYTES = 2 << 20
#: Larger sets are heavy whatever the counts: one would have over a million subsets.
LIGHT_MOST = 48


def shingles(texts: list[bytes | None], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes and their documents, in order of the hashes.
    A text of fewer words is one shingle as a whole."""
    parts = [word_hashes(texts[i:j], lower=True) for i, j in pieces(texts)]
    words = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, dtype=np.uint64)
    counts = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, dtype=np.int64)
    doc, first = np.repeat(np.arange(len(counts)), counts), starts_of(counts)
    hashes, owners = [], []
    if len(words) >= size:
        at = np.flatnonzero(doc[:len(doc) - size + 1] == doc[size - 1:])
        hashes.append(window_hashes(words, size)[at])
        owners.append(doc[at])
    for n in range(1, size):
        own = np.flatnonzero(counts == n)
        if len(own):
            few = words[(first[own][:, None] + np.arange(n)).ravel()]
            hashes.append(mix(window_hashes(few, n)[::n] ^ np.uint64(n)))
            owners.append(own)
    if not hashes:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    h, d = np.concatenate(hashes), np.concatenate(owners)
    order = np.lexsort((d, h))
    h, d = h[order], d[order]
    one = runs(h, d)
    return h[one], d[one]


_RANGES = "part int, ids binary, owner binary, value binary"
_SHARED = "g int, ids binary, value binary, n binary"
SETS = "doc_id long, n long, shared long, score double, s0 long, s1 long, s2 long, s3 long, toks array<long>"
#: Parities of the shared shingles that fall on each of 256 bits: two sets differ
#: in at least as many shingles as their parities differ in bits.
PARITY = ("s0", "s1", "s2", "s3")


def _table(rows: list[tuple], schema: str) -> pa.Table:
    names = [x.strip().split(" ") for x in schema.split(",")]
    kinds = {"int": pa.int32(), "binary": pa.binary()}
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.table([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, names, strict=True)], names=[n for n, _ in names])


def _need(n, percent: int):
    """Least intersection of a set of n with any similar set."""
    return (percent * n + 99) // 100


def shingle_sets(df: DataFrame, text: str, doc_id: str, size: int, percent: int) -> DataFrame:
    """One row for each distinct id: the number of shingles n, how many of them
    another document shares and, if those could reach similarity, their hashes in
    the global order with ``score``, the documents that have the prefix."""
    groups = partitions(df.sparkSession)
    ranges = 2 * groups

    def split(batches):
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for i, j, texts in text_slices(b.column(1), SORT_BYTES):
                out = []
                h, d = shingles(texts, size)
                own = ids[i:j]
                for p, x, y in spans(range_of(h, ranges)):
                    docs, at = np.unique(d[x:y], return_inverse=True)
                    out.append((p, pack(own[docs].view(np.uint64)), pack(at.astype(np.uint64)), pack_sorted(h[x:y])))
                # the sizes travel as part -1 - g
                n = np.bincount(d, minlength=len(own))
                g = (mix(own.view(np.uint64)) % np.uint64(groups)).astype(np.int64)
                for k in np.unique(g):
                    mine = g == k
                    out.append((-1 - int(k), pack(own[mine].view(np.uint64)), pack(n[mine].astype(np.uint64)), None))
                yield from _table(out, _RANGES).to_batches()

    def share(t: pa.Table) -> pa.Table:
        rows = t.to_pydict()
        if rows["part"][0] < 0:
            return _table([(-1 - rows["part"][0], i, None, n) for i, n in zip(rows["ids"], rows["owner"], strict=True)], _SHARED)
        h = np.concatenate([unpack_sorted(x) for x in rows["value"]])
        d = np.concatenate([unpack(i)[unpack(o).astype(np.int64)] for i, o in zip(rows["ids"], rows["owner"], strict=True)])
        order = np.lexsort((d, h))
        h, d = h[order], d[order]
        one = runs(h, d)  # an id may stand in several rows; its size counts a shingle once
        again = np.delete(d, one)
        h, d = h[one], d[one]
        first = runs(h)
        df_ = np.diff(np.append(first, len(h)))[run_numbers(first, len(h))]
        keep = df_ > 1
        h, d, df_ = h[keep], d[keep], df_[keep]
        g = (mix(d) % np.uint64(groups)).astype(np.int64)
        order = np.lexsort((h, d, g))
        h, d, df_, g = h[order], d[order], df_[order], g[order]
        out = [(k, pack(d[x:y]), pack(h[x:y]), pack(df_[x:y].astype(np.uint64))) for k, x, y in spans(g)]
        ids, n = np.unique(again, return_counts=True)
        out += [(int((mix(i) % np.uint64(groups))[0]), pack(i), None, pack((-k).view(np.uint64)))
                for i, k in zip(ids.reshape(-1, 1), n.reshape(-1, 1), strict=True)]
        return _table(out, _SHARED)

    def gather(t: pa.Table) -> pa.Table:
        rows = t.to_pydict()
        sizes = [(unpack(i), unpack(n)) for i, v, n in zip(rows["ids"], rows["value"], rows["n"], strict=True) if v is None]
        ids, n = np.concatenate([x[0] for x in sizes]), np.concatenate([x[1] for x in sizes]).astype(np.int64)
        ids, at = np.unique(ids, return_inverse=True)
        total = np.bincount(at, weights=n, minlength=len(ids)).astype(np.int64)
        parts = [(unpack(i), unpack(v), unpack(k)) for i, v, k in zip(rows["ids"], rows["value"], rows["n"], strict=True) if v is not None]
        d, h, f = (np.concatenate([p[c] for p in parts]) if parts else np.zeros(0, dtype=np.uint64) for c in range(3))
        order = np.lexsort((h, f, d))
        d, h, f = d[order], h[order], f[order].astype(np.int64)
        own = np.searchsorted(ids, d)
        shared = np.bincount(own, minlength=len(ids))
        start = np.cumsum(shared) - shared
        prefix = np.maximum(0, shared - _need(total, percent) + 1)
        able = (shared > 0) & (prefix > 0)
        place = np.arange(len(d)) - start[own]
        in_prefix = place < prefix[own]
        score = np.bincount(own, weights=np.where(in_prefix, f, 0), minlength=len(ids)) / np.maximum(1, prefix)
        keep = able[own]
        lengths = np.where(able, shared, 0)
        toks = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), pa.array(h[keep].view(np.int64)))
        bit = mix(h ^ np.uint64(0x5851F42D4C957F2D)) & np.uint64(255)
        parity = np.zeros((4, len(ids)), dtype=np.uint64)
        np.bitwise_xor.at(parity, ((bit >> np.uint64(6)).astype(np.int64), own), np.uint64(1) << (bit & np.uint64(63)))
        return pa.table({"doc_id": pa.array(ids.view(np.int64)), "n": pa.array(total), "shared": pa.array(shared.astype(np.int64)),
                         "score": pa.array(score), **{c: pa.array(x.view(np.int64)) for c, x in zip(PARITY, parity, strict=True)}, "toks": toks})

    docs = df.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sets = (docs.mapInArrow(split, _RANGES).groupBy("part").applyInArrow(share, _SHARED)
            .groupBy("g").applyInArrow(gather, SETS))
    return sets


def light_cost(n: int, most: int, percent: int) -> int:
    """Subsets that a set of n shingles enumerates to meet all sizes up to ``most``."""
    total = 0
    for m in range(_need(n, percent), min(most, 100 * n // percent) + 1):
        total += math.comb(n, min(n, -(-percent * (n + m) // (100 + percent))))
    return total


def boundary(sizes: dict[int, int], heavy: float, percent: int) -> int:
    """The light size with the least cost.  ``sizes`` counts the sets of each size
    up to LIGHT_MOST, ``heavy`` is the mean length of an inverted list."""

    def cost(most: int) -> float:
        total = 0.0
        for n, k in sizes.items():
            if n <= most:
                total += k * light_cost(n, most, percent)
            if 100 * n >= percent * (most + 1):
                total += k * (n - _need(n, percent) + 1) * heavy
        return total

    return min(range(LIGHT_MOST + 1), key=cost)


def _light_pairs(sets: DataFrame, most: int, percent: int) -> DataFrame:
    """Links found by equal subsets; each key links its members in a star."""

    def subsets(batches):
        for b in batches:
            keys, docs, ns, lows, highs = [], [], [], [], []
            for doc, n, toks in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                h = mix(np.array(toks, dtype=np.int64).view(np.uint64))
                with np.errstate(over="ignore"):
                    whole = h.sum(dtype=np.uint64)
                    for m in range(_need(n, percent), min(most, 100 * n // percent) + 1):
                        low, high = min(n, m), max(n, m)
                        off = len(h) - -(-percent * (low + high) // (100 + percent))
                        if off < 0:
                            continue
                        for gone in itertools.combinations(range(len(h)), off):
                            left = whole - h[list(gone)].sum(dtype=np.uint64) if gone else whole
                            keys.append(left)
                            docs.append(doc)
                            ns.append(n)
                            lows.append(low)
                            highs.append(high)
            yield pa.RecordBatch.from_arrays([pa.array(np.array(keys, dtype=np.uint64).view(np.int64)), pa.array(docs, pa.int64()), pa.array(ns, pa.int64()),
                                              pa.array(lows, pa.int64()), pa.array(highs, pa.int64())], names=["key", "doc", "n", "low", "high"])

    rows = sets.where(F.col("n") <= most).select("doc_id", "n", "toks").mapInArrow(subsets, "key long, doc long, n long, low long, high long")
    key = ["low", "high", "key"]
    ends = rows.groupBy(*key).agg(F.min(F.when(F.col("n") == F.col("low"), F.col("doc"))).alias("a"),
                                  F.min(F.when(F.col("n") == F.col("high"), F.col("doc"))).alias("b")).where("a is not null and b is not null")
    met = rows.join(ends, key)
    return met.select("doc", F.when(F.col("n") == F.col("low"), F.col("b")).otherwise(F.col("a")).alias("other")).where("doc != other").distinct()


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar."""
    a = sets.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("toks").alias("ta"))
    b = sets.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("toks").alias("tb"))
    both = F.size(F.array_intersect("ta", "tb"))
    return pairs.join(a, "a").join(b, "b").where(100 * both >= percent * (F.col("na") + F.col("nb") - both)).select("a", "b")


#: What is known of a list's member, and its names for the other one of a pair.
_MEMBER = ("c", "n", "own", "rest", *PARITY)
_OTHER = {c: f"{c}_b" for c in _MEMBER}


def _possible(most: int, percent: int):
    """Whether two sets that meet at a shingle can be similar, by their sizes, by
    how many shingles each has from this one on (if it is the first that they
    share, no more can be in the intersection), and by the shingles in which they
    must differ: those that only one document has, and one for each parity."""
    need = F.ceil(F.lit(percent) * (F.col("n") + F.col("n_b")) / (100 + percent))
    differ = F.col("own") + F.col("own_b")
    for p in PARITY:
        differ = differ + F.bit_count(F.col(p).bitwiseXOR(F.col(f"{p}_b")))
    return ((100 * F.least("n", "n_b") >= percent * F.greatest("n", "n_b")) & (F.greatest("n", "n_b") > most)
            & (F.least("rest", "rest_b") >= need) & (differ <= F.col("n") + F.col("n_b") - 2 * need))


def jaccard_classes(df: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = 4, percent: int = 85) -> DataFrame:
    """Classes of documents linked by shingle sets with
    ``100 * intersection >= percent * union``.

    Returns one row for each distinct id: doc_id, n_shingles and component_id, the
    smallest id reachable by links.  A-Z are lower-cased.  Null and empty texts
    have no shingle and are linked with nothing.  Rows that share an id are one
    document that holds the shingles of all; rows with a null id are one row each
    with a null component.  Other columns are ignored, whatever their names.
    """
    sets = cut(shingle_sets(df, text, doc_id, size, percent))
    able = sets.where(F.size("toks") > 0).select("doc_id", "n", "score", (F.col("n") - F.col("shared")).alias("own"), *PARITY, "toks")
    prefix = F.slice("toks", 1, F.greatest(F.lit(0), F.size("toks") - F.floor((F.lit(percent) * F.col("n") + 99) / 100) + 1).cast("int"))

    shape = able.select(F.when(F.col("n") <= LIGHT_MOST, F.col("n")).alias("n"), F.size(prefix).alias("k"))
    counts = shape.groupBy("n").agg(F.count(F.lit(1)).alias("sets"), F.sum("k").alias("k")).collect()
    if not counts:
        labels = None
    else:
        entries = able.select(F.explode(prefix).alias("tok")).agg(F.count(F.lit(1)), F.approx_count_distinct("tok")).first()
        most = boundary({r[0]: r[1] for r in counts if r[0] is not None}, entries[0] / max(1, entries[1]), percent)
        heavy = able.where(100 * F.col("n") >= percent * (most + 1))
        # own: shingles that no other document has; rest: shingles from this one on, in the global order
        lists = (heavy.select(F.posexplode(prefix).alias("i", "tok"), F.col("doc_id").alias("doc"), "n", "score", "own", F.size("toks").alias("k"), *PARITY)
                 .select("tok", "doc", "n", "score", "own", (F.col("k") - F.col("i")).alias("rest"), *PARITY))
        links = cut(_verified(_light_pairs(able, most, percent).select(F.col("doc").alias("a"), F.col("other").alias("b")), able, percent)
                    .union(_verified(_starred(lists.withColumn("c", F.col("doc")), most, percent), able, percent)))
        labels = cut(components(links))
        columns = lists.columns
        for part in (None, *ROUNDS):
            marked = lists.join(labels.withColumnRenamed("node", "doc"), "doc", "left").select(*columns, F.coalesce("root", "doc").alias("c"))
            split = marked.groupBy("tok").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo != hi").select("tok")
            marked = cut(marked.join(split, "tok"))
            if marked.isEmpty():
                break
            pairs = _starred(marked, most, percent, other=True) if part is None else _across(marked, most, percent, *part)
            more = cut(_verified(pairs, able, percent))
            if not more.isEmpty():
                links = links.union(more)
                labels = cut(components(links))
            lists = marked.select(*columns)
    out = sets.select("doc_id", F.col("n").alias("n_shingles"))
    if labels is None:
        out = out.withColumn("component_id", F.col("doc_id"))
    else:
        out = out.join(labels.select(F.col("node").alias("doc_id"), "root"), "doc_id", "left").select(
            "doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("component_id"))

    def count(batches):
        for b in batches:
            n = [np.bincount(shingles(texts, size)[1], minlength=j - i) for i, j, texts in text_slices(b.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(n).astype(np.int64)) if n else pa.array([], pa.int64())], names=["n_shingles"])

    nameless = df.where(F.col(doc_id).isNull()).select(F.col(text).alias("text")).mapInArrow(count, "n_shingles long")
    return out.unionByName(nameless.select(F.lit(None).cast("long").alias("doc_id"), "n_shingles", F.lit(None).cast("long").alias("component_id")))


def _starred(lists: DataFrame, most: int, percent: int, other: bool = False) -> DataFrame:
    """Pairs of each list's members with its most central one (the one whose
    rarest shingles most documents have), in other classes than its own.  With
    ``other`` the centre is the most central outside the class of that one."""
    rank = F.struct(F.col("score"), (-F.col("doc")).alias("r"), *_MEMBER)
    centre = lists.groupBy("tok").agg(F.max(rank).alias("x"))
    if other:
        first = lists.join(centre, "tok").where(F.col("c") != F.col("x.c")).drop("x")
        centre = first.groupBy("tok").agg(F.max(rank).alias("x"))
    centre = centre.select("tok", (-F.col("x.r")).alias("b"), *[F.col(f"x.{c}").alias(o) for c, o in _OTHER.items()])
    met = lists.join(centre, "tok").where((F.col("c") != F.col("c_b")) & _possible(most, percent))
    return met.select(F.col("doc").alias("a"), "b").distinct()


#: Slices of the pairs across classes, of 64, in each round.
ROUNDS = ((0, 1), (1, 8), (8, 64))


def _across(lists: DataFrame, most: int, percent: int, low: int, high: int) -> DataFrame:
    """Pairs of a list whose members are in different classes, of the slices from
    ``low`` to below ``high``.  The largest class of each list meets the rest; it never meets itself."""
    share = lists.groupBy("tok", "c").count()
    main = share.groupBy("tok").agg(F.max(F.struct("count", "c")).alias("x")).select("tok", F.col("x.c").alias("main"))
    told = lists.join(main, "tok")
    others = told.where("c != main").select("tok", F.col("doc").alias("b"), *[F.col(c).alias(o) for c, o in _OTHER.items()])
    sliced = F.pmod(F.xxhash64(F.least("doc", "b"), F.greatest("doc", "b")), F.lit(64))
    met = told.join(others, "tok").where((F.col("c") != F.col("c_b")) & ((F.col("c") == F.col("main")) | (F.col("doc") < F.col("b")))
                                         & (sliced >= low) & (sliced < high) & _possible(most, percent))
    return met.select(F.least("doc", "b").alias("a"), F.greatest("doc", "b").alias("b")).distinct()
