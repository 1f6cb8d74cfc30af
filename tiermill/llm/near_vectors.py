"""Near duplicates of embeddings: random-hyperplane sign hashing in several
tables, exact cosine verification, distributed connected components.

Equal vectors are one class and travel once, so a group of copies of any size
is one member of a bucket.  Vectors are dealt out by (table, signs); within a bucket
all pairs are verified as tiles of a matrix product, and no pair leaves the task:
a member sends the number of its links (weighted by the copies behind them) and
its root within the bucket.  A pair that meets in several tables counts in the
first one.  Buckets above ``TILE`` members are split into tiles, and each pair of
tiles is a bucket of its own.

The number of signs grows with the logarithm of the number of classes, so that
buckets keep their size; the number of tables follows from the signs, such that a pair at the
threshold meets with probability ``recall`` (closer pairs meet more surely).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.llm.common import cut
from tiermill.llm.components import components, unite
from tiermill.llm.vectors import common_length, finite_rows

#: Members of a bucket that are compared as one; of an average bucket; and rows
#: of a matrix of cosines.
TILE, BUCKET, STRIP = 8192, 128, 1024
#: Tables whose vectors are shuffled at a time.
ROUND = 4
MOST_SIGNS = 30

_SIGNED = "node long, m long, x binary, signs array<int>"
_LINKED = "node long, links long, root long"


def plan_tables(classes: int, cosine: float, recall: float) -> tuple[int, int]:
    """(signs, tables) for a number of classes."""
    signs = min(MOST_SIGNS, max(4, math.ceil(math.log2(max(1, classes) / BUCKET)))) if classes > BUCKET else 4
    met = (1 - math.acos(cosine) / math.pi) ** signs
    return signs, max(1, math.ceil(math.log(1 - recall) / math.log(1 - met)))


def hyperplanes(dim: int, signs: int, tables: int, seed: int) -> np.ndarray:
    """Normals as columns: the same for every task and run."""
    return np.random.default_rng([seed, dim]).standard_normal((dim, signs * tables))


def bucket_links(x: np.ndarray, m: np.ndarray, signs: np.ndarray, table: int, split: np.ndarray | None, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Weighted links of each member of a bucket, and its root among the members.
    ``split`` tells two tiles apart of which only pairs across count.  Pairs that
    share the signs of an earlier table than ``table`` do not count."""
    n = len(x)
    links, root = np.zeros(n, dtype=np.int64), np.arange(n)
    for i in range(0, n, STRIP):
        own = np.arange(i, min(n, i + STRIP))
        for j in range(i, n, STRIP):
            near = x[own] @ x[j:j + STRIP].T >= cosine
            if split is not None:
                near &= split[own][:, None] != split[j:j + STRIP][None]
            a, b = np.nonzero(near)
            a, b = a + i, b + j
            ahead = a < b
            a, b = a[ahead], b[ahead]
            fresh = np.ones(len(a), dtype=bool)
            for t in range(table):
                fresh &= signs[a, t] != signs[b, t]
            a, b = a[fresh], b[fresh]
            np.add.at(links, a, m[b])
            np.add.at(links, b, m[a])
            unite(root, a, b)
    return links, root


def near_vectors(df: DataFrame, cosine: float = 0.9, vector: str = "embedding", vec_id: str = "vec_id", recall: float = 0.97, seed: int = 5) -> DataFrame:
    """One row for each row of ``df``: id, n_links (other rows that were found to
    have a cosine of at least ``cosine``, in double precision), component_id (the
    smallest id reachable by links, itself included) and kept (it is its own).

    Vectors that are null, of another than the common length, zero, or hold a null
    or non-finite component link with nothing.  Rows with a null id cannot be named:
    they link with nothing and their component is null.  Rows that share an id are
    rows of their own.  An empty table gives no row.  Columns of other names are ignored.
    """
    dim = common_length(df, vector)
    given = df.select(F.col(f"`{vec_id}`").cast("long").alias("id"), F.col(f"`{vector}`").alias("vector"))
    key = [F.xxhash64("vector").alias("h"), F.xxhash64("vector", F.lit(1)).alias("g")]
    wide = given.schema["vector"].dataType.elementType.simpleString() == "double"
    kind = np.float64 if wide else np.float32

    def able(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, x = finite_rows(batch.column(2), dim)
            at = at[(x != 0).any(axis=1)]
            yield batch.take(pa.array(at, pa.int64()))

    rows = given.where("id is not null and vector is not null").select(F.col("id"), F.lit(0).alias("none"), "vector")
    usable = rows.mapInArrow(able, rows.schema).select("id", "vector", *key)
    classes = usable.groupBy("h", "g").agg(F.count(F.lit(1)).alias("m"), F.min("id").alias("low"), F.any_value("vector").alias("vector"))
    classes = cut(classes.withColumn("node", F.monotonically_increasing_id()))
    signs, tables = plan_tables(classes.count(), cosine, recall)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = hyperplanes(dim, signs, tables, seed)
        weight = 1 << np.arange(signs)
        for batch in batches:
            for i in range(0, batch.num_rows, TILE):
                piece = batch.slice(i, TILE)
                _, x = finite_rows(piece.column(2), dim)
                own = ((x @ planes > 0).reshape(len(x), tables, signs) * weight).sum(axis=2).astype(np.int32)
                raw = x.astype(kind)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), piece.column(1), pa.array([r.tobytes() for r in raw], pa.binary()),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * tables), pa.array(own.ravel()))],
                    names=["node", "m", "x", "signs"])

    signed = cut(classes.select("node", "m", "vector").mapInArrow(sign, _SIGNED))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def linked(own: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            t = pa.Table.from_batches(own)
            if t.num_rows < 2:
                return
            x = np.frombuffer(b"".join(t["x"].to_pylist()), dtype=kind).reshape(t.num_rows, dim).astype(np.float64)
            x /= np.abs(x).max(axis=1, keepdims=True)  # the squares stay finite
            x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
            node, m = (t[c].to_numpy() for c in ("node", "m"))
            seen = t["signs"].combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1)
            i, j = t["i"][0].as_py(), t["j"][0].as_py()
            links, root = bucket_links(x, m, seen, t["t"][0].as_py(), None if i == j else t["tile"].to_numpy(), cosine)
            at = np.flatnonzero(links)
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array(node[at]), pa.array(links[at]), pa.array(node[root[at]])], names=["node", "links", "root"])

        last = None
        for batch in batches:
            bucket = [batch.column(c).to_numpy() for c in ("t", "sign", "i", "j")]
            edge = np.flatnonzero(np.any([np.diff(c) != 0 for c in bucket], axis=0)) + 1 if batch.num_rows > 1 else np.zeros(0, np.int64)
            for a, b in zip([0, *edge], [*edge, batch.num_rows], strict=True):
                if b > a:
                    now = tuple(int(c[a]) for c in bucket)
                    if held and now != last:
                        yield from linked(held)
                        held = []
                    last = now
                    held.append(batch.slice(a, b - a))
        if held:
            yield from linked(held)

    def met(first: int) -> DataFrame:
        """Links found in ``ROUND`` tables from ``first`` on."""
        own = F.slice("signs", first + 1, ROUND)
        place = signed.select("node", F.posexplode(own).alias("t", "sign"))
        hot = place.groupBy("t", "sign").count().where(F.col("count") > TILE).select(F.col("t").alias("ht"), F.col("sign").alias("hs"), F.ceil(F.col("count") / TILE).cast("int").alias("n"))
        entries = signed.select("node", "m", "x", "signs", F.posexplode(own).alias("t", "sign"))
        entries = entries.join(hot, (F.col("t") == F.col("ht")) & (F.col("sign") == F.col("hs")), "left").drop("ht", "hs")
        entries = entries.withColumn("n", F.coalesce("n", F.lit(1))).withColumn("tile", F.pmod(F.xxhash64("node"), F.col("n")).cast("int"))
        # with tile number r of n, a member meets the tiles (0, r) .. (r, r) .. (r, n - 1)
        entries = entries.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
        entries = entries.select("node", "m", "x", "signs", (F.col("t") + first).alias("t"), "sign", "tile",
                                 F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"))
        bucket = ["t", "sign", "i", "j"]
        return cut(entries.repartition(*bucket).sortWithinPartitions(*bucket).mapInArrow(verify, _LINKED))

    linked = None
    for first in range(0, tables, ROUND):
        found = met(first)
        linked = found if linked is None else linked.union(found)
    totals = linked.groupBy("node").agg(F.sum("links").alias("links"))
    roots = cut(components(linked.select(F.col("node").alias("a"), F.col("root").alias("b"))))
    named = classes.select("node", "h", "g", "m", "low").join(totals, "node", "left").join(roots, "node", "left").select(
        "h", "g", "low", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("links"), F.coalesce("root", "node").alias("root"))
    least = named.groupBy("root").agg(F.min("low").alias("component"))
    told = named.where("links > 0").join(least, "root").select("h", "g", "links", "component")
    named_rows = given.select("id", *key)
    out = named_rows.join(told, (F.col("id").isNotNull()) & (named_rows["h"] == told["h"]) & (named_rows["g"] == told["g"]), "left")
    component = F.coalesce("component", "id")
    return out.select("id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (component == F.col("id")).alias("kept"))
