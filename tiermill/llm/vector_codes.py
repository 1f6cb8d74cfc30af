"""Vector code compression: product codes in whole numbers, assigned with
Drake and Hamerly's adaptive bounds.

A vector is cut into equal parts, and each part position has a codebook of
entries.  Lloyd rounds move the entries; between rounds every part keeps its
own entry, its b next closest entries with ascending lower bounds on their
distances, and one outer bound below the distances to all others.  When the
entries have moved, each bound falls by how far they moved.  A part whose exact
distance to its own entry is below its bounds keeps it; otherwise the entries
whose bounds do not exclude them -- the first few of the b, rarely all -- are
compared in exact integers, ties to the lower index.  Bounds are rounded
downwards and the own distance upwards, so a tie is always compared.

b is adapted for each batch of rows: it falls to what nearly all parts needed, and
a batch in which most parts got past the outer bound is listed anew with twice
as many.  The state is checkpointed between rounds; codes do not depend on b.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.llm.common import cut, fresh
from tiermill.llm.vectors import common_length, finite_rows, pack_rows, unpack_rows, whole

#: Parts that are allowed to get past the kept bounds when b falls, of a hundred.
PAST = 1
#: Rows worked on together: a batch's distances to all entries of a part stay small.
ROWS = 4096


@dataclass
class State:
    """Of m parts: own entry (m,), listed entries (m, b), bounds (m, b + 1), the
    last of which is the outer one."""

    own: np.ndarray
    listed: np.ndarray
    bounds: np.ndarray


def _down(x: np.ndarray) -> np.ndarray:
    """At most ``x``, as 32-bit floats."""
    y = x.astype(np.float32)
    return np.where(y > x, np.nextafter(y, np.float32(-np.inf)), y)


def _all_distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to all entries of one codebook; by way of
    doubles where all of the sums fit their 53 bits."""
    most = int(max(np.abs(x).max(initial=0), np.abs(book).max(initial=0)))
    a, b = (x.astype(np.float64), book.astype(np.float64)) if x.shape[1] * 4 * most * most < 1 << 53 else (x, book)
    return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None]).astype(np.int64)


def _some_distances(x: np.ndarray, part: np.ndarray, entry: np.ndarray, books: np.ndarray) -> np.ndarray:
    """Exact squared distances of part rows (m, d) to listed entries (m, t)."""
    d = x[:, None, :] - books[part[:, None], entry]
    return (d * d).sum(-1)


def _list(d: np.ndarray, b: int) -> State:
    """State of rows whose distances to all entries are given."""
    k = d.shape[1]
    order = np.argsort(d * k + np.arange(k), axis=1)
    near = np.sqrt(np.take_along_axis(d, order[:, 1:b + 2], axis=1).astype(np.float64))
    bounds = np.full((len(d), b + 1), np.inf)
    bounds[:, :near.shape[1]] = np.nextafter(near, 0)
    return State(order[:, 0], order[:, 1:b + 1], bounds)


def first_state(x: np.ndarray, books: np.ndarray, b: int) -> tuple[State, np.ndarray]:
    """Of rows (n, parts, d): state and squared distances of all parts (n * parts)."""
    n, parts, _ = x.shape
    own, listed = np.empty((n, parts), np.int64), np.empty((n, parts, b), np.int64)
    bounds, least = np.empty((n, parts, b + 1)), np.empty((n, parts), np.int64)
    for p in range(parts):
        d = _all_distances(x[:, p], books[p])
        s = _list(d, b)
        own[:, p], listed[:, p], bounds[:, p] = s.own, s.listed, s.bounds
        least[:, p] = np.take_along_axis(d, s.own[:, None], axis=1)[:, 0]
    return State(own.ravel(), listed.reshape(n * parts, b), bounds.reshape(n * parts, b + 1)), least.ravel()


def moved_state(x: np.ndarray, state: State, before: np.ndarray, books: np.ndarray) -> tuple[State, np.ndarray, np.ndarray]:
    """State after the entries moved from ``before`` to ``books``, the squared
    distances, and how many listed entries each part had to compare (b + 1: all)."""
    n, parts, d = x.shape
    k, b = books.shape[1], state.listed.shape[1]
    part, flat = np.tile(np.arange(parts), n), x.reshape(-1, d)
    shift = books - before
    far = np.nextafter(np.sqrt((shift * shift).sum(-1).astype(np.float64)), np.inf)
    bounds = np.array(state.bounds, dtype=np.float64)
    bounds[:, :b] -= far[part[:, None], state.listed]
    bounds[:, b] -= far.max(axis=1)[part]
    bounds = np.nextafter(bounds, -np.inf)  # the differences are rounded
    bounds = np.minimum.accumulate(bounds[:, ::-1], axis=1)[:, ::-1]
    own, listed = state.own.copy(), state.listed.copy()
    least = _some_distances(flat, part, own[:, None], books)[:, 0]
    depth = (bounds <= np.nextafter(np.sqrt(least.astype(np.float64)), np.inf)[:, None]).sum(axis=1)
    for t in np.unique(depth[(depth > 0) & (depth <= b)]):
        at = np.flatnonzero(depth == t)
        entry = np.concatenate([own[at, None], listed[at, :t]], axis=1)
        dist = _some_distances(flat[at], part[at], entry, books)
        order = np.argsort(dist * k + entry, axis=1)
        entry, dist = np.take_along_axis(entry, order, 1), np.take_along_axis(dist, order, 1)
        own[at], least[at], listed[at, :t] = entry[:, 0], dist[:, 0], entry[:, 1:]
        bounds[at, :t] = np.nextafter(np.sqrt(dist[:, 1:].astype(np.float64)), -np.inf)
    for p in np.unique(part[depth > b]):
        at = np.flatnonzero((depth > b) & (part == p))
        dist = _all_distances(flat[at], books[p])
        s = _list(dist, b)
        own[at], listed[at], bounds[at] = s.own, s.listed, s.bounds
        least[at] = np.take_along_axis(dist, s.own[:, None], axis=1)[:, 0]
    return State(own, listed, bounds), least, depth


def adapted(x: np.ndarray, state: State, least: np.ndarray, depth: np.ndarray, books: np.ndarray) -> tuple[State, np.ndarray]:
    """The state with the b that this batch of rows turned out to need."""
    b = state.listed.shape[1]
    if not len(depth) or not b:
        return state, least
    if 2 * (depth > b).sum() > len(depth) and b < books.shape[1] - 1:
        return first_state(x, books, min(2 * b, books.shape[1] - 1))
    within = depth[depth <= b]
    need = max(1, int(np.percentile(within, 100 - PAST, method="higher"))) if len(within) else b
    if need < b:  # the outer bound takes in what is let go
        state = State(state.own, state.listed[:, :need], np.concatenate([state.bounds[:, :need], state.bounds[:, need:].min(axis=1, keepdims=True)], axis=1))
    return state, least


_STATE = "id long, label string, x binary, own binary, listed binary, bounds binary"


def _batch(ids, labels, x: np.ndarray, state: State) -> pa.RecordBatch:
    n, parts, d = x.shape
    b = state.listed.shape[1]

    def rows(a: np.ndarray, width: int) -> list[bytes]:
        return [r.tobytes() for r in a.reshape(n, width)]

    return pa.RecordBatch.from_arrays(
        [ids, labels, pa.array(pack_rows(x.reshape(n, parts * d)), pa.binary()), pa.array(rows(state.own.astype(np.uint8), parts), pa.binary()),
         pa.array(rows(state.listed.astype(np.uint8), parts * b), pa.binary()), pa.array(rows(_down(state.bounds), parts * (b + 1)), pa.binary())],
        names=["id", "label", "x", "own", "listed", "bounds"])


def _unbatch(batch: pa.RecordBatch, parts: int, d: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, State]]:
    """Rows of equal b together."""
    size = np.array([len(r) for r in batch.column(4).to_pylist()], dtype=np.int64)
    for s in np.unique(size):
        own = batch.take(pa.array(np.flatnonzero(size == s)))
        n, b = own.num_rows, int(s) // parts
        read = lambda c, kind, own=own: np.frombuffer(b"".join(own.column(c).to_pylist()), dtype=kind)
        yield own, unpack_rows(own.column(2), parts * d).reshape(n, parts, d), State(
            read(3, np.uint8).astype(np.int64), read(4, np.uint8).astype(np.int64).reshape(n * parts, b),
            read(5, np.float32).astype(np.float64).reshape(n * parts, b + 1))


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for i in range(0, batch.num_rows, ROWS):
        yield batch.slice(i, ROWS)


def _sums(state: DataFrame, parts: int, d: int, entries: int) -> list:
    """Count and component sums of each entry's parts: a task sends one row an
    entry, and as many come to the driver."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts * entries, d + 1), dtype=np.int64)
        for batch in batches:
            n = batch.num_rows
            x = unpack_rows(batch.column(0), parts * d).reshape(n * parts, d)
            own = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint8).astype(np.int64)
            cell = np.tile(np.arange(parts) * entries, n) + own
            order = np.argsort(cell, kind="stable")
            cell = cell[order]
            first = np.flatnonzero(np.diff(cell, prepend=-1))
            if len(first):
                total[cell[first], 0] += np.diff(np.append(first, len(cell)))
                total[cell[first], 1:] += np.add.reduceat(x[order], first, axis=0)
        used = np.flatnonzero(total[:, 0])
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), *(pa.array(total[used, j]) for j in range(d + 1))],
                                         names=["cell", *(f"s{j}" for j in range(d + 1))])

    columns = [f"s{j}" for j in range(d + 1)]
    rows = state.select("x", "own").mapInArrow(add, "cell int, " + ", ".join(f"{c} long" for c in columns))
    return rows.groupBy("cell").agg(*[F.sum(c).alias(c) for c in columns]).collect()


def _updated(books: np.ndarray, sums: list) -> np.ndarray:
    out = books.copy()
    for cell, n, *s in sums:
        out[cell // books.shape[1], cell % books.shape[1]] = [v // n for v in s]
    return out


def codebook_sha256(books: np.ndarray) -> str:
    """Of all entries' components in order of part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def code_vectors(df: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", label: str = "label", parts: int = 16, entries: int = 64,
                 rounds: int = 2, nearest: int = 8) -> tuple[DataFrame, np.ndarray]:
    """Codes of the vectors, and the codebooks (parts, entries, part length).

    Components become ``floor(256 * x)``.  The codebooks start as the parts of
    the ``entries`` smallest ids (rows that share an id: the smaller vector
    first; rows without an id come last).  Each round assigns all parts and replaces
    each used entry by the floor of its parts' means; then parts are assigned again.
    ``nearest`` is the first b.

    Rows: id, code (an entry index of two hex digits for each part), error
    (squared distances, summed), label_error (errors summed over equal labels,
    nulls together).  Vectors that are null, of another than the common length or
    hold a null or non-finite component are left out; components beyond
    +-4096 raise.  The common length must divide by ``parts``; there are at most
    256 entries, fewer if there are fewer vectors.  An empty table gives no row
    and empty codebooks.  Columns of other names are ignored.
    """
    if not 0 < entries <= 256:
        raise ValueError("an entry index has two hex digits")
    dim = common_length(df, vector)
    if dim % parts:
        raise ValueError(f"vectors of {dim} components cannot be cut into {parts} equal parts")
    d = dim // parts
    given = df.select(F.col(f"`{vec_id}`").cast("long").alias("id"), F.col(f"`{label}`").cast("string").alias("label"), F.col(f"`{vector}`").alias("vector"))

    def read(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
        for piece in _pieces(batch):
            at, x = finite_rows(piece.column(2), dim)
            if len(at):
                yield piece.take(pa.array(at)), whole(x).reshape(len(at), parts, d)

    def finite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, _ in read(batch):
                yield own

    kept = given.mapInArrow(finite, given.schema)
    start = kept.orderBy(F.asc_nulls_last("id"), "vector").limit(entries).select("vector").collect()
    books = whole(np.array([r[0] for r in start], dtype=np.float64).reshape(len(start), dim)).reshape(len(start), parts, d).transpose(1, 0, 2)
    books = np.ascontiguousarray(books)
    if not len(start):
        empty = df.sparkSession.createDataFrame([], "id long, code string, error long, label_error long")
        return empty, books
    k = len(start)
    b = min(nearest, k - 1)

    def begin(batches: Iterator[pa.RecordBatch], books=books) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, x in read(batch):
                yield _batch(own.column(0), own.column(1), x, first_state(x, books, b)[0])

    def onward(before: np.ndarray, books: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in _pieces(batch):
                    for own, x, state in _unbatch(piece, parts, d):
                        state, least, depth = moved_state(x, state, before, books)
                        yield _batch(own.column(0), own.column(1), x, adapted(x, state, least, depth, books)[0])
        return run

    def finish(before: np.ndarray, books: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in _pieces(batch):
                    for own, x, state in _unbatch(piece, parts, d):
                        state, least, _ = moved_state(x, state, before, books)
                        text = state.own.astype(np.uint8).tobytes().hex()
                        codes = [text[i:i + 2 * parts] for i in range(0, len(text), 2 * parts)]
                        yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), pa.array(codes, pa.string()), pa.array(least.reshape(-1, parts).sum(axis=1))],
                                                         names=["id", "label", "code", "error"])
        return run

    state, before = cut(kept.mapInArrow(begin, _STATE)), books
    for r in range(rounds):
        before, books = books, _updated(books, _sums(state, parts, d, k))
        if r + 1 < rounds:
            state = cut(state.mapInArrow(onward(before, books), _STATE))
    codes = cut(state.mapInArrow(finish(before, books), "id long, label string, code string, error long"))
    total = codes.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", fresh(codes, "of"))
    return codes.join(total, F.col("label").eqNullSafe(F.col("of"))).select("id", "code", "error", "label_error"), books
