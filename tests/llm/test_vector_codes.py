import math
from collections import defaultdict

import numpy as np
import pytest

from tiermill.llm.vector_codes import adapted, code_vectors, codebook_sha256, first_state, moved_state
from vector_fixtures import AWKWARD_VECTORS, SCHEMA, clusters, frame, taking_part


def brute(rows, parts, entries, rounds):
    """Codes by comparing every part with every entry."""
    rows = sorted(taking_part(rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    q = [[math.floor(256 * x) for x in np.float32(v).astype(float).tolist()] for _, v, _ in rows]
    d = len(q[0]) // parts
    cut = [[v[p * d:p * d + d] for p in range(parts)] for v in q]
    books = [[cut[i][p] for i in range(min(entries, len(q)))] for p in range(parts)]

    def nearest(x, book):
        return min((sum((u - w) ** 2 for u, w in zip(x, c, strict=True)), k) for k, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            members = defaultdict(list)
            for v in cut:
                members[nearest(v[p], books[p])[1]].append(v[p])
            for k, own in members.items():
                books[p][k] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    out, total = [], defaultdict(int)
    for (i, _, label), v in zip(rows, cut, strict=True):
        best = [nearest(v[p], books[p]) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in best), sum(e for e, _ in best), label))
        total[label] += out[-1][2]
    return sorted(((*r[:3], total[r[3]]) for r in out), key=str), books


@pytest.mark.parametrize(("parts", "entries", "rounds", "nearest"), [(4, 16, 2, 4), (2, 64, 4, 1), (8, 3, 1, 8), (4, 256, 2, 255), (1, 1, 2, 3)])
def test_equals_brute_force(spark, parts, entries, rounds, nearest):
    rows = clusters(250) + AWKWARD_VECTORS
    want, books = brute(rows, parts, entries, rounds)
    codes, got = code_vectors(frame(spark, rows), parts=parts, entries=entries, rounds=rounds, nearest=nearest)
    assert sorted(map(tuple, codes.collect()), key=str) == want
    assert got.tolist() == books


def test_bounds_spare_comparisons_and_never_lose_the_nearest():
    rng = np.random.default_rng(0)
    x = (rng.standard_normal((2000, 1, 4)) * 60).astype(np.int64)
    books = x[:64].transpose(1, 0, 2).copy()
    state, least = first_state(x, books, 8)
    compared = []
    for _ in range(6):
        before, books = books, books + rng.integers(-4, 5, books.shape)
        state, least, depth = moved_state(x, state, before, books)
        d = ((x[:, 0, None, :] - books[0][None]) ** 2).sum(-1)
        assert (least == d.min(axis=1)).all() and (state.own == d.argmin(axis=1)).all()
        compared.append(depth.mean())
        state, least = adapted(x, state, least, depth, books)
        assert (np.sort(np.sqrt(d), axis=1)[:, 1] + 1e-9 >= state.bounds.min(axis=1)).all()
    assert max(compared) < 8  # of 63 others
    far, _, depth = moved_state(x, state, books, books + 500 * (np.arange(64) % 2)[None, :, None])
    again, _ = adapted(x, far, far.own, depth, books)
    assert (depth > state.listed.shape[1]).mean() > 0.5 and again.listed.shape[1] == 2 * state.listed.shape[1]


def test_empty_and_useless_tables(spark):
    for rows in ([], [(1, None, 0)], [(1, [], 0)]):
        codes, books = code_vectors(spark.createDataFrame(rows, SCHEMA))
        assert codes.collect() == [] and books.size == 0 and len(codebook_sha256(books)) == 64
    with pytest.raises(ValueError, match="equal parts"):
        code_vectors(spark.createDataFrame([(1, [1.0] * 8, 0)], SCHEMA), parts=3)
    codes, _ = code_vectors(spark.createDataFrame([(7, [1.0] * 8, None)], SCHEMA), parts=4)
    assert list(map(tuple, codes.collect())) == [(7, "00000000", 0, 0)]
