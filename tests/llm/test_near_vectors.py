import numpy as np
import pytest

from tiermill.llm.near_vectors import bucket_links, hyperplanes, near_vectors, plan_tables
from vector_fixtures import AWKWARD_VECTORS, SCHEMA, clusters, frame, taking_part


def brute(rows, cosine=0.9):
    """(id, n_links, component, kept) of each row, from all pairs."""
    able = [k for k, r in enumerate(rows) if r in taking_part([r]) and any(r[1]) and r[0] is not None]
    x = np.array([np.float32(rows[k][1]) for k in able], dtype=np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= cosine
    np.fill_diagonal(near, False)
    ids = np.array([rows[k][0] for k in able])
    low = ids.copy()
    for _ in range(len(able)):
        low = np.minimum(low, np.where(near, low[None], np.iinfo(np.int64).max).min(axis=1))
    out = {k: (int(near[n].sum()), int(low[n])) for n, k in enumerate(able)}
    return sorted(((i, *out.get(k, (0, i)), None if i is None else out.get(k, (0, i))[1] == i) for k, (i, _, _) in enumerate(rows)), key=str)


@pytest.mark.parametrize("tile", [8192, 8])
def test_equals_brute_force(spark, monkeypatch, tile):
    """Small buckets are split into pairs of tiles; the links are the same."""
    monkeypatch.setattr("tiermill.llm.near_vectors.TILE", tile)
    monkeypatch.setattr("tiermill.llm.near_vectors.STRIP", max(4, tile // 2))
    rows = clusters(300) + AWKWARD_VECTORS
    got = near_vectors(frame(spark, rows), recall=0.9999999).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)
    assert max(r.n_links for r in got) > 5


def test_recall_on_random_neighbours(spark):
    """Pairs just above the threshold, the hardest to find."""
    rng = np.random.default_rng(3)
    a = rng.standard_normal((1500, 32))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((1500, 32))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b = 0.905 * a + np.sqrt(1 - 0.905 ** 2) * b / np.linalg.norm(b, axis=1, keepdims=True)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(np.concatenate([a, b]))]
    got = {r.id: r for r in near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert np.mean([got[i].n_links for i in range(1500)]) >= 0.93
    assert all(r.n_links <= 1 and r.component_id == r.id % 1500 for r in got.values() if r.n_links)


def test_large_group_of_copies_and_of_near_copies(spark):
    rng = np.random.default_rng(5)
    one = rng.standard_normal(16)
    near = one + 0.01 * rng.standard_normal((300, 16))
    rows = [(i, one.tolist(), 0) for i in range(2000)] + [(5000 + i, v.tolist(), 0) for i, v in enumerate(near)]
    for r in near_vectors(spark.createDataFrame(rows, SCHEMA), recall=0.9999).collect():
        assert (r.n_links, r.component_id) == (2299, 0)


def test_a_pair_counts_in_its_first_table_only():
    x, m = np.array([[1.0, 0.0], [1.0, 0.0], [1.0, 0.0]]), np.array([1, 2, 3])
    signs = np.array([[7, 1], [7, 1], [8, 1]])
    assert bucket_links(x, m, signs, 1, None, 0.9)[0].tolist() == [3, 3, 3]
    assert bucket_links(x, m, signs, 0, np.array([0, 0, 1]), 0.9)[0].tolist() == [3, 3, 3]


def test_tables_follow_the_number_of_classes():
    small, large = plan_tables(10_000, 0.9, 0.95), plan_tables(10 ** 9, 0.9, 0.95)
    assert small[0] < large[0] and small[1] < large[1]
    assert (hyperplanes(4, 2, 3, 1) == hyperplanes(4, 2, 3, 1)).all()


def test_empty_and_useless_tables(spark):
    for rows in ([], [(1, None, 0)], [(1, [], 0), (None, [], 0)], [(1, [0.0, 0.0], 0), (2, [0.0, 0.0], 0)]):
        got = near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
        assert sorted(map(tuple, got), key=str) == sorted(((i, 0, i, None if i is None else True) for i, _, _ in rows), key=str)
