import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tiermill.llm.hard_negatives import Heaps, mine_negatives, strassen
from vector_fixtures import AWKWARD_VECTORS, SCHEMA, clusters, frame, taking_part


@pytest.mark.parametrize("shape", [(1, 1, 1), (3, 5, 7), (64, 64, 64), (33, 70, 129), (130, 31, 40), (0, 8, 9), (9, 8, 0)])
def test_strassen_equals_the_product(shape):
    m, k, n = shape
    rng = np.random.default_rng(1)
    a, b = rng.integers(-(1 << 20), 1 << 20, (m, k)), rng.integers(-(1 << 20), 1 << 20, (k, n))
    want = (a.astype(object) @ b.astype(object)).astype(np.int64) if m and n else np.zeros((m, n))
    assert (strassen(a, b, leaf=4) == want).all() and strassen(a, b, leaf=4).shape == (m, n)
    big = rng.integers(-(1 << 27), 1 << 27, (m, k))  # sums beyond 2**53 take the integer leaf
    assert (strassen(big, b, leaf=8) == ((big.astype(object) @ b.astype(object)).astype(np.int64) if m and n else want)).all()


def test_heaps_merge_in_any_order():
    rng = np.random.default_rng(2)
    key, score, id_ = rng.integers(0, 6, 500), rng.integers(0, 20, 500), rng.permutation(500)
    want = sorted((k, -s, i) for k in range(6) for s, i in sorted(zip(score[key == k], id_[key == k], strict=True), key=lambda x: (-x[0], x[1]))[:5])
    for seed in range(3):
        h = Heaps(6, 5)
        for part in np.array_split(np.random.default_rng(seed).permutation(500), 7):
            h.merge(key[part], score[part], id_[part])
        assert sorted(zip(h.key.tolist(), (-h.score).tolist(), h.id.tolist(), strict=True)) == want


def brute(rows, every):
    rows = [(i, [math.floor(256 * x) for x in np.float32(v).astype(float).tolist()], label) for i, v, label in taking_part(rows) if i is not None and label is not None]
    out = []
    for i, v, label in rows:
        if i % every:
            continue
        scored = [(-sum(map(int.__mul__, v, w)), j, other == label) for j, w, other in rows if j != i]
        for p, j, _ in sorted(x for x in scored if x[2])[:5]:
            fits = sorted(x for x in scored if not x[2] and 80 * -p <= 100 * -x[0] <= 100 * -p)[:5]
            out += [(i, j, r, x[1], -p, -x[0]) for r, x in enumerate(fits, 1)]
    return sorted(out)


@pytest.mark.parametrize("tile", [4096, 16])
def test_equals_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr("tiermill.llm.hard_negatives.TILE", tile)
    monkeypatch.setattr("tiermill.llm.hard_negatives.BLOCK", tile // 4)
    rows = clusters(300) + AWKWARD_VECTORS
    got = mine_negatives(frame(spark, rows), F.col("vec_id") % 20 == 0, F.col("label")).collect()
    want = brute(rows, 20)
    assert sorted(map(tuple, got)) == want and len(want) > 50
    assert any(r[0] == -300 for r in want)  # negative ids are ids


def test_empty_and_useless_tables(spark):
    for rows in ([], [(100, None, 1)], [(100, [], 1)], [(100, [1.0, 2.0], 1)], [(1, [1.0], 1), (2, [1.0], 2)]):
        assert mine_negatives(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 100 == 0, F.col("label")).collect() == []
    with pytest.raises(Exception, match="outside"):
        mine_negatives(spark.createDataFrame([(100, [1e9], 1)], SCHEMA), F.col("vec_id") % 100 == 0, F.col("label")).collect()
