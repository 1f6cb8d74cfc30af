import itertools
import re
import tracemalloc

import pytest

from conftest import SF_ORACLE
from fixtures import AWKWARD, awkward, corpus, empty
from harness import compare, duck
from tiermill.llm import jaccard_join
from tiermill.llm.catalog import ORACLE, QUERIES
from tiermill.llm.components import components
from tiermill.llm.jaccard_join import boundary, jaccard_classes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(given, size, percent):
    sets = {}
    for i, t in given:
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        own = {tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()
        if i is not None:
            sets.setdefault(i, set()).update(own)
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def classes(df, **how):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_classes(df, **how).collect() if r.doc_id is not None}


def test_query_equals_sql(spark):
    problems, n = compare(QUERIES["op3_jaccard_join"](spark, SF_ORACLE), duck(SF_ORACLE), ORACLE["op3_jaccard_join"])
    assert n == 1000 and not problems


@pytest.mark.parametrize(("size", "percent", "most"), [(4, 85, None), (4, 85, 0), (2, 60, 14), (1, 70, 9)])
def test_equals_brute_force(spark, monkeypatch, size, percent, most):
    if most is not None:  # any boundary gives the same classes
        monkeypatch.setattr(jaccard_join, "boundary", lambda *_: most)
    short = [" ".join("abcdefghij"[(k * s + o) % 10] for k in range(n)) for n in (3, 6, 9, 10) for s in (1, 3) for o in range(5)]
    given = AWKWARD + [(20 + i, t) for i, t in corpus(130)] + [(300 + i, t) for i, t in enumerate(short)]
    assert classes(spark.createDataFrame(given, "doc_id long, text string"), size=size, percent=percent) == brute(given, size, percent)


def test_large_group_of_near_copies(spark):
    base = [f"w{i}" for i in range(120)]
    given = []
    for i in range(200):
        words = list(base)
        for k in range(i % 5):
            words[(i * 7 + k * 23) % 120] = f"own{i}_{k}"
        given.append((i, " ".join(words)))
    given += [(1000 + i, " ".join(base[:30] + [f"z{i}_{k}" for k in range(9)])) for i in range(40)]
    df = spark.createDataFrame(given, "doc_id long, text string")
    assert classes(df) == brute(given, 4, 85)


def test_boundary_follows_the_cost():
    assert boundary({30: 1000}, 2.0, 85) < 30
    assert boundary({5: 1000, 6: 1000}, 50.0, 85) >= 6


def test_awkward_and_empty(spark):
    rows = jaccard_classes(awkward(spark)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows if r.doc_id is not None} == brute(AWKWARD, 4, 85)
    assert sorted((r.n_shingles, r.component_id) for r in rows if r.doc_id is None) == [(0, None), (16, None)]
    assert jaccard_classes(empty(spark)).collect() == []


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (95, 100), (7, 7), (200, 201), (201, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 90: 90, 95: 90, 100: 90, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_arrays_of_one_stretch_are_small():
    """Workers run beside each other in an executor: one holds less than 64 MB of arrays."""
    words = " ".join(f"w{i % 99991}" for i in range(jaccard_join.SORT_BYTES // 6)).encode()
    step = len(words) // 16
    texts = [words[i * step:(i + 1) * step] for i in range(16)]
    tracemalloc.start()
    jaccard_join.shingles(texts, 5)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 64 << 20
