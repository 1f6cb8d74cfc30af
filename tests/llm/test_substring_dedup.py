import re

from conftest import SF_ORACLE
from fixtures import AWKWARD, LONG, awkward, corpus, empty
from harness import compare, duck
from tiermill.llm.catalog import ORACLE, QUERIES
from tiermill.llm.substring_dedup import substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(given, window):
    words = [(i, WORD.findall(t or "")) for i, t in given]
    first = {}
    for i, w in words:
        if i is not None:
            for k in range(len(w) - window + 1):
                run = tuple(w[k:k + window])
                first[run] = min(first.get(run, i), i)
    out = []
    for i, w in words:
        gone = set()
        if i is not None:
            for k in range(len(w) - window + 1):
                if first[tuple(w[k:k + window])] < i:
                    gone.update(range(k, k + window))
        out.append((str(i), len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out)


def test_query_equals_sql(spark):
    problems, n = compare(QUERIES["op2_fixed_block_dedup"](spark, SF_ORACLE), duck(SF_ORACLE), ORACLE["op2_fixed_block_dedup"])
    assert n == 1000 and not problems


def test_equals_brute_force(spark):
    given = AWKWARD + [(20 + i, t) for i, t in corpus(150)] + [(500, LONG[1000:9000]), (400, LONG[5000:20000]), (501, "a b " * 40), (502, "a b " * 30)]
    for window in (13, 4):
        rows = substring_dedup(spark.createDataFrame(given, "doc_id long, text string"), window=window).collect()
        assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in rows) == brute(given, window)
        assert all(sum(s.end - s.start for s in r.spans) == r.n_removed for r in rows)


def test_awkward_and_empty(spark):
    rows = substring_dedup(awkward(spark)).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in rows) == brute(AWKWARD, 13)
    assert substring_dedup(empty(spark)).collect() == []


def test_rows_without_an_id_are_not_grouped(spark):
    given = [(i, t) for i, t in corpus(60)] + [(None, "été à\u00a0la  plage\x1c\tfs \n x " * 5)] * 20 + [(None, None)] * 20
    df = substring_dedup(spark.createDataFrame(given, "doc_id long, text string"))
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in df.collect()) == brute(given, 13)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "isnull(doc_id" in plan and "isnotnull(doc_id" in plan
