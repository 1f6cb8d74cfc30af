import re
from collections import Counter

import pyarrow.parquet as pq

from conftest import SF_ORACLE
from fixtures import AWKWARD, CLASHES, awkward, corpus, empty
from tiermill.llm.catalog import QUERIES
from tiermill.llm.quality import fit_quality, judge, splices, train

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts_of(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), len(lines)


def model():
    return train([("a clean line of words.\nand one more, of words.", 1), ("JUNK!! JUNK!!\n### *** |||", 0)] * 40)


def test_counts_equal_brute_force(spark):
    given = AWKWARD + [(100 + i, t + "\n" + t if i % 3 == 0 else t) for i, t in corpus(60)]
    rows = judge(spark.createDataFrame(given, "doc_id long, text string"), model()).collect()
    got = sorted((str(r.doc_id), str(r.text), (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.n_lines)) for r in rows)
    assert got == sorted((str(i), str(t), counts_of(t)) for i, t in given)
    assert all(len(r.lines) == r.n_lines and 0 <= r.n_content_words <= r.n_words for r in rows)


def test_lines_of_both_kinds(spark):
    row = judge(spark.createDataFrame([(1, "some fine words here, all small.\nand a second one.\n### JUNK!! ***\n|||| ### $$$ !!")], "doc_id long, text string"), model()).first()
    assert row.lines == [True, True, False, False]


def test_agrees_with_the_labels(spark):
    rows = {r.doc_id: r.kept for r in QUERIES["op7_quality_lines"](spark, SF_ORACLE).collect()}
    labels = pq.read_table(f"{SF_ORACLE}/labels.parquet").to_pylist()
    docs = {d["doc_id"]: d["text"] for d in pq.read_table(f"{SF_ORACLE}/documents.parquet").to_pylist()}
    low = [x["doc_id"] for x in labels if x["quality"] == 0]
    good = [x["doc_id"] for x in labels if x["quality"] == 1 and len(docs[x["doc_id"]].split()) >= 20]
    assert sum(not rows[i] for i in low) >= 0.95 * len(low)
    assert sum(rows[i] for i in good) >= 0.95 * len(good)


def test_clashing_names_and_empty(spark):
    out = judge(awkward(spark), model())
    assert [c for c in CLASHES if c not in ("n_words", "lines")] == [c for c in out.columns if c in CLASHES and c not in ("n_words", "lines")]
    assert out.count() == len(AWKWARD)
    assert judge(empty(spark), model()).collect() == []
    assert judge(empty(spark), train([])).collect() == []


def test_splices_keep_every_line_once_and_switch_labels():
    counts, labels = [3, 0, 5, 1, 4, 2], [0, 1, 1, 0, 1, 0]
    chains = splices(counts, labels, 0.5, 6, 1)
    seen = [x for chain in chains for x in chain]
    assert sorted(seen) == [(d, i) for d, n in enumerate(counts) for i in range(n)]
    assert all([i for e, i in seen if e == d] == list(range(n)) for d, n in enumerate(counts))
    assert all(len(c) <= 6 for c in chains) and any(len({labels[d] for d, _ in c}) == 2 for c in chains)
    assert splices([], [], 0.5, 6, 1) == []


def test_learned_model_marks_lines_of_mixed_documents(spark):
    """The model learned from the table, on documents spliced from stretches of
    good and of bad documents that it did not learn from."""
    docs, labels = (spark.read.parquet(f"{SF_ORACLE}/{t}.parquet") for t in ("documents", "labels"))
    model = fit_quality(docs.where("doc_id % 2 = 0"), labels)
    quality = {r.doc_id: r.quality for r in labels.where("doc_id % 2 = 1").collect()}
    own: dict = {0: [], 1: []}
    for r in docs.where("doc_id % 2 = 1 AND text IS NOT NULL").collect():
        lines = [x for x in r.text.split("\n") if x.split()]
        if r.doc_id in quality and len(lines) >= 3:
            own[quality[r.doc_id]].append(lines[:6])
    pairs = list(zip(own[1], own[0], strict=False))
    assert len(pairs) >= 10
    given = [(k, "\n".join(a + b if k % 2 else b + a)) for k, (a, b) in enumerate(pairs)]
    right = total = both = 0
    for r in judge(spark.createDataFrame(given, "doc_id long, text string"), model).collect():
        a, b = pairs[r.doc_id]
        want = [True] * len(a) + [False] * len(b) if r.doc_id % 2 else [False] * len(b) + [True] * len(a)
        right += sum(x == y for x, y in zip(r.lines, want, strict=True))
        total += len(want)
        both += len(set(r.lines)) == 2
    assert right >= 0.9 * total and both >= 0.8 * len(pairs)
