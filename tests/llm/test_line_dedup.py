import itertools
import random

from fixtures import AWKWARD, CLASHES, awkward, corpus, empty
from tiermill.llm.line_dedup import blocks, line_dedup, patience


def test_alignment_is_a_common_subsequence():
    rng = random.Random(0)
    for _ in range(500):
        a, b = ([rng.randint(0, 12) for _ in range(rng.randint(0, 14))] for _ in range(2))
        got = patience(a, b)
        assert all(b[y] == a[x] for y, x in got)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in itertools.pairwise(got))
    assert patience([1, 2, 3, 9, 4, 5], [7, 2, 3, 8, 4, 5]) == [(1, 1), (2, 2), (4, 4), (5, 5)]
    assert patience(list(range(50)), list(range(50))) == [(i, i) for i in range(50)]


def test_blocks():
    assert blocks([(1, 1), (2, 2), (4, 4)], [9, 6, 6, 1, 6], 10) == [1, 2]
    assert blocks([(0, 3)], [2], 10) == [0]  # the whole later document
    assert blocks([], [], 10) == []


def least_common(given, block_words=10):
    """Lines that must go, from the definition of a common block alone: every line in a run of
    lines of ``block_words`` words or more that stands in a document with a smaller
    id as well.  All runs of all pairs of documents are compared; no hash, no alignment."""
    docs = sorted({(i, t or "") for i, t in given if i is not None})
    lines = {d: [tuple(x.split()) for x in d[1].split("\n") if x.split()] for d in docs}
    out = {}
    for d, own in lines.items():
        gone = set()
        for e, theirs in lines.items():
            if e[0] < d[0]:
                for y in range(len(own)):
                    for x in range(len(theirs)):
                        k = 0
                        while y + k < len(own) and x + k < len(theirs) and own[y + k] == theirs[x + k]:
                            k += 1
                        if sum(map(len, own[y:y + k])) >= block_words:
                            gone.update(range(y, y + k))
        out[d] = gone
    return lines, out


def test_equals_brute_force(spark):
    common = "a line of boilerplate words"
    given = [r for r in AWKWARD if len(r[1] or "") < 10000] + [(20 + i, t + "\n" + common if i % 3 else t) for i, t in corpus(200)]
    lines, want = least_common(given)
    rows = line_dedup(spark.createDataFrame(given, "doc_id long, text string").selectExpr("*", "text AS before")).collect()
    assert len(rows) == len(given)
    whole = 0
    for r in rows:
        if r.doc_id is None:
            assert r.n_removed == 0 and r.text == r.before
            continue
        own, gone = lines[r.doc_id, r.before or ""], want[r.doc_id, r.before or ""]
        assert r.n_lines == len(own)
        if r.n_removed != len(gone):  # a document smaller than a block that an earlier one holds
            assert r.n_removed == len(own) and sum(map(len, own)) < 10
            whole += 1
        if not r.n_removed:
            assert r.text == r.before
        else:
            assert [tuple(x.split()) for x in r.text.split("\n") if x.split()] == [x for k, x in enumerate(own) if k not in gone and r.n_removed < len(own)]
            assert min(r.sources) < r.doc_id
    assert whole and sum(map(len, want.values())) > 300


def test_unrelated_earlier_documents_hide_no_copy(spark):
    a, b, c = "first line of words", "second line of words", "third line of words"
    given = [(1, f"{a}\n{b}"), (2, f"{b}\n{c}"), *[(i, f"{a}\n{b}\n{c}") for i in (5, 9, 10)]]
    rows = {r.doc_id: r for r in line_dedup(spark.createDataFrame(given, "doc_id long, text string")).collect()}
    assert [rows[i].n_removed for i in (1, 2, 5, 9, 10)] == [0, 0, 0, 3, 3] and rows[10].sources == [5]


def test_moved_block_goes_and_twenty_one_are_as_twenty(spark):
    x = ["one block of six words here", "and its second line of words"]
    y = ["another block of six words here", "with a second line as well", "and a third one too"]
    given = [(1, "\n".join(x + y)), (2, "\n".join(y + x))] + [(100 + i, f"start of {i} alone\n" + "\n".join(x) + f"\nend of {i} alone") for i in range(30)]
    rows = {r.doc_id: r for r in line_dedup(spark.createDataFrame(given, "doc_id long, text string")).collect()}
    assert rows[1].n_removed == 0 and rows[2].n_removed == 5
    assert all(rows[100 + i].n_removed == 2 and rows[100 + i].sources == [1] for i in range(30))


def test_large_group_of_copies_is_not_too_common(spark):
    text = "\n".join(f"line number {i} of the copied document" for i in range(4))
    one = "a single line document that very many copies share"
    given = [(i, text) for i in range(60)] + [(100 + i, one) for i in range(60)]
    rows = {r.doc_id: r.text for r in line_dedup(spark.createDataFrame(given, "doc_id long, text string")).collect()}
    assert rows[0] == text and rows[100] == one
    assert all(t == "" for i, t in rows.items() if i not in (0, 100))


def test_block_of_one_line_goes_from_any_number_of_documents(spark):
    block = "ten words that stand in very many documents as one"  # block_words
    short = "only nine words that stand in very many documents"
    given = [(i, f"own start {i}\n{block}\nown middle {i}\n{short}\nown end {i}") for i in range(60)]
    rows = {r.doc_id: r for r in line_dedup(spark.createDataFrame(given, "doc_id long, text string")).collect()}
    assert rows[0].text == given[0][1] and rows[0].n_removed == 0
    assert all(r.text == given[i][1].replace(block + "\n", "") and r.sources == [0] for i, r in rows.items() if i)


def test_awkward_and_empty(spark):
    out = line_dedup(awkward(spark))
    assert out.count() == len(AWKWARD) and set(CLASHES) <= set(out.columns)
    assert all(r.gone == "own gone" for r in out.collect())
    assert line_dedup(empty(spark)).collect() == []
