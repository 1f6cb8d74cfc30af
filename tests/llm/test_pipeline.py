import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from conftest import SF_ORACLE
from tiermill.llm.catalog import ORACLE, QUERIES


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """The input and the output of every stage, as the pipeline writes them."""
    folder = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{SF_ORACLE}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = os.path.join(folder, str(k))
        stage(spark, docs, SF_ORACLE).write.parquet(path)
        out.append((docs, spark.read.parquet(path)))
        docs = out[-1][1]
    return out


def ids(df):
    return [r[0] for r in df.select("doc_id").collect()]


def test_stages_keep_columns_and_clean_documents(steps):
    for before, after in steps[:-1]:
        assert after.columns == before.columns
        assert set(ids(after)) <= set(ids(before)) and len(ids(after)) == len(set(ids(after)))
    first, second = steps[0], steps[1]
    assert len(ids(first[1])) == 1000  # every document of the table is prose in a learned language
    texts = {r.doc_id: r.text for r in second[0].collect()}
    left = {r.doc_id: r.text for r in second[1].collect()}
    seen, copies = set(), set()
    for i in sorted(texts):
        key = " ".join(texts[i].split())
        (copies if key in seen else seen).add(i if key in seen else key)
    assert not copies & set(left)  # of exact copies only the smallest id is left
    unshared = [i for i in left if not set(texts[i].split("\n")) & {x for j, t in texts.items() if j != i for x in t.split("\n")}]
    assert unshared and all(left[i] == texts[i] for i in unshared)
    assert all(r.n_chars == len(r.text) for r in second[1].collect())


def test_near_duplicates_leave_one(spark, steps):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(1, text + " end"), (2, text + " other"), (3, "quite another text of its own, with words"), (None, text), (4, None)]
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(ids(corpus_pipeline.near_duplicates(spark, docs, SF_ORACLE)), key=str) == [1, 3, 4]


def test_rows_without_an_id_are_judged_by_text(spark):
    item = next(r.text for r in spark.read.parquet(f"{SF_ORACLE}/benchmark.parquet").orderBy("item_id").collect() if len(r.text.split()) >= 12)
    text = "\n".join(" ".join(f"w{i}x{k}" for i in range(12)) for k in range(6))
    own = " ".join(f"own{i}" for i in range(60))  # 51 of 61 shingles are shared with the next
    near = own.replace("own20", "other")
    rows = [(1, text), (None, text), (None, text), (None, own), (None, own), (None, near), (None, f"some words before it {item} and after"), (None, None), (None, " "), (2, text + "\nnew words")]
    docs = spark.createDataFrame([(*r, "en", "s", len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")

    def left(out):
        return sorted(((r.doc_id, r.text) for r in out.collect()), key=str)

    lines = corpus_pipeline.line_duplicates(spark, docs, SF_ORACLE)
    assert left(lines) == sorted([r for r in rows if r[1] != text and r[0] != 2] + [(1, text), (2, "new words")], key=str)
    kept = left(corpus_pipeline.near_duplicates(spark, docs, SF_ORACLE))
    assert (1, text) in kept and (None, text) not in kept and (None, None) in kept and (None, " ") in kept
    assert kept.count((None, own)) + kept.count((None, near)) == 1
    clean = left(corpus_pipeline.decontamination(spark, docs, SF_ORACLE))
    assert clean == sorted([r for r in rows if item not in (r[1] or "")], key=str)


def test_decontamination_drops_leaks_only(steps, spark):
    before, after = steps[3]
    items = [r.text for r in spark.read.parquet(f"{SF_ORACLE}/benchmark.parquet").collect()]
    held = {r.doc_id for r in before.collect() if any(" ".join(x.split()) in " ".join(r.text.split()) for x in items)}
    gone = set(ids(before)) - set(ids(after))
    assert held and held <= gone and len(gone) <= len(held) + 2


def test_packing_holds_every_document(steps):
    before, after = steps[4]
    assert {r.doc_id for r in after.collect()} == set(ids(before))
    assert after.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0


def test_run_equals_the_stages(spark, steps):
    got = corpus_pipeline.run(spark, SF_ORACLE)
    keep = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, got.select(*keep).collect())) == sorted(map(tuple, steps[4][1].select(*keep).collect()))


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_awkward_tables(spark, stage):
    schema = "doc_id long, text string, lang string, source string, n_chars long, n_lines string, score string, lang_pred string, sources string"
    rows = [(None, None, None, None, None, "a", "b", "c", "d"), (1, "", "en", "s", 0, "a", "b", "c", "d"), (2, "some words of it\nand more", None, None, 5, "a", "b", "c", "d"),
            (2, "some words of it\nand more", None, None, 5, "a", "b", "c", "d"), (3, "the words " * 9000, "en", "s", 1, "a", "b", "c", "d")]
    for given in (rows, []):
        docs = spark.createDataFrame(given, schema)
        out = stage(spark, docs, SF_ORACLE)
        n = out.count()
        assert n <= 60
        if stage is not corpus_pipeline.packing:
            assert out.columns == docs.columns
            assert all(r.score == "b" and r.lang_pred == "c" for r in out.collect())


def test_registered(spark):
    names = __spark_entry__.queries()
    assert "pipeline" in names and set(QUERIES) <= set(names)
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)}
    assert set(ORACLE) <= set(__spark_entry__.oracle_sql())
