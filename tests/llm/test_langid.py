import zlib

import pyarrow.parquet as pq

from conftest import SF_ORACLE
from fixtures import AWKWARD, CLASHES, awkward, empty
from tiermill.llm.catalog import QUERIES
from tiermill.llm.common import hash_words
from tiermill.llm.langid import _scores, fit_languages, label_language, train


def test_held_out_accuracy(spark):
    rows = QUERIES["op5_crf_language_id"](spark, SF_ORACLE).collect()
    docs = pq.read_table(f"{SF_ORACLE}/documents.parquet").to_pylist()
    lang = {d["doc_id"]: d["lang"] for d in docs}
    assert len(rows) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    out = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in out) >= 0.98 * len(out)


def test_words_of_a_switched_text():
    en, fr = "the cat and the dog with this that\nof the house and what", "le chat et les chiens avec une\ndans la maison du pere"
    model = train([(en, "en"), (fr, "fr")] * 30)
    assert model.langs == ["en", "fr"]
    assert model.chain.trans[0, 0] > model.chain.trans[0, 1]


def test_learns_from_the_middle_of_long_words():
    ends, middle = "ab" * 40, {"xx": "kelomu" * 30, "yy": "tirasa" * 30}
    model = train([(f"{ends}{middle[lang]}{k}{ends}", lang) for lang in middle for k in range(30)])
    for lang in middle:
        word = (ends + middle[lang] + "new" + ends).encode()
        scores = _scores([word], hash_words([word]), model)[0]
        assert model.langs[int(scores.argmax())] == lang and abs(scores[0] - scores[1]) > 1


def test_awkward_rows(spark):
    model = train([("the cat and the dog", "en"), ("le chat et les chiens", "fr")] * 20)
    out = label_language(awkward(spark), model)
    assert set(out.columns) == {"doc_id", "text", *CLASHES}
    rows = out.collect()
    assert len(rows) == len(AWKWARD)
    for r in rows:
        lettered = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not lettered) and 0 <= r.score <= 1 and (lettered or r.score == 0)
        assert r.g == "own g"


def test_no_labels_and_empty(spark):
    docs = spark.createDataFrame([(1, "some words", None)], "doc_id long, text string, lang string")
    model = fit_languages(docs)
    assert model.langs == []
    assert label_language(docs, model).first().lang_pred == "und"
    some = train([("the cat", "en")])
    assert label_language(empty(spark), some).collect() == []
