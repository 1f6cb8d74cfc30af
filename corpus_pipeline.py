"""The corpus pipeline: stages over ``documents``, each written as Parquet and
read again as the next one's input.

1. language: documents in no learned language, or hardly in one, go.
2. line_dedup: blocks of lines that an earlier document has are deleted; a
   document of which nothing is left goes.
3. near_duplicates: of each class of near duplicates the smallest id stays.
4. decontamination: documents that hold a benchmark item go.
5. packing: what is left is tokenized and packed into sequences.

Every stage but the last returns the columns of its input.  Rows without an id are
judged by their text in the stages 2 to 4, and count as later than all others;
near_duplicates keeps one of those that repeat a text.  Rows that repeat an id
and a text stay together.  Empty tables pass through.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermill import session
from tiermill.llm.catalog import held_out
from tiermill.llm.decontaminate import contaminated
from tiermill.llm.jaccard_join import jaccard_classes
from tiermill.llm.langid import fit_languages, label_language
from tiermill.llm.line_dedup import line_dedup
from tiermill.llm.packing import pack_documents

#: Least mean probability of the predicted language for a document to stay.
LEAST_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents whose words are in a learned language."""
    model = fit_languages(docs, usable=~held_out())
    kept = label_language(_numbered(docs), model, text=_own(docs, "text")).where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE))
    return _named(kept, docs)


def _numbered(docs: DataFrame) -> DataFrame:
    """Columns by number, so that no name clashes with those an operator adds."""
    return docs.toDF(*[f"_{k}" for k in range(len(docs.columns))])


def _named(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The numbered columns under the names that ``docs`` gives them."""
    return rows.select(*[F.col(f"_{k}").alias(c) for k, c in enumerate(docs.columns)])


def _own(docs: DataFrame, column: str) -> str:
    return f"_{docs.columns.index(column)}"


def _keyed(docs: DataFrame) -> DataFrame:
    """Numbered columns and _key: the id or, without one, a number above 2^62 by the text."""
    by_text = F.xxhash64(F.coalesce(F.col(_own(docs, "text")), F.lit(""))).bitwiseAND((1 << 62) - 1) + F.lit(1 << 62)
    return _numbered(docs).withColumn("_key", F.coalesce(F.col(_own(docs, "doc_id")).cast("long"), by_text))


def line_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Delete common blocks of lines; documents that were nothing else go."""
    text = _own(docs, "text")
    done = line_dedup(_keyed(docs), text=text, doc_id="_key")
    done = done.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
    if "n_chars" in docs.columns:
        chars, kind = _own(docs, "n_chars"), docs.schema["n_chars"].dataType
        done = done.withColumn(chars, F.when(F.col("n_removed") > 0, F.char_length(text).cast(kind)).otherwise(F.col(chars)))
    return _named(done, docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest id of each class of near duplicates: five-word
    shingles, similarity 0.8 or more."""
    own, text, id_ = _keyed(docs), _own(docs, "text"), F.col(_own(docs, "doc_id"))
    worded = F.coalesce(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    # only rows that lack an id are shuffled with their texts
    once = own.where(id_.isNull() & worded).dropDuplicates(["_key", text])
    own = own.where(id_.isNotNull() | ~worded).unionByName(once)
    copies = jaccard_classes(own, text=text, doc_id="_key", size=5, percent=80).where("component_id != doc_id").select(F.col("doc_id").alias("_key"))
    return _named(own.join(copies, "_key", "left_anti"), docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    own = _keyed(docs)
    leaks = contaminated(own, items, text=_own(docs, "text"), doc_id="_key").select(F.col("doc_id").alias("_key")).distinct()
    return _named(own.join(leaks, "_key", "left_anti"), docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents and their places in sequences."""
    return pack_documents(docs)


STAGES = [("language", language), ("line_dedup", line_duplicates), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("packing", packing)]

#: Language ID and packing have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = session.scratch_path(spark, f"pipeline-{uuid.uuid4().hex}")
    for k, (name, stage) in enumerate(STAGES):
        path = os.path.join(folder, f"{k}-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
