"""Registered queries of this subpackage: name -> (spark, sf_dir) -> DataFrame,
and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermill.llm.common import table
from tiermill.llm.decontaminate import contaminated
from tiermill.llm.hard_negatives import mine_negatives
from tiermill.llm.jaccard_join import jaccard_classes
from tiermill.llm.langid import fit_languages, label_language
from tiermill.llm.licenses import PHRASES, TEMPLATES, plain, scan_licenses
from tiermill.llm.line_dedup import line_dedup
from tiermill.llm.near_vectors import near_vectors
from tiermill.llm.packing import pack_documents
from tiermill.llm.quality import CONTENT_SHARE, fit_quality, judge
from tiermill.llm.sharding import histogram_shards
from tiermill.llm.substring_dedup import substring_dedup
from tiermill.llm.url_cascade import build_cascade, first_listed, is_listed, rule_keys, split_url
from tiermill.llm.vector_codes import code_vectors, codebook_sha256

#: Fixed URL rules (host, path) and their verdicts.
URL_RULES = {("net", "/"): "block", ("example.net", "/en/"): "allow", ("example.com", "/de/"): "block", ("org", "/fr/"): "allow"}

#: A host is listed if one of its labels, cut at hyphens, holds one of these words.
LISTED_WORDS = ("ads", "adult", "bets", "casino", "pills", "porn", "spam", "xxx")
_LISTED_HOST = rf"(^|[.-])({'|'.join(LISTED_WORDS)})([.-]|$)"


def op1_patience_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_removed", F.coalesce(F.size("sources"), F.lit(0)).cast("long").alias("n_sources"), F.sha2("text", 256).alias("kept_sha256"))


def op2_fixed_block_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(table(spark, sf_dir, "documents"))


def op4_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two cascades.  The rule of a page is its longest listed key: the universe
    is every key that a rule could have for some page, the rules' keys are listed.
    Pages without a rule are judged by host: the universe is every host of the
    table, listed are those whose names hold one of ``LISTED_WORDS``."""
    host, path = split_url(F.col("url"))
    pages = table(spark, sf_dir, "pages").select("page_id", host.alias("host"), path.alias("path"))
    pages = pages.withColumn("keys", rule_keys(F.col("host"), F.col("path"), list(URL_RULES)))
    verdicts = spark.createDataFrame([(own + start, verdict) for (own, start), verdict in URL_RULES.items()], "rule string, own string")
    universe = pages.select(F.explode("keys").alias("rule")).distinct().join(F.broadcast(verdicts), "rule", "left")
    rules = build_cascade(universe.select("rule", F.col("own").isNotNull().alias("listed")), "rule", "listed")
    pages = pages.withColumn("rule", first_listed(rules, F.col("keys"))).drop("keys").join(F.broadcast(verdicts), "rule", "left")
    hosts = pages.select("host").distinct().select("host", F.col("host").rlike(_LISTED_HOST).alias("listed"))
    listed = is_listed(build_cascade(hosts, "host", "listed"), F.col("host"))
    return pages.select("page_id", "host", "path", "rule", F.coalesce("own", F.when(listed, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"))


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents that language ID must not learn from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def op5_crf_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_languages(docs, usable=~held_out())
    return label_language(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op7_quality_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = judge(docs, fit_quality(docs, table(spark, sf_dir, "labels")))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    content = F.col("n_content_words") >= CONTENT_SHARE * F.col("n_words")
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       failed.alias("base_failed"), (~failed & content).alias("kept"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    words = F.transform("places", lambda x: x["word"])
    own, met = F.transform("places", lambda x: x["label"]), F.transform("matches", lambda x: x["label"])
    best = F.coalesce(F.array_max(F.transform("matches", lambda x: x["containment"])), F.lit(0.0))
    return rows.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min(words).alias("first_word"), F.array_max(words).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(own)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(own, met))), ",").alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(best).alias("score"))


def op9_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = histogram_shards(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op10_simhash_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_strassen_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_negatives(table(spark, sf_dir, "embeddings"), anchor=F.col("vec_id") % 100 == 0, label=label)


def op12_hyperplane_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op13_bounded_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = code_vectors(table(spark, sf_dir, "embeddings"))
    return codes.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(codebook_sha256(books)).alias("codebooks_sha256"))


QUERIES = {f.__name__: f for f in (op1_patience_line_dedup, op2_fixed_block_dedup, op3_jaccard_join, op4_url_cascade, op5_crf_language_id, op6_best_fit_packing, op7_quality_lines, op8_license_scan, op10_simhash_decontamination,
                                    op9_histogram_shards, op11_strassen_hard_negatives, op12_hyperplane_near_vectors, op13_bounded_vector_codes)}

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _rules_sql() -> str:
    longest = sorted(URL_RULES, key=lambda r: -len(r[0] + r[1]))
    return " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h}{p}'" for h, p in longest)


def _op4_sql() -> str:
    verdict = " ".join(f"WHEN '{h}{p}' THEN '{v}'" for (h, p), v in URL_RULES.items())
    return f"""
WITH cut AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
parts AS (SELECT page_id, coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), {_LOWER}), '') AS host,
                 coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM cut),
ruled AS (SELECT *, CASE {_rules_sql()} END AS rule FROM parts),
judged AS (SELECT *, CASE rule {verdict} END AS own FROM ruled),
listed AS (SELECT DISTINCT host FROM (SELECT host, unnest(regexp_split_to_array(host, '[.-]')) AS word FROM judged)
           WHERE word IN {LISTED_WORDS})
SELECT page_id, host, path, rule, coalesce(own, CASE WHEN host IN (FROM listed) THEN 'block' ELSE 'allow' END) AS verdict
FROM judged"""


def _op8_sql() -> str:
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    templates = ", ".join(f"('{label}', {sorted({w.decode() for w in plain(text.encode()).split()})})" for label, text in TEMPLATES)
    places = []
    for phrase, label in PHRASES:
        words = phrase.split()
        meets = " AND ".join(f"ws[i + {k + 1}] = '{w}'" for k, w in enumerate(words))
        places.append(f"SELECT doc_id, i AS word, '{label}' AS label FROM (SELECT doc_id, ws, unnest(range(len(ws) - {len(words) - 1})) AS i FROM d) WHERE {meets}")
    return f"""
WITH low AS (SELECT doc_id, translate(coalesce(text, ''), {_LOWER}) AS body FROM documents),
d AS (SELECT doc_id, body, regexp_extract_all(body, '{word}') AS ws FROM low),
places AS ({" UNION ALL ".join(places)}),
base AS (SELECT doc_id, count(*) AS n, min(word) AS a, max(word) AS b FROM places GROUP BY doc_id),
templates(label, own) AS (VALUES {templates}),
blocks AS (SELECT doc_id, regexp_extract_all(unnest(string_split(body, chr(10))), '{word}') AS line FROM d),
met AS (SELECT doc_id, label, len(list_intersect(line, own)) / len(own) AS share FROM blocks, templates
        WHERE len(list_intersect(line, own)) >= ceil(0.9 * len(own) - 1e-9)),
best AS (SELECT doc_id, max(share) AS share FROM met GROUP BY doc_id),
names AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
          FROM (SELECT doc_id, label FROM places UNION ALL SELECT doc_id, label FROM met) GROUP BY doc_id),
own AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM places GROUP BY doc_id)
SELECT d.doc_id, len(ws) AS n_words, coalesce(n, 0) AS n_base, a AS first_word, b AS last_word,
       coalesce(own.labels, '') AS base_labels, coalesce(names.labels, '') AS labels,
       CASE WHEN n > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0)::DOUBLE END AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN names USING (doc_id) LEFT JOIN own USING (doc_id)"""


def _op2_sql() -> str:
    run = " || ' ' || ".join(f"ws[i + {k}]" for k in range(13))
    return rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
runs AS (SELECT doc_id, i, {run} AS run FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM d)),
earlier AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY run) AS owner FROM runs) WHERE owner < doc_id),
gone AS (SELECT doc_id, list(DISTINCT j) AS js FROM (SELECT doc_id, unnest(range(i, i + 13)) AS j FROM earlier) GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, coalesce(len(js), 0) AS n_removed,
       sha256(array_to_string(CASE WHEN js IS NULL THEN ws ELSE [w FOR w, j IN ws IF NOT list_contains(js, j)] END, ' ')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id)"""


def _op3_sql() -> str:
    return rf"""
WITH RECURSIVE low AS (SELECT doc_id, translate(coalesce(text, ''), {_LOWER}) AS body FROM documents),
d AS (SELECT doc_id, regexp_extract_all(body, '[^\x20\x09-\x0D]+') AS ws FROM low),
own AS (SELECT doc_id, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] || ' ' || ws[i + 3] AS s
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 2)) AS i FROM d)
        UNION SELECT doc_id, array_to_string(ws, ' ') FROM d WHERE len(ws) BETWEEN 1 AND 3),
sized AS (SELECT doc_id, count(*) AS n FROM own GROUP BY doc_id),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM own a JOIN own b ON a.s = b.s AND a.doc_id != b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM met JOIN sized x ON x.doc_id = a JOIN sized y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT doc_id, b FROM reach JOIN links ON a = other)
SELECT documents.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id
FROM documents LEFT JOIN sized USING (doc_id) JOIN reach USING (doc_id) GROUP BY documents.doc_id"""


#: Vectors that take part, as doubles; all of the table have one length.
_VECTORS_SQL = """
given AS (SELECT vec_id, label, [x::DOUBLE FOR x IN embedding] AS v FROM embeddings WHERE embedding IS NOT NULL),
finite AS (SELECT * FROM given WHERE len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0)"""


def _op11_sql() -> str:
    return f"""
WITH {_VECTORS_SQL},
d AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x) FOR x IN v] AS q FROM finite WHERE label IS NOT NULL),
scored AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
           FROM d a JOIN d b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
pos AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id))::INTEGER AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM pos JOIN scored USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5"""


def _op12_sql() -> str:
    return f"""
WITH RECURSIVE {_VECTORS_SQL},
d AS (SELECT vec_id, v, sqrt(list_inner_product(v, v)) AS norm FROM finite WHERE list_inner_product(v, v) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM d a JOIN d b ON a.vec_id <> b.vec_id AND list_inner_product(a.v, b.v) >= 0.9 * a.norm * b.norm),
reach(vec_id, other) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT vec_id, b FROM reach JOIN links ON a = other),
counted AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(any_value(n), 0) AS n_links, min(other) AS component_id, vec_id = min(other) AS kept
FROM reach LEFT JOIN counted USING (vec_id) GROUP BY vec_id"""


def _op13_sql() -> str:
    rounds, mean = "", ", ".join(f"floor(sum(x[{j}]) / count(*))::BIGINT" for j in (1, 2, 3, 4))
    distance = "list_sum(list_transform(list_zip(p.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    for r in (0, 1, 2):
        rounds += f""",
a{r} AS (SELECT vec_id, label, part, x, min(dist * 64 + entry) AS best
         FROM (SELECT p.vec_id, p.label, p.part, p.x, c.entry, {distance} AS dist FROM p JOIN c{r} c USING (part)) GROUP BY ALL)"""
        if r < 2:
            rounds += f""",
m{r} AS (SELECT part, (best % 64)::INTEGER AS entry, [{mean}] AS x FROM a{r} GROUP BY part, best % 64),
c{r + 1} AS (SELECT part, entry, coalesce(m{r}.x, c{r}.x) AS x FROM c{r} LEFT JOIN m{r} USING (part, entry))"""
    return f"""
WITH {_VECTORS_SQL},
d AS (SELECT vec_id, label, [floor(256 * x)::BIGINT FOR x IN v] AS q FROM finite),
p AS (SELECT vec_id, label, part, q[4 * part + 1:4 * part + 4] AS x FROM d, (SELECT unnest(range(16)) AS part)),
smallest AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM d QUALIFY entry < 64),
c0 AS (SELECT part, entry::INTEGER AS entry, x FROM p JOIN smallest USING (vec_id)){rounds},
codes AS (SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', best % 64), '' ORDER BY part) AS code, sum(best // 64)::BIGINT AS error FROM a2 GROUP BY vec_id),
books AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c2)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM codes, books"""


ORACLE: dict[str, str] = {
    "op11_strassen_hard_negatives": _op11_sql(),
    "op12_hyperplane_near_vectors": _op12_sql(),
    "op13_bounded_vector_codes": _op13_sql(),
    "op3_jaccard_join": _op3_sql(),
    "op2_fixed_block_dedup": _op2_sql(),
    "op4_url_cascade": _op4_sql(),
    "op8_license_scan": _op8_sql(),
}
