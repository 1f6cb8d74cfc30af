"""Request ingest: validate, split valid / rejected, summarize.

One line is one request ``{"table": ..., "batch_id": ..., "data": [...]}``.
Everything that decides about a request -- malformed text, unknown table,
missing batch id, number of records -- is a rule on its own row, and
``posexplode`` numbers the records.  So there is no shuffle, no window and no
batch list before the split, and the answer for a request does not depend on
which other requests are read with it.

:func:`evaluate` gives one row per record, those of rejected requests included
(a request without records gives one row that holds its line), so every input
line ends in exactly one of the valid, rejected-record or rejected-request sets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import rules
from ..sources.readers import CORRUPT

BATCH_KEY = ["table", "batch_id"]
#: ``request`` is the digest of the line: two requests of one batch id are two, and a
#: line that is delivered again is the same request.
REQUEST_KEY = ["request", *BATCH_KEY]

# Error texts that name a table or a record's shape.
ERR_TABLE = "Invalid table: "
ERR_NOT_OBJECT = "Input should be a valid dictionary"

ERR_MALFORMED = "The line is no request"
ERR_BATCH_ID = "The request names no batch"
ERR_BATCH_SIZE = f"A batch holds {rules.BATCH_MIN} to {rules.BATCH_MAX} records"
REQUEST_ERROR = "RequestError"


def read_requests(lines: DataFrame) -> DataFrame:
    """(line, request, table, batch_id, data, corrupt) from a text column ``value``.
    ``data`` keeps each record as its JSON text; blank lines are skipped."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = lines.filter(F.trim("value") != "").select(
        F.col("value").alias("line"), F.from_json("value", schemas.REQUEST, options).alias("r"))
    return parsed.select("line", F.md5("line").alias("request"), "r.table", "r.batch_id", "r.data",
                         (F.col("r").isNull() | F.col(f"r.{CORRUPT}").isNotNull()).alias("corrupt"))


def once(requests: DataFrame) -> DataFrame:
    """Requests that were delivered more than once, once (the batch counterpart of
    the stream's replay window)."""
    return requests.dropDuplicates(["request"])


def request_error() -> Column:
    """Why a whole request is rejected, else null."""
    return (F.when(F.col("corrupt"), F.lit(ERR_MALFORMED))
            .when(~rules.table_is_known("table"), F.concat(F.lit(ERR_TABLE), F.coalesce(F.col("table"), F.lit("NULL"))))
            .when(F.col("batch_id").isNull(), F.lit(ERR_BATCH_ID))
            .when(~F.coalesce(F.size("data").between(rules.BATCH_MIN, rules.BATCH_MAX), F.lit(False)), F.lit(ERR_BATCH_SIZE)))


def batch_verdicts(requests: DataFrame) -> DataFrame:
    """(table, batch_id, n_records, accepted, error) per request."""
    error = request_error()
    return requests.select(*BATCH_KEY, F.coalesce(F.size("data"), F.lit(0)).cast("bigint").alias("n_records"),
                           error.isNull().alias("accepted"), error.alias("error"))


def evaluate(requests: DataFrame) -> DataFrame:
    """One row per record: request, table, batch_id, ``index`` (place in the request),
    ``record`` (its text, or the line of a request without records), the field
    texts ``f_<name>``, the integral values ``v_<name>`` of id fields,
    ``request_error``, ``n_errors`` and ``error_list`` (all messages).

    A record is parsed once, into a variant; field texts and kinds are columns
    below the rules.  The last step goes through a generator, so that later
    filters on its columns are not pushed down with the rules inlined."""
    # the line goes on only where it is the record; copied beside each record of a request it would be quadratic
    bare = F.coalesce(F.size("data"), F.lit(0)) <= 0
    judged = requests.select(*REQUEST_KEY, F.when(bare, F.col("line")).alias("line"), "data", request_error().alias("request_error"))
    listed = judged.select(*REQUEST_KEY, "line", "request_error", F.posexplode_outer("data").alias("_at", "_text"))
    parsed = listed.select(
        *REQUEST_KEY, "request_error", F.col("_at").cast("bigint").alias("index"),
        F.coalesce("_text", F.when(F.col("_at").isNull(), F.col("line")), F.lit("null")).alias("record"),
        F.when(F.col("request_error").isNull(), F.try_parse_json("_text")).alias("_v"))
    # each field is looked up once, and only in records of a table that has it
    tokens = parsed.select(
        *REQUEST_KEY, "request_error", "index", "record",
        F.coalesce(F.schema_of_variant("_v").startswith("OBJECT"), F.lit(False)).alias("_is_object"),
        *[F.when(F.col("table").isin(*tables), F.try_variant_get("_v", f"$.{n}", "variant")).alias(f"_t_{n}")
          for n, tables in rules.tables_of_field().items()])
    fields = tokens.select(
        *REQUEST_KEY, "request_error", "index", "record", "_is_object",
        *[F.try_variant_get(f"_t_{n}", "$", "string").alias(f"f_{n}") for n in rules.ALL_FIELDS],
        *[F.schema_of_variant(f"_t_{n}").alias(f"k_{n}") for n in rules.ALL_FIELDS])
    typed = fields.select("*", *rules.id_values())
    checks = rules.record_checks()
    messages = typed.select("*", *[c.alias(f"_e{i}") for i, c in enumerate(checks)])
    n_rules, joined = rules.count_and_join([F.col(f"_e{i}") for i in range(len(checks))])
    whole = F.col("request_error").isNotNull()
    result = F.struct(
        F.when(whole | ~F.col("_is_object"), F.lit(1)).otherwise(n_rules).alias("n_errors"),
        F.when(whole, F.col("request_error")).when(F.col("_is_object"), joined).otherwise(F.lit(ERR_NOT_OBJECT)).alias("error_list"))
    return messages.select(
        *REQUEST_KEY, "index", "record", "request_error", *[F.col(f"f_{n}") for n in rules.ALL_FIELDS],
        *[F.col(f"v_{n}") for n in rules.ID_FIELDS], F.inline(F.array(result)))


def valid_records(evaluated: DataFrame, table: str) -> DataFrame:
    """Valid records of ``table`` in its declared schema, ready to append."""
    return (evaluated.filter((F.col("table") == table) & (F.col("n_errors") == 0))
            .select("batch_id", "index", *rules.valid_projection(table)))


def error_text() -> Column:
    n = F.col("n_errors")
    model = F.coalesce(*[F.when(F.col("table") == t, F.lit(m)) for t, m in rules.MODEL_NAMES.items()])
    return F.concat(n.cast("string"), F.lit(" validation error"),
                    F.when(n > 1, F.lit("s")).otherwise(F.lit("")),
                    F.lit(" for "), model, F.lit("; "), F.col("error_list"))


def all_rejects(evaluated: DataFrame) -> DataFrame:
    """(request, table, batch_id, index, record, error, error_type) of every record
    that was not stored: invalid ones and those of rejected requests."""
    whole = F.col("request_error").isNotNull()
    return (evaluated.filter(F.col("n_errors") > 0)
            .select(*REQUEST_KEY, "index", "record", F.when(whole, F.col("request_error")).otherwise(error_text()).alias("error"),
                    F.when(whole, F.lit(REQUEST_ERROR)).otherwise(F.lit(rules.ERROR_TYPE)).alias("error_type")))


def rejected_records(evaluated: DataFrame) -> DataFrame:
    """Invalid records of accepted requests."""
    return all_rejects(evaluated.filter(F.col("request_error").isNull()))


def summary(evaluated: DataFrame) -> DataFrame:
    """(request, table, batch_id, inserted, rejected) per accepted request."""
    return evaluated.filter(F.col("request_error").isNull()).groupBy(*REQUEST_KEY).agg(
        F.count_if(F.col("n_errors") == 0).alias("inserted"),
        F.count_if(F.col("n_errors") > 0).alias("rejected"))


def rejected_requests(evaluated: DataFrame) -> DataFrame:
    """(request, table, batch_id, error, n_records) per rejected request."""
    return (evaluated.filter(F.col("request_error").isNotNull()).groupBy(*REQUEST_KEY, F.col("request_error").alias("error"))
            .agg(F.count("index").alias("n_records")))
