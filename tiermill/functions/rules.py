"""Rule catalogue.

Two families of rules run over whole DataFrames as column expressions:

* the warehouse rules that split raw employees into staging and quarantine
  (first failing rule names the reason), and
* the record rules of the ingest path, which keep *all* errors of a record.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_of, is_blank, safe_timestamp, strip_ws

# ---------------------------------------------------------------------------
# Quarantine reasons, in the order they are tested.
# ---------------------------------------------------------------------------
REASON_MISSING_ID = "Missing ID"
REASON_MISSING_NAME = "Missing or empty Name"
REASON_BAD_DATETIME = "Invalid datetime format: "
REASON_MISSING_DEPARTMENT = "Missing Department ID"
REASON_MISSING_JOB = "Missing Job ID"


def quarantine_reason(ts: Column | None = None) -> Column:
    """First failing rule of a raw employee row, or null when none fails."""
    ts = safe_timestamp("datetime") if ts is None else ts
    return (
        F.when(F.col("id").isNull(), F.lit(REASON_MISSING_ID))
        .when(F.col("name").isNull() | is_blank("name"), F.lit(REASON_MISSING_NAME))
        .when(ts.isNull(), F.concat(F.lit(REASON_BAD_DATETIME),
                                    F.coalesce(F.col("datetime"), F.lit("NULL"))))
        .when(F.col("department_id").isNull(), F.lit(REASON_MISSING_DEPARTMENT))
        .when(F.col("job_id").isNull(), F.lit(REASON_MISSING_JOB))
    )


def staging_predicate(ts: Column | None = None, blank_name_to_staging: bool = True) -> Column:
    """Rows kept by staging.  By default a name of only spaces passes (it is
    stored as ``''``) and is quarantined as well; ``blank_name_to_staging=False``
    keeps such rows out of staging."""
    ts = safe_timestamp("datetime") if ts is None else ts
    keep = (F.col("id").isNotNull() & F.col("name").isNotNull() & ts.isNotNull()
            & F.col("department_id").isNotNull() & F.col("job_id").isNotNull())
    if not blank_name_to_staging:
        keep = keep & ~is_blank("name")
    return keep


def quarantine_predicate(ts: Column | None = None) -> Column:
    ts = safe_timestamp("datetime") if ts is None else ts
    return (F.col("id").isNull() | F.col("name").isNull() | is_blank("name") | ts.isNull()
            | F.col("department_id").isNull() | F.col("job_id").isNull())


# ---------------------------------------------------------------------------
# Record rules of the ingest path.
# ---------------------------------------------------------------------------
# Validation messages of the record model and its validators.
MSG_REQUIRED = "Field required"
MSG_INT = "Input should be a valid integer"
MSG_INT_FRACTION = "Input should be a valid integer, got a number with a fractional part"
MSG_STR = "Input should be a valid string"
MSG_GT0 = "Input should be greater than 0"
MSG_MIN1 = "String should have at least 1 character"
MSG_MAX = "String should have at most {n} characters"
MSG_NAME_EMPTY = "Value error, Name cannot be empty after stripping"
MSG_DATETIME = "Value error, no es un formato de fecha aceptable"
MSG_DEPARTMENT_EMPTY = "Value error, Department name cannot be empty"
MSG_JOB_EMPTY = "Value error, Job title cannot be empty"
ERROR_TYPE = "ValidationError"
MODEL_NAMES = {"employees": "Employee", "departments": "Department", "jobs": "Job"}
MIN_DATETIME_CHARS = 10
BATCH_MIN, BATCH_MAX = 1, 1000


@dataclass(frozen=True)
class Field:
    name: str
    kind: str                 # "id" (positive integer), "text", "datetime"
    max_len: int | None = None
    empty_msg: str | None = None


# Fields of each record model, in declaration order.
MODELS = {
    "employees": (
        Field("id", "id"),
        Field("name", "text", 255, MSG_NAME_EMPTY),
        Field("datetime", "datetime"),
        Field("department_id", "id"),
        Field("job_id", "id"),
    ),
    "departments": (
        Field("id", "id"),
        Field("department", "text", 100, MSG_DEPARTMENT_EMPTY),
    ),
    "jobs": (
        Field("id", "id"),
        Field("job", "text", 100, MSG_JOB_EMPTY),
    ),
}

ALL_FIELDS = tuple(dict.fromkeys(f.name for fs in MODELS.values() for f in fs))


# Shapes of number text: casts run only on text of the right shape, since a
# failed cast builds (and drops) an exception -- costly when it is per row.
INTEGER_TEXT = r"^\s*[+-]?\d+\s*$"
NUMBER_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
# Doubles hold every whole number up to here.
EXACT_DOUBLE = 2.0 ** 53


def is_number(kind: Column) -> Column:
    """Whether a token is a JSON number (``kind``: its variant type)."""
    return kind.isin("BIGINT", "DOUBLE") | kind.startswith("DECIMAL")


def as_number(text: Column, kind: Column) -> Column:
    """A JSON number or numeric string as a double, else null."""
    return F.when((is_number(kind) | (kind == "STRING")) & text.rlike(NUMBER_TEXT), text.try_cast("double"))


def integral(text: Column, kind: Column) -> Column:
    """A JSON number or numeric string as a long, if it is a whole number that
    a long holds exactly.  Integer text never goes through a double."""
    as_double = as_number(text, kind)
    return (F.when(~(is_number(kind) | (kind == "STRING")), F.lit(None).cast("bigint"))
            .when((kind == "BIGINT") | text.rlike(INTEGER_TEXT), text.try_cast("bigint"))
            .when((as_double % 1 == 0) & (F.abs(as_double) <= EXACT_DOUBLE), as_double.try_cast("bigint")))


def _field_error(f: Field, kind: Column, text: Column, as_long: Column) -> Column:
    """Message for one field, null when the field is valid.  ``kind`` is the
    token's variant type (null: no such field; VOID: JSON null), ``as_long`` the
    field's integral value (only used for id fields)."""
    missing = F.when(kind.isNull(), F.lit(MSG_REQUIRED))
    if f.kind == "id":
        number = as_number(text, kind)
        err = (missing
               .when(as_long.isNull() & (number % 1 != 0), F.lit(MSG_INT_FRACTION))
               .when(as_long.isNull(), F.lit(MSG_INT))
               .when(as_long <= 0, F.lit(MSG_GT0)))
    elif f.kind == "text":
        err = (missing
               .when(kind != "STRING", F.lit(MSG_STR))
               .when(F.length(text) < 1, F.lit(MSG_MIN1))
               .when(F.length(text) > f.max_len, F.lit(MSG_MAX.format(n=f.max_len)))
               .when(is_blank(text), F.lit(f.empty_msg)))
    else:  # datetime: stored unchanged, must read as a full date(-time)
        err = (missing
               .when(kind != "STRING", F.lit(MSG_STR))
               .when((F.length(text) < MIN_DATETIME_CHARS)
                     | safe_timestamp(text).isNull(), F.lit(MSG_DATETIME)))
    return F.concat(F.lit(f.name + ": "), err)  # null when err is null


def field_plan() -> list[tuple[str, Field, tuple[str, ...]]]:
    """Every distinct (column, rule) of the record models with the tables it
    applies to, in an order that keeps each model's declaration order."""
    plan: dict[tuple[str, Field], list[str]] = {}
    for table, fields in MODELS.items():
        for f in fields:
            plan.setdefault((f.name, f), []).append(table)
    return [(name, f, tuple(tables)) for (name, f), tables in plan.items()]


def tables_of_field() -> dict[str, list[str]]:
    """The tables that have a field, for every field name."""
    return {n: [t for t, fields in MODELS.items() if any(f.name == n for f in fields)] for n in ALL_FIELDS}


ERROR_SEP = "; "


def field_errors(table: Column, text_of, kind_of, long_of) -> list[Column]:
    """One message column per (field, rule set) of the record models, null
    when that field is valid or the record's table has no such field.
    ``text_of(name)``, ``kind_of(name)`` and ``long_of(name)`` give a field's
    text, token type and integral value as columns."""
    return [F.when(table.isin(*tables), _field_error(f, kind_of(name), text_of(name), long_of(name)))
            for name, f, tables in field_plan()]


def count_and_join(messages: list[Column]) -> tuple[Column, Column]:
    """(number of non-null messages, messages joined by ``ERROR_SEP``).
    ``concat_ws`` skips nulls; no array filter (higher-order functions have
    no code generation)."""
    n = sum((m.isNotNull().cast("int") for m in messages[1:]), messages[0].isNotNull().cast("int"))
    return n, F.concat_ws(ERROR_SEP, *messages)


def valid_projection(table: str) -> list[Column]:
    """Typed columns stored for a valid record (text stripped, ids as long),
    over the ``f_<name>`` / ``v_<name>`` columns of an evaluated feed."""
    out = []
    for f in MODELS[table]:
        if f.kind == "id":
            out.append(F.col(f"v_{f.name}").alias(f.name))
        elif f.kind == "text":
            out.append(strip_ws(F.col(f"f_{f.name}")).alias(f.name))
        else:
            out.append(F.col(f"f_{f.name}").alias(f.name))
    return out


def table_is_known(c: str | Column) -> Column:
    """Never null: a null table is not known."""
    return F.coalesce(col_of(c).isin(*MODELS.keys()), F.lit(False))


ID_FIELDS = tuple(sorted({n for n, f, _ in field_plan() if f.kind == "id"}))


def id_values() -> list[Column]:
    """``v_<name>``: integral value of each id field over ``f_<name>``, ``k_<name>``."""
    return [integral(F.col(f"f_{n}"), F.col(f"k_{n}")).alias(f"v_{n}") for n in ID_FIELDS]


def record_checks() -> list[Column]:
    """Per-field message columns over ``table``, ``f_*``, ``k_*``, ``v_*``."""
    return field_errors(F.col("table"), lambda n: F.col(f"f_{n}"), lambda n: F.col(f"k_{n}"),
                        lambda n: F.col(f"v_{n}") if n in ID_FIELDS else F.lit(None))
