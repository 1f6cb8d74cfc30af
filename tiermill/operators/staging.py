"""Raw -> staging and raw -> quarantine.

Both are a filter plus a projection over the raw scan, so each compiles to a
single whole-stage-codegen span with no shuffle.  They are two scans rather
than one persisted evaluation: on parquet a second pruned scan is cheaper
than writing and re-reading a cached copy of the raw layer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.text import audit_time, canonical_text, round_to_long, safe_timestamp, strip_ws


def with_parsed_time(raw: DataFrame) -> DataFrame:
    """``raw`` with the hire time parsed once, as ``_ts``.  The value comes out
    of a generator: a plain projection would be inlined into every later filter
    (the staging rule, a mart's year) and parse the text again in each."""
    return raw.select("*", F.explode(F.array(safe_timestamp("datetime"))).alias("_ts"))


def staging_employees(raw: DataFrame, as_of: str | None = None,
                      blank_name_to_staging: bool = True) -> DataFrame:
    """Cleaned employees: name stripped, datetime canonical UTC text, job id
    rounded to an integer, audit stamp.  ``hired_at`` keeps the parsed time
    (seconds precision) beside the text so that the marts filter on a typed
    column that reaches the parquet reader."""
    parsed = with_parsed_time(raw)
    ts_kept = F.col("_ts")
    return parsed.filter(rules.staging_predicate(ts_kept, blank_name_to_staging)).select(
        F.col("id"),
        strip_ws("name").alias("name"),
        canonical_text(ts_kept).alias("datetime"),
        F.col("department_id"),
        round_to_long("job_id").alias("job_id"),
        audit_time(as_of).alias("processed_at"),
        F.date_trunc("second", ts_kept).alias("hired_at"),
    )


def quarantine_employees(raw: DataFrame, as_of: str | None = None) -> DataFrame:
    """Rejected raw rows with the first failing rule as the reason."""
    ts = F.col("_ts")
    return with_parsed_time(raw).filter(rules.quarantine_predicate(ts)).select(
        "id", "name",
        F.col("datetime").alias("original_datetime_string"),
        "department_id", "job_id",
        rules.quarantine_reason(ts).alias("rejection_reason"),
        audit_time(as_of).alias("quarantined_at"),
    )


def staging_dimension(raw: DataFrame, name_col: str) -> DataFrame:
    """Staging departments / jobs: the two columns, nothing else."""
    return raw.select("id", name_col)
