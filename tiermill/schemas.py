"""Table schemas and layer naming.

Raw keeps ``datetime`` as text (the quarantine reason quotes it verbatim) and
``job_id`` as double (CSV exports write ``96.0``); staging casts.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The table names the ingest accepts and the layer names.
TABLES = ("employees", "departments", "jobs")
LAYERS = ("raw", "staging", "quarantine", "marts")

RAW_EMPLOYEES = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("datetime", T.StringType()),
    T.StructField("department_id", T.LongType()),
    T.StructField("job_id", T.DoubleType()),
])

RAW_DEPARTMENTS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("department", T.StringType()),
])

RAW_JOBS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("job", T.StringType()),
])

RAW = {"employees": RAW_EMPLOYEES, "departments": RAW_DEPARTMENTS, "jobs": RAW_JOBS}

# Declared (append-time) schemas: every field required, ids integral.
DECLARED_EMPLOYEES = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("datetime", T.StringType(), False),
    T.StructField("department_id", T.LongType(), False),
    T.StructField("job_id", T.LongType(), False),
])
DECLARED_DEPARTMENTS = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("department", T.StringType(), False),
])
DECLARED_JOBS = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("job", T.StringType(), False),
])
DECLARED = {"employees": DECLARED_EMPLOYEES, "departments": DECLARED_DEPARTMENTS,
            "jobs": DECLARED_JOBS}

STAGING_EMPLOYEES = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("datetime", T.StringType()),
    T.StructField("department_id", T.LongType()),
    T.StructField("job_id", T.LongType()),
    T.StructField("processed_at", T.TimestampType()),
    T.StructField("hired_at", T.TimestampType()),
])

QUARANTINE_EMPLOYEES = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("original_datetime_string", T.StringType()),
    T.StructField("department_id", T.LongType()),
    T.StructField("job_id", T.DoubleType()),
    T.StructField("rejection_reason", T.StringType()),
    T.StructField("quarantined_at", T.TimestampType()),
])

# One rejected record of an ingest batch.
REJECTED_RECORD = T.StructType([
    T.StructField("index", T.LongType()),
    T.StructField("record", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("error_type", T.StringType()),
])

# A request line: a table, a batch and its records, each kept as JSON text.
REQUEST = T.StructType([
    T.StructField("table", T.StringType()),
    T.StructField("batch_id", T.StringType()),
    T.StructField("data", T.ArrayType(T.StringType())),
    T.StructField("_corrupt_record", T.StringType()),
])


def schema_name(layer: str | None, default: str = "default",
                prefix: str = "tiermill") -> str:
    """Database (schema) for a layer: ``<prefix>_<layer>``, or the default."""
    if layer is None:
        return default
    return f"{prefix}_{layer.strip()}"


def table_name(layer: str, name: str, prefix: str = "tiermill") -> str:
    """Fully qualified table name ``<prefix>_<layer>.<name>``."""
    return f"{schema_name(layer, prefix=prefix)}.{name}"
