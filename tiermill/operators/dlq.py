"""Dead-letter sink for rejected records and the quarantine export.

Rejected records are written one JSON line each, under a directory of the
ingest run, so a retried run overwrites its own output.  The per-request
envelope ``{timestamp, table, count, records}`` is built by a grouped
aggregate over the invalid records of accepted requests: at most 1000 each, so
no group is unbounded.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import audit_time, export_text, round_to_long, stamp_text
from ..sources.writers import write_json, write_table
from .snapshots import StoredTable, stamp_of

# The columns of the quarantine export.
EXPORT = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
    T.StructField("datetime", T.StringType()), T.StructField("department_id", T.LongType()),
    T.StructField("job_id", T.LongType()), T.StructField("rejection_reason", T.StringType()),
    T.StructField("quarantine_at", T.StringType()),
])
RECORD_FIELDS = ["index", "record", "error", "error_type"]


def envelopes(rejected: DataFrame, as_of: str | None = None) -> DataFrame:
    """(table, batch_id, count, envelope): one row per request with rejects;
    ``envelope`` is the JSON text of the dead-letter entry, records ordered
    by their position in the batch."""
    ts = stamp_text(audit_time(as_of))
    grouped = rejected.groupBy("request", "table", "batch_id").agg(
        F.count(F.lit(1)).alias("count"),
        F.array_sort(F.collect_list(F.struct(*RECORD_FIELDS))).alias("records"))
    return grouped.select(
        "table", "batch_id", "count",
        F.to_json(F.struct(ts.alias("timestamp"), F.col("table"), F.col("count"),
                           F.col("records"))).alias("envelope"))


def write_rejects(rejected: DataFrame, root: str, run_id: str,
                  as_of: str | None = None) -> str:
    """One JSON line per rejected record under ``<root>/dlq/run=<run_id>``,
    partitioned by table."""
    path = os.path.join(root, "dlq", f"run={run_id}")
    lines = rejected.select("table", "batch_id", *RECORD_FIELDS,
                            stamp_text(audit_time(as_of)).alias("timestamp"))
    return write_json(lines, path, partition_by=["table"])


def _export_rows(quarantine: DataFrame) -> DataFrame:
    return quarantine.select(
        "id", "name", F.col("original_datetime_string").cast("string").alias("datetime"), "department_id",
        round_to_long("job_id").alias("job_id"), "rejection_reason", export_text("quarantined_at").alias("quarantine_at"))


def _newest_first(rows: DataFrame) -> DataFrame:
    # the row hash splits the range of equal times and ids (all null ids)
    return rows.orderBy(F.desc("quarantine_at"), F.asc_nulls_last("id"), F.xxhash64("name", "datetime", "department_id", "job_id"))


def quarantine_export(quarantine: DataFrame) -> DataFrame:
    """Quarantine rows under the export's column names, newest first."""
    return (quarantine
            .select("id", "name",
                    F.col("original_datetime_string").cast("string").alias("datetime"),
                    "department_id", round_to_long("job_id").alias("job_id"),
                    "rejection_reason", F.col("quarantined_at"))
            # the row hash splits the range of equal times and ids (all null ids)
            .orderBy(F.desc("quarantined_at"), F.asc_nulls_last("id"), F.xxhash64("name", "datetime", "department_id", "job_id"))
            .select("id", "name", "datetime", "department_id", "job_id", "rejection_reason",
                    export_text("quarantined_at").alias("quarantine_at")))


def write_quarantine_export(quarantine: DataFrame, root: str, as_of: str | None = None,
                            table: str = "employees") -> str:
    """Write the export to ``<root>/dlq/quarantine/<table>/quarantine_<stamp>_<id>``;
    the id keeps two exports of one second apart."""
    path = os.path.join(root, "dlq", "quarantine", table, f"quarantine_{stamp_of(as_of)}_{uuid.uuid4().hex[:8]}")
    return write_json(quarantine_export(quarantine), path)


# -- incremental export ---------------------------------------------------------


def _marks(spark: SparkSession, root: str, table: str) -> StoredTable:
    return StoredTable(spark, root, f"{table}_export_marks")


def export_new(quarantine: DataFrame, root: str, table: str = "employees") -> str | None:
    """Export the rows that were quarantined since the last run; returns the folder,
    None if there is nothing new.

    The high-water mark is the newest second exported so far; it bounds the scan.
    Rows that came later within that second are told from exported ones as a
    multiset, so equal stamps lose and repeat nothing.  Rows must not be stamped
    with a second before the mark once it is set.  A run counts when its mark is
    written, after its rows: a run that died in between is done again in a folder
    of its own, and :func:`exported` reads only the runs that count."""
    spark = quarantine.sparkSession
    marks = _marks(spark, root, table)
    past = marks.read().orderBy(F.desc("run")).first() if marks.current() else None
    second = F.date_trunc("second", "quarantined_at")
    if past is None:
        fresh = _export_rows(quarantine)
    else:
        mark = F.lit(past["mark"])
        old = exported(spark, root, table).drop("run").filter(F.col("quarantine_at") == export_text(mark))
        since = quarantine.filter(F.col("quarantined_at") >= mark)
        fresh = _export_rows(since.filter(second == mark)).exceptAll(old).unionByName(_export_rows(since.filter(second > mark)))
    path = os.path.join(root, "dlq", "quarantine", table, f"run_{uuid.uuid4().hex}")
    _newest_first(fresh).write.json(path)
    top = spark.read.schema(EXPORT).json(path).agg(F.max("quarantine_at").alias("top"), F.count(F.lit(1)).alias("rows")).first()
    if not top["rows"]:
        return None
    run = spark.range(1).select(F.lit((past["run"] if past else 0) + 1).cast("bigint").alias("run"), F.lit(path).alias("path"),
                                F.lit(top["top"]).cast("timestamp").alias("mark"))
    if past is None:
        marks.replace(run)
    else:
        write_table(run, marks.current(), mode="append")
    return path


def exported(spark: SparkSession, root: str, table: str = "employees") -> DataFrame:
    """All rows exported by the runs that count, with their ``run``."""
    runs = _marks(spark, root, table).read().select("run", F.col("path"))
    paths = [r["path"] for r in runs.collect()]  # one row a run
    rows = spark.read.schema(EXPORT).json(paths).withColumn("_folder", F.regexp_extract(F.input_file_name(), "(run_[0-9a-f]+)/", 1))
    return rows.join(runs.withColumn("_folder", F.regexp_extract("path", "(run_[0-9a-f]+)$", 1)).drop("path"), "_folder").drop("_folder")
