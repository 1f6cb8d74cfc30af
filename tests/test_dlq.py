"""Dead-letter envelope and quarantine export."""

import json

import pytest
from pyspark.sql import functions as F

from tiermill import schemas
from tiermill.operators import dlq, ingest, staging
from test_ingest import BROKEN, CLERK, evaluated


def test_envelope_per_batch(spark):
    ev = evaluated(spark, ("employees", "a", [BROKEN, CLERK, dict(BROKEN, id=7)]))
    env = dlq.envelopes(ingest.rejected_records(ev), as_of="2024-05-02 14:30:22").collect()
    assert len(env) == 1 and env[0]["count"] == 2
    doc = json.loads(env[0].envelope)
    assert (doc["timestamp"], doc["table"], doc["count"]) == ("20240502_143022", "employees", 2)
    assert [r["index"] for r in doc["records"]] == [0, 2]
    assert json.loads(doc["records"][1]["record"])["id"] == 7


def test_quarantine_export_names_and_order(spark):
    raw = spark.createDataFrame([(3, None, "x", 1, 1.0), (1, "a", "202", 1, 2.0), (2, "b", None, 1, None)],
                                schemas.RAW_EMPLOYEES)
    out = dlq.quarantine_export(staging.quarantine_employees(raw, as_of="2024-01-01 00:00:00"))
    assert out.columns == ["id", "name", "datetime", "department_id", "job_id", "rejection_reason",
                           "quarantine_at"]
    rows = out.collect()
    assert [r.id for r in rows] == [1, 2, 3]  # same stamp: ties broken by id
    assert rows[0].quarantine_at == "2024-01-01 00:00:00" and rows[0].job_id == 2


def test_export_of_null_ids_is_spread(spark, root):
    """Half of the rows have a null id: no part of the export holds more than
    twice the mean."""
    from pyspark.sql import functions as F
    raw = spark.range(40000).select(
        F.when(F.col("id") % 2 == 0, F.col("id")).alias("id"), F.concat(F.lit("n"), F.col("id")).alias("name"), F.lit("202").alias("datetime"),
        (F.col("id") % 9).alias("department_id"), F.col("id").cast("double").alias("job_id"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = dlq.quarantine_export(staging.quarantine_employees(raw, as_of="2024-01-01 00:00:00"))
        sizes = [r[0] for r in parts.groupBy(F.spark_partition_id()).count().select("count").collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 40000 and max(sizes) <= 2 * 40000 / 8
    assert dlq.write_quarantine_export(parts.limit(0).selectExpr("id", "name", "datetime as original_datetime_string", "department_id", "double(job_id) as job_id",
                                                                 "rejection_reason", "timestamp'2024-01-01' as quarantined_at"), root, "2024-01-01 00:00:00") != \
        dlq.write_quarantine_export(staging.quarantine_employees(raw, as_of="2024-01-01 00:00:00"), root, "2024-01-01 00:00:00")


def _quarantined(spark, rows):
    return spark.createDataFrame([(i, n, "202", 1, 2.0, "why", t) for i, n, t in rows],
                                 "id long, name string, original_datetime_string string, department_id long, job_id double, "
                                 "rejection_reason string, quarantined_at string").withColumn("quarantined_at", F.col("quarantined_at").cast("timestamp"))


def test_export_runs_lose_and_repeat_nothing(spark, root):
    first = _quarantined(spark, [(1, "a", "2024-01-01 00:00:00"), (None, None, "2024-01-01 00:00:01.2"), (2, "b", "2024-01-01 00:00:01.2")])
    assert dlq.export_new(first.limit(0), root) is None
    assert dlq.export_new(first, root) and dlq.export_new(first, root) is None
    # equal rows within the second of the mark, before and after its stamp; repeats count
    more = first.unionByName(_quarantined(spark, [(2, "b", "2024-01-01 00:00:01.1"), (2, "b", "2024-01-01 00:00:01.9"), (3, "c", "2024-01-01 00:00:05")]))
    assert dlq.export_new(more, root) and dlq.export_new(more, root) is None
    rows = dlq.exported(spark, root)
    whole = dlq.quarantine_export(more)
    assert rows.drop("run").exceptAll(whole).count() == 0 and whole.exceptAll(rows.drop("run")).count() == 0
    assert sorted((r["run"], r["id"] or 0) for r in rows.collect()) == [(1, 0), (1, 1), (1, 2), (2, 2), (2, 2), (2, 3)]


def test_a_run_without_its_mark_does_not_count(spark, root, monkeypatch):
    one = _quarantined(spark, [(1, "a", "2024-01-01 00:00:00")])
    two = one.unionByName(_quarantined(spark, [(2, "b", "2024-01-01 00:00:00")]))
    dlq.export_new(one, root)

    def dies(*args, **kwargs):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(dlq, "write_table", dies)
        with pytest.raises(OSError):
            dlq.export_new(two, root)
    assert [r["id"] for r in dlq.exported(spark, root).collect()] == [1]
    dlq.export_new(two, root)
    assert sorted(r["id"] for r in dlq.exported(spark, root).collect()) == [1, 2]


def test_later_runs_scan_from_the_mark(spark, root):
    path = root + "/q"
    _quarantined(spark, [(1, "a", "2024-01-01 00:00:00")]).write.parquet(path)
    q = spark.read.parquet(path)
    since = q.filter(F.col("quarantined_at") >= F.lit("2024-01-02").cast("timestamp"))
    assert "GreaterThanOrEqual(quarantined_at" in since._jdf.queryExecution().executedPlan().toString()
