"""Invariants over the driver's tables (whole tables, sf0.001)."""

from pyspark.sql import functions as F

from tiermill.plans.catalog import QUERIES
from conftest import SF_SMALL


def test_raw_equals_staging_plus_quarantine_minus_overlap(spark):
    c = QUERIES["split_counts"](spark, SF_SMALL).first()
    assert c.raw == c.staging + c.quarantine - c.overlap
    layers = {r.layer: r.records for r in QUERIES["layer_counts"](spark, SF_SMALL).collect()}
    assert layers["RAW"] == layers["STAGING"] + layers["QUARANTINE"] - layers["OVERLAP"]


def test_quarters_add_up_and_forms_agree(spark):
    q = QUERIES["quarterly_hires"](spark, SF_SMALL)
    assert q.filter(F.col("Q1") + F.col("Q2") + F.col("Q3") + F.col("Q4") != F.col("total_hires")).count() == 0
    two = QUERIES["quarterly_two_level"](spark, SF_SMALL)
    assert q.exceptAll(two).count() == 0 and two.exceptAll(q).count() == 0
    a = QUERIES["dept_performance"](spark, SF_SMALL)
    b = QUERIES["above_mean_subquery"](spark, SF_SMALL)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_ingest_accounts_for_every_record(spark):
    s = QUERIES["ingest_summary"](spark, SF_SMALL).agg(F.sum("inserted"), F.sum("rejected")).first()
    guard = QUERIES["batch_guard"](spark, SF_SMALL)
    accepted = guard.filter("accepted").agg(F.sum("n_records")).first()[0]
    assert s[0] + s[1] == accepted
    valid_employees = QUERIES["ingest_valid"](spark, SF_SMALL).count()
    per_table = {r.table: r.inserted for r in QUERIES["ingest_summary"](spark, SF_SMALL)
                 .groupBy("table").agg(F.sum("inserted").alias("inserted")).collect()}
    assert per_table["employees"] == valid_employees
