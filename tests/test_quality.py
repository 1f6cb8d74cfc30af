"""Quality checks and the publication gate."""

import pytest

from tiermill import schemas
from tiermill.operators import quality, staging


def test_checks_and_gate(spark):
    raw = spark.createDataFrame(
        [(1, "a", "2021-01-01", 1, 1.0), (1, "b", "2021-01-01", 1, 1.0),
         (2, "c", "2021-01-01", 9, 1.0)], schemas.RAW_EMPLOYEES)
    stg = staging.staging_employees(raw)
    dep = spark.createDataFrame([(1, "X")], schemas.RAW_DEPARTMENTS)
    job = spark.createDataFrame([(1, "Y")], schemas.RAW_JOBS)
    checks = {r.check: (r.failures, r.passed) for r in quality.staging_checks(stg, dep, job).collect()}
    assert checks["unique_id"] == (1, False)
    assert checks["orphans_department"] == (1, True)  # reported, not blocking
    assert checks["not_null_id"] == (0, True)
    with pytest.raises(quality.QualityGateError):
        quality.enforce(quality.staging_checks(stg, dep, job))


def test_quality_pct_and_empty_raw(spark):
    raw = spark.createDataFrame([(1, "a", "2021-01-01", 1, 1.0), (2, None, "x", 1, 1.0)],
                                schemas.RAW_EMPLOYEES)
    r = quality.quality_pct(raw, staging.staging_employees(raw)).first()
    assert (r.raw, r.valid, r.quality_pct, r.passed) == (2, 1, 50.0, False)
    empty = spark.createDataFrame([], schemas.RAW_EMPLOYEES)
    assert quality.quality_pct(empty, staging.staging_employees(empty)).first().quality_pct is None


def test_reconcile_finds_one_altered_row(spark):
    rows = [(i, f"n{i}") for i in range(200)] + [(None, "x"), (None, "x")]
    left = spark.createDataFrame(rows, "id long, name string")
    assert {r.equal for r in quality.reconcile(left, left.select("name", "id").repartition(5), "id").collect()} == {True}
    other = spark.createDataFrame([(i, "changed" if i == 77 else n) for i, n in rows], "id long, name string")
    assert [(r["range"], r.rows_left, r.rows_right) for r in quality.reconcile(left, other, "id").filter("NOT equal").collect()] == [(77 % 64, 3, 3)]
    twice = left.unionByName(left.limit(1)).exceptAll(left.filter("id = 70"))
    assert quality.reconcile(left, twice, "id").filter("NOT equal").count() >= 1
    assert quality.reconcile(left, left.limit(0), "id").filter("equal").count() == 0
