"""Plan shape: the properties the design relies on at scale."""

import os

from tiermill.operators import marts, staging
from tiermill.operators.snapshots import StoredTable, overwrite
from tiermill.plans.catalog import layers
from tiermill.sources import feed
from conftest import SF_SMALL


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_marts_aggregate_before_join(spark):
    L = layers(spark, SF_SMALL)
    p = plan_of(marts.quarterly_hires(L["staging"], L["departments"], L["jobs"], 1997))
    # the fact side of the first join is a final aggregate over the fact keys
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    first_join = p.rfind("Join")
    assert "HashAggregate(keys=[department_id" in p[first_join:]


def test_dept_performance_has_no_cross_join(spark):
    L = layers(spark, SF_SMALL)
    p = plan_of(marts.dept_performance(L["staging"], L["departments"], 1997))
    assert "CartesianProduct" not in p and "NestedLoopJoin" not in p
    assert "Subquery" in p


def test_year_filter_reaches_stored_staging(spark, root):
    t = StoredTable(spark, root, "staging/employees", partition_by=["hire_year"])
    stg = staging.staging_employees(feed.raw_employees(spark, SF_SMALL))
    from pyspark.sql import functions as F
    overwrite(t, stg.withColumn("hire_year", F.year("hired_at")))
    path = t.current()
    stored = spark.read.parquet(path)
    p = plan_of(marts.quarterly_hires(stored, layers(spark, SF_SMALL)["departments"],
                                      layers(spark, SF_SMALL)["jobs"], 1997))
    scan = [line for line in p.split("\n") if "FileScan" in line and "hired_at" in line][0]
    assert "GreaterThanOrEqual(hired_at" in scan.split("PushedFilters")[1]
    assert "PartitionFilters: [isnotnull(hire_year" in scan and "= 1997)" in scan
    assert os.path.isdir(os.path.join(path, "hire_year=1997"))


def test_dept_performance_scans_the_fact_once(spark):
    L = layers(spark, SF_SMALL)
    df = marts.dept_performance(L["staging"], L["departments"], 1997)
    df.collect()
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "ReusedSubquery" in p and "ReusedExchange" in p


def test_gate_checks_scan_staging_twice(spark):
    from tiermill.operators import quality
    L = layers(spark, SF_SMALL)
    df = quality.staging_checks(L["staging"], L["departments"], L["jobs"])
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    scans = [line for line in final.split("\n") if "FileScan parquet" in line and "orders" in line]
    assert len(scans) == 2


def test_raw_to_mart_parses_each_time_once(spark):
    L = layers(spark, SF_SMALL)
    plan = marts.quarterly_hires(L["staging"], L["departments"], L["jobs"], 1997)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_cast") == 1, plan


def test_layer_counts_scan_raw_once(spark):
    from tiermill.plans.catalog import QUERIES
    assert plan_of(QUERIES["layer_counts"](spark, SF_SMALL)).count("FileScan parquet") == 1


def test_deltas_do_not_read_the_stored_fact(spark, root):
    L = layers(spark, SF_SMALL)
    counts = StoredTable(spark, root, "marts/hire_counts")
    overwrite(counts, marts.hire_counts(L["staging"], 1997))
    delta = spark.createDataFrame([(1, 1, 0, 0, 0, 1, 1)], "department_id long, job_id long, Q1 long, Q2 long, Q3 long, Q4 long, total_hires long")
    files = marts.with_deltas(counts.read(), delta).inputFiles()
    assert files and all("hire_counts" in f for f in files)
    taken = marts.with_deltas(counts.read(), marts.hire_counts(L["staging"], 1997, sign=-1))
    assert taken.count() == 0


def test_page_condition_reaches_the_files(spark, root):
    from tiermill.plans import serving
    keys = ["department", "job"]
    rows = spark.range(5000).selectExpr("concat('d', lpad(id % 50, 3, '0')) AS department", "concat('j', lpad(id, 5, '0')) AS job", "id AS total_hires")
    table = StoredTable(spark, root, "marts/pages")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the mart is too small for several files
    try:
        serving.store_in_order(table, rows, keys)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    mart, after, seen = table.read(), None, []
    for _ in range(60):
        page = serving.page(mart, keys, 100, after)
        seen += [(r.department, r.job) for r in page.collect()]
        after = serving.last_keys(page, keys)
        if after is None:
            break
    assert seen == sorted((r.department, r.job) for r in rows.collect())
    p = plan_of(serving.page(mart, keys, 100, ("d020", "j00120")))
    assert "GreaterThanOrEqual(department,d020)" in p.split("PushedFilters")[1] and "TakeOrdered" in p
    # each file holds a range of the keys
    bounds = sorted((r.lo, r.hi) for r in mart.selectExpr("input_file_name() AS f", "department").groupBy("f").agg({"department": "min"}).join(
        mart.selectExpr("input_file_name() AS f", "department").groupBy("f").agg({"department": "max"}), "f").toDF("f", "lo", "hi").collect())
    assert len(bounds) > 1 and all(a[1] <= b[0] for a, b in zip(bounds, bounds[1:]))
    assert serving.page(mart.limit(0), keys, 5).count() == 0 and serving.last_keys(mart.limit(0), keys) is None
