"""Full refresh from CSV files: raw -> staging/quarantine -> gate -> marts."""

import os

import pytest
from pyspark.sql import functions as F

from tiermill import schemas
from tiermill.operators import quality, snapshots
from tiermill.plans import refresh, serving
from tiermill.sources import readers
from test_staging_marts import DEPARTMENTS, EMPLOYEES, JOBS


def write_csvs(root, employees=EMPLOYEES):
    def fmt(v):
        return "" if v is None else (f'"{v}"' if isinstance(v, str) else str(v))
    tables = {"employees": ("id,name,datetime,department_id,job_id", employees),
              "departments": ("id,department", DEPARTMENTS), "jobs": ("id,job", JOBS)}
    for name, (header, rows) in tables.items():
        os.makedirs(os.path.join(root, name))
        half = len(rows) // 2 or 1
        for i, part in enumerate([rows[:half], rows[half:]]):
            with open(os.path.join(root, name, f"part{i}.csv"), "w") as f:
                f.write(header + "\n" + "".join(",".join(fmt(v) for v in r) + "\n" for r in part))


def test_refresh_from_csv(spark, root):
    write_csvs(os.path.join(root, "csv"))
    raw = readers.read_csv_layer(spark, os.path.join(root, "csv"))
    out = refresh.refresh(spark, raw, os.path.join(root, "lake"), 2021, as_of="2024-01-01 00:00:00")
    rows = {k: v["rows"] for k, v in out["commits"].items() if isinstance(v, dict)}
    assert rows["raw/employees"] == 15 and rows["staging/employees"] == 9
    assert rows["quarantine/employees"] == 7 and rows["marts/quarterly_hires"] == 4
    assert rows["marts/dept_performance"] == 1
    t = refresh.tables(spark, os.path.join(root, "lake"))
    per_layer = {}
    for name in t:
        per_layer[name.split("/")[0]] = per_layer.get(name.split("/")[0], 0) + 1
    assert per_layer == {"raw": 3, "staging": 3, "marts": 2, "quarantine": 1}
    first = serving.quarterly_hires(t["marts/quarterly_hires"].read()).first()
    assert (first.department, first.job, first.total_hires) == ("Legal", "Clerk", 2)
    counts = {r.table: r.rows for r in refresh.table_counts(spark, os.path.join(root, "lake")).collect()}
    assert counts["staging/employees"] == 9
    exported = spark.read.json(out["commits"]["dlq/quarantine"])
    assert exported.count() == 7 and "quarantine_at" in exported.columns


def test_gate_blocks_marts(spark, root):
    write_csvs(os.path.join(root, "csv"), EMPLOYEES + [EMPLOYEES[0]])  # duplicate id 1
    raw = readers.read_csv_layer(spark, os.path.join(root, "csv"))
    lake = os.path.join(root, "lake")
    with pytest.raises(quality.QualityGateError, match="unique_id=1"):
        refresh.refresh(spark, raw, lake, 2021, catalog_prefix="hrblocked")
    assert not spark.catalog.databaseExists("hrblocked_staging")  # no name moves before the gate
    t = refresh.tables(spark, lake)
    assert t["staging/employees"].current() is not None
    assert t["marts/quarterly_hires"].current() is None  # nothing published


def test_layers_published_to_the_catalog(spark, root):
    write_csvs(os.path.join(root, "csv"))
    raw = readers.read_csv_layer(spark, os.path.join(root, "csv"))
    lake = os.path.join(root, "lake")
    refresh.refresh(spark, raw, lake, 2021, catalog_prefix="hrtest")
    assert spark.table("hrtest_staging.employees").count() == 9
    got = spark.sql("SELECT department, total_hires FROM hrtest_marts.quarterly_hires "
                    "WHERE job = 'Clerk' ORDER BY department").collect()
    assert [(r.department, r.total_hires) for r in got] == [("Legal", 2), ("Sales", 3)]
    # a second refresh moves the names to the new versions
    refresh.refresh(spark, raw, lake, 2021, catalog_prefix="hrtest")
    assert spark.table("hrtest_staging.employees").count() == 9
    t = refresh.tables(spark, lake)
    assert len(t["staging/employees"].versions()) == 2
    assert spark.table("hrtest_staging.employees").filter("hire_year = 2021").count() == 8


def test_refresh_over_an_appended_raw_table(spark, root):
    write_csvs(os.path.join(root, "csv"))
    raw = readers.read_csv_layer(spark, os.path.join(root, "csv"))
    lake = os.path.join(root, "lake")
    t = refresh.tables(spark, lake)
    for name, df in raw.items():
        snapshots.overwrite(t[f"raw/{name}"], df)
    more = spark.createDataFrame([(900, "New", "2021-06-01T00:00:00Z", 1, 1.0)], schemas.RAW_EMPLOYEES)
    snapshots.append(t["raw/employees"], more, schemas.RAW_EMPLOYEES)
    refresh.refresh(spark, {}, lake, 2021, catalog_prefix="hrappend")
    assert spark.table("hrappend_raw.employees").count() == 16
    assert spark.table("hrappend_staging.employees").filter("id = 900").count() == 1
