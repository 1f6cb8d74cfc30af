"""Full refresh: raw -> staging + quarantine -> checks -> marts -> DLQ export.

Each layer table is a :class:`~tiermill.operators.snapshots.StoredTable`
under ``root``; each step reads the previous layer from storage, so every
step starts from a cut lineage and a failed step leaves the published
versions untouched.  The blocking checks run on staging *before* the marts
are published.  Tables of one step do not depend on each other and are
written by concurrent jobs, so small dimension writes overlap the large ones.
Raw tables that are stored already (by an ingest that appends to them) are taken
as they are: ``raw`` names only those to replace.  The valid records of a request stream
(``ingested``) are part of the raw layer.
"""

from __future__ import annotations

import os
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import dlq, marts, quality, staging
from ..operators.snapshots import StoredTable, overwrite
from ..session import ensure_conventions

DIMENSIONS = {"departments": "department", "jobs": "job"}


def tables(spark: SparkSession, root: str) -> dict[str, StoredTable]:
    names = ["raw/employees", "raw/departments", "raw/jobs",
             "staging/employees", "staging/departments", "staging/jobs",
             "quarantine/employees", "marts/quarterly_hires", "marts/dept_performance"]
    # staging is partitioned by hire year: the marts read one year, so the
    # scan is pruned to one directory.
    partitioning = {"staging/employees": ["hire_year"]}
    return {n: StoredTable(spark, root, n, partition_by=partitioning.get(n)) for n in names}


def publish(spark: SparkSession, name: str, table: StoredTable, prefix: str = "tiermill") -> str:
    """Point the catalog table ``<prefix>_<layer>.<table>`` at the current
    version of ``table`` (an external table whose location moves with each
    version), so the layers can be read by name and from SQL."""
    layer, short = name.split("/", 1)
    fq, path = schemas.table_name(layer, short, prefix), table.current()
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schemas.schema_name(layer, prefix=prefix)}")
    if spark.catalog.tableExists(fq):
        spark.sql(f"ALTER TABLE {fq} SET LOCATION '{path}'")
        spark.catalog.refreshTable(fq)
    else:
        spark.sql(f"CREATE TABLE {fq} USING {table.fmt} LOCATION '{path}'")
    if table.partition_by:
        spark.sql(f"MSCK REPAIR TABLE {fq}")
    return fq


def raw_rows(spark: SparkSession, table: StoredTable, name: str, ingested: str | None) -> DataFrame:
    """The raw layer's rows of a table: those stored, and those of a request stream."""
    want = schemas.RAW[name]
    parts = [table.read()] if ingested is None or table.current() else []
    if ingested is not None:
        new = spark.read.parquet(os.path.join(ingested, "raw", name))
        parts.append(new.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in want.fields]))
    return reduce(DataFrame.unionByName, parts)


def refresh(spark: SparkSession, raw: dict[str, DataFrame], root: str, year: int,
            as_of: str | None = None, gate: bool = True,
            blank_name_to_staging: bool = True, catalog_prefix: str | None = None, ingested: str | None = None) -> dict:
    """Run the whole refresh; returns path and rows of every table written and
    the check rows.  Raises QualityGateError (no mart version, no name moved)
    when a blocking check fails and ``gate`` is on.  With ``catalog_prefix``
    every table is published to the session catalog at the end."""
    ensure_conventions(spark)
    t = tables(spark, root)
    out = {}

    def step(writes: dict) -> None:
        """Commit independent tables concurrently (one Spark job each)."""
        with ThreadPoolExecutor(max_workers=len(writes)) as pool:
            futures = {name: pool.submit(overwrite, t[name], df) for name, df in writes.items()}
            out.update({name: f.result() for name, f in futures.items()})

    writes = {f"raw/{name}": df for name, df in raw.items()}
    if writes:
        step(writes)

    raw_emp = raw_rows(spark, t["raw/employees"], "employees", ingested)
    step({
        "staging/employees": staging.staging_employees(raw_emp, as_of, blank_name_to_staging)
                             .withColumn("hire_year", F.year("hired_at")),
        "quarantine/employees": staging.quarantine_employees(raw_emp, as_of),
        **{f"staging/{name}": staging.staging_dimension(raw_rows(spark, t[f"raw/{name}"], name, ingested), col)
           for name, col in DIMENSIONS.items()},
    })

    stg, deps, jobs = (t["staging/employees"].read(), t["staging/departments"].read(),
                       t["staging/jobs"].read())
    checks = quality.staging_checks(stg, deps, jobs)
    check_rows = quality.enforce(checks) if gate else [r.asDict() for r in checks.collect()]

    step({"marts/quarterly_hires": marts.quarterly_hires(stg, deps, jobs, year),
          "marts/dept_performance": marts.dept_performance(stg, deps, year)})
    out["dlq/quarantine"] = dlq.write_quarantine_export(
        t["quarantine/employees"].read(), root, as_of)
    if catalog_prefix:
        for name in [n for n, table in t.items() if table.current()]:
            publish(spark, name, t[name], catalog_prefix)
    return {"commits": out, "checks": check_rows}


def table_counts(spark: SparkSession, root: str) -> DataFrame:
    """(table, rows) of every layer table."""
    parts = [t.read().agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows") for name, t in tables(spark, root).items()]
    return reduce(DataFrame.unionByName, parts)
