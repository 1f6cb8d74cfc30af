"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame
built over the whole driver tables (raw layer derived by
:mod:`tiermill.sources.feed`).  Audit stamps are left out of the results,
they are the only non-deterministic columns."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.text import in_year, parse_canonical
from ..operators import dlq, ingest, key_filter, marts, quality, snapshots, staging
from ..session import ensure_conventions, scratch_path
from ..sources import feed, lattice, readers, writers
from ..sources.readers import testdata
from ..streaming import ingest_stream
from . import refresh as refresh_plan, serving

YEAR = feed.FEED_YEAR
STAGING_COLUMNS = ["id", "name", "datetime", "department_id", "job_id"]
QUARANTINE_COLUMNS = ["id", "name", "original_datetime_string", "department_id",
                      "job_id", "rejection_reason"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(fn):
    QUERIES[fn.__name__.removeprefix("q_")] = fn
    return fn


class Layers:
    """raw / staging / quarantine / dimension frames over ``sf_dir``, built
    on first use (each frame costs plan analysis on the driver)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        ensure_conventions(spark)
        self.spark, self.sf_dir, self._frames = spark, sf_dir, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = getattr(self, "_" + name)()
        return self._frames[name]

    def _raw(self):
        return feed.raw_employees(self.spark, self.sf_dir)

    def _staging(self):
        return staging.staging_employees(self["raw"])

    def _quarantine(self):
        return staging.quarantine_employees(self["raw"])

    def _departments(self):
        return staging.staging_dimension(feed.raw_departments(self.spark, self.sf_dir), "department")

    def _jobs(self):
        return staging.staging_dimension(feed.raw_jobs(self.spark, self.sf_dir), "job")


def layers(spark: SparkSession, sf_dir: str) -> Layers:
    return Layers(spark, sf_dir)


@register
def q_staging_employees(spark, sf_dir):
    return layers(spark, sf_dir)["staging"].select(*STAGING_COLUMNS)


@register
def q_quarterly_hires(spark, sf_dir):
    L = layers(spark, sf_dir)
    return marts.quarterly_hires(L["staging"], L["departments"], L["jobs"], YEAR)


@register
def q_quarterly_two_level(spark, sf_dir):
    L = layers(spark, sf_dir)
    return marts.quarterly_hires_two_level(L["staging"], L["departments"], L["jobs"], YEAR)


@register
def q_dept_performance(spark, sf_dir):
    L = layers(spark, sf_dir)
    return marts.dept_performance(L["staging"], L["departments"], YEAR)


@register
def q_quarantine_employees(spark, sf_dir):
    return layers(spark, sf_dir)["quarantine"].select(*QUARANTINE_COLUMNS)


# -- audits and quality checks ----------------------------------------------


@register
def q_rejections_by_reason(spark, sf_dir):
    return quality.rejections_by_reason(layers(spark, sf_dir)["quarantine"])


@register
def q_rejected_audit(spark, sf_dir):
    return quality.rejected_audit(layers(spark, sf_dir)["quarantine"])


@register
def q_layer_counts(spark, sf_dir):
    return quality.layer_counts(layers(spark, sf_dir)["raw"])


@register
def q_split_counts(spark, sf_dir):
    return quality.split_counts(layers(spark, sf_dir)["raw"])


@register
def q_quality_pct(spark, sf_dir):
    L = layers(spark, sf_dir)
    return quality.quality_pct(L["raw"], L["staging"])


@register
def q_not_null_checks(spark, sf_dir):
    return quality.not_null_checks(layers(spark, sf_dir)["staging"],
                                   ["id", "department_id", "job_id"])


@register
def q_unique_check(spark, sf_dir):
    return quality.unique_check(layers(spark, sf_dir)["staging"], ["id"])


@register
def q_duplicate_lineitem_keys(spark, sf_dir):
    return quality.duplicate_keys(testdata(spark, sf_dir, "lineitem"),
                                  ["l_orderkey", "l_linenumber"])


@register
def q_orphan_departments(spark, sf_dir):
    L = layers(spark, sf_dir)
    return quality.orphan_count(L["staging"], "department_id", L["departments"])


@register
def q_orphan_jobs(spark, sf_dir):
    L = layers(spark, sf_dir)
    return quality.orphan_count(L["staging"], "job_id", L["jobs"])


@register
def q_staging_checks(spark, sf_dir):
    L = layers(spark, sf_dir)
    return quality.staging_checks(L["staging"], L["departments"], L["jobs"])


# -- record-batch ingest -----------------------------------------------------


def requests(spark, sf_dir):
    ensure_conventions(spark)
    return ingest.read_requests(feed.request_lines(spark, sf_dir))


def evaluated_feed(spark, sf_dir):
    return ingest.evaluate(requests(spark, sf_dir))


@register
def q_batch_guard(spark, sf_dir):
    return ingest.batch_verdicts(requests(spark, sf_dir))


@register
def q_unknown_table_guard(spark, sf_dir):
    return q_batch_guard(spark, sf_dir).filter("NOT accepted").drop("accepted")


@register
def q_ingest_valid(spark, sf_dir):
    return ingest.valid_records(evaluated_feed(spark, sf_dir), "employees")


@register
def q_ingest_rejected(spark, sf_dir):
    return ingest.rejected_records(evaluated_feed(spark, sf_dir)).drop("request")


@register
def q_dlq_all_rejects(spark, sf_dir):
    """Every record that was not stored, those of rejected requests included,
    as the dead-letter sink holds them."""
    path = dlq.write_rejects(ingest.all_rejects(evaluated_feed(spark, sf_dir)), run_root(spark), "r0", as_of=AS_OF)
    return readers.read_table(spark, path, fmt="json", schema=DLQ_LINE).select(*[f.name for f in DLQ_LINE.fields])


@register
def q_ingest_summary(spark, sf_dir):
    return ingest.summary(evaluated_feed(spark, sf_dir)).drop("request")


# -- sinks, dead-letter queue, snapshots ---------------------------------------

AS_OF = "2024-01-01 00:00:00"
AS_OF_LATER = "2024-01-02 00:00:00"
DELETE_ABOVE_ID = 4540
DELETE_IDS = (100, 120)
RAW_COLUMNS = [f.name for f in schemas.RAW_EMPLOYEES.fields]
DLQ_LINE = T.StructType([T.StructField("table", T.StringType()), T.StructField("batch_id", T.StringType()),
                         *schemas.REJECTED_RECORD.fields])


def run_root(spark) -> str:
    """A fresh folder for one run of a writing query, under the shared
    checkpoint folder of the session."""
    return scratch_path(spark, "runs", uuid.uuid4().hex)


@register
def q_csv_roundtrip(spark, sf_dir):
    raw = layers(spark, sf_dir)["raw"]
    path = writers.write_csv(raw, run_root(spark) + "/raw/employees")
    return readers.read_csv(spark, path + "/*.csv", "employees")


@register
def q_csv_inferred_types(spark, sf_dir):
    raw = layers(spark, sf_dir)["raw"]
    path = writers.write_csv(raw, run_root(spark) + "/raw/employees")
    return readers.read_csv(spark, path, infer=True)


@register
def q_json_append(spark, sf_dir):
    """Valid records appended twice: an append is not idempotent."""
    valid = q_ingest_valid(spark, sf_dir).select(*[f.name for f in schemas.DECLARED_EMPLOYEES])
    path = run_root(spark) + "/raw/employees"
    writers.write_json(valid, path, mode="append")
    writers.write_json(valid, path, mode="append")
    return readers.read_json_records(spark, path, schemas.DECLARED_EMPLOYEES, strict=True)


@register
def q_dlq_roundtrip(spark, sf_dir):
    rejected = q_ingest_rejected(spark, sf_dir)
    path = dlq.write_rejects(rejected, run_root(spark), "r0", as_of=AS_OF)
    return readers.read_table(spark, path, fmt="json", schema=DLQ_LINE).select(*[f.name for f in DLQ_LINE.fields])


@register
def q_dlq_envelope(spark, sf_dir):
    return dlq.envelopes(ingest.rejected_records(evaluated_feed(spark, sf_dir)), as_of=AS_OF)


@register
def q_quarantine_export(spark, sf_dir):
    ensure_conventions(spark)
    raw = feed.raw_employees(spark, sf_dir)
    path = dlq.write_quarantine_export(staging.quarantine_employees(raw, as_of=AS_OF),
                                       run_root(spark), as_of=AS_OF)
    return readers.read_table(spark, path, fmt="json", schema=dlq.EXPORT)


def _raw_table(spark, sf_dir, key=None):
    table = snapshots.StoredTable(spark, run_root(spark), "employees", key=key)
    snapshots.overwrite(table, layers(spark, sf_dir)["raw"])
    return table


@register
def q_backup_restore(spark, sf_dir):
    """backup -> delete -> restore gives the table back."""
    table = _raw_table(spark, sf_dir)
    root = os.path.dirname(os.path.dirname(table.location))
    snapshots.backup(table.read(), root, "employees", as_of=AS_OF)
    snapshots.delete_where(table, F.col("id") > DELETE_ABOVE_ID)
    snapshots.restore(table, root, schema=schemas.RAW_EMPLOYEES)
    return table.read()


@register
def q_latest_snapshot(spark, sf_dir):
    L = layers(spark, sf_dir)
    root = run_root(spark)
    for as_of in (AS_OF, AS_OF_LATER):
        snapshots.backup(L["raw"], root, "employees", as_of=as_of)
    snapshots.backup(L["departments"], root, "departments", as_of=AS_OF)
    return snapshots.latest_snapshots(snapshots.manifest(spark, root)).select("table", "ts", "rows")


@register
def q_delete_rows(spark, sf_dir):
    table = _raw_table(spark, sf_dir)
    snapshots.delete_where(table, F.col("id") > DELETE_ABOVE_ID)
    return table.read()


@register
def q_truncate_table(spark, sf_dir):
    """Operation and rows of the first and of the second version: all of them, then none."""
    table = _raw_table(spark, sf_dir)
    snapshots.truncate(table)
    counts = [spark.read.schema(schemas.RAW_EMPLOYEES).parquet(p).agg(F.count(F.lit(1)).alias("rows"))
              .select(F.lit(k).cast("bigint").alias("version"), F.lit(operation).alias("operation"), "rows")
              for k, (operation, p) in enumerate(table.history())]
    return counts[0].unionByName(counts[1])


@register
def q_delete_by_key(spark, sf_dir):
    """Rows of some ids deleted from a table kept by id: only the partitions of
    those ids are written again."""
    table = _raw_table(spark, sf_dir, key="id")
    snapshots.delete_where(table, F.col("id").between(*DELETE_IDS))
    return table.read()


@register
def q_upsert_by_id(spark, sf_dir):
    """Valid ingest records upserted into the raw table by id."""
    table = _raw_table(spark, sf_dir, key="id")
    batch = q_ingest_valid(spark, sf_dir).withColumn("job_id", F.col("job_id").cast("double"))
    snapshots.upsert(table, batch, ["batch_id", "index"])
    return table.read()


@register
def q_upsert_twice(spark, sf_dir):
    """The same batch upserted twice, rows with a null key included: the second
    time changes nothing."""
    table = _raw_table(spark, sf_dir, key="id")
    batch = q_ingest_valid(spark, sf_dir).withColumn("job_id", F.col("job_id").cast("double"))
    nameless = layers(spark, sf_dir)["raw"].filter(F.col("id").isNull()).select(
        "*", F.lit("nameless").alias("batch_id"), F.lit(0).cast("bigint").alias("index"))
    # evaluated and stored once, as a batch that arrives is
    stored = spark.read.parquet(writers.write_table(batch.unionByName(nameless), run_root(spark) + "/batch"))
    for _ in range(2):
        snapshots.upsert(table, stored, ["batch_id", "index"])
    return table.read()


@register
def q_ingest_to_mart(spark, sf_dir):
    """Requests -> valid records appended to the raw table -> staging -> the
    quarterly mart over all raw rows, stored and ingested."""
    root = run_root(spark)
    t = refresh_plan.tables(spark, root)
    for name, df in feed.raw_layer(spark, sf_dir).items():
        snapshots.overwrite(t[f"raw/{name}"], df)
    for name in schemas.TABLES:
        stored, want = t[f"raw/{name}"], schemas.RAW[name]
        valid = ingest.valid_records(evaluated_feed(spark, sf_dir), name).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in want.fields])
        # ids that the raw layer does not have yet
        snapshots.append(stored, valid.join(stored.read().select("id"), "id", "left_anti").select(*want.names), want)
    refresh_plan.refresh(spark, {}, root, YEAR)
    return serving.quarterly_hires(t["marts/quarterly_hires"].read())


@register
def q_row_counts(spark, sf_dir):
    """Row counts of the stored raw tables."""
    root, parts = run_root(spark), []
    for name, df in feed.raw_layer(spark, sf_dir).items():
        t = snapshots.StoredTable(spark, root, name)
        snapshots.overwrite(t, df)
        parts.append(t.read().agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# -- serving, streaming ingest, full refresh --------------------------------------


def _published(spark, sf_dir):
    root = run_root(spark)
    refresh_plan.refresh(spark, feed.raw_layer(spark, sf_dir), root, YEAR)
    return root, refresh_plan.tables(spark, root)


@register
def q_serve_quarterly(spark, sf_dir):
    _, t = _published(spark, sf_dir)
    return serving.quarterly_hires(t["marts/quarterly_hires"].read())


@register
def q_serve_dept_performance(spark, sf_dir):
    _, t = _published(spark, sf_dir)
    return serving.dept_performance(t["marts/dept_performance"].read())


@register
def q_preview_top5(spark, sf_dir):
    L = layers(spark, sf_dir)
    mart = marts.quarterly_hires(L["staging"], L["departments"], L["jobs"], YEAR)
    return serving.preview(serving.quarterly_hires(mart), 5)


@register
def q_full_refresh(spark, sf_dir):
    root, _ = _published(spark, sf_dir)
    return refresh_plan.table_counts(spark, root)


@register
def q_gate_blocked(spark, sf_dir):
    """A refresh over raw rows of which some ids stand twice: the gate raises;
    the check rows, and how many mart versions there are (none)."""
    raw = feed.raw_layer(spark, sf_dir)
    raw["employees"] = raw["employees"].unionByName(raw["employees"].filter(F.col("id") % 100 == 1))
    root = run_root(spark)
    try:
        refresh_plan.refresh(spark, raw, root, YEAR)
        rows = []
    except quality.QualityGateError as exc:
        rows = exc.rows
    marts_made = sum(t.current() is not None for n, t in refresh_plan.tables(spark, root).items() if n.startswith("marts/"))
    return spark.createDataFrame(rows, "check string, failures long, blocking boolean, passed boolean").withColumn(
        "mart_versions", F.lit(marts_made).cast("bigint"))


@register
def q_layer_by_name(spark, sf_dir):
    """The staging layer of a refresh, read by its catalog name."""
    prefix = "run_" + uuid.uuid4().hex[:12]
    refresh_plan.refresh(spark, feed.raw_layer(spark, sf_dir), run_root(spark), YEAR, catalog_prefix=prefix)
    return readers.read_table(spark, schemas.table_name("staging", "employees", prefix)).select(*STAGING_COLUMNS)


@register
def q_staging_hired_at(spark, sf_dir):
    """The hire time read back, strictly, from the canonical text."""
    return layers(spark, sf_dir)["staging"].select("id", parse_canonical("datetime").alias("hired_at"))


@register
def q_stream_ingest(spark, sf_dir):
    """availableNow stream over request files = the batch ingest."""
    ensure_conventions(spark)
    root = run_root(spark)
    source = ingest_stream.write_lines(feed.request_lines(spark, sf_dir), root + "/incoming")
    ingest_stream.run_available(spark, source, root + "/out", root + "/_checkpoint")
    return ingest_stream.ingested(spark, root + "/out", "employees").drop("batch")


def _streamed(spark, sf_dir, deliveries: int = 1) -> str:
    """Root of a stream that ingested the request lines, in two runs: those of the
    employees, then the others.  Further deliveries bring all lines again.  The lines
    are made once and stored; each delivery reads them."""
    ensure_conventions(spark)
    root = run_root(spark)
    lines = spark.read.parquet(writers.write_table(feed.request_lines(spark, sf_dir), root + "/lines"))
    employees = F.coalesce(F.col("value").startswith('{"table":"employees"'), F.lit(False))
    files = [lines.filter(employees), lines.filter(~employees), *[lines] * (deliveries - 1)]
    for k, part in enumerate(files):
        ingest_stream.write_lines(part, f"{root}/incoming/part={k}")
        ingest_stream.run_available(spark, f"{root}/incoming", f"{root}/out", f"{root}/_checkpoint")
        ingest_stream.total_available(spark, f"{root}/out", f"{root}/_totals")
    return root + "/out"


@register
def q_stream_replayed_requests(spark, sf_dir):
    """All request files delivered twice: every valid record is stored once."""
    return ingest_stream.ingested(spark, _streamed(spark, sf_dir, deliveries=2), "employees").drop("batch")


@register
def q_stream_verdicts(spark, sf_dir):
    """The requests that the stream rejected, in whatever micro-batch."""
    return spark.read.parquet(_streamed(spark, sf_dir) + "/rejected_requests").select("table", "batch_id", "n_records", "error")


@register
def q_stream_summary(spark, sf_dir):
    """Totals of each batch id over all its requests, kept up by a stateful aggregate."""
    return ingest_stream.totals(spark, _streamed(spark, sf_dir, deliveries=2))


@register
def q_stream_to_mart(spark, sf_dir):
    """Departments, jobs and employees that came as requests only -> staging -> mart."""
    out = _streamed(spark, sf_dir)
    root = run_root(spark)
    refresh_plan.refresh(spark, {}, root, YEAR, ingested=out)
    return serving.quarterly_hires(refresh_plan.tables(spark, root)["marts/quarterly_hires"].read())


@register
def q_marts_by_deltas(spark, sf_dir):
    """The quarterly mart after a delete and an append, from stored counts and the
    signed counts of the rows that went and came; the stored fact is not counted again."""
    L, root = layers(spark, sf_dir), run_root(spark)
    counts = snapshots.StoredTable(spark, root, "marts/hire_counts")
    snapshots.overwrite(counts, marts.hire_counts(L["staging"], YEAR))
    gone = L["staging"].filter(F.col("id") > DELETE_ABOVE_ID)
    raw_new = q_ingest_valid(spark, sf_dir).join(L["raw"].select("id"), "id", "left_anti").withColumn("job_id", F.col("job_id").cast("double"))
    came = staging.staging_employees(raw_new.select(*RAW_COLUMNS))
    snapshots.overwrite(counts, marts.with_deltas(counts.read(), marts.hire_counts(gone, YEAR, sign=-1), marts.hire_counts(came, YEAR)))
    return marts.quarterly_from_counts(counts.read(), L["departments"], L["jobs"])


@register
def q_reconcile_layers(spark, sf_dir):
    """The raw table against a restored copy in which some names were altered, by content."""
    table = _raw_table(spark, sf_dir)
    altered = table.read().withColumn("name", F.when(F.col("id") % 1009 == 7, F.lit("altered")).otherwise(F.col("name")))
    copy = snapshots.StoredTable(spark, run_root(spark), "employees")
    snapshots.overwrite(copy, altered)
    return quality.reconcile(table.read(), copy.read(), "id")


@register
def q_above_mean_subquery(spark, sf_dir):
    """Departments above the mean with an uncorrelated scalar subquery in SQL
    (Spark runs it once; it must equal ``dept_performance``)."""
    L = layers(spark, sf_dir)
    per_key = L["staging"].filter(in_year("hired_at", YEAR)).groupBy("department_id").agg(F.count(F.lit(1)).alias("hired"))
    hires = per_key.join(L["departments"], per_key["department_id"] == F.col("id")).groupBy("id", "department").agg(F.sum("hired").alias("hired"))
    return spark.sql("""
        SELECT id, department, hired, round(mean, 2) AS mean_hired, round(hired - mean, 2) AS diff_from_mean
        FROM (SELECT *, (SELECT sum(hired) / count(hired) FROM {hires}) AS mean FROM {hires})
        WHERE hired > mean""", hires=hires)


@register
def q_batch_size_guard(spark, sf_dir):
    """Size rule of every batch: 1 to 1000 records."""
    sizes = q_batch_guard(spark, sf_dir).select("table", "batch_id", "n_records")
    return sizes.withColumn("size_ok", F.col("n_records").between(1, 1000))


# -- keys by filters, paged serving, type lattice, incremental export -----------------


@register
def q_orphans_by_bloom(spark, sf_dir):
    """Order lines whose order is not in staging, by the keys of all staged employees."""
    lines = testdata(spark, sf_dir, "lineitem").select("l_orderkey")
    return key_filter.orphans_by_bloom(lines, "l_orderkey", layers(spark, sf_dir)["staging"].select("id"))


@register
def q_unique_by_filter(spark, sf_dir):
    """Duplicated ids of the raw table after two appends, of new ids and of ids that
    are stored already, without a second count of what is stored."""
    raw, root = layers(spark, sf_dir)["raw"], run_root(spark)
    table = snapshots.StoredTable(spark, root, "employees", key="id")
    late = F.coalesce(F.col("id") > DELETE_ABOVE_ID, F.lit(False))
    snapshots.overwrite(table, raw.filter(~late))
    keys = key_filter.UniqueKeys(table, root)
    keys.build()
    keys.append(raw.filter(late))
    keys.append(raw.filter(F.col("id") % 1009 == 7))
    return keys.duplicates()


PAGE_ROWS, PAGES = 100, 3


@register
def q_serve_page(spark, sf_dir):
    """The first pages of the quarterly mart, each after the last keys of the one before."""
    L, keys = layers(spark, sf_dir), ["department", "job"]
    table = snapshots.StoredTable(spark, run_root(spark), "marts/quarterly_hires")
    serving.store_in_order(table, marts.quarterly_hires(L["staging"], L["departments"], L["jobs"], YEAR).select(*serving.QUARTERLY_COLUMNS), keys)
    mart, after, served = table.read(), None, None
    for k in range(PAGES):
        rows = serving.page(mart, keys, PAGE_ROWS, after)
        numbered = rows.withColumn("page", F.lit(k).cast("bigint"))
        served = numbered if served is None else served.unionByName(numbered)
        after = serving.last_keys(rows, keys)
        if after is None:
            break
    return served


@register
def q_csv_type_conflicts(spark, sf_dir):
    """Raw CSV files in 16 folders, one of them with ids in letters and one with
    fractional departments: the types of each folder's columns and of all."""
    k, own = F.col("o_orderkey") % 16, feed.employee_columns()
    text = testdata(spark, sf_dir, "orders").select(k.cast("int").alias("part"), *own).select(
        "part", F.when(F.col("part") == 3, F.concat(F.lit("E"), F.col("id").cast("string"))).otherwise(F.col("id").cast("string")).alias("id"),
        "name", "datetime",
        F.when(F.col("part") == 5, F.concat(F.col("department_id").cast("string"), F.lit(".5"))).otherwise(F.col("department_id").cast("string")).alias("department_id"),
        "job_id")
    path = run_root(spark) + "/raw/employees"
    text.write.option("header", True).partitionBy("part").csv(path)
    columns = RAW_COLUMNS
    stored = spark.read.option("header", True).schema(", ".join(f"{c} string" for c in columns)).csv(path + "/*/*.csv")
    folder = F.regexp_extract(F.input_file_name(), "(part=[0-9]+)", 1)
    return lattice.type_conflicts(lattice.column_kinds(stored, columns, folder))


@register
def q_quarantine_export_runs(spark, sf_dir):
    """Quarantined rows in three loads, of which two have one stamp; two export runs,
    after the first and after the last, hold each row once."""
    raw, root = layers(spark, sf_dir)["raw"], run_root(spark)
    table = snapshots.StoredTable(spark, root, "quarantine/employees")
    third = F.coalesce(F.pmod("department_id", F.lit(3)), F.lit(0))

    def load(k, as_of):
        return staging.quarantine_employees(raw.filter(third == k), as_of=as_of)

    snapshots.overwrite(table, load(0, AS_OF))
    dlq.export_new(table.read(), root)
    snapshots.append(table, load(1, AS_OF))
    snapshots.append(table, load(2, AS_OF_LATER))
    dlq.export_new(table.read(), root)
    return dlq.exported(spark, root)
