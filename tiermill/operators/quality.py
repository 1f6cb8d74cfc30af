"""Data-quality checks and audits.

Every check is one aggregate job; none collects rows to the driver.  Checks
that look at keys (unique, orphans) first reduce the fact to one row per key
with a partial aggregate, so a hot key costs one row per map task and the
join against the dimension runs on distinct keys only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.text import safe_timestamp

# Layer labels of the reconciliation and the quality threshold.
LAYER_LABELS = {"raw": "RAW", "staging": "STAGING", "quarantine": "QUARANTINE"}
QUALITY_THRESHOLD_PCT = 95.0


def not_null_checks(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, failures, should_error): all columns in one scan."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return (counts.unpivot([], columns, "column_name", "failures")
            .withColumn("should_error", F.col("failures") != 0))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values present more than once (rows with a null key excluded)."""
    cond = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return (df.filter(cond).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_records"))
            .filter(F.col("n_records") > 1))


def unique_check(df: DataFrame, keys: list[str]) -> DataFrame:
    """(failures, should_error): number of duplicated key values."""
    return (duplicate_keys(df, keys).agg(F.count(F.lit(1)).alias("failures"))
            .withColumn("should_error", F.col("failures") != 0))


def orphans(fact: DataFrame, fact_key: str, dim: DataFrame, dim_key: str = "id") -> DataFrame:
    """Fact rows whose key has no dimension row, counted per key:
    (key, n_records).  Null keys are orphans, as a LEFT JOIN ... IS NULL
    test counts them."""
    per_key = fact.groupBy(F.col(fact_key).alias("key")).agg(F.count(F.lit(1)).alias("n_records"))
    keys = dim.select(F.col(dim_key).alias("key")).filter(F.col("key").isNotNull())
    return per_key.join(keys, "key", "left_anti")


def orphan_count(fact: DataFrame, fact_key: str, dim: DataFrame, dim_key: str = "id") -> DataFrame:
    return orphans(fact, fact_key, dim, dim_key).agg(
        F.coalesce(F.sum("n_records"), F.lit(0)).cast("bigint").alias("orphans"))


def rejections_by_reason(quarantine: DataFrame) -> DataFrame:
    return quarantine.groupBy("rejection_reason").agg(F.count(F.lit(1)).alias("count"))


def rejected_audit(quarantine: DataFrame) -> DataFrame:
    return quarantine.select("id", "name", "job_id", "rejection_reason")


def split_counts(raw: DataFrame, blank_name_to_staging: bool = True) -> DataFrame:
    """raw, staging, quarantine and overlap counts of one raw layer, in one
    scan (rules evaluated once per row)."""
    ts = safe_timestamp("datetime")
    stg = rules.staging_predicate(ts, blank_name_to_staging)
    qua = rules.quarantine_predicate(ts)
    return raw.agg(
        F.count(F.lit(1)).alias("raw"),
        F.count_if(stg).alias("staging"),
        F.count_if(qua).alias("quarantine"),
        F.count_if(stg & qua).alias("overlap"),
    )


def layer_counts(raw: DataFrame) -> DataFrame:
    """(layer, records): the rows of raw, of its staging and quarantine parts
    and of their overlap, counted in one scan of raw."""
    counts = split_counts(raw)
    labels = {**LAYER_LABELS, "overlap": "OVERLAP"}
    return counts.select(*[F.col(c).alias(label) for c, label in labels.items()]).unpivot([], list(labels.values()), "layer", "records")


def content_marks(df: DataFrame, key: str, ranges: int) -> DataFrame:
    """(range, rows, mark) per range of the key: ``mark`` sums the rows' hashes, so it
    depends on which rows there are and how often, and on no order.  One partial
    aggregate; rows without a key are range -1."""
    hashed = F.xxhash64(*[F.col(c) for c in sorted(df.columns)]).cast("decimal(38,0)")
    place = F.coalesce(F.pmod(F.col(key), F.lit(ranges)), F.lit(-1)).cast("int")
    return df.groupBy(place.alias("range")).agg(F.count(F.lit(1)).alias("rows"), F.sum(hashed).alias("mark"))


def reconcile(left: DataFrame, right: DataFrame, key: str, ranges: int = 64) -> DataFrame:
    """(range, rows_left, rows_right, equal) for every key range of two tables of the
    same columns: a changed row shows although the counts agree."""
    a = content_marks(left, key, ranges).withColumnsRenamed({"rows": "rows_left", "mark": "_a"})
    b = content_marks(right.select(*left.columns), key, ranges).withColumnsRenamed({"rows": "rows_right", "mark": "_b"})
    zero = F.lit(0).cast("bigint")
    return a.join(b, "range", "full").select("range", F.coalesce("rows_left", zero).alias("rows_left"), F.coalesce("rows_right", zero).alias("rows_right"),
                                             (F.col("rows_left").eqNullSafe(F.col("rows_right")) & F.col("_a").eqNullSafe(F.col("_b"))).alias("equal"))


def quality_pct(raw: DataFrame, valid: DataFrame,
                threshold: float = QUALITY_THRESHOLD_PCT) -> DataFrame:
    """(raw, valid, quality_pct, passed): share of raw rows that reached
    staging, null when raw is empty."""
    n_raw = raw.agg(F.count(F.lit(1))).scalar()
    n_valid = valid.agg(F.count(F.lit(1))).scalar()
    pct = F.round(F.try_divide(n_valid * F.lit(100.0), n_raw), 2)
    return (raw.sparkSession.range(1)
            .select(n_raw.alias("raw"), n_valid.alias("valid"), pct.alias("quality_pct"))
            .withColumn("passed", F.col("quality_pct") > F.lit(threshold)))


def staging_checks(staging: DataFrame, departments: DataFrame | None = None,
                   jobs: DataFrame | None = None) -> DataFrame:
    """The publication gate's checks as rows (check, failures, blocking,
    passed): not-null on id/department_id/job_id, unique id, and -- when the
    dimensions are given -- orphan counts, which are reported but do not
    fail the gate.

    The not-null and orphan checks come from one plan: staging is reduced to
    one row per (department_id, job_id) pair, the pairs are matched against
    the distinct dimension keys, and a single aggregate counts everything.
    With the id count for uniqueness, staging is scanned twice in all."""
    pairs = staging.groupBy("department_id", "job_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("id").isNull()).alias("null_ids"))
    orphan_checks = [("orphans_department", "department_id", departments),
                     ("orphans_job", "job_id", jobs)]
    for label, key, dim in orphan_checks:
        if dim is not None:
            known = (dim.select(F.col("id").alias(key)).filter(F.col(key).isNotNull())
                     .distinct().withColumn(f"_{label}", F.lit(True)))
            pairs = pairs.join(known, key, "left")

    def total(c):
        return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")

    counts = {
        "not_null_id": total("null_ids"),
        "not_null_department_id": total(F.when(F.col("department_id").isNull(), F.col("n"))),
        "not_null_job_id": total(F.when(F.col("job_id").isNull(), F.col("n"))),
    }
    for label, _, dim in orphan_checks:
        if dim is not None:
            counts[label] = total(F.when(F.col(f"_{label}").isNull(), F.col("n")))
    per_check = (pairs.agg(*[c.alias(k) for k, c in counts.items()])
                 .unpivot([], list(counts), "check", "failures")
                 .withColumn("blocking", F.col("check").startswith("not_null_")))
    uq = unique_check(staging, ["id"]).select(F.lit("unique_id").alias("check"), "failures",
                                              F.lit(True).alias("blocking"))
    return per_check.unionByName(uq).withColumn(
        "passed", ~F.col("blocking") | (F.col("failures") == 0))


class QualityGateError(RuntimeError):
    """A blocking data-quality check failed; nothing was published.  ``rows``
    are the check rows."""

    def __init__(self, message: str, rows: list[dict]):
        super().__init__(message)
        self.rows = rows


def enforce(checks: DataFrame) -> list[dict]:
    """Evaluate the (few) check rows and raise when a blocking one failed.
    The frame has one row per check, so collecting it is bounded."""
    rows = [r.asDict() for r in checks.collect()]
    failed = [r for r in rows if not r["passed"]]
    if failed:
        raise QualityGateError("quality checks failed: " + ", ".join(
            f"{r['check']}={r['failures']}" for r in failed), rows)
    return rows
