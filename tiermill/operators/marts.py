"""Gold marts: hires per department x job x quarter, and departments hiring
above the mean.

Both aggregate the fact *before* joining the dimensions (eager aggregation):
the fact is reduced to one row per key combination with a map-side partial
aggregate, so only those rows are shuffled and joined.  The join then runs on
a result bounded by |departments| x |jobs| no matter how large the fact is,
and the dimensions need not be small enough to broadcast -- the planner
broadcasts them when their size statistic allows and falls back to a
sort-merge join otherwise.  A hot key costs one partial row per map task.
Grouping after the join is by dimension *names* (two ids with one name
merge), as the mart defines.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import in_year

QUARTERS = (1, 2, 3, 4)


def _in_year_fact(fact: DataFrame, time_col: str, year: int) -> DataFrame:
    """Rows of ``year``; a stored staging table partitioned by ``hire_year``
    is pruned to that one directory as well."""
    cond = in_year(time_col, year)
    if "hire_year" in fact.columns:
        cond = cond & (F.col("hire_year") == year)
    return fact.filter(cond)


COUNTS = [*[f"Q{q}" for q in QUARTERS], "total_hires"]


def hire_counts(fact: DataFrame, year: int, time_col: str = "hired_at", fact_keys: tuple[str, str] = ("department_id", "job_id"), sign: int = 1) -> DataFrame:
    """Hires of ``year`` per (department id, job id): Q1..Q4 and the total.  With
    ``sign`` -1 they are what deleting the rows takes away."""
    quarter = F.quarter(time_col)
    return _in_year_fact(fact, time_col, year).groupBy(*fact_keys).agg(
        *[(F.lit(sign) * F.count_if(quarter == q)).alias(f"Q{q}") for q in QUARTERS], (F.lit(sign) * F.count(F.lit(1))).alias("total_hires"))


def with_deltas(counts: DataFrame, *deltas: DataFrame, fact_keys: tuple[str, str] = ("department_id", "job_id")) -> DataFrame:
    """Stored counts with signed counts merged in: what a recount of the changed fact
    gives, without reading the fact.  An update is the old row taken away and the new one added."""
    every = reduce(DataFrame.unionByName, deltas, counts)
    return every.groupBy(*fact_keys).agg(*[F.sum(c).alias(c) for c in COUNTS]).filter("total_hires != 0")


def quarterly_hires(fact: DataFrame, departments: DataFrame, jobs: DataFrame,
                    year: int, time_col: str = "hired_at",
                    fact_keys: tuple[str, str] = ("department_id", "job_id"),
                    dim_keys: tuple[str, str] = ("id", "id"),
                    names: tuple[str, str] = ("department", "job")) -> DataFrame:
    """Q1..Q4 and total hires per (department, job) in ``year``; one pass of
    conditional counts instead of a pivot (which would add a shuffle)."""
    return quarterly_from_counts(hire_counts(fact, year, time_col, fact_keys), departments, jobs, fact_keys, dim_keys, names)


def quarterly_from_counts(per_ids: DataFrame, departments: DataFrame, jobs: DataFrame, fact_keys: tuple[str, str] = ("department_id", "job_id"),
                          dim_keys: tuple[str, str] = ("id", "id"), names: tuple[str, str] = ("department", "job")) -> DataFrame:
    """The quarterly mart from counts per (department id, job id)."""
    dk, jk = fact_keys
    dep = departments.select(F.col(dim_keys[0]).alias("_dk"), F.col(names[0]).alias("department"))
    job = jobs.select(F.col(dim_keys[1]).alias("_jk"), F.col(names[1]).alias("job"))
    joined = (per_ids.join(dep, per_ids[dk] == dep["_dk"], "inner")
              .join(job, per_ids[jk] == job["_jk"], "inner"))
    return joined.groupBy("department", "job").agg(*[F.sum(c).alias(c) for c in COUNTS])


def quarterly_hires_two_level(fact: DataFrame, departments: DataFrame, jobs: DataFrame,
                              year: int, time_col: str = "hired_at") -> DataFrame:
    """The mart's literal shape: count per (department, job, quarter), then
    ``max(if(quarter = k, hires, 0))`` per (department, job).  Kept as a
    cross-check of :func:`quarterly_hires`."""
    # first level: hires per (department, job, quarter); the fact is reduced
    # to one row per (ids, quarter) before the dimension joins
    per_ids = (_in_year_fact(fact, time_col, year)
               .groupBy("department_id", "job_id", F.quarter(time_col).alias("quarter"))
               .agg(F.count(F.lit(1)).alias("n")))
    per_quarter = (
        per_ids.join(departments.select(F.col("id").alias("_dk"), "department"),
                     per_ids["department_id"] == F.col("_dk"))
        .join(jobs.select(F.col("id").alias("_jk"), "job"), per_ids["job_id"] == F.col("_jk"))
        .groupBy("department", "job", "quarter")
        .agg(F.sum("n").alias("hires"))
    )
    return per_quarter.groupBy("department", "job").agg(
        *[F.coalesce(F.max(F.when(F.col("quarter") == q, F.col("hires")).otherwise(0)), F.lit(0))
          .cast("bigint").alias(f"Q{q}") for q in QUARTERS],
        F.sum("hires").alias("total_hires"),
    )


def department_hires(fact: DataFrame, departments: DataFrame, year: int,
                     time_col: str = "hired_at", fact_key: str = "department_id",
                     dim_key: str = "id", name: str = "department") -> DataFrame:
    """(id, department, hired) for departments with at least one hire."""
    per_id = (_in_year_fact(fact, time_col, year)
              .groupBy(fact_key).agg(F.count(F.lit(1)).alias("_n")))
    dep = departments.select(F.col(dim_key).alias("id"), F.col(name).alias("department"))
    return (per_id.join(dep, per_id[fact_key] == dep["id"], "inner")
            .groupBy("id", "department").agg(F.sum("_n").alias("hired")))


def dept_performance(fact: DataFrame, departments: DataFrame, year: int,
                     time_col: str = "hired_at", fact_key: str = "department_id",
                     dim_key: str = "id", name: str = "department") -> DataFrame:
    """Departments whose hires exceed the mean over the hiring departments.

    The mean is one scalar: it is computed once as an uncorrelated scalar
    subquery and compared unrounded; no join carries it to the rows."""
    hires = department_hires(fact, departments, year, time_col, fact_key, dim_key, name)
    mean = hires.agg(F.avg("hired")).scalar()
    return hires.filter(F.col("hired") > mean).select(
        "id", "department", "hired",
        F.round(mean, 2).alias("mean_hired"),
        F.round(F.col("hired") - mean, 2).alias("diff_from_mean"),
    )
