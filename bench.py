"""Benchmark of the headline queries.

Runs each query over ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints one JSON line.  Every query is forced to
evaluate all of its columns through the ``noop`` sink (no driver collect).

Numbers are *warm*: every query first runs once on the smallest data set
next to ``$BENCH_SF_DIR`` (``sf0.001``), so JIT and code generation are not
timed.  ``BENCH_WARMUP=0`` gives cold numbers.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tiermill import session  # noqa: E402
from tiermill.plans.catalog import QUERIES  # noqa: E402

HEADLINE = [
    "staging_employees",      # raw -> staging
    "quarantine_employees",   # raw -> quarantine
    "quarterly_hires",        # mart 1, one-pass conditional counts
    "quarterly_two_level",    # mart 1 in its literal two-level shape
    "dept_performance",       # mart 2, mean as a scalar subquery
    "staging_checks",         # publication gate checks
    "backup_restore",         # snapshot export + import
    "upsert_by_id",
    "stream_ingest",          # availableNow stream = batch ingest
]


def stored_layer_queries(spark, sf_dir: str) -> dict[str, float]:
    """The refresh (all layers written, gate, marts, export), then the marts
    and the serving reads over the *stored* layers -- the shape in which the
    published mart timings were taken (queries over a materialized staging
    table)."""
    from tiermill.operators import marts
    from tiermill.plans import refresh, serving
    from tiermill.plans.catalog import YEAR, run_root
    from tiermill.sources import feed

    times = {}
    root = run_root(spark)
    t0 = time.perf_counter()
    refresh.refresh(spark, feed.raw_layer(spark, sf_dir), root, YEAR)
    times["full_refresh"] = time.perf_counter() - t0
    t = refresh.tables(spark, root)
    jobs = {
        "stored_quarterly_hires": lambda: marts.quarterly_hires(
            t["staging/employees"].read(), t["staging/departments"].read(),
            t["staging/jobs"].read(), YEAR),
        "stored_dept_performance": lambda: marts.dept_performance(
            t["staging/employees"].read(), t["staging/departments"].read(), YEAR),
        "serve_quarterly": lambda: serving.quarterly_hires(t["marts/quarterly_hires"].read()),
        "serve_dept_performance": lambda: serving.dept_performance(
            t["marts/dept_performance"].read()),
    }
    for name, build in jobs.items():
        t0 = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        times[name] = time.perf_counter() - t0
    return times


def ingest_queries(spark, sf_dir: str) -> dict[str, float]:
    """Record-batch validation over request files, as an ingest finds them; writing
    the files is not timed."""
    from tiermill.operators import ingest
    from tiermill.plans.catalog import run_root
    from tiermill.sources import feed
    from tiermill.streaming.ingest_stream import write_lines

    times = {}
    path = write_lines(feed.request_lines(spark, sf_dir), run_root(spark) + "/incoming", files=spark.sparkContext.defaultParallelism)
    for name, result in (("ingest_summary", ingest.summary), ("ingest_rejected", ingest.rejected_records)):
        t0 = time.perf_counter()
        result(ingest.evaluate(ingest.read_requests(spark.read.text(path)))).write.format("noop").mode("overwrite").save()
        times[name] = time.perf_counter() - t0
    return times


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:] or HEADLINE
    extra = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")}
    spark = session.build(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2, extra=extra)
    session.checkpoint_dir(spark)  # the configured shared folder; a scratch one only if unset
    warm_dir = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if os.environ.get("BENCH_WARMUP", "1") != "0" and os.path.isdir(warm_dir):
        for name in only:
            QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
        if not sys.argv[1:]:
            stored_layer_queries(spark, warm_dir)
            ingest_queries(spark, warm_dir)
    else:
        QUERIES["quarterly_hires"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in only:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = time.perf_counter() - t0
    if not sys.argv[1:]:
        times.update(stored_layer_queries(spark, sf_dir))
        times.update(ingest_queries(spark, sf_dir))
    times = {k: round(v, 3) for k, v in times.items()}
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
