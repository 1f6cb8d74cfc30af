"""Request-file ingest as a Structured Streaming query.

New files of request lines under ``source`` are read as a stream.  A request is
one line and is known by the line's digest: a state store keeps the digests
of the last ``REPLAY_WINDOW``, so a file that is delivered again, in the same micro-batch
or in a later one, adds nothing.  All other rules are rules of a line.  So the
outputs do not depend on how the trigger groups files.

Each micro-batch is evaluated once and written to
``<root>/evaluated``; the dead letters are written from there first, then valid
records per table, the summary and the verdicts, by concurrent jobs.  Every
output directory is keyed by the micro-batch id and written with overwrite, so a
replayed micro-batch (after a failure between the sink write and the checkpoint
commit) rewrites the same files: exactly-once output on top of the at-least-once
``foreachBatch``.  ``<root>/raw`` is part of the raw layer (plans/refresh.py reads it).

The totals of each batch id over all its requests are a second stream, over the
summaries: a stateful aggregate in update mode.
"""

from __future__ import annotations

import os
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules
from ..operators import dlq, ingest
from ..sources.writers import write_table

# Files of a micro-batch, unless a bound in bytes is given; either only sets how
# much is evaluated at a time.
MAX_FILES_PER_TRIGGER = 1000
# How long a request is remembered, from its arrival.
REPLAY_WINDOW = "7 days"
SUMMARY = "request string, table string, batch_id string, inserted long, rejected long, batch string"


def write_lines(lines: DataFrame, path: str, files: int | None = None) -> str:
    """Write request lines (column ``value``) as text files."""
    (lines.repartition(files) if files else lines).write.mode("overwrite").text(path)
    return path


def first_deliveries(lines: DataFrame, window: str = REPLAY_WINDOW) -> DataFrame:
    """The lines of a stream whose request did not arrive within ``window`` before.
    The event time is the arrival, so no line is ever late and dropped for it."""
    return (lines.select("value", F.md5("value").alias("request"), F.current_timestamp().alias("arrived"))
            .withWatermark("arrived", window).dropDuplicatesWithinWatermark(["request"]).select("value"))


def part_of(batch_id: int) -> str:
    return f"batch={batch_id:010d}"


def process_batch(root: str, as_of: str | None = None):
    def run(batch: DataFrame, batch_id: int) -> None:
        def to(name: str, df: DataFrame) -> str:
            return write_table(df, os.path.join(root, name, part_of(batch_id)))

        spark = batch.sparkSession
        evaluated = spark.read.parquet(to("evaluated", ingest.evaluate(ingest.read_requests(batch.select("value")))))
        dlq.write_rejects(ingest.all_rejects(evaluated), root, f"{batch_id:010d}", as_of)
        outputs = {f"raw/{t}": ingest.valid_records(evaluated, t) for t in rules.MODELS}
        outputs["ingest_summary"] = ingest.summary(evaluated)
        outputs["rejected_requests"] = ingest.rejected_requests(evaluated)
        with ThreadPoolExecutor(max_workers=len(outputs)) as pool:
            for done in [pool.submit(to, name, df) for name, df in outputs.items()]:
                done.result()
    return run


def _finish(writer, checkpoint: str):
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def run_available(spark: SparkSession, source: str, root: str, checkpoint: str,
                  max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER,
                  max_bytes_per_trigger: int | None = None, as_of: str | None = None):
    """Ingest every request file present now, then stop (availableNow), in
    micro-batches bounded by files or, if given, by bytes (Spark takes one of
    the two bounds)."""
    limit = ({"maxBytesPerTrigger": max_bytes_per_trigger} if max_bytes_per_trigger
             else {"maxFilesPerTrigger": max_files_per_trigger})
    lines = first_deliveries(spark.readStream.options(**limit).text(source))
    return _finish(lines.writeStream.foreachBatch(process_batch(root, as_of)), checkpoint)


def ingested(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Valid records of ``table`` written by all micro-batches so far."""
    return spark.read.parquet(os.path.join(root, "raw", table))


def total_available(spark: SparkSession, root: str, checkpoint: str):
    """Bring the totals up to the summaries written so far.  In update mode a
    micro-batch emits only the totals that it changed; they are written under its id."""
    def run(batch: DataFrame, batch_id: int) -> None:
        write_table(batch, os.path.join(root, "ingest_totals", part_of(batch_id)))

    summaries = spark.readStream.schema(SUMMARY).parquet(os.path.join(root, "ingest_summary"))
    totals = summaries.groupBy(*ingest.BATCH_KEY).agg(F.count(F.lit(1)).alias("requests"), F.sum("inserted").alias("inserted"), F.sum("rejected").alias("rejected"))
    return _finish(totals.writeStream.outputMode("update").foreachBatch(run), checkpoint)


def totals(spark: SparkSession, root: str) -> DataFrame:
    """(table, batch_id, requests, inserted, rejected): the last total of each batch id."""
    kept = spark.read.parquet(os.path.join(root, "ingest_totals"))
    values = ["requests", "inserted", "rejected"]
    return kept.groupBy(*ingest.BATCH_KEY).agg(F.max_by(F.struct(*values), "batch").alias("t")).select(*ingest.BATCH_KEY, *[f"t.{v}" for v in values])
