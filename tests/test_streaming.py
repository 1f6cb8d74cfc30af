"""availableNow stream ingest: any trigger gives the batch result, a replayed request
adds nothing, and a restart from the checkpoint adds nothing."""

import os

import pytest

from conftest import SF_SMALL
from test_ingest import CLERK, line
from tiermill.operators import ingest
from tiermill.plans import catalog
from tiermill.sources import feed
from tiermill.streaming import ingest_stream

VALID = ["batch_id", "index", "id", "name", "datetime", "department_id", "job_id"]
DEAD = ["table", "batch_id", "index", "record", "error"]
LIMITS = [{"max_files_per_trigger": 1}, {"max_files_per_trigger": 1000}, {"max_bytes_per_trigger": 20_000}]


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def outputs(spark, out):
    """Everything that a stream wrote, without the number of the micro-batch."""
    return {"valid": rows(ingest_stream.ingested(spark, out, "employees").select(*VALID)),
            "dead": rows(spark.read.json(out + "/dlq").select(*DEAD)),
            "summary": rows(spark.read.parquet(out + "/ingest_summary").drop("batch")),
            "rejected": rows(spark.read.parquet(out + "/rejected_requests").drop("batch"))}


def expected(lines):
    ev = ingest.evaluate(ingest.once(ingest.read_requests(lines)))
    return {"valid": rows(ingest.valid_records(ev, "employees").select(*VALID)), "dead": rows(ingest.all_rejects(ev).select(*DEAD)),
            "summary": rows(ingest.summary(ev)), "rejected": rows(ingest.rejected_requests(ev))}


@pytest.mark.parametrize("limit", LIMITS)
def test_stream_equals_batch_and_replays_nothing(spark, root, limit):
    lines = feed.request_lines(spark, SF_SMALL)
    source = ingest_stream.write_lines(lines, root + "/incoming", files=4)
    ingest_stream.run_available(spark, source, root + "/out", root + "/ck", **limit)
    batches = os.listdir(root + "/out/raw/employees")
    if limit != {"max_files_per_trigger": 1000}:
        assert len(batches) > 1
    assert outputs(spark, root + "/out") == expected(lines)
    ingest_stream.run_available(spark, source, root + "/out", root + "/ck", **limit)
    assert os.listdir(root + "/out/raw/employees") == batches


@pytest.mark.parametrize("limit", LIMITS)
def test_repeated_lines_and_batch_ids_under_any_trigger(spark, root, limit):
    """Files that hold the same malformed line and different requests of one batch
    id; the last file is delivered twice, the second time after a restart."""
    texts = [[line("employees", "7", [dict(CLERK, id=k * 10 + i) for i in range(1, 4)] + [dict(CLERK, id=-1)]), "no request", "", f"broken {k}"] for k in range(4)]
    os.makedirs(root + "/incoming")

    def deliver(name, own):
        with open(f"{root}/incoming/{name}.txt", "w") as f:
            f.write("\n".join(own) + "\n")

    for k, own in enumerate(texts):
        deliver(k, own)
    deliver("again-at-once", texts[0])

    def run():
        ingest_stream.run_available(spark, root + "/incoming", root + "/out", root + "/ck", **limit)
        ingest_stream.total_available(spark, root + "/out", root + "/totals")

    run()
    deliver("again-later", texts[3])
    run()
    got = outputs(spark, root + "/out")
    assert got == expected(spark.createDataFrame([(x,) for own in texts for x in own], "value string"))
    assert [r[1:] for r in got["summary"]] == [("employees", "7", 3, 1)] * 4 and len(got["rejected"]) == 5
    assert rows(ingest_stream.totals(spark, root + "/out")) == [("employees", "7", 4, 12, 4)]
    deliver("more", [line("employees", "7", [dict(CLERK, id=99)])])
    run()
    assert rows(ingest_stream.totals(spark, root + "/out")) == [("employees", "7", 5, 13, 4)]


def test_stream_to_mart_makes_the_lines_once(spark, monkeypatch):
    lines, seen = feed.request_lines, spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    monkeypatch.setattr(feed, "request_lines", lambda s, d: lines(s, d).mapInArrow(counted, "value string"))
    assert catalog.QUERIES["stream_to_mart"](spark, SF_SMALL).count() > 0
    assert seen.value == lines(spark, SF_SMALL).count()


def test_records_do_not_carry_their_line(spark):
    """A line is copied beside a record only if it has no records of its own."""
    texts = [line("employees", "7", [dict(CLERK, id=k) for k in range(1, 4)]), line("employees", "8", []), "no request"]
    out = ingest.evaluate(ingest.read_requests(spark.createDataFrame([(x,) for x in texts], "value string")))
    assert rows(out.filter("request_error IS NOT NULL").select("record")) == sorted([(x,) for x in texts[1:]], key=repr)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    carried = next(x for x in plan.split("\n") if "Generate posexplode" in x)
    before = plan[plan.index(carried) + len(carried):].split("\n")[1]
    assert "AS line#" in before and "CASE WHEN" in before.split(" AS line#")[0]
