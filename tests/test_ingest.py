"""Request ingest: request rules, record rules, split, summary."""

import json

import pytest
from pyspark.sql import functions as F

from tiermill import schemas
from tiermill.operators import ingest

CLERK = {"id": 41, "name": "Ada Byron", "datetime": "2021-03-04T05:06:07Z", "department_id": 7, "job_id": 12}
BROKEN = {"id": -8, "name": "", "datetime": "soon", "department_id": 7, "job_id": 12}


def line(table, batch, records):
    """A request line; a str stands for a record's JSON text."""
    data = ",".join(r if isinstance(r, str) else json.dumps(r) for r in records)
    return f'{{"table":{json.dumps(table)},"batch_id":{json.dumps(batch)},"data":[{data}]}}'


def requests_of(spark, lines):
    return ingest.read_requests(spark.createDataFrame([(x,) for x in lines], "value string"))


def evaluated(spark, *requests):
    return ingest.evaluate(requests_of(spark, [line(*r) for r in requests]))


def errors_of(spark, records, table="employees"):
    rows = evaluated(spark, (table, "b", records)).select("index", "error_list").collect()
    return {r["index"]: r.error_list for r in rows}


def test_valid_and_invalid_record(spark):
    ev = evaluated(spark, ("employees", "a", [CLERK, BROKEN]))
    assert [tuple(r)[1:] for r in ingest.summary(ev).collect()] == [("employees", "a", 1, 1)]
    rej = ingest.rejected_records(ev).collect()
    assert len(rej) == 1 and rej[0]["index"] == 1 and rej[0].error_type == "ValidationError"
    assert rej[0].error.startswith("3 validation errors for Employee; id: ")
    assert "name: String should have at least 1 character" in rej[0].error
    assert "datetime: Value error, no es un formato de fecha aceptable" in rej[0].error
    assert json.loads(rej[0].record) == BROKEN


def test_field_rules(spark):
    errors = errors_of(spark, [
        dict(CLERK, job_id=96.0), dict(CLERK, job_id=96.5), dict(CLERK, name="   "), dict(CLERK, name="x" * 256),
        dict(CLERK, name="x" * 250 + " " * 10), dict(CLERK, datetime="2021-1-5"), dict(CLERK, extra="dropped"),
        {k: v for k, v in CLERK.items() if k != "department_id"}, dict(CLERK, department_id=None), dict(CLERK, id="abc")])
    assert errors[0] == "" and errors[6] == ""
    assert errors[1] == "job_id: Input should be a valid integer, got a number with a fractional part"
    assert errors[2] == "name: Value error, Name cannot be empty after stripping"
    assert errors[3] == errors[4] == "name: String should have at most 255 characters"
    assert errors[5] == "datetime: Value error, no es un formato de fecha aceptable"
    assert errors[7] == "department_id: Field required"
    assert errors[8] == "department_id: Input should be a valid integer"
    assert errors[9] == "id: Input should be a valid integer"


INT, STR = "Input should be a valid integer", "Input should be a valid string"


@pytest.mark.parametrize(("field", "token", "value"), [
    ("id", "1234567890123456789", 1234567890123456789), ("id", "9223372036854775807", 9223372036854775807),
    ("id", "9223372036854775808", INT), ("id", "99999999999999999999", INT), ("id", '"12"', 12), ("id", '" 12 "', 12),
    ("id", '"1234567890123456789"', 1234567890123456789), ("id", "12.0", 12), ("id", "1e3", 1000), ("id", "1e30", INT),
    ("id", "true", INT), ("id", "[1]", INT), ("id", '{"a":1}', INT), ("id", "null", INT), ("id", '""', INT),
    ("name", "5", STR), ("name", "1.5", STR), ("name", "false", STR), ("name", '{"x":1}', STR), ("name", '["x"]', STR), ("name", "null", STR),
    ("datetime", "20210304", STR), ("datetime", "null", STR),
])
def test_token_kinds(spark, field, token, value):
    record = json.dumps({**CLERK, field: "@"}).replace('"@"', token)
    ev = evaluated(spark, ("employees", "t", [record]))
    if isinstance(value, int):
        assert ingest.valid_records(ev, "employees").first()[field] == value
    else:
        assert ingest.valid_records(ev, "employees").count() == 0
        assert ev.first().error_list == f"{field}: {value}"


def test_records_that_are_no_objects(spark):
    ev = evaluated(spark, ("jobs", "n", ["[1]", "7", "null", '"text"', {"id": 1, "job": "Clerk"}]))
    assert [r.error_list for r in ev.orderBy("index").collect()] == [ingest.ERR_NOT_OBJECT] * 4 + [""]
    assert [r.record for r in ingest.rejected_records(ev).orderBy("index").collect()] == ["[1]", "7", "null", "text"]


def test_other_tables(spark):
    ev = evaluated(spark, ("departments", "d", [{"id": 1, "department": " Sales "}, {"id": 2, "department": "  "}]),
                   ("jobs", "j", [{"id": 3, "job": "Clerk"}, {"id": 0, "job": "x" * 101}]))
    assert {(r.table, r.inserted, r.rejected) for r in ingest.summary(ev).collect()} == {("departments", 1, 1), ("jobs", 1, 1)}
    assert ingest.valid_records(ev, "departments").first().department == "Sales"
    assert ingest.rejected_records(ev.filter("table = 'jobs'")).first().error.startswith("2 validation errors for Job")


def test_request_rules_and_nothing_lost(spark):
    many = [dict(CLERK, id=i + 1) for i in range(1001)]
    lines = [line("employees", "ok", many[:1000]), line("employees", "big", many), line("staff'; --", "x", [CLERK, CLERK]),
             line(None, "n", [CLERK]), line("jobs", None, [{"id": 1, "job": "a"}]), line("jobs", "empty", []),
             '{"table":"jobs","batch_id":"nodata"}', '{"table":"jobs","batch_id":"cut","data":[{"id":', "no json", "  ", '{"table":"jobs","batch_id":"s","data":"text"}']
    requests = requests_of(spark, lines)
    verdicts = {r.batch_id: (r.accepted, r.error) for r in ingest.batch_verdicts(requests).collect() if r.batch_id}
    assert verdicts["ok"] == (True, None) and verdicts["x"] == (False, "Invalid table: staff'; --")
    assert verdicts["big"] == verdicts["empty"] == verdicts["nodata"] == (False, ingest.ERR_BATCH_SIZE)
    assert verdicts["n"] == (False, "Invalid table: NULL")
    ev = ingest.evaluate(requests)
    assert ingest.valid_records(ev, "employees").count() == 1000
    rejects = ingest.all_rejects(ev)
    assert rejects.count() == 1001 + 2 + 1 + 1 + 5  # five lines without a record
    assert rejects.filter("error is null or record is null or error_type is null").count() == 0
    kept = {r.record for r in rejects.filter("index is null").collect()}
    assert kept == {lines[5], lines[6], lines[7], lines[8], lines[10]}
    assert {r.batch_id for r in ingest.summary(ev).collect()} == {"ok"}


def test_no_shuffle_or_window_before_the_split(spark):
    ev = evaluated(spark, ("employees", "a", [CLERK, BROKEN]))
    for df in (ingest.valid_records(ev, "employees"), ingest.all_rejects(ev)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Window" not in plan and "Join" not in plan
        assert plan.count("parse_json") <= 1  # each record is parsed once


def test_output_schemas(spark):
    ev = evaluated(spark, ("employees", "a", [CLERK, BROKEN]), ("jobs", "j", [{"id": 3, "job": "Clerk"}]))
    for table in ("employees", "jobs"):
        valid = ingest.valid_records(ev, table).drop("batch_id", "index")
        assert [(f.name, f.dataType) for f in valid.schema] == [(f.name, f.dataType) for f in schemas.DECLARED[table]]
    rej = ingest.rejected_records(ev).select(*[f.name for f in schemas.REJECTED_RECORD])
    assert [(f.name, f.dataType) for f in rej.schema] == [(f.name, f.dataType) for f in schemas.REJECTED_RECORD]


def test_feed_keeps_every_row(spark):
    from conftest import SF_SMALL
    from tiermill.plans.catalog import requests
    from tiermill.sources.readers import testdata
    rows = sum(testdata(spark, SF_SMALL, t).count() for t in ("orders", "nation", "nation", "nation", "part", "supplier"))
    ev = ingest.evaluate(requests(spark, SF_SMALL))
    assert ev.count() == rows + 3 + 3  # three records and three lines without one from the regions
    assert ev.filter(F.col("n_errors") == 0).count() + ingest.all_rejects(ev).count() == rows + 6


def test_two_requests_of_one_batch_id_are_two(spark):
    lines = [line("jobs", "7", [{"id": 1, "job": "a"}]), line("jobs", "7", [{"id": 2, "job": "b"}, {"id": 0, "job": "c"}]), "cut {", "cut {", "other {"]
    requests = requests_of(spark, lines)
    assert sorted(tuple(r)[1:] for r in ingest.summary(ingest.evaluate(requests)).collect()) == [("jobs", "7", 1, 0), ("jobs", "7", 1, 1)]
    again = ingest.once(requests_of(spark, lines * 2))
    assert sorted(tuple(r)[1:] for r in ingest.summary(ingest.evaluate(again)).collect()) == [("jobs", "7", 1, 0), ("jobs", "7", 1, 1)]
    assert ingest.rejected_requests(ingest.evaluate(again)).count() == 2
