"""Readers and writers: CSV with explicit / inferred schema, JSON lines in
strict and permissive mode, layer naming."""

import os

import pytest

from tiermill import schemas
from tiermill.sources import readers, writers


def test_csv_text_and_empty_fields(spark, root):
    path = os.path.join(root, "in")
    os.makedirs(path)
    with open(os.path.join(path, "a.csv"), "w") as f:
        f.write("id,name,datetime,department_id,job_id\n"
                "1,Mirela,2019-02-03T04:05:06Z,4,17.0\n"
                "2,,2020-10-11T12:13:14Z,5,\n"
                '3,"",2018-07-08T09:10:11Z,6,1.0\n')
    with open(os.path.join(path, "b.csv"), "w") as f:
        f.write("id,name,datetime,department_id,job_id\n4,  Padded ,202,1,3.0\n")
    df = readers.read_csv(spark, path + "/*.csv", "employees")
    rows = {r.id: r for r in df.collect()}
    assert len(rows) == 4 and rows[1].job_id == 17.0 and rows[2].job_id is None
    assert rows[2].name is None and rows[3].name is None  # empty text reads as null
    assert rows[4].name == "  Padded " and rows[4].datetime == "202"
    out = writers.write_csv(df, os.path.join(root, "out"))
    back = readers.read_csv(spark, out, "employees")
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)
    inferred = readers.read_csv(spark, path, infer=True)
    assert dict(inferred.dtypes)["job_id"] == "double"


def test_json_lines_strict_and_permissive(spark, root):
    path = os.path.join(root, "feed")
    os.makedirs(path)
    with open(os.path.join(path, "part.json"), "w") as f:
        f.write('{"id":1,"job":"x"}\n{"id":2,\n')
    df = readers.read_json_records(spark, path, schemas.RAW_JOBS)
    rows = df.collect()
    assert len(rows) == 2
    assert sum(r[readers.CORRUPT] is not None for r in rows) == 1
    with pytest.raises(Exception):
        readers.read_json_records(spark, path, schemas.RAW_JOBS, strict=True).collect()


def test_layer_names():
    assert schemas.table_name("staging", "employees") == "tiermill_staging.employees"
    assert schemas.schema_name(None) == "default"
    assert schemas.schema_name(" marts ", prefix="hr") == "hr_marts"
