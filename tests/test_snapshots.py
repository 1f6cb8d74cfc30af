"""Stored tables, snapshots and table operations."""

import os
import pathlib

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tiermill import schemas
from tiermill.operators import snapshots
from tiermill.plans import catalog
from tiermill.plans.catalog import QUERIES

ROWS = [(1, "a", "2021-01-01", 1, 1.0), (2, "b", "2021-01-01", 1, 2.0),
        (5000, "c", "2021-01-01", 2, 1.0), (None, "d", "2021-01-01", 2, 1.0)]


def table_with_rows(spark, root, key=None):
    t = snapshots.StoredTable(spark, root, "employees", key=key, parts=8)
    snapshots.overwrite(t, spark.createDataFrame(ROWS, schemas.RAW_EMPLOYEES))
    return t


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_backup_delete_restore(spark, root):
    t = table_with_rows(spark, root)
    out = snapshots.backup(t.read(), root, "employees", as_of="2024-05-02 14:30:22")
    assert out["timestamp"] == "20240502_143022" and out["rows_backed_up"] == 4
    snapshots.delete_where(t, F.col("id") > 4540)
    assert t.read().count() == 3  # the null id is not deleted
    res = snapshots.restore(t, root, "20240502_143022", schema=schemas.RAW_EMPLOYEES)
    assert res["rows_restored"] == 4
    assert rows(t.read()) == rows(spark.createDataFrame(ROWS, schemas.RAW_EMPLOYEES))
    assert len(t.versions()) == 3


def test_missing_snapshot(spark, root):
    t = table_with_rows(spark, root)
    with pytest.raises(snapshots.SnapshotNotFound):
        snapshots.restore(t, root, "19990101_000000")


def test_latest_snapshot(spark, root):
    df = spark.createDataFrame(ROWS, schemas.RAW_EMPLOYEES)
    snapshots.backup(df, root, "employees", as_of="2024-01-01 00:00:00")
    snapshots.backup(df.limit(2), root, "employees", as_of="2024-01-02 00:00:00")
    latest = snapshots.latest_snapshots(snapshots.manifest(spark, root)).first()
    assert (latest.ts, latest.rows) == ("20240102_000000", 2)


def test_truncate_keeps_schema(spark, root):
    t = table_with_rows(spark, root)
    snapshots.truncate(t)
    assert t.read().count() == 0 and t.read().schema == schemas.RAW_EMPLOYEES


def test_versions_name_their_operation(spark, root):
    t = table_with_rows(spark, root)
    snapshots.backup(t.read(), root, "employees", as_of="2024-05-02 14:30:22")
    snapshots.delete_where(t, F.col("id") > 4540)
    snapshots.truncate(t)
    snapshots.restore(t, root, schema=schemas.RAW_EMPLOYEES)
    assert [operation for operation, _ in t.history()] == ["overwrite", "delete", "truncate", "restore"]
    assert [p for _, p in t.history()] == t.versions()


def test_truncate_query_gives_operation_and_rows(spark):
    out = QUERIES["truncate_table"](spark, SF_SMALL)
    assert out.columns == ["version", "operation", "rows"]
    assert rows(out) == [(0, "overwrite", spark.read.parquet(f"{SF_SMALL}/orders.parquet").count()), (1, "truncate", 0)]


def files_of(t):
    return {(str(f.relative_to(t.current())), f.stat().st_mtime_ns) for f in pathlib.Path(t.current()).rglob("part-*")}


def parts_of(files):
    return {f.split("/")[0] for f, _ in files}


BATCH = "id long, name string, datetime string, department_id long, job_id double, seq long"


def test_upsert_twice_equals_once(spark, root):
    t = table_with_rows(spark, root, key="id")
    batch = spark.createDataFrame(
        [(2, "b2", "2021-02-02", 1, 2.0, 1), (2, "b3", "2021-02-03", 1, 2.0, 2),
         (7, "g", "2021-02-02", 3, 3.0, 1), (None, "n", "2021-02-02", 3, 3.0, 1)], BATCH)
    snapshots.upsert(t, batch, ["seq"])
    once = rows(t.read())
    assert [r for r in once if r[0] == 2] == [(2, "b3", "2021-02-03", 1, 2.0)]
    assert len(once) == 5  # 4 old - 1 replaced + 2 new keys; the batch row without a key is left out
    assert [r for r in once if r[0] is None] == [ROWS[3]]
    snapshots.upsert(t, batch, ["seq"])
    assert rows(t.read()) == once and t.read().schema == schemas.RAW_EMPLOYEES


def test_upsert_writes_the_touched_partitions_only(spark, root):
    t = snapshots.StoredTable(spark, root, "employees", key="id", parts=8)
    snapshots.overwrite(t, spark.range(1, 400).selectExpr("id", "'n' AS name", "'2021-01-01' AS datetime", "1L AS department_id", "1.0D AS job_id"))
    before, folder = files_of(t), t.current()
    touched = snapshots.upsert(t, spark.createDataFrame([(2, "b", "2021-02-02", 1, 2.0, 1), (1000, "c", "2021-02-02", 1, 2.0, 1)], BATCH), ["seq"])
    own = {f"_part={k}" for k in touched}
    assert 0 < len(own) <= 2 and t.current() == folder
    assert {f for f in before if f[0].split("/")[0] not in own} == {f for f in files_of(t) if f[0].split("/")[0] not in own}
    assert not {f for f in before if f[0].split("/")[0] in own} & files_of(t)
    assert t.read().count() == 400 and t.read().filter("name <> 'n'").count() == 2


def test_delete_writes_the_touched_partitions_only(spark, root):
    t = snapshots.StoredTable(spark, root, "employees", key="id", parts=8)
    snapshots.overwrite(t, spark.range(1, 40).selectExpr("id", "'n' AS name", "'2021-01-01' AS datetime", "1L AS department_id", "1.0D AS job_id"))
    before = files_of(t)
    of = {r.id: f"_part={r._part}" for r in t.stored().collect()}
    whole = [i for i, p in of.items() if p == of[1]]
    snapshots.delete_where(t, F.col("id").isin(*whole, next(i for i in of if of[i] != of[1])))
    changed = parts_of(before ^ files_of(t))
    assert of[1] in changed and len(changed) == 2 and of[1] not in parts_of(files_of(t))
    assert t.read().count() == 39 - len(whole) - 1
    snapshots.delete_where(t, F.col("id") < 0)
    assert t.read().count() == 39 - len(whole) - 1


def test_null_keys_are_spread_and_stay(spark, root):
    t = snapshots.StoredTable(spark, root, "employees", key="id", parts=8)
    rows_ = [(None, f"n{i}", "2021-01-01", 1, 1.0) for i in range(200)]
    snapshots.overwrite(t, spark.createDataFrame(rows_, schemas.RAW_EMPLOYEES))
    assert t.stored().select("_part").distinct().count() == 8
    snapshots.upsert(t, spark.createDataFrame([(i, "k", "2021-02-02", 1, 2.0, 1) for i in range(50)], BATCH), ["seq"])
    assert t.read().filter("id IS NULL").count() == 200 and t.read().count() == 250


def test_upsert_reads_the_batch_once(spark, root):
    t = table_with_rows(spark, root, key="id")
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    batch = t.read().selectExpr("*", "1L as seq").mapInPandas(count, BATCH)
    snapshots.upsert(t, batch, ["seq"])
    assert seen.value == 4


def test_upsert_twice_evaluates_its_batch_once(spark, monkeypatch):
    valid, seen = catalog.q_ingest_valid, spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    monkeypatch.setattr(catalog, "q_ingest_valid", lambda s, d: (v := valid(s, d)).mapInArrow(counted, v.schema))
    out = QUERIES["upsert_twice"](spark, SF_SMALL)
    assert out.count() > 0 and seen.value == valid(spark, SF_SMALL).count()


def test_append_checks_the_schema(spark, root):
    t = table_with_rows(spark, root)
    more = spark.createDataFrame([(8, "h", "2021-01-01", 1, 1.0)], schemas.RAW_EMPLOYEES)
    snapshots.append(t, more, schemas.RAW_EMPLOYEES)
    assert len(t.versions()) == 1 and t.read().count() == 5
    for wrong in (more.drop("job_id"), more.withColumn("id", F.col("id").cast("int")), more.select("name", "id", "datetime", "department_id", "job_id")):
        with pytest.raises(ValueError, match="append to employees"):
            snapshots.append(t, wrong, schemas.RAW_EMPLOYEES)
    assert t.read().count() == 5


def test_a_write_that_died_does_not_count(spark, root):
    t = table_with_rows(spark, root)
    for name, files in (("v99999999999999999998-dead", []), ("v99999999999999999999-torn", ["part-00000.parquet"])):
        os.makedirs(os.path.join(t.location, name))
        for f in files:
            open(os.path.join(t.location, name, f), "w").close()
    assert t.read().count() == 4 and len(t.versions()) == 1

    def fail(batches):
        yield from ()
        raise OSError("the job dies")

    with pytest.raises(Exception, match="the job dies"):
        snapshots.overwrite(t, t.read().mapInPandas(fail, t.read().schema))
    assert t.read().count() == 4


def test_damaged_snapshot_changes_nothing(spark, root):
    t = table_with_rows(spark, root)
    out = snapshots.backup(t.read(), root, "employees", as_of="2024-05-02 14:30:22")
    spark.createDataFrame(ROWS[:1], schemas.RAW_EMPLOYEES).write.mode("overwrite").parquet(out["backup_uri"])
    with pytest.raises(RuntimeError, match="expected 4"):
        snapshots.restore(t, root, schema=schemas.RAW_EMPLOYEES)
    assert len(t.versions()) == 1 and t.read().count() == 4


def test_two_backups_of_one_second(spark, root):
    df = spark.createDataFrame(ROWS, schemas.RAW_EMPLOYEES)
    a = snapshots.backup(df, root, "employees", as_of="2024-01-01 00:00:00")
    b = snapshots.backup(df.limit(2), root, "employees", as_of="2024-01-01 00:00:00")
    assert a["backup_uri"] != b["backup_uri"] and spark.read.parquet(a["backup_uri"]).count() == 4
    assert snapshots.find_snapshot(spark, root, "employees")["rows"] == 2  # the later one
