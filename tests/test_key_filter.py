"""Bloom filters over keys: orphans and the unique check of appended rows."""

import glob
import os

import pytest

from tiermill.operators import key_filter, quality, snapshots
from test_plans import plan_of

FACT, DIM = "key long, v string", "id long"


def _counts(df):
    return sorted(((r["key"], r["n_records"]) for r in df.collect()), key=str)


def test_orphans_equal_the_plain_anti_join(spark):
    fact = spark.range(3000).selectExpr("CASE WHEN id % 50 = 0 THEN NULL WHEN id % 3 = 0 THEN 7 ELSE id END AS key", "'x' AS v")
    dim = spark.range(0, 3000, 2).selectExpr("id").unionByName(spark.createDataFrame([(None,), (4,)], DIM))
    want = _counts(quality.orphans(fact, "key", dim))
    assert _counts(key_filter.orphans_by_bloom(fact, "key", dim)) == want and (None, 60) in want
    # a filter that may not be sent: the same rows by the join alone
    assert _counts(key_filter.orphans_by_bloom(fact, "key", dim, max_bytes=8)) == want
    assert "bit_or" not in plan_of(key_filter.orphans_by_bloom(fact, "key", dim, max_bytes=8))


def test_empty_sides(spark):
    none, some = spark.createDataFrame([], DIM), spark.createDataFrame([(1, "a"), (None, "b")], FACT)
    assert _counts(key_filter.orphans_by_bloom(some, "key", none)) == [(1, 1), (None, 1)]
    assert _counts(key_filter.orphans_by_bloom(some.limit(0), "key", some.selectExpr("key AS id"))) == []


def test_only_keys_that_may_stand_are_joined(spark, root):
    fact = spark.range(10000, 60000).withColumnRenamed("id", "key")
    dim = spark.range(10000)
    words = key_filter.words_for(10000)
    maybe = fact.filter(key_filter.may_hold(key_filter.filter_of(dim, "id", words), fact["key"], words)).count()
    assert 0 < maybe < 0.05 * 50000  # all are orphans; few of them reach the join
    held = dim.filter(key_filter.may_hold(key_filter.filter_of(dim, "id", words), dim["id"], words)).count()
    assert held == 10000
    p = plan_of(key_filter.orphans_by_bloom(fact, "key", dim))
    assert "LeftAnti" in p and "bit_or" in p and "CartesianProduct" not in p and "NestedLoopJoin" not in p


def _table(spark, root, rows, schema=None):
    t = snapshots.StoredTable(spark, root, "people", key="id", parts=16, schema=schema)
    snapshots.overwrite(t, spark.createDataFrame(rows, "id long, name string"))
    keys = key_filter.UniqueKeys(t, root, words=256)
    keys.build()
    return t, keys


def _dups(keys):
    return sorted(r["id"] for r in keys.duplicates().collect())


def test_appends_read_only_partitions_that_may_hold_a_key(spark, root):
    t, keys = _table(spark, root, [(i, "a") for i in range(500)] + [(3, "b"), (None, "n"), (None, "n")])
    assert _dups(keys) == [3]
    new = spark.createDataFrame([(10 ** 6 + i, "c") for i in range(20)] + [(None, "n")], "id long, name string")
    assert len(keys.append(new)) <= 3 and _dups(keys) == [3]
    again = spark.createDataFrame([(77, "d"), (10 ** 6, "d"), (9 * 10 ** 6, "e"), (9 * 10 ** 6, "f")], "id long, name string")
    read = keys.append(again)
    assert 1 <= len(read) <= 4
    assert _dups(keys) == [3, 77, 10 ** 6, 9 * 10 ** 6]
    full = quality.duplicate_keys(t.read(), ["id"])
    assert sorted(r["id"] for r in full.collect()) == _dups(keys)
    assert t.read().count() == 503 + 21 + 4


def test_a_stored_partition_that_is_not_read_may_be_gone(spark, root):
    t, keys = _table(spark, root, [(i, "a") for i in range(100)])
    row = spark.createDataFrame([(5, "b")], "id long, name string")
    part = t.parted(row).first()["_part"]
    t.schema = t.stored().schema  # or Spark would take it from some file
    for folder in glob.glob(os.path.join(t.current(), "_part=*")):
        if not folder.endswith(f"={part}"):
            for f in glob.glob(folder + "/*.parquet"):
                with open(f, "wb") as broken:  # a read of this file would fail
                    broken.write(b"no parquet")
    assert keys.append(row) == [part] and _dups(keys) == [5]


def test_empty_table_and_append(spark, root):
    t, keys = _table(spark, root, [], schema="id long, name string, _part int")
    assert keys.append(spark.createDataFrame([], "id long, name string")) == [] and _dups(keys) == []
    assert keys.append(spark.createDataFrame([(1, "a"), (1, "b")], "id long, name string")) == [] and _dups(keys) == [1]
    with pytest.raises(ValueError):
        key_filter.UniqueKeys(snapshots.StoredTable(spark, root, "other"), root)
