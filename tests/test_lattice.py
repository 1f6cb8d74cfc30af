"""The type lattice of CSV text."""

from pyspark.sql import functions as F

from tiermill.sources import lattice


def test_kinds_of_values(spark):
    want = {"1": 1, "-17": 1, " 5 ": 1, "1.5": 2, "1e9": 2, ".5": 2, "1234567890123456789": 2, "2020-01-02": 4,
            "2020-01-02T03:04:05Z": 4, "x": 8, "1-2": 8, "": 0, "   ": 0, None: 0}
    rows = spark.createDataFrame([(k,) for k in want], "v string").select("v", lattice.kind(F.col("v")).alias("k")).collect()
    assert {r["v"]: r["k"] for r in rows} == want


def test_the_source_that_widens_is_named(spark):
    parts = [("a", "1", None), ("a", "2", "2020-01-01"), ("b", "3", ""), ("c", "4.5", "2020-01-01"), ("d", None, "7")]
    df = spark.createDataFrame(parts, "src string, n string, t string")
    got = {(r["source"], r["column"]): (r["file_type"], r["table_type"], r["widens"])
           for r in lattice.type_conflicts(lattice.column_kinds(df, ["n", "t"], F.col("src"))).collect()}
    assert got == {("a", "n"): ("bigint", "double", False), ("b", "n"): ("bigint", "double", False),
                   ("c", "n"): ("double", "double", True), ("d", "n"): ("empty", "double", False),
                   ("a", "t"): ("timestamp", "string", False), ("b", "t"): ("empty", "string", False),
                   ("c", "t"): ("timestamp", "string", False), ("d", "t"): ("bigint", "string", True)}
    kinds = lattice.column_kinds(df, ["n", "t"], F.col("src"))
    assert {(r["column"], r["type"]) for r in lattice.column_types(kinds).collect()} == {("n", "double"), ("t", "string")}


def test_each_file_is_a_source(spark, root):
    for k, rows in enumerate([["id", "1", "2"], ["id", "x"]]):
        spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1).write.text(f"{root}/csv/{k}")
    text = spark.read.option("header", True).schema("id string").csv(f"{root}/csv/*")
    got = sorted((r["file_type"], r["widens"]) for r in lattice.type_conflicts(lattice.column_kinds(text, ["id"])).collect())
    assert got == [("bigint", False), ("string", True)]
    assert lattice.type_conflicts(lattice.column_kinds(text.limit(0), ["id"])).count() == 0
