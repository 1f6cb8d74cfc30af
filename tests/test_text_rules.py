"""Column helpers: timestamp acceptance, canonical text, whitespace, rounding."""

import pytest
from pyspark.sql import functions as F

from tiermill.functions import text

# (input text, canonical UTC text or None)
TIMESTAMP_CASES = [
    ("2021-11-07T02:48:42Z", "2021-11-07T02:48:42Z"),
    ("2021-11-07", "2021-11-07T00:00:00Z"),
    ("202", None),
    ("2021", None),
    ("2021-11", None),
    ("12:30:00", None),
    ("20211107T024842Z", None),
    ("2021-13-01T00:00:00Z", None),
    ("2021-02-30", None),
    ("", None),
    ("2021-11-07T02:48:42+05:30", "2021-11-06T21:18:42Z"),
    ("  2021-11-07T02:48:42Z ", "2021-11-07T02:48:42Z"),
    ("2021-11-07T02:48:42.987Z", "2021-11-07T02:48:42Z"),
    ("2021-1-5", "2021-01-05T00:00:00Z"),
    (None, None),
]


def test_safe_timestamp_and_canonical(spark):
    df = spark.createDataFrame(TIMESTAMP_CASES, "t string, expected string")
    got = df.select("t", "expected", text.canonical_text(text.safe_timestamp("t")).alias("c")).collect()
    for row in got:
        assert row.c == row.expected, row


def test_strip_and_blank(spark):
    df = spark.createDataFrame([("  a b  ",), ("\t\nx\n",), ("   ",), ("",), (None,)], "s string")
    rows = df.select(text.strip_ws("s").alias("v"), text.is_blank("s").alias("b")).collect()
    assert [r.v for r in rows] == ["a b", "x", "", "", None]
    assert [r.b for r in rows] == [False, False, True, True, None]


def test_round_to_long_half_away_from_zero(spark):
    df = spark.createDataFrame([(96.0,), (96.5,), (-2.5,), (None,)], "x double")
    assert [r.v for r in df.select(text.round_to_long("x").alias("v")).collect()] == [96, 97, -3, None]


@pytest.mark.parametrize("year,inside", [(2021, True), (2022, False)])
def test_in_year_half_open(spark, year, inside):
    df = spark.createDataFrame([("2021-12-31 23:59:59",), ("2022-01-01 00:00:00",)], "s string")
    ts = F.col("s").cast("timestamp")
    got = [r.v for r in df.select(text.in_year(ts, year).alias("v")).collect()]
    assert got == ([True, False] if inside else [False, True])


def test_canonical_text_is_read_strictly(spark):
    df = spark.createDataFrame([("2021-11-07T02:48:42Z",), (None,)], "t string")
    got = [r.v for r in df.select(text.canonical_text(text.parse_canonical("t")).alias("v")).collect()]
    assert got == ["2021-11-07T02:48:42Z", None]
    for bad in ("2021-11-07", "2021-11-07T02:48:42", "x"):
        with pytest.raises(Exception, match="CANNOT_PARSE"):
            spark.createDataFrame([(bad,)], "t string").select(text.parse_canonical("t").alias("v")).collect()


def test_shared_folder_is_required_off_a_local_master(monkeypatch):
    from types import SimpleNamespace

    from tiermill import session
    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master="yarn"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(cluster)
