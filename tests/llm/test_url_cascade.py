import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_ORACLE
from harness import compare, duck
from tiermill.llm import catalog
from tiermill.llm.catalog import ORACLE, QUERIES
from tiermill.llm.url_cascade import Cascade, build_cascade, first_listed, is_listed, rule_keys, rule_of, split_url


def test_query_equals_sql(spark):
    problems, n = compare(QUERIES["op4_url_cascade"](spark, SF_ORACLE), duck(SF_ORACLE), ORACLE["op4_url_cascade"])
    assert n == 250 and not problems


@pytest.mark.parametrize("share", [2, 10, 500])
def test_membership_is_exact(spark, share):
    keys = spark.range(20000).select(F.concat(F.lit("host"), F.col("id")).alias("key"), (F.col("id") % share == 0).alias("listed"))
    keys = keys.union(keys.where("listed"))  # repeated keys count once
    cascade = build_cascade(keys, "key", "listed")
    wrong = keys.where(is_listed(cascade, F.col("key")) != F.col("listed")).count()
    assert wrong == 0 and len(cascade.levels) > 1
    bits = sum(level.size for level in cascade.levels)
    assert bits < 64 * (20000 // share) + 4096


def test_edge_cases(spark):
    keys = spark.createDataFrame([("a", True), ("a", False), (None, True), ("", False)], "key string, listed boolean")
    cascade = build_cascade(keys, "key", "listed")
    got = {r.key: r.x for r in keys.select("key", is_listed(cascade, F.col("key")).alias("x")).collect()}
    assert got == {"a": True, "": False, None: None}
    none = build_cascade(keys.where("not listed"), "key", "listed")
    assert none.levels == [] and not none.listed(np.array([1]), np.array([2])).any()
    assert build_cascade(keys.limit(0), "key", "listed").levels == []
    with pytest.raises(ValueError, match="more than"):
        build_cascade(keys, "key", "listed", max_bytes=1)


def test_hosts_paths_and_rules(spark):
    given = {
        "http://A.Example.NET/en/x?q#f": ("a.example.net", "/en/x", "example.net/en/"), "https://x.net": ("x.net", "", None),
        "https://x.net/": ("x.net", "/", "net/"), "no scheme/net": ("", "", None), None: ("", "", None), "": ("", "", None),
        "http://u://v/fr/": ("u:", "//v/fr/", None), "ftp://net/?a": ("net", "/", "net/"), "http://badnet/": ("badnet", "/", None),
        "http://é.org/fr/#": ("é.org", "/fr/", "org/fr/"), "http:///p": ("", "/p", None),
    }
    rules = [("net", "/"), ("example.net", "/en/"), ("example.com", "/de/"), ("org", "/fr/")]
    host, path = split_url(F.col("url"))
    rows = spark.createDataFrame([(u,) for u in given], "url string").select("url", host.alias("host"), path.alias("path"))
    got = {r.url: (r.host, r.path, r.rule) for r in rows.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules)).collect()}
    assert got == given


def test_cascade_decides_the_rules(spark, monkeypatch):
    rows = {r.page_id: (r.rule, r.verdict) for r in QUERIES["op4_url_cascade"](spark, SF_ORACLE).collect()}
    assert {v for _, v in rows.values()} == {"block", "allow"}
    monkeypatch.setattr(catalog, "build_cascade", lambda *_: Cascade([]))
    without = {r.page_id: (r.rule, r.verdict) for r in QUERIES["op4_url_cascade"](spark, SF_ORACLE).collect()}
    assert all(v == (None, "allow") for v in without.values()) and without != rows


def test_host_list_decides_pages_without_a_rule(spark, monkeypatch):
    rows = {r.page_id: (r.host, r.rule, r.verdict) for r in QUERIES["op4_url_cascade"](spark, SF_ORACLE).collect()}
    blocked = {h for h, rule, v in rows.values() if rule is None and v == "block"}
    assert "www.casino-win.example.org" in blocked and len(blocked) >= 3
    assert all("-" in h for h in blocked)  # no other host of the table is listed
    built = catalog.build_cascade
    monkeypatch.setattr(catalog, "build_cascade", lambda keys, key, listed: Cascade([]) if key == "host" else built(keys, key, listed))
    without = {r.page_id: (r.host, r.rule, r.verdict) for r in QUERIES["op4_url_cascade"](spark, SF_ORACLE).collect()}
    changed = [i for i in rows if rows[i] != without[i]]
    assert changed and all(rows[i][1] is None and without[i][2] == "allow" for i in changed)


def test_rules_by_cascade_equal_the_plain_form(spark):
    rules = [("net", "/"), ("example.net", "/en/"), ("a.example.net", "/e"), ("org", ""), ("x.org", "/fr/"), ("", "/p"), ("é.org", "/ü/")]
    hosts = ["net", "example.net", "b.a.example.net", "badnet", "org", "x.org", "y.x.org", "", ".", "a..net", "é.org", "z.é.org"]
    paths = ["", "/", "/e", "/en/", "/en/x", "/fr/", "/p", "/ü/é"]
    rows = spark.createDataFrame([(h, p) for h in hosts for p in paths], "host string, path string")
    rows = rows.withColumn("keys", rule_keys(F.col("host"), F.col("path"), rules))
    names = [own + start for own, start in rules]
    universe = rows.select(F.explode("keys").alias("key")).select("key", F.col("key").isin(names).alias("listed"))
    cascade = build_cascade(universe, "key", "listed")
    got = rows.select("*", first_listed(cascade, F.col("keys")).alias("got"), rule_of(F.col("host"), F.col("path"), rules).alias("want"))
    found = [(r.host, r.path, r.got, r.want) for r in got.collect()]
    assert [x for x in found if x[2] != x[3]] == []
    assert {x[2] is None for x in found} == {True, False}
