import math
import random

from conftest import SF_ORACLE
from fixtures import AWKWARD, CLASHES, awkward, empty
from harness import compare, duck
from tiermill.llm.catalog import ORACLE, QUERIES
from tiermill.llm.licenses import TEMPLATES, index_of, matches_of, plain, runs_of, scan_licenses


def test_query_equals_sql(spark):
    problems, n = compare(QUERIES["op8_license_scan"](spark, SF_ORACLE), duck(SF_ORACLE), ORACLE["op8_license_scan"])
    assert n == 1000 and not problems


def test_join_loses_no_match():
    rng = random.Random(4)
    words = sorted({w for _, t in TEMPLATES for w in plain(t.encode()).split()}) + [b"other", b"words", b"here"]
    for threshold in (0.5, 0.8, 0.9, 1.0):
        index = index_of(TEMPLATES, {w: rng.randrange(50) for w in words}, threshold)
        for _ in range(300):
            block = rng.sample(words, rng.randint(0, 40))
            want = [(t, len(set(block) & set(own))) for t, (_, own, _) in enumerate(index.templates)
                    if len(set(block) & set(own)) >= max(1, math.ceil(threshold * len(own) - 1e-9))]
            assert matches_of(block, index) == want


def test_places_and_labels(spark):
    texts = ["CC-BY cc by CC by", "All rights\nreserved. General public license!", "Licensed under CC BY-NC 4.0.\nx", "ccby all rights  Reserved"]
    rows = scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [[tuple(p) for p in r.places] for r in rows] == [
        [(0, "cc-by"), (2, "cc-by"), (4, "cc-by")], [(0, "reserved"), (3, "gpl")], [(2, "cc-by")], [(1, "reserved")]]
    assert [m.label for m in rows[2].matches] == ["cc-by-nc"] and rows[2].matches[0].containment == 1.0


def test_awkward_rows(spark):
    out = scan_licenses(awkward(spark))
    assert out.count() == len(AWKWARD) and set(CLASHES) <= set(out.columns)
    assert all(r.n_words == 0 for r in out.collect() if not (r.text or "").strip())
    assert scan_licenses(empty(spark)).collect() == []
    assert scan_licenses(awkward(spark), templates=(), phrases=()).where("size(matches) + size(places) > 0").count() == 0


WRAPPED = {
    "mit": "/* Permission is hereby granted, free of charge, to any person obtaining a copy\n * of this software and associated documentation files */",
    "bsd": "# Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided that the following\r\n# conditions are met:",
    "gpl": "This program is free software: you can redistribute it\nand/or modify it under the terms of the GNU General Public\nLicense as published by the Free Software Foundation",
    "mpl": "This Source Code Form is subject to the terms of\nthe Mozilla Public License,\n\nv. 2.0",
    "": "Permission is hereby granted, free of\nnobody obtaining copies of this software, to any person or charge",
}


def test_wrapped_notices(spark):
    given = [(f"{label} {k}", before + text + after) for label, text in WRAPPED.items()
             for k, (before, after) in enumerate([("", ""), ("Some words\nand a heading\n", "\nand what follows it."), ("x " * 500, "\n" + "y z " * 500)])]
    rows = scan_licenses(spark.createDataFrame(given, "doc_id string, text string")).collect()
    for r in rows:
        assert [m.label for m in r.matches] == [r.doc_id.split(" ")[0]] * (not r.doc_id.startswith(" ")), r.doc_id
        assert all(m.containment == 1.0 and r.text.split("\n")[m.block].split() for m in r.matches)


def test_several_wrapped_notices_stand_by_themselves(spark):
    text = "\n".join([WRAPPED["mit"], WRAPPED["mit"], WRAPPED["bsd"], "", WRAPPED["mit"].replace("\n", ""), WRAPPED["bsd"]])
    row = scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [(m.block, m.label) for m in row.matches] == [(0, "mit"), (2, "mit"), (4, "bsd"), (8, "mit"), (9, "bsd")]


def test_runs_lose_no_match():
    rng = random.Random(5)
    words = sorted({w for _, t in TEMPLATES for w in plain(t.encode()).split()}) + [b"other", b"here"]
    for threshold in (0.5, 0.8, 0.9):
        index = index_of(TEMPLATES, {w: rng.randrange(50) for w in words}, threshold)
        for _ in range(200):
            body = rng.choices(words, k=rng.randint(0, 60))
            for _ in range(rng.randint(0, 2)):
                notice = plain(rng.choice(TEMPLATES)[1].encode()).split()
                notice.insert(rng.randrange(len(notice)), b"dnl")
                body[(at := rng.randint(0, len(body))):at] = notice
            best = {}
            for t, (_, own, need) in enumerate(index.templates):
                size = index.runs[t]
                most = max(len(set(own) & set(body[i:i + size])) for i in range(len(body) + 1))
                if most >= need:
                    best[t] = most
            got = runs_of(body, index)
            assert {t: max(x[3] for x in got if x[0] == t) for t, *_ in got} == best
            assert all(len(set(body[a:b]) & set(index.templates[t][1])) == n and b - a <= index.runs[t] for t, a, b, n in got)
