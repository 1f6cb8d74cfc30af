"""License scan: an exact set-similarity join of text blocks and templates.

A block is a line of a document, or a run of consecutive words about as long as
the template, wherever lines end; a template is a short licence text; both are
sets of words.  A block matches when it holds at least ``threshold`` of a
template's words.  Words are ordered by their frequency over all documents, rarest first.
To reach overlap ``need`` with a template of n words, a block must hold one of
the template's first ``n - need + 1`` words (prefix filter), at least ``need``
words (length filter), and after the first shared word enough words must be left
on both sides (positional filter).  Blocks that pass are verified.  Runs are laid
only around prefix words, where enough of the template's words are near.

The templates are a parameter, so their index, one row a template word, is as
small as the given list and goes to the tasks with the code.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.llm.common import fresh, text_slices

#: (label, text): notices by which licences are commonly stated.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
)

#: Phrases whose words, standing consecutively, give a label by themselves.
PHRASES: tuple[tuple[str, str], ...] = (
    ("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

#: After A-Z are lower-cased, every ASCII byte but digits and letters parts words.
_PARTS = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x0A if b == 0x0A else 0x20 for b in range(256))

MATCH = "array<struct<block:int,template:int,label:string,overlap:int,containment:double>>"


def plain(text: bytes) -> bytes:
    """Lower-cased text in which white space parts words; line ends stay."""
    return text.lower().translate(_PARTS)


def word_frequency(df: DataFrame, words: set[bytes], text: str = "text") -> Counter:
    """In how many documents each of the given words stands, over all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for b in batches:
            for _, _, texts in text_slices(b.column(0)):
                for body in texts:
                    if body:
                        seen.update(words.intersection(plain(body).split()))
        yield pa.RecordBatch.from_pandas(pd.DataFrame({"word": [w.decode() for w in seen], "n": list(seen.values())}, dtype=None)
                                         .astype({"word": "string", "n": "int64"}), schema=pa.schema([("word", pa.string()), ("n", pa.int64())]))

    rows = df.select(F.col(text)).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    return Counter({r[0].encode(): r[1] for r in rows})


@dataclass
class Index:
    templates: list[tuple[str, list[bytes], int]]  # label, words rarest first, least overlap
    prefix: dict[bytes, list[tuple[int, int]]]  # word -> (template, place) within the prefixes
    place: dict[bytes, int]  # global order of all template words
    runs: list[int]  # words of a run: the template's, and what the threshold lets through besides


def index_of(templates: tuple[tuple[str, str], ...], frequency: Counter, threshold: float) -> Index:
    """Prefix index of the templates under the global order."""
    sets = [(label, plain(text.encode()).split()) for label, text in templates]
    order = sorted(set().union(*(s for _, s in sets)) if sets else set(), key=lambda w: (frequency[w], w))
    place = {w: i for i, w in enumerate(order)}
    built, prefix, runs = [], {}, []
    for label, words in sets:
        if not words:
            continue
        own = sorted(set(words), key=place.__getitem__)
        need = max(1, math.ceil(threshold * len(own) - 1e-9))
        for i, w in enumerate(own[:len(own) - need + 1]):
            prefix.setdefault(w, []).append((len(built), i))
        built.append((label, own, need))
        runs.append(max(len(words), math.ceil(len(words) / threshold - 1e-9)))
    return Index(built, prefix, place, runs)


def matches_of(block: list[bytes], index: Index) -> list[tuple[int, int]]:
    """(template, overlap) of every template that the block's words meet."""
    words = set(block)
    hits = words & index.prefix.keys()
    if not hits:
        return []
    own = sorted((w for w in words if w in index.place), key=index.place.__getitem__)
    at = {w: j for j, w in enumerate(own)}
    first: dict[int, tuple[int, int]] = {}  # the rarest shared word of each candidate
    for w in hits:
        for t, i in index.prefix[w]:
            if t not in first or i < first[t][0]:
                first[t] = (i, at[w])
    found = []
    for t, (i, j) in sorted(first.items()):
        _, template, need = index.templates[t]
        if len(words) >= need and 1 + min(len(template) - i - 1, len(own) - j - 1) >= need:
            overlap = sum(w in words for w in template)
            if overlap >= need:
                found.append((t, overlap))
    return found


def _end(words: list[bytes], spots: list[int], i: int, n: int, step: int) -> int:
    """The index after (or before) the shortest stretch of ``spots`` from ``i``
    that holds ``n`` different words."""
    seen: set[bytes] = set()
    while len(seen) < n:
        seen.add(words[spots[i]])
        i += step
    return i


def runs_of(words: list[bytes], index: Index) -> list[tuple[int, int, int, int]]:
    """(template, first word, end, overlap) of the runs that meet a template, cut
    to the words they need.  A run gives way to a fuller one that begins inside
    it; the next one begins where it ends."""
    at: dict[int, list[int]] = {}  # places of each candidate's prefix words
    for p, w in enumerate(words):
        for t, _ in index.prefix.get(w, ()):
            at.setdefault(t, []).append(p)
    found = []
    for t, heads in sorted(at.items()):
        _, template, need = index.templates[t]
        own, size = set(template), index.runs[t]
        near: list[list[int]] = []
        for p in heads:
            if near and p - size < near[-1][1]:
                near[-1][1] = p + size
            else:
                near.append([max(0, p - size + 1), p + size])
        for start, end in near:
            spots = [p for p in range(start, min(end, len(words))) if words[p] in own]
            if len({words[p] for p in spots}) < need:
                continue
            full = []  # overlap of the run that begins at each of the template's words
            held: Counter = Counter()
            j = 0
            for p in spots:
                while j < len(spots) and spots[j] < p + size:
                    held[words[spots[j]]] += 1
                    j += 1
                full.append(len(held))
                held[words[p]] -= 1
                if not held[words[p]]:
                    del held[words[p]]
            i = 0
            while i < len(spots):
                if full[i] < need:
                    i += 1
                    continue
                k, j = i, _end(words, spots, i, full[i], 1)
                while (fuller := max(range(k, j), key=lambda x: (full[x], -x))) != k:
                    k, j = fuller, _end(words, spots, fuller, full[fuller], 1)
                first = _end(words, spots, j - 1, full[k], -1) + 1
                found.append((t, spots[first], spots[j - 1] + 1, full[k]))
                i = j
    return found


def phrase_places(words: list[bytes], phrases: list[bytes]) -> list[tuple[int, int]]:
    """(first word, phrase) of every place where a phrase's words stand."""
    line = b" " + b" ".join(words) + b" "
    found = []
    for p, phrase in enumerate(phrases):
        at = line.find(b" " + phrase + b" ")
        while at >= 0:
            found.append((line.count(b" ", 0, at), p))
            at = line.find(b" " + phrase + b" ", at + 1)
    return sorted(found)


def scan_licenses(df: DataFrame, text: str = "text", templates: tuple[tuple[str, str], ...] = TEMPLATES,
                  phrases: tuple[tuple[str, str], ...] = PHRASES, threshold: float = 0.9) -> DataFrame:
    """Add to every row of ``df``: n_words, ``matches`` (every block and template
    that meet the threshold) and ``places`` (word, label) of the phrases.  The
    number of a block is that of its (first) line.  A run over several lines is
    a match if it holds more of the template than each line it touches that
    matches by itself.

    Null and empty texts have no words, matches or places.  Columns of the names
    added are replaced; all others pass through."""
    vocabulary = set().union(*(plain(t.encode()).split() for _, t in templates)) if templates else set()
    index = index_of(templates, word_frequency(df, vocabulary, text), threshold)
    spoken = [b" ".join(plain(p.encode()).split()) for p, _ in phrases]
    added = ("n_words", "matches", "places")
    body_ = fresh(df, "_text_")
    keep = [f for f in df.schema if f.name not in added]
    names = [f.name for f in keep]
    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in keep] + [
        "n_words long", f"matches {MATCH}", "places array<struct<word:long,label:string>>"]
    kinds = [pa.int64(), pa.list_(pa.struct([("block", pa.int32()), ("template", pa.int32()), ("label", pa.string()),
                                             ("overlap", pa.int32()), ("containment", pa.float64())])),
             pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())]))]

    def scan(body: bytes) -> tuple[int, list[dict], list[dict]]:
        clean = plain(body)
        words = clean.split()
        found = []
        if not index.prefix.keys().isdisjoint(words):
            lines = [line.split() for line in clean.split(b"\n")]
            met = {(k, t): overlap for k, line in enumerate(lines) for t, overlap in matches_of(line, index)}
            ends = list(accumulate(map(len, lines)))
            for t, start, end, overlap in runs_of(words, index):
                first, last = bisect_right(ends, start), bisect_right(ends, end - 1)
                if first < last and overlap > max(met.get((k, t), 0) for k in range(first, last + 1)):
                    met[first, t] = overlap
            for (k, t), overlap in sorted(met.items()):
                label, own, _ = index.templates[t]
                found.append({"block": k, "template": t, "label": label, "overlap": overlap, "containment": overlap / len(own)})
        return len(words), found, [{"word": w, "label": phrases[p][1]} for w, p in phrase_places(words, spoken)]

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [scan(body or b"") for _, _, texts in text_slices(b.column(body_)) for body in texts]
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), *columns], names=[*names, *added])

    return df.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{text}`").alias(body_)).mapInArrow(scanned, ",".join(schema))
