"""Content and boilerplate lines by a linear-chain conditional random field.

The lines of a document that hold a word are one chain.  A line is described by
its own looks (length, symbols, capitals, digits, separators, repetition), and
by the looks of no other line: what its neighbours say reaches it through the
learned transitions.  Labels are per document, so every line of a training
document takes its document's label, and training chains are spliced from
stretches of lines of differently labelled documents.  Viterbi decoding marks each line; the
share of words that stand in content lines decides whether a document stays.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.llm.common import fresh, text_slices, window_hashes, word_hashes
from tiermill.llm.crf import Chain, fit, viterbi

#: Labelled documents to learn from, expected of each label.
SAMPLE_PER_LABEL = 400
#: Least share of words in content lines for a document to stay.
CONTENT_SHARE = 0.5

_SYMBOLS = b"#*$%&|<>"
_SPACE = b"\x20\x09\x0A\x0B\x0C\x0D"
_CAPS, _SMALL = bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B))
_DIGITS, _STOPS = b"0123456789", b".,;:?"
_INNER = bytes(range(0x80, 0xC0))  # UTF-8 bytes that start no code point
#: Kinds of look and the values each can take.
LOOKS, VALUES = 9, 12


@dataclass
class Model:
    weights: np.ndarray
    chain: Chain


def _share(part: int, whole: int) -> int:
    """Share in tenths, from 0 to 10; any part counts."""
    return 0 if not part else max(1, min(10, part * 10 // max(1, whole)))


def _count(text: bytes, kinds: bytes) -> int:
    return len(text) - len(text.translate(None, kinds))


def look(line: bytes, words: list[bytes], seen: bool) -> list[int]:
    """The discrete looks of a line."""
    n, symbols = len(words), _count(line, _SYMBOLS)
    chars = len(line) - _count(line, _SPACE)
    caps = _count(line, _CAPS)
    return [
        min(10, n.bit_length()),
        _share(symbols, chars),
        _share(sum(_count(w, _SYMBOLS) > 0 for w in words), n) if symbols else 0,
        _share(caps, caps + _count(line, _SMALL)),
        _share(_count(line, _DIGITS), chars),
        _share(line.count(b"!"), n),
        _share(n - len(set(words)), n),
        _share(_count(line, _STOPS), n),
        int(seen),
    ]


def lines_of(text: bytes) -> tuple[list[list[int]], list[int]]:
    """Looks and word counts of the lines that hold a word."""
    looks, sizes, seen = [], [], set()
    for line in text.split(b"\n"):
        words = line.split()
        if words:
            looks.append(look(line, words, line in seen))
            sizes.append(len(words))
            seen.add(line)
    return looks, sizes


def _numbers(looks: list[list[int]]) -> np.ndarray:
    """Feature numbers, one for each look and value; 0 is kept for padding."""
    x = np.array(looks, dtype=np.int64).reshape(-1, LOOKS)
    return 1 + np.arange(LOOKS) * VALUES + x


def splices(counts: list[int], labels: list[int], switch: float, chain_lines: int, seed: int) -> list[list[tuple[int, int]]]:
    """Chains of (document, line), each line of each document once and in its
    order.  After a line, ``switch`` is the chance that the chain goes on in a document
    of another label, if one is left."""
    rng = np.random.default_rng(seed)
    queues: dict[int, list[int]] = {}
    for d in rng.permutation(len(counts)).tolist():
        if counts[d]:
            queues.setdefault(labels[d], []).append(d)
    at = [0] * len(counts)
    chains: list[list[tuple[int, int]]] = []
    while any(queues.values()):
        chain: list[tuple[int, int]] = []
        label = max(queues, key=lambda k: len(queues[k]))
        while len(chain) < chain_lines and any(queues.values()):
            if not queues[label] or rng.random() < switch:
                label = next((k for k in queues if k != label and queues[k]), label)
            d = queues[label][-1]
            chain.append((d, at[d]))
            at[d] += 1
            if at[d] == counts[d]:
                queues[label].pop()
        chains.append(chain)
    return chains


def train(rows: list[tuple[str, int]], switch: float = 0.15, chain_lines: int = 200, seed: int = 13) -> Model:
    """Fit on (text, label) rows; label 1 is content."""
    own = [lines_of(text.encode())[0] for text, _ in rows]
    chains = splices([len(x) for x in own], [int(label) for _, label in rows], switch, chain_lines, seed)
    looks = [own[d][i] for chain in chains for d, i in chain]
    labels = [int(rows[d][1]) for chain in chains for d, _ in chain]
    counts = [len(chain) for chain in chains]
    kinds, items = np.unique(_numbers(looks), axis=0, return_inverse=True) if looks else (np.zeros((0, LOOKS), int), np.zeros(0, int))
    return Model(*fit(items.ravel(), kinds, np.array(labels, dtype=np.int64), np.array(counts, dtype=np.int64),
                      1 + LOOKS * VALUES, 2, rounds=12, parts=8))


def training_rows(df: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text", doc_id: str = "doc_id",
                  per_label: int = SAMPLE_PER_LABEL) -> list[tuple[str, int]]:
    """About ``per_label`` labelled documents of each label (0 and 1), chosen by
    the hash of their ids.  The ids drawn pass the driver, and are a filter of the texts."""
    known = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull()).select(
        F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_label"))
    counts = {r[0]: r[1] for r in known.groupBy("_label").count().collect()}
    rate = F.lit(0.0)
    for k, n in counts.items():
        rate = F.when(F.col("_label") == k, F.lit(min(1.0, per_label / n))).otherwise(rate)
    drawn = known.where(F.pmod(F.xxhash64("_id", F.lit("quality")), F.lit(1 << 40)) < rate * (1 << 40))
    labels_of: dict = {}
    for r in drawn.distinct().collect():
        labels_of.setdefault(r[0], []).append(r[1])
    if not labels_of:
        return []
    found = df.where(F.col(text).isNotNull() & F.col(doc_id).isin(list(labels_of))).select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).collect()
    return [(t, label) for i, t in sorted(map(tuple, found), key=lambda r: (str(r[0]), r[1])) for label in sorted(labels_of[i])]


def fit_quality(df: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text", doc_id: str = "doc_id",
                per_label: int = SAMPLE_PER_LABEL) -> Model:
    """Learn from a bounded sample of the labelled documents."""
    return train(training_rows(df, labels, label, text, doc_id, per_label))


def repeated_words(words: np.ndarray, counts: np.ndarray, size: int = 8) -> np.ndarray:
    """For each document, its words inside windows of ``size`` words that occur
    twice or more in the same document."""
    out = np.zeros(len(counts), dtype=np.int64)
    if len(words) < size:
        return out
    doc = np.repeat(np.arange(len(counts)), counts)
    h = window_hashes(words, size)
    inside = doc[:len(h)] == doc[size - 1:]
    at = np.flatnonzero(inside)
    order = np.lexsort((h[at], doc[at]))
    h, d = h[at][order], doc[at][order]
    same = (h[1:] == h[:-1]) & (d[1:] == d[:-1])
    twice = np.zeros(len(h), dtype=bool)
    twice[1:] |= same
    twice[:-1] |= same
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    hit = at[order][twice]
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + size, -1)
    covered = np.cumsum(edge[:-1]) > 0
    return np.bincount(doc, weights=covered, minlength=len(counts)).astype(np.int64)


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_content_words", "lines")


def judge(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add the counts and the labelled lines to every row of ``df``.

    ``lines`` holds one boolean for each line with a word, true for content;
    ``n_content_words`` are the words of those lines.  Null and empty texts
    have no words, no lines and zero counts.  Columns of the names added are
    replaced; all others pass through."""
    body_ = fresh(df, "_text_")
    keep = [f for f in df.schema if f.name not in COLUMNS]
    names = [f.name for f in keep]
    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in keep] + [f"{c} long" for c in COLUMNS[:-1]] + ["lines array<boolean>"]

    def own(raw: list[bytes | None]) -> list[list]:
        hashes, n_words = word_hashes(raw)
        repeat = repeated_words(hashes, n_words)
        chars, symbols, dups = [], [], []
        looks: list[list[int]] = []
        sizes: list[int] = []
        counts = np.zeros(len(raw), dtype=np.int64)
        for i, body in enumerate(raw):
            body = body or b""
            found, n = lines_of(body)
            looks += found
            sizes += n
            counts[i] = len(found)
            dups.append(sum(x[-1] for x in found))
            symbols.append(_count(body, _SYMBOLS))
            chars.append(len(body.translate(None, _SPACE + _INNER)))
        marked = np.zeros(0, dtype=np.int64)
        if looks:
            kinds, items = np.unique(_numbers(looks), axis=0, return_inverse=True)
            marked = viterbi(model.weights[kinds].sum(axis=1)[items.ravel()], counts, model.chain)
        doc = np.repeat(np.arange(len(raw)), counts)
        content = np.bincount(doc, weights=marked * np.array(sizes, dtype=np.int64), minlength=len(raw)).astype(np.int64)
        ends = np.cumsum(counts)
        labels = [marked[e - c:e].astype(bool) for e, c in zip(ends, counts, strict=True)]
        return [n_words.tolist(), chars, symbols, dups, repeat.tolist(), counts.tolist(), content.tolist(), labels]

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns: list[list] = [[] for _ in COLUMNS]
            for _, _, raw in text_slices(b.column(body_)):
                for c, v in zip(columns, own(raw), strict=True):
                    c += v
            kinds = [pa.int64()] * (len(COLUMNS) - 1) + [pa.list_(pa.bool_())]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), *map(pa.array, columns, kinds)], names=[*names, *COLUMNS])

    return df.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{text}`").alias(body_)).mapInArrow(judged, ",".join(schema))
