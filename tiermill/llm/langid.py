"""Language of each word by a linear-chain conditional random field.

The words of a text are one chain.  A word's features are its letter n-grams
with word borders, its affixes and, if the training words know it, the word
itself; transitions between languages are learned on training chains spliced
from lines of different documents, since labels are per document.
Forward-backward gives each word's language probabilities; the document takes
the language that its words with a letter hold most of.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermill.llm.common import fresh, hash_words, mix, text_slices
from tiermill.llm.crf import Chain, Ragged, fit, marginals

#: Labelled documents to learn from, expected for each language.
SAMPLE_PER_LANG = 200
#: Feature numbers of n-grams and affixes; as many again for known words.
BUCKETS = 1 << 16
#: Text in bytes whose chains are worked on together.
CHAIN_BYTES = 1 << 20

_LETTER = re.compile(r"[^\W\d_]")


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray  # (2 * BUCKETS, languages)
    lexicon: np.ndarray  # sorted hashes of known words
    chain: Chain


def _ngrams(words: list[bytes]) -> np.ndarray:
    """Feature numbers, 0 where there is none: all 2- and 3-grams of the word
    between borders, its first and last four bytes."""
    n, width = len(words), max(map(len, words)) + 2
    flat = np.frombuffer(b"".join(b" " + w + b" " * (width - 1 - len(w)) for w in words), dtype=np.uint8)
    x = flat.reshape(n, width).astype(np.uint64)
    length = np.array([len(w) + 2 for w in words])
    out = []
    place = np.arange(width)
    for size in (2, 3):
        if width < size:
            continue
        h = np.zeros((n, width - size + 1), dtype=np.uint64)
        for i in range(size):
            h = h * np.uint64(257) + x[:, i:i + width - size + 1]
        f = mix(h + np.uint64(size << 40)) % np.uint64(BUCKETS - 1) + np.uint64(1)
        out.append(np.where(place[None, :width - size + 1] + size <= length[:, None], f, 0))
    for tag, at in ((5, np.zeros(n, dtype=np.int64)), (6, np.maximum(length - 5, 0))):
        h = np.zeros(n, dtype=np.uint64)
        for i in range(5):
            h = h * np.uint64(257) + x[np.arange(n), np.minimum(at + i, width - 1)]
        out.append((mix(h + np.uint64(tag << 48)) % np.uint64(BUCKETS - 1) + np.uint64(1))[:, None])
    return np.concatenate(out, axis=1).astype(np.int64)


def _known(hashes: np.ndarray, lexicon: np.ndarray) -> np.ndarray:
    """Feature number of a known word, else 0."""
    if not len(lexicon):
        return np.zeros(len(hashes), dtype=np.int64)
    at = np.minimum(np.searchsorted(lexicon, hashes), len(lexicon) - 1)
    return np.where(lexicon[at] == hashes, BUCKETS + 1 + (hashes % np.uint64(BUCKETS - 1)).astype(np.int64), 0)


def _blocks(words: list[bytes]) -> Iterator[list[int]]:
    """Places of the words, shortest first, as many at once as a bounded matrix takes."""
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    i = 0
    while i < len(order):
        j = i + 1
        while j < len(order) and (j - i + 1) * (len(words[order[j]]) + 2) <= 1 << 18:
            j += 1
        yield order[i:j]
        i = j


def _scores(words: list[bytes], hashes: np.ndarray, model: Model) -> np.ndarray:
    """Emission scores of distinct words, a bounded matrix at a time."""
    out = np.empty((len(words), len(model.langs)))
    for own in _blocks(words):
        feats = _ngrams([words[r] for r in own])
        total = np.zeros((len(own), len(model.langs)))
        for c in range(0, feats.shape[1], 16):
            total += model.weights[feats[:, c:c + 16]].sum(axis=1)
        out[own] = total + model.weights[_known(hashes[own], model.lexicon)]
    return out


def _features(words: list[bytes], hashes: np.ndarray, lexicon: np.ndarray) -> Ragged:
    """All features of distinct words, whatever their length."""
    known = _known(hashes, lexicon)
    parts: list[np.ndarray] = [np.zeros(0, dtype=np.int64)] * len(words)
    for own in _blocks(words):
        for r, row in zip(own, _ngrams([words[r] for r in own]), strict=True):
            parts[r] = np.append(row, known[r])
            parts[r] = parts[r][parts[r] > 0]
    return Ragged(np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64), np.array([len(x) for x in parts], dtype=np.int64))


def train(rows: list[tuple[str, str]], switch: float = 0.15, chain_words: int = 200, seed: int = 11) -> Model:
    """Fit on (text, language) rows.  Chains of about ``chain_words`` words are
    spliced from lines; after a line, ``switch`` is the chance that the chain
    goes on in another document."""
    langs = sorted({lang for _, lang in rows})
    lines: list[list[list[bytes]]] = []
    for text, _ in rows:
        lines.append([w for w in (x.lower().split() for x in text.encode().split(b"\n")) if w])
    labels = [langs.index(lang) for _, lang in rows]
    rng = np.random.default_rng(seed)
    at, left = [0] * len(rows), {i for i, x in enumerate(lines) if x}
    words: list[bytes] = []
    tags: list[int] = []
    counts: list[int] = []
    while left:
        pool = sorted(left)
        rng.shuffle(pool)
        doc, size = pool[0], 0
        while True:
            line = lines[doc][at[doc]]
            words += line
            tags += [labels[doc]] * len(line)
            size += len(line)
            at[doc] += 1
            done = at[doc] == len(lines[doc])
            if done:
                left.discard(doc)
            if size >= chain_words or not left:
                break
            if done or rng.random() < switch:
                doc = pool[int(rng.integers(len(pool)))]
                if doc not in left:
                    break
        counts.append(size)
    index: dict[bytes, int] = {}
    items = np.array([index.setdefault(w, len(index)) for w in words], dtype=np.int64)
    kinds = list(index)
    seen = np.bincount(items, minlength=len(kinds))
    hashes = hash_words(kinds)
    lexicon = np.unique(hashes[seen >= 3])
    weights, chain = fit(items, _features(kinds, hashes, lexicon), np.array(tags, dtype=np.int64), np.array(counts, dtype=np.int64),
                         2 * BUCKETS, max(1, len(langs)), rounds=4, parts=8)
    return Model(langs, weights, lexicon, chain)


def training_rows(df: DataFrame, text: str, lang: str, doc_id: str, usable: Column,
                  per_lang: int = SAMPLE_PER_LANG) -> list[tuple[str, str]]:
    """About ``per_lang`` labelled rows of each language, chosen by the hash of
    their ids.  The languages must be few: one count a language passes the driver."""
    labelled = df.where(usable & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(doc_id).alias("_id"), F.col(text).alias("_text"), F.col(lang).alias("_lang"))
    counts = {r[0]: r[1] for r in labelled.groupBy("_lang").count().collect()}
    if not counts:
        return []
    share = F.create_map(*[F.lit(v) for k, n in counts.items() for v in (k, min(1.0, per_lang / n))])
    drawn = F.pmod(F.xxhash64("_id", F.lit("langid")), F.lit(1 << 40)) < F.element_at(share, F.col("_lang")) * (1 << 40)
    return [(r[1], r[2]) for r in sorted(labelled.where(drawn).collect(), key=lambda r: (str(r[0]), r[2], r[1]))]


def label_language(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add lang_pred and score to every row of ``df``.

    ``score`` is the mean probability of the predicted language over the words
    that have a letter.  Null text, text without a letter and any text under a
    model that learned no language give ``und`` with score 0.  Columns of these
    two names are replaced; all others pass through."""
    body_ = fresh(df, "_text_")
    keep = [c for c in df.columns if c not in ("lang_pred", "score")]
    schema = ",".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name in keep)

    def own(texts: list[bytes | None]) -> tuple[list[str], list[float]]:
        names, scores = ["und"] * len(texts), [0.0] * len(texts)
        if not model.langs:
            return names, scores
        index: dict[bytes, int] = {}
        items: list[int] = []
        counts = np.zeros(len(texts), dtype=np.int64)
        for i, body in enumerate(texts):
            if body and _LETTER.search(body.decode()):
                words = body.lower().split()
                counts[i] = len(words)
                items += [index.setdefault(w, len(index)) for w in words]
        if not items:
            return names, scores
        kinds = list(index)
        lettered = np.array([bool(_LETTER.search(w.decode())) for w in kinds])
        at = np.array(items)
        gamma, _ = marginals(_scores(kinds, hash_words(kinds), model)[at], counts, model.chain)
        gamma *= lettered[at][:, None]
        doc = np.repeat(np.arange(len(texts)), counts)
        held = np.stack([np.bincount(doc, weights=gamma[:, k], minlength=len(texts)) for k in range(gamma.shape[1])], 1)
        n = np.bincount(doc, weights=lettered[at], minlength=len(texts))
        for i in np.flatnonzero(n):
            k = int(held[i].argmax())
            names[i], scores[i] = model.langs[k], float(min(1.0, held[i, k] / n[i]))
        return names, scores

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, scores = [], []
            for _, _, texts in text_slices(b.column(body_), CHAIN_BYTES):
                n, s = own(texts)
                names += n
                scores += s
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                             names=[*keep, "lang_pred", "score"])

    return df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias(body_)).mapInArrow(
        label, ",".join(x for x in (schema, "lang_pred string", "score double") if x))


def fit_languages(df: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id",
                  usable: Column | None = None, per_lang: int = SAMPLE_PER_LANG) -> Model:
    """Learn from a bounded sample of the labelled rows that ``usable`` admits."""
    return train(training_rows(df, text, lang, doc_id, F.lit(True) if usable is None else usable, per_lang))
