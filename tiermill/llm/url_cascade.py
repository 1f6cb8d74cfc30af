"""URL filter by a cascade of Bloom filters.

The keys of the corpus are known completely (the universe), and a part of them
is listed.  Level 1 holds the listed keys; the keys outside the list that it
wrongly admits go into level 2; the listed keys that level 2 wrongly admits go
into level 3, and so on until a level admits nothing wrongly.  A key of the
universe is listed exactly if the first level that rejects it is an even one
(or, past the last level, if their number is odd).  Membership is then a look at
bits within each task: no join and no list of keys.

The cascade takes about ``BITS`` bits a listed key in the first level and less
than twice that in all.  It is sent to the tasks, so its size is checked against
``max_bytes`` before any level is built.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermill.llm.common import cut, mix

#: Most bytes that the levels may take together.
MAX_BYTES = 64 << 20


@dataclass
class Level:
    bits: np.ndarray  # uint64 words
    size: int  # bits
    hashes: int

    def holds(self, a: np.ndarray, b: np.ndarray, level: int) -> np.ndarray:
        """Whether all bits of each key (two 64-bit hashes) are set."""
        out = np.ones(len(a), dtype=bool)
        for at in places(a, b, level, self.size, self.hashes):
            out &= (self.bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return out


def places(a: np.ndarray, b: np.ndarray, level: int, size: int, hashes: int) -> list[np.ndarray]:
    """Bits of each key by double hashing, independent between levels."""
    with np.errstate(over="ignore"):
        x = mix(a.view(np.uint64) + np.uint64(level) * np.uint64(0x9E3779B97F4A7C15))
        y = mix(b.view(np.uint64) ^ np.uint64(level)) | np.uint64(1)
        return [mix(x + np.uint64(i) * y) % np.uint64(size) for i in range(hashes)]


def _shape(keys: int, rate: float) -> tuple[int, int]:
    """Bits and hash functions for ``keys`` keys at a false-positive rate."""
    size = max(64, math.ceil(-keys * math.log(rate) / math.log(2) ** 2 / 64) * 64)
    return size, max(1, round(-math.log2(rate)))


@dataclass
class Cascade:
    levels: list[Level]

    def listed(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Exact membership for keys of the universe it was built over."""
        out = np.zeros(len(a), dtype=bool)
        left = np.arange(len(a))
        for k, level in enumerate(self.levels):
            held = level.holds(a[left], b[left], k)
            out[left[~held]] = k % 2 == 1
            left = left[held]
        out[left] = len(self.levels) % 2 == 1
        return out


def key_hashes(key: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes of a key; together they stand for it."""
    return F.xxhash64(key, F.lit("a")), F.xxhash64(F.lit("b"), key)


def build_cascade(universe: DataFrame, key: str, listed: str, max_bytes: int = MAX_BYTES) -> Cascade:
    """Cascade over ``universe``: rows with a key and whether it is listed.

    Repeated keys count once; a key that is listed in any row is listed.  Null
    keys are left out.  An empty list gives a cascade without levels.  Raises
    ValueError if the list is too long for ``max_bytes``."""
    a, b = key_hashes(F.col(key))
    keys = cut(universe.where(F.col(key).isNotNull()).select(a.alias("a"), b.alias("b"), F.col(listed).alias("listed"))
               .groupBy("a", "b").agg(F.max("listed").alias("listed")))
    counts = {bool(r[0]): r[1] for r in keys.groupBy("listed").count().collect()}
    inside, outside = counts.get(True, 0), counts.get(False, 0)
    levels: list[Level] = []
    if not inside:
        return Cascade(levels)
    # The first level lets about inside * sqrt(1/2) keys through wrongly, each later one half of its keys.
    rate = min(0.5, inside * math.sqrt(0.5) / max(1, outside))
    if 2 * _shape(inside, rate)[0] + 16 * inside > 8 * max_bytes:
        raise ValueError(f"{inside} listed keys of {inside + outside} need more than {max_bytes} bytes")
    of_level, n = True, inside
    while n:
        k = len(levels)
        size, hashes = _shape(n, rate if k == 0 else 0.5)
        done = Cascade(list(levels))

        def set_bits(batches: Iterator[pd.DataFrame], done=done, k=k, size=size, hashes=hashes, of_level=of_level) -> Iterator[pd.DataFrame]:
            """Words of the level's bits, one row a word and batch."""
            for p in batches:
                x, y = p["a"].to_numpy(), p["b"].to_numpy()
                own = p["listed"].to_numpy(dtype=bool) == of_level
                x, y = x[own], y[own]
                for i, level in enumerate(done.levels):
                    held = level.holds(x, y, i)
                    x, y = x[held], y[held]
                at = np.unique(np.concatenate([*places(x, y, k, size, hashes)]))
                word, start = np.unique(at >> np.uint64(6), return_index=True)
                bit = np.uint64(1) << (at & np.uint64(63))
                value = np.bitwise_or.reduceat(bit, start) if len(at) else bit
                yield pd.DataFrame({"word": word.astype(np.int64), "value": value.view(np.int64)})

        rows = keys.mapInPandas(set_bits, "word long, value long").groupBy("word").agg(F.bit_or("value").alias("value")).toPandas()
        bits = np.zeros(size // 64, dtype=np.int64)
        bits[rows["word"].to_numpy()] = rows["value"].to_numpy()
        levels.append(Level(bits.view(np.uint64), size, hashes))
        of_level = not of_level
        n = keys.mapInPandas(_admitted(Cascade(list(levels)), of_level), "n long").agg(F.sum("n")).first()[0] or 0
        if k >= 200:
            raise ValueError("two keys share both hashes")
    return Cascade(levels)


def _admitted(cascade: Cascade, of_level: bool):
    """Counts the keys of one kind that pass every level."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = 0
        for p in batches:
            own = p["listed"].to_numpy(dtype=bool) == of_level
            x, y = p["a"].to_numpy()[own], p["b"].to_numpy()[own]
            for i, level in enumerate(cascade.levels):
                held = level.holds(x, y, i)
                x, y = x[held], y[held]
            n += len(x)
        yield pd.DataFrame({"n": [n]})

    return count


def is_listed(cascade: Cascade, key: Column) -> Column:
    """Exact membership of a key of the universe; null for a null key."""

    @F.pandas_udf("boolean")
    def look(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(cascade.listed(a.to_numpy(), b.to_numpy()))

    return F.when(key.isNotNull(), look(*key_hashes(key)))


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_keys(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The keys, host + path, of every rule that could fit: the host and each
    parent domain, with each start of the path as long as that of some rule.
    The longest key stands first, in the order of ``rule_of``."""
    labels = F.split(host, r"\.")
    owns = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    starts = F.filter(F.array(*[F.when(F.char_length(path) >= n, F.substring(path, 1, n)) for n in sorted({len(start) for _, start in rules})]),
                      lambda x: x.isNotNull()) if rules else F.array().cast("array<string>")
    both = F.flatten(F.transform(owns, lambda own: F.transform(starts, lambda start: F.struct(
        (F.char_length(own) + F.char_length(start)).alias("n"), own.alias("own"), start.alias("start")))))
    return F.transform(F.sort_array(both, asc=False), lambda x: F.concat(x["own"], x["start"]))


def first_listed(cascade: Cascade, keys: Column) -> Column:
    """The first listed key of an array of keys of the universe, else null."""

    @F.pandas_udf("int")
    def look(a: pd.Series, b: pd.Series) -> pd.Series:
        n = a.map(len).to_numpy()
        out = np.zeros(len(n), dtype=np.int32)
        if n.sum():
            held = cascade.listed(np.concatenate(a.to_list()).astype(np.int64), np.concatenate(b.to_list()).astype(np.int64))
            row = np.repeat(np.arange(len(n)), n)
            place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + 1
            row, first = np.unique(row[held], return_index=True)
            out[row] = place[held][first]
        return pd.Series(out)

    at = look(F.transform(keys, lambda x: key_hashes(x)[0]), F.transform(keys, lambda x: key_hashes(x)[1]))
    return F.get(keys, at - 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest (host, path) rule, as host + path, that fits; else null.  A
    rule fits its host and all subdomains, if the path starts with the rule's."""
    out = F.lit(None).cast("string")
    for own, start in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), r)):
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(start)
        out = F.when(fits, F.lit(own + start)).otherwise(out)
    return out
