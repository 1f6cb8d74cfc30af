"""Bloom filters over keys: orphans without a join where the filter says no, and
a unique check of appended rows that reads only the partitions it must.

A filter is a list of 64-bit words.  A key has one word and four bits in it, all
from one hash, so filters are built by ``bit_or`` per word (a partial aggregate)
and two filters of one size merge the same way.  A key whose bits are not all set
was never added; any other key may have been.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quality import orphans
from .snapshots import PART, StoredTable, append

#: Most bytes of a filter that is sent to the tasks, and keys a word at most.
MAX_FILTER_BYTES = 8 << 20
KEYS_PER_WORD = 4


def _hash(key: Column) -> Column:
    # salted: the partition of a stored table comes from the plain hash
    return F.xxhash64(key, F.lit(1))


def _word(key: Column, words: int) -> Column:
    return F.shiftrightunsigned(_hash(key), 24).bitwiseAND(F.lit(words - 1).cast("bigint"))


def _mask(key: Column) -> Column:
    def bit(k: int) -> Column:
        place = F.shiftrightunsigned(_hash(key), 6 * k).bitwiseAND(F.lit(63).cast("bigint")).cast("int")
        return F.call_function("shiftleft", F.lit(1).cast("bigint"), place)
    return bit(0).bitwiseOR(bit(1)).bitwiseOR(bit(2)).bitwiseOR(bit(3))


def words_for(n_keys: int) -> int:
    """Words of a filter of ``n_keys``: a power of two."""
    return 1 << max(0, (max(1, n_keys) - 1) // KEYS_PER_WORD).bit_length()


def filter_of(keys: DataFrame, key: str, words: int) -> Column:
    """The filter as one array of words, an uncorrelated scalar subquery that is run
    once.  ``words`` bounds its one group."""
    spark = keys.sparkSession
    empty = spark.range(words).select(F.col("id").alias("word"), F.lit(0).cast("bigint").alias("bits"))
    own = keys.filter(F.col(key).isNotNull()).select(_word(F.col(key), words).alias("word"), _mask(F.col(key)).alias("bits"))
    filled = own.unionByName(empty).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    return filled.agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda x: x["bits"]).alias("words")).scalar()


def may_hold(words_array: Column, key: Column, words: int) -> Column:
    """False where the filter excludes the key; null keys are excluded."""
    mask = _mask(key)
    return F.coalesce(key.isNotNull() & (F.get(words_array, _word(key, words).cast("int")).bitwiseAND(mask) == mask), F.lit(False))


def orphans_by_bloom(fact: DataFrame, fact_key: str, dim: DataFrame, dim_key: str = "id", max_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """(key, n_records) of the fact rows without a dimension row, as
    :func:`~tiermill.operators.quality.orphans` gives them.

    Rows that a filter of the dimension's keys excludes are orphans at once; only
    the others are joined.  The filter's size follows from the number of dimension
    rows and is checked before it is built: beyond ``max_bytes`` all keys are
    joined.  Null keys are orphans; repeated dimension keys count once."""
    words = words_for(dim.count())
    if words * 8 > max_bytes:
        return orphans(fact, fact_key, dim, dim_key)
    maybe = may_hold(filter_of(dim, dim_key, words), F.col(fact_key), words)
    alone = fact.filter(~maybe).groupBy(F.col(fact_key).alias("key")).agg(F.count(F.lit(1)).alias("n_records"))
    return alone.unionByName(orphans(fact.filter(maybe), fact_key, dim, dim_key))


class UniqueKeys:
    """Keeps up the duplicated keys of a stored table with a key, append by append.

    Beside the table stand its key filter, (partition, word, bits), and its
    duplicated keys.  An append looks its keys up in the filter and reads only the
    partitions in which one of them may stand already.  ``words`` is the filter's
    size in each partition: a filter that has filled up costs reads, not results.

    The filter and the duplicates are written before the rows.  If a job dies in
    between, running the append again gives the same result."""

    def __init__(self, table: StoredTable, root: str, words: int = 1 << 12):
        if not table.key:
            raise ValueError(f"{table.name} has no key")
        self.table, self.words = table, words
        self.filter = StoredTable(table.spark, root, f"{table.name}_filter")
        self.duplicated = StoredTable(table.spark, root, f"{table.name}_duplicates")

    def _filter_rows(self, parted: DataFrame) -> DataFrame:
        key = F.col(self.table.key)
        return parted.filter(key.isNotNull()).groupBy(PART, _word(key, self.words).alias("word")).agg(F.bit_or(_mask(key)).alias("bits"))

    def build(self) -> None:
        """Filter and duplicates of the whole stored table."""
        key, rows = self.table.key, self.table.stored()
        self.filter.replace(self._filter_rows(rows))
        self.duplicated.replace(rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(key))

    def append(self, df: DataFrame) -> list[int]:
        """Append ``df``; returns the partitions that were read (at most ``table.parts``)."""
        key, parted = self.table.key, self.table.parted(df)
        batch = parted.filter(F.col(key).isNotNull()).groupBy(PART, key).agg(F.count(F.lit(1)).alias("n"))
        probes = batch.withColumn("word", _word(F.col(key), self.words)).join(self.filter.read(), [PART, "word"], "left")
        maybe = probes.filter(F.col("bits").bitwiseAND(_mask(F.col(key))) == _mask(F.col(key))).select(PART, key)
        read = sorted(r[PART] for r in maybe.select(PART).distinct().collect())
        twice = batch.filter("n > 1").select(key)
        if read:
            stored = self.table.stored().filter(F.col(PART).isin(read)).select(PART, key)
            twice = twice.unionByName(maybe.join(stored, [PART, key], "left_semi").select(key))
        merged = self.filter.read().unionByName(self._filter_rows(parted)).groupBy(PART, "word").agg(F.bit_or("bits").alias("bits"))
        self.filter.replace(merged)
        self.duplicated.replace(self.duplicated.read().unionByName(twice).distinct())
        append(self.table, df)
        return read

    def duplicates(self) -> DataFrame:
        """The key values that stand in more than one row."""
        return self.duplicated.read()
