"""Benchmark decontamination by SimHash windows and a multi-index.

A benchmark item of m shingles is compared with the windows of m shingles of the
documents.  Each window and each item has a 64-bit SimHash of its shingles, each
counted as often as it stands there.  The fingerprints are cut into ``BLOCKS``
blocks; two that differ in at most ``radius`` bits agree in some block up to
``radius // BLOCKS`` bits, so the index holds every item under all those values
of every block, and a window looks up its own: all fingerprints within the
radius are found.  What is found is verified by the exact similarity of the
weighted shingle sets, sum of least over sum of greatest counts.

Only windows that hold at least one shingle of an item of their size are
fingerprinted; any other has similarity 0 with all of them.

Everything is DataFrame functions: a document's shingles are one array, its
windows are slices of it, and the bit counts of a SimHash are summed in lanes of
a long, several bits at a time.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermill.llm.common import cut

BLOCKS, BLOCK_BITS = 8, 8
#: Rows of benchmark items (shingles, or index entries) that are sent to every task; more
#: are joined by shuffle.
BROADCAST_ROWS = 1 << 20


def _let(value: Column, body) -> Column:
    """``body(value)``, with ``value`` evaluated once."""
    return F.transform(F.array(value), body)[0]


def shingles(text: Column, size: int) -> Column:
    """Hashes of all runs of ``size`` words, in order.  Words are runs of letters
    and digits in lower case.  Fewer words are one shingle as a whole; null text
    and text without a word have none."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")

    def runs(w: Column) -> Column:
        own = F.transform(F.sequence(F.lit(0), F.size(w) - size), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(size)]))
        return (F.when(F.size(w) == 0, F.array().cast("array<long>"))
                .when(F.size(w) < size, F.array(F.xxhash64(F.concat_ws(" ", w)))).otherwise(own))

    return _let(words, runs)


def simhash(toks: Column, lanes: int) -> Column:
    """64-bit SimHash of an array of hashes: bit b is set if more than half of
    them have it.  ``lanes`` bits are counted in one long at a time."""
    width = 64 // lanes
    ones, top = sum(1 << (width * i) for i in range(lanes)), width - 2
    low = (F.lit((1 << top) - 1).cast("long") - F.floor(F.size(toks) / 2)) * F.lit(ones)
    out = None

    def set_bits(g: int) -> Column:
        return F.aggregate(toks, F.lit(0).cast("long"), lambda a, x: a + F.shiftrightunsigned(x, g).bitwiseAND(F.lit(ones)))

    for g in range(width):
        count = set_bits(g)
        bit = F.shiftleft(F.shiftrightunsigned(count + low, top).bitwiseAND(F.lit(ones)), g)
        out = bit if out is None else out.bitwiseOR(bit)
    return out


def _block(f: Column, i: int) -> Column:
    return F.shiftrightunsigned(f, BLOCK_BITS * i).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)).cast("int")


def _flips(radius: int) -> list[int]:
    """All changes of up to ``radius // BLOCKS`` bits of a block."""
    return [sum(1 << b for b in bits) for n in range(radius // BLOCKS + 1) for bits in combinations(range(BLOCK_BITS), n)]


def _index(items: DataFrame, radius: int) -> DataFrame:
    """Every item under all block values within ``radius // BLOCKS`` bits of its own."""
    keys = [F.struct(F.lit(i).alias("block"), _block(F.col("f"), i).bitwiseXOR(F.lit(x)).alias("value")) for i in range(BLOCKS) for x in _flips(radius)]
    return items.select("item_id", "m", F.col("f").alias("item_f"), F.explode(F.array(*keys)).alias("k")).select(
        "item_id", "m", "item_f", F.col("k.block").alias("block"), F.col("k.value").alias("value"))


def most_often(ordered: Column) -> Column:
    """How often the most frequent value of a sorted array stands in it."""
    run = F.aggregate(ordered, F.struct(F.lit(None).cast("long").alias("last"), F.lit(0).alias("n"), F.lit(0).alias("most")), _lengthen)
    return run["most"]


def _lengthen(run: Column, x: Column) -> Column:
    n = F.when(run["last"] == x, run["n"] + 1).otherwise(F.lit(1))
    return F.struct(x.alias("last"), n.alias("n"), F.greatest(run["most"], n).alias("most"))


def repeated(ordered: Column, times: Column) -> Column:
    """The distinct values that stand in a sorted array ``times`` times or more."""
    return F.array_distinct(F.filter(ordered, lambda x, i: x == F.get(ordered, i + times - 1)))


def contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", item_text: str = "text",
                 item_id: str = "item_id", size: int = 5, percent: int = 80, radius: int = 15) -> DataFrame:
    """The (document, item) pairs of which some window of the document is similar
    to the item: similarity times 100 is ``percent`` or more, and the SimHashes
    differ in ``radius`` bits at most.

    Returns doc_id, item_id, similarity, first_shingle (the place of the best
    window in the document; the first of equals), n_shingles of the window and
    distance (bits).  A document shorter than an item is one window.

    Documents and items with a null id or without a word give no rows.  Items
    that repeat an id are compared each for itself, and so are documents; the
    best window counts.  Other columns are ignored, whatever their names.
    """
    items = cut(benchmark.where(F.col(item_id).isNotNull()).select(F.col(item_id).alias("item_id"), shingles(F.col(item_text), size).alias("toks"))
                .where(F.size("toks") > 0).distinct().withColumn("m", F.size("toks")))
    total, longest, n_items = items.agg(F.coalesce(F.sum("m"), F.lit(0)), F.coalesce(F.max("m"), F.lit(0)), F.count(F.lit(1))).first()
    lanes = 4 if longest < 1 << 14 else 2
    entries = n_items * BLOCKS * len(_flips(radius))
    send = F.broadcast if total <= BROADCAST_ROWS and entries <= BROADCAST_ROWS else (lambda x: x)
    items = cut(items.withColumn("f", simhash(F.col("toks"), lanes)))

    # places of the items' shingles in the documents, by window size
    seeds = items.select("m", F.explode("toks").alias("tok")).distinct()
    named = docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    places = named.select("doc_id", F.posexplode(shingles(F.col("text"), size)).alias("at", "tok"))
    found = (places.join(send(seeds), "tok").groupBy("doc_id", "m").agg(F.collect_set("at").alias("at"))
             .groupBy("doc_id").agg(F.collect_list(F.struct("m", "at")).alias("sizes")))

    # all windows that hold one of them
    whole = named.join(found, "doc_id").select("doc_id", shingles(F.col("text"), size).alias("toks"), "sizes")
    sized = whole.select("doc_id", "toks", F.explode("sizes").alias("s")).select("doc_id", "toks", F.col("s.m").alias("m"), F.col("s.at").alias("at"))
    last = F.size("toks")
    around = F.transform(F.filter("at", lambda p: p < last), lambda p: F.sequence(
        F.greatest(F.lit(0), p - F.col("m") + 1), F.least(p, F.greatest(F.lit(0), last - F.col("m")))))
    # windows are cut after the explosion, so that no row holds all of them
    windows = (sized.withColumn("starts", F.array_distinct(F.flatten(around)))
               .select("doc_id", "m", "toks", F.explode("starts").alias("start"))
               .select("doc_id", "m", "start", F.slice("toks", F.col("start") + 1, F.col("m")).alias("win")))
    printed = windows.withColumn("f", simhash(F.col("win"), lanes))

    # the index, then the exact comparison
    probes = printed.select("*", F.explode(F.array(*[F.struct(F.lit(i).alias("block"), _block(F.col("f"), i).alias("value")) for i in range(BLOCKS)])).alias("k"))
    probes = probes.select("doc_id", "m", "start", "win", "f", F.col("k.block").alias("block"), F.col("k.value").alias("value"))
    near = probes.join(send(_index(items, radius)), ["m", "block", "value"])
    differ = F.col("f").bitwiseXOR(F.col("item_f"))
    first = F.coalesce(*[F.when(F.bit_count(_block(differ, i)) <= radius // BLOCKS, F.lit(i)) for i in range(BLOCKS)])
    near = near.where((F.bit_count(differ) <= radius) & (first == F.col("block"))).select(
        "doc_id", "item_id", "m", "start", "win", "item_f", F.bit_count(differ).alias("distance"))
    # level c of an item holds the shingles that stand in it c times or more; a window's are
    # those that stand c - 1 places further in its sorted shingles as well
    ordered = F.array_sort("toks")
    levels = F.transform(F.sequence(F.lit(1), most_often(ordered)), lambda c: repeated(ordered, c))
    own = items.select("item_id", "m", F.col("f").alias("item_f"), levels.alias("levels"))
    met = near.withColumn("win", F.array_sort("win")).join(send(own), ["item_id", "m", "item_f"])
    least = F.aggregate(F.transform("levels", lambda level, c: F.size(F.array_intersect(level, repeated(F.col("win"), c + 1)))),
                        F.lit(0), lambda a, n: a + n)
    met = met.withColumn("least", least).withColumn("most", F.size("win") + F.col("m") - F.col("least"))
    met = met.where(100 * F.col("least") >= percent * F.col("most"))
    best = F.max(F.struct((F.col("least") / F.col("most")).alias("similarity"), (-F.col("start")).alias("before"),
                          F.size("win").alias("n"), (-F.col("distance")).alias("far")))
    return met.groupBy("doc_id", "item_id").agg(best.alias("b")).select(
        "doc_id", "item_id", F.col("b.similarity").alias("similarity"), (-F.col("b.before")).cast("long").alias("first_shingle"),
        F.col("b.n").cast("long").alias("n_shingles"), (-F.col("b.far")).cast("int").alias("distance"))
