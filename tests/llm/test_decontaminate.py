import random
import re
from collections import Counter

import xxhash
from pyspark.sql import functions as F

from fixtures import AWKWARD, awkward, corpus, empty
from tiermill.llm import decontaminate
from tiermill.llm.decontaminate import contaminated


def tokens(text, size=5):
    words = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
    if not words:
        return []
    runs = [words[i:i + size] for i in range(len(words) - size + 1)] if len(words) >= size else [[" ".join(words)]]
    out = []
    for run in runs:
        h = 42
        for w in run:
            h = xxhash.xxh64(w.encode(), seed=h).intdigest()
        out.append(h)
    return out


def simhash(toks):
    return sum(1 << b for b in range(64) if 2 * sum(t >> b & 1 for t in toks) > len(toks))


def brute(docs, items, percent=80, radius=15):
    """Every window of every document against every item."""
    own = [(i, tokens(t)) for i, t in items if i is not None]
    best = {}
    for d, text in docs:
        toks = tokens(text)
        if d is None or not toks:
            continue
        for i, item in own:
            m = len(item)
            for s in range(max(1, len(toks) - m + 1)) if m else ():
                win = toks[s:s + m]
                least = sum((Counter(win) & Counter(item)).values())
                most = len(win) + m - least
                far = (simhash(win) ^ simhash(item)).bit_count() if least else 99
                if 100 * least >= percent * most and far <= radius:
                    best[d, i] = max(best.get((d, i), (0, 0, 0, 0)), (least / most, -s, len(win), -far))
    return {k: (v[0], -v[1], v[2], -v[3]) for k, v in best.items()}


def cases():
    docs = [(i, t) for i, t in corpus(40, seed=9) if len(t.split()) > 30]
    items = [(k, " ".join(docs[k][1].split()[3:3 + n])) for k, n in enumerate((14, 20, 26, 8, 3, 40))]
    items += [(90, "la la la la la la la la la la"), (91, None), (92, " -- "), (None, docs[0][1]), (93, "one two three"), (94, items[0][1])]
    planted = []
    for k, text in items[:6]:
        w = text.split()
        planted += [(500 + k, "Some words before: " + text.upper().replace(" ", ", ") + "! And some after it."),
                    (520 + k, " ".join([*w[:len(w) // 2], "changed", *w[len(w) // 2 + 1:]])), (540 + k, " ".join(w[:-1])), (560 + k, " ".join(w[:len(w) // 2]))]
    return docs + planted + [(600, "la " * 30), (601, "one two three")] + AWKWARD, items


def test_equals_brute_force(spark):
    docs, items = cases()
    rows = contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    got = {(r.doc_id, r.item_id): (r.similarity, r.first_shingle, r.n_shingles, r.distance) for r in rows}
    want = brute(docs, items)
    assert len(rows) == len(got) and got == want
    assert all((500 + k, k) in got for k in (0, 1, 2, 3, 5))  # item 4 has fewer than five words: one shingle as a whole


def test_the_index_misses_little_at_the_threshold(spark):
    """Of windows at similarity 0.8 to 1, the radius lets nearly all through."""
    docs, items = cases()
    all_, near = brute(docs, items, radius=64), brute(docs, items)
    assert len(near) >= 0.95 * len(all_)


def test_awkward_and_empty(spark):
    items = spark.createDataFrame([(1, "no id here at all, but a text of some words")], "item_id long, text string")
    rows = contaminated(awkward(spark), items).collect()
    assert [(r.doc_id, r.item_id) for r in rows] == [(8, 1)]
    assert contaminated(empty(spark), items).collect() == []
    assert contaminated(awkward(spark), items.limit(0)).collect() == []


def test_overlap_counts_repeats(spark):
    from tiermill.llm.decontaminate import most_often, repeated
    rows = [([],), ([5],), ([1, 1, 2, 3, 3, 3],), ([7] * 6,)]
    df = spark.createDataFrame(rows, "a array<long>").select("a", most_often(F.col("a")).alias("n"), *[repeated(F.col("a"), F.lit(k)).alias(f"r{k}") for k in (1, 2, 3)])
    assert [tuple(r)[1:] for r in df.collect()] == [(0, [], [], []), (1, [5], [], []), (3, [1, 2, 3], [1, 3], [3]), (6, [7], [7], [7])]


def test_long_item_and_items_too_many_to_send(spark, monkeypatch):
    rng = random.Random(9)
    text = [f"v{rng.randrange(300)}" if i % 7 else "again and again and again and again" for i in range(900)]
    docs = spark.createDataFrame([(1, " ".join(text)), (2, " ".join(text[:100])), (3, "nothing of it")], "doc_id long, text string")
    items = spark.createDataFrame([(7, " ".join(text[500:650])), (8, " ".join(text[10:60])), (9, "again and " * 40)], "item_id long, text string")

    def found():
        return sorted((r.doc_id, r.item_id, r.similarity, r.n_shingles) for r in contaminated(docs, items).collect())

    rows = found()
    assert [x[:3] for x in rows if x[1] != 9] == [(1, 7, 1.0), (1, 8, 1.0), (2, 8, 1.0)]
    assert not [x for x in rows if x[1] == 9]
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    assert found() == rows
