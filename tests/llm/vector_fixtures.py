"""Small vector tables: clusters, copies, ties, and awkward rows."""

import random

from pyspark.sql import functions as F

from fixtures import CLASHES

SCHEMA = "vec_id long, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")

#: Rows that take no part (null, short, non-finite, zero), and repeated ids and vectors.
AWKWARD_VECTORS = [
    (900, None, 1), (901, [], 1), (902, [0.5], 1), (903, [0.1, NAN] * 4, 1), (904, [INF, 0.0] * 4, 2), (905, [None, 0.5] * 4, 2),
    (906, [0.0] * 8, 2), (None, [0.25] * 8, 1), (907, [0.5] * 8, None), (908, [0.5] * 8, 1), (908, [0.5] * 8, 1), (908, [-0.5] * 8, 2),
    (-300, [0.25, -0.25] * 4, 3), (-7, [1.0] * 8, 1), (1400, [0.125] * 8, 2),
]


def clusters(n: int = 400, dim: int = 8, seed: int = 4, labels: int = 4) -> list[tuple]:
    """Vectors around a few centres, some of them copied, on a coarse grid so that ties occur."""
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(n // 8)]
    rows: list[tuple] = []
    for i in range(n):
        if rows and rng.random() < 0.1:
            rows.append((i, rng.choice(rows)[1], rng.randrange(labels)))
            continue
        c = rng.choice(centres)
        rows.append((i, [round((x + rng.gauss(0, 0.25)) * 16) / 64 for x in c], rng.randrange(labels)))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHES if c != "embedding"])


def taking_part(rows, dim: int = 8) -> list[tuple]:
    return [r for r in rows if r[1] is not None and len(r[1]) == dim and all(x is not None and abs(x) < INF for x in r[1])]
