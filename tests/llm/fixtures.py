"""Small inputs for the operators: awkward rows, and a small corpus of copies."""

import random

from pyspark.sql import functions as F

LONG = " ".join(f"w{i % 997}x{i}" for i in range(30000))

#: doc_id, text: nulls, empties, blanks, long, repeated rows, ties, odd characters.
AWKWARD = [
    (1, None), (2, ""), (3, " \n\t "), (4, LONG), (5, "one"), (5, "one"), (6, "one two three"), (7, "ONE two three"),
    (None, "no id here at all, but a text of some words that goes on for a little while longer"), (None, None),
    (8, "no id here at all, but a text of some words that goes on for a little while longer"),
    (9, "été à la plage\u00a0nbsp \u2003em \x1c fs"), (9, "another text under the same id"), (10, "-- ** !! 12 34"),
    (11, "a\nb\n\na\nb"), (-3, "negative id"), (2 ** 62, "large id"),
]

#: Names that the operators use inside.
CLASHES = ("score", "lang_pred", "n_words", "g", "part", "tok", "matches", "places", "lines", "gone", "h", "size", "cell", "key", "n", "m", "_id_")


def awkward(spark):
    rows = spark.createDataFrame(AWKWARD, "doc_id long, text string")
    return rows.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHES])


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def corpus(n: int = 120, seed: int = 3) -> list[tuple[int, str]]:
    """Documents of random words with exact copies, near copies and passages."""
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrst"]
    line = lambda k: " ".join(rng.choice(vocabulary) for _ in range(k))
    passages = ["\n".join(line(12) for _ in range(5)) for _ in range(4)]
    docs: list[str] = []
    for i in range(n):
        kind = rng.random()
        if docs and kind < 0.15:
            docs.append(rng.choice(docs))
        elif docs and kind < 0.4:
            words = rng.choice(docs).split(" ")
            for _ in range(max(1, len(words) // 60)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            docs.append(" ".join(words))
        elif kind < 0.55:
            docs.append("\n".join([line(9), rng.choice(passages), line(14)]))
        elif kind < 0.65:
            docs.append(line(rng.randint(1, 9)))
        else:
            docs.append("\n".join(line(rng.randint(3, 15)) for _ in range(rng.randint(2, 12))))
    return list(enumerate(docs))
