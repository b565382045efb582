"""Small tables that every operator has to take."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, label int, node string, n int"


def prose(seed, n, vocabulary=400):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(vocabulary)]
    out = []
    for k in range(n):
        out.append(rng.choice(words))
        if k % 11 == 10:
            out[-1] += "\n"
    return " ".join(out).replace("\n ", "\n")


def frame(spark, texts, first=0):
    """Documents of the texts, with extra columns whose names clash with those that operators use."""
    rows = [(first + k, t, "en", "s", None if t is None else len(t), 7, "x", 3) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def odd(spark):
    """Nulls in any column, empty and blank texts, a very long one, repeated rows, texts of one word."""
    long = prose(1, 30_000)
    rows = [
        (1, None, None, None, None, None, None, None),
        (2, "", "en", "s", 0, 1, "x", 1),
        (3, " \n\t ", "en", "s", 4, 1, "x", 1),
        (4, long, "de", "s", len(long), 1, "x", 1),
        (5, "word", "fr", "s", 4, 1, "x", 1),
        (6, prose(2, 60), "en", "s", 1, 1, "x", 1),
        (6, prose(2, 60), "en", "s", 1, 1, "x", 1),
        (7, prose(2, 60), "en", "s", 1, 1, "x", 1),
        (None, prose(3, 60), "en", "s", 1, 1, "x", 1),
        (8, "naïve Été 漢字 " + prose(4, 40), "xx", "s", 1, 1, "x", 1),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
