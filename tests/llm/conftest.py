import random

import pytest

WORDS = ["".join(random.Random(i).choices("abcdefghijklmnop", k=2 + i % 6)) for i in range(3000)]


def prose(rng, n):
    return " ".join(rng.choices(WORDS, k=n))


@pytest.fixture()
def awkward(spark):
    """Nulls in every column, empty, blank and long texts, ties, repeated rows, and extra
    columns with names that operators use inside."""
    rng = random.Random(3)
    long = prose(rng, 60_000)
    base = [
        (None, None, None), (None, "some text here", "a"), (1, None, "a"), (2, "", "a"), (3, " \n\t ", None),
        (4, "one", "b"), (4, "one", "b"), (5, "one", "b"), (6, long, "c"), (7, long, "c"), (8, long + " end", None),
        (9, "x@y.zz or +1 (456) 555-2186, or 10.0.0.1, or 4111111111111111", "c"), (10, "é 漢字 <|endoftext|> \U0001f600", "é"),
        (11, prose(rng, 80), "a"), (11, prose(rng, 80), "a"), (2**62, "one two three four five", "b"),
    ]
    rows = [(*r, "x", 1.5, 2, "r", [1], True, 4) for r in base]
    names = "doc_id long, text string, source string, row string, score double, size long, key string, spans array<int>, kept boolean, dropped_key long"
    return spark.createDataFrame(rows, names)


@pytest.fixture()
def empty(awkward):
    return awkward.filter("1 = 0")


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
