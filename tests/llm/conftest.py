"""Small documents with every awkward case."""

import random

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from ``(doc_id, text)`` or ``(doc_id, text, source)``, with columns of names that operators use."""

    def make(rows, *extra):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS).repartition(3)
        for name in extra:
            from pyspark.sql import functions as F

            df = df.withColumn(name, F.lit("own"))
        return df

    return make


@pytest.fixture(scope="session")
def prose():
    """A function that gives ``n`` words of invented prose for a seed."""
    syllables = ["ba", "ke", "lo", "mi", "nu", "ra", "sto", "tri", "ven", "zu", "é", "ña"]

    def write(n, seed):
        rng = random.Random(seed)
        return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(n))

    return write


@pytest.fixture(scope="session")
def awkward(prose):
    """NULLs, blanks, a very long text, ties and repeated rows."""
    return [
        (None, prose(80, 1)),
        (None, None),
        (0, None),
        (1, ""),
        (2, " \t\n "),
        (3, "one"),
        (4, prose(30_000, 2)),
        (5, prose(90, 3)),
        (5, prose(90, 3)),
        (5, prose(90, 4)),
        (6, prose(90, 3)),
        (7, "a b   c\x01 \x0bd\r\n e <|endoftext|> f  g"),
        (8, "x" * 5000),
    ]
