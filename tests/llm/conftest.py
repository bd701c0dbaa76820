import random

import pytest

SCHEMA = "doc_id long, text string, lang string, id long, node long, row long, label int, sequence_id long"


@pytest.fixture()
def documents(spark):
    """A DataFrame from (id, text) pairs, with further columns whose names operators use inside."""

    def made(rows):
        return spark.createDataFrame([(i, t, "xx", 7, 7, 7, 7, 7) for i, t in rows], SCHEMA)

    return made


@pytest.fixture()
def awkward():
    """NULLs, empty and blank texts, repeated rows, one very long text, ties."""
    rng = random.Random(0)
    words = [f"w{k}" for k in range(400)]
    long = " ".join(rng.choice(words) for _ in range(30_000))
    some = " ".join(rng.choice(words) for _ in range(120))
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two"), (6, some), (6, some), (7, some), (8, long),
        (9, "Été &amp; <b>x</b> </s> [INST] \\ 'quoted' don't 12 34 <|endoftext|>  z 　y"), (None, some), (10, some + " tail"),
    ]
