import random

import pytest

WORDS = "the of and to in is that it for was on are as with be this by from at or".split()


@pytest.fixture(scope="session")
def prose():
    """A function that writes repeatable text of ``n`` invented words."""

    def write(seed, n):
        rng = random.Random(seed)
        made = [rng.choice(WORDS) if rng.random() < 0.3 else "".join(rng.choice(["ra", "ti", "mo", "lu", "en", "ska", "vé"]) for _ in range(rng.randint(1, 4))) for _ in range(n)]
        return " ".join(made)

    return write


@pytest.fixture(scope="session")
def frame(spark):
    """A function from (doc_id, text) rows to a documents table with more columns, some of
    whose names the operators use themselves."""

    def make(rows, partitions=3):
        schema = "doc_id long, text string, lang string, source string, n_chars long, score double, line string, keep string, fp long"
        full = [(d, t, "en", "s", None if t is None else len(t), 0.5, "x", "y", 1) for d, t in rows]
        return spark.createDataFrame(full, schema).repartition(partitions)

    return make
