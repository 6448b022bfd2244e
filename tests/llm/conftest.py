import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, part string, rank int, bucket int, key string, h long"


@pytest.fixture
def docs(spark):
    """docs(texts or (id, text) pairs): a documents table with further columns whose names operators use themselves."""

    def make(items):
        pairs = [x if isinstance(x, tuple) else (i, x) for i, x in enumerate(items)]
        return spark.createDataFrame([(i, t, None, None, None, "p", 1, 2, "k", 3) for i, t in pairs], SCHEMA).repartition(3)

    return make


@pytest.fixture(scope="session")
def prose():
    """prose(n words, seed): words of a small invented language."""
    syllables = ["ba", "ke", "lo", "mi", "nu", "ra", "si", "to", "ve", "zu", "é", "ßa"]

    def make(n, seed):
        r = random.Random(seed)
        return " ".join("".join(r.choice(syllables) for _ in range(r.randint(1, 4))) for _ in range(n))

    return make


@pytest.fixture(scope="session")
def awkward(prose):
    """Empty, null, blank, very long, tied and repeated rows."""
    long = prose(30_000, 1)
    return [(1, ""), (2, None), (3, " \n\t "), (4, long), (5, long), (6, prose(200, 2)), (6, prose(200, 2)), (7, "a"), (8, "a"), (None, "x y z"), (9, prose(200, 2) + " end")]
