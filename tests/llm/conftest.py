import random

import pytest

#: Names that the operators use for columns of their own.
CLASHES = ["_x", "_h", "_d", "_t", "_q", "_late", "_new", "_key", "_s", "_r0", "_r1", "_size", "_old", "_hash", "_task", "_m", "_bucket", "_slice", "_Rank", "_copy"]
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "size long, shard string, slot string, kept string, copies string, n_entities string, "
          + ", ".join(f"{c} string" for c in CLASHES))


def make(spark, rows):
    """Documents with further columns whose names clash with results."""
    full = [(i, t, la, so, len(t or ""), -1, "a", "b", "c", "d", "e", *CLASHES) for i, t, la, so in rows]
    return spark.createDataFrame(full, SCHEMA)


def prose(seed, n, vocabulary=3000):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


EDGE_ROWS = [
    (1, "the cat sat on the mat " * 10, "en", "s1"), (1, "the cat sat on the mat " * 10, "en", "s1"),
    (2, None, "en", None), (3, "", None, "s1"), (None, "no id here", "en", "s2"), (None, None, None, None),
    (4, "one", "en", "s2"), (5, " \t\n ", "en", "s2"), (6, "Éa ß\x00 漢字 🙂 \\ <|im_end|> </s>", "fr", "s3"),
    (7, prose(1, 6000), "en", "s1"), (8, "x" * 200_000, "en", "s1"), (9, "a\n\na\nb\n", "en", "é"),
]


@pytest.fixture(scope="session")
def edge(spark):
    return make(spark, EDGE_ROWS).cache()


@pytest.fixture(scope="session")
def empty(edge):
    return edge.limit(0)
