import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, size string, key string, rank int, shard string, bucket string"


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    out = []
    for k in range(words):
        word = "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7)))
        out.append(word.capitalize() if k % 9 == 0 else word)
    return " ".join(out)


def full(doc_id, text, source="src0"):
    return (doc_id, text, "en", source, len(text or ""), "r", "s", "k", 7, "x", "b")


@pytest.fixture(scope="session")
def edge_rows():
    """Null, empty, blank and very long texts, null ids and sources, ties and repeated rows."""
    rows = [full(k, prose(k, 120), f"src{k % 3}") for k in range(12)]
    near = prose(3, 120).split(" ")
    near[60] = "changed"
    return rows + [
        full(20, None),
        full(21, ""),
        full(22, " \n\t "),
        full(None, prose(50, 80)),
        full(23, prose(51, 30_000), None),
        full(24, " ".join(near), "src1"),
        full(5, prose(5, 120), "src2"),
        full(5, prose(5, 120), "src2"),
        full(25, prose(0, 120), None),
        full(None, None, None),
        full(26, "one two three"),
        full(27, "One two THREE"),
        full(28, "the " * 400),
    ]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    return spark.createDataFrame(edge_rows, SCHEMA).repartition(3).persist()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
