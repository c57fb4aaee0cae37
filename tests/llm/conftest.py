import random

import pytest

CLASHES = (
    "size", "score", "kept", "labels", "ids", "n_words", "copies", "target", "key", "rank", "held_out", "node", "root",
    "component_id", "label", "bad", "spans", "reply_to", "body", "position", "words", "tokens", "predicted", "decoded",
)
SCHEMA = "doc_id long, text string, source string, " + ", ".join(f"`{c}` string" for c in CLASHES)


def prose(seed, n=60):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmno") for _ in range(rng.randint(2, 7))) for _ in range(n))


def odd_rows():
    """Nulls in any column, empty, blank and long texts, repeated rows, equal and near texts."""
    base = prose(1, 200)
    near = base.split()
    near[100] = "changed"
    rows = [
        (1, base, "a"), (2, base, "b"), (3, " ".join(near), None), (4, None, "a"), (5, "", "a"), (6, " \t\n\x0b\x0c\r ", "b"),
        (None, prose(2), "a"), (None, prose(2), None), (7, prose(3), "a"), (7, prose(3), "a"), (8, prose(4, 60_000), "c"),
        (9, "Word", None), (10, "word", ""), (11, "two words", "a"), (12, "naïve Ünïcode 日本 😀 \x00 x" * 9, "d"),
    ]
    return rows


@pytest.fixture(scope="module")
def odd_docs(spark):
    return spark.createDataFrame([(*r, *(["x"] * len(CLASHES))) for r in odd_rows()], SCHEMA).cache()


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, label int")


SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def small_docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")
