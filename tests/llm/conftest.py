import os
import random

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(autouse=True)
def package_on_workers(spark):
    spark.sparkContext.environment["PYTHONPATH"] = ROOT


def invented(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(n)]


@pytest.fixture
def rng():
    return random.Random(7)


@pytest.fixture
def messy(spark, rng):
    """Null, empty, blank, tiny, repeated and long texts, a null id, and columns with clashing names."""
    long = " ".join(invented(rng, 30_000)) + " " + "x" * 100_000
    texts = [(1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, "a b c d e f g h"), (5, "a b c d e f g h"),
             (6, "A B C D E F\nG H"), (7, long), (None, "a text without an id, seven words"), (8, "élan Ω 日本 12 ?!")]
    rows = [(i, t, "en", 9, "p", 0.5, [1], 7) for i, t in texts]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, id long, prefix string, score double, "
                                       "ids array<int>, n int")


@pytest.fixture
def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")
