import random

import pytest
from pyspark.sql import types as T

WORDS = ("ander bolt cabin delta ember fjord gamma hazel ivory jolt karst lumen mango nickel "
         "ochre piano quartz raven sable tundra umber velvet willow xenon yonder zephyr").split()
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(40)) for _ in range(n))


def odd_texts() -> list[tuple]:
    """Ids and texts: nulls, empty, blank, ties, repeated rows, a long text."""
    long = prose(99, 12_000)
    return [(1, prose(1, 60)), (2, prose(1, 60)), (2, prose(1, 60)), (None, prose(1, 60)),
            (None, prose(3, 30)), (None, prose(3, 30)), (4, None), (5, ""), (6, " \n\t "), (7, "one two"),
            (8, "One TWO"), (None, None), (9, long), (10, long + " tail"), (11, "idiot " * 40),
            (12, "mail a@b.example.com or +1 (206) 555-0100\x00 é漢字 \U0001f600")]


@pytest.fixture(scope="session")
def docs(spark):
    """The odd rows as ``documents``."""
    rows = [(i, t, "en", "s", len(t) if t else None) for i, t in odd_texts()]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def clashing(docs):
    """The odd rows with extra columns whose names clash by case."""
    n = len(docs.columns)
    wide = docs.selectExpr("*", "1 AS a", "'x' AS b", "2.0 AS c")
    return wide.toDF(*docs.columns, "TEXT", "Doc_ID", "score"), n + 3


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
