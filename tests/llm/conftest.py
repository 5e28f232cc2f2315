import pytest
from pyspark.sql import functions as F

LONG = " ".join(f"w{i % 977}" for i in range(30_000))
EDGE = [
    (1, None), (2, ""), (3, "  \n\t "), (4, "alone"), (5, "The quick brown fox jumps over the lazy dog, said nobody."),
    (5, "The quick brown fox jumps over the lazy dog, said nobody."), (6, "the QUICK brown fox jumps over the lazy dog, said nobody."),
    (7, LONG), (8, LONG + " end"), (9, "a\n\na\nb c\r\nd\x0be  f ### $ | <b> é ü 漢字 🙂"), (10, "x y z " * 40),
    (None, "no id here but words enough to count as more than ten of them"),
]


@pytest.fixture(scope="session")
def edge(spark):
    """Null, empty, blank, repeated, long and odd texts, beside columns whose names the operators use themselves."""
    rows = spark.createDataFrame(EDGE, "doc_id bigint, text string")
    for name in ("shard", "slot", "kept", "n_words", "score", "host", "rank", "_text", "component_id"):
        rows = rows.withColumn(name, F.lit("mine"))
    return rows.repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id bigint, text string")
