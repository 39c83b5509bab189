"""Shared fixtures and texts of these tests (imported by name: only one conftest module can exist)."""

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
LABELS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()), T.StructField("toxic", T.IntegerType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    """Frame of documents from (doc_id, text[, source]) tuples."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture(scope="session")
def make_labels(spark):
    return lambda rows: spark.createDataFrame(rows, LABELS)

SF_SMALL = "/root/testdata/sf0.001"


def sentence(seed: int, n: int) -> str:
    """n invented words, different for every seed."""
    x, out = seed * 7919 + 17, []
    for _ in range(n):
        x = (x * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        out.append("w" + format(x >> 40, "x"))
    return " ".join(out)


# rows every operator must survive: null and empty texts, null and repeated ids, blanks only, very long
AWKWARD = [(None, "no id here at all"), (1, None), (2, ""), (3, " \n\t "), (4, "twice the same row"), (4, "twice the same row"),
           (5, "ünïcödé wörds ☃ 漢字 " * 3), (6, sentence(1, 30_000)), (7, "a" * 5000), (8, "x\x00y\x7f z")]
