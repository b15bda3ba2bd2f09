"""Small inputs with every awkward case; the brute-force forms are in the test modules."""

import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_helpers import SF, prose  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # extra columns whose names clash with those of results, of helpers, or by case
    T.StructField("Text", T.IntegerType()), T.StructField("h", T.StringType()), T.StructField("k", T.StringType()),
    T.StructField("c0", T.StringType()), T.StructField("kept", T.BooleanType()), T.StructField("n_lines", T.StringType()),
    T.StructField("score", T.StringType()), T.StructField("spans", T.StringType())])


def texts() -> list[tuple[int | None, str | None]]:
    """Null and empty texts, one word, white space only, a very long text, exact and near copies,
    repeated lines, non-ASCII, repeated rows, a doc_id used twice, missing doc_ids."""
    rng = random.Random(7)
    base = [prose(rng, 80) for _ in range(6)]
    lines = [prose(rng, 9) for _ in range(5)]
    long = prose(rng, 30_000)
    near = base[0].split()
    near[40] = "changed"
    return [
        (1, base[0]), (2, base[0]), (3, " ".join(near)), (4, base[1]), (5, None), (6, ""), (7, "word"), (8, " \n\t "),
        (9, long), (10, long + " tail"), (11, "\n".join(lines)), (12, "\n".join([base[2], "", *lines, base[3]])),
        (13, "\n".join(["same line"] * 6)), (14, "Ünï cödé É 𝒳 " + base[4] + " " + base[0]), (15, base[5]), (15, base[5]),
        (16, base[5] + " more"), (16, "other text"), (None, base[1]), (None, None), (100, base[4]), (200, base[4] + " x"),
        (17, "a b"), (18, "a b"), (19, "\n".join(["x y z"] * 3) + "\n" + "\n".join(lines[:3]) + "\n\n\n"),
    ]


@pytest.fixture(scope="session")
def rows():
    return texts()


@pytest.fixture(scope="session")
def edge(spark, rows):
    data = [(i, t, None if i == 7 else "en", None, None if t is None else len(t), 5, "h", None, "c", True, "n", "s", "p")
            for i, t in rows]
    return spark.createDataFrame(data, DOCUMENTS)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
