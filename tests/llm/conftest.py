import os

import pytest

FOLDER = os.environ.get("AISLEWATCH_TESTDATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture(scope="session")
def documents(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").collect()
    return sorted(((r.doc_id, r.text, r.source) for r in rows), key=lambda r: r[0])


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows, and clashing extra columns."""
    long_text = " ".join(f"word{k % 977}x{k % 13}" for k in range(60_000))
    rows = [
        (1, "a b c", "x", 0, 1, "q", "l"), (1, "a b c", "x", 0, 1, "q", "l"), (2, None, "x", None, 2, None, None),
        (3, "", None, 0, 3, "q", "l"), (None, "alone without an id " * 20, "y", 7, 4, "q", "l"), (4, " \t\n ", "y", 1, 5, "q", "l"),
        (5, long_text, "y", 1, 6, "q", "l"), (6, long_text, "z", 1, 7, "q", "l"), (7, "🙂 é ß İ ŉ   x", "z", 1, 8, "q", "l"),
        (8, "one", "z", 1, 9, "q", "l"),
    ]
    kinds = "doc_id bigint, text string, source string, size bigint, n_tokens bigint, _quality string, region string"
    from pyspark.sql import functions as F

    clashing = ("_d", "_s", "_c", "_n", "_row", "_j", "_own", "lines", "times", "copies", "whole", "c0", "set", "_block", "label")
    return spark.createDataFrame(rows, kinds).withColumns({c: F.lit(c) for c in clashing})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, source string, lang string, n_chars bigint")
