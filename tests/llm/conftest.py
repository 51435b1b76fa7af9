import re

import pytest
from pyspark.sql import types as T

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, score double, h string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


@pytest.fixture(scope="session")
def odd(spark):
    """Null columns, empty and very long texts, ties, repeated rows, clashing extra columns."""
    long = " ".join(f"w{i % 7919}x{i % 101}" for i in range(60_000))
    base = " ".join(f"alpha{i}" for i in range(70))
    rows = [(1, base), (2, base), (2, base), (3, None), (4, ""), (5, " \t\n"), (6, long), (7, base + " tail words here"),
            (None, base), (None, None), (8, "one"), (9, "two words"), (10, "One"), (11, "é " * 60), (12, "x" * 300_000)]
    return spark.createDataFrame([(i, t, None, None, None if t is None else len(t), 0, 0.5, "h") for i, t in rows], SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], T._parse_datatype_string(SCHEMA))
