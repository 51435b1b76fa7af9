"""Property tests: Spark column rules against Python on random inputs (one Spark job per example)."""

import os

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ferret.functions.text import file_ext, file_head, lines_of, strip_ws, words_of
from tests.brute import py_lines

ALPHABET = st.sampled_from(list("ab .\n\r\t\x0b\x0c\x1c\x85\xa0 　ÉéΣσ_-") + ["\r\n"])
TEXTS = st.lists(st.lists(ALPHABET, max_size=12).map("".join), min_size=1, max_size=40)
NAMES = st.lists(st.lists(st.sampled_from(list("ab.cC")), max_size=8).map("".join), min_size=1, max_size=40)
SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(TEXTS)
def test_lines_words_strip_equal_python(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {}
    for r in lines_of(df, ["id"], "text").collect():
        got.setdefault(r.id, []).append((r.line_no, r.line))
    for i, t in enumerate(texts):
        assert sorted(got.get(i, [])) == list(enumerate(py_lines(t), start=1)), repr(t)
    for r in df.select("text", words_of("text").alias("w"), strip_ws("text").alias("s")).collect():
        assert r.w == r.text.lower().split() and r.s == r.text.strip(), repr(r.text)


@SETTINGS
@given(NAMES)
def test_ext_and_head_equal_splitext(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "n string")
    for r in df.select("n", file_ext("n").alias("e"), file_head("n").alias("h")).collect():
        assert (r.h, r.e) == os.path.splitext(r.n), repr(r.n)


def test_pinned_lower(spark):
    r = spark.range(1).select(F.lower(F.lit("İ")).alias("i"), F.lower(F.lit("ΑΣ")).alias("s")).first()
    assert r.i == "İ".lower() == "i̇"
    assert r.s == "ας"


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.text("abcé ", max_size=14), st.text("abcé ", max_size=14)), max_size=30))
def test_ratios_of_a_batch_are_those_of_difflib(pairs):
    from difflib import SequenceMatcher

    from ferret.functions.similarity import ratios
    a, b = [p[0] for p in pairs], [p[1] for p in pairs]
    assert ratios(a, b).tolist() == [SequenceMatcher(None, x, y).ratio() for x, y in pairs]


def test_ratios_of_long_and_unlike_lengths():
    import random
    from difflib import SequenceMatcher

    from ferret.functions import similarity
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("aabİ\U0001F642") for _ in range(rnd.choice([0, 1, 2, 9, 60, 199, 200, 260])))
    a, b = [word() for _ in range(300)], [word() for _ in range(300)]
    want = [SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)]
    old = similarity.SWEEP_CELLS
    try:
        for cells in (old, 50):
            similarity.SWEEP_CELLS = cells
            assert similarity.ratios(a, b).tolist() == want
    finally:
        similarity.SWEEP_CELLS = old
