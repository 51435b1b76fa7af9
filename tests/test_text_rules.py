import os

from pyspark.sql import functions as F

from ferret.functions.text import WS_CHARS, file_ext, lines_of, strip_ws, words_of
from tests.brute import py_lines


def _df(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")


TEXTS = ["Hello world\nsecond\r\nthird\rfourth\n\n", "x\ny", "", "\n", "a b\x0bc\x0cd\x85e\x1cf\n",
         "a\n\n", "\r\r\n\n", "  lead and trail \t\n", "no terminator"]


def test_whitespace_set_is_python_isspace():
    assert len(WS_CHARS) == 29
    assert all(c.isspace() for c in WS_CHARS)


def test_lines_follow_universal_newlines(spark):
    got = lines_of(_df(spark, TEXTS), ["id"], "text").orderBy("id", "line_no").collect()
    for i, t in enumerate(TEXTS):
        mine = [(r.line_no, r.line) for r in got if r.id == i]
        assert mine == list(enumerate(py_lines(t), start=1)), t


def test_words_and_strip_follow_python(spark):
    df = _df(spark, TEXTS).select("id", "text", words_of("text").alias("w"), strip_ws("text").alias("s"))
    for r in df.collect():
        assert r.w == r.text.lower().split()
        assert r.s == r.text.strip()


def test_extension_matches_splitext(spark):
    names = ["Makefile", ".bashrc", "a.tar.gz", "x.C", "..x", "a.", "...", "d0", ".a.b", "a b.txt", "été.Pdf"]
    got = _df(spark, names).select("text", file_ext("text").alias("e")).collect()
    for r in got:
        assert r.e == os.path.splitext(r.text)[1], r.text


def test_lower_matches_python_on_sigma_and_dotted_i(spark):
    r = spark.range(1).select(F.lower(F.lit("ΑΣ")).alias("a")).first()
    assert r.a == "ΑΣ".lower()
