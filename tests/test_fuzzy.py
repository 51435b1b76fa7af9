import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from ferret.functions.similarity import bounds_pass, check_cutoff
from ferret.functions.text import lines_of
from ferret.operators.fuzzy import fuzzy_search
from tests.brute import fuzzy_hits


def _search(spark, texts, query, cutoff):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    rows = fuzzy_search(lines_of(df, ["id"], "text"), query, ["id"], cutoff).collect()
    return sorted((r.id, r.line_no, r.line, r.matched_token, r.select_score, r.confidence) for r in rows)


def _brute(texts, query, cutoff):
    return sorted((i, *h) for i, t in enumerate(texts) for h in fuzzy_hits(t, query, cutoff))


@pytest.mark.parametrize("query,words,cutoff,token,conf", [
    ("HELLO", "hello", 0.85, "hello", 0.0),
    ("Hello", "hello", 0.85, "hello", 0.8),
    ("abcd", "abce abcf abca", 0.5, "abcf", None),
    ("abc", "zzz", 0.0, "zzz", None),
])
def test_pinned_choices(spark, query, words, cutoff, token, conf):
    got = _search(spark, [words], query, cutoff)
    assert len(got) == 1 and got[0][3] == token
    if conf is not None:
        assert got[0][5] == conf


def test_multi_word_query_does_not_match(spark):
    assert _search(spark, ["hello world again"], "hello world", 0.85) == []


def test_pinned_ratios():
    assert SequenceMatcher(None, "tide", "diet").ratio() == 0.25
    assert SequenceMatcher(None, "diet", "tide").ratio() == 0.5
    assert SequenceMatcher(None, "license", "license,").ratio() == 0.9333333333333333


def test_cutoff_checked():
    for bad in (-0.1, 1.5, float("nan")):
        with pytest.raises(ValueError):
            check_cutoff(bad)
    assert check_cutoff(0) == 0.0 and check_cutoff(1) == 1.0


def test_bounds_never_below_ratio(spark):
    rnd = random.Random(7)
    alphabet = "abcdeéñ"
    words = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 9))) for _ in range(400)]
    df = spark.createDataFrame([(w,) for w in words], "token string")
    for q in ("abc", "déjà", "aaab"):
        kept = {r.token for r in df.filter(bounds_pass(F.col("token"), q, 0.6)).collect()}
        for w in words:
            if SequenceMatcher(None, w, q).ratio() >= 0.6:
                assert w in kept


def test_random_lines_equal_brute_force(spark):
    rnd = random.Random(11)
    vocab = ["the", "The", "then", "license", "licence", "license,", "reaution", "caution", "über", "Über",
             "ab", "a", "xyz", "hello", "HELLO", "ratio", "ration", "nation", "station"]
    seps = [" ", "  ", "\t", "　", "\xa0"]
    texts = []
    for _ in range(60):
        lines = [rnd.choice(seps).join(rnd.choice(vocab) for _ in range(rnd.randint(0, 8))) for _ in range(rnd.randint(0, 5))]
        texts.append(rnd.choice(["\n", "\r\n", "\r"]).join(lines) + rnd.choice(["", "\n"]))
    for query, cutoff in [("license", 0.85), ("The", 0.85), ("Reaution", 0.7), ("nation", 0.6), ("ab", 0.0)]:
        assert _search(spark, texts, query, cutoff) == _brute(texts, query, cutoff), query
