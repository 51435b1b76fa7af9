"""Quality rules as a short-circuit cascade of native expressions.

The counts of a text are array and string functions in the row, without shuffle.
``base_failed`` follows from two of them. The other rules form a cascade: each rule's
running time and share of rejected texts are measured on a sample, the rules are
ordered by rejection per cost, and a text leaves at its first failed rule. The order
changes the work, never the verdict.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of the sample that rules are timed on.
SAMPLE_ROWS = 1_000
#: Longest text of the sample, which passes the driver.
SAMPLE_BYTES = 1 << 16

_WS = "\t\n\x0b\x0c\r"


def counts(docs: DataFrame) -> DataFrame:
    """Adds the counts of each text to (doc_id, text): n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, and the arrays ``_lines`` and ``_words``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    plain = F.translate("text", _WS, "     ")
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
            .withColumn("_parts", F.split(plain, " ", -1))
            .withColumn("_words", F.array_remove("_parts", "")))
    n = F.size("_words")
    word_chars = F.length("text") - (F.size("_parts") - 1)
    symbols = F.length("text") - F.length(F.translate("text", "#*$%&|<>", ""))
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    spans = F.transform(F.slice("_words", 1, F.greatest(n - 2, F.lit(0))),
                        lambda w, i: F.xxhash64(w, F.get("_words", i + 1), F.get("_words", i + 2)))
    rows = rows.select("doc_id", "text", "_words", n.cast("long").alias("n_words"), word_chars.cast("long").alias("word_chars"),
                       symbols.cast("long").alias("n_symbols"), lines.alias("_lines"), spans.alias("_spans"))
    # most texts repeat no window: only the others are sorted
    ordered = F.when(F.size(F.array_distinct("_spans")) < F.size("_spans"),
                     F.sort_array(F.transform("_spans", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    rows = rows.withColumn("_ordered", ordered).drop("_spans")
    same = F.transform("_ordered", lambda s, k: F.when(
        (s["h"] == F.get("_ordered", k + 1)["h"]) | (s["h"] == F.get("_ordered", k - 1)["h"]), s["i"]))
    rows = rows.withColumn("_starts", F.sort_array(F.array_compact(same))).drop("_ordered")
    covered = F.aggregate("_starts", F.struct(F.lit(-3).alias("at"), F.lit(0).alias("n")),
                          lambda a, s: F.struct(s.alias("at"), (a["n"] + F.least(F.lit(3), s - a["at"])).alias("n")))["n"]
    return rows.select(
        "doc_id", "text", "_words", "_lines", "n_words", "word_chars", "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def rules() -> dict[str, Column]:
    """Name -> whether a text fails. All read the columns of ``counts``."""
    n, words = F.col("n_words"), F.col("_words")
    upper = F.length("text") - F.length(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    marks = F.length("text") - F.length(F.translate("text", "!?", ""))
    lettered = F.size(F.filter(words, lambda w: w.rlike(r"\p{L}")))
    return {
        "symbols": 10 * F.col("n_symbols") > n,
        "word_length": (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 12 * n),
        "same_lines": 10 * F.col("n_dup_lines") > 8 * F.size("_lines"),
        "upper_case": 2 * upper > F.col("word_chars"),
        "marks": 4 * marks > n,
        "letters": 10 * lettered < 7 * n,
        "kinds": 20 * F.size(F.array_distinct(words)) < n,
        "bullets": 10 * F.size(F.filter("_lines", lambda x: F.ltrim(x).rlike("^[-*•]"))) > 9 * F.size("_lines"),
    }


def ordered_rules(docs: DataFrame, checks: dict[str, Column] | None = None) -> list[tuple[str, Column]]:
    """The rules by rejection per cost on a sample, best first (all rules, always).

    The sample is what the first partitions give; no other partition is read for it. A
    rule's cost is that of a run over it, less that of a run without a rule; its rejection
    counts the rows that the rules before it left.
    """
    checks = checks or rules()
    schema = "doc_id long, text string"
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .where(F.coalesce(F.octet_length("text"), F.lit(0)) <= SAMPLE_BYTES).take(SAMPLE_ROWS))
    # filtered after the cache: a filter below it would be pushed into the array expressions
    sample = counts(docs.sparkSession.createDataFrame(rows, schema).coalesce(1)).withColumn("_judge", ~base_failed()).cache()
    judge = sample.where("_judge")
    rejects = {name: set() for name in checks}
    for k, r in enumerate(judge.select([F.coalesce(c, F.lit(False)).alias(n) for n, c in checks.items()]).collect()):
        for name in checks:
            if r[name]:
                rejects[name].add(k)

    def took(c: Column) -> float:
        began = time.perf_counter()
        judge.agg(F.count_if(c)).collect()
        return time.perf_counter() - began

    took(F.lit(False))
    floor = took(F.lit(False))
    cost = {name: max(took(c) - floor, 1e-3) for name, c in checks.items()}
    sample.unpersist()
    order, gone = [], set()
    while len(order) < len(checks):
        order.append(max((n for n in checks if n not in order), key=lambda n: (len(rejects[n] - gone) / cost[n], -cost[n])))
        gone |= rejects[order[-1]]
    return [(name, checks[name]) for name in order]


def judged(docs: DataFrame, checks: dict[str, Column] | None = None) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept) for every row of ``docs`` (doc_id, text).

    Null text has no words and fails the base; null doc_ids and repeated rows are judged
    like others; an empty table gives an empty result. Other columns are not read.
    """
    verdict = F.lit(True)
    for _, fails in reversed(ordered_rules(docs, checks)):
        verdict = F.when(fails, F.lit(False)).otherwise(verdict)
    out = counts(docs).withColumn("base_failed", base_failed())
    # always true, but not deterministic: a filter on the result is then not pushed into the
    # projections, where its copies of the array expressions would run once per element
    stay = F.monotonically_increasing_id() >= 0
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      (F.when(F.col("base_failed"), F.lit(False)).otherwise(verdict) & stay).alias("kept"))
