"""Fuzzy search: per line, the best word whose similarity to the query reaches the cutoff.

Plan, one scan of the corpus and no shuffle:

1. split each line into lower-case words (native array);
2. keep the words that pass the length and character bounds (native predicate
   inside ``filter``); lines without a candidate are dropped here;
3. only the candidate arrays cross into Python (Arrow batches), where each word
   is scored once per task (memo) and the best word of the line is chosen:
   largest select_score >= cutoff, ties to the larger word, as
   ``heapq.nlargest`` inside ``get_close_matches`` does.

All words of a line live in one row, so choosing the best needs no grouping;
the plan is scan -> project -> filter -> Python -> filter, embarrassingly parallel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferret.functions.similarity import best_word_udf, bounds_pass, check_cutoff, score_udf
from ferret.functions.text import strip_ws, words_of
from ferret.operators.exact import check_query

# Fixed value: the default cutoff of the fuzzy search.
DEFAULT_CUTOFF = 0.85


def scored(cands: DataFrame, query: str, cutoff: float = DEFAULT_CUTOFF) -> DataFrame:
    """Adds select_score and confidence; keeps select_score >= cutoff."""
    cutoff = check_cutoff(cutoff)
    s = score_udf(query).asNondeterministic()(F.col("token"))
    return (cands.withColumn("_s", s)
            .select(*[c for c in cands.columns], F.col("_s.select_score").alias("select_score"),
                    F.col("_s.confidence").alias("confidence"))
            .filter(F.col("select_score") >= F.lit(cutoff)))


def with_best_word(lines: DataFrame, query: str, cutoff: float, line_col: str = "line", keep=None) -> DataFrame:
    """Lines that have a candidate word (or meet ``keep``) with ``_b``, their best word or nulls."""
    q = check_query(query).lower()
    cutoff = check_cutoff(cutoff)
    cands = F.filter(words_of(line_col), lambda t: bounds_pass(t, q, cutoff))
    some = F.size("_c") > 0
    found = lines.withColumn("_c", cands).filter(some if keep is None else some | keep)
    return found.withColumn("_b", best_word_udf(query, cutoff).asNondeterministic()(F.col("_c"))).drop("_c")


def fuzzy_search(lines: DataFrame, query: str, key_cols, cutoff: float = DEFAULT_CUTOFF,
                 line_col: str = "line") -> DataFrame:
    """Hits: keys, line_no, stripped line, matched_token, select_score, confidence."""
    key_cols = list(key_cols)
    found = with_best_word(lines.select(*key_cols, "line_no", F.col(line_col).alias("line")), query, cutoff)
    return (found.filter(F.col("_b.matched_token").isNotNull())
            .select(*key_cols, "line_no", strip_ws("line").alias("line"),
                    F.col("_b.matched_token").alias("matched_token"),
                    F.col("_b.select_score").alias("select_score"),
                    F.col("_b.confidence").alias("confidence")))


def fuzzy_scores(tokens: DataFrame, query: str, cutoff: float = DEFAULT_CUTOFF) -> DataFrame:
    """Distinct words that reach the cutoff, with both scores (F4 on its own)."""
    q = check_query(query).lower()
    cutoff = check_cutoff(cutoff)
    words = tokens.select("token").filter(bounds_pass(F.col("token"), q, cutoff)).distinct()
    return scored(words, query, cutoff)


def vocabulary(docs: DataFrame, text_col: str) -> DataFrame:
    """Distinct words with occurrence and document counts; ``docs`` has one row per document.

    A document leaves its words twice, all of them and each once, as two arrays of their own
    rows, and one hash aggregation by word follows. (Line breaks are whitespace, so whole
    texts need no line split. An array carried beside its exploded words would be copied
    for every word, which is quadratic in a text's length.)
    """
    arrays = docs.select(words_of(text_col).alias("_w")).select(F.explode(F.array(
        F.struct(F.lit(1).alias("all"), F.col("_w").alias("words")),
        F.struct(F.lit(0).alias("all"), F.array_distinct("_w").alias("words")))).alias("_s"))
    return (arrays.select("_s.all", F.explode("_s.words").alias("token")).groupBy("token")
            .agg(F.sum("all").cast("bigint").alias("occurrences"), F.sum(1 - F.col("all")).cast("bigint").alias("docs")))


def format_confidence(col) -> F.Column:
    """``{score:.5f}`` for display; compare raw doubles, not this text."""
    return F.format_string("%.5f", col)
