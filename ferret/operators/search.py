"""One entry point for both search methods (the reference's method switch)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferret.operators import exact, fuzzy

METHODS = ("exact", "fuzzy")


def search(lines: DataFrame, query: str, key_cols, method: str = "exact",
           cutoff: float = fuzzy.DEFAULT_CUTOFF) -> DataFrame:
    """Hits of one method with a common schema:
    keys, line_no, line, method, matched_token, select_score, confidence
    (the last three are null for exact hits)."""
    key_cols = list(key_cols)
    if method == "exact":
        hits = exact.exact_search(lines, query, key_cols)
        return hits.select(*key_cols, "line_no", "line", F.lit("exact").alias("method"),
                           F.lit(None).cast("string").alias("matched_token"),
                           F.lit(None).cast("double").alias("select_score"),
                           F.lit(None).cast("double").alias("confidence"))
    if method == "fuzzy":
        hits = fuzzy.fuzzy_search(lines, query, key_cols, cutoff)
        return hits.select(*key_cols, "line_no", "line", F.lit("fuzzy").alias("method"),
                           "matched_token", "select_score", "confidence")
    raise ValueError(f"method must be one of {METHODS}, got {method!r}")


def search_methods(lines: DataFrame, query: str, key_cols, methods=METHODS,
                   cutoff: float = fuzzy.DEFAULT_CUTOFF) -> DataFrame:
    """Hits of several methods from one scan: each line is tested by every method in its
    row and gives one row for each hit."""
    key_cols, methods = list(key_cols), list(methods)
    if not methods or any(m not in METHODS for m in methods):
        raise ValueError(f"methods must be among {METHODS}")
    if len(set(methods)) == 1:
        return search(lines, query, key_cols, methods[0], cutoff)
    q = exact.check_query(query).lower()
    found = fuzzy.with_best_word(lines.withColumn("_x", F.lower("line").contains(F.lit(q))), query, cutoff, keep=F.col("_x"))
    row = [F.struct(F.lit("exact").alias("method"), F.lit(None).cast("string").alias("matched_token"),
                    F.lit(None).cast("double").alias("select_score"), F.lit(None).cast("double").alias("confidence")),
           F.struct(F.lit("fuzzy").alias("method"), F.col("_b.matched_token").alias("matched_token"),
                    F.col("_b.select_score").alias("select_score"), F.col("_b.confidence").alias("confidence"))]
    hits = F.array_compact(F.array(F.when(F.col("_x"), row[0]), F.when(F.col("_b.matched_token").isNotNull(), row[1])))
    return (found.select(*key_cols, "line_no", exact.strip_ws("line").alias("line"), F.explode(hits).alias("_h"))
            .select(*key_cols, "line_no", "line", "_h.*"))
