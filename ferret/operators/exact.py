"""Exact search: lines whose lower-case form contains the lower-case query.

One hit per line; the match sees the raw line (blanks count), the output shows
it stripped. Case-insensitive substring only: no regex and no LIKE, so no
escaping is needed. Everything is a narrow filter over a scan: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferret.functions.text import lines_of, strip_ws


def check_query(query: str) -> str:
    if not isinstance(query, str) or query == "":
        raise ValueError("query must be a non-empty string")
    return query


def exact_search(lines: DataFrame, query: str, key_cols, line_col: str = "line") -> DataFrame:
    """Hits over numbered lines: keys, line_no, stripped line."""
    q = check_query(query).lower()
    return (lines
            .filter(F.lower(F.col(line_col)).contains(F.lit(q)))
            .select(*key_cols, "line_no", strip_ws(line_col).alias("line")))


def exact_search_texts(docs: DataFrame, query: str, key_cols, text_col: str) -> DataFrame:
    """Hits straight from a table of whole texts.

    A line can only hit if its whole text contains the query (lower-casing never
    looks across a line break), so texts without it are dropped before they are
    split into lines. That test runs on the compressed scan output and saves the
    split/explode work for every text that cannot match.
    """
    q = check_query(query).lower()
    candidates = docs.filter(F.lower(F.col(text_col)).contains(F.lit(q)))
    return exact_search(lines_of(candidates, key_cols, text_col), query, key_cols)
