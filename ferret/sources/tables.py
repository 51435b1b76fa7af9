"""Parquet table sources.

Only the needed columns are selected right at the scan, so the Parquet reader
prunes the rest (``ReadSchema`` in the plan). Tasks come from the input's row groups;
nothing is dealt out anew, so input should not be one large row group.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str, columns=None) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    if columns:
        df = df.select(*columns)
    return df


# Corpus tables: (key columns, text column). The reference's "file" is the key.
CORPORA = {
    "documents": (["doc_id"], "text"),
    "pages": (["page_id"], "html"),
    "conversations": (["conv_id", "turn"], "text"),
    "benchmark": (["item_id"], "text"),
}


def read_corpus(spark: SparkSession, sf_dir: str, name: str):
    """Return (df with keys + text, key columns, text column)."""
    keys, text = CORPORA[name]
    df = read_table(spark, sf_dir, name, keys + [text])
    return df, keys, text
