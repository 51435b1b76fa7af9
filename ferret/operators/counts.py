"""Hit counts: per file (the reference's ``found``) and in total.

``groupBy(...).count()`` gets a partial aggregate in each task, so only one row
per key and task crosses the shuffle. The total is a global aggregate whose
shuffle carries one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hits_per_file(hits: DataFrame, key_cols) -> DataFrame:
    return hits.groupBy(*key_cols).agg(F.count(F.lit(1)).alias("hits"))


def hits_total(hits: DataFrame) -> DataFrame:
    """One row, 0 when there is no hit."""
    return hits.agg(F.count(F.lit(1)).alias("hits"))


def observe_hits(hits: DataFrame, name: str = "hits"):
    """Count hits while they are written (no second pass): returns (df, observation).

    After an action on ``df`` (a write, say), ``observation.get["hits"]`` holds the total.
    """
    from pyspark.sql import Observation

    obs = Observation(name)
    return hits.observe(obs, F.count(F.lit(1)).alias("hits")), obs
