"""The paths taken above a broadcast bound give the same rows as the broadcast paths."""

import pytest
from pyspark.sql import functions as F

from ferret.operators import exact, multi
from ferret.operators.ingest import with_rank
from ferret.plans import catalog
from ferret.sources.files import read_lines
from tests.conftest import SF_SMALL


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_split_numbering_without_broadcast(spark, tmp_path):
    d = tmp_path / "f"
    d.mkdir()
    (d / "a.txt").write_text("".join(f"n {i}\n" for i in range(1, 4001)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(4096))
    try:
        a = _rows(read_lines(spark, str(d)))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        b = _rows(read_lines(spark, str(d)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert a == b and len(a) == 4000 and all(r[3] == f"n {r[2]}" for r in a)


@pytest.fixture
def shuffled(spark, monkeypatch):
    monkeypatch.setattr(multi, "BROADCAST_BYTES", -1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _joins(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_many_query_fuzzy_without_broadcast(spark, shuffled):
    lines, keys = catalog.corpus_lines(spark, SF_SMALL, "documents")
    q = catalog.benchmark_queries(spark, SF_SMALL).filter("length(query) > 6")
    df = multi.fuzzy_search_many(lines, q, keys, 0.8)
    assert "SortMergeJoin" in _joins(df)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    multi.BROADCAST_BYTES = 16 << 20
    assert _rows(df) == _rows(multi.fuzzy_search_many(lines, q, keys, 0.8)) != []


def test_many_query_exact_without_broadcast(spark, shuffled):
    lines, keys = catalog.corpus_lines(spark, SF_SMALL, "documents")
    q = catalog.benchmark_queries(spark, SF_SMALL).filter("length(query) > 6")
    df = multi.exact_search_many(lines, q.unionByName(spark.createDataFrame([("991", "a"), ("992", "Ly")], q.schema)), keys)
    plan = _joins(df)
    assert "SortMergeJoin" in plan and "NestedLoop" not in plan and "BroadcastHashJoin" not in plan and "Cartesian" not in plan
    want = [(r.query_id, *h) for r in [*q.collect(), *spark.createDataFrame([("991", "a"), ("992", "Ly")], q.schema).collect()]
            for h in _rows(exact.exact_search(lines, r.query, keys))]
    assert _rows(df) == sorted(want)


def test_rank_is_dense_across_partitions(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k")).repartition(8)
    ranked = with_rank(df, [F.col("k")]).collect()
    assert sorted(r["rank"] for r in ranked) == list(range(1, 5001))
    assert all(r["rank"] == r["k"] + 1 for r in ranked)
