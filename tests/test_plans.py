"""Scale properties of the executed plans, so a change cannot silently regress them."""

import re

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL


def _plan(spark, key):
    df = E.queries()[key](spark, SF_SMALL)
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def _broadcast_subtrees(plan):
    """Text of every BroadcastExchange subtree (lines indented deeper than the node)."""
    lines = plan.split("\n")
    out = []
    for i, ln in enumerate(lines):
        if "BroadcastExchange" in ln:
            depth = len(ln) - len(ln.lstrip(" :+-"))
            sub = []
            for nxt in lines[i + 1:]:
                if len(nxt) - len(nxt.lstrip(" :+-")) <= depth:
                    break
                sub.append(nxt)
            out.append("\n".join(sub))
    return out


@pytest.mark.parametrize("key", ["exact_search", "fuzzy_search", "fuzzy_search_upper", "lines_documents"])
def test_single_searches_are_narrow(spark, key):
    plan = _plan(spark, key)
    assert not re.search(r"Join|Aggregate", plan), plan
    assert "Exchange" not in plan


@pytest.mark.parametrize("key", ["fuzzy_multi_query", "exact_multi_query", "exact_multi_query_trigram",
                                 "inventory", "fuzzy_scores"])
def test_corpus_is_never_broadcast(spark, key):
    for sub in _broadcast_subtrees(_plan(spark, key)):
        assert "documents.parquet" not in sub, sub


def test_many_queries_move_no_line(spark):
    """With queries of a checked size a line is searched for all of them where it is read."""
    for key in ("fuzzy_multi_query", "exact_multi_query"):
        plan = _plan(spark, key).split("== Initial Plan ==")[0]
        assert "documents.parquet" in plan and not re.search("SortMergeJoin|Aggregate.*line", plan)
        scan = plan.index("documents.parquet")
        above = [x for x in plan[:scan].split("\n") if "Exchange" in x and "Broadcast" not in x]
        assert not any("line" in x for x in above), plan


def test_many_query_fuzzy_beyond_the_broadcast_uses_hash_aggregates(spark):
    from ferret.operators import multi
    from ferret.plans import catalog
    lines, keys = catalog.corpus_lines(spark, SF_SMALL, "documents")
    scored = spark.createDataFrame([("a", "1", 1.0, 1.0, 1)], "token string, query_id string, select_score double, confidence double, _r long")
    df = multi._best_by_groups(lines.select(*keys, "line_no", "line"), scored, keys)
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_scans_read_only_needed_columns(spark):
    plan = _plan(spark, "type_dispatch")
    assert "ReadSchema: struct<doc_id:bigint>" in plan  # the text column is pruned
    plan = _plan(spark, "exact_search")
    assert re.search(r"ReadSchema: struct<doc_id:bigint,text:string>", plan)


@pytest.mark.parametrize("key", ["exact_multi_query", "exact_multi_query_trigram", "fuzzy_multi_query"])
def test_many_queries_use_no_nested_loop(spark, key):
    assert not re.search("NestedLoop|Cartesian", _plan(spark, key))


def test_broadcast_detection_sees_the_query_side(spark):
    subs = _broadcast_subtrees(_plan(spark, "exact_multi_query"))
    assert subs and any("benchmark.parquet" in s for s in subs)


def test_vocabulary_has_one_shuffle_and_both_methods_one_scan(spark):
    assert len(re.findall(r"Exchange hashpartitioning", _plan(spark, "vocabulary").split("== Initial Plan ==")[0])) == 1
    assert _plan(spark, "search_method_both").split("== Initial Plan ==")[0].count("FileScan") == 1
