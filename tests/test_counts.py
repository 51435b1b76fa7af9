from ferret.operators import counts, exact
from ferret.plans import catalog
from tests.conftest import SF_SMALL


def test_observed_total_equals_count(spark, tmp_path):
    df, keys, text = catalog.read_corpus(spark, SF_SMALL, "documents")
    hits = exact.exact_search_texts(df, "the", keys, text)
    observed, obs = counts.observe_hits(hits)
    observed.write.parquet(str(tmp_path / "hits"))
    assert obs.get["hits"] == spark.read.parquet(str(tmp_path / "hits")).count() > 0
    assert counts.hits_total(hits).first().hits == obs.get["hits"]
