import corpus_pipeline as P
from ferret.llm import queries
from ferret.llm.common import stored, table
from tests.conftest import SF_MID
from tests.llm.test_dedup import brute_components, brute_cut, brute_print


def test_stages_by_brute_force(spark):
    docs = table(spark, SF_MID, "documents")
    steps = [docs]
    for name, stage in P.STAGES[:-1]:
        steps.append(stored(stage(spark, steps[-1], SF_MID)))
        assert steps[-1].columns == docs.columns, name
    toxic = {r.doc_id for r in queries.op7_toxicity(spark, SF_MID).collect() if r.predicted}
    rows = [{r.doc_id: r for r in s.collect()} for s in steps]
    assert set(rows[1]) == set(rows[0]) - toxic
    prints = {i: brute_print(r.text) for i, r in rows[1].items()}
    root, least = brute_components(set(prints.values())), {}
    for i, p in prints.items():
        least[root[p]] = min(i, least.get(root[p], i))
    assert set(rows[2]) == set(least.values())
    cut = brute_cut([(i, r.text) for i, r in rows[2].items()])
    assert {i: r.text for i, r in rows[3].items()} == {i: cut[i][2] if cut[i][1] else r.text for i, r in rows[2].items()}
    assert all(r.n_chars == len(r.text) for i, r in rows[3].items() if cut[i][1])
    assert set(rows[4]) < set(rows[3])
    last = P.STAGES[-1][1](spark, steps[-1], SF_MID).collect()
    assert {r.doc_id for r in last} == set(rows[4])
    assert len(P.run(spark, SF_MID).collect()) == len(last)


def test_odd_rows_pass_all_stages(spark, odd, empty):
    for docs in (odd, empty):
        for _, stage in P.STAGES[:-1]:
            docs = stored(stage(spark, docs, SF_MID))
            assert docs.columns == odd.columns
        ids = [r.doc_id for r in docs.collect() if r.doc_id is not None]
        assert len(ids) == len(set(ids))
        P.pack(spark, docs, SF_MID).collect()
    assert P.drop_near_duplicates(spark, odd, SF_MID).where("doc_id = 2").count() == 0
