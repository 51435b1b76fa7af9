import hashlib

import numpy as np
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from ferret.llm import queries, simhash, substring_dedup
from ferret.llm.common import table
from tests.conftest import SF_MID
from tests.llm.conftest import words


def brute_print(text):
    w = [x.encode().translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))) for x in words(text)]
    s = [b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxh64_intdigest(x, 42) for x in s]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def brute_components(prints: dict):
    """fp -> root of its component, by comparing all pairs."""
    fps, root = sorted(prints), {}
    for f in fps:
        root[f] = f

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    arr = np.array(fps, np.uint64)
    for i, f in enumerate(fps):
        for j in np.flatnonzero(np.bitwise_count(arr[i + 1:] ^ arr[i]) <= 3) + i + 1:
            a, b = find(f), find(fps[j])
            root[max(a, b)] = min(a, b)
    return {f: find(f) for f in fps}


def test_query_equals_brute_force(spark):
    rows = {r.doc_id: r for r in queries.op10_simhash(spark, SF_MID).collect()}
    texts = {r.doc_id: r.text for r in table(spark, SF_MID, "documents").collect()}
    prints = {i: brute_print(t) for i, t in texts.items()}
    assert {i: f"{p:016x}" for i, p in prints.items()} == {i: r.fingerprint for i, r in rows.items()}
    root = brute_components(set(prints.values()))
    least = {}
    for i, p in prints.items():
        least[root[p]] = min(i, least.get(root[p], i))
    assert {i: least[root[p]] for i, p in prints.items()} == {i: r.component_id for i, r in rows.items()}


def test_links_of_random_bits_and_crowded_cells(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2 ** 63, 40, dtype=np.uint64)
    fps = set(base.tolist())
    for f in base.tolist()[:20]:
        for _ in range(40):  # chains and balls around a fingerprint
            for k in rng.integers(0, 64, rng.integers(1, 5)):
                f ^= 1 << int(k)
            fps.add(f)
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    from ferret.llm.components import components
    for chunk in (4, 512):
        found = {r.node: r.root for r in components(simhash.links(df, 3, chunk)).collect()}
        want = brute_components(fps)
        signed = {f: f - (1 << 64) if f >> 63 else f for f in fps}
        groups = {}
        for f, r in want.items():
            groups.setdefault(r, set()).add(signed[f])
        expect = {x: min(g) for g in groups.values() if len(g) > 1 for x in g}
        assert found == expect


def test_exploded_cells_are_never_broadcast(spark):
    fps = spark.range(3000).select(F.xxhash64("id").alias("fp")).groupBy("fp").agg(F.count(F.lit(1)).alias("n"))
    found = simhash.links(fps.select("fp"))
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_simhash_odd_rows(odd, empty):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert {r.component_id for i in (1, 2) for r in by[i]} == {1} and len(by[2]) == 2
    assert {by[i][0].fp for i in (3, 4, 5)} == {0} and {by[i][0].component_id for i in (3, 4, 5)} == {3}
    assert all(r.component_id is None for r in by[None])
    assert by[8][0].fp == by[10][0].fp  # A-Z lower-cased
    assert simhash.near_duplicates(empty).collect() == []


def brute_cut(rows, window=50):
    seen, out = {}, {}
    for i, t in sorted(rows):
        w = words(t)
        mine = [" ".join(w[k:k + window]) for k in range(len(w) - window + 1)]
        keep = [True] * len(w)
        for k, s in enumerate(mine):
            if s in seen:
                keep[k:k + window] = [False] * window
        seen.update(dict.fromkeys(mine))
        left = " ".join(x for x, y in zip(w, keep) if y)
        out[i] = (len(w), len(w) - sum(keep), left)
    return out


def test_cut_repeats_by_brute_force(spark):
    import random
    rnd = random.Random(3)
    vocabulary = [f"v{k}" for k in range(30)]
    part = [rnd.choice(vocabulary) for _ in range(53)]
    rows = []
    for i in range(60):
        w = [rnd.choice(vocabulary) for _ in range(rnd.randrange(0, 150))]
        at = rnd.randrange(len(w) + 1)
        if i % 3 == 0:
            w[at:at] = part[rnd.randrange(0, 5):]
        if i % 7 == 0:
            w += w[-60:]
        rows.append((i, ("\n" if i % 2 else "  ").join(w)))
    rows += [(100 + i, rows[i][1]) for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for window in (50, 8):
        want = brute_cut(rows, window)
        got = {r.doc_id: r for r in substring_dedup.cut_repeats(df, window).collect()}
        assert {i: (r.n_words, r.n_removed, r.kept) for i, r in got.items()} == {
            i: (n, m, hashlib.sha256(t.encode()).hexdigest()) for i, (n, m, t) in want.items()}
        kept = {r.doc_id: r.kept for r in substring_dedup.cut_repeats(df, window, texts=True).collect()}
        assert kept == {i: t if m else None for i, (n, m, t) in want.items()}


def test_cut_odd_rows(odd, empty):
    rows = substring_dedup.cut_repeats(odd).collect()
    got = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert got[1].n_removed == 0 and got[2].n_removed == 70 and got[7].n_removed == 70
    assert got[7].kept == hashlib.sha256(b"tail words here").hexdigest()
    assert got[3].n_words == 0 and got[3].kept == hashlib.sha256(b"").hexdigest()
    assert sum(r.doc_id is None for r in rows) == 2 and len(rows) == odd.count()
    assert substring_dedup.cut_repeats(empty).collect() == []


def brute_rows(rows, window=50):
    """[(doc_id, n_words, n_removed, left)] of all rows, several of which may share a doc_id."""
    held = {}
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - window + 1):
            s = " ".join(w[k:k + window])
            held[s] = min(i, held.get(s, i))
    out = []
    for i, t in rows:
        w = words(t)
        keep = [True] * len(w)
        for k in range(len(w) - window + 1):
            if held[" ".join(w[k:k + window])] < i:
                keep[k:k + window] = [False] * window
        out.append((i, len(w), len(w) - sum(keep), " ".join(x for x, y in zip(w, keep) if y)))
    return sorted(out)


def test_every_row_of_a_repeated_doc_id_speaks(spark):
    import corpus_pipeline as P
    a, b = " ".join(f"a{k}" for k in range(60)), " ".join(f"b{k}" for k in range(55))
    rows = [(1, "x y"), (1, a), (2, a), (2, b), (2, b + " more"), (3, b), (3, "c " + a + " d"), (3, None), (4, a + "\n" + b), (4, a + " " + b)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_rows(rows)
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept) for r in substring_dedup.cut_repeats(df).collect())
    assert got == sorted((i, n, m, hashlib.sha256(t.encode()).hexdigest()) for i, n, m, t in want)
    cut = P.cut_repeats(spark, df.withColumnRenamed("doc_id", "DOC_ID").withColumnRenamed("DOC_ID", "doc_id")
                        .selectExpr("*", "1 AS __id", "2 AS __kept", "3 AS __digest", "4 AS __own"), "")
    left = sorted((r.doc_id, " ".join(words(r.text))) for r in cut.collect())
    assert left == sorted((i, t) for i, _, _, t in want) and cut.columns == ["doc_id", "text", "__id", "__kept", "__digest", "__own"]
