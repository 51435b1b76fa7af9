"""Whitening, spelling variants and MinHash against plain brute force."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from ferret.llm import minhash, queries, spelling, whitening
from ferret.llm.common import table
from tests.conftest import SF_MID
from tests.llm.conftest import words

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
VECTORS = "vec_id long, embedding array<double>, n long, component string, whitened string"


# --- whitening ---------------------------------------------------------------------------

def brute_whitening(rows, k=8):
    """(n, {id: deviation}, components' deviations, whitened up to sign, trace)."""
    x = np.floor(1024 * np.array([v for _, v in rows], float)).astype(np.int64) + 100_000
    n, s = len(x), x.sum(0)
    c = (n * x - s) / n
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1], u[:, ::-1]
    return n, ((n * x - s) ** 2).sum(1), e, c @ u[:, :k] / np.sqrt(e[:k])


def compare_whitening(out, rows, k):
    n, dev, e, w = brute_whitening(rows, k)
    got = out.orderBy("component", "vec_id").toPandas()
    order = np.argsort([i for i, _ in rows], kind="stable")
    assert len(got) == k * len(rows) and set(got.n) == {n} and got.identity_error.max() < 1e-9
    for j in range(k):
        part = got[got.component == j + 1]
        assert part.deviation.tolist() == dev[order].tolist()
        assert np.allclose(part.explained, e[j] / e.sum(), rtol=1e-10, atol=0)
        sign = np.sign(part.whitened.to_numpy() @ w[order, j])
        assert np.abs(sign * part.whitened.to_numpy() - w[order, j]).max() < 1e-8


def test_whitening_query_equals_eigenvectors(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF_MID, "embeddings").collect()]
    compare_whitening(queries.op11_embedding_whitening(spark, SF_MID), rows, 8)


def test_whitening_odd_rows_and_ties(spark):
    rng = np.random.default_rng(3)
    good = [(i, list(map(float, rng.normal(size=5) * [5, 3, 2, 1, .5]))) for i in range(40)]
    good += [good[0], good[1], (None, good[2][1])]
    nan, inf = float("nan"), float("inf")
    bad = [(90, None), (91, []), (92, [None, 1., 2., 3., 4.]), (93, [nan, 1., 2., 3., 4.]), (94, [inf, 1., 2., 3., 4.]),
           (95, [1e300, 1., 2., 3., 4.]), (96, [1., 2.])]
    df = spark.createDataFrame([(i, v, 7, "c", "w") for i, v in good + bad], VECTORS)
    got = whitening.whiten(df, 5)
    assert got.where("vec_id is null").count() == 5 and got.where("vec_id >= 90").count() == 0
    with_ids = [(i, v) for i, v in good if i is not None] + [(1000, good[2][1])]
    compare_whitening(got.na.fill({"vec_id": 1000}), with_ids, 5)


def test_whitening_equal_deviations_and_low_rank(spark):
    # the corners of a cube: three equal deviations; the fourth dimension repeats the first
    cube = [(i, [float(2 * (i >> k & 1) - 1) for k in (0, 1, 2, 0)]) for i in range(8)]
    got = whitening.whiten(spark.createDataFrame([(i, v, 0, "", "") for i, v in cube], VECTORS)).toPandas()
    assert sorted(got.component.unique()) == [1, 2, 3] and got.identity_error.max() < 1e-12
    share = got.groupby("component").explained.first()
    assert np.allclose(share, [.5, .25, .25])
    same = spark.createDataFrame([(i, [1., 2.], 0, "", "") for i in range(4)], VECTORS)
    assert whitening.whiten(same).count() == 0 == whitening.whiten(same.limit(1)).count()
    assert whitening.whiten(spark.createDataFrame([], VECTORS)).count() == 0


def test_whitening_wide_numbers_are_exact(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(rng.integers(-2 ** 29, 2 ** 29)), float(rng.normal())]) for i in range(30)]
    got = whitening.whiten(spark.createDataFrame([(i, v, 0, "", "") for i, v in rows], VECTORS)).toPandas()
    x = [[int(np.floor(1024 * c)) for c in v] for _, v in rows]
    s = [sum(c) for c in zip(*x)]
    dev = {i: sum((30 * c - t) ** 2 for c, t in zip(v, s)) for (i, _), v in zip(rows, x)}
    for r in got.itertuples():
        assert np.isnan(r.deviation) if dev[r.vec_id] >= 1 << 63 else r.deviation == dev[r.vec_id]


# --- spelling variants -------------------------------------------------------------------

def brute_words(texts):
    total = Counter()
    for i, t in texts:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = w.translate(AZ)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 199 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            total[w] += 1
    return {w: n for w, n in total.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute_variants(counts, near):
    form = {}
    for w, n in counts.items():
        if near[w]:
            f = min(near[w], key=lambda v: (-counts[v], v))
            if counts[f] >= 5 * n:
                form[w] = f
    out = {}
    for w, n in counts.items():
        r = w
        while r in form:
            r = form[r]
        out[w] = (form.get(w), r, n, len(near[w]), counts[form[w]] if w in form else None)
    return out


def all_near(counts):
    near = defaultdict(set)
    kinds = sorted(counts)
    for i, a in enumerate(kinds):
        for b in kinds[i + 1:]:
            if abs(len(a) - len(b)) < 2 and one_edit(a, b):
                near[a].add(b), near[b].add(a)
    return near


def near_by_deletion(counts):
    """The same from words that share a string with one code point less."""
    near, groups = defaultdict(set), defaultdict(set)
    for w in counts:
        for k in range(len(w)):
            v = w[:k] + w[k + 1:]
            groups[k, v].add(w)
            if v in counts:
                near[w].add(v), near[v].add(w)
    for g in groups.values():
        for w in g:
            near[w] |= g - {w}
    return near


def collected(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_variants_query_equals_brute_force(spark):
    counts = brute_words([(r.doc_id, r.text) for r in table(spark, SF_MID, "documents").collect()])
    assert collected(queries.op12_spelling_variants(spark, SF_MID)) == brute_variants(counts, near_by_deletion(counts))


@pytest.mark.parametrize("tile", [3, 512])
def test_variants_in_crowded_groups(spark, tile):
    rng = np.random.default_rng(2)
    base = ["common", "commons", "straße", "aaaaaaa", "élèves", "x" * 300]
    kinds = set(base)
    for w in base * 25:
        for _ in range(rng.integers(1, 3)):
            k, c = int(rng.integers(0, len(w) + 1)), "abcéx"[rng.integers(0, 5)]
            w = [w[:k] + c + w[k:], w[:k] + w[k + 1:], w[:k] + c + w[k + 1:]][rng.integers(0, 3)]
        kinds.add(w)
    texts = [(i, " ".join([w] * int(5 ** rng.integers(1, 5)))) for i, w in enumerate(sorted(kinds))]
    counts = brute_words(texts)
    df = spark.createDataFrame(texts, "doc_id long, text string")
    want = brute_variants(counts, all_near(counts))
    assert collected(spelling.variants(df, tile=tile)) == want
    assert any(f and want[f][0] for f, *_ in want.values())  # a form of a form


def test_variants_odd_rows(spark, odd, empty):
    texts = [(r.doc_id, r.text) for r in odd.collect()] + [(None, "Zugabe zugabe ZUGABE zugaben " * 9)]
    df = odd.unionByName(spark.createDataFrame([(None, texts[-1][1], "w", "s", 0, 0, 0.5, "h")], odd.schema))
    counts = brute_words(texts)
    assert collected(spelling.variants(df)) == brute_variants(counts, all_near(counts))
    assert spelling.variants(empty).count() == 0 == spelling.variants(df.where("text is null")).count()


# --- MinHash -----------------------------------------------------------------------------

def shingles(text):
    w = words((text or "").translate(AZ))
    return frozenset(" ".join(w[k:k + 3]) for k in range(max(1, len(w) - 2))) if w else frozenset()


def brute_near(rows, percent=85):
    """[(doc_id, size, component)] by comparing all that share a shingle."""
    sets = [shingles(t) for _, t in rows]
    held, root = defaultdict(list), list(range(len(rows)))
    for k, s in enumerate(sets):
        if rows[k][0] is not None:
            for g in s:
                held[g].append(k)

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for k, s in enumerate(sets):
        if rows[k][0] is not None:
            for j, c in Counter(j for g in s for j in held[g] if j < k).items():
                if 100 * c >= percent * (len(s) + len(sets[j]) - c):
                    a, b = find(k), find(j)
                    root[max(a, b)] = min(a, b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return Counter((i, len(sets[k]), None if i is None else least[find(k)]) for k, (i, _) in enumerate(rows))


def near_rows(df):
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


def test_minhash_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF_MID, "documents").collect()]
    out = queries.op13_minhash(spark, SF_MID)
    assert near_rows(out) == brute_near(rows)
    assert out.where("kept != (doc_id = component_id)").count() == 0


@pytest.mark.parametrize("bucket, cluster", [(4, 3), (2048, 512)])
def test_minhash_crowded_groups(spark, bucket, cluster):
    """Families whose members link in chains, with some that only resemble: small chunks
    must join what whole groups join."""
    rng = np.random.default_rng(4)
    rows = []
    for f in range(3):
        text = [f"f{f}w{k}" for k in range(150)]
        for _ in range(60):
            t = list(text)
            for k in rng.integers(0, 150, rng.integers(1, 8)):
                t[k] = f"x{rng.integers(0, 10 ** 9)}"
            rows.append((len(rows), " ".join(t)))
            if rng.random() < .3:
                text = t  # drift
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute_near(rows)
    assert near_rows(minhash.near_duplicates(df, bucket_chunk=bucket, cluster_chunk=cluster)) == want
    assert 3 < len({c for _, _, c in want}) < 150


def test_minhash_odd_rows(spark, odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert near_rows(minhash.near_duplicates(odd)) == brute_near(rows)
    assert minhash.near_duplicates(empty).count() == 0 == minhash.near_duplicates(odd.where("doc_id = 99")).count()


def test_sketches_fill_and_estimate():
    rng = np.random.default_rng(6)
    for size in (1, 2, 40, 3000):
        both = rng.integers(0, 2 ** 63, 2 * size, dtype=np.uint64)
        a, b = np.unique(both[:-(size // 4) or None]), np.unique(both[size // 4:])
        first = np.array([0, len(a), len(a) + len(b)])
        s = minhash.sketches(np.concatenate([a, b]), first)
        assert (s != minhash._EMPTY).all()
        alike = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs((s[0] == s[1]).mean() - alike) < 0.2
    assert (minhash.sketches(np.zeros(0, np.uint64), np.zeros(2, np.int64)) == minhash._EMPTY).all()
