import math
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa

from ferret.llm import brown_lm, quality_model, queries, toxicity, wordhash
from ferret.llm.common import held_out, table
from pyspark.sql import functions as F
from tests.conftest import SF_MID
from tests.llm.conftest import words


def _accuracy(spark, rows, label, dir=SF_MID):
    truth = {r.doc_id: r[label] for r in table(spark, dir, "labels").collect()}
    seen = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    return sum(p == t for p, t in seen) / len(seen)


def test_quality_held_out(spark):
    rows = queries.op2_quality_classifier(spark, SF_MID).collect()
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert _accuracy(spark, rows, "quality") > 0.95


def test_toxicity_held_out(spark):
    rows = queries.op7_toxicity(spark, SF_MID).collect()
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert _accuracy(spark, rows, "toxic") > 0.9


def test_flat_trees_equal_a_walk():
    rng = np.random.default_rng(0)
    x = rng.random((500, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    t = quality_model.grow(x, y)
    for row in x[:20]:
        total = t.base
        for f, th, leaf in zip(t.feature, t.threshold, t.leaf):
            node = 0
            while node < len(f):
                node = 2 * node + 1 + (row[f[node]] > th[node])
            total += leaf[node - len(f)]
        assert math.isclose(total, t.margin(row[None])[0], rel_tol=1e-9)
    assert ((t.margin(x) > 0) == (y == 1)).mean() > 0.97


def test_segments_are_the_best_ones():
    rng = np.random.default_rng(2)
    for _ in range(200):
        s = rng.normal(-0.3, 1, rng.integers(1, 14))
        run = np.r_[0, np.cumsum(s)]
        up = np.flatnonzero(s > 0)
        got = toxicity._segments(up.tolist(), run[up].tolist(), run[up + 1].tolist())

        def best(lo, hi):  # all maximal segments, by definition: the best one, then both sides
            every = [(run[j + 1] - run[i], -(j - i), i, j) for i in range(lo, hi) for j in range(i, hi)]
            if not every or max(every)[0] <= 0:
                return []
            _, _, i, j = max(every)
            return best(lo, i) + [(i, j)] + best(j + 1, hi)
        want = best(0, len(s))
        assert np.isclose(sum(x for *_, x in got), sum(run[j + 1] - run[i] for i, j in want))
        assert np.isclose(max([x for *_, x in got], default=0), max([run[j + 1] - run[i] for i, j in want], default=0))


def test_models_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 0, 1), (6, 1, 0), (7, 0, 1), (8, 1, 0), (9, 1, 0), (9, 0, 0), (None, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    none = labels.where("false")
    never = lambda i: F.lit(False)
    for docs in (odd, empty):
        for lab in (labels, none):
            q = quality_model.scored(docs, quality_model.fit(docs, lab, never)).collect()
            t = toxicity.scored(docs, toxicity.fit(docs, lab, never), names=("s", "p")).collect()
            assert len(q) == len(t) == docs.count()
            assert all(0 <= r.score <= 1 for r in q) and all(0 <= r.s <= 1 for r in t)
        assert toxicity.scored(docs, toxicity.fit(docs, none, never), names=("s", "p")).columns == [*docs.columns, "s", "p"]
        model, counts = brown_lm.fit(docs)
        rows = brown_lm.scored(docs, model, counts).collect()
        assert len(rows) == docs.count() and all(r.n_tokens >= 1 and r.score < 0 for r in rows)
    model, counts = brown_lm.fit(empty)
    assert len(brown_lm.scored(odd, model, counts).collect()) == odd.count()


def test_language_model_counts(spark):
    docs = {r.doc_id: r.text for r in table(spark, SF_MID, "documents").collect()}
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = {i: words(t.translate(low)) + [None] for i, t in docs.items()}
    seen = Counter(w for i, ws in tokens.items() if crc32(str(i).encode()) % 5 != 1 for w in ws)
    n, v = sum(seen.values()), len(seen)
    gain = []
    for r in queries.op9_brown_lm(spark, SF_MID).collect():
        ws = tokens[r.doc_id]
        base = sum(math.log10((seen[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(w in seen for w in ws), n)
        assert math.isclose(base, r.base_score, rel_tol=1e-9)
        if r.held_out:
            gain.append((r.score - base) / len(ws))
    assert np.mean(gain) > 0


def test_exchange_ends_where_no_move_helps():
    rng = np.random.default_rng(4)
    counts = np.zeros((brown_lm._SIZE, brown_lm._SIZE))
    group = rng.integers(0, 3, 60)  # hidden classes that follow one another in turn
    for _ in range(20_000):
        a = rng.integers(0, 60)
        b = rng.choice(np.flatnonzero(group == (group[a] + 1) % 3))
        counts[a, b] += 1

    def fit(of):
        m = of.max() + 1
        t = np.zeros((m, m))
        np.add.at(t, (of[:, None], of[None, :]), counts)
        return (brown_lm._g(t).sum() - brown_lm._g(t.sum(0)).sum() - brown_lm._g(t.sum(1)).sum())
    start, end = brown_lm.exchange(counts, 3, 0), brown_lm.exchange(counts, 3, 50)
    assert fit(end) > fit(start)
    for i in range(60):  # no move of one unit is left that raises it
        for c in range(3):
            other = end.copy()
            other[i] = c
            assert fit(other) <= fit(end) + 1e-6


def test_gain_of_a_word_is_that_of_the_likelihood():
    rng = np.random.default_rng(5)
    m, words = brown_lm._M, 300
    counts = rng.poisson(0.3, (words, words)).astype(float)
    of = rng.integers(0, 7, words)

    def table(of):
        t = np.zeros((m, m))
        np.add.at(t, (of[:, None], of[None, :]), counts)
        return t
    now = table(of)
    for w in range(10):
        left, right = (np.bincount(of, x, m) for x in (counts[:, w], counts[w]))
        own = counts[w, w]
        left[of[w]] -= own
        right[of[w]] -= own
        up = brown_lm._dense(left[None], right[None], np.array([own]), of[w:w + 1], now)[0]
        cell, n = np.r_[np.arange(2 * m), brown_lm._SELF], np.r_[left, right, own].astype(int)
        near = brown_lm._sparse(np.zeros(2 * m + 1, int)[n > 0], cell[n > 0], n[n > 0], 1, np.array([own]), of[w:w + 1], now)[0]
        for c in range(7):
            other = of.copy()
            other[w] = c
            gain = brown_lm.likelihood(table(other)) - brown_lm.likelihood(now)
            assert math.isclose(up[c] - up[of[w]], gain, abs_tol=1e-6)
            assert abs(near[c] - near[of[w]] - gain) < 3 + 0.1 * abs(gain)  # the table is small beside the word


def test_gains_of_equal_cells_are_reckoned_once(monkeypatch):
    """The logarithms behind the exchange follow the different cells and counts, not the words that have them."""
    rng = np.random.default_rng(7)
    m, size, reckoned, g = brown_lm._M, 5000, [0], brown_lm._g
    table = rng.poisson(30, (m, m)).astype(float)
    word = np.repeat(np.arange(size), 6)
    cell = np.sort(np.array([rng.choice(2 * m, 6, replace=False) for _ in range(size)]), axis=1).ravel()
    n, a, own = rng.integers(1, 4, len(word)), rng.integers(0, brown_lm.CLASSES, size), rng.integers(0, 3, size).astype(float)

    def counted(x):
        reckoned[0] += np.size(x)
        return g(x)
    monkeypatch.setattr(brown_lm, "_g", counted)
    up = brown_lm._sparse(word, cell, n, size, own, a, table)
    assert reckoned[0] < 8 * len(word) + 10 * m * m * brown_lm.CLASSES < len(word) * brown_lm.CLASSES * 2
    row, col = table.sum(1), table.sum(0)
    for w in rng.integers(0, size, 20):
        for c in range(brown_lm.CLASSES):
            want, sums = g(table[c, c] + own[w]) - g(table[c, c]), [own[w], own[w]]
            for x, k in zip(cell[word == w], n[word == w]):
                side, d = divmod(x, m)
                t = (table[d, c] if side == 0 else table[c, d]) - (k if c == a[w] else 0)
                want += g(max(t, 0) + k) - g(max(t, 0))
                sums[side] += k
            for total, k in zip((col[c], row[c]), sums):
                t = max(total - (k if c == a[w] else 0), 0)
                want -= g(t + k) - g(t)
            assert math.isclose(up[w, c], want, abs_tol=1e-8)


def test_places_of_hashes_in_full_bins():
    rng = np.random.default_rng(8)
    low = rng.integers(0, 1 << 40, 40).astype(np.uint64)
    for key in (np.zeros(0, np.uint64), np.unique(np.r_[low, low + np.uint64(3 << 62), np.uint64(2**64 - 1) - low, np.uint64(0)]),
                np.unique(rng.integers(0, 2**64, 3000, np.uint64))):
        h = np.r_[key[::-1], key + np.uint64(1), low, rng.integers(0, 2**64, 1000, np.uint64), np.uint64(0), np.uint64(2**64 - 1)]
        where = {k: i for i, k in enumerate(key.tolist())}
        assert brown_lm._places(key)(h).tolist() == [where.get(x, len(key)) for x in h.tolist()]


def test_endings_are_those_of_the_last_three_bytes():
    text = "a Bc dEf ghij é xyé " + "long" * 100_000
    h, first, ending = brown_lm.tokens(pa.array([text, None, "", "Z", text]))
    want = [w.encode() for w in [*words(text.lower()), "z", *words(text.lower())]]
    assert h.tolist() == [wordhash.word_hash(w.decode()) for w in want] and first.tolist() == [0, 7, 7, 7, 8, 15]

    def group(w):
        return int(wordhash.hashes(np.frombuffer(w[-3:], np.uint8), np.array([0]), np.array([len(w[-3:])]))[0] % np.uint64(brown_lm.ENDINGS))
    assert ending(np.arange(15)).tolist() == [group(w) for w in want]
    assert ending(np.array([7, 3])).tolist() == [group(want[7]), group(want[3])] and not len(ending(np.zeros(0, np.int64)))


def test_every_word_has_a_class_by_exchange(spark):
    """More words than travel to the tasks, the others of equal endings but of two kinds."""
    rng = np.random.default_rng(6)
    start = [f"h{i}" for i in range(brown_lm.HEADS + 100)]
    texts = [" ".join(start[i] for i in rng.permutation(len(start))) for _ in range(4)]
    # two kinds of frequent words that follow one another; u-words stand like the first, v-words like the second
    texts += [" ".join(f"{'ab'[i % 2]}{rng.integers(20)}" for i in range(200)) for _ in range(100)]
    for k, (before, after) in {"u": "bb", "v": "aa"}.items():
        texts += [f"{before}{rng.integers(20)} {k}{i}ing {after}{rng.integers(20)}" for i in range(100) for _ in range(3)]
    many = [f"z{i}" for i in range(brown_lm.KNOWN + 10)]
    texts += [" ".join(many[i:i + 500]) for i in range(0, len(many), 500) for _ in range(3)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    model, counts = brown_lm.fit(docs)
    of = {r.h: r["class"] for r in counts.collect()}
    assert len(of) + len(model.key) == len({w for t in texts for w in t.split()}) and len(of) > 200
    of |= dict(zip(model.key.view(np.int64).tolist(), model.of.tolist()))
    named = {w: of[np.uint64(wordhash.word_hash(w)).astype(np.int64).item()] for w in {w for t in texts for w in t.split()}}
    kinds = [Counter(named[f"{k}{i}ing"] for i in range(100)).most_common(1)[0] for k in "uv"]
    assert kinds[0][0] != kinds[1][0] and min(n for _, n in kinds) > 90
    # transitions and sizes are those of all texts in these classes, and scores follow from them
    n, end = Counter(w for t in texts for w in t.split()), brown_lm.CLASSES
    steps, size = np.zeros((end + 2, end + 1)), np.full(end + 2, 0.5) * np.bincount(model.new, minlength=end + 2)
    size[end] = 1
    for w, c in n.items():
        size[named[w]] += c + 0.5
    for t in texts:
        s = [end + 1, *(named[w] for w in t.split()), end]
        np.add.at(steps, (s[:-1], s[1:]), 1)
    steps = np.log10((steps + brown_lm.SMOOTH) / (steps + brown_lm.SMOOTH).sum(1, keepdims=True))
    assert np.allclose(model.step, steps)
    odd = ["z1 z2 a1 z3 h1", "neverseen z1 neverseen", "", None, "u1ing v1ing h5"]
    got = brown_lm.scored(spark.createDataFrame([*enumerate([*texts[:20], *texts[-20:], *odd])], "doc_id long, text string"), model, counts).collect()
    new = model.new[int(wordhash.hashes(np.frombuffer(b"een", np.uint8), np.array([0]), np.array([3]))[0] % np.uint64(brown_lm.ENDINGS))]
    for r, t in zip(sorted(got, key=lambda r: r.doc_id), [*texts[:20], *texts[-20:], *odd]):
        ws = (t or "").split()
        s = [end + 1, *(named.get(w, new) for w in ws), end]
        want = steps[s[:-1], s[1:]].sum() + sum(math.log10((n[w] + 0.5) / size[c]) for w, c in zip(ws, s[1:]))
        assert math.isclose(r.score, want, rel_tol=1e-9)
        assert r.n_known == sum(w in n for w in ws) + 1
