"""The similarity ratio of ``difflib.SequenceMatcher`` and its two cheap upper bounds.

``ratio = 2*M / (len(a) + len(b))`` with ``M`` the matched characters of the
recursive longest-block matching. Spark has no built-in equal (``levenshtein``
and ``soundex`` are other measures), so the ratio itself runs in an
Arrow-batched pandas UDF: the matching blocks of all pairs of a batch at once, as sweeps
over arrays of code points (``ratios``). Before it, two bounds that are never below the ratio
run as native columns and drop almost every word:

* length bound: ``2*min(la, lb) / (la + lb)``
* character bound: ``2*|multiset(a) & multiset(b)| / (la + lb)``

Both compute the same double arithmetic as difflib, so ``bound >= cutoff`` keeps
every word whose ratio reaches the cutoff (``autojunk`` only lowers the ratio).
"""

from collections import Counter

import numpy as np
import pandas as pd

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Per-task memo of computed scores; bounded so a Python worker stays small
# (about 40 MB at the limit) whatever the vocabulary.
MEMO_LIMIT = 250_000

SCORE_TYPE = T.StructType([
    T.StructField("select_score", T.DoubleType()),
    T.StructField("confidence", T.DoubleType()),
])


def check_cutoff(cutoff) -> float:
    c = float(cutoff)
    if not (0.0 <= c <= 1.0):  # also rejects NaN
        raise ValueError(f"cutoff must be within [0, 1], got {cutoff!r}")
    return c


def length_bound(tok: Column, qlen: int) -> Column:
    lt = F.length(tok)
    return F.lit(2.0) * F.least(lt, F.lit(qlen)) / (lt + F.lit(qlen))


def char_overlap(tok: Column, q: str) -> Column:
    """Size of the multiset intersection of the characters of ``tok`` and ``q``. The
    characters are an array, so a long query does not lengthen the plan."""
    counts = F.array(*[F.struct(F.lit(c).alias("c"), F.lit(n).alias("k")) for c, n in sorted(Counter(q).items())]) \
        if len(set(q)) > 64 else None
    lt = F.length(tok)
    if counts is not None:
        return F.aggregate(counts, F.lit(0), lambda acc, x: acc + F.least(
            x["k"], lt - F.length(F.replace(tok, x["c"], F.lit("")))))
    terms = [F.least(F.lit(n), lt - F.length(F.replace(tok, F.lit(c), F.lit("")))) for c, n in sorted(Counter(q).items())]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total


def char_bound(tok: Column, q: str) -> Column:
    return F.lit(2.0) * char_overlap(tok, q) / (F.length(tok) + F.lit(len(q)))


def bounds_pass(tok: Column, q: str, cutoff: float) -> Column:
    """Both bounds as one predicate. The lengths that pass the length bound are counted here,
    with its own arithmetic, so a word of another length costs one comparison."""
    n = len(q)
    top = int(n * (2.0 - cutoff) / cutoff) + 2 if cutoff > 0 else None
    if top is None or top > 100_000:
        return (length_bound(tok, n) >= F.lit(cutoff)) & (char_bound(tok, q) >= F.lit(cutoff))
    fits = [t for t in range(1, top + 1) if 2.0 * min(t, n) / (t + n) >= cutoff]  # neighbours: it rises to n, then falls
    if not fits:
        return F.lit(False)
    return F.length(tok).between(fits[0], fits[-1]) & (char_bound(tok, q) >= F.lit(cutoff))


# Fixed value: from this length of the second word on, difflib leaves out frequent characters.
AUTOJUNK_LENGTH = 200
# Cells (pairs x characters x characters) of one sweep.
SWEEP_CELLS = 1 << 21


def _longest(a, b, alo, ahi, blo, bhi):
    """(size, start in a, start in b) of the longest common block of each pair of windows;
    the earliest in a, then in b, of equally long ones. a, b: rows of code points."""
    rows, width = b.shape
    column = np.arange(width)
    inside = (column >= blo[:, None]) & (column < bhi[:, None])
    run = np.zeros((rows, width + 1), np.int32)
    size, at_a, at_b = (np.zeros(rows, np.int64) for _ in range(3))
    for i in range(int(alo.min()), int(ahi.max())):
        same = (b == a[:, i, None]) & inside & ((alo <= i) & (i < ahi))[:, None]
        run[:, 1:] = np.where(same, run[:, :-1] + 1, 0)
        j = run.argmax(1)
        k = run[np.arange(rows), j]
        more = k > size
        size[more], at_a[more], at_b[more] = k[more], i + 1 - k[more], j[more] - k[more]
    return size, at_a, at_b


def _matched(a, b, la, lb):
    """Characters in matching blocks of each pair, block by block on all open windows."""
    total, pair = np.zeros(len(a), np.int64), np.arange(len(a))
    window = np.stack([np.zeros(len(a), np.int64), la, np.zeros(len(a), np.int64), lb])
    while len(pair):
        size, i, j = _longest(a[pair], b[pair], *window)
        np.add.at(total, pair, size)
        alo, ahi, blo, bhi = window
        window = np.concatenate([np.stack([alo, i, blo, j]), np.stack([i + size, ahi, j + size, bhi])], 1)
        keep = np.tile(size > 0, 2) & (window[0] < window[1]) & (window[2] < window[3])
        pair, window = np.tile(pair, 2)[keep], window[:, keep]
    return total


def _points(words, width):
    size = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
    out = np.zeros((len(words), width), np.uint32)
    out[np.arange(width) < size[:, None]] = flat
    return out


def ratios(first: list, second: list):
    """``SequenceMatcher(None, a, b).ratio()`` of each pair, bit by bit."""
    from difflib import SequenceMatcher

    la = np.fromiter(map(len, first), np.int64, len(first))
    lb = np.fromiter(map(len, second), np.int64, len(second))
    out = np.empty(len(first))
    long_ = (lb >= AUTOJUNK_LENGTH) | (la >= AUTOJUNK_LENGTH)
    for k in np.flatnonzero(long_).tolist():
        out[k] = SequenceMatcher(None, first[k], second[k]).ratio()
    order = np.flatnonzero(~long_)
    order = order[np.argsort(la[order] * lb[order], kind="stable")]
    start = 0
    while start < len(order):  # pairs of like size together
        stop, cells = start + 1, 0
        step = max(1, SWEEP_CELLS // max(1, int(la[order[start]] * lb[order[start]])))
        stop = min(len(order), start + step)
        while True:
            part = order[start:stop]
            wa, wb = max(1, int(la[part].max())), max(1, int(lb[part].max()))
            cells = len(part) * wa * wb
            if cells <= 2 * SWEEP_CELLS or len(part) == 1:
                break
            stop = start + max(1, len(part) // 2)
        a, b = [first[k] for k in part.tolist()], [second[k] for k in part.tolist()]
        both = la[part] + lb[part]
        matched = _matched(_points(a, wa), _points(b, wb), la[part], lb[part])
        out[part] = np.where(both > 0, 2.0 * matched / np.maximum(both, 1), 1.0)
        start = stop
    return out


def score_udf(query: str):
    """Pandas UDF: token -> (select_score, confidence).

    ``select_score`` is what chooses the word: ``ratio(a=token, b=lower(query))``.
    ``confidence`` is what is reported: ``ratio(a=query, b=token)`` (raw case,
    swapped arguments), so it may be below the cutoff. Each distinct token of a
    batch is scored once and the results are mapped back by code.
    """
    qlow = query.lower()

    @F.pandas_udf(SCORE_TYPE)
    def score(tokens: pd.Series) -> pd.DataFrame:
        codes, uniques = pd.factorize(tokens, use_na_sentinel=False)
        words = list(uniques)
        sel, conf = ratios(words, [qlow] * len(words)), ratios([query] * len(words), words)
        return pd.DataFrame({"select_score": sel[codes], "confidence": conf[codes]})

    return score


BEST_TYPE = T.StructType([
    T.StructField("matched_token", T.StringType()),
    T.StructField("select_score", T.DoubleType()),
    T.StructField("confidence", T.DoubleType()),
])


def best_word_udf(query: str, cutoff: float):
    """Pandas UDF: array of candidate words of one line -> best (word, select_score, confidence).

    The best word has the largest select_score >= cutoff, ties to the larger word
    (what ``get_close_matches(n=1)`` returns); no such word gives null fields.
    Scores are memoised per task, so a repeated word costs a dict lookup.
    """
    qlow = query.lower()
    sel_memo: dict = {}
    conf_memo: dict = {}

    @F.pandas_udf(BEST_TYPE)
    def best(cands: pd.Series) -> pd.DataFrame:
        # what this batch brings anew is scored at once
        new = list({t for arr in cands for t in arr if t not in sel_memo})
        if len(sel_memo) + len(new) > MEMO_LIMIT:
            sel_memo.clear()
            new = list({t for arr in cands for t in arr})
        sel_memo.update(zip(new, ratios(new, [qlow] * len(new)).tolist()))
        toks, sels = [], []
        for arr in cands:
            bt, bs = None, -1.0
            for t in arr:
                s = sel_memo[t]
                if s >= cutoff and (s > bs or (s == bs and t > bt)):
                    bt, bs = t, s
            if bt is None:
                toks.append(None)
                sels.append(None)
                continue
            toks.append(bt)
            sels.append(bs)
        chosen = list({t for t in toks if t is not None and t not in conf_memo})
        if len(conf_memo) + len(chosen) > MEMO_LIMIT:
            conf_memo.clear()
            chosen = list({t for t in toks if t is not None})
        conf_memo.update(zip(chosen, ratios([query] * len(chosen), chosen).tolist()))
        confs = [None if t is None else conf_memo[t] for t in toks]
        return pd.DataFrame({"matched_token": toks, "select_score": sels, "confidence": confs})

    return best


def pair_score_udf():
    """Pandas UDF over (token, query) pairs, for many queries at once."""
    @F.pandas_udf(SCORE_TYPE)
    def score(tokens: pd.Series, queries: pd.Series) -> pd.DataFrame:
        words, raw = tokens.tolist(), queries.tolist()
        return pd.DataFrame({"select_score": ratios(words, [q.lower() for q in raw]), "confidence": ratios(raw, words)})

    return score


# Signatures of a word, and the pairs of words compared at once.
SIGNATURES = 3
NEAR_CELLS = 1 << 19


def _signatures(words: list, size: int):
    """SIGNATURES x len(words): 64-bit signatures of words of ``size`` characters. A bit stands
    for some numbered characters (the second ``e`` is not the first)."""
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(words), size)
    points = np.sort(points, axis=1).astype(np.uint64)
    place = np.arange(size)
    fresh = np.ones(points.shape, bool)
    fresh[:, 1:] = points[:, 1:] != points[:, :-1]
    number = (place - np.maximum.accumulate(np.where(fresh, place, 0), axis=1)).astype(np.uint64)
    mixed = (points * np.uint64(0x9E3779B97F4A7C15) + number) * np.uint64(0xD1342543DE82EF95)
    return [np.bitwise_or.reduce(np.uint64(1) << ((mixed >> np.uint64(58 - 6 * k)) & np.uint64(63)), axis=1)
            for k in range(SIGNATURES)]


def near_udf(patterns: list, cutoff: float):
    """Pandas UDF: word -> the numbers of the patterns whose ratio may reach the cutoff.

    Words and patterns meet by length. The characters two words share are at most the bits
    their signatures share and the lesser number of characters that have no bit of their own.
    """
    made: dict = {}

    def lengths():
        if not made:
            at: dict = {}
            for i, p in enumerate(patterns):
                at.setdefault(len(p), []).append(i)
            for n, ids in at.items():
                sig = _signatures([patterns[i] for i in ids], n)
                made[n] = np.array(ids, np.int32), sig, [n - np.bitwise_count(x).astype(np.int64) for x in sig]
        return made

    @F.pandas_udf("array<int>")
    def near(tokens: pd.Series) -> pd.Series:
        words = tokens.tolist()
        out = [[] for _ in words]
        size = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(size, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(size[order])) + 1):
            n = int(size[part[0]]) if len(part) else 0
            if not n:
                continue
            sig = _signatures([words[i] for i in part.tolist()], n)
            spare = [n - np.bitwise_count(x).astype(np.int64) for x in sig]
            for m, (ids, other, free) in lengths().items():
                if 2.0 * min(n, m) / (n + m) < cutoff:
                    continue
                need = int(np.ceil(cutoff * (n + m) / 2.0 - 1e-9))
                step = max(1, NEAR_CELLS // len(ids))
                for lo in range(0, len(part), step):
                    cut = slice(lo, lo + step)
                    shared = np.bitwise_count(sig[0][cut, None] & other[0])
                    # at least ``need - spare``: the words' side first, both for what is left
                    t, q = np.nonzero(shared >= np.maximum(need - spare[0][cut], 0).astype(np.uint8)[:, None])
                    t += lo
                    for k in range(SIGNATURES):
                        bits = np.bitwise_count(sig[k][t] & other[k][q])
                        keep = bits + np.minimum(spare[k][t], free[k][q]) >= need
                        t, q = t[keep], q[keep]
                    for i, j in zip(part[t].tolist(), ids[q].tolist()):
                        out[i].append(j)
        return pd.Series(out)

    return near


def register_by_value(module: str = __name__):
    # Ship the module's UDF bodies by value, so executors need only the standard
    # library, numpy, pandas and pyarrow, not this package on their path.
    try:
        import sys

        from pyspark import cloudpickle
        cloudpickle.register_pickle_by_value(sys.modules[module])
    except Exception:  # pragma: no cover - older cloudpickle
        pass


register_by_value()
