"""Toxic passages as maximum-scoring segments of token log-odds.

Words (runs of letters and digits, lower-cased) and their beginnings of 3 to 8 bytes
are counted as tokens in toxic and other training documents. Log-odds with an informative Dirichlet prior (the counts of both
classes together) and their standard errors single out the tokens that tell toxic
from other text. A word scores by its most telling token, the log ratio of that token's shares
in the two classes; words without one score the log ratio of the remaining mass, a small negative
number, so the mean score of other text is negative. A linear scan finds all maximal scoring segments of a
document. For such log ratios the extreme-value law gives E = K n exp(-S) segments of
score S by chance in n tokens; K is fitted on training documents. A logistic curve over
the best segment's -log E, the sum over significant segments, the sum of all segments'
scores and the length gives the score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferret.llm import wordhash as W
from ferret.llm.common import labelled_sample, longs, sigmoid, slices, texts_of

#: Most labelled documents to learn from, and most telling tokens kept (by log-odds' lower bound).
TRAIN_ROWS = 20_000
TOKENS = 100_000
#: Weight of the prior as a share of all tokens; least log-odds, four standard errors below
#: the estimate, of a telling token; E of a significant segment.
PRIOR = 0.01
TELLING = 0.5
SIGNIFICANT = 0.05

#: Beginnings of words that are tokens beside the words, in bytes.
BEGINNINGS = (3, 4, 5, 6, 7, 8)

PASSAGE = "array<struct<start:int,end:int,score:double,evalue:double>>"


@dataclass
class Model:
    token: np.ndarray   # sorted hashes of telling tokens
    score: np.ndarray   # their log ratios
    z: np.ndarray       # their log-odds, four standard errors below the estimate
    rest: float         # score of any other word
    log_k: float        # extreme-value constant
    curve: tuple        # intercept and weights of the logistic curve


def _tokens(column):
    """(first word of each text, [tokens of each word: the word, its beginnings])."""
    data, offs = texts_of(column)
    data = W.LOWER[data]
    start, end, first = W.bounds(data, offs, W.NOT_ALNUM)
    return first, [W.hashes(data, start, end), *W.beginnings(data, start, end, BEGINNINGS)]


def token_counts(sample: DataFrame) -> DataFrame:
    """(h, toxic, other): occurrences of every token in each class; counted per task first."""
    def run(batches):
        for b in slices(batches, 0):
            first, tokens = _tokens(b.column(0))
            y = np.tile(np.repeat(np.asarray(b.column(1)).astype(np.int64), np.diff(first)), len(tokens))
            token, where = np.unique(np.concatenate(tokens), return_inverse=True)
            n = np.bincount(where, minlength=len(token))
            bad = np.bincount(where, weights=y, minlength=len(token)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([longs(token), longs(bad), longs(n - bad)], ["h", "toxic", "other"])

    return (sample.select("text", "y").mapInArrow(run, "h long, toxic long, other long")
            .where("h != 0").groupBy("h").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")))


def _segments(pos: list, before: list, after: list) -> list:
    """All maximal scoring segments (first, last, score) of tokens with positive score at
    ``pos``, whose running sums of scores are ``before`` and ``after`` them."""
    stack: list = []  # (left sum, right sum, first, last)
    for p, left, right in zip(pos, before, after):
        first = p
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][0] >= left:
                j -= 1
            if j < 0 or stack[j][1] >= right:
                break
            left, first = stack[j][0], stack[j][2]
            del stack[j:]
        stack.append((left, right, first, p))
    return [(a, b, r - s) for s, r, a, b in stack]


def passages(b, model: Model, at: int = 1):
    """(tokens per text, segments per text) of a batch."""
    first, tokens = _tokens(b.column(at))
    s = np.full(int(first[-1]), model.rest)
    sure = np.zeros(len(s))
    for h in tokens if len(model.token) else ():
        k = np.minimum(np.searchsorted(model.token, h), len(model.token) - 1)
        better = (model.token[k] == h) & (model.z[k] > sure)
        s[better], sure[better] = model.score[k[better]], model.z[k[better]]
    run = np.concatenate([[0.0], np.cumsum(s)])
    up = np.flatnonzero(s > 0)
    doc = W.owner(first)[up]
    found = [[] for _ in range(b.num_rows)]
    cut = np.flatnonzero(np.diff(doc)) + 1
    for i, j in zip(np.r_[0, cut], np.r_[cut, len(up)]):
        if j > i:
            d = int(doc[i])
            p = up[i:j]
            found[d] = _segments((p - first[d]).tolist(), run[p].tolist(), run[p + 1].tolist())
    return np.diff(first), found


def _features(n, found, log_k: float) -> np.ndarray:
    """(best -log E, summed -log E of significant segments, mass of all, length) of each
    text, in logs."""
    x = np.zeros((len(n), 4))
    for i, segs in enumerate(found):
        if segs:
            s = np.array([s for *_, s in segs])
            e = s - np.log(n[i]) - log_k  # -log E
            x[i, :3] = max(e.max(), 0.0), e[e > -np.log(SIGNIFICANT)].sum(), s.sum()
    x[:, 3] = n
    return np.log1p(x)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple:
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = sigmoid(x @ w)
        g = x.T @ (y - p) - ridge * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), g)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(map(float, w))


def _rest(sample: DataFrame, model: Model) -> float:
    """Log ratio of the shares of words without a telling token in the two classes."""
    def run(batches):
        for b in slices(batches, 0):
            n, _ = passages(b, model, 0)
            first, tokens = _tokens(b.column(0))
            told = np.isin(tokens[0], model.token)
            for h in tokens[1:]:
                told |= np.isin(h, model.token)
            hit = np.bincount(W.owner(first)[told], minlength=len(n))
            yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64()), pa.array(hit, pa.int64()), b.column(1)], ["n", "hit", "y"])

    rows = (sample.select("text", "y").mapInArrow(run, "n long, hit long, y int").groupBy("y")
            .agg(F.sum("n").alias("n"), F.sum("hit").alias("hit")).collect())
    share = {r["y"]: (r["n"] - r["hit"] + 1) / (r["n"] + 2) for r in rows}
    return min(float(np.log(share.get(1, 0.5) / share.get(0, 0.5))), -1e-6)


def fit(docs: DataFrame, labels: DataFrame, unseen, label: str = "toxic", rows: int = TRAIN_ROWS) -> Model:
    """Learn from at most ``rows`` labelled documents (see ``labelled_sample``). Without
    any row of either class every document scores below one half."""
    sample = labelled_sample(docs, labels, label, rows, unseen)
    counts = token_counts(sample)
    counts = counts.select("h", F.col("toxic").cast("double").alias("t"), F.col("other").cast("double").alias("o"))
    total = counts.agg(F.sum("t").alias("t"), F.sum("o").alias("o")).first()
    nt, no = total["t"] or 0.0, total["o"] or 0.0
    empty = Model(np.zeros(0, np.uint64), np.zeros(0), np.zeros(0), -1e-6, 0.0, (-2.0, 0.0, 0.0, 0.0, 0.0))
    if not nt or not no:
        return empty
    a, prior = F.lit(PRIOR) * (F.col("t") + F.col("o")), PRIOR * (nt + no)
    t, o = F.col("t") + a, F.col("o") + a
    delta = F.log(t / (F.lit(nt + prior) - t)) - F.log(o / (F.lit(no + prior) - o))
    z = delta - 4 * F.sqrt(1 / t + 1 / o)
    told = (counts.where(z >= F.lit(TELLING)).select("h", (t / F.lit(nt + prior)).alias("p"), (o / F.lit(no + prior)).alias("q"), z.alias("z"))
            .orderBy(F.desc("z"), "h").limit(TOKENS).toPandas())
    if not len(told):
        return empty
    token = told["h"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(token)
    p, q = told["p"].to_numpy()[order], told["q"].to_numpy()[order]
    model = Model(token[order], np.log(p / q), told["z"].to_numpy()[order], -1.0, 0.0, empty.curve)
    model.rest = _rest(sample, model)

    def run(batches):
        for b in slices(batches, 0):
            n, found = passages(b, model, 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(n, pa.int64()), b.column(1), pa.array([[s for *_, s in f] for f in found], pa.list_(pa.float64()))],
                ["n", "y", "all"])

    seen = sample.select("text", "y").mapInArrow(run, "n long, y int, all array<double>").toPandas()
    # log K from the median of S - log n, which the law puts at log K - log(log 2)
    chance = [max(a) - np.log(n) for a, n, y in zip(seen["all"], seen["n"], seen["y"]) if y == 0 and len(a)]
    if len(chance) >= 30:
        model.log_k = min(max(float(np.median(chance) + np.log(np.log(2))), -3.0), 0.0)
    found = [[(0, 0, s) for s in a] for a in seen["all"]]
    model.curve = _logistic(_features(seen["n"].to_numpy(), found, model.log_k), seen["y"].to_numpy(float))
    return model


def scored(docs: DataFrame, model: Model, keep=None, names=("score", "passages")) -> DataFrame:
    """Every row of ``docs`` with the columns ``names``: score and passages (word positions,
    score and E of each maximal segment). ``keep``: columns to carry (default all); one
    that is named like a new column is left out, so choose other names to keep it. Null or empty texts have no passage and the
    curve's score at zero. Narrow: a row is judged alone."""
    keep = [c for c in docs.columns if c not in names] if keep is None else list(keep)
    if "text" not in keep:
        keep.append("text")
    rows = docs.select(*keep)
    at = keep.index("text")

    def run(batches):
        for b in slices(batches, at):
            n, found = passages(b, model, at)
            x = np.column_stack([np.ones(len(n)), _features(n, found, model.log_k)])
            spans = [[{"start": p, "end": q + 1, "score": s, "evalue": float(n[i] * np.exp(model.log_k - s))}
                      for p, q, s in f] for i, f in enumerate(found)]
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("evalue", pa.float64())]))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(sigmoid(x @ np.array(model.curve))), pa.array(spans, kind)],
                                             [*keep, *names])

    from pyspark.sql import types as T
    schema = T.StructType(list(rows.schema.fields) + T._parse_datatype_string(f"`{names[0]}` double, `{names[1]}` {PASSAGE}").fields)
    return rows.mapInArrow(run, schema)
