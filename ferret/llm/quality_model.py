"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics of a text are computed over its bytes and word hashes in vectorised
passes. Trees are fitted on a bounded sample of labelled documents (``TRAIN_ROWS``):
features are cut into at most ``BINS`` bins and every split is chosen from histograms
of gradients. All trees have the same depth and lie in three arrays (feature,
threshold, leaf value), so a batch walks down all trees with numpy indexing alone.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferret.llm import wordhash as W
from ferret.llm.common import labelled_sample, sigmoid, slices, texts_of

TRAIN_ROWS = 20_000
BINS, DEPTH, TREES, RATE, RIDGE, LEAST = 64, 4, 80, 0.15, 1.0, 5

NAMES = ("log_words", "mean_word", "digits", "upper", "symbols", "pipes", "marks", "stops", "commas", "breaks",
         "other", "distinct", "top", "again3", "lines", "same_lines", "line_words", "long_words", "short_words", "upper_words")


def _mask(chars: str) -> np.ndarray:
    m = np.zeros(256, bool)
    m[list(chars.encode())] = True
    return m


_UPPER = _mask("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_CLASSES = (_mask("0123456789"), _UPPER, _mask("#*$%&<>@^~_=+\\/"), _mask("|"), _mask("!?"), _mask("."), _mask(",;:"),
            _mask("\n"), ~_mask("".join(map(chr, range(128)))))
_BREAK = _mask("\n")


def _per_text(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    run = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return run[offs[1:]] - run[offs[:-1]]


def _distinct(h: np.ndarray, doc: np.ndarray, n: int):
    """(different values, occurrences of the most frequent one) per text."""
    key = np.sort((doc.astype(np.uint64) << np.uint64(40)) | (h >> np.uint64(24)))
    if not len(key):
        return np.zeros(n), np.zeros(n)
    at = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    of = (key[at] >> np.uint64(40)).astype(np.int64)
    top = np.zeros(n)
    np.maximum.at(top, of, np.diff(np.r_[at, len(key)]))
    return np.bincount(of, minlength=n).astype(float), top


def statistics(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """One row of ``NAMES`` for each text; an empty text has zeros."""
    n = len(offs) - 1
    size = np.maximum(np.diff(offs), 1)
    start, end, first = W.bounds(data, offs, W.BLANKS)
    h = W.hashes(data, start, end)
    doc, long = W.owner(first), end - start
    words = np.diff(first)
    some = np.maximum(words, 1)
    by = [_per_text(m[data], offs) / size for m in _CLASSES]
    kinds, top = _distinct(h, doc, n)
    g, ok = W.windows(h, 3), W.full(first, 3)
    spans = np.maximum(words - 2, 0)
    kinds3, _ = _distinct(g[ok], doc[:len(g)][ok], n)
    ls, le, lf = W.bounds(data, offs, _BREAK)
    line_doc, lines = W.owner(lf), np.diff(lf)
    line_kinds, _ = _distinct(W.hashes(data, ls, le), line_doc, n)
    count = lambda mask: np.bincount(doc[mask], minlength=n) / some
    upper = _UPPER[data[start]] & _UPPER[data[np.maximum(end - 1, start)]] if len(start) else np.zeros(0, bool)
    return np.column_stack([
        np.log1p(words), np.bincount(doc, weights=long, minlength=n) / some, *by, kinds / some, top / some,
        1 - kinds3 / np.maximum(spans, 1) * (spans > 0) - (spans == 0), np.log1p(lines),
        1 - line_kinds / np.maximum(lines, 1) - (lines == 0), words / np.maximum(lines, 1),
        count(long > 12), count(long <= 3), count(upper)])


@dataclass
class Trees:
    feature: np.ndarray    # trees x inner nodes, level by level
    threshold: np.ndarray
    leaf: np.ndarray       # trees x leaves
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Sum of leaf values of each row of ``x``."""
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))[:, None]
        trees = np.arange(len(self.feature))[None, :]
        for i in range(0, len(x), 4096):
            part = x[i:i + 4096]
            node = np.zeros((len(part), len(self.feature)), np.int64)
            for _ in range(DEPTH):
                f, t = self.feature[trees, node], self.threshold[trees, node]
                node = 2 * node + 1 + (part[rows[:len(part)], f] > t)
            out[i:i + 4096] += self.leaf[trees, node - (2 ** DEPTH - 1)].sum(1)
        return out


def grow(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boosted trees for labels ``y`` (0 or 1), second-order, with ridge ``RIDGE``."""
    n, m = x.shape
    share = (y.sum() + 1) / (n + 2)
    base = float(np.log(share / (1 - share)))
    if not n:
        return Trees(np.zeros((0, 2 ** DEPTH - 1), np.int64), np.zeros((0, 2 ** DEPTH - 1)), np.zeros((0, 2 ** DEPTH)), base)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(m)]
    bins = np.stack([np.searchsorted(edges[j], x[:, j], "left") for j in range(m)], 1)
    inner, leaves = 2 ** DEPTH - 1, 2 ** DEPTH
    feature, threshold, leaf = np.zeros((TREES, inner), np.int64), np.full((TREES, inner), np.inf), np.zeros((TREES, leaves))
    margin = np.full(n, base)
    for t in range(TREES):
        p = sigmoid(margin)
        grad, hess = y - p, np.maximum(p * (1 - p), 1e-9)
        node = np.zeros(n, np.int64)
        for level in range(DEPTH):
            width, low = 2 ** level, 2 ** level - 1
            best = np.zeros(width)
            for j in range(m):
                key = (node - low) * BINS + bins[:, j]
                gs, hs, cs = (np.cumsum(np.bincount(key, w, width * BINS).reshape(width, BINS), 1) for w in (grad, hess, None))
                gr, hr, cr = gs[:, -1:] - gs, hs[:, -1:] - hs, cs[:, -1:] - cs
                gain = gs ** 2 / (hs + RIDGE) + gr ** 2 / (hr + RIDGE) - gs[:, -1:] ** 2 / (hs[:, -1:] + RIDGE)
                gain[(cs < LEAST) | (cr < LEAST)] = 0
                at = gain.argmax(1)
                for k in np.flatnonzero(gain.max(1) > best + 1e-9):
                    best[k] = gain[k, at[k]]
                    feature[t, low + k], threshold[t, low + k] = j, edges[j][at[k]]
            f, th = feature[t, node], threshold[t, node]
            node = 2 * node + 1 + (x[np.arange(n), f] > th)
        g, h = np.bincount(node - inner, grad, leaves), np.bincount(node - inner, hess, leaves)
        leaf[t] = RATE * g / (h + RIDGE)
        margin += leaf[t][node - inner]
    return Trees(feature, threshold, leaf, base)


def fit(docs: DataFrame, labels: DataFrame, unseen, label: str = "quality", rows: int = TRAIN_ROWS) -> Trees:
    """Trees from at most ``rows`` labelled documents (``labelled_sample``); their
    statistics, not their texts, come to the driver."""
    def run(batches):
        for b in slices(batches, 1):
            x = statistics(*texts_of(b.column(1)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "y", "x"])

    sample = labelled_sample(docs, labels, label, rows, unseen)
    got = sample.select("doc_id", "text", "y").mapInArrow(run, "doc_id long, y int, x array<double>").toPandas()
    got = got.sort_values("doc_id", kind="stable")
    x = np.stack(got["x"].to_list()) if len(got) else np.zeros((0, len(NAMES)))
    return grow(x, got["y"].to_numpy(float))


def scored(docs: DataFrame, trees: Trees) -> DataFrame:
    """(doc_id, score) of every row; null or empty texts score by their (zero) statistics;
    null doc_ids and repeated rows are scored like others. Without training rows every
    score is one half. Narrow; other columns are not read."""
    def run(batches):
        for b in slices(batches, 1):
            margin = trees.margin(statistics(*texts_of(b.column(1))))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sigmoid(margin))], ["doc_id", "score"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, score double"))
