"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Words are runs of letters and digits, lower-cased. The n-grams of the test items are
the seeds; one pass over all texts counts them. A second pass takes the seeds' hits in
each text; hits of one item that lie close together give a passage, which is aligned
with the item by Smith-Waterman over words, so edited, shortened and paraphrased copies
score by what they share. No seed is dropped for being frequent: a text's passages of an
item are aligned rarest seeds first, and a passage is passed over only if the words it
shares with the item cannot reach the least score, or the score already found.

Both passes are narrow: the items travel to the tasks in blocks of at most about
``BLOCK_WORDS`` words (one pass per block), and no text is shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferret.llm import wordhash as W
from ferret.llm.common import longs, slices, texts_of

SEED = 3
BLOCK_WORDS = 2_000_000
#: Pairs of a hit and an item's place looked at together in a task.
ENTRIES = 1 << 20
#: Alignment scores of a word: equal, different, left out.
EQUAL, OTHER, GAP = 1, -1, -1
#: A passage is a leak if its score reaches this share of the item's words, or LONG, and LEAST words.
SHARE, LONG, LEAST = 0.4, 30, 6

_ROW = "doc_id long, item_id long, score long, share double, start int, end int"


def item_words(texts: list) -> list:
    """Word hashes of each item."""
    data, offs = texts_of(pa.array(texts, pa.string()))
    h, first = W.words(data, offs, W.NOT_ALNUM, lower=True)
    return [h[a:b] for a, b in zip(first[:-1], first[1:])]


def align(item: np.ndarray, part: np.ndarray) -> tuple[int, int, int]:
    """(score, start, end) of the best local alignment of ``item`` within ``part``."""
    m = len(part)
    ramp = np.arange(m + 1)
    row, start = np.zeros(m + 1, np.int64), ramp.copy()
    best = (0, 0, 0)
    for w in item:
        step = np.where(part == w, EQUAL, OTHER)
        diag, up = row[:-1] + step, row[1:] + GAP
        new = np.zeros(m + 1, np.int64)
        new[1:] = np.maximum(np.maximum(diag, up), 0)
        origin = ramp.copy()
        origin[1:] = np.where(new[1:] == 0, ramp[1:], np.where(new[1:] == diag, start[:-1], start[1:]))
        # a run of words left out: the best cell to the left, less its distance
        lead = new - GAP * ramp
        top = np.maximum.accumulate(lead)
        at = np.maximum.accumulate(np.where(lead == top, ramp, 0))
        value = top + GAP * ramp
        start = np.where(value > new, origin[at], origin)
        row = np.maximum(value, new)
        j = int(row.argmax())
        if row[j] > best[0]:
            best = (int(row[j]), int(start[j]), j)
    return best


class Seeds:
    """Sorted seed hashes and, for each, the items and places that hold it."""

    def __init__(self, items: list):
        g = [W.windows(h, SEED) for h in items]
        size = [len(x) for x in g]
        every = np.concatenate(g) if g else np.zeros(0, np.uint64)
        order = np.argsort(every, kind="stable")
        self.item = np.repeat(np.arange(len(items)), size)[order]
        self.place = np.concatenate([np.arange(n) for n in size])[order] if g else np.zeros(0, np.int64)
        self.hash, at = np.unique(every[order], return_index=True)
        self.at = np.r_[at, len(every)]
        self.items = len(items)
        self.key = np.repeat(np.arange(len(self.hash)), np.diff(self.at)) * self.items + self.item  # rising

    def weights(self, count: np.ndarray) -> np.ndarray:
        """Rarity of each (seed, item) entry; ``count``: the corpus' hits of each hash."""
        return np.repeat(1 / np.maximum(count, 1), np.diff(self.at))

    def hits(self, g: np.ndarray):
        """(position, seed number) of the hashes that are seeds."""
        if not len(self.hash):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        k = np.minimum(np.searchsorted(self.hash, g), len(self.hash) - 1)
        at = np.flatnonzero(self.hash[k] == g)
        return at, k[at]


def _grams(column):
    data, offs = texts_of(column)
    h, first = W.words(data, offs, W.NOT_ALNUM, lower=True)
    g, ok = W.windows(h, SEED), W.full(first, SEED)
    return h, first, np.where(ok, g, np.uint64(0))


def seed_counts(docs: DataFrame, seeds) -> DataFrame:
    """(k, n): hits of seed number k over all texts, summed per task first."""
    def run(batches):
        s = seeds.value
        total = np.zeros(len(s.hash), np.int64)
        for b in slices(batches, 0):
            total += np.bincount(s.hits(_grams(b.column(0))[2])[1], minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([longs(at), longs(total[at])], ["k", "n"])

    return docs.select("text").mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n"))


def _passages(h, first, g, seeds: Seeds, weight: np.ndarray, sizes: np.ndarray):
    """(doc, item, from, to): word ranges of texts around close hits of an item, those
    of the rarest seeds first. Items are taken in ranges that bring at most about ENTRIES
    pairs of a hit and an item's place at once, so common phrases don't need more memory."""
    at, k = seeds.hits(g)
    if not len(at):
        return
    held, back, n = np.unique(k, return_inverse=True, return_counts=True)
    size = seeds.at[held + 1] - seeds.at[held]
    entry = np.repeat(seeds.at[held], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    brought = np.cumsum(np.bincount(seeds.item[entry], np.repeat(n, size), minlength=seeds.items))
    cuts = np.unique(np.searchsorted(brought, np.arange(ENTRIES, brought[-1], ENTRIES), "left") + 1)
    for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), seeds.items]):
        begin = np.searchsorted(seeds.key, held * seeds.items + low)
        end = np.searchsorted(seeds.key, held * seeds.items + high)
        yield from _ranges(at, begin[back], (end - begin)[back], first, seeds, weight, sizes)


def _ranges(at, begin, n, first, seeds: Seeds, weight: np.ndarray, sizes: np.ndarray):
    entry = np.repeat(begin, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    if not len(entry):
        return
    at = np.repeat(at, n)
    item, place, doc = seeds.item[entry], seeds.place[entry], W.owner(first)[at]
    order = np.lexsort((at, item, doc))
    at, item, place, doc, entry = at[order], item[order], place[order], doc[order], entry[order]
    head = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (at[1:] - at[:-1] > sizes[item[1:]])])
    tail = np.r_[head[1:], len(at)] - 1
    doc, item = doc[head], item[head]
    size, slack = sizes[item], sizes[item] // 2 + 2
    lo = np.maximum(first[doc], np.minimum.reduceat(at - place, head) - slack)
    hi = np.minimum(first[doc + 1], np.maximum.reduceat(at - place, head) + size + slack)
    lo, hi = np.maximum(lo, at[head] - size - slack), np.minimum(hi, at[tail] + size + slack)
    for i in np.argsort(-np.add.reduceat(weight[entry], head), kind="stable"):
        yield int(doc[i]), int(item[i]), int(lo[i]), int(hi[i])


def _block_leaks(docs: DataFrame, rows: list) -> DataFrame:
    sc = docs.sparkSession.sparkContext
    words = item_words([r["text"] for r in rows])
    ids = np.array([r["item_id"] for r in rows], np.int64)
    table = Seeds(words)
    seeds = sc.broadcast(table)
    count = np.zeros(len(table.hash), np.int64)
    for r in seed_counts(docs, seeds).toLocalIterator():
        count[r["k"]] = r["n"]
    held = sc.broadcast((words, ids, table.weights(count)))

    def run(batches):
        s = seeds.value
        words, ids, weight = held.value
        sizes = np.array([len(w) for w in words], np.int64)
        for b in slices(batches, 1):
            h, first, g = _grams(b.column(1))
            best: dict = {}
            for d, t, lo, hi in _passages(h, first, g, s, weight, sizes):
                # no alignment scores more than the item's words that the passage holds
                most = int(np.isin(words[t], h[lo:hi]).sum())
                if most < max(min(LEAST, sizes[t]), min(SHARE * sizes[t], LONG)) or most < best.get((d, t), (0,))[0]:
                    continue
                score, start, end = align(words[t], h[lo:hi])
                if score >= min(LEAST, sizes[t]) and (score >= SHARE * sizes[t] or score >= LONG):
                    row = (score, score / sizes[t], int(lo + start - first[d]), int(lo + end - first[d]))
                    best[d, t] = max(best.get((d, t), row), row)
            doc = b.column(0).to_pylist()
            cols = list(zip(*((doc[d], int(ids[t]), *row) for (d, t), row in best.items()))) or [()] * 6
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             ["doc_id", "item_id", "score", "share", "start", "end"])

    return docs.mapInArrow(run, _ROW)


def leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, score, share, start, end): each text's best passage (a range of
    words) for every item of ``items`` (item_id, text) that it holds, word by word or edited.

    Null or empty texts and items match nothing, nor do items of fewer than ``SEED``
    words. Items with null id are left out; a repeated item_id may give several rows.
    Rows of ``docs`` are judged one by one, also with null or repeated doc_ids. Empty
    tables give an empty result. Other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = (items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
             .where("item_id is not null and text is not null"))
    size = items.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    blocks = -(-size // (4 * BLOCK_WORDS)) or 1
    out = None
    for i in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == i)
        found = _block_leaks(docs, part.orderBy("item_id", "text").collect())
        out = found if out is None else out.unionByName(found)
    return out
