"""Spelling variants by dense prefix-suffix tiling.

Two words are one edit apart if their common prefix and common suffix together reach the
longer length minus one. Then, with the longer length m, they share either the first
m // 2 or the last (m + 1) // 2 code points, so every word stands in a tile group for its
beginning and one for its ending, once with m its own length and once with m one more.
Inside a group the words are rows of two padded code-point matrices, one aligned left and
one right, and blocks of them are compared column by column for all pairs at once. A
pair that shares the beginning is left to the group of the beginning. A group over
TILE words is dealt over chunks, and each pair of chunks is a block of its own.

Blocks give, for each word, how many near words they hold and the most frequent one, never
the pairs.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferret.llm.common import bounded, checkpointed, slices, stored

#: Fixed values of the word rule.
RUN = "[A-Za-zÀ-ÿ]"
DROP = 199
LEAST_LENGTH, LEAST_COUNT, TIMES = 6, 5, 5
#: Words of a chunk of a crowded group; code points of a chunk of long words.
TILE, TILE_POINTS = 512, 1 << 21
#: Cells compared at once in a task, words counted in a task before they leave.
CELLS, COUNTED = 1 << 20, 200_000
#: Code points of a text whose words are listed at once; longer texts go word by word.
LISTED = 1 << 20
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _lower(text: str) -> str:
    return text.lower() if text.isascii() else text.encode().translate(_LOWER).decode()


def text_words(doc_id, text: str | None, least: int = LEAST_LENGTH) -> dict:
    """word -> occurrences in one text, of words of ``least`` code points or more: runs of
    letters in lower case (A-Z only), one code point deleted where DROP divides the crc32
    of ``<doc_id>:<run>``."""
    found: dict = {}
    text = _lower(text or "")
    run = re.compile(f"{RUN}{{{least},}}")  # a maximal run, since it takes all it can
    for w in run.findall(text) if len(text) <= LISTED else (m.group() for m in run.finditer(text)):
        found[w] = found.get(w, 0) + 1
    out, begin = {}, zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for w, n in found.items():
        h = zlib.crc32(w.encode(), begin)
        if h % DROP == 0:
            k = h % len(w)
            w = w[:k] + w[k + 1:]
            if len(w) < least:
                continue
        out[w] = out.get(w, 0) + n
    return out


def counted(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of all texts; summed in each task before the shuffle."""
    def run(batches):
        total: dict = {}

        def out():
            return pa.RecordBatch.from_pydict({"word": pa.array(list(total), pa.string()), "n": pa.array(list(total.values()), pa.int64())})

        for b in slices(batches, 1):
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for w, n in text_words(i, t, least_length).items():
                    total[w] = total.get(w, 0) + n
            if len(total) > COUNTED:
                yield out()
                total = {}
        yield out()

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count))


def _matrix(words: list, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lengths, code points aligned left, aligned right) of words of m or m - 1 code points,
    a row for each column of the alignment; 0 pads."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
    start = np.cumsum(size) - size
    col = np.arange(m)[:, None]
    left = np.where(col < size, flat[np.minimum(start + col, len(flat) - 1)], 0)
    shift = col - (m - size)
    right = np.where(shift >= 0, flat[start + np.maximum(shift, 0)], 0)
    return size, left, right


def _common(rows: np.ndarray) -> np.ndarray:
    """rows: columns x G x s code points. Common leading columns of all pairs: G x s x s."""
    g, s = rows.shape[1:]
    alive, total = np.ones((g, s, s), bool), np.zeros((g, s, s), np.int32)
    for c in rows:
        alive &= c[:, :, None] == c[:, None, :]
        if not alive.any():
            break
        total += alive
    return total


def _near_rows():
    """Arrow function over rows (m, side, g, i, j, own, n, word) sorted by the first five:
    for each word its near words in the block: how many, and the one of largest n."""
    def blocks(key, own, n, words):
        cut = np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1
        start, stop = np.r_[0, cut], np.r_[cut, len(words)]
        size = stop - start
        rank = np.empty(len(words), np.int64)
        rank[sorted(range(len(words)), key=lambda k: (-n[k], words[k]))] = np.arange(len(words))
        by_rank = np.argsort(rank)
        for m in np.unique(key[start[size > 1], 0]).tolist():
            of_m = (key[start, 0] == m) & (size > 1)
            pad = 1 << np.ceil(np.log2(size)).astype(int)  # groups are padded to the next power of two
            for s in np.unique(pad[of_m]).tolist():
                first, count = start[of_m & (pad == s)], size[of_m & (pad == s)]
                step = max(1, CELLS // (s * s))
                for k in range(0, len(first), step):
                    f, c = first[k:k + step], count[k:k + step]
                    there = np.arange(s) < c[:, None]
                    at = np.where(there, f[:, None] + np.arange(s), f[:, None])
                    used, back = np.unique(at, return_inverse=True)
                    length, left, right = _matrix([words[u] for u in used.tolist()], m)
                    back = back.reshape(at.shape)
                    prefix = _common(left[:, back])
                    suffix = _common(right[::-1][:, back])
                    long_ = length[back] == m
                    near = (prefix + suffix >= m - 1) & (long_[:, :, None] | long_[:, None]) & there[:, :, None] & there[:, None]
                    near &= ~np.eye(s, dtype=bool)
                    side = key[f, 1].astype(bool)[:, None, None]
                    near &= np.where(side, (prefix < m // 2) & (suffix >= (m + 1) // 2), prefix >= m // 2)
                    o = own[at]
                    near &= (key[f, 3] == key[f, 4])[:, None, None] | (o[:, :, None] != o[:, None])
                    hits = near.sum(2)
                    best = np.where(near, rank[at][:, None], len(words)).min(2)
                    yield at[hits > 0], hits[hits > 0], by_rank[best[hits > 0]]

    def out(key, own, n, words):
        for at, hits, best in blocks(key, own, n, words):
            if len(at):
                yield pa.RecordBatch.from_pydict({
                    "word": [words[k] for k in at.tolist()], "near": pa.array(hits.astype(np.int64)),
                    "form_n": pa.array(n[best]), "form": [words[k] for k in best.tolist()]})

    def run(batches):
        key, own, n, words = np.zeros((0, 5), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), []
        for b in batches:
            if not b.num_rows:
                continue
            col = [np.asarray(b.column(i)).astype(np.int64) for i in range(7)]
            key, own, n = np.concatenate([key, np.stack(col[:5], 1)]), np.r_[own, col[5]], np.r_[n, col[6]]
            words += b.column(7).to_pylist()
            last = np.flatnonzero((key[1:] != key[:-1]).any(1))
            if len(last):  # the last block may go on in the next batch
                cut = int(last[-1]) + 1
                yield from out(key[:cut], own[:cut], n[:cut], words[:cut])
                key, own, n, words = key[cut:], own[cut:], n[cut:], words[cut:]
        if words:
            yield from out(key, own, n, words)

    return run


def near_words(words: DataFrame, tile: int = TILE) -> DataFrame:
    """(word, near, form_n, form) for the words of ``words`` (distinct word, n) that have near
    words: how many, and the most frequent one (ties: the smallest). Words of two code
    points or more."""
    size = F.length("word")
    tiles = []
    for more in (0, 1):
        m = size + more
        for side, part in ((0, F.left(F.col("word"), F.floor(m / 2).cast("int"))), (1, F.right(F.col("word"), F.floor((m + 1) / 2).cast("int")))):
            tiles.append(F.struct(m.alias("m"), F.lit(side).alias("side"), F.xxhash64(part).alias("g")))
    rows = words.select("word", "n", F.explode(F.array(*tiles)).alias("t")).select("word", "n", "t.*")
    chunk = F.greatest(F.lit(2), F.least(F.lit(tile), F.floor(F.lit(TILE_POINTS) / F.col("m"))))
    shared = stored(rows.groupBy("m", "side", "g").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
                    .select("m", "side", "g", F.ceil(F.col("c") / chunk).cast("int").alias("k")))
    met = rows.join(bounded(shared, 40), ["m", "side", "g"]).withColumn("own", F.pmod(F.xxhash64("word"), "k").cast("int"))
    blocks = (met.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
              .select("m", "side", "g", F.least("own", "o").alias("i"), F.greatest("own", "o").alias("j"), "own", "n", "word"))
    found = (blocks.repartition("m", "side", "g", "i", "j").sortWithinPartitions("m", "side", "g", "i", "j")
             .mapInArrow(_near_rows(), "word string, near long, form_n long, form string"))
    return (found.groupBy("word").agg(F.sum("near").alias("near"), F.min(F.struct((-F.col("form_n")).alias("a"), "form")).alias("f"))
            .select("word", "near", (-F.col("f.a")).alias("form_n"), "f.form"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for ``forms`` (word, form): the last word that forms lead to. Forms must
    not run in a circle. Each round doubles the steps taken."""
    now = checkpointed(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        new = checkpointed(now.join(bounded(ahead, 64), "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        now = new.select("word", "root")
        if new.where("moved").isEmpty():
            return now


def variants(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, times: int = TIMES,
             tile: int = TILE) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of all texts of ``docs`` (doc_id, text).

    A word's form is its near word of largest n (ties: smallest in code-point order) if that
    is ``times`` its own n or more; root follows forms to the last and is the word itself
    where it has none. Null or empty texts have no words; a null doc_id counts as an empty
    one; rows that repeat a doc_id count each. An empty table gives an empty result. Other
    columns are not read. least_length must be 2 or more, times over 1.
    """
    words = stored(counted(docs, least_length, least_count))
    near = near_words(words, tile)
    is_form = F.col("form_n") >= times * F.col("n")
    named = stored(words.join(near, "word", "left").select(
        "word", F.when(is_form, F.col("form")).alias("form"), "n", F.coalesce("near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("form_n")).alias("form_n")))
    last = roots(named.where("form is not null"))
    return (named.join(last, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
