"""Class-based bigram language model with Brown classes from exchange clustering.

All words of the training texts are counted and each has a class of its own choice.
The classes start from a small table: the ``HEADS`` most frequent words and ``ENDINGS``
groups of the others by their last three bytes are exchanged on the driver. From there
every counted word moves by exchange in Spark rounds: the classes beside each word are
counted over all training texts, dealt by word, and the word goes to the class that
raises the likelihood of the class bigrams most, if by more than a class is worth (``LEAVE``).
A word that was not seen has the class of its ending's words of one occurrence. A text's probability is the product of
class transitions and of word emissions, with additive smoothing.

Counts and classes of the ``KNOWN`` most frequent words travel to the tasks (a fixed
bound); those of all others come by a join on the word's hash.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferret.llm import wordhash as W
from ferret.llm.common import longs, slices, stored, texts_of

HEADS, ENDINGS, CLASSES, KNOWN = 1024, 256, 64, 1 << 18
ROUNDS = 8
#: Rounds of the known words, a part of them at a time as words that move at once do not see each
#: other; they end earlier when no part moves with a higher likelihood.
WORD_ROUNDS, PARTS = 2, 2
#: A word leaves its class for a gain (in nats) above what naming one of the classes costs: less is chance.
LEAVE = float(np.log(CLASSES))
#: A word of more occurrences is taken out of the table exactly, one of fewer only from its own class.
DENSE = 64
#: Pseudo-counts of a class transition and of an emission.
SMOOTH, EMIT = 0.1, 0.5
#: Different words that a task gathers before it merges them.
MERGE = 2_000_000


def tokens(column: pa.Array):
    """(hash, first, ending) of the words of texts, A-Z lower-cased; ending: the groups of some of them."""
    data, offs = texts_of(column)
    data = data | ((data - np.uint8(65) < 26).view(np.uint8) << 5)
    start, end, first = W.bounds(data, offs)

    def ending(at):
        size = np.minimum(end[at] - start[at], 3)
        last = data[np.maximum(end[at][:, None] - np.array([3, 2, 1]), 0)].ravel()
        stop = np.arange(3, len(last) + 1, 3)
        return (W.hashes(last, stop - size, stop) % np.uint64(ENDINGS)).astype(np.int64)

    return W.hashes(data, start, end), first, ending


def word_counts(texts: DataFrame) -> DataFrame:
    """(h, ending, n): every word of ``texts`` (text) and its occurrences, summed per task first."""
    def distinct(h):
        """(hash, place of one occurrence, number of the hash for each word)."""
        coded = longs(h).dictionary_encode()
        number, one = coded.indices.to_numpy(), coded.dictionary.to_numpy().view(np.uint64)
        at = np.empty(len(one), np.int64)
        at[number] = np.arange(len(h))
        return one, at, number

    def merged(parts):
        h, e, n = (np.concatenate(x) for x in zip(*parts))
        one, at, number = distinct(h)
        return one, e[at], np.bincount(number, weights=n, minlength=len(one)).astype(np.int64)

    def run(batches):
        have, size = [], 0
        for b in slices(batches, 0):
            h, _, ending = tokens(b.column(0))
            one, at, number = distinct(h)
            have.append((one, ending(at).astype(np.int16), np.bincount(number, minlength=len(one))))
            size += len(one)
            if size > MERGE:
                have = [merged(have)]
                size = len(have[0][0])
                if size > MERGE // 2:
                    yield row(have[0])
                    have, size = [], 0
        if have:
            yield row(merged(have))

    def row(x):
        return pa.RecordBatch.from_arrays([longs(x[0]), pa.array(x[1]), longs(x[2])], ["h", "ending", "n"])

    return (texts.select("text").mapInArrow(run, "h long, ending short, n long")
            .groupBy("h").agg(F.max("ending").alias("ending"), F.sum("n").alias("n")))


_END, _START = HEADS + ENDINGS, HEADS + ENDINGS + 1
_SIZE = HEADS + ENDINGS + 2
_M = CLASSES + 2  # classes of words, then those of the end and of the start
#: What stands beside a word: class before, class after (from _M), the word itself (_SELF),
#: and from _RARE the classes before and after that are of words outside the known.
_SELF, _RARE, _CELLS = 2 * _M, 2 * _M + 1, 512


#: Bits of a hash that name its bin among the known words: few of them share one.
_BIN = 18


def _places(key: np.ndarray):
    """A function that gives where each of some hashes stands in the sorted ``key``, len(key) where it does not."""
    shift, none = np.uint64(64 - _BIN), len(key)
    first = np.concatenate([[0], np.cumsum(np.bincount((key >> shift).astype(np.int64), minlength=1 << _BIN))]).astype(np.int32)
    key = np.append(key, np.uint64(0))

    def places(h):
        bin = (h >> shift).astype(np.int64)
        at, stop = first[bin], first[bin + 1]
        left = np.flatnonzero((key[at] != h) | (at == stop))
        while len(left):
            last = at[left] + 1 >= stop[left]
            at[left[last]] = none
            left = left[~last]
            at[left] += 1
            left = left[key[at[left]] != h[left]]
        return at

    return places


def coded(texts: DataFrame, known) -> DataFrame:
    """(codes, rest): the words of ``texts`` in order, some texts a row, as int32: the rank of
    a known word, -1 for the end of a text, -2 - ending for the others, whose hashes are ``rest``."""
    def run(batches):
        key, rank = known.value
        places, rank = _places(key), np.append(rank, np.int32(0))
        for b in slices(batches, 0):
            h, first, ending = tokens(b.column(0))
            k = places(h)
            rare = np.flatnonzero(k == len(key))
            code = rank[k]
            code[rare] = -2 - ending(rare)
            out = np.full(len(h) + b.num_rows, -1, np.int32)
            out[np.arange(len(h)) + W.owner(first)] = code
            yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary()), pa.array([h[rare].tobytes()], pa.binary())],
                                             ["codes", "rest"])

    return texts.select("text").mapInArrow(run, "codes binary, rest binary")


def _read(batches):
    """(codes, rest) of each row of a coded table."""
    for b in batches:
        for c, r in zip(b.column(0), b.column(1)):
            yield np.frombuffer(c.as_buffer(), np.int32), np.frombuffer(r.as_buffer(), np.uint64)


def _table(seqs: DataFrame, of_code, size: int, pairs=None) -> np.ndarray:
    """Bigram counts (before, at) of the coded texts, ``of_code`` (broadcast) giving each code's
    row; the last two rows are the end and the start. ``pairs``: count those only where it holds."""
    def run(batches):
        lut, total = of_code.value, np.zeros(size * size, np.int64)
        for codes, _ in _read(batches):
            at = lut[codes].astype(np.int64)
            before = np.concatenate([[size - 1], np.where(codes[:-1] == -1, size - 1, at[:-1])]) if len(at) else at
            if pairs is not None:
                ok = pairs(codes)
                before, at = before[ok], at[ok]
            total += np.bincount(before * size + at, minlength=size * size)
        k = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int32)), longs(total[k])], ["k", "n"])

    def packed(batches):  # few bytes a count for the driver
        for b in batches:
            k, n = b.column(0).to_numpy(), b.column(1).to_numpy()
            order = np.argsort(k)
            yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(x.tobytes(), 1)], pa.binary()) for x in
                                              (np.diff(k[order], prepend=np.int32(0)), n[order])], ["k", "n"])

    sums = seqs.mapInArrow(run, "k int, n long").groupBy("k").agg(F.sum("n").alias("n"))
    out = np.zeros(size * size)
    for r in sums.mapInArrow(packed, "k binary, n binary").collect():
        out[np.cumsum(np.frombuffer(zlib.decompress(r["k"]), np.int32))] = np.frombuffer(zlib.decompress(r["n"]), np.int64)
    return out.reshape(size, size)


def _all_known(codes: np.ndarray) -> np.ndarray:
    """Where neither a word nor the one before it is outside the known."""
    rare = codes < -1
    return ~(rare | np.concatenate([[False], rare[:-1]]))


_BESIDE = "w long, own short, cells array<long>"
#: Bits of a count beside its cell of a known word (18 bits of the word, 9 of the cell).
_COUNT = 36


def _beside(w, own, start, cells):
    at = np.flatnonzero(start)
    return pa.RecordBatch.from_arrays(
        [longs(w[at]), pa.array(own[at].astype(np.int16)),
         pa.ListArray.from_arrays(pa.array(np.r_[at, len(w)].astype(np.int32)), longs(cells))], ["w", "own", "cells"])


def beside(seqs: DataFrame, of_code, part: int | None) -> DataFrame:
    """(w, own, cells): for a part of the known words (w: rank) or all others (None; w: hash) their
    class and what stands beside them, as count * _CELLS + cell, summed per task or row first; w comes in several rows."""
    known = part is not None

    def run(batches):
        lut = of_code.value
        have, size = [], 0

        def merged():
            """The cells so far, each once: cell and count sorted as one number."""
            both = np.sort(np.concatenate(have))
            key = both >> _COUNT
            at = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            return key[at], np.add.reduceat(both & ((1 << _COUNT) - 1), at)

        def rows(key, n):
            w = key // _CELLS
            return _beside(w, lut[w], np.r_[True, w[1:] != w[:-1]][:len(w)], n * _CELLS + key % _CELLS)

        for codes, rest in _read(batches):
            at = lut[codes].astype(np.int64)
            rare = codes < -1
            if known:
                i, word = np.flatnonzero((codes >= 0) & (codes % PARTS == part)), codes.astype(np.int64)
            else:
                i, word = np.flatnonzero(rare), np.full(len(codes), -1)
                names, word[i] = np.unique(rest, return_inverse=True)
            first = (i == 0) | (codes[i - 1] == -1)
            same = ~first & (word[i - 1] == word[i])
            # a known word's neighbours count alike; another's say which of them are known
            left = np.where(first, _M - 1, at[i - 1]) + _RARE * (~first & rare[i - 1] & (not known))
            right = _M + at[i + 1] + _RARE * (rare[i + 1] & (not known))
            left = np.where(same, _SELF, left)
            on = word[i + 1] != word[i]
            key, n = np.unique(np.concatenate([word[i] * _CELLS + left, word[i[on]] * _CELLS + right[on]]), return_counts=True)
            if not known:
                w = key // _CELLS
                if len(w):
                    own = np.zeros(len(names), np.int64)
                    own[word[i]] = at[i]
                    yield _beside(names[w], own[w], np.r_[True, w[1:] != w[:-1]], n * _CELLS + key % _CELLS)
                continue
            have.append(key << _COUNT | n)
            size += len(key)
            if size > MERGE:
                key, n = merged()
                have, size = [key << _COUNT | n], len(key)
                if size > MERGE // 2:
                    yield rows(key, n)
                    have, size = [], 0
        if size:
            yield rows(*merged())

    return seqs.mapInArrow(run, _BESIDE)


def _g(x):
    return x * np.log(np.maximum(x, 1))


def exchange(counts: np.ndarray, classes: int = CLASSES, rounds: int = ROUNDS) -> np.ndarray:
    """Class of each unit. The end and the start have classes of their own (the last two)."""
    size = counts.sum(0) + counts.sum(1)
    free = np.argsort(-size[:HEADS + ENDINGS], kind="stable")
    free = free[size[free] > 0]
    of = np.zeros(_SIZE, np.int64)
    of[free] = np.arange(len(free)) % classes
    of[_END], of[_START] = classes, classes + 1
    m = classes + 2
    table = np.zeros((m, m))
    np.add.at(table, (of[:, None], of[None, :]), counts)
    left = np.zeros((_SIZE, m))   # counts of classes before each unit
    right = np.zeros((_SIZE, m))  # and after it
    np.add.at(left.T, of, counts)
    np.add.at(right.T, of, counts.T)
    for _ in range(rounds):
        moved = 0
        for w in free:
            a, own = of[w], counts[w, w]
            lw, rw = left[w].copy(), right[w].copy()
            lw[a] -= own
            rw[a] -= own
            table[:, a] -= lw
            table[a, :] -= rw
            table[a, a] -= own
            row, col = table.sum(1) + lw, table.sum(0) + rw  # with the unit's neighbours, wherever it goes
            # gain of each class b: its column gets lw, its row gets rw, its own cell both
            up = (_g(table + lw[:, None]) - _g(table)).sum(0)[:classes] + (_g(table + rw[None, :]) - _g(table)).sum(1)[:classes]
            d = np.arange(classes)
            cell = table[d, d]
            up += (_g(cell + lw[d] + rw[d] + own) - _g(cell)) - (_g(cell + lw[d]) - _g(cell)) - (_g(cell + rw[d]) - _g(cell))
            r, c = rw.sum() + own, lw.sum() + own
            up -= _g(row[:classes] + r) - _g(row[:classes]) + _g(col[:classes] + c) - _g(col[:classes])
            b = int(up.argmax())
            if up[b] <= up[a] + 1e-9:
                b = int(a)
            table[:, b] += lw
            table[b, :] += rw
            table[b, b] += own
            if b != a:
                moved += 1
                of[w] = b
                left[:, a] -= counts[w]
                left[:, b] += counts[w]
                right[:, a] -= counts[:, w]
                right[:, b] += counts[:, w]
        if not moved:
            break
    return of


def _dense(left, right, own, a, table):
    """Gain of every class for words out of class ``a``; left, right: counts of classes beside them."""
    n, d = len(a), np.arange(len(a))
    t = np.repeat(table[None], n, 0)
    t[d, :, a] -= left
    t[d, a, :] -= right
    t[d, a, a] -= own
    row, col = t.sum(2) + left, t.sum(1) + right
    base = np.repeat(_g(table)[None], n, 0)  # of t, which differs by a row and a column
    base[d, :, a], base[d, a, :] = _g(t[d, :, a]), _g(t[d, a, :])
    up = (_g(t + left[:, :, None]) - base).sum(1) + (_g(t + right[:, None, :]) - base).sum(2)
    cell = np.diagonal(t, axis1=1, axis2=2)
    up += _g(cell + left + right + own[:, None]) - _g(cell + left) - _g(cell + right) + _g(cell)
    r, c = (right.sum(1) + own)[:, None], (left.sum(1) + own)[:, None]
    return (up - _g(row + r) + _g(row) - _g(col + c) + _g(col))[:, :CLASSES]


def _sparse(word, cell, n, size, own, a, table):
    """The same for words of few occurrences, by the cells that they have; the bigrams of a word
    with its own class are taken as those with another word of it."""
    up = np.zeros((size, CLASSES))
    row, col = table.sum(1)[:CLASSES], table.sum(0)[:CLASSES]
    for side, to, sums in ((0, table[:, :CLASSES], col), (1, table.T[:, :CLASSES], row)):
        mine = (cell < 2 * _M) & (cell // _M == side)
        w, d, k = word[mine], cell[mine] % _M, n[mine].astype(np.int64)
        total = (np.bincount(w, k, size) + own).astype(np.int64)
        most = int(k.max(initial=0)) + 1
        gains = _gains(to, d * most + k, most)
        for i in range(0, len(w), 1 << 14):
            j = slice(i, i + (1 << 14))
            gain = gains(j, a[w[j]], True)
            first = np.flatnonzero(np.r_[True, w[j][1:] != w[j][:-1]])
            up[w[j][first]] += np.add.reduceat(gain, first, 0)
        gains = _gains(sums[None], total, int(total.max(initial=0)) + 1)
        for i in range(0, size, 1 << 14):
            j = slice(i, i + (1 << 14))
            up[j] -= gains(j, a[j], True)
    gains = _gains(np.diagonal(table)[None, :CLASSES], own.astype(np.int64), int(own.max(initial=0)) + 1)
    for i in range(0, size, 1 << 14):
        j = slice(i, i + (1 << 14))
        up[j] += gains(j, a[j], False)
    return up


def _gains(to, key, most):
    """What counts add to the rows of ``to``, key = row * most + count: reckoned once for equal keys.
    The function gives it for some of them, with the counts taken out of the column ``a`` before or not."""
    kinds = np.zeros(len(to) * most, bool)
    kinds[key] = True
    number = np.cumsum(kinds) - 1
    x, k = np.divmod(np.flatnonzero(kinds), most)
    x = to[x]
    gain = _g(x + k[:, None]) - _g(x)

    def gains(j, a, out):
        up = gain[number[key[j]]]
        if out:
            x, k = np.divmod(key[j], most)
            x = np.maximum(to[x, a] - k, 0)
            up[np.arange(len(k)), a] = _g(x + k) - _g(x)
        return up

    return gains


def best_class(word, cell, n, a, table) -> np.ndarray:
    """The class of each word (numbered from 0, ``word`` ascending) that exchange gives it, from
    the class ``a``, for its cells and the class bigrams ``table`` that it is part of."""
    size, out = len(a), a.copy()
    cell = np.where(cell >= _RARE, cell - _RARE, cell)
    order = np.argsort(word * _CELLS + cell, kind="stable")
    word, cell, n = word[order], cell[order], n[order]
    own = np.bincount(word[cell == _SELF], n[cell == _SELF], size)
    much = np.bincount(word, n, size) > 2 * DENSE

    def to(which, up):
        b = up.argmax(1)
        d = np.arange(len(b))
        out[which] = np.where(up[d, b] > up[d, a[which]] + LEAVE, b, a[which])

    for i in range(0, size, 1 << 16):  # few words at a time, whatever the batch
        some = np.arange(i, min(size, i + (1 << 16)))
        j = slice(*np.searchsorted(word, [some[0], some[-1] + 1]))
        w, c, k = word[j] - i, cell[j], n[j]
        few = some[~much[some]]
        if len(few):
            at = np.cumsum(~much[some]) - 1
            on = ~much[some][w]
            to(few, _sparse(at[w[on]], c[on], k[on], len(few), own[few], a[few], table))
        big = some[much[some]]
        for x in range(0, len(big), 128):
            part = big[x:x + 128]
            at = np.full(len(some), -1)
            at[part - i] = np.arange(len(part))
            v = slice(*np.searchsorted(w, [part[0] - i, part[-1] - i + 1]))
            ww, cc, kk = at[w[v]], c[v], k[v]
            on = (ww >= 0) & (cc < _SELF)
            both = np.bincount(ww[on] * 2 * _M + cc[on], kk[on], len(part) * 2 * _M).reshape(len(part), 2, _M)
            to(part, _dense(both[:, 0], both[:, 1], own[part], a[part], table))
    return out


def moved(near: DataFrame, table) -> DataFrame:
    """(w, class, k, n): every word of ``near`` with its new class; and, with a null w, the bigrams
    k = before * _M + at between these words and known ones, in the new classes, per task."""
    def run(batches):
        total = np.zeros(_M * _M, np.int64)
        have = None

        def chosen(t, last):
            """The new classes of the words that are whole, and the rows of the last word otherwise."""
            w = t.column(0).to_numpy()
            keep = len(w) if last else int(np.searchsorted(w, w[-1]))
            at = np.flatnonzero(np.r_[True, w[1:keep] != w[:keep - 1]]) if keep else np.zeros(0, np.int64)
            lists = t.column(2).combine_chunks() if isinstance(t.column(2), pa.ChunkedArray) else t.column(2)
            size = np.asarray(pa.compute.list_value_length(lists)).astype(np.int64)[:keep]
            v = lists.slice(0, keep).flatten().to_numpy()
            a = t.column(1).to_numpy().astype(np.int64)[at]
            word = np.repeat(np.repeat(np.arange(len(at)), np.diff(np.r_[at, keep])), size)
            cell, n = v % _CELLS, v // _CELLS
            to = best_class(word, cell, n, a, table.value)
            mine = to[word]
            k = np.where(cell < _M, cell * _M + mine, mine * _M + cell - _M)
            on = cell < _SELF
            total[:] += np.bincount(k[on], n[on], _M * _M).astype(np.int64)
            none = pa.nulls(len(at), pa.int32()), pa.nulls(len(at), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(w[at]), pa.array(to.astype(np.int16)), *none], ["w", "class", "k", "n"]), t.slice(keep)

        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b])
            have = t if have is None else pa.concat_tables([have, t])
            out, have = chosen(have, False)
            yield out
        if have is not None and have.num_rows:
            yield chosen(have, True)[0]
        k = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.nulls(len(k), pa.int64()), pa.nulls(len(k), pa.int16()), pa.array(k.astype(np.int32)),
                                          longs(total[k])], ["w", "class", "k", "n"])

    return near.repartition("w").sortWithinPartitions("w").mapInArrow(run, "w long, class short, k int, n long")


def rare_pairs(seqs: DataFrame) -> DataFrame:
    """(h, h2, n): neighbours that both are outside the known words."""
    def run(batches):
        for codes, rest in _read(batches):
            rare = codes < -1
            both = rare[:-1] & rare[1:]
            at = np.cumsum(rare)[:-1][both]  # the second's place in rest
            yield pa.RecordBatch.from_arrays([longs(rest[at - 1]), longs(rest[at])], ["h", "h2"])

    return seqs.mapInArrow(run, "h long, h2 long").groupBy("h", "h2").agg(F.count(F.lit(1)).alias("n"))


def likelihood(table: np.ndarray) -> float:
    """Of the class bigrams, as far as it depends on the classes."""
    return float(_g(table).sum() - _g(table.sum(0)).sum() - _g(table.sum(1)).sum())


@dataclass
class Model:
    key: np.ndarray         # sorted hashes of the known words
    known: np.ndarray       # their log10(count + 0.5)
    of: np.ndarray          # their classes
    step: np.ndarray        # log10 P(class | class before)
    mass: np.ndarray        # log10 of each class's smoothed size
    new: np.ndarray         # class of a word not seen, by its ending: where most of one occurrence are
    ends: int               # training texts
    total: int              # training tokens, ends included
    kinds: int              # different training tokens


def fit(texts: DataFrame) -> tuple[Model, DataFrame]:
    """The model of ``texts`` (text) and the table (h, n, class) of all words counted."""
    spark = texts.sparkSession
    sc = spark.sparkContext
    counts = stored(word_counts(texts))
    ends = texts.count()
    # the words above a frequency: its place follows from at most 4096 bins of frequencies
    bins = counts.groupBy(F.floor(F.log2("n") * 64).alias("bin")).agg(F.count(F.lit(1)).alias("v")).collect()
    least, have = None, 0
    for r in sorted(bins, key=lambda r: -r["bin"]):
        have += r["v"]
        if have > KNOWN:
            break
        least = r["bin"]
    frequent = counts.where(F.floor(F.log2("n") * 64) >= least) if least is not None else counts.where("false")
    top = frequent.toPandas().sort_values(["n", "h"], ascending=[False, True])
    h, n = top["h"].to_numpy(np.int64).view(np.uint64), top["n"].to_numpy(np.int64)
    ending = top["ending"].to_numpy(np.int64)
    del top
    order = np.argsort(h)
    seqs = stored(coded(texts, sc.broadcast((h[order], order.astype(np.int32)))))

    def lut(words, groups, end):  # by code: ranks from the front, ends and endings from the back
        return np.concatenate([words, groups[::-1], [end]])

    rank, groups = np.arange(len(h)), HEADS + np.arange(ENDINGS)
    start = _table(seqs, sc.broadcast(lut(np.where(rank < HEADS, rank, HEADS + ending), groups, _END).astype(np.int16)), _SIZE)
    unit = exchange(start)
    seed = unit[groups]
    of = np.where(rank < HEADS, unit[np.minimum(rank, HEADS - 1)], seed[ending]) if len(h) else np.zeros(0, np.int64)
    table = np.zeros((_M, _M))
    np.add.at(table, (unit[:, None], unit[None, :]), start)
    del start
    still = 0
    for i in range(WORD_ROUNDS * PARTS if len(h) else 0):
        near = beside(seqs, sc.broadcast(lut(of, seed, CLASSES).astype(np.int16)), i % PARTS)
        got = moved(near, sc.broadcast(table)).where("w is not null").select("w", "class").toPandas()
        to = of.copy()
        to[got["w"].to_numpy(np.int64)] = got["class"].to_numpy()
        after = _table(seqs, sc.broadcast(lut(to, seed, CLASSES).astype(np.int16)), _M)
        better = likelihood(after) > likelihood(table)
        if better:
            of, table = to, after
        still = 0 if better else still + 1
        if still == PARTS:
            break
    # all others, beside the classes that the known words have now
    codes = sc.broadcast(lut(of, seed, CLASSES).astype(np.int16))
    rest = stored(moved(beside(seqs, codes, None), sc.broadcast(table)))
    table = _table(seqs, codes, _M, _all_known)
    words = rest.where("w is not null").select(F.col("w").alias("h"), F.col("class"))
    pairs = (rare_pairs(seqs).join(words, "h").withColumnRenamed("class", "before")
             .join(words.select(F.col("h").alias("h2"), "class"), "h2").select((F.col("before") * F.lit(_M) + F.col("class")).alias("k"), "n"))
    for r in rest.where("w is null").select("k", "n").union(pairs).groupBy("k").agg(F.sum("n").alias("n")).collect():
        table[r["k"] // _M, r["k"] % _M] += r["n"]
    steps = table[:, :_M - 1] + SMOOTH  # nothing leads to the start
    # the other words' counts with their classes; the known ones travel with the model
    others = stored(counts.join(words, "h"))
    size, kinds, once = np.bincount(of, n, _M), np.bincount(of, minlength=_M), np.zeros((ENDINGS, _M))
    np.add.at(once, (ending, of), n == 1)
    for r in others.groupBy("ending", "class").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v"),
                                                   F.sum((F.col("n") == 1).cast("long")).alias("once")).collect():
        size[r["class"]] += r["n"]
        kinds[r["class"]] += r["v"]
        once[r["ending"], r["class"]] += r["once"]
    new = np.where(once.any(1), once.argmax(1), seed)
    mass = size + EMIT * (kinds + np.bincount(new, minlength=_M))
    return Model(h[order], np.log10(n[order] + 0.5), of[order].astype(np.int16), np.log10(steps / steps.sum(1, keepdims=True)),
                 np.log10(np.maximum(mass, EMIT)), new, ends, int(size.sum()) + ends, int(kinds.sum()) + (ends > 0)), others.drop("ending")


def scored(docs: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every row of
    ``docs`` (doc_id, text).

    base_score: log10 probability under add-half unigrams; score: under the class model.
    Null or empty texts are one end; null doc_ids and repeated rows are scored like
    others; without training texts all words are unknown. An empty table gives an empty
    result. Other columns are not read.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = held.value
        places = _places(m.key)
        # one more row for a word that the join has to tell: class -1, nothing to add
        logs, kinds = np.append(m.known, 0.0), np.append(m.of, np.int16(-1))
        emit = np.append(m.known - m.mass[m.of], 0.0)
        step = np.pad(m.step, ((1, 0), (1, 0))).ravel()
        for b in slices(batches, 1):
            h, first, ending = tokens(b.column(1))
            n, doc, size = b.num_rows, W.owner(first), np.diff(first)
            k = places(h)
            base = np.bincount(doc, logs[k], n) + np.log10(m.ends + 0.5)
            # classes in order; transitions between known ones count here
            at = np.full(len(h) + n, CLASSES, np.int16)
            at[np.arange(len(h)) + doc] = kinds[k]
            before = np.concatenate([[np.int16(_M - 1)], np.where(at[:-1] == CLASSES, np.int16(_M - 1), at[:-1])])[:len(at)]
            cls = np.bincount(np.repeat(np.arange(n), size + 1), step[(before + 1) * np.int16(_M) + at + 1], n)
            cls += np.bincount(doc, emit[k], n)
            rest, rare = np.flatnonzero(at < 0), np.flatnonzero(k == len(m.key))
            unknown = np.bincount(doc[rare], minlength=n)
            cut = pa.array(np.concatenate([[0], np.cumsum(unknown)]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(size + 1, pa.int64()), pa.array(size - unknown + (m.ends > 0), pa.int64()),
                 pa.array(base), pa.array(cls),
                 pa.ListArray.from_arrays(cut, longs(h[rare])),
                 pa.ListArray.from_arrays(cut, pa.array(m.new[ending(rare)].astype(np.int8))),
                 pa.ListArray.from_arrays(cut, pa.array(before[rest].astype(np.int8))),
                 pa.ListArray.from_arrays(cut, pa.array(at[rest + 1].astype(np.int8)))],
                ["doc_id", "n_tokens", "n_known", "base", "cls", "rest", "new", "before", "after"])

    rows = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
                  .mapInArrow(run, "doc_id long, n_tokens long, n_known long, base double, cls double, rest array<long>, "
                                   "new array<tinyint>, before array<tinyint>, after array<tinyint>")
                  .withColumn("row", F.monotonically_increasing_id()))
    rare = rows.select("row", F.posexplode("rest").alias("p", "h"), *(F.get(c, F.col("p")).alias(c) for c in ("new", "before", "after")))
    looked = (rare.join(counts, "h", "left").withColumn("class", F.coalesce("class", "new")).groupBy("row")
              .agg(F.sort_array(F.collect_list(F.struct("p", "n", "class", "before", "after"))).alias("found")))

    def rest(batches):
        """(row, log, seen, cls) of the words that were joined."""
        m = held.value
        for b in batches:
            found = b.column(1)
            size = np.asarray(pa.compute.list_value_length(found)).astype(np.int64)
            p, n, kind, before, after = (x.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64) for x in found.flatten().flatten())
            doc = np.repeat(np.arange(len(size)), size)
            seen = n >= 0
            log = np.log10(np.maximum(n, 0) + 0.5)
            before = np.where(before < 0, np.r_[0, kind[:-1]][:len(kind)], before)
            cls = log - m.mass[kind] + m.step[before, kind]
            on = after >= 0
            cls[on] += m.step[kind[on], after[on]]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.bincount(doc, log, len(size)), pa.float64()),
                                              pa.array(np.bincount(doc, seen, len(size)).astype(np.int64)),
                                              pa.array(np.bincount(doc, cls, len(size)), pa.float64())], ["row", "log", "seen", "more"])

    looked = looked.mapInArrow(rest, "row long, log double, seen long, more double")
    log, seen, more = (F.coalesce(c, F.lit(0)) for c in ("log", "seen", "more"))
    share = float(np.log10(model.total + 0.5 * (model.kinds + 1)))
    return rows.drop("rest", "new", "before", "after").join(looked, "row", "left").select(
        "doc_id", "n_tokens", (F.col("n_known") + seen).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("base") + log - F.col("n_tokens") * F.lit(share)).alias("base_score"), (F.col("cls") + more).alias("score"))
