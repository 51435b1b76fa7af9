"""Best-fit packing of token sequences in bulk-synchronous rounds.

Each round orders all pieces that have no place and all gaps by size, from large to
small, and lets every piece take the smallest gap that holds it and that no larger
piece has taken. In that order the gaps form a stack: a gap is pushed, a piece pops.
The stack's height at each size follows from the counts per size (at most ``capacity``
sizes, so the sweep over them is short for any corpus), and a row's own height from
its rank within its size; a piece then takes the gap that was last pushed at its
height. So one round is a rank within sizes and a match within heights, both
distributed. Gaps shrink by what they took, and the next round begins.

A size that many rows share is dealt over sub-groups by a hash, of ``GROUP`` rows, or
more where that would make over ``GROUPS`` of them, which the driver sweeps. A gap that holds several of the largest pieces left is
offered as that many slots. The first round opens as many sequences as the tokens
fill, or as there are pieces over half the capacity; more are opened when a round
places next to nothing.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ferret.llm import wordhash
from ferret.llm.common import checkpointed, slices, texts_of

CAPACITY = 2048
GROUP = 4_000
#: Sub-groups of all sizes together: beyond it groups grow with the rows.
GROUPS = 100_000
#: Units of one text given to the tokenizer.
UNITS = 200
#: Words whose ids a worker remembers, and places where it looks for them; it forgets all
#: before the next slice when there are more.
MEMO, PLACES, TRIES = 500_000, 1 << 20, 8


def _learner(path: str | None):
    """Function (data, start, end): words data[start:end] without white space -> (ids, sizes,
    order), the ids of all of them one after another, how many each has, and which words
    they are.

    The tokenizer never joins across white space, and splits letters from a full stop or
    comma after them unless the last one's normal form ends in a mark; such a pair is kept
    whole. Units of letters alone are encoded many at a time, ASCII ones in lower case and
    past the normal form and the rules that split words: each ends at the one id that closes
    a word. No word of these is looked at by itself."""
    import public_tokenizers
    from tokenizers import Tokenizer, pre_tokenizers

    path = path or public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    plain = Tokenizer.from_file(path)
    plain.normalizer = None
    plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    closes = np.zeros(tok.get_vocab_size() + 1, bool)
    closes[[i for t, i in tok.get_vocab().items() if t.endswith("</w>")]] = True
    letter = np.zeros(256, bool)
    letter[[*range(65, 91), *range(97, 123)]] = True

    def raw(unit):
        return np.array(tok.encode(unit, add_special_tokens=False).ids, "<u4")

    def batched(texts, by):
        return np.concatenate([np.array(e.ids, "<u4") for e in by.encode_batch_fast(texts, add_special_tokens=False)])

    marks = {m: raw(m) for m in ".,"}
    mark_of = np.zeros(256, np.int64)
    mark_of[list(map(ord, marks))] = np.arange(1, len(marks) + 1)
    mark_ids = np.concatenate([np.zeros(1, "<u4"), *marks.values()])
    if len(mark_ids) != len(marks) + 1:  # a mark of several ids: leave pairs whole
        mark_of[:] = 0
    apart: dict = {}

    def splits(c):
        """Whether the tokenizer parts this letter from a mark after it."""
        if c not in apart:
            apart[c] = c.isalpha() and all(np.array_equal(raw(c + m), np.concatenate([raw(c), i])) for m, i in marks.items())
        return apart[c]

    def sized(ids, n):
        """How many ids each of n units has, or None if one closes more than once."""
        cut = np.flatnonzero(closes[ids]) + 1
        return np.diff(cut, prepend=0) if len(cut) == n else None

    def ascii_letters(data, start, end):
        """(ids, sizes) of words of ASCII letters."""
        size = end - start + 1
        at = np.cumsum(size) - size
        text = data[np.minimum(np.repeat(start - at, size) + np.arange(size.sum()), len(data) - 1)]
        text = wordhash.LOWER[text]
        text[at + size - 1] = 32
        blob, cuts = text.tobytes().decode("ascii"), [*at[::UNITS].tolist(), len(text)]
        ids = batched([blob[a:z] for a, z in zip(cuts, cuts[1:])], plain)
        return ids, sized(ids, len(start))

    def others(words):
        """(ids, sizes) of words of any characters."""
        core, last = [], np.zeros(len(words), np.int64)
        for k, t in enumerate(words):
            if t[-1] in marks and mark_of[ord(t[-1])] and len(t) > 1 and splits(t[-2]):
                last[k], t = mark_of[ord(t[-1])], t[:-1]
            core.append(t)
        out = [None] * len(core)
        plainly = [k for k, t in enumerate(core) if t.isalpha()]
        for i in range(0, len(plainly), 100 * UNITS):
            part = plainly[i:i + 100 * UNITS]
            ids = batched([" ".join(core[k] for k in part[j:j + UNITS]) for j in range(0, len(part), UNITS)], tok)
            size = sized(ids, len(part))
            if size is not None:  # else a letter has a normal form that is none
                for k, one in zip(part, np.split(ids, np.cumsum(size)[:-1])):
                    out[k] = one
        alone = [k for k, o in enumerate(out) if o is None]
        for i in range(0, len(alone), 100 * UNITS):
            part = alone[i:i + 100 * UNITS]
            for k, e in zip(part, tok.encode_batch_fast([core[k] for k in part], add_special_tokens=False)):
                out[k] = np.array(e.ids, "<u4")
        size = np.fromiter(map(len, out), np.int64, len(out))
        return marked(np.concatenate(out), size, last) if out else (np.zeros(0, "<u4"), size)

    def marked(ids, size, last):
        """The ids with those of the marks after them."""
        has = np.flatnonzero(last)
        return np.insert(ids, np.cumsum(size)[has], mark_ids[last[has]]), size + (last > 0)

    def learn(data, start, end):
        final = data[end - 1]
        last = np.where(end - start > 1, mark_of[final], 0)
        count = np.concatenate([[0], np.cumsum(letter[data])])
        core = end - (last > 0)
        simple = count[core] - count[start] == core - start
        mine = np.flatnonzero(simple)
        rest = np.flatnonzero(~simple)
        ids, size = ascii_letters(data, start[mine], core[mine]) if len(mine) else (np.zeros(0, "<u4"), np.zeros(0, np.int64))
        ids, size = marked(ids, size, last[mine])
        more, sizes = others([data[a:z].tobytes().decode() for a, z in zip(start[rest].tolist(), end[rest].tolist())])
        return np.concatenate([ids, more]), np.concatenate([size, sizes]), np.concatenate([mine, rest])

    return learn


class _Words:
    """The ids of known words in flat arrays. A word's 64-bit hash has TRIES places; a word
    that finds all taken displaces one, which is then learnt anew when it comes again."""

    def __init__(self, tokenizer: str | None, end_id: int, memo: int = MEMO, places: int = PLACES):
        self.learn, self.memo, self.mask, self.end_id = _learner(tokenizer), memo, places - 1, end_id
        self.forget()

    def forget(self):
        self.hash = np.zeros(self.mask + 1, np.uint64)
        self.at = np.zeros(self.mask + 1, np.int32)  # word 0 is the end of a text
        self.start, self.size, self.ids = np.zeros(1, np.int64), np.ones(1, np.int64), np.array([self.end_id], "<u4")

    def _place(self, h, k):
        return (h >> np.uint64(5 * k) & np.uint64(self.mask)).astype(np.int64)

    def numbers(self, data, start, end):
        """The number of each word data[start:end]."""
        h = wordhash.hashes(data, start, end)
        h[h == 0] = np.uint64(1)  # 0 marks a free place
        at = self._place(h, 0)
        out = np.where(self.hash[at] == h, self.at[at], 0)
        miss = np.flatnonzero(out == 0)
        for k in range(1, TRIES):
            if not len(miss):
                break
            at = self._place(h[miss], k)
            hit = self.hash[at] == h[miss]
            out[miss[hit]] = self.at[at[hit]]
            miss = miss[~hit]
        if len(miss):
            new, first, back = np.unique(h[miss], return_index=True, return_inverse=True)
            at = miss[first]
            ids, size, order = self.learn(data, start[at], end[at])
            number = np.empty(len(new), np.int64)
            number[order] = np.arange(len(self.size), len(self.size) + len(new))
            self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(size) - size])
            self.size = np.concatenate([self.size, size])
            self.ids = np.concatenate([self.ids, ids])
            left = np.arange(len(new))
            for k in range(TRIES):
                place = self._place(new[left], k)
                free = self.hash[place] == 0 if k + 1 < TRIES else np.ones(len(left), bool)
                self.hash[place[free]], self.at[place[free]] = new[left[free]], number[left[free]]
                left = left[self.hash[place] != new[left]]  # of several for one place the last stays
            out[miss] = number[back]
        return out

    def encode(self, data, offs):
        """(ids, first): the ids of each text and its end id, and where they begin."""
        if len(self.size) > self.memo:
            self.forget()
        start, end, word = wordhash.bounds(data, offs)
        number = np.insert(self.numbers(data, start, end), word[1:], 0)
        size = self.size[number]
        total = np.cumsum(size)
        ids = self.ids[np.repeat(self.start[number] - total + size, size) + np.arange(total[-1] if len(total) else 0)]
        ends = word[1:] + np.arange(len(word) - 1)  # each text's end in ``number``
        return ids, np.concatenate([[0], total[ends]]).astype(np.int64)


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each text's ids and ``end_id``, cut into
    pieces of ``capacity``. Null text counts as empty. Narrow. ``tokenizer``: a file of
    the `tokenizers` library whose rules never join across white space, on every node.
    Special tokens written out in a text are read as such, as the library does."""
    def run(batches):
        import os
        import sys

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        # reused workers keep the words they know from task to task
        memo = sys.modules.setdefault("_ferret_words", type(sys)("_ferret_words")).__dict__
        words = memo.get((tokenizer, end_id)) or memo.setdefault((tokenizer, end_id), _Words(tokenizer, end_id))
        for b in slices(batches, 1):
            ids, first = words.encode(*texts_of(b.column(1)))
            n = -(-np.diff(first) // capacity)
            doc = np.repeat(np.arange(len(n)), n)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
            start = piece * capacity
            length = np.minimum(capacity, np.diff(first)[doc] - start)
            at = first[doc] + start
            blob = memoryview(np.ascontiguousarray(ids).view(np.uint8))
            crc = [zlib.crc32(blob[a:z]) for a, z in zip((4 * at).tolist(), (4 * (at + length)).tolist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                 pa.array(crc, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def _sweep(counts: dict, groups: dict) -> list:
    """Stack heights by size. counts: (kind, size) -> rows (kind 1: gaps, 0: pieces);
    groups: (kind, size, sub) -> rows. Gives (kind, size, sub, first height, rows with one)."""
    rows, height, subs = [], 0, {}
    for k, z, s in sorted(groups):
        subs.setdefault((k, z), []).append(s)
    for size in sorted({s for _, s in counts}, reverse=True):
        for kind in (1, 0):
            n = counts.get((kind, size), 0)
            have, rank = height, 0
            for sub in subs.get((kind, size), ()) if n else ():
                m = groups[kind, size, sub]
                if kind:
                    rows.append((kind, size, sub, have + rank + 1, m))
                else:
                    rows.append((kind, size, sub, have - rank, max(0, min(m, have - rank))))
                rank += m
            height = have + n if kind else have - min(n, have)
    return rows


def pack(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(uid, sequence_id, offset) for ``items`` (uid, length) with 1 <= length <= capacity.

    Sequences are filled from offset 0 without gaps between pieces; ``uid`` must be
    unique. Equal lengths are ranked by uid. An empty table gives an empty result.
    """
    spark = items.sparkSession
    left = checkpointed(items.select(F.col("uid").cast("long").alias("uid"), F.col("length").cast("long").alias("length")))
    placed, bins, opened, turn, grow = [], None, 0, 0, True
    while True:
        sizes = {r["length"]: r["n"] for r in left.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
        if not sizes:
            break
        need, large = sum(k * n for k, n in sizes.items()), sum(n for k, n in sizes.items() if 2 * k > capacity)
        if grow:
            new = max(-(-need // capacity), large if not turn else 1)
            fresh = spark.range(opened, opened + new).select(F.col("id").alias("bin"), F.lit(capacity).cast("long").alias("gap"))
            bins = fresh if bins is None else bins.unionByName(fresh)
            opened += new
        rows = F.greatest(F.lit(1), F.floor(F.col("gap") / F.lit(max(sizes)))).cast("int")
        slots = (bins.where(F.col("gap") >= min(sizes)).select("bin", "gap", rows.alias("k"))
                 .select("bin", F.floor(F.col("gap") / F.col("k")).cast("long").alias("size"),
                         F.explode(F.sequence(F.lit(1), "k")).alias("slot")))
        rows = (left.select(F.lit(0).alias("kind"), F.col("length").alias("size"), F.col("uid").alias("id"),
                            F.lit(0).alias("slot"))
                .unionByName(slots.select(F.lit(1).alias("kind"), "size", F.col("bin").alias("id"), "slot")))
        counts = {(0, k): n for k, n in sizes.items()}
        counts |= {(1, r["size"]): r["n"] for r in slots.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}
        group = max(GROUP, -(-sum(counts.values()) // GROUPS))
        parts = {k: -(-n // group) for k, n in counts.items() if n > group}
        if parts:  # at most 2 x capacity rows
            hot = F.broadcast(spark.createDataFrame([(k, z, n) for (k, z), n in parts.items()], "kind int, size long, parts int"))
            many = rows.join(hot, ["kind", "size"])
            rows = rows.join(hot, ["kind", "size"], "left")
        sub = F.pmod(F.xxhash64("id", "slot"), F.coalesce("parts", F.lit(1))).cast("int") if parts else F.lit(0)
        rows = rows.select("kind", "size", "id", "slot", sub.alias("sub"))
        groups = {(k, s, 0): n for (k, s), n in counts.items() if (k, s) not in parts}
        if parts:
            many = many.withColumn("sub", sub)
            groups |= {(r["kind"], r["size"], r["sub"]): r["n"] for r in
                       many.groupBy("kind", "size", "sub").agg(F.count(F.lit(1)).alias("n")).collect()}
        heights = spark.createDataFrame(_sweep(counts, groups), "kind int, size long, sub int, first long, most long")
        rank = F.row_number().over(Window.partitionBy("kind", "size", "sub").orderBy("id", "slot")) - 1
        ranked = rows.withColumn("rank", rank).join(F.broadcast(heights), ["kind", "size", "sub"])
        height = (F.when(F.col("kind") == 1, F.col("first") + F.col("rank"))
                  .when(F.col("rank") < F.col("most"), F.col("first") - F.col("rank"))
                  .otherwise(-1 - F.col("id")))  # no gap: a height of its own
        below = F.lag(F.when(F.col("kind") == 1, F.col("id"))).over(
            Window.partitionBy("height").orderBy(F.desc("size"), F.desc("kind")))
        done = checkpointed(ranked.withColumn("height", height).withColumn("bin", below).where("kind = 0")
                            .select(F.col("id").alias("uid"), F.col("size").alias("length"), "bin"))
        took = done.where("bin is not null")
        placed.append(took.withColumn("turn", F.lit(turn)))
        left = done.where("bin is null").select("uid", "length")
        used = took.groupBy("bin").agg(F.sum("length").alias("used"), F.count(F.lit(1)).alias("n"))
        bins = checkpointed(bins.join(used, "bin", "left").select(
            "bin", (F.col("gap") - F.coalesce("used", F.lit(0))).alias("gap")).where(F.col("gap") > 0))
        grow = 50 * took.count() < sum(sizes.values())
        turn += 1
    if not placed:
        return items.select(F.col("uid").cast("long").alias("uid"), F.lit(0).cast("long").alias("sequence_id"),
                            F.lit(0).cast("long").alias("offset")).where("false")
    every = placed[0]
    for p in placed[1:]:
        every = every.unionByName(p)
    before = F.sum("length").over(Window.partitionBy("bin").orderBy("turn", F.desc("length"), "uid")
                                  .rowsBetween(Window.unboundedPreceding, -1))
    return every.select("uid", F.col("bin").alias("sequence_id"), F.coalesce(before, F.lit(0)).alias("offset"))


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """Pieces of every row of ``docs`` (doc_id, text) with their places: doc_id, piece,
    start, length, ids_crc32, sequence_id, offset.

    Null or empty texts are one piece that holds ``end_id``; null doc_ids and rows that
    repeat a doc_id are packed like others. Pieces of full length stand alone and are
    not matched. An empty table gives an empty result. Other columns are not read.
    """
    cut = checkpointed(pieces(docs, tokenizer, capacity, end_id).withColumn("uid", F.monotonically_increasing_id()))
    short = pack(cut.where(F.col("length") < capacity).select("uid", "length"), capacity)
    out = cut.where(F.col("length") < capacity).join(short, "uid")
    whole = cut.where(F.col("length") >= capacity).withColumn("sequence_id", -1 - F.col("uid")).withColumn(
        "offset", F.lit(0).cast("long"))
    return out.unionByName(whole).drop("uid")
