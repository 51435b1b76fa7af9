"""Substring deduplication by level-wise doubling over word windows.

A window of ``window`` words can repeat only if the windows of half that length inside
it repeat. Level one looks at half windows: in every run of half windows that a full
window spans, the one with the least hash is its anchor (equal windows choose equal
anchors), so about one position in fourteen is counted. Anchors found in one text
alone are dropped. Level two extends the rest: only windows whose anchor repeats are
hashed (128 bits) and counted at full length. No candidate is left after that, since
``window`` is the length asked for.

Exact copies are first reduced to the copy with the smallest doc_id: each window of
another copy starts there too, so all its words go without looking at windows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferret.llm import wordhash as W
from ferret.llm.common import bit_filter, bounded, checkpointed, longs, passes, slices, stored, texts_of

_EMPTY = hashlib.sha256(b"").hexdigest()


def _id_text(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, sha): word count and SHA-256 of the words joined by one space."""
    def run(batches):
        for b in slices(batches, 1):
            words = [(t or "").encode().split() for t in b.column(1).to_pylist()]
            sha = [hashlib.sha256(b" ".join(w)).hexdigest() for w in words]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(list(map(len, words)), pa.int64()), pa.array(sha)],
                                             ["doc_id", "n_words", "sha"])

    return _id_text(docs).mapInArrow(run, "doc_id long, n_words long, sha string")


def _half_windows(b, window: int):
    """(hashes of half windows, full windows' mask, first words, word hashes) of a batch's texts."""
    data, offs = texts_of(b.column(1))
    h, first = W.words(data, offs)
    half = (window + 1) // 2
    g, ok = W.windows(h, half), W.full(first, window)
    return g, ok, first, h


def anchor_rows(docs: DataFrame, window: int) -> DataFrame:
    """(h, doc_id): the anchors of every text."""
    def run(batches):
        for b in slices(batches, 1):
            g, ok, first, _ = _half_windows(b, window)
            at = np.flatnonzero(W.anchors(g, ok, len(g) - len(ok) + 1))
            doc = b.column(0).take(pa.array(W.owner(first)[at]))
            yield pa.RecordBatch.from_arrays([longs(g[at]), doc], ["h", "doc_id"])

    return docs.mapInArrow(run, "h long, doc_id long")


def window_rows(docs: DataFrame, window: int, filter_words) -> DataFrame:
    """(h1, h2, doc_id, row, pos): windows whose anchor passes the filter."""
    def run(batches):
        bits = filter_words.value
        for b in slices(batches, 1):
            g, ok, first, h = _half_windows(b, window)
            if not len(ok):
                continue
            at = np.flatnonzero(ok & passes(bits, W.sliding(g, len(g) - len(ok) + 1, np.minimum)))
            doc = W.owner(first)[at]
            yield pa.RecordBatch.from_arrays(
                [longs(W.windows(h, window, 1)[at]), longs(W.windows(h, window, 2)[at]),
                 *(b.column(k).take(pa.array(doc)) for k in (0, 2)), pa.array((at - first[doc]).astype(np.int32))],
                ["h1", "h2", "doc_id", "row", "pos"])

    return docs.mapInArrow(run, "h1 long, h2 long, doc_id long, row long, pos int")


def repeated_windows(docs: DataFrame, window: int = 50) -> DataFrame:
    """(doc_id, row, starts array<int>): windows whose words also start in a smaller doc_id.
    ``docs``: (doc_id, text, row); doc_id and row together name a row."""
    seen = (anchor_rows(docs, window).groupBy("h").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
            .where("a < b").select("h"))
    filter_words = docs.sparkSession.sparkContext.broadcast(bit_filter(checkpointed(seen), "h"))
    rows = window_rows(docs, window, filter_words)
    # read back from storage, so that both sides of the join are shuffled for it and AQE can
    # split the rows of a window that very many texts hold
    least = stored(rows.groupBy("h1", "h2").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
                   .where("least < most").select("h1", "h2", "least"))
    return (rows.join(least, ["h1", "h2"]).where("doc_id > least")
            .groupBy("doc_id", "row").agg(F.collect_list("pos").alias("starts")))


def _cut(window: int, texts: bool):
    """Arrow function (doc_id, row, text, starts) -> what is left of each text."""
    def run(batches):
        for batch in batches:
            left, gone, sha = [], [], []
            for t, s in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                words = (t or "").encode().split()
                step = np.zeros(len(words) + 1, np.int64)
                s = np.asarray(s, np.int64)
                np.add.at(step, s, 1)
                np.add.at(step, s + window, -1)
                keep = np.cumsum(step[:-1]) == 0
                kept = b" ".join([words[k] for k in np.flatnonzero(keep)])
                gone.append(int(len(words) - keep.sum()))
                if texts:
                    left.append(kept.decode())
                else:
                    sha.append(hashlib.sha256(kept).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(gone, pa.int64()), pa.array(left if texts else sha, pa.string())],
                ["doc_id", "row", "n_removed", "kept"])

    return run


def words_digest(text: str):
    """The digest of ``digests`` of a text column, as a native expression."""
    blank = r"[\x20\x09-\x0D]+"
    joined = F.regexp_replace(F.coalesce(F.col(text).cast("string"), F.lit("")), blank, " ")
    return F.sha2(F.trim(joined).cast("binary"), 256)


def cut_repeats(docs: DataFrame, window: int = 50, texts: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) for every row of ``docs`` (doc_id, text).

    Each word covered by a window of ``window`` words whose sequence also starts in a
    document with a smaller doc_id is removed. ``kept``: the words left, joined by one
    space, if ``texts``, otherwise their SHA-256; with ``texts`` it is null where nothing
    was removed (the text stays as it is), and ``digest`` tells rows of one doc_id apart
    (``words_digest`` of the row's text). Null or empty texts have no words. A row with
    null doc_id stays whole and covers nothing. Rows that repeat a doc_id each give a
    row: each is cut by its own words and its windows count as that document's. An empty
    table gives an empty result.
    """
    named = _id_text(docs)
    all_digests = checkpointed(digests(named))
    anonymous = all_digests.where("doc_id is null")
    known = all_digests.where("doc_id is not null")
    many = checkpointed(known.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("doc_id"))
    known, one = known.withColumn("row", F.lit(0).cast("long")), named.where("doc_id is not null").withColumn("row", F.lit(0).cast("long"))
    if not many.isEmpty():  # rows that repeat a doc_id: one of each text
        of_many = bounded(many)
        own = F.xxhash64("sha")
        known = known.join(of_many, "doc_id", "left_anti").unionByName(
            known.join(of_many, "doc_id", "left_semi").withColumn("row", own))
        more = (digested(one.join(of_many, "doc_id", "left_semi")).groupBy("doc_id", own.alias("row")).agg(F.min("text").alias("text")))
        one = one.join(of_many, "doc_id", "left_anti").unionByName(stored(more.select("doc_id", "text", "row")))
    # read back from storage, so that AQE can split the rows of a text with very many copies
    first = stored(known.where(F.col("n_words") >= window).groupBy("sha").agg(
        F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most").select("sha", "least"))
    copies = checkpointed(known.join(first, "sha").where("doc_id > least").select("doc_id", "row").distinct())
    one = one.join(bounded(copies), ["doc_id", "row"], "left_anti").select("doc_id", "text", "row")
    found = checkpointed(repeated_windows(one, window))
    hit = one.join(bounded(found.select("doc_id", "row")), ["doc_id", "row"], "left_semi").join(found, ["doc_id", "row"])
    cut = hit.select("doc_id", "row", "text", "starts").mapInArrow(_cut(window, texts),
                                                                   "doc_id long, row long, n_removed long, kept string")
    gone = copies.select("doc_id", "row", F.lit(None).cast("long").alias("n_removed"),
                         F.lit("" if texts else _EMPTY).alias("kept"))
    whole = F.lit(None).cast("string") if texts else F.col("sha")
    names = [F.col("sha").alias("digest")] if texts else []
    out = known.join(cut.unionByName(gone), ["doc_id", "row"], "left").select(
        "doc_id", "n_words",
        F.when(F.col("kept").isNull(), F.lit(0)).otherwise(F.coalesce("n_removed", "n_words")).cast("long")
        .alias("n_removed"), F.coalesce("kept", whole).alias("kept"), *names)
    return out.unionByName(anonymous.select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"),
                                            whole.alias("kept"), *names))


def digested(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with the digest of each row's words."""
    def run(batches):
        for b in slices(batches, 1):
            sha = [hashlib.sha256(b" ".join((t or "").encode().split())).hexdigest() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(sha)], ["doc_id", "text", "sha"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, text string, sha string")
