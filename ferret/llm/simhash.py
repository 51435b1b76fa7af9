"""SimHash near-duplicates through a segment-popcount embedding.

A 64-bit fingerprint maps to the bit counts of its 32 two-bit segments. The Manhattan
distance of two such vectors is never above the bit distance, so links of at most
three bits lie within distance 3, and one half of the vector within distance 1. Grid
cells are the halves' vectors. Each fingerprint stands in its own two cells and also
visits the neighbour cells one step up; the lower one of any two cells at distance 1
visits the other, so every link meets in a cell. Cells are compared block by block
with the exact bit distance, and a block gives the spanning forest of its links,
never all pairs. A crowded cell is split into chunks whose pairs are separate blocks.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferret.llm.common import checkpointed, longs, slices
from ferret.llm.components import components

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_EVEN = 0x55555555
#: Fingerprints of one chunk of a crowded cell.
CHUNK = 512
#: Shingles whose bits are counted at once.
_PART = 1 << 16


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of the word shingles of one text (XXH64, seed 42); no word gives 0."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    k = min(shingle, len(words))
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    starts, ends = (end - size)[:len(words) - k + 1].tolist(), end[k - 1:].tolist()
    counts, n = np.zeros(64, np.int64), len(starts)
    for i in range(0, n, _PART):
        parts = map(joined.__getitem__, map(slice, starts[i:i + _PART], ends[i:i + _PART]))
        h = np.fromiter(map(xxh64_intdigest, parts, repeat(42)), np.uint64, min(_PART, n - i))
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp long) of every row; null text counts as empty. Narrow."""
    def run(batches):
        for b in slices(batches, 1):
            fp = np.array([fingerprint(t, shingle) for t in b.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), longs(fp)], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, fp long")


def _cells(fps: DataFrame) -> DataFrame:
    """(cell, fp, home): each fingerprint in its own cells and one step up from them."""
    even = F.lit(_EVEN).cast("long")
    x = F.col("fp")
    rows = []
    for half, x in enumerate((x.bitwiseAND(F.lit(0xFFFFFFFF).cast("long")), F.shiftrightunsigned(x, 32))):
        v = x.bitwiseAND(even) + F.shiftrightunsigned(x, 1).bitwiseAND(even)
        key = v + F.lit(half << 32).cast("long")
        rows.append(F.struct(key.alias("cell"), F.lit(1).alias("home")))
        for i in range(16):  # a segment that counts 2 has no step up
            up = F.when(v.bitwiseAND(F.lit(2 << (2 * i)).cast("long")) == 0,
                        F.struct((key + F.lit(1 << (2 * i)).cast("long")).alias("cell"), F.lit(0).alias("home")))
            rows.append(up)
    return (fps.select("fp", F.explode(F.array(*rows)).alias("r")).where("r is not null")
            .select("r.cell", "fp", "r.home"))


def _forest(x: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """x: R blocks of s fingerprints. (member, root) of the links' components per block."""
    near = np.bitwise_count(x[:, :, None] ^ x[:, None, :]) <= bits
    s = x.shape[1]
    label = np.broadcast_to(np.arange(s), x.shape).copy()
    while True:
        new = np.where(near, label[:, None, :], s).min(2)
        if (new == label).all():
            break
        label = new
    r, i = np.nonzero(label != np.arange(s))
    return x[r, i], x[r, label[r, i]]


def _link_blocks(bits: int):
    """Arrow function over rows sorted by block: the links' forest of each block."""
    def links(key, fp):
        cut = np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1
        start, stop = np.r_[0, cut], np.r_[cut, len(fp)]
        size = stop - start
        for s in np.unique(size[size > 1]):
            at = start[size == s]
            step = max(1, (1 << 21) // int(s * s))
            for i in range(0, len(at), step):
                yield _forest(fp[at[i:i + step, None] + np.arange(s)], bits)

    def run(batches):
        key, fp = np.zeros((0, 3), np.int64), np.zeros(0, np.uint64)
        names = ["a", "b"]

        def out(found):
            for a, b in found:
                if len(a):
                    yield pa.RecordBatch.from_arrays([longs(a), longs(b)], names)

        for b in batches:
            if not b.num_rows:
                continue
            col = [np.asarray(b.column(i)) for i in range(4)]
            key = np.concatenate([key, np.stack([c.astype(np.int64) for c in col[:3]], 1)])
            fp = np.concatenate([fp, col[3].astype(np.int64).view(np.uint64)])
            last = np.flatnonzero((key[1:] != key[:-1]).any(1))
            if len(last):  # the last block may go on in the next batch
                cut = int(last[-1]) + 1
                yield from out(links(key[:cut], fp[:cut]))
                key, fp = key[cut:], fp[cut:]
        if len(fp):
            yield from out(links(key, fp))

    return run


def links(fps: DataFrame, bits: int = 3, chunk: int = CHUNK) -> DataFrame:
    """(a, b): forests of the links between distinct fingerprints at most ``bits`` apart
    (0 to 3); together they join exactly what all links join."""
    if not 0 <= bits <= 3:
        raise ValueError("the grid is built for bit distances of 0 to 3")
    cells = _cells(fps)
    shared = (cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("home").alias("h"))
              .where("n > 1 and h = 1").select("cell", F.ceil(F.col("n") / F.lit(chunk)).cast("int").alias("k")))
    # Spark takes the size of cells from the fingerprints, before the explode gives 34 rows for each:
    # without the hint it may broadcast them
    met = cells.join(shared.hint("merge"), "cell").withColumn("own", F.pmod(F.xxhash64("fp"), "k").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("k") - 1))
    blocks = (met.select("cell", "fp", "own", other.alias("j"))
              .select("cell", F.least("own", "j").alias("i"), F.greatest("own", "j").alias("j"), "fp"))
    return (blocks.repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j")
            .mapInArrow(_link_blocks(bits), "a long, b long"))


def near_duplicates(docs: DataFrame, shingle: int = 3, bits: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs`` (doc_id, text).

    component_id: the smallest doc_id that links reach, itself included. Null or empty
    texts have fingerprint 0 and link like any other. A row with null doc_id keeps its
    fingerprint, has no component_id and names no component. Repeated rows each get a
    row. An empty table gives an empty result. Other columns are not read.
    """
    prints = checkpointed(fingerprints(docs, shingle))
    classes = prints.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("least"))
    stars = components(links(classes.select("fp"), bits))
    rooted = (classes.join(stars.withColumnRenamed("node", "fp"), "fp", "left")
              .select("fp", "least", F.coalesce("root", "fp").alias("root")))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    return (prints.join(named, "fp", "left")
            .select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")))
