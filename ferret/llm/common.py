"""Helpers shared by the operators: tables, checkpoints, size-checked broadcasts, Arrow batches."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferret.session import ensure_checkpoint_dir

#: Text bytes handled at once inside a task; one longer document is handled alone.
SLICE_BYTES = 2 << 20
#: A key table is broadcast only below this many bytes (its rows are counted first).
BROADCAST_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a checkpoint in the shared folder of the session."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """The table written as Parquet into the shared checkpoint folder and read back."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def bounded(df: DataFrame, row_bytes: int = 24) -> DataFrame:
    """Mark a checkpointed table for broadcast if its counted rows fit BROADCAST_BYTES;
    otherwise return it unmarked and the join shuffles."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    n, at = len(column), column.offset
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, np.int64)[at:at + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offs[0]:offs[-1]], offs - offs[0]


def slices(batches, text_at: int, most: int = SLICE_BYTES):
    """Arrow batches cut so that each holds at most ``most`` text bytes (or one row)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.asarray(pa.compute.binary_length(batch.column(text_at)).fill_null(0)).astype(np.int64)
        total, start = np.cumsum(size), 0
        while start < batch.num_rows:
            before = total[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(total, before + most, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def longs(a: np.ndarray) -> pa.Array:
    """Unsigned 64-bit values as the signed longs Spark holds."""
    return pa.array(np.ascontiguousarray(a).view(np.int64) if a.dtype == np.uint64 else a.astype(np.int64))


def bit_filter(keys: DataFrame, col: str) -> np.ndarray:
    """A Bloom filter of 64-bit hashes: 16 bits a key, two probes, 2^16 to 2^28 bits
    (32 MB at most, whatever the table). It only drops keys that are surely absent;
    callers join exactly afterwards. The words are built by a grouped bit_or."""
    n = keys.count()
    bits = 1 << min(28, max(16, int(16 * n).bit_length()))
    h = F.col(col)
    at = F.explode(F.array(h.bitwiseAND(F.lit(bits - 1)),
                           F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(bits - 1))))
    words = (keys.select(at.alias("p"))
             .groupBy(F.shiftright("p", 6).alias("w"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("m")).toPandas())
    out = np.zeros(bits >> 6, np.uint64)
    out[words["w"].to_numpy(np.int64)] = words["m"].to_numpy(np.int64).view(np.uint64)
    return out


def passes(words: np.ndarray, h: np.ndarray) -> np.ndarray:
    mask = np.uint64(len(words) * 64 - 1)
    one, six, low = np.uint64(1), np.uint64(6), np.uint64(63)
    a, b = h & mask, (h >> np.uint64(32)) & mask
    return ((words[a >> six] >> (a & low)) & (words[b >> six] >> (b & low)) & one).astype(bool)


def held_out(doc_id, modulus: int, remainder: int):
    """crc32 of the id as text leaves ``remainder``; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % modulus == remainder, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, unseen) -> DataFrame:
    """(doc_id, text, y): at most ``rows`` labelled documents to learn from, the first in
    hash order of their ids. ``unseen``: function of the id column that marks rows kept
    out. A doc_id with several labels counts with its largest."""
    doc_id = F.col("doc_id").cast("long")
    train = (labels.select(doc_id.alias("doc_id"), F.col(label).cast("int").alias("y")).where("doc_id is not null and y in (0, 1)")
             .where(~unseen(F.col("doc_id"))).groupBy("doc_id").agg(F.max("y").alias("y"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))  # at most 16 bytes a row
    return (docs.select(doc_id.alias("doc_id"), F.col("text").cast("string").alias("text"))
            .join(F.broadcast(train), "doc_id"))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))
