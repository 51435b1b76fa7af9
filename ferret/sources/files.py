"""File sources: a directory of ``.txt`` files as numbered lines, and a directory of
source documents as binary rows for ingest.

Line numbers for splittable text files
--------------------------------------
A file no larger than one split is read whole (one row) and split into lines in
one pass. A larger file is read by many tasks (one per split), so a task cannot
know how many lines precede its split. Each line gets ``monotonically_increasing_id()``
right at the scan (consecutive inside a task), and the scanned lines are written
once to the shared checkpoint folder. The first id and the line count of each
(file, split) come from those same lines, so the ids cannot disagree, whatever the
cluster's size is when the result is read; a running sum over the splits of a
file gives the lines before each split, and
``line_no = id - first_id + lines_before + 1``.

File names are given as they are on disk (``_metadata`` columns hold them URL-encoded).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ferret.functions.text import lines_of
from ferret.session import ensure_checkpoint_dir
from ferret.sources.listing import file_pieces, glob_regex, list_folder

MODES = ("PERMISSIVE", "DROPMALFORMED", "FAILFAST")


def plain_path(col) -> Column:
    """A path or name of ``_metadata`` as it is on disk: URL escapes decoded (a plus sign
    is no blank here), ``file:///`` written as Hadoop prints it (``file:/``)."""
    c = F.col(col) if isinstance(col, str) else col
    c = F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(c, "^([A-Za-z][A-Za-z0-9+.-]*):///", "$1:/")


def _file() -> list[Column]:
    return [plain_path("_metadata.file_name").alias("file"), plain_path("_metadata.file_path").alias("path")]


def _utf8(col, mode: str):
    return F.validate_utf8(col) if mode == "FAILFAST" else F.make_valid_utf8(col)


def read_lines(spark: SparkSession, path: str, glob: str = "*.txt", mode: str = "PERMISSIVE",
               whole_file_bytes: int | None = None) -> DataFrame:
    """Numbered lines of every file matching ``glob`` directly in ``path``.

    Columns: file (base name), path, line_no (1-based), line. Names that begin with a dot
    or an underscore count like others.
    ``mode`` for bad UTF-8: PERMISSIVE replaces bad bytes with U+FFFD,
    DROPMALFORMED drops every file with a bad line, FAILFAST raises.

    Files up to ``whole_file_bytes`` (default: the split size,
    ``spark.sql.files.maxPartitionBytes``) are read whole, one row each, and split
    into lines in one pass. Larger files keep their splits and get the two-pass
    numbering. The size test prunes files before any byte is read.
    """
    mode = mode.upper()
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    seen = _seen_lines(spark, lambda r: r.option("pathGlobFilter", glob).load(path), mode, whole_file_bytes)
    return seen.unionByName(_hidden_lines(spark, path, glob, mode))


def read_file_lines(spark: SparkSession, paths: list, mode: str = "PERMISSIVE", whole_file_bytes: int | None = None) -> DataFrame:
    """The same for the named files (not folders), names as on disk."""
    plain = [re.sub(r"([\\\[\]{}*?])", r"\\\1", p) for p in paths]  # a path is a glob to the reader
    return _seen_lines(spark, lambda r: r.load(plain), mode.upper(), whole_file_bytes)


def _seen_lines(spark: SparkSession, load, mode: str, whole_file_bytes: int | None) -> DataFrame:
    if whole_file_bytes is None:
        whole_file_bytes = _bytes(spark.conf.get("spark.sql.files.maxPartitionBytes", "128m"))
    size = F.col("_metadata.file_size")
    small = (load(spark.read.format("text").option("wholetext", "true"))
             .filter(size <= F.lit(whole_file_bytes))
             .select(*_file(), F.col("value").alias("_raw")))
    if mode == "DROPMALFORMED":
        small = small.filter(F.is_valid_utf8("_raw"))
    # UTF-8 is checked on the raw bytes first (a regex would silently repair them);
    # then a leading byte-order mark is dropped, as the line reader does.
    text = F.regexp_replace(_utf8(F.col("_raw"), mode), "^\uFEFF", "")
    small_lines = lines_of(small.select("file", "path", text.alias("text")), ["file", "path"], "text")
    # recursiveFileLookup stays off: one directory level, like the searcher.
    large_lines = _split_lines(spark, load(spark.read.format("text")).filter(size > F.lit(whole_file_bytes)), mode)
    return small_lines.unionByName(large_lines)


def _hidden_lines(spark: SparkSession, path: str, glob: str, mode: str) -> DataFrame:
    """The lines of files whose names Spark's readers skip."""
    hidden = _listed(spark, path, glob).where("hidden and length > 0")
    ensure_checkpoint_dir(spark)
    raw = file_pieces(hidden, CHUNK_BYTES)
    if mode == "DROPMALFORMED":
        raw = raw.checkpoint(eager=True)
        bad = raw.where(~F.is_valid_utf8(F.col("content").cast("string"))).select("path").distinct()
        raw = raw.join(bad, "path", "left_anti")
    text = _breaks(F.validate_utf8(F.col("content").cast("string")) if mode == "FAILFAST" else F.col("content").cast("string"))
    text = F.when(F.col("start") == 0, F.regexp_replace(text, "^\uFEFF", "")).otherwise(text)
    chunks = _numbered(raw.select("path", F.col("start").alias("_p"), F.lit(0).alias("_q"), text.alias("text")))
    named = chunks.withColumn("file", F.regexp_extract("path", r"([^/]*)$", 1))
    return text_lines(named, ["file", "path"])


def _bytes(v: str) -> int:
    v = str(v).strip().lower()
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}
    v = v[:-1] if v.endswith("b") else v
    return int(float(v[:-1]) * units[v[-1]]) if v and v[-1] in units else int(v)


def _split_lines(spark: SparkSession, scan: DataFrame, mode: str) -> DataFrame:
    """Two-pass numbering of lines read split by split (see the module notes)."""
    ensure_checkpoint_dir(spark)
    base = scan.select(
        *_file(),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_mid"),
        F.col("value")).checkpoint(eager=True)
    splits = (base.groupBy("path", "_block")
              .agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n"),
                   F.min(F.is_valid_utf8("value").cast("int")).alias("_valid"))
              .withColumn("_before", F.coalesce(F.sum("_n").over(
                  Window.partitionBy("path").orderBy("_block")
                  .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .withColumn("_file_valid", F.min("_valid").over(Window.partitionBy("path")))
              .select("path", "_block", "_first", "_before", "_file_valid"))
    lines = base.join(splits, ["path", "_block"])
    if mode == "DROPMALFORMED":
        lines = lines.filter(F.col("_file_valid") == 1)
    return lines.select("file", "path",
                        (F.col("_mid") - F.col("_first") + F.col("_before") + 1).cast("bigint").alias("line_no"),
                        _utf8(F.col("value"), mode).alias("line"))


def read_texts(spark: SparkSession, path: str, glob: str = "*.txt") -> DataFrame:
    """One row per file with its whole text (file, path, text): for many small files,
    and for streams. A file must fit in one row (2 GB)."""
    df = spark.read.format("text").option("pathGlobFilter", glob).option("wholetext", "true").load(path)
    return df.select(*_file(), F.make_valid_utf8("value").alias("text"))


def read_binary(spark: SparkSession, path: str, glob: str | None = None, with_content: bool = True,
                most: int = (1 << 31) - 1) -> DataFrame:
    """Source documents: path, name, length, modificationTime (and content).

    Without ``content`` no file body is read: the rows are the folder's listing. With it,
    ``binaryFile`` reads what Spark's readers see (files over ``most`` bytes are left out
    before they are read); hidden names come from the listing's own reader, zero-byte
    files from the listing alone.
    """
    cols = ["path", "name", "length", "modificationTime"]
    listed = _listed(spark, path, glob)
    if not with_content:
        return listed.select(cols)
    r = spark.read.format("binaryFile")
    if glob:
        r = r.option("pathGlobFilter", glob)
    seen = (r.load(path).filter((F.col("length") > 0) & (F.col("length") <= F.lit(most)))
            .withColumn("path", plain_path("_metadata.file_path"))
            .withColumn("name", F.regexp_extract("path", r"([^/]*)$", 1)).select(*cols, "content"))
    rest = listed.where("length = 0 or hidden").where(F.col("length") <= F.lit(most))
    content = file_pieces(rest, most).select("path", "content")
    return seen.unionByName(rest.select(cols).join(content, "path"))


def _listed(spark: SparkSession, path: str, glob: str | None) -> DataFrame:
    """The files, not the directories, directly in ``path``."""
    listed = list_folder(spark, path).where("not is_dir")
    return listed.where(F.col("name").rlike(glob_regex(glob))) if glob else listed


#: Text of one chunk of a long file.
CHUNK_BYTES = 64 << 20


def read_chunks(spark: SparkSession, path: str, glob: str = "*", over: int = 0, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """path, chunk_no, first_line, text: the files of over ``over`` bytes directly in ``path``, as
    chunks of whole lines near ``chunk_bytes`` long, numbered from 0, whatever the size of
    a file. The chunks of a file together are its text with line breaks made ``\\n``;
    ``first_line`` numbers a chunk's first line in the file. One line must fit a row.

    Splits are read in parallel, cut at ``\\n`` and joined again chunk by chunk inside each
    split. What a line reader hides, a final line break and a byte-order mark, follows from
    the bytes that a file has beyond those of its lines.
    """
    ensure_checkpoint_dir(spark)
    scan = (spark.read.format("text").option("lineSep", "\n").option("pathGlobFilter", glob).load(path)
            .filter(F.col("_metadata.file_size") > F.lit(over)))
    rows = scan.select(plain_path("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_b"),
                       F.col("_metadata.file_size").alias("_size"), F.monotonically_increasing_id().alias("_mid"), "value",
                       (F.octet_length("value") + 1).cast("long").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("path", "_b").orderBy("_mid").rowsBetween(Window.unboundedPreceding, -1))
    lines = rows.withColumn("_c", F.floor(F.coalesce(before, F.lit(0)) / F.lit(chunk_bytes)))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_mid", "value"))), lambda x: x["value"]), "\n")
    chunks = (lines.groupBy("path", "_b", "_c").agg(body.alias("_body"), F.sum("_n").alias("_n"), F.max("_size").alias("_size"))
              .checkpoint(eager=True))
    # bytes of a file beyond its lines: 3 of a byte-order mark, one less without a final line break
    ends = (chunks.groupBy("path").agg((F.max("_size") - F.sum("_n")).alias("_d"), F.min(F.struct("_b", "_c")).alias("_first"),
                                       F.max(F.struct("_b", "_c")).alias("_last")))
    place = F.struct("_b", "_c")
    text = F.concat(F.when((place == F.col("_first")) & (F.col("_d") >= 2), F.lit("\ufeff")).otherwise(""), F.col("_body"),
                    F.when((place == F.col("_last")) & F.col("_d").isin(-1, 2), F.lit("")).otherwise("\n"))
    seen = chunks.join(ends, "path").select("path", F.col("_b").alias("_p"), F.col("_c").alias("_q"), _breaks(text).alias("text"))
    hidden = _listed(spark, path, glob).where("hidden").where(F.col("length") > F.lit(over))
    pieces = file_pieces(hidden, chunk_bytes).select("path", F.col("start").alias("_p"), F.lit(0).cast("long").alias("_q"),
                                                     _breaks(F.col("content").cast("string")).alias("text"))
    return _numbered(seen.unionByName(pieces))


def _breaks(text) -> Column:
    return F.regexp_replace(F.make_valid_utf8(text), r"\r\n|\r", "\n")


def _numbered(pieces: DataFrame) -> DataFrame:
    """chunk_no and first_line of pieces (path, _p, _q, text) in the order of _p, _q."""
    pieces = pieces.withColumn("_k", F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))).checkpoint(eager=True)
    file = Window.partitionBy("path").orderBy("_p", "_q")
    before = F.sum("_k").over(file.rowsBetween(Window.unboundedPreceding, -1))
    numbers = pieces.select("path", "_p", "_q", (F.row_number().over(file) - 1).cast("long").alias("chunk_no"),
                            (F.coalesce(before, F.lit(0)) + 1).cast("long").alias("first_line"))
    return (pieces.select("path", "_p", "_q", "text").join(numbers, ["path", "_p", "_q"])
            .select("path", "chunk_no", "first_line", "text"))


def text_lines(texts: DataFrame, key_cols, text_col: str = "text") -> DataFrame:
    """Numbered lines of a table of texts; where a text is one chunk of several (column
    ``first_line``), its lines are numbered as those of the whole text."""
    if "first_line" not in texts.columns:
        return lines_of(texts, key_cols, text_col)
    lines = lines_of(texts, key_cols, text_col, keep_cols=["first_line"])
    return lines.select(*key_cols, (F.col("line_no") + F.col("first_line") - 1).alias("line_no"), "line")


def read_type_list(spark: SparkSession, path: str) -> DataFrame:
    """Extra-type list file: '#' comment lines, types separated by blanks. One row per type."""
    from ferret.operators.ingest import types_from_text
    return types_from_text(spark.read.text(path))
