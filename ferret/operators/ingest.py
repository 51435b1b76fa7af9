"""Document ingest: classify source files, convert them to text, name the outputs,
report a status per file and in total.

Nothing is deleted: where the reference removes a converted source, we return a
removal manifest (the paths a caller may remove once the text table is safely
written).

Input frame: one row per source file with a name (base name or path) and either
a binary ``content`` column (``binaryFile`` source) or a string column already
holding the text. Plain copies stay native (decode, newline normalisation);
only rows whose extension has a registered codec cross into Python.
"""

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferret.functions.text import WS_RUN, ext_label, file_ext, file_head

# Fixed values (must equal the original tool's results).
# Extra types copied as plain text, in their original order.
DEFAULT_TYPES = (
    ".css", ".sass", ".html", ".htm", ".js", ".jsm", ".mjs", ".json",
    ".markdown", ".md", ".mkd", ".org",
    ".v", ".asc", ".log", ".conf",
    ".doc",
    ".py", ".py3", ".pyi", ".pyx", ".py3x", ".wsgi",
    ".rs", ".vbs", ".lua", ".p", ".pas", ".kt", ".java",
    ".c", ".C", ".cs", ".c++", ".cc", ".cpp", ".cxx",
    ".lisp", ".go", ".hs",
)
# Extensions with their own converter, and the handler name used for each.
CODEC_HANDLERS = {".docx": "docx", ".pdf": "pdf"}
# Status messages: {name} source name, {ext} its extension, {cause} why it failed.
MSG_SUCCESS = "## Successfully converted {name}"
MSG_FAIL = "{cause}\n|| Failed to convert {name}"
MSG_UNSURE = "@@ ({ext}) is an unsupported file format\n|| Tried to convert {name}"
MSG_SKIP = "%% Skipped {name}"
# Output names: the first, then numbered.
OUT_NAME = "{head} ({label}).txt"
OUT_NAME_N = "{head} ({label}) ({n}).txt"

# Our own causes of a failed conversion (codec registry).
CAUSE_NO_CODEC = "XX No converter for {ext} is available"
CAUSE_ERROR = "XX {error}"

STATUSES = ("success", "fail", "unsure", "skip")


def fill(template: str, **cols) -> F.Column:
    """A message template as a column: literal parts and columns concatenated."""
    parts = re.split(r"\{(\w+)\}", template)
    pieces = [F.lit(p) if i % 2 == 0 else cols[p].cast("string") for i, p in enumerate(parts)]
    return F.concat(*[p for i, p in enumerate(pieces) if i % 2 == 1 or parts[i] != ""])


def types_from_text(df: DataFrame) -> DataFrame:
    """The same parse as a Spark job over a text source (``value`` column): one row per type."""
    body = df.filter(~F.col("value").startswith("#") & (F.col("value") != ""))
    return body.select(F.explode(F.split("value", WS_RUN)).alias("ext")).filter(F.col("ext") != "")


def classify(files: DataFrame, name_col: str = "name", types=DEFAULT_TYPES,
             type_match: str = "member") -> DataFrame:
    """Adds ext, head, label and handler ('docx', 'pdf', 'plain', 'skip').

    ``type_match='member'`` tests the extension against the list (what the docs
    state); ``'substring'`` tests it against the list's text form, as the
    reference's converter does, so '' and partial extensions like '.j' pass too.
    """
    types = tuple(types)
    ext = file_ext(F.col(name_col))
    out = files.withColumn("ext", ext).withColumn("head", file_head(F.col(name_col)))
    out = out.withColumn("label", ext_label(F.col("ext")))
    if type_match == "member":
        extra = F.col("ext").isin(list(types)) if types else F.lit(False)
    elif type_match == "substring":
        extra = F.instr(F.lit(str(types)), F.col("ext")) > 0
    else:
        raise ValueError("type_match must be 'member' or 'substring'")
    handler = F.when(extra, "plain").otherwise("skip")
    for e, name in reversed(list(CODEC_HANDLERS.items())):
        handler = F.when(F.col("ext") == e, name).otherwise(handler)
    return out.withColumn("handler", handler)


def normalize_newlines(col) -> F.Column:
    return F.regexp_replace(col, r"\r\n|\r", "\n")


CODEC_RESULT = T.StructType([T.StructField("text", T.StringType()),
                             T.StructField("error", T.StringType())])


def _codec_udf(codecs: dict[str, Callable[[bytes], str]]):
    @F.pandas_udf(CODEC_RESULT)
    def run(exts: pd.Series, blobs: pd.Series) -> pd.DataFrame:
        texts, errors = [], []
        for ext, blob in zip(exts.tolist(), blobs.tolist()):
            if blob is None:
                texts.append(None)
                errors.append(None)
                continue
            try:
                texts.append(codecs[ext](bytes(blob)))
                errors.append(None)
            except Exception as e:  # one bad document must not stop the job
                texts.append(None)
                errors.append(f"{type(e).__name__}: {e}")
        return pd.DataFrame({"text": texts, "error": errors})

    return run


def convert(classified: DataFrame, name_col: str = "name", content_col: str = "content",
            text_input: bool = False, codecs: dict | None = None) -> DataFrame:
    """Adds status, text, message. One pass over the input.

    * plain: UTF-8 decode with replacement of bad bytes, newlines made '\\n'; 'unsure'
    * docx/pdf: the registered codec; 'success', or 'fail' with the cause first
    * anything else: 'skip'
    """
    codecs = dict(codecs or {})
    h = F.col("handler")
    raw = F.col(content_col)
    decoded = raw if text_input else F.make_valid_utf8(raw.cast("string"))
    plain_text = normalize_newlines(decoded)
    is_codec = h.isin(*CODEC_HANDLERS.values())
    has_codec = F.col("ext").isin(list(codecs)) if codecs else F.lit(False)
    df = classified
    if codecs:
        blob = F.encode(raw, "UTF-8") if text_input else raw
        df = df.withColumn("_c", _codec_udf(codecs)(F.col("ext"), F.when(is_codec & has_codec, blob)))
        codec_text, codec_err = F.col("_c.text"), F.col("_c.error")
    else:
        codec_text, codec_err = F.lit(None).cast("string"), F.lit(None).cast("string")
    status = (F.when(h == "plain", "unsure")
              .when(is_codec & has_codec & codec_err.isNull(), "success")
              .when(is_codec, "fail")
              .otherwise("skip"))
    text = (F.when(h == "plain", plain_text)
            .when(is_codec & has_codec & codec_err.isNull(), normalize_newlines(codec_text)))
    ext, name = F.col("ext"), F.col(name_col)
    cause = F.when(has_codec, fill(CAUSE_ERROR, error=codec_err)).otherwise(fill(CAUSE_NO_CODEC, ext=ext))
    st = F.col("status")
    message = (F.when(st == "success", fill(MSG_SUCCESS, name=name))
               .when(st == "fail", fill(MSG_FAIL, cause=cause, name=name))
               .when(st == "unsure", fill(MSG_UNSURE, ext=ext, name=name))
               .otherwise(fill(MSG_SKIP, name=name)))
    out = df.withColumn("status", status).withColumn("text", text).withColumn("message", message)
    return out.drop("_c")


def name_stem() -> F.Column:
    """A source's plain output name without '.txt'."""
    return F.concat(F.col("head"), F.lit(" ("), F.col("label"), F.lit(")"))


def name_family(stem) -> F.Column:
    """An output name without '.txt' and without trailing numbers: names can only meet
    within one family, since a numbered name adds a number to a plain one."""
    return F.regexp_replace(stem, r"( \([0-9]+\))+$", "")


def _assign_names(sources: pd.DataFrame, taken: pd.DataFrame) -> pd.DataFrame:
    used, out = set(taken["out_name"]), []
    for row in sources.sort_values("name", kind="stable").itertuples():
        fields = {"head": row.head, "label": row.label}
        name, n = OUT_NAME.format(**fields), 0
        while name in used:
            n += 1
            name = OUT_NAME_N.format(n=n, **fields)
        used.add(name)
        out.append((row.name, name))
    return pd.DataFrame(out, columns=["_name", "out_name"])


def output_names(converted: DataFrame, name_col: str = "name", existing: DataFrame | None = None) -> DataFrame:
    """(_name, out_name) of the rows that write output (status success/unsure).

    ``head (LABEL).txt``, then ``head (LABEL) (1).txt``, ...: in name order each source takes
    the first name that neither ``existing`` (column ``out_name``: names in the target) nor an
    earlier source holds. Only names are read and shuffled. A group is a family of names, the
    spellings of one head in one folder, so it stays small. ``name_col`` names a source once.
    """
    stem = name_stem()
    family = Window.partitionBy("_family")
    sources = (converted.filter(F.col("status").isin("success", "unsure"))
               .select(F.col(name_col).alias("name"), "head", "label", stem.alias("_stem"), name_family(stem).alias("_family"))
               .withColumn("_rank", F.row_number().over(family.orderBy("name")) - 1)
               .withColumn("_mixed", (F.min("_stem").over(family) != F.max("_stem").over(family)).cast("int")))
    spark = converted.sparkSession
    taken = (spark.createDataFrame([], "out_name string") if existing is None else existing.select("out_name"))
    taken = taken.withColumn("_family", name_family(F.regexp_replace("out_name", r"\.txt$", "")))
    if existing is not None:
        sources = sources.join(taken.select("_family", F.lit(1).alias("_held")).distinct(), "_family", "left")
        sources = sources.withColumn("_mixed", F.greatest("_mixed", F.coalesce("_held", F.lit(0)))).drop("_held")
    # one spelling and a free family: the k-th source takes the k-th name; the others one by one
    head, label, n = F.col("head"), F.col("label"), F.col("_rank")
    plain = F.when(n == 0, fill(OUT_NAME, head=head, label=label)).otherwise(fill(OUT_NAME_N, head=head, label=label, n=n))
    alone = sources.filter("_mixed = 0").select(F.col("name").alias("_name"), plain.alias("out_name"))
    mixed = sources.filter("_mixed = 1").select("name", "head", "label", "_family")
    return alone.unionByName(mixed.groupBy("_family").cogroup(taken.groupBy("_family")).applyInPandas(
        _assign_names, "_name string, out_name string"))


def name_outputs(converted: DataFrame, name_col: str = "name", existing: DataFrame | None = None) -> DataFrame:
    """Adds out_name (see ``output_names``) to rows that write output, else null. Search
    before naming where only hits matter: the join then carries no whole texts."""
    names = output_names(converted, name_col, existing)
    return converted.join(names, F.col(name_col) == F.col("_name"), "left").drop("_name")


def _sources(converted: DataFrame) -> DataFrame:
    """One row for each source: the first chunk stands for a text in several."""
    return converted.filter(F.col("chunk_no") == 0) if "chunk_no" in converted.columns else converted


def report(converted: DataFrame) -> DataFrame:
    """One row: success, fail, unsure, skip (zeros included)."""
    return _sources(converted).agg(*[F.count_if(F.col("status") == s).cast("bigint").alias(s) for s in STATUSES])


def report_verbose(converted: DataFrame) -> DataFrame:
    """Only the statuses that occur: (status, files)."""
    return _sources(converted).groupBy("status").agg(F.count(F.lit(1)).alias("files"))


def removal_manifest(converted: DataFrame, name_col: str = "name") -> DataFrame:
    """Sources the reference would delete (converted or copied); we only list them."""
    written = _sources(converted).filter(F.col("status").isin("success", "unsure"))
    return written.select(name_col, *[c for c in ("out_name",) if c in converted.columns])


def inventory(files: DataFrame, name_col: str = "name", types=DEFAULT_TYPES,
              is_dir_col: str | None = None) -> DataFrame:
    """Listing with a type class per entry and its listing rank (case-insensitive name order).

    Classes: text (.txt), docx, pdf, extra (in the type list), directory, other.
    """
    ext = file_ext(F.col(name_col))
    is_dir = F.col(is_dir_col) if is_dir_col else F.lit(False)
    klass = F.when(ext == ".txt", "text")
    for e, name in CODEC_HANDLERS.items():
        klass = klass.when(ext == e, name)
    klass = (klass.when(ext.isin(list(types)), "extra").when(is_dir, "directory").otherwise("other"))
    listing = files.select(F.col(name_col), klass.alias("type_class"))
    return with_rank(listing, [F.lower(F.col(name_col)), F.col(name_col)])


def with_rank(df: DataFrame, order_cols, rank_col: str = "rank") -> DataFrame:
    """Global 1-based rank without a single-partition window.

    Range-partitioned sort; within a sorted partition the generated id counts rows,
    so rank = rows in earlier partitions + position. The per-partition counts are
    one row per partition (a bound set by configuration), joined by broadcast. The
    sorted, numbered rows are checkpointed so both uses see one partitioning.
    """
    from ferret.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    numbered = (df.orderBy(*order_cols)
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_mid", F.monotonically_increasing_id())
                .checkpoint(eager=True))
    sizes = numbered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    offsets = sizes.select("_pid", "_first", (F.sum("_n").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))).alias("_before"))
    return (numbered.join(F.broadcast(offsets), "_pid")
            .withColumn(rank_col, (F.coalesce(F.col("_before"), F.lit(0)) + F.col("_mid") - F.col("_first") + 1)
                        .cast("bigint"))
            .drop("_pid", "_mid", "_first", "_before"))


# A binaryFile row holds the whole file: a codec cannot be given more than this.
MAX_FILE_BYTES = (1 << 31) - 1
CAUSE_TOO_LARGE = "XX The file has {length} bytes, more than one row can hold"


def ingest_files(spark, path: str, codecs: dict | None = None, types=DEFAULT_TYPES,
                 type_match: str = "member", existing: DataFrame | None = None,
                 max_file_bytes: int = MAX_FILE_BYTES, chunk_bytes: int | None = None) -> DataFrame:
    """Convert every file directly in ``path``: path, name, ext, handler, status, message, out_name,
    chunk_no, first_line, text.

    Hidden names and empty files count like others. Plain copies decode natively; codec
    rows go through the registry in Arrow batches, and a failing codec marks its row
    'fail'. A plain file of over ``chunk_bytes`` (64 MB, or ``max_file_bytes`` if that is
    less) has a row for each of its chunks of whole lines (see ``read_chunks``), so no
    size is left out; all others have one row with chunk_no 0. A file of over
    ``max_file_bytes`` for a codec, which needs the whole, is a 'fail' that names its size.
    """
    from ferret.sources.files import CHUNK_BYTES, read_binary, read_chunks

    whole = min(max_file_bytes, CHUNK_BYTES if chunk_bytes is None else chunk_bytes)
    spare = [c for c in codecs or {} if c in CODEC_HANDLERS]
    listing = classify(read_binary(spark, path, with_content=False), "name", types, type_match)
    limit = F.when(F.col("handler") == "plain", F.lit(whole)).otherwise(F.lit(max_file_bytes))
    big = listing.filter((F.col("length") > limit) & (F.col("handler") != "skip"))
    # bodies of what no handler takes are not read
    bodies = classify(read_binary(spark, path, most=max_file_bytes), "name", types, type_match)
    taken = (F.col("handler") == "plain") & (F.col("length") <= F.lit(whole))
    taken = taken | (F.col("ext").isin(spare) & (F.col("handler") != "plain")) if spare else taken
    small = (bodies.withColumn("content", F.when(taken, F.col("content")))
             .filter(~((F.col("handler") == "plain") & (F.col("length") > F.lit(whole)))))
    left = listing.filter((F.col("handler") == "skip") & (F.col("length") > F.lit(max_file_bytes))).withColumn("content", F.lit(None).cast("binary"))
    cols = ["path", "name", "ext", "head", "label", "handler", "status", "message", "text"]
    conv = convert(small.unionByName(left.select(small.columns)), "name", "content", text_input=False, codecs=codecs).select(cols)
    big = (big.withColumn("status", F.when(F.col("handler") == "plain", "unsure").otherwise("fail"))
           .withColumn("text", F.lit(None).cast("string"))
           .withColumn("message", F.when(F.col("status") == "unsure", fill(MSG_UNSURE, ext=F.col("ext"), name=F.col("name")))
                       .otherwise(fill(MSG_FAIL, cause=fill(CAUSE_TOO_LARGE, length=F.col("length")), name=F.col("name")))))
    named = name_outputs(conv.unionByName(big.select(cols)), "name", existing)
    out = ["path", "name", "ext", "handler", "status", "message", "out_name", "chunk_no", "first_line", "text"]
    one = named.withColumn("chunk_no", F.lit(0).cast("long")).withColumn("first_line", F.lit(1).cast("long"))
    long_ = (F.col("handler") == "plain") & F.col("text").isNull()
    if big.filter("handler = 'plain'").isEmpty():
        return one.select(out)
    chunks = read_chunks(spark, path, over=whole, chunk_bytes=whole)
    return one.filter(~long_).select(out).unionByName(named.filter(long_).drop("text").join(chunks, "path").select(out))


def write_texts(converted: DataFrame, out_path: str, mode: str = "errorifexists") -> None:
    """Sink: the converted texts as a Parquet table (out_name, chunk_no, first_line, text), whose
    lines ``sources.files.text_lines`` gives. Without chunks: (out_name, text)."""
    more = [c for c in ("chunk_no", "first_line") if c in converted.columns]
    (converted.filter(F.col("status").isin("success", "unsure"))
     .select("out_name", *more, "text").write.mode(mode).parquet(out_path))


def convert_plain_lines(spark, path: str, types=DEFAULT_TYPES, type_match: str = "member",
                        existing: DataFrame | None = None, mode: str = "PERMISSIVE") -> DataFrame:
    """Plain copies as numbered lines: out_name, line_no, line (no per-file size limit).

    The same conversion as the plain handler, but read through the split-safe line
    reader instead of one row per file, so a file of any size converts and the
    result is searchable without splitting texts again. Output names come from the
    content-free listing, joined on the path as it is on disk.
    """
    from ferret.sources.files import read_binary, read_lines

    listing = classify(read_binary(spark, path, with_content=False), "name", types, type_match)
    plain = (listing.filter(F.col("handler") == "plain")
             .withColumn("status", F.lit("unsure")))
    names = name_outputs(plain, "name", existing).select("path", "out_name")
    if type_match == "member" and types:
        glob = "*{" + ",".join(sorted(set(types))) + "}"
    else:
        glob = "*"  # substring matching admits names a glob cannot say; the join selects
    lines = read_lines(spark, path, glob=glob, mode=mode)
    return lines.join(names, "path").select("out_name", "line_no", "line")
