"""Command line: the interactive search/convert prompt re-aimed as batch jobs.

    python -m ferret search --dir CORPUS --query license [--query ...] [--fuzzy --cutoff 0.85] --out HITS
    python -m ferret search --table docs.parquet --key doc_id --text text --queries-file q.txt --out HITS
    python -m ferret convert --src INBOX --out CONVERTED [--types-file T] [--substring-types] [--verbose] [--lines]

Hits and conversions are written as Parquet to ``--out``; only small summaries (one
row per query, the four status counts) come back to the driver for printing. A
converted table is searchable as is: ``search --table CONVERTED --key out_name``.
"""

from __future__ import annotations

import argparse
import importlib
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


# Queries whose totals are printed; the table OUT_totals has all of them.
PRINTED = 20


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="ferret")
    sub = p.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("search", help="search a folder of .txt files or a Parquet text table")
    src = s.add_mutually_exclusive_group(required=True)
    src.add_argument("--dir", help="folder of .txt files (one level)")
    src.add_argument("--table", help="Parquet table with a key and a text column")
    s.add_argument("--key", action="append", help="key column(s) of --table")
    s.add_argument("--text", default="text", help="text column of --table")
    s.add_argument("--query", action="append", default=[], help="query (repeatable)")
    s.add_argument("--queries-file", help="file with one query per line")
    s.add_argument("--fuzzy", action="store_true", help="fuzzy word search instead of exact")
    s.add_argument("--cutoff", type=float, default=0.85)
    s.add_argument("--mode", default="PERMISSIVE", help="bad UTF-8 in --dir: PERMISSIVE, DROPMALFORMED, FAILFAST")
    s.add_argument("--out", required=True, help="output folder (Parquet)")
    c = sub.add_parser("convert", help="convert a folder of documents to a Parquet text table")
    c.add_argument("--src", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--append", action="store_true", help="add to a table that exists; its names are kept clear of")
    c.add_argument("--codec", action="append", default=[], help=".ext=module:function, bytes to text (repeatable)")
    c.add_argument("--types-file", help="extra-type list file")
    c.add_argument("--substring-types", action="store_true", help="match extensions as substrings of the list")
    c.add_argument("--verbose", action="store_true", help="print only the non-zero counts, one per line")
    c.add_argument("--lines", action="store_true",
                   help="also write plain copies as numbered lines to OUT_lines (any file size)")
    return p


def _queries(spark: SparkSession, args):
    rows = [(i, q) for i, q in enumerate(args.query)]
    df = spark.createDataFrame(rows, "query_id long, query string") if rows else None
    if args.queries_file:
        fq = (spark.read.text(args.queries_file).filter(F.col("value") != "")
              .select((F.monotonically_increasing_id() + len(rows)).alias("query_id"), F.col("value").alias("query")))
        df = fq if df is None else df.unionByName(fq)
    if df is None:
        raise SystemExit("give --query or --queries-file")
    return df


def run_search(spark: SparkSession, args) -> list:
    from ferret.operators import multi
    from ferret.operators.fuzzy import fuzzy_search
    from ferret.sources.files import read_lines, text_lines

    if args.dir:
        lines, keys = read_lines(spark, args.dir, mode=args.mode), ["file"]
    else:
        keys = args.key or ["doc_id"]
        table = spark.read.parquet(args.table)
        chunked = [c for c in ("first_line",) if c in table.columns]
        lines = text_lines(table.select(*keys, *chunked, args.text), keys, args.text)
    queries = _queries(spark, args)
    if args.fuzzy and len(args.query) == 1 and not args.queries_file:  # any cutoff, 0 included
        hits = fuzzy_search(lines, args.query[0], keys, args.cutoff).select(F.lit(0).cast("long").alias("query_id"), "*")
    elif args.fuzzy:
        hits = multi.fuzzy_search_many(lines, queries, keys, args.cutoff)
    else:
        hits = multi.exact_search_many(lines, queries, keys)
    hits.write.mode("errorifexists").parquet(args.out)
    totals = (queries.join(spark.read.parquet(args.out).groupBy("query_id").count(), "query_id", "left")
              .select("query_id", "query", F.coalesce("count", F.lit(0)).alias("hits")))
    totals.write.mode("errorifexists").parquet(args.out + "_totals")
    return [(r.query, r.hits) for r in spark.read.parquet(args.out + "_totals").orderBy("query_id").limit(PRINTED).collect()]


def _codecs(entries) -> dict:
    """{'.ext': function} of entries '.ext=module:function' (bytes to text)."""
    out = {}
    for entry in entries:
        ext, _, place = entry.partition("=")
        module, _, name = place.partition(":")
        if not (ext.startswith(".") and module and name):
            raise SystemExit(f"--codec wants .ext=module:function, got {entry!r}")
        out[ext] = getattr(importlib.import_module(module), name)
    return out


def run_convert(spark: SparkSession, args):
    from ferret.operators import ingest
    from ferret.sources.files import read_type_list

    types = ingest.DEFAULT_TYPES
    if args.types_file:
        types = tuple(r.ext for r in read_type_list(spark, args.types_file).collect())  # a short list
    existing = spark.read.parquet(args.out).select("out_name").where("out_name is not null") if args.append else None
    if existing is not None:  # read before the target changes
        from ferret.session import ensure_checkpoint_dir
        ensure_checkpoint_dir(spark)
        existing = existing.checkpoint(eager=True)
    out = ingest.ingest_files(spark, args.src, codecs=_codecs(args.codec), types=types, existing=existing,
                              type_match="substring" if args.substring_types else "member")
    out.write.mode("append" if args.append else "errorifexists").parquet(args.out)
    if args.lines:
        ingest.convert_plain_lines(spark, args.src, types=types,
                                   type_match="substring" if args.substring_types else "member") \
            .write.mode("errorifexists").parquet(args.out + "_lines")
    return ingest.report(spark.read.parquet(args.out)).first().asDict()


def main(argv=None, spark: SparkSession | None = None) -> int:
    args = _parser().parse_args(argv)
    own = spark is None
    if own:
        from ferret.session import get_session
        spark = get_session("ferret-cli")
    try:
        if args.cmd == "search":
            for q, n in run_search(spark, args):
                print(f"{n}\t{q}")
        else:
            rep = run_convert(spark, args)
            if args.verbose:
                for k, v in rep.items():
                    if v > 0:
                        print(f"{k}\t{v}")
            else:
                print("\t".join(f"{k}={v}" for k, v in rep.items()))
    finally:
        if own:
            spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
