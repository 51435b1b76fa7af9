"""Registered queries: each key builds a Spark DataFrame over the given tables and
has (where SQL can say it) an oracle statement for DuckDB.

Every query reads the whole table it names; nothing is capped or sampled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferret.functions.text import lines_of, tokens_of
from ferret.operators import counts, exact, fuzzy, index, ingest, multi, search
from ferret.plans import oracle as O
from ferret.sources.tables import CORPORA, read_corpus, read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            SQL[key] = sql
        return fn
    return deco


def corpus_lines(spark, sf_dir, name):
    df, keys, text = read_corpus(spark, sf_dir, name)
    return lines_of(df, keys, text), keys


# ---------------------------------------------------------------- lines (S3)

def _lines_key(name):
    keys, text = CORPORA[name]
    k = ", ".join(keys)
    sql = f"WITH {O.lines_cte(name, keys, text)} SELECT {k}, line_no, line FROM lines"

    @register(f"lines_{name}", sql)
    def _q(spark, sf_dir, _name=name):
        return corpus_lines(spark, sf_dir, _name)[0]
    return _q


for _name in ("documents", "pages", "conversations"):
    _lines_key(_name)


# ---------------------------------------------------------------- exact search (P1, P2)

EXACT = {
    # key: (table, query)
    "exact_search": ("documents", "license"),
    "exact_search_mixed_case": ("documents", "LiCeNSE"),
    "exact_search_blanks": ("documents", " the "),
    "exact_search_no_wildcards": ("documents", "a_b"),
    "exact_search_pages": ("pages", "<P>"),
    "exact_search_conversations": ("conversations", "de"),
}


def _exact_key(key, table, query):
    keys, text = CORPORA[table]

    @register(key, O.exact_sql(table, keys, text, query))
    def _q(spark, sf_dir):
        df, keys_, text_ = read_corpus(spark, sf_dir, table)
        return exact.exact_search_texts(df, query, keys_, text_)
    return _q


for _k, (_t, _q) in EXACT.items():
    _exact_key(_k, _t, _q)


# ---------------------------------------------------------------- counts (A1, A2)

HITS_QUERY = "the"


@register("hits_per_file",
          f"WITH hits AS ({O.exact_sql('documents', ['doc_id'], 'text', HITS_QUERY)}) "
          f"SELECT doc_id, count(*) AS hits FROM hits GROUP BY doc_id")
def q_hits_per_file(spark, sf_dir):
    df, keys, text = read_corpus(spark, sf_dir, "documents")
    return counts.hits_per_file(exact.exact_search_texts(df, HITS_QUERY, keys, text), keys)


@register("hits_total",
          f"WITH hits AS ({O.exact_sql('documents', ['doc_id'], 'text', HITS_QUERY)}) "
          f"SELECT count(*) AS hits FROM hits")
def q_hits_total(spark, sf_dir):
    df, keys, text = read_corpus(spark, sf_dir, "documents")
    return counts.hits_total(exact.exact_search_texts(df, HITS_QUERY, keys, text))


# ---------------------------------------------------------------- words (P4)

@register("tokens",
          f"WITH {O.lines_cte('documents', ['doc_id'], 'text')}, {O.tokens_cte()} "
          f"SELECT doc_id, line_no, token FROM tokens")
def q_tokens(spark, sf_dir):
    lines, keys = corpus_lines(spark, sf_dir, "documents")
    return tokens_of(lines, keys + ["line_no"])


@register("vocabulary",
          f"WITH {O.lines_cte('documents', ['doc_id'], 'text')}, {O.tokens_cte()} "
          f"SELECT token, count(*) AS occurrences, count(DISTINCT doc_id) AS docs FROM tokens GROUP BY token")
def q_vocabulary(spark, sf_dir):
    df, _, text = read_corpus(spark, sf_dir, "documents")
    return fuzzy.vocabulary(df, text)


# ---------------------------------------------------------------- fuzzy search (P3, P5, P6, F1-F6)

FUZZY = {
    # key: (table, query, cutoff)
    "fuzzy_search": ("documents", "license", 0.85),
    "fuzzy_search_upper": ("documents", "The", 0.85),
    "fuzzy_search_typo": ("documents", "Reaution", 0.85),
    "fuzzy_search_low_cutoff": ("documents", "der", 0.6),
    "fuzzy_search_conversations": ("conversations", "Retion", 0.8),
}


def _fuzzy_key(key, table, query, cutoff):
    keys, text = CORPORA[table]
    k = ", ".join(keys)

    @register(key, f"{O.fuzzy_ctes(table, keys, text, query, cutoff)} "
                   f"SELECT {k}, line_no, line, matched_token, select_score, confidence FROM best")
    def _q(spark, sf_dir):
        lines, keys_ = corpus_lines(spark, sf_dir, table)
        return fuzzy.fuzzy_search(lines, query, keys_, cutoff)
    return _q


for _k, (_t, _q, _c) in FUZZY.items():
    _fuzzy_key(_k, _t, _q, _c)

BOUND_QUERY, BOUND_CUTOFF = "reaution", 0.85
_VOCAB_SQL = (f"WITH {O.lines_cte('documents', ['doc_id'], 'text')}, {O.tokens_cte()}, "
              f"vocab AS (SELECT DISTINCT token FROM tokens) ")


@register("fuzzy_bound_length",
          _VOCAB_SQL + f"SELECT token, 2.0::DOUBLE * least(length(token), {len(BOUND_QUERY)}) / "
                       f"(length(token) + {len(BOUND_QUERY)}) AS length_bound FROM vocab "
                       f"WHERE 2.0::DOUBLE * least(length(token), {len(BOUND_QUERY)}) / "
                       f"(length(token) + {len(BOUND_QUERY)}) >= {BOUND_CUTOFF}::DOUBLE")
def q_fuzzy_bound_length(spark, sf_dir):
    from ferret.functions.similarity import length_bound
    lines, keys = corpus_lines(spark, sf_dir, "documents")
    vocab = tokens_of(lines, keys + ["line_no"]).select("token").distinct()
    b = length_bound(F.col("token"), len(BOUND_QUERY))
    return vocab.select("token", b.alias("length_bound")).filter(F.col("length_bound") >= F.lit(BOUND_CUTOFF))


@register("fuzzy_bound_chars",
          _VOCAB_SQL + f"SELECT token FROM vocab WHERE {O.bounds_sql('token', BOUND_QUERY, BOUND_CUTOFF)}")
def q_fuzzy_bound_chars(spark, sf_dir):
    from ferret.functions.similarity import bounds_pass
    lines, keys = corpus_lines(spark, sf_dir, "documents")
    vocab = tokens_of(lines, keys + ["line_no"]).select("token").distinct()
    return vocab.filter(bounds_pass(F.col("token"), BOUND_QUERY, BOUND_CUTOFF))


@register("fuzzy_scores",
          f"{O.fuzzy_ctes('documents', ['doc_id'], 'text', 'Reaution', 0.85)} "
          f"SELECT token, select_score, confidence FROM scores")
def q_fuzzy_scores(spark, sf_dir):
    lines, keys = corpus_lines(spark, sf_dir, "documents")
    return fuzzy.fuzzy_scores(tokens_of(lines, keys + ["line_no"]), "Reaution", 0.85)


@register("fuzzy_report",
          f"{O.fuzzy_ctes('documents', ['doc_id'], 'text', 'license', 0.85)} "
          f"SELECT doc_id, line_no, line, printf('%.5f', confidence) AS confidence_text FROM best")
def q_fuzzy_report(spark, sf_dir):
    lines, keys = corpus_lines(spark, sf_dir, "documents")
    hits = fuzzy.fuzzy_search(lines, "license", keys, 0.85)
    return hits.select(*keys, "line_no", "line", fuzzy.format_confidence("confidence").alias("confidence_text"))


@register("fuzzy_hits_per_file",
          f"{O.fuzzy_ctes('documents', ['doc_id'], 'text', 'Reaution', 0.85)} "
          f"SELECT doc_id, count(*) AS hits FROM best GROUP BY doc_id")
def q_fuzzy_hits_per_file(spark, sf_dir):
    lines, keys = corpus_lines(spark, sf_dir, "documents")
    return counts.hits_per_file(fuzzy.fuzzy_search(lines, "Reaution", keys, 0.85), keys)


@register("search_method_both",
          f"{O.fuzzy_ctes('documents', ['doc_id'], 'text', 'license', 0.85)}, "
          f"ex AS (SELECT doc_id, line_no, {O.strip_sql('line')} AS line FROM lines WHERE contains(lower(line), 'license')) "
          f"SELECT doc_id, line_no, line, 'exact' AS method, CAST(NULL AS VARCHAR) AS matched_token, "
          f"CAST(NULL AS DOUBLE) AS select_score, CAST(NULL AS DOUBLE) AS confidence FROM ex "
          f"UNION ALL SELECT doc_id, line_no, line, 'fuzzy' AS method, matched_token, select_score, confidence FROM best")
def q_search_method_both(spark, sf_dir):
    lines, keys = corpus_lines(spark, sf_dir, "documents")
    return search.search_methods(lines, "license", keys, methods=("exact", "fuzzy"), cutoff=0.85)


# ---------------------------------------------------------------- ingest (S5-S8, C1-C8)

def manifest(spark, sf_dir):
    """Source files stood in by documents: name d{doc_id div 8}{ext}, ext by doc_id % 8."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    ext = F.element_at(F.array(*[F.lit(e) for e in O.MANIFEST_EXTS]), (F.col("doc_id") % 8 + 1).cast("int"))
    name = F.concat(F.lit("d"), F.expr("doc_id div 8").cast("string"), ext)
    return docs.select("doc_id", name.alias("file_name"), "text")


def _converted(spark, sf_dir, type_match="member", codecs=None):
    files = ingest.classify(manifest(spark, sf_dir), "file_name", type_match=type_match)
    return ingest.convert(files, "file_name", "text", text_input=True, codecs=codecs)


# A registered decoder for the codec keys: the bytes as text after a mark.
CODECS = {".docx": lambda blob: "# " + blob.decode()}


_M = O.manifest_cte()
_CLS = O.classified_cte("manifest", "file_name", ingest.DEFAULT_TYPES)
_CLS_SUB = O.classified_cte("manifest", "file_name", ingest.DEFAULT_TYPES, "substring")
_CONV = O.converted_cte("classified", "file_name", "text")
_NAMED = O.named_cte("converted", "file_name")


@register("type_dispatch", f"WITH {_M}, {_CLS} SELECT doc_id, file_name, ext, label, handler FROM classified")
def q_type_dispatch(spark, sf_dir):
    return ingest.classify(manifest(spark, sf_dir), "file_name").select(
        "doc_id", "file_name", "ext", "label", "handler")


@register("type_dispatch_substring",
          f"WITH {_M}, {_CLS_SUB} SELECT doc_id, file_name, ext, label, handler FROM classified")
def q_type_dispatch_substring(spark, sf_dir):
    return ingest.classify(manifest(spark, sf_dir), "file_name", type_match="substring").select(
        "doc_id", "file_name", "ext", "label", "handler")


@register("conversion_messages",
          f"WITH {_M}, {_CLS}, {_CONV} SELECT doc_id, file_name, status, message FROM converted")
def q_conversion_messages(spark, sf_dir):
    return _converted(spark, sf_dir).select("doc_id", "file_name", "status", "message")


_CODEC = O.converted_cte("classified", "file_name", "text", codec_exts=tuple(CODECS))


@register("conversion_codec",
          f"WITH {_M}, {_CLS}, {_CODEC}, {_NAMED} SELECT doc_id, file_name, status, message, out_name, "
          f"length(out_text) AS chars FROM named")
def q_conversion_codec(spark, sf_dir):
    named = ingest.name_outputs(_converted(spark, sf_dir, codecs=CODECS), "file_name")
    return named.select("doc_id", "file_name", "status", "message", "out_name",
                        F.length("text").cast("bigint").alias("chars"))


_REPORT_COLS = ", ".join(f"count(*) FILTER (WHERE status = '{s}') AS {s}" for s in ingest.STATUSES)


@register("conversion_report", f"WITH {_M}, {_CLS}, {_CONV} SELECT {_REPORT_COLS} FROM converted")
def q_conversion_report(spark, sf_dir):
    return ingest.report(_converted(spark, sf_dir))


@register("conversion_report_substring",
          f"WITH {_M}, {_CLS_SUB}, {_CONV} SELECT {_REPORT_COLS} FROM converted")
def q_conversion_report_substring(spark, sf_dir):
    return ingest.report(_converted(spark, sf_dir, "substring"))


@register("conversion_report_verbose",
          f"WITH {_M}, {_CLS}, {_CONV} SELECT status, count(*) AS files FROM converted GROUP BY status")
def q_conversion_report_verbose(spark, sf_dir):
    return ingest.report_verbose(_converted(spark, sf_dir))


@register("output_naming",
          f"WITH {_M}, {_CLS}, {_CONV}, {_NAMED} SELECT doc_id, file_name, out_name FROM named "
          f"WHERE out_name IS NOT NULL")
def q_output_naming(spark, sf_dir):
    named = ingest.name_outputs(_converted(spark, sf_dir), "file_name")
    return named.filter(F.col("out_name").isNotNull()).select("doc_id", "file_name", "out_name")


@register("output_naming_existing",
          f"WITH {_M}, {_CLS}, {_CONV}, taken AS (SELECT 'd' || CAST(doc_id // 8 AS VARCHAR) || ' (C).txt' AS t "
          f"FROM documents WHERE doc_id % 24 = 5), w AS (SELECT *, {O.sql_fill(ingest.OUT_NAME, head='head', label='label')} "
          f"AS first FROM converted WHERE status IN ('success', 'unsure')), "
          f"r AS (SELECT *, row_number() OVER (PARTITION BY first ORDER BY file_name) - 1 "
          f"+ CAST(first IN (SELECT t FROM taken) AS INTEGER) AS rk FROM w) "
          f"SELECT doc_id, file_name, CASE WHEN rk = 0 THEN first ELSE "
          f"{O.sql_fill(ingest.OUT_NAME_N, head='head', label='label', n='rk')} END AS out_name FROM r")
def q_output_naming_existing(spark, sf_dir):
    """Naming against a target that already holds the plain ``.c`` name of every third head."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id"]).filter(F.col("doc_id") % 24 == 5)
    taken = docs.select(F.concat(F.lit("d"), F.expr("doc_id div 8").cast("string"), F.lit(" (C).txt")).alias("out_name"))
    named = ingest.name_outputs(_converted(spark, sf_dir), "file_name", taken)
    return named.filter(F.col("out_name").isNotNull()).select("doc_id", "file_name", "out_name")


@register("removal_manifest",
          f"WITH {_M}, {_CLS}, {_CONV}, {_NAMED} SELECT file_name, out_name FROM named "
          f"WHERE status IN ('success', 'unsure')")
def q_removal_manifest(spark, sf_dir):
    return ingest.removal_manifest(ingest.name_outputs(_converted(spark, sf_dir), "file_name"), "file_name")


@register("convert_plaintext",
          f"WITH pg AS (SELECT page_id, 'p' || CAST(page_id AS VARCHAR) || '.html' AS name, html FROM pages), "
          f"{O.classified_cte('pg', 'name', ingest.DEFAULT_TYPES)}, {O.converted_cte('classified', 'name', 'html')}, "
          f"{O.named_cte('converted', 'name')} "
          f"SELECT page_id, out_name, status, out_text AS text FROM named")
def q_convert_plaintext(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages", ["page_id", "html"]).select(
        "page_id", F.format_string("p%d.html", "page_id").alias("name"), "html")
    conv = ingest.convert(ingest.classify(pages, "name"), "name", "html", text_input=True)
    return ingest.name_outputs(conv, "name").select("page_id", "out_name", "status", "text")


@register("inventory",
          f"WITH {_M}, {_CLS} SELECT file_name, CASE WHEN ext = '.txt' THEN 'text' WHEN ext = '.docx' THEN 'docx' "
          f"WHEN ext = '.pdf' THEN 'pdf' WHEN list_contains([{', '.join(O.sql_str(t) for t in ingest.DEFAULT_TYPES)}], "
          f"ext) THEN 'extra' ELSE 'other' END AS type_class, "
          f"CAST(row_number() OVER (ORDER BY lower(file_name), file_name) AS BIGINT) AS rank FROM classified")
def q_inventory(spark, sf_dir):
    return ingest.inventory(manifest(spark, sf_dir).select("file_name"), "file_name")


_WRITES = "status IN ('success', 'unsure')"


@register("convert_then_search",
          f"WITH {_M}, {_CLS}, {_CONV}, {_NAMED}, "
          f"{O.lines_cte('named', ['out_name'], 'out_text', where=_WRITES)} "
          f"SELECT out_name, line_no, {O.strip_sql('line')} AS line FROM lines WHERE contains(lower(line), 'license')")
def q_convert_then_search(spark, sf_dir):
    conv = _converted(spark, sf_dir)
    writes = conv.filter(F.col("status").isin("success", "unsure"))
    hits = exact.exact_search_texts(writes, "license", ["file_name"], "text")
    names = ingest.output_names(conv, "file_name")
    return hits.join(names, F.col("file_name") == F.col("_name")).select("out_name", "line_no", "line")


# ---------------------------------------------------------------- many queries (M1, M2)

def benchmark_queries(spark, sf_dir):
    """(query_id, query): every distinct word, in its own case, of all benchmark items; a word is its own id."""
    from ferret.functions.text import WS_RUN
    b = read_table(spark, sf_dir, "benchmark", ["text"])
    words = b.select(F.explode(F.split("text", WS_RUN, -1)).alias("query")).filter(F.col("query") != "").distinct()
    return words.select(F.col("query").alias("query_id"), "query")


_EXACT_MANY_SQL = (f"WITH {O.queries_cte()}, {O.lines_cte('documents', ['doc_id'], 'text')} "
                   f"SELECT q.query_id, l.doc_id, l.line_no, {O.strip_sql('l.line')} AS line "
                   f"FROM lines l JOIN queries q ON contains(lower(l.line), lower(q.query))")


@register("exact_multi_query", _EXACT_MANY_SQL)
def q_exact_multi_query(spark, sf_dir):
    lines, keys = corpus_lines(spark, sf_dir, "documents")
    return multi.exact_search_many(lines, benchmark_queries(spark, sf_dir), keys)


@register("exact_multi_query_trigram", _EXACT_MANY_SQL.replace("contains(", "length(q.query) >= 3 AND contains(", 1))
def q_exact_multi_query_trigram(spark, sf_dir):
    """The queries of three characters and more, which block on a trigram."""
    lines, keys = corpus_lines(spark, sf_dir, "documents")
    queries = benchmark_queries(spark, sf_dir).filter(F.length("query") >= 3)
    return multi.exact_search_many(lines, queries, keys)


@register("fuzzy_multi_query",
          f"{O.fuzzy_many_ctes(0.85)} SELECT query_id, doc_id, line_no, line, matched_token, select_score, "
          f"confidence FROM best")
def q_fuzzy_multi_query(spark, sf_dir):
    from ferret.functions.text import words_of
    df, keys, text = read_corpus(spark, sf_dir, "documents")
    vocab = df.select(F.explode(words_of(text)).alias("token"))
    return multi.fuzzy_search_many(lines_of(df, keys, text), benchmark_queries(spark, sf_dir), keys, 0.85,
                                   vocab=vocab)


# ---------------------------------------------------------------- stored index (M1, M2 again and again)

def documents_index(spark, sf_dir):
    """An index of documents in two segments, as a corpus that grew once."""
    import uuid

    from ferret.session import ensure_checkpoint_dir
    df, keys, text = read_corpus(spark, sf_dir, "documents")
    stored = index.create_index(df.filter(F.col("doc_id") % 2 == 0), f"{ensure_checkpoint_dir(spark)}/{uuid.uuid4().hex}", keys, text)
    stored.add(df.filter(F.col("doc_id") % 2 != 0), text)
    return stored


@register("index_exact_queries", _EXACT_MANY_SQL)
def q_index_exact_queries(spark, sf_dir):
    return documents_index(spark, sf_dir).exact_search_many(benchmark_queries(spark, sf_dir))


@register("index_fuzzy_queries", SQL["fuzzy_multi_query"])
def q_index_fuzzy_queries(spark, sf_dir):
    return documents_index(spark, sf_dir).fuzzy_search_many(benchmark_queries(spark, sf_dir), 0.85)
