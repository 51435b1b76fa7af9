"""The registered queries of the operators: one over the whole of its table each."""

from __future__ import annotations

from pyspark.sql import functions as F

from ferret.llm import (brown_lm, decontaminate, html_extract, licenses, minhash, packing, quality_model, quality_rules, simhash,
                        spelling, substring_dedup, toxicity, whitening)
from ferret.llm.common import held_out, table


def op1_decontamination(spark, sf_dir):
    """Leaked benchmark passages: one row for each document and item that it holds."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    trees = quality_model.fit(docs, table(spark, sf_dir, "labels"), lambda i: held_out(i, 3, 1))
    return quality_model.scored(docs, trees).select(
        "doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_license_scan(spark, sf_dir):
    """One row for each notice that a document holds."""
    return (licenses.licenses(table(spark, sf_dir, "documents")).select("doc_id", F.explode("found").alias("f"))
            .select("doc_id", "f.license", "f.line", "f.saved", "f.share", F.array_join("f.differences", " ").alias("differences"),
                    "f.start", "f.end"))


def op4_quality_rules(spark, sf_dir):
    return quality_rules.judged(table(spark, sf_dir, "documents"))


def op5_html_extraction(spark, sf_dir):
    return html_extract.extracted(table(spark, sf_dir, "pages"))


def op6_substring_dedup(spark, sf_dir):
    return substring_dedup.cut_repeats(table(spark, sf_dir, "documents")).withColumnRenamed("kept", "kept_sha256")


def op7_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), lambda i: held_out(i, 5, 0))
    return toxicity.scored(docs, model).select(
        "doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("passages").alias("n_passages"))


def op8_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op9_brown_lm(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model, counts = brown_lm.fit(docs.where(~held_out(F.col("doc_id"), 5, 1)))
    out = brown_lm.scored(docs, model, counts)
    return out.select("doc_id", held_out(F.col("doc_id"), 5, 1).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                      "base_score", "score")


def op10_simhash(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op11_embedding_whitening(spark, sf_dir):
    """Whitened coordinates: one row for each usable vector and component."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_spelling_variants(spark, sf_dir):
    """One row for each frequent word, with the form and the root it is a variant of."""
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_minhash(spark, sf_dir):
    """One row for each document, with the component of its near-duplicates."""
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.withColumn("kept", F.col("doc_id") == F.col("component_id"))


QUERIES = {f.__name__: f for f in (
    op1_decontamination, op2_quality_classifier, op3_license_scan, op4_quality_rules, op5_html_extraction,
    op6_substring_dedup, op7_toxicity, op8_best_fit_packing, op9_brown_lm, op10_simhash,
    op11_embedding_whitening, op12_spelling_variants, op13_minhash)}

_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

SQL = {
    "op4_quality_rules": rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
spans AS (
  SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, words[p], words[p + 1], words[p + 2]) AS n
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS p FROM d)),
again AS (
  SELECT doc_id, count(DISTINCT w) AS n_repeat_words
  FROM (SELECT doc_id, unnest([p, p + 1, p + 2]) AS w FROM spans WHERE n > 1) GROUP BY doc_id),
c AS (
  SELECT d.*, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS upper_case,
    length(text) - length(regexp_replace(text, '[!?]', '', 'g')) AS marks,
    len(list_filter(words, lambda w: regexp_matches(w, '\pL'))) AS lettered, len(list_distinct(words)) AS kinds,
    len(list_filter(lines, lambda l: regexp_matches(ltrim(l), '^[-*•]'))) AS bullets
  FROM d LEFT JOIN again USING (doc_id)),
j AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 12 * n_words
    OR 10 * n_dup_lines > 8 * len(lines) OR 2 * upper_case > word_chars OR 4 * marks > n_words OR 10 * lettered < 7 * n_words
    OR 20 * kinds < n_words OR 10 * bullets > 9 * len(lines)) AS kept
FROM j""",
    "op6_substring_dedup": rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS words FROM documents),
w AS (SELECT doc_id, p, array_to_string(words[p:p + 49], ' ') AS k
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS p FROM d)),
least AS (SELECT k, min(doc_id) AS first FROM w GROUP BY k HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS p FROM w JOIN least USING (k) WHERE doc_id > first),
each AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM d),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t FROM each ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)""",
    "op13_minhash": r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(words[p:p + 2], ' ') AS g
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 1, 2))) AS p FROM d WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
near AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
ways AS (SELECT a, b FROM near UNION ALL SELECT b, a FROM near),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, ways.b FROM reach JOIN ways ON ways.a = reach.b)
SELECT a AS doc_id, CAST(coalesce(max(n), 0) AS BIGINT) AS n_shingles, min(b) AS component_id, a = min(b) AS kept
FROM reach LEFT JOIN n ON n.doc_id = a GROUP BY a""",
}
