"""Corpus pipeline: toxicity, SimHash near-duplicates, substring repeats, benchmark leaks, packing.

Each stage works on all rows its predecessor kept. All but the last return the columns
of ``docs``; the last returns one row for each packed piece. Decisions name documents
by doc_id: a row with null doc_id is judged by the row-wise toxicity stage and passes
the others; rows that repeat a doc_id share its decision, except that the SimHash stage
leaves one row of each and the substring stage cuts each row by its own words. Columns of
any name pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferret.llm import decontaminate, packing, simhash, substring_dedup, toxicity
from ferret.llm.common import bounded, checkpointed, held_out, stored, table


def _free(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` doesn't have."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name = "_" + name
    return name


def _join(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """``docs`` with (left_semi) or without (left_anti) the rows of the doc_ids ``ids``."""
    name = _free(docs, "__id")
    key = bounded(ids.select(F.col("doc_id").cast("long").alias(name)))
    return docs.join(key, F.col("doc_id").cast("long") == F.col(name), how)


def drop_toxic(spark, docs, sf_dir):
    """Rows that the toxicity model rejects go."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), lambda i: held_out(i, 5, 0))
    names = (_free(docs, "__toxic_score"), _free(docs, "__toxic_passages"))
    return toxicity.scored(docs, model, names=names).where(f"{names[0]} < 0.5").select(*docs.columns)


def drop_near_duplicates(spark, docs, sf_dir):
    """One row of each near-duplicate group stays: that of the smallest doc_id."""
    found = checkpointed(simhash.near_duplicates(docs).where("doc_id is not null"))
    again = checkpointed(found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id"))
    gone = found.where("doc_id != component_id").select("doc_id")
    if not again.count():
        return _join(docs, checkpointed(gone), "left_anti")
    # rows of a repeated doc_id may lie in several groups: they are told apart by fingerprint
    once = _join(_join(docs, again, "left_anti"), checkpointed(gone.join(again, "doc_id", "left_anti")), "left_anti")
    id_, fp, row, own = (_free(docs, n) for n in ("__id", "__fp", "__row", "__print"))
    stays = found.join(again, "doc_id", "left_semi").where("doc_id = component_id").select(
        F.col("doc_id").alias(id_), F.col("fp").alias(fp)).distinct()
    several = checkpointed(_join(docs, again, "left_semi").withColumn(row, F.monotonically_increasing_id()))
    prints = simhash.fingerprints(several.select(F.col(row).alias("doc_id"), "text")).select(
        F.col("doc_id").alias(row), F.col("fp").alias(own))
    kept = (several.join(prints, row).join(stays, (F.col("doc_id").cast("long") == F.col(id_)) & (F.col(own) == F.col(fp)), "left_semi")
            .dropDuplicates(["doc_id"]))
    return once.unionByName(kept.select(*docs.columns))


def cut_repeats(spark, docs, sf_dir):
    """Words in passages of 50 words that an earlier document holds are cut from the text."""
    id_, digest, kept = (_free(docs, n) for n in ("__id", "__digest", "__kept"))
    cut = checkpointed(substring_dedup.cut_repeats(docs, texts=True).where("doc_id is not null and n_removed > 0")
                       .select(F.col("doc_id").alias(id_), F.col("digest").alias(digest), F.col("kept").alias(kept))
                       .dropDuplicates([id_, digest]))
    ids = checkpointed(cut.select(F.col(id_).alias("doc_id")).distinct())
    own = _free(docs, "__own")
    old = _join(docs, ids, "left_semi").withColumn(own, substring_dedup.words_digest("text"))
    new = old.join(cut, (F.col("doc_id").cast("long") == F.col(id_)) & (F.col(own) == F.col(digest)), "left")
    new = new.withColumn("text", F.coalesce(kept, "text"))
    if "n_chars" in docs.columns:
        new = new.withColumn("n_chars", F.when(F.col(kept).isNull(), F.col("n_chars")).otherwise(
            F.length(kept)).cast(docs.schema["n_chars"].dataType))
    return _join(docs, ids, "left_anti").unionByName(new.select(*docs.columns))


def drop_leaks(spark, docs, sf_dir):
    """Documents that hold a passage of the benchmark go."""
    found = decontaminate.leaks(docs, table(spark, sf_dir, "benchmark"))
    return _join(docs, checkpointed(found.select("doc_id").where("doc_id is not null").distinct()), "left_anti")


def pack(spark, docs, sf_dir):
    """What is left, as token pieces packed into sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("benchmark_decontamination", drop_leaks),
    ("best_fit_packing", pack),
]

#: Fingerprints, classifiers, alignments and tokens are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs)
    return docs
