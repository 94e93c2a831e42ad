"""Corpus pipeline: each stage takes the documents its predecessor kept and returns what it keeps.

STAGES holds (name, function) with function(spark, docs, sf_dir) -> DataFrame; run() writes each stage's result as
Parquet and reads it again as the next one's documents. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from zonewright.llm import catalog, decontaminate, segment, signature_tree, storage, surrogates, toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not found toxic (operator 10). Rows whose doc_id is rejected go; rows without doc_id stay."""
    found = toxicity.detect(docs, catalog.table(spark, sf_dir, "labels"))
    bad = found.where("predicted = 1 and doc_id is not null").select("doc_id").distinct()
    return docs.join(bad, "doc_id", "left_anti").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the least doc_id, of each group of near copies (operator 8: five words, 0.8). Rows without doc_id stay."""
    groups = signature_tree.jaccard_components(docs, k=5, percent=80)
    copies = groups.where("doc_id is not null and doc_id != component_id").select("doc_id").distinct()
    return docs.join(copies, "doc_id", "left_anti").select(*COLUMNS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item (operator 7)."""
    found = decontaminate.leaks(docs, catalog.table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(*COLUMNS)


def replace_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data and secrets replaced (operator 4); n_chars follows the new text."""
    out = surrogates.replace(docs.select(*COLUMNS))
    length = F.when(F.col("n_entities") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", length).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The best segmentation of each document and the scores of the next ones (operator 6)."""
    return catalog.segmented(docs)


STAGES = [("toxicity", drop_toxic), ("ngram_jaccard_join", drop_near_copies), ("benchmark_decontamination", drop_leaks),
          ("pii", replace_private), ("sentencepiece", encode)]

# learned labels, near copies by signature trees and segmentation are beyond SQL; tests hold each stage against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    path = storage.run_dir(spark, "pipeline")
    docs = catalog.table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = storage.kept(stage(spark, docs, sf_dir), f"{path}/{i}-{name}")
    return docs
