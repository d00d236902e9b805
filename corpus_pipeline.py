"""Corpus pipeline over ``documents``: quality classifier, line dedup, n-gram
near-duplicates, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one
before it kept; all but the last return the columns of ``docs``. Rows without a
doc_id pass the stages that decide by id. ``run`` writes every stage's rows to
the shared folder and reads them back for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from burnlens.llm import classifier, decontamination, line_dedup, ngram_join, packing
from burnlens.llm.common import materialise, table


#: Near duplicates: Jaccard similarity over word shingles (op6 has its contract's own values).
NEAR_WORDS, NEAR_PERCENT = 5, 80


def _by_id(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` whose doc_id is (left_semi) or isn't (left_anti) among
    ``ids``; a list of ids known to be small goes to the executors."""
    ids = materialise(ids.select(F.col("doc_id").alias("__id")).distinct(), "ids")
    few = ids.count() <= ngram_join.BROADCAST_IDS
    return docs.join(F.broadcast(ids) if few else ids, F.col("doc_id").cast("long") == F.col("__id"), how)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return classifier.keep_good(docs, classifier.fit(docs, table(spark, sf_dir, "labels")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks of lines that an earlier document has go, and documents that held nothing else."""
    out = line_dedup.dedup(docs).where("kept")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long"))
    return out.select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents the one with the least id stays."""
    gone = ngram_join.join(docs, percent=NEAR_PERCENT, words=NEAR_WORDS).where(F.col("component_id") != F.col("doc_id"))
    return _by_id(docs, gone, "left_anti")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return _by_id(docs, decontamination.leaks(docs, table(spark, sf_dir, "benchmark")), "left_anti")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents left, in sequences."""
    return packing.pack(docs)


STAGES = [("quality_classifier", quality), ("line_dedup", lines), ("ngram_jaccard_join", near_duplicates),
          ("benchmark_decontamination", decontaminate), ("best_fit_packing", pack)]

#: SQL can't express these stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
