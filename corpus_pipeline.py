"""Training-data pipeline: rules, near-duplicates, decontamination, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from halocline.llm import decontaminate, jaccard_join, packing, quality_rules, secret_scan
from halocline.llm.shared import stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects, unchanged. Null and empty texts have no words and go; repeated rows are judged alike; an empty table stays empty."""
    return quality_rules.keep(docs).select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the least id, of each group of near-duplicates, unchanged. Texts without shingles are groups of their own; an empty table stays empty."""
    return jaccard_join.one_of_each(docs).select(COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, unchanged. Null and empty texts hold none and stay; an empty table stays empty, and without items all stay."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark")).select(COLUMNS)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced by a mark and n_chars counted anew."""
    return secret_scan.redact(docs).withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast("long"))).select(COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sequence and place of each piece of each document."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", rules),
    ("jaccard_join", near_duplicates),
    ("decontaminate", decontamination),
    ("secret_scan", secrets),
    ("best_fit_packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Packing and the random spans cannot be written in SQL; tests hold the stages against brute force.
ORACLE_SQL = None
