"""The corpus pipeline: stages over `documents`, each written and read again.

Every stage takes what its predecessor kept and returns the columns of
documents; the last adds the token ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.lineage import scratch_folder
from panelwright.llm.byte_bpe import VOCABULARY, encode, n_ids
from panelwright.llm.decontamination import decontaminated
from panelwright.llm.exact import drop_exact_duplicates
from panelwright.llm.simhash import drop_near_duplicates
from panelwright.llm.toxicity import drop_toxic

# Columns that the last stage adds to those of documents.
IDS, N_TOKENS = "token_ids", "n_tokens"


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from `labels`."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of equal texts stays."""
    return drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenization(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their ids (little-endian 32-bit) and their number."""
    own = [docs[c] for c in docs.columns if c not in (IDS, N_TOKENS)]
    ids = encode(spark, F.col("text"), public_tokenizers.path(VOCABULARY))
    return docs.select(*own, ids.alias(IDS)).withColumn(N_TOKENS, n_ids(F.col(IDS)))


STAGES = [
    ("toxicity", toxicity),
    ("exact dedup", exact_dedup),
    ("simhash near-dedup", near_dedup),
    ("decontamination", decontamination),
    ("byte-level bpe", tokenization),
]

# Training, SimHash over XXH64 and the merges of a vocabulary are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage returns is written as Parquet in
    the shared scratch folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            folder = scratch_folder(spark, f"stage-{i}")
            docs.write.parquet(folder)
            docs = spark.read.parquet(folder)
    return docs
