"""Documents to training sequences: quality, near-duplicates, benchmark passages, personal data, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from agorastat.llm import decontamination, packing, pii, quality, simhash
from agorastat.llm.common import materialize, read, ship


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither fail the base rules nor come from a rejected host."""
    ship(spark)
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of near-duplicates."""
    ship(spark)
    return simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    ship(spark)
    return decontamination.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in ``text`` replaced by its kind."""
    ship(spark)
    return pii.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as token pieces with their places in sequences."""
    ship(spark)
    return packing.pack(packing.token_pieces(docs))


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("PII", mask_personal_data),
    ("best-fit packing", pack_sequences),
]

#: SQL has no tokenizer and no message passing; tests/llm compares run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the whole table, each written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = materialize(stage(spark, docs, sf_dir), f"stage{number}")
    return docs
