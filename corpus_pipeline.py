"""The training-data pipeline: stages that each read what the one before has written.

Every stage reads the columns of ``documents`` and carries further ones through. An empty table stays empty in
every stage; what a null, an empty text or a repeated row becomes is stated with each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from glyphline.llm import mixing, packing, quality, secrets, simhash
from glyphline.llm.common import table, written

#: Seeds, fingerprints and a linear program have no SQL equivalent; a test compares with brute-force versions.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, without their flagged lines.

    A null or empty text goes, as the base rules ask for words; a null source is a host of its own; repeated rows
    each stay or go.
    """
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id.

    Texts without words are one group; rows that repeat id and text are one document; of a group of none but
    null ids one text stays.
    """
    return simhash.keep_one(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark; null texts stay null, repeated rows stay."""
    return secrets.redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as the mix takes them: once for each whole pass, and the words of a partial one.

    A text without words gives no row; the null source comes last among the weights.
    """
    return mixing.draw(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences; a null or empty text is its end token alone."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", near_dedup),
    ("secret scans", secret_scan),
    ("mixing sources", source_mix),
    ("best-fit packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = written(docs, f"stage{number}")
    return docs
