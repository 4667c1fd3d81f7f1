"""The given tables in the roles the operators expect, and small literal lexicons.

Texts hold no emoji here, so accented letters and junk marks serve as the symbols.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from glyphline.functions.symbols import symbol_class
from glyphline.operators.frequency import with_symbols

SYMBOLS = "é è ê ç ä ö ü ß ñ í ó É È Ê Ç Ä Ö Ü Ñ Í Ó | % * & $ # ! + = @ -".split()
VOCAB = symbol_class(SYMBOLS)

POLARITY = [
    ("the", "pos"), ("and", "pos"), ("to", "pos"), ("la", "pos"), ("que", "pos"), ("die", "pos"),
    ("best", "pos"), ("of", "neg"), ("in", "neg"), ("der", "neg"), ("is", "neg"), ("le", "neg"),
    ("worthless", "neg"), ("all-around", "pos"),
]
VALENCE = [
    ("the", 0.5), ("of", -0.75), ("and", 1.25), ("to", 0.25), ("in", -0.5), ("la", 1.5), ("de", -1.0),
    ("der", -0.25), ("que", 2.0), ("is", -1.5), ("le", 0.75), ("en", -1.25), ("die", 1.0), ("was", -2.0),
]
EMOTIONS = [
    ("the", "trust"), ("of", "fear"), ("and", "joy"), ("and", "trust"), ("to", "joy"), ("in", "fear"),
    ("in", "sadness"), ("la", "joy"), ("de", "sadness"), ("der", "anger"), ("die", "trust"), ("die", "anger"),
    ("que", "joy"), ("que", "surprise"), ("is", "anger"), ("le", "trust"), ("en", "sadness"), ("was", "anger"),
]
STOPWORDS = ["a", "an", "on", "for", "it", "as", "with", "de", "le", "en", "the", "of", "don't"]
LABELS = [("src0", "é"), ("src1", "ü"), ("src2", "ñ"), ("src3", "!"), ("nowhere", "|")]


def values_sql(rows: list[tuple], columns: str) -> str:
    """A VALUES list that reads the same in Spark and in standard SQL."""

    def literal(v) -> str:
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else f"CAST({v} AS DOUBLE)"

    listed = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return f"(VALUES {listed}) AS t({columns})"


POLARITY_SQL = values_sql(POLARITY, "word, polarity")
VALENCE_SQL = values_sql(VALENCE, "word, valence")
EMOTIONS_SQL = values_sql(EMOTIONS, "word, emotion")
STOPWORDS_SQL = values_sql([(w,) for w in STOPWORDS], "word")
LABELS_SQL = values_sql(LABELS, "label, symbol")


def _values(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    """A literal table Catalyst knows the size of."""

    def literal(v) -> str:
        return '"' + v + '"' if isinstance(v, str) else f"{v}D"

    listed = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {listed} AS t({columns})")


def lexicon(spark: SparkSession) -> DataFrame:
    return _values(spark, POLARITY, "word, polarity")


def valence(spark: SparkSession) -> DataFrame:
    return _values(spark, VALENCE, "word, valence")


def emotions(spark: SparkSession) -> DataFrame:
    return _values(spark, EMOTIONS, "word, emotion")


def stopwords(spark: SparkSession) -> DataFrame:
    return _values(spark, [(w,) for w in STOPWORDS], "word")


def label_dimension(spark: SparkSession) -> DataFrame:
    return _values(spark, LABELS, "label, symbol")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Documents with only the columns asked for."""
    return table(spark, sf_dir, "documents").select(*columns)


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir, "doc_id", "source", "text").select(
        F.col("doc_id").alias("post_id"), F.col("source").alias("label"), "text"
    )


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations")


def symbol_rows(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    """Documents with at least one symbol: the kept columns and the symbols."""
    needed = dict.fromkeys((*keep, "text"))
    return with_symbols(documents(spark, sf_dir, *needed), VOCAB, "text", keep=keep)


def rated_symbol_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbols with the rating of the text (null when it has none) and its item.

    Symbols are extracted before the join, so ids and short arrays are shuffled and the
    texts are not.
    """
    ratings = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("rating"))
    rows = symbol_rows(spark, sf_dir, "doc_id", "source")
    return rows.join(ratings, "doc_id", "left").select(
        F.col("doc_id").alias("review_id"), F.col("source").alias("item_id"), "rating", "symbols"
    )
