"""Lexicon hits and word polarity per label.

The lexicon is joined to the token stream, which drops most tokens before they are
counted. Catalyst broadcasts a small lexicon by itself; for a larger one, adaptive
execution splits the partitions of frequent words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from glyphline.functions.scoring import share
from glyphline.functions.text import tokenize


def tokens(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """One row per token; a text without tokens keeps one row with a null word."""
    return df.select(*keep, F.explode_outer(tokenize(text)).alias("word"))


def normalise_lexicon(lexicon: DataFrame, word: str = "word") -> DataFrame:
    """Reduce entries to what the tokeniser can produce (``all-around`` -> ``allaround``).
    Without it, entries holding other characters never match; that is the default."""
    return lexicon.withColumn(word, F.regexp_replace(F.lower(word), "[^a-z']", "")).filter(F.col(word) != "").distinct()


def weighted_hits(found: DataFrame, lexicon: DataFrame, how: str = "inner") -> DataFrame:
    """Join a token frame (the ``keep`` columns and ``word``) with the lexicon; every line
    stands for one token (``_n``)."""
    return found.withColumn("_n", F.lit(1).cast("bigint")).join(lexicon, "word", how)


def lexicon_hits(df: DataFrame, lexicon: DataFrame, text: str, *keep: str) -> DataFrame:
    """Tokens that are in the lexicon, with the lexicon's columns and a count ``n``."""
    found = tokens(df, text, *keep).filter(F.col("word").isNotNull())
    columns = [c for c in lexicon.columns if c != "word"]
    return (
        weighted_hits(found, lexicon)
        .groupBy(*keep, "word", *columns)
        .agg(F.sum("_n").alias("n"))
    )


def restrict_labels(posts: DataFrame, dimension: DataFrame, label: str = "label") -> DataFrame:
    """Posts whose label is in the dimension."""
    return posts.join(dimension.select(label), label, "left_semi")


def polarity_counts(
    posts: DataFrame, lexicon: DataFrame, label: str = "label", text: str = "text"
) -> DataFrame:
    """Positive and negative tokens per label; labels without a hit stay with 0."""
    def tally(polarity: str):
        return F.coalesce(F.sum(F.when(F.col("polarity") == polarity, F.col("_n"))), F.lit(0)).cast("bigint")

    return (
        weighted_hits(tokens(posts, text, label), lexicon, how="left")
        .groupBy(label)
        .agg(tally("pos").alias("pos"), tally("neg").alias("neg"))
    )


def polarity_ratio(counts: DataFrame) -> DataFrame:
    return counts.withColumn("ratio", share(F.col("pos"), F.col("neg")))


def polarity_share(counts: DataFrame) -> DataFrame:
    """Both shares, null when there is no hit at all, and a flag for that case."""
    total = F.col("pos") + F.col("neg")
    return (
        counts.withColumn("pos_share", share(F.col("pos"), total))
        .withColumn("neg_share", share(F.col("neg"), total))
        .withColumn("no_words", total == 0)
    )
