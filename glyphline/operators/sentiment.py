"""Valence scores per text and mean sentiment per symbol.

A score is the sum of the lexicon's word valences, squeezed into (-1, 1). Rules for
negation, boosters, capitals and punctuation are not modelled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from glyphline.functions.scoring import compound, rank_value, sentiment_bucket, share
from glyphline.operators.frequency import exploded
from glyphline.operators.polarity import tokens, weighted_hits


def valence_totals(df: DataFrame, valence: DataFrame, text: str, *keep: str) -> DataFrame:
    """Per row (identified by ``keep``): summed valence, its positive and negative part,
    and the number of neutral tokens. A text without tokens stays, with zeros.

    All tokens of a row sit in one task, so the partial aggregate leaves one narrow
    line per row for the shuffle; the text itself never moves.
    """
    scored = weighted_hits(tokens(df, text, *keep), valence, how="left")
    value = F.coalesce("valence", F.lit(0.0)) * F.col("_n")
    return scored.groupBy(*keep).agg(
        F.sum(value).alias("total"),
        F.sum(F.when(value > 0, value).otherwise(F.lit(0.0))).alias("pos_sum"),
        F.sum(F.when(value < 0, -value).otherwise(F.lit(0.0))).alias("neg_sum"),
        F.coalesce(
            F.sum(F.when(F.col("word").isNotNull() & (value == 0), F.col("_n"))), F.lit(0)
        ).alias("neutral"),
    )


def valence_score(df: DataFrame, valence: DataFrame, text: str, *keep: str) -> DataFrame:
    totals = valence_totals(df, valence, text, *keep)
    return totals.select(*keep, "total", compound(F.col("total")).alias("compound"))


def valence_shares(df: DataFrame, valence: DataFrame, text: str, *keep: str) -> DataFrame:
    """Positive, negative and neutral share of each text; null for an empty text."""
    totals = valence_totals(df, valence, text, *keep)
    mass = F.col("pos_sum") + F.col("neg_sum") + F.col("neutral")
    return totals.select(
        *keep,
        share(F.col("pos_sum"), mass).alias("pos"),
        share(F.col("neg_sum"), mass).alias("neg"),
        share(F.col("neutral").cast("double"), mass).alias("neu"),
    )


def bucketed(scores: DataFrame, score: str = "compound") -> DataFrame:
    return scores.withColumn("bucket", sentiment_bucket(F.col(score)))


def symbol_sentiment(
    df: DataFrame, valence: DataFrame, text: str, id_col: str, min_support: int = 1
) -> DataFrame:
    """Mean compound score and number of rows per symbol, each row counting once.

    The row's distinct symbols ride along as a grouping key, so scores need not be
    joined back to the texts.
    """
    sets = df.withColumn("symbols", F.array_distinct("symbols"))
    scores = valence_score(sets, valence, text, id_col, "symbols")
    return (
        exploded(scores, "compound")
        .groupBy("symbol")
        .agg(F.avg("compound").alias("avg_sentiment"), F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= min_support)
    )


def symbol_polarity(
    df: DataFrame, valence: DataFrame, text: str, id_col: str, min_support: int = 50
) -> DataFrame:
    """Mean positive and negative share per symbol, their relative weight, and how far
    that weight is from an even split."""
    sets = df.withColumn("symbols", F.array_distinct("symbols"))
    shares = valence_shares(sets, valence, text, id_col, "symbols")
    means = (
        exploded(shares, "pos", "neg")
        .groupBy("symbol")
        .agg(F.avg("pos").alias("avg_pos"), F.avg("neg").alias("avg_neg"), F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= min_support)
    )
    pos_share = share(F.col("avg_pos"), F.col("avg_pos") + F.col("avg_neg"))
    return (
        means.withColumn("pos_share", pos_share)
        .withColumn("neg_share", F.lit(1.0) - F.col("pos_share"))
        .withColumn("polarity_gap", F.abs(F.col("pos_share") - F.lit(0.5)))
    )


def sentiment_extremes(means: DataFrame, k: int = 10) -> DataFrame:
    """The k highest and the k lowest symbols by mean sentiment."""
    key = rank_value(F.col("avg_sentiment"))
    high = means.orderBy(key.desc(), "symbol").limit(k).withColumn("side", F.lit("top"))
    low = means.orderBy(key, "symbol").limit(k).withColumn("side", F.lit("bottom"))
    return high.unionByName(low)


def polarity_extremes(polarity: DataFrame, k: int = 6) -> DataFrame:
    """The k symbols with the widest and the k with the narrowest polarity gap."""
    scored = polarity.filter(F.col("polarity_gap").isNotNull())
    key = rank_value(F.col("polarity_gap"))
    wide = scored.orderBy(key.desc(), "symbol").limit(k).withColumn("side", F.lit("head"))
    narrow = scored.orderBy(key, F.desc("symbol")).limit(k).withColumn("side", F.lit("tail"))
    return wide.unionByName(narrow).orderBy("side", rank_value(F.col("pos_share")), "symbol")
