"""Emotion labels: lexicon counts, dominant emotion, and the hook for any scorer."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from glyphline.operators.polarity import tokens, weighted_hits


def emotion_counts(df: DataFrame, lexicon: DataFrame, text: str, *keep: str) -> DataFrame:
    """(row, emotion, n). A word may stand for several emotions."""
    found = tokens(df, text, *keep).filter(F.col("word").isNotNull())
    return (
        weighted_hits(found, lexicon)
        .groupBy(*keep, "emotion")
        .agg(F.sum("_n").alias("n"))
    )


def _names(labels: DataFrame) -> Column:
    """The distinct emotions in order, as a scalar array."""
    return labels.agg(F.sort_array(F.collect_set("emotion"))).scalar()


def _coded(names: Column, first_wins: bool) -> Column:
    """Count and place of the emotion as one number, larger for a larger count.

    A number can be the buffer of a hash aggregate; a struct or a string would make Spark
    sort the rows of every text. With K emotions the code is n * (K + 1) plus the place, or
    minus it where the first name is to win.
    """
    place = F.array_position(names, F.col("emotion"))
    return F.col("n") * (F.size(names) + 1) + (-place if first_wins else place)


def _place(code: Column, names: Column, first_wins: bool) -> Column:
    """The emotion that a code stands for, null for a null code."""
    size = F.size(names) + 1
    return F.get(names, (F.pmod(-code if first_wins else code, size) - 1).cast("int"))


def dominant_emotion(counts: DataFrame, lexicon: DataFrame, *keep: str) -> DataFrame:
    """The most frequent emotion of each row, the first by name on ties."""
    names = _names(lexicon)
    best = counts.groupBy(*keep).agg(F.max(_coded(names, True)).alias("_code"), F.max("n").alias("n"))
    return best.select(*keep, _place(F.col("_code"), names, True).alias("emotion"), "n")


def labelled(df: DataFrame, lexicon: DataFrame, text: str, *keep: str) -> DataFrame:
    """Every row with its dominant emotion, null where no word is in the lexicon.

    One pass: rows without a hit are carried through the same aggregate, so nothing is
    joined back.
    """
    hits = weighted_hits(tokens(df, text, *keep), lexicon, how="left")
    counts = hits.groupBy(*keep, "emotion").agg(F.sum("_n").alias("n"))
    names = _names(lexicon)
    # the place of a null emotion is null, and so is its code
    best = counts.groupBy(*keep).agg(F.max(_coded(names, True)).alias("_code"))
    return best.select(*keep, _place(F.col("_code"), names, True).alias("emotion"))


def top_emotions(df: DataFrame, lexicon: DataFrame, text: str, *keep: str, key: str = "label") -> DataFrame:
    """Emotions whose frequency equals the row's highest, and the largest of them as a
    (label, score) tuple. ``key="label"`` returns the label alone; ``"label_score"``
    also the score, so that rows can be grouped by the whole tuple."""
    counts = emotion_counts(df, lexicon, text, *keep)
    names = _names(lexicon)
    pairs = counts.groupBy(*keep).agg(
        F.sum("n").alias("_total"),
        F.max("n").alias("_most"),
        F.max(_coded(names, False)).alias("_code"),
    ).withColumn("emotion", _place(F.col("_code"), names, False))
    columns = ["emotion"]
    if key == "label_score":
        pairs = pairs.withColumn("score", F.col("_most") / F.col("_total"))
        columns.append("score")
    return pairs.select(*keep, *columns)


def label_with(
    df: DataFrame, make_scorer: Callable[[], Callable[[str], str | None]], text: str, out: str = "emotion"
) -> DataFrame:
    """Label every text with any Python callable, batch by batch.

    ``make_scorer`` runs once per worker stream (load the model there); a text the
    callable fails on gets a null label.
    """

    @F.pandas_udf("string")
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = make_scorer()

        def one(value: str | None) -> str | None:
            try:
                return scorer("" if value is None else value)
            except Exception:
                return None

        for batch in batches:
            yield batch.map(one, na_action=None).astype(object)

    return df.withColumn(out, label(F.col(text)))
