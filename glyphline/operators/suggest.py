"""Emotion -> symbol suggestion.

The model is a small (emotion, symbol, n) table. It is folded to one line per emotion,
with ranked and cumulated arrays bounded by the vocabulary, so a text meets exactly one
model line and scoring never multiplies the texts. The join has no hint: Catalyst
broadcasts the lines when they are small, and otherwise adaptive execution splits the
partition of an emotion that labels a third of all texts.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F

from glyphline.functions.scoring import damped, seeded_uniform
from glyphline.functions.text import none_of
from glyphline.operators.frequency import symbol_counts_by


def emotion_model(df: DataFrame, emotion: str = "emotion") -> DataFrame:
    """(emotion, symbol, n) from rows with a label; a symbol counts once per row."""
    return symbol_counts_by(df.filter(F.col(emotion).isNotNull()), emotion)


def folded_model(model: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
    """One line per emotion: symbols by descending count, their counts, running sums."""
    excluded = list(exclude)
    if excluded:
        model = model.filter(none_of("symbol", excluded))
    order = Window.partitionBy("emotion").orderBy(F.desc("n"), "symbol")
    summed = model.select(
        "emotion",
        F.struct(
            F.row_number().over(order).alias("i"),
            F.col("symbol").alias("s"),
            F.col("n").alias("n"),
            F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("r"),
        ).alias("_e"),
    )
    lines = summed.groupBy("emotion").agg(F.sort_array(F.collect_list("_e")).alias("_r"))
    return lines.select("emotion", F.col("_r.s").alias("_symbols"), F.col("_r.n").alias("_counts"), F.col("_r.r").alias("_running"))


def _scored(texts: DataFrame, model: DataFrame, pick: Column, exclude: Iterable[str] = ()) -> DataFrame:
    """Left join, so that an unknown or missing emotion keeps its row with a null symbol."""
    lines = folded_model(model, exclude)
    return texts.join(lines, "emotion", "left").select(*texts.columns, pick.alias("symbol"))


def suggest_top(texts: DataFrame, model: DataFrame) -> DataFrame:
    """The most frequent symbol of the text's emotion."""
    return _scored(texts, model, F.get("_symbols", F.lit(0)))


def suggest_topk(
    texts: DataFrame, model: DataFrame, id_col: str, k: int = 3, seed: int = 42, exclude: Iterable[str] = ()
) -> DataFrame:
    """An even, seeded choice among the k most frequent symbols."""
    return _scored(texts, model, _even_choice(id_col, k, seed), exclude)


def _even_choice(id_col: str, k: int, seed: int) -> Column:
    choices = F.least(F.lit(k), F.size("_symbols"))
    return F.get("_symbols", (seeded_uniform(seed, F.col(id_col)) % choices).cast("int"))


def suggest_from_lines(texts: DataFrame, lines: DataFrame, id_col: str, k: int = 3, seed: int = 42) -> DataFrame:
    """``suggest_topk`` on a model that was folded before; ``texts`` may be a stream and ``lines`` its static side."""
    return texts.join(lines, "emotion", "left").select(*texts.columns, _even_choice(id_col, k, seed).alias("symbol"))


def suggest_damped(texts: DataFrame, model: DataFrame) -> DataFrame:
    """The symbol with the largest damped count n / ln(n + 2)."""
    weighted = F.zip_with(
        "_counts", "_symbols", lambda n, s: F.struct((-damped(n)).alias("k"), s.alias("s"))
    )
    return _scored(texts, model, F.array_min(weighted)["s"])


def suggest_weighted(texts: DataFrame, model: DataFrame, id_col: str, seed: int = 42) -> DataFrame:
    """A seeded choice weighted by count: the first running sum above the draw."""
    total = F.element_at("_running", -1)
    draw = seeded_uniform(seed, F.col(id_col)) % total
    index = F.size(F.filter("_running", lambda r: r <= draw))
    return _scored(texts, model, F.get("_symbols", index))


def race_key(seed: int, row_id: Column, symbol: Column, n: Column) -> Column:
    """Finishing time of a symbol in an exponential race (Efraimidis and Spirakis, 2006): -ln(u) / n.

    u is drawn from seed, row and symbol alone. The least of several times belongs to a symbol
    with chance n / sum(n), and the next ones are draws without replacement from the rest.
    """
    u = (seeded_uniform(seed, row_id, symbol) + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.ln(u) / n


def _race(seed: int, id_col: str) -> Column:
    """(time, symbol) of every symbol of the text's model line; symbols without weight do not start."""
    times = F.zip_with(
        "_symbols", "_counts", lambda s, n: F.when(n > 0, F.struct(race_key(seed, F.col(id_col), s, n).alias("t"), s.alias("s")))
    )
    return F.filter(times, lambda e: e.isNotNull())


def suggest_race(texts: DataFrame, model: DataFrame, id_col: str, seed: int = 42, exclude: Iterable[str] = ()) -> DataFrame:
    """A seeded choice weighted by count: the first symbol home.

    Adding or dropping a symbol changes the choice only where that symbol wins or won, as every
    symbol has a draw of its own. An unknown emotion, or one without symbols, keeps its row with a null.
    """
    return _scored(texts, model, F.array_min(_race(seed, id_col))["s"], exclude)


def suggest_picks(
    texts: DataFrame, model: DataFrame, id_col: str, k: int = 3, seed: int = 42, exclude: Iterable[str] = ()
) -> DataFrame:
    """Up to k different symbols per text, drawn by count without replacement, in the order they come home."""
    first = F.transform(F.slice(F.array_sort(_race(seed, id_col)), 1, k), lambda e: e["s"])
    return _scored(texts, model, first, exclude).withColumnRenamed("symbol", "symbols")


def race_by_aggregate(texts: DataFrame, model: DataFrame, id_col: str, seed: int = 42) -> DataFrame:
    """The same choice as ``suggest_race`` for a model too long to fold: texts meet the model's rows and the
    least time wins by a partial and a final aggregate, so no list of symbols is held."""
    times = texts.join(model.filter(F.col("n") > 0), "emotion", "left")
    order = F.struct(race_key(seed, F.col(id_col), F.col("symbol"), F.col("n")), F.col("symbol"))
    return times.groupBy(*texts.columns).agg(F.min_by("symbol", F.when(F.col("symbol").isNotNull(), order)).alias("symbol"))


def ranked_model(model: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
    """The model in long form with a rank per emotion."""
    excluded = list(exclude)
    if excluded:
        model = model.filter(none_of("symbol", excluded))
    order = Window.partitionBy("emotion").orderBy(F.desc("n"), "symbol")
    return model.withColumn("rnk", F.row_number().over(order).cast("bigint"))
