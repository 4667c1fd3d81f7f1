"""Seven features per symbol: ratings, reach and company."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from glyphline.operators.frequency import exploded

FEATURES = [
    "n",
    "avg_rating",
    "std_rating",
    "reviews",
    "items",
    "avg_cooccurring",
    "partners",
]


def symbol_rating_stats(df: DataFrame, rating: str = "rating") -> DataFrame:
    """Mean and population deviation of the rating per symbol, one vote per occurrence."""
    return (
        exploded(df, rating)
        .groupBy("symbol")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(rating).alias("avg_rating"),
            F.stddev_pop(rating).alias("std_rating"),
        )
    )


def symbol_reach(df: DataFrame, item: str = "item_id", approximate: bool = False) -> DataFrame:
    """Reviews and items per symbol. A review is one row, so it needs no distinct."""
    pairs = exploded(df, item, once_per_row=True)
    if approximate:
        return pairs.groupBy("symbol").agg(
            F.count(F.lit(1)).alias("reviews"), F.approx_count_distinct(item).cast("bigint").alias("items")
        )
    return (
        pairs.groupBy("symbol", item)
        .agg(F.count(F.lit(1)).alias("_n"))
        .groupBy("symbol")
        .agg(F.sum("_n").alias("reviews"), F.count(item).alias("items"))
    )


def symbol_company(df: DataFrame) -> DataFrame:
    """Mean number of other symbols beside it, and how many different ones overall."""
    others = df.select(F.array_distinct("symbols").alias("_set"))
    beside = others.select("_set", F.explode_outer("_set").alias("symbol")).filter(F.col("symbol").isNotNull())
    links = beside.select(
        "symbol",
        (F.size("_set") - F.lit(1)).alias("_others"),
        F.explode(F.concat(F.array(F.lit(None).cast("string")), F.array_remove("_set", F.col("symbol")))).alias(
            "partner"
        ),
    )
    return (
        links.groupBy("symbol", "partner")
        .agg(F.count(F.lit(1)).alias("_n"), F.sum("_others").alias("_others"))
        .groupBy("symbol")
        .agg(
            (F.sum(F.when(F.col("partner").isNull(), F.col("_others")))
             / F.sum(F.when(F.col("partner").isNull(), F.col("_n")))).alias("avg_cooccurring"),
            F.count("partner").alias("partners"),
        )
    )


def symbol_profile(df: DataFrame, rating: str = "rating", item: str = "item_id") -> DataFrame:
    """All seven features from one scan and two narrow aggregates, without a join.

    Inside the row the symbols shrink to distinct symbols with their multiplicity, so a
    text full of symbols does not multiply its own list. Each distinct symbol yields one
    line, plus one per partner. The first aggregate, on (symbol, partner, item), folds
    hot symbols before the shuffle; the second counts its lines: those with a partner
    are the distinct partners, the others the distinct items. Ratings are kept as sum
    and sum of squares, which is exact for ratings on a short decimal scale.
    """
    sets = df.select(
        F.col(item).alias("_item"),
        F.col(rating).cast("double").alias("_rating"),
        "symbols",
        F.array_distinct("symbols").alias("_set"),
    )
    counted = F.transform(
        "_set",
        lambda s: F.struct(
            s.alias("symbol"), (F.size("symbols") - F.size(F.array_remove("symbols", s))).alias("times")
        ),
    )
    each = sets.select("_item", "_rating", "_set", F.explode_outer(counted).alias("_c")).select(
        "_item", "_rating", "_set", "_c.symbol", "_c.times"
    )
    itself = F.array(F.lit(None).cast("string"))
    lines = each.filter(F.col("symbol").isNotNull()).select(
        "symbol",
        "_item",
        "_rating",
        "times",
        (F.size("_set") - F.lit(1)).alias("_company"),
        F.explode(F.concat(itself, F.array_remove("_set", F.col("symbol")))).alias("partner"),
    )
    own = F.col("partner").isNull()

    def total(value: Column) -> Column:
        return F.sum(F.when(own, value))

    folded = (
        lines.groupBy("symbol", "partner", F.when(own, F.col("_item")).alias("item"))
        .agg(
            total(F.col("times")).alias("_n"),
            F.count_if(own).alias("_reviews"),
            total(F.col("_company")).alias("_others"),
            total(F.when(F.col("_rating").isNotNull(), F.col("times"))).alias("_rated"),
            total(F.col("times") * F.col("_rating")).alias("_sum"),
            total(F.col("times") * F.col("_rating") * F.col("_rating")).alias("_squares"),
        )
        .groupBy("symbol")
        .agg(
            F.sum("_n").alias("n"),
            F.sum("_sum").alias("_sum"),
            F.sum("_squares").alias("_squares"),
            F.sum("_rated").alias("_rated"),
            F.sum("_reviews").alias("reviews"),
            F.count("item").alias("items"),
            F.sum("_others").alias("_others"),
            F.count("partner").alias("partners"),
        )
    )
    rated = F.nullif("_rated", F.lit(0))
    mean = F.col("_sum") / rated
    variance = F.greatest(F.col("_squares") / rated - mean * mean, F.lit(0.0))
    return folded.select(
        "symbol",
        "n",
        mean.alias("avg_rating"),
        F.when(mean.isNotNull(), F.sqrt(variance)).alias("std_rating"),
        "reviews",
        "items",
        (F.col("_others") / F.col("reviews")).alias("avg_cooccurring"),
        "partners",
    )
