"""Distinct items per symbol as mergeable sketches, kept up to date from new rows only.

A sketch (HyperLogLog of Apache DataSketches) has a fixed size per symbol, whatever it has counted, and the
union of sketches is the sketch of all their rows. So a table of rows that grows is never counted anew: each
batch of new rows leaves one sketch per symbol, and a reader unites them. An item that comes again,
in the same batch or another, changes nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from glyphline.operators.frequency import exploded

LG_K = 12


def error_bound(lg_k: int = LG_K, deviations: float = 3.0) -> float:
    """Relative error of an estimate that ``deviations`` standard errors allow, for united sketches of 2 ** lg_k cells."""
    return deviations * 1.04 / 2 ** (lg_k / 2)


def reach_sketches(df: DataFrame, item: str = "item_id", lg_k: int = LG_K) -> DataFrame:
    """symbol, reviews, sketch: from a symbols frame. A null item counts as no item.

    Partial sketches are made where rows are read, so a symbol that a third of all rows have is no hot key.
    """
    pairs = exploded(df, F.col(item).cast("string").alias("_item"), once_per_row=True)
    return pairs.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("reviews"), F.hll_sketch_agg("_item", F.lit(lg_k)).alias("sketch")
    )


def united(*sketches: DataFrame) -> DataFrame:
    """One sketch per symbol of several tables of sketches."""
    rows = reduce(DataFrame.unionByName, sketches)
    return rows.groupBy("symbol").agg(F.sum("reviews").alias("reviews"), F.hll_union_agg("sketch").alias("sketch"))


def reach(sketches: DataFrame) -> DataFrame:
    """symbol, reviews, items: the number of items is an estimate, exact while there are few."""
    return sketches.select("symbol", "reviews", F.hll_sketch_estimate("sketch").alias("items"))


def both(left: str | Column, right: str | Column) -> Column:
    """Estimate of the items that two sketches share, from the estimates of each and of their union."""
    union = F.hll_sketch_estimate(F.hll_union(left, right))
    return F.greatest(F.hll_sketch_estimate(left) + F.hll_sketch_estimate(right) - union, F.lit(0))


def update_reach(new_rows: DataFrame, path: str, batch: str | int, item: str = "item_id", lg_k: int = LG_K) -> None:
    """Add the sketches of a batch of new rows to the table at ``path``. A batch that is run again replaces itself."""
    reach_sketches(new_rows, item, lg_k).write.mode("overwrite").parquet(f"{path}/batch={batch}")


def read_reach(spark: SparkSession, path: str) -> DataFrame:
    """One sketch per symbol of all batches so far."""
    return united(spark.read.parquet(path).select("symbol", "reviews", "sketch"))


def compact_reach(spark: SparkSession, path: str, into: str) -> None:
    """Write the united sketches of all batches as the first batch of another table."""
    read_reach(spark, path).write.mode("overwrite").parquet(f"{into}/batch=0")
