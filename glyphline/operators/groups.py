"""Groups and symbols: top groups, top symbols per group, association, shares.

Everything here needs two facts from the texts: how many rows each group has, and
how many rows hold each symbol in each group. ``group_profile`` gets both in one scan.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window, functions as F

from glyphline.functions.scoring import rank_value
from glyphline.functions.text import none_of, primary_category


def with_primary_category(df: DataFrame, categories: str, out: str = "grp") -> DataFrame:
    return df.withColumn(out, primary_category(categories))


def group_sizes(df: DataFrame, group: str) -> DataFrame:
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("rows"))


def top_groups(df: DataFrame, group: str, k: int, exclude: Iterable[str] = ()) -> DataFrame:
    """The k groups with most rows; ``exclude`` is applied before the ranking."""
    excluded = list(exclude)
    if excluded:
        df = df.filter(none_of(group, excluded))
    return group_sizes(df, group).orderBy(F.desc("rows"), group).limit(k)


def in_top_groups(df: DataFrame, group: str, k: int, exclude: Iterable[str] = ()) -> DataFrame:
    """Rows of the k most frequent groups (the broadcast side has k rows)."""
    top = top_groups(df, group, k, exclude).select(group)
    return df.join(F.broadcast(top), group, "left_semi")


def group_profile(
    df: DataFrame, group: str, top: int, exclude_groups: Iterable[str] = ()
) -> DataFrame:
    """(group, rows, symbol, n) for the ``top`` most frequent groups, in one scan.

    Each row yields its distinct symbols plus one null marker, so the same partial
    aggregate counts rows (marker) and symbols. A hot group is folded on the map side;
    what is shuffled is one line per task, group and symbol. Per group the list is
    bounded by the vocabulary, which lets the ranking run before the symbols are
    unfolded again - no second scan and no join.
    """
    excluded = list(exclude_groups)
    if excluded:
        df = df.filter(none_of(group, excluded))
    marked = F.concat(F.array(F.lit(None).cast("string")), F.array_distinct("symbols"))
    counts = (
        df.select(group, F.explode_outer(marked).alias("symbol"))
        .groupBy(group, "symbol")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    per_group = counts.groupBy(group).agg(
        F.max(F.when(F.col("symbol").isNull(), F.col("n"))).alias("rows"),
        F.collect_list(F.when(F.col("symbol").isNotNull(), F.struct("symbol", "n"))).alias("cells"),
    )
    ranked = per_group.orderBy(F.desc("rows"), group).limit(top)
    return ranked.select(group, "rows", F.explode("cells").alias("c")).select(
        group, "rows", "c.symbol", "c.n"
    )


def keep_spread(cells: DataFrame, max_spread: int) -> DataFrame:
    """Cells of symbols that occur in at most ``max_spread`` groups."""
    spread = F.count(F.lit(1)).over(Window.partitionBy("symbol"))
    return cells.withColumn("spread", spread).filter(F.col("spread") <= max_spread)


def top_symbols_per_group(
    df: DataFrame,
    group: str,
    top: int = 5,
    n: int = 5,
    max_spread: int = 5,
    exclude_groups: Iterable[str] = (),
) -> DataFrame:
    """The n most frequent symbols of each of the ``top`` groups."""
    cells = keep_spread(group_profile(df, group, top, exclude_groups), max_spread)
    order = Window.partitionBy(group).orderBy(F.desc("n"), "symbol")
    return (
        cells.withColumn("rnk", F.row_number().over(order))
        .filter(F.col("rnk") <= n)
        .select(group, "symbol", "n", "spread", F.col("rnk").cast("bigint").alias("rnk"))
    )


def with_expected(cells: DataFrame, group: str) -> DataFrame:
    """The cells with their symbol's and group's totals (``_row``, ``_col``) and the count
    expected if symbol and group were independent."""
    every = Window.partitionBy()
    return (
        cells.withColumn("_row", F.sum("n").over(Window.partitionBy("symbol")))
        .withColumn("_col", F.sum("n").over(Window.partitionBy(group)))
        .withColumn("expected", F.col("_row").cast("double") * F.col("_col") / F.sum("n").over(every))
    )


def chi2_from_cells(cells: DataFrame, group: str, min_support: int = 10) -> DataFrame:
    """Sum over groups of (observed - expected)^2 / expected for each symbol.

    ``cells`` is a reduced (group, symbol, n) table. Group totals include symbols
    below the support. A cell that was never observed adds its expected count; those
    expectations sum to the symbol's total minus the expectations of observed cells,
    so no zero cell and no cross join is needed.
    """
    missing = F.greatest(F.first("_row") - F.sum("expected"), F.lit(0.0))
    return (
        with_expected(cells, group).filter(F.col("_row") >= min_support)
        .groupBy("symbol")
        .agg(
            F.first("_row").alias("total"),
            (F.sum((F.col("n") - F.col("expected")) ** 2 / F.col("expected")) + missing).alias("chi2"),
        )
    )


def association_cells(
    df: DataFrame,
    group: str,
    top: int = 10,
    drop_groups: Iterable[str] = (),
    drop_symbols: Iterable[str] = (),
) -> DataFrame:
    """Cells of the top groups; groups and symbols are dropped after that choice."""
    cells = group_profile(df, group, top)
    for column, dropped in ((group, list(drop_groups)), ("symbol", list(drop_symbols))):
        if dropped:
            cells = cells.filter(none_of(column, dropped))
    return cells


def chi2_association(
    df: DataFrame,
    group: str,
    top_groups: int = 10,
    min_support: int = 10,
    top: int = 10,
    drop_groups: Iterable[str] = (),
    drop_symbols: Iterable[str] = (),
) -> DataFrame:
    """The ``top`` symbols most strongly tied to particular groups."""
    cells = association_cells(df, group, top_groups, drop_groups, drop_symbols)
    return top_associations(chi2_from_cells(cells, group, min_support), top)


def top_associations(scored: DataFrame, top: int) -> DataFrame:
    return scored.orderBy(rank_value(F.col("chi2")).desc(), "symbol").limit(top)


def row_share(cells: DataFrame, value: str = "n") -> DataFrame:
    """Each cell as a share of its symbol's total."""
    total = F.sum(value).over(Window.partitionBy("symbol"))
    return cells.withColumn("share", F.col(value) / total)
