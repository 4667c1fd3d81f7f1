"""Symbol extraction over a table, and symbol counts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from glyphline.functions.symbols import extract_symbols, has_symbol
from glyphline.functions.text import combined_text


def with_symbols(df: DataFrame, vocab: str, *text_cols: str, keep: Iterable[str] | None = None) -> DataFrame:
    """Rows with at least one symbol, plus their ``symbols`` array.

    The row test is the character class itself, so rows without a symbol never reach
    the extraction. ``keep`` names the columns to carry on; leaving the text out
    keeps later shuffles narrow.
    """
    text = combined_text(*text_cols)
    kept = list(keep) if keep is not None else df.columns
    return df.filter(has_symbol(text, vocab)).select(*kept, extract_symbols(text, vocab).alias("symbols"))


def symbols_by_table(
    df: DataFrame, vocab: DataFrame, *text_cols: str, keep: Iterable[str], symbol: str = "symbol"
) -> DataFrame:
    """Every row with its ``symbols`` by a vocabulary held as a table: in reading order, repeats kept.

    The code points of a text are unfolded with their places, joined to the vocabulary and folded in order
    again; code points outside the vocabulary end at the join, in the task that read the text, and texts do not
    move. Entries of more or less than one code point are no symbols. Of those with one Unicode has
    1,114,112, which bounds what the join broadcasts, however long the table is. A null or empty text, and one
    without a symbol, has an empty list; rows that are equal in all columns each stay.
    """
    known = vocab.select(F.col(symbol).alias("_c")).filter(F.char_length("_c") == 1).distinct()
    points = F.regexp_extract_all(combined_text(*text_cols), F.lit("(?s)."), F.lit(0))
    kept = list(keep)
    rows = df.select(*kept, F.monotonically_increasing_id().alias("_row"), points.alias("_points"))
    # place 0 holds no code point: it carries the row through the join
    unfolded = rows.select(*kept, "_row", F.posexplode(F.concat(F.array(F.lit("")), "_points")).alias("_p", "_c"))
    found = unfolded.join(F.broadcast(known.withColumn("_known", F.lit(True))), "_c", "left")
    found = found.filter((F.col("_p") == 0) | F.col("_known"))
    listed = F.collect_list(F.when(F.col("_p") > 0, F.struct("_p", "_c")))
    return found.groupBy("_row", *kept).agg(F.sort_array(listed).alias("_s")).select(*kept, F.col("_s._c").alias("symbols"))


def distinct_symbols(symbols: Column | str = "symbols") -> Column:
    return F.array_distinct(F.col(symbols) if isinstance(symbols, str) else symbols)


def exploded(df: DataFrame, *keep: Column | str, once_per_row: bool = False) -> DataFrame:
    """One row per symbol occurrence, or per distinct symbol of a row.

    ``explode_outer`` with a filter behind it: plain ``explode`` makes Catalyst add a
    size test below the generator, which would run the extraction a second time.
    """
    array = distinct_symbols() if once_per_row else F.col("symbols")
    return df.select(*keep, F.explode_outer(array).alias("symbol")).filter(F.col("symbol").isNotNull())


def symbol_counts(df: DataFrame) -> DataFrame:
    """Occurrences of every symbol."""
    return exploded(df).groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))


def symbol_counts_by(df: DataFrame, group: str, exclude: Iterable[str] = ()) -> DataFrame:
    """Rows per (group, symbol); a symbol counts once per row."""
    pairs = exploded(df, group, once_per_row=True)
    excluded = list(exclude)
    if excluded:
        pairs = pairs.filter(~F.col("symbol").isin(excluded))
    return pairs.groupBy(group, "symbol").agg(F.count(F.lit(1)).alias("n"))


def top_symbols(df: DataFrame, k: int = 5) -> DataFrame:
    return symbol_counts(df).orderBy(F.desc("n"), "symbol").limit(k)


def containing(df: DataFrame, symbol: str) -> DataFrame:
    """Rows whose list holds the symbol."""
    return df.filter(F.array_contains("symbols", symbol))


def containing_any(df: DataFrame, wanted: DataFrame, id_col: str) -> DataFrame:
    """(id, symbol) for every row holding one of the wanted symbols."""
    return exploded(df, id_col, once_per_row=True).join(wanted.select("symbol"), "symbol", "left_semi")
