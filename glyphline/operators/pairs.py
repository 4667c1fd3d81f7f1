"""Symbol pairs inside a row: counts, top pairs, the reduced matrix and its scaling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from glyphline.session import checkpointed


def symbol_pairs(df: DataFrame, *keep: str) -> DataFrame:
    """Unordered pairs of distinct symbols of a row, smaller code point first.

    Two chained generators emit the pairs one at a time, so a row with many symbols
    never builds its whole pair list in memory, and no self join is needed.
    """
    ordered = df.select(*keep, F.array_sort(F.array_distinct("symbols")).alias("_set"))
    first = ordered.select(*keep, "_set", F.posexplode_outer("_set").alias("_i", "s1"))
    rest = F.slice("_set", F.col("_i") + F.lit(2), F.size("_set"))
    return (
        first.select(*keep, "s1", F.explode_outer(rest).alias("s2"))
        .filter(F.col("s1").isNotNull() & F.col("s2").isNotNull())
    )


def cooccurrence_counts(df: DataFrame) -> DataFrame:
    """Rows per unordered pair. The result is bounded by the vocabulary, not the data."""
    return symbol_pairs(df).groupBy("s1", "s2").agg(F.count(F.lit(1)).alias("n"))


def top_pairs(counts: DataFrame, k: int = 20) -> DataFrame:
    return counts.orderBy(F.desc("n"), "s1", "s2").limit(k)


def pair_matrix(counts: DataFrame) -> DataFrame:
    """Symmetric long form of the pair counts."""
    both = F.explode(
        F.array(F.struct(F.col("s1").alias("row"), F.col("s2").alias("col")),
                F.struct(F.col("s2").alias("row"), F.col("s1").alias("col")))
    )
    return counts.select(both.alias("cell"), "n").select("cell.row", "cell.col", "n")


def top_pair_matrix(counts: DataFrame, k: int = 20) -> DataFrame:
    """Every cell among the symbols of the top-k pairs, symmetric and zero-filled.

    At most 2k symbols: the semi joins broadcast that list, and the zero cells are
    unfolded from it as one small array, without a cross join. The counts are needed
    for the choice and for the cells; they are checkpointed (vocabulary-sized), because
    Catalyst would push the semi joins under their aggregate and read the texts twice.
    """
    counts = checkpointed(counts)
    top = top_pairs(counts, k).select(F.explode(F.array("s1", "s2")).alias("symbol")).distinct()
    side = F.broadcast(top)
    observed = pair_matrix(
        counts.join(side.withColumnRenamed("symbol", "s1"), "s1", "left_semi").join(
            side.withColumnRenamed("symbol", "s2"), "s2", "left_semi"
        )
    )
    zeros = (
        top.agg(F.collect_set("symbol").alias("_symbols"))
        .select("_symbols", F.explode("_symbols").alias("row"))
        .select("row", F.explode("_symbols").alias("col"), F.lit(0).cast("bigint").alias("n"))
    )
    return observed.unionByName(zeros).groupBy("row", "col").agg(F.sum("n").alias("n"))


def to_matrix(
    long: DataFrame, row: str, col: str, value: str, columns: list[str] | None = None, checked: bool = True
) -> DataFrame:
    """Wide, zero-filled form of a reduced long table.

    Without ``columns`` every value that occurs has one, in order; more values than a pivot may have
    (spark.sql.pivotMaxValues) are an error, and no more than that reach the driver. With ``columns`` a
    cell outside them is an error, or left out on purpose with ``checked=False``.
    """
    if columns is None:
        most = int(long.sparkSession.conf.get("spark.sql.pivotMaxValues"))
        found = long.select(col).filter(F.col(col).isNotNull()).distinct().limit(most + 1).collect()
        if len(found) > most:
            raise ValueError(f"{col} has more than {most} values: reduce the table first")
        columns = sorted(r[0] for r in found)
    if checked:
        outside = F.raise_error(F.concat(F.lit(f"a cell outside the columns of {col}: "), F.coalesce(F.col(col).cast("string"), F.lit("null"))))
        long = long.withColumn(col, F.when(F.col(col).isin(columns), F.col(col)).otherwise(outside.cast(long.schema[col].dataType)))
    else:
        long = long.filter(F.col(col).isin(columns))
    return long.groupBy(row).pivot(col, columns).agg(F.sum(value)).fillna(0)


def log_minmax(matrix: DataFrame, value: str = "n") -> DataFrame:
    """log1p, then scaled to 0..1 over the whole reduced matrix; null when flat.

    The input is the (2k)^2 matrix above, so one window over it is one small task.
    """
    logged = matrix.withColumn("logged", F.log1p(value))
    every = Window.partitionBy()
    low, high = F.min("logged").over(every), F.max("logged").over(every)
    return logged.withColumn("scaled", (F.col("logged") - low) / F.nullif(high - low, F.lit(0.0)))
