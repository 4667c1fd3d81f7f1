"""Run and key de-duplication, and the kept / total counter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T


MAX_BUCKETS = 4096
#: Bytes of text that a bucket holds on average at most.
BUCKET_BYTES = 32 << 20


def _borders(df: DataFrame, order: str, bucket_rows: int) -> list[int]:
    """Values of the order that cut the rows into buckets of about equal size.

    The number of buckets follows the number of rows and the bytes of their texts up to MAX_BUCKETS; a
    bucket then holds more rows, which its task sorts with spilling. There is always a border, so the
    bucket is a column to join on and no constant.
    """
    texts = [F.col(f"`{f.name}`") for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)).cast("bigint") for c in texts), F.lit(0).cast("bigint"))
    rows, held = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    buckets = min(MAX_BUCKETS, max(2, -(-rows // bucket_rows), -(-held // BUCKET_BYTES)))
    cuts = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    found = df.agg(F.percentile_approx(F.col(order).cast("bigint"), cuts, F.lit(10 * buckets))).first()[0]
    return sorted(set(found or [0]))


def _bucket_of(order: Column, borders: list[int], first: int = 0) -> Column:
    """Number of borders at or below the value: a tree of comparisons, so few are made per row."""
    if not borders:
        return F.lit(first)
    middle = len(borders) // 2
    return F.when(order < F.lit(borders[middle]), _bucket_of(order, borders[:middle], first)).otherwise(
        _bucket_of(order, borders[middle + 1 :], first + middle + 1)
    )


def first_of_run(
    df: DataFrame, order: str, key: str, predicate: Column, bucket_rows: int = 1_000_000
) -> DataFrame:
    """Rows where the predicate holds and the key differs from the row just before.

    ``order`` is a unique integer of any distribution; "just before" is the previous input
    row, kept or not, and the first row counts as different. A global lag would sort
    everything in one task. Here the order is cut at its own quantiles, which spreads any key
    evenly; ``lag`` runs inside a bucket, and one line per bucket (MAX_BUCKETS at most)
    carries the last key over the border. The columns of rows that fail the predicate are
    blanked before the shuffle: only their order and key are needed.
    """
    borders = _borders(df, order, bucket_rows)
    payload = F.when(predicate, F.struct(*[F.col(c) for c in df.columns]))
    narrow = df.select(
        F.col(order).alias("_order"),
        F.struct(F.col(key).alias("k")).alias("_key"),
        payload.alias("_row"),
        _bucket_of(F.col(order), borders).alias("_bucket"),
    )
    summaries = narrow.groupBy("_bucket").agg(F.max_by("_key", "_order").alias("_last"))
    carried = summaries.select("_bucket", F.lag("_last").over(Window.orderBy("_bucket")).alias("_before"))
    inside = F.lag("_key").over(Window.partitionBy("_bucket").orderBy("_order"))
    placed = narrow.withColumn("_inside", inside).filter(F.col("_row").isNotNull())
    before = F.coalesce("_inside", "_before")
    changed = before.isNull() | ~before["k"].eqNullSafe(F.col("_key")["k"])
    return placed.join(carried, "_bucket").filter(changed).select("_row.*")


def scalar_columns(df: DataFrame, without: tuple[str, ...] = ()) -> list[str]:
    nested = (T.ArrayType, T.MapType, T.StructType)
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, nested) and f.name not in without]


def row_digest(df: DataFrame, columns: list[str]) -> Column:
    """A 256-bit digest of the columns. Each value is marked with its length, or as null, so
    different rows have different input; 0.0 and -0.0 are one value."""
    parts = []
    for c in columns:
        value = F.col(c)
        if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)):
            value = value + F.lit(0.0)
        text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("null;")))
    return F.sha2(F.concat(*parts) if parts else F.lit(""), 256)


def _firsts(df: DataFrame, columns: list[str], order: str) -> DataFrame:
    """The rows with the least order of each combination of the columns.

    Digests and orders are aggregated, which hashes and never sorts a text; a row copied a
    billion times is folded by every task before the shuffle. Only combinations that occur again go
    on: the orders of their later rows are looked up by digest, and those rows leave by an anti join. While
    copies are few, Spark broadcasts both short sides and no text moves.
    """
    digests = df.select(row_digest(df, columns).alias("_digest"), F.col(order).alias("_order"))
    repeated = digests.groupBy("_digest").agg(F.min("_order").alias("_least"), F.count(F.lit(1)).alias("_n"))
    later = digests.join(repeated.filter(F.col("_n") > 1), "_digest").filter(F.col("_order") > F.col("_least"))
    return df.join(later.select(F.col("_order").alias(order)), order, "left_anti")


def dedup_scalar(df: DataFrame, order: str) -> DataFrame:
    """One row per combination of scalar columns (row identity aside), the first by
    ``order``, a unique id; nested columns come along with it. Nulls compare equal."""
    return _firsts(df, scalar_columns(df, (order,)), order)


def dedup_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """The first row by ``order``, a unique id, for each key."""
    return _firsts(df, [key], order)


def selectivity(df: DataFrame, predicate: Column) -> DataFrame:
    """Kept rows, all rows, and the percentage."""
    return df.agg(
        F.count_if(predicate).alias("kept"), F.count(F.lit(1)).alias("total")
    ).withColumn("percent", F.col("kept") * F.lit(100.0) / F.nullif("total", F.lit(0)))
