"""CSV records of files with quoted line breaks, read by many tasks per file.

A line break ends a record when an even number of quotes comes before it, and a quote inside a quoted
field is doubled, so counting quotes is enough to find the borders. Each block of a file counts the
quotes of its lines and the records that start in it, for either state in which it may begin. One line per
block then goes through a running sum per file, which says how each block does begin and how many
records come before it; with that, a block numbers its records by itself. Lines are shuffled once, by
their block, and only records that lie across the border of two blocks meet their other half in a second, small group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from glyphline.sources.files import raw_lines

QUOTE = '"'


def _quotes(value: Column) -> Column:
    return F.octet_length(value) - F.octet_length(F.replace(value, F.lit(QUOTE), F.lit("")))


def numbered_lines(spark: SparkSession, files: str | list[str]) -> DataFrame:
    """file, block, at, value, record, and whether the record goes on in another block.

    Records count from 1 in each file, the header included; empty lines between records belong to none.
    A file with an odd number of quotes has no last record and is an error.
    """
    inside = Window.partitionBy("file", "block").orderBy("at")
    lines = raw_lines(spark, files).withColumn("_q", _quotes(F.col("value")))
    # quotes of the block before the line
    lines = lines.withColumn("_before", F.sum("_q").over(inside) - F.col("_q"))
    empty = F.rtrim(F.col("value"), F.lit("\r")) == ""
    opens = lambda parity: F.count_if((F.col("_before") % 2 == parity) & ~empty)
    blocks = lines.groupBy("file", "block").agg(
        F.sum("_q").alias("quotes"), opens(0).alias("_even"), opens(1).alias("_odd")
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("parity", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2)
    blocks = blocks.withColumn("starts", F.when(F.col("parity") == 0, F.col("_even")).otherwise(F.col("_odd")))
    blocks = blocks.select(
        F.col("file").alias("_file"), F.col("block").alias("_block"), "parity", "starts",
        F.coalesce(F.sum("starts").over(earlier), F.lit(0)).alias("records"),
        ((F.col("parity") + F.col("quotes")) % 2 == 1).alias("stays_open"),
        F.last("block").over(Window.partitionBy("file").orderBy("block").rowsBetween(0, Window.unboundedFollowing)).alias("_last"),
    )
    unended = F.concat(F.lit("an odd number of quotes in "), F.col("_file"))
    blocks = blocks.withColumn(
        "stays_open",
        F.when(F.col("stays_open") & (F.col("_block") == F.col("_last")), F.raise_error(unended).cast("boolean")).otherwise(F.col("stays_open")),
    )
    found = lines.join(blocks, (F.col("file") == F.col("_file")) & (F.col("block") == F.col("_block")))
    between = (F.col("parity") + F.col("_before")) % 2 == 0
    found = found.filter(~(between & empty))
    starts = F.when(between, 1).otherwise(0)
    found = found.withColumn("record", F.col("records") + F.sum(starts).over(inside))
    across = (F.col("record") == F.col("records")) | (F.col("stays_open") & (F.col("record") == F.col("records") + F.col("starts")))
    return found.select("file", "block", "at", "value", "record", across.alias("across"))


def _joined(lines: Column) -> Column:
    return F.array_join(F.sort_array(F.collect_list(lines))["value"], "\n")


def csv_records(spark: SparkSession, files: str | list[str]) -> DataFrame:
    """file, record, raw: the records of CSV files, undecoded, without their last line feed."""
    lines = numbered_lines(spark, files)
    # the same keys as the windows and one more, so nothing is shuffled again
    parts = lines.groupBy("file", "block", "record").agg(
        _joined(F.struct("at", "value")).alias("value"), F.first("across").alias("across")
    )
    whole = parts.filter(~F.col("across")).select("file", "record", F.col("value").alias("raw"))
    halves = parts.filter("across").groupBy("file", "record").agg(_joined(F.struct("block", "value")).alias("raw"))
    return whole.unionByName(halves)
