"""Encoding and column-count audits of raw files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from glyphline.sources.csv import _FILE, _RAW, _RECORD, _options, _parsed_records, field_count
from glyphline.sources.files import files_by_layout, raw_lines

PREVIEW_CHARS = 120
SLICE_BYTES = 10


def audit_encoding(spark: SparkSession, glob: str | list[str]) -> DataFrame:
    """Per file: lines, lines that are not valid UTF-8, and the first of those - its line
    number, byte offset and the bytes there.

    Blocks of a file are summarised where they are read; line numbers follow from the
    line counts of the blocks before, so a file of any size is audited in parallel.
    """
    lines = raw_lines(spark, glob)
    bad = ~F.is_valid_utf8("value")
    blocks = lines.groupBy("file", "block").agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(bad).alias("bad_lines"),
        F.min("at").alias("_first"),
        F.min(F.when(bad, F.col("at"))).alias("_at"),
        F.min_by(F.when(bad, F.col("value").cast("binary")), F.when(bad, F.col("at"))).alias("_raw"),
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    placed = blocks.withColumn("_before", F.coalesce(F.sum("lines").over(earlier), F.lit(0)))
    number = F.col("_before") + F.col("_at") - F.col("_first") + F.lit(1)
    per_file = placed.groupBy("file").agg(
        F.sum("lines").alias("lines"),
        F.sum("bad_lines").alias("bad_lines"),
        F.min(number).alias("first_bad_line"),
        F.min_by("_raw", number).alias("_raw"),
    )
    good_part = F.substring_index(F.make_valid_utf8(F.col("_raw").cast("string")), "�", 1)
    offset = F.octet_length(good_part)
    return per_file.select(
        "file",
        "lines",
        "bad_lines",
        "first_bad_line",
        F.when(F.col("_raw").isNotNull(), offset).alias("byte_offset"),
        F.hex(F.substring(F.col("_raw"), offset + F.lit(1), F.lit(SLICE_BYTES))).alias("bad_bytes"),
    )


def audit_columns(spark: SparkSession, glob: str | list[str], by_blocks: bool = False) -> DataFrame:
    """Records whose field count differs from the header: file, record number (the
    header is 1), fields found, fields expected, and a preview. Blank lines are not
    records. With ``by_blocks`` many tasks read one file, and the numbers come from the
    sums that place its records."""
    parts = []
    for (names, utf8, crlf), files in sorted(files_by_layout(spark, glob).items()):
        schema = T.StructType(
            [*[T.StructField(f"c{i}", T.StringType()) for i in range(len(names))], T.StructField(_RAW, T.StringType())]
        )
        if by_blocks:
            rows = _parsed_records(spark, schema, sorted(files), utf8, crlf)
            place = F.col(_RECORD)
        else:
            rows = _options(spark, "UTF-8" if utf8 else "ISO-8859-1").schema(schema).option("columnNameOfCorruptRecord", _RAW)
            rows = rows.csv(sorted(files)).withColumn(_FILE, F.col("_metadata.file_path"))
            place = F.monotonically_increasing_id()
        # Spark refuses to read the raw-record column alone, hence the first cell beside it
        bad = F.when(F.col(_RAW).isNotNull(), F.rtrim(F.coalesce(_RAW, "c0"), F.lit("\r\n")))
        parts.append(rows.select(F.col(_FILE).alias("file"), place.alias("_at"), bad.alias("_raw"), F.lit(len(names)).alias("expected")))
    records = reduce(DataFrame.unionByName, parts)
    found = records.filter(F.col("_raw").isNotNull())
    if by_blocks:
        found = found.withColumn("record", F.col("_at"))
    else:
        # the reader gives a file with quoted line breaks to one task, so _at is consecutive in it; one
        # number per file is joined to the records that are reported, and no others are shuffled
        first = records.groupBy("file").agg(F.min("_at").alias("_first"))
        found = found.join(first, "file").withColumn("record", F.col("_at") - F.col("_first") + F.lit(2))
    return found.select(
        "file", "record", field_count(F.col("_raw")).alias("n_fields"), "expected",
        F.left("_raw", F.lit(PREVIEW_CHARS)).alias("preview"),
    )
