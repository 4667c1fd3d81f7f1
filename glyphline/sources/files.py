"""What a folder of CSV files holds, learned in one distributed pass over raw lines."""

from __future__ import annotations

import csv
import re
from collections import defaultdict
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F


def escaped(path: str) -> str:
    """A file's path for readers that take globs: characters that a glob gives a meaning are quoted."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def raw_lines(spark: SparkSession, glob: str | list[str]) -> DataFrame:
    """Undecoded lines with their file, the block they start in and their order.

    Lines end at ``\\n`` only. ``at`` grows inside a task, and a block is read by one
    task, so (block, at) orders the lines of a file.
    """
    return (
        spark.read.option("lineSep", "\n")
        .option("recursiveFileLookup", "true")
        .text(glob)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("at"),
            "value",
        )
    )


def profile_files(spark: SparkSession, glob: str | list[str]) -> DataFrame:
    """One line per file: header line, and whether every line is valid UTF-8.

    Only lines of a file's first block can be its header; the others are blanked before
    the aggregate.
    """
    candidate = F.when(F.col("block") == 0, F.col("value"))
    return raw_lines(spark, glob).groupBy("file").agg(
        F.min_by(candidate, F.when(F.col("block") == 0, F.col("at"))).alias("header"),
        F.bool_and(F.is_valid_utf8("value")).alias("utf8"),
    )


def column_names(header: str) -> list[str]:
    """Column names of a header line, without byte-order mark, unnamed and repeated
    names made distinct by position."""
    line = header.removeprefix("﻿").rstrip("\r")
    names: list[str] = []
    seen: dict[str, int] = defaultdict(int)
    for i, name in enumerate(next(csv.reader([line]), [])):
        name = name or f"Unnamed: {i}"
        seen[name] += 1
        names.append(name if seen[name] == 1 else f"{name}.{seen[name] - 1}")
    return names


def files_by_layout(spark: SparkSession, glob: str | list[str]) -> dict[tuple[tuple[str, ...], bool, bool], list[str]]:
    """(column names, is UTF-8, header ends in a carriage return) -> files. The driver sees one line per file,
    which is what it lists anyway to plan the read."""
    layouts: dict[tuple[tuple[str, ...], bool, bool], list[str]] = defaultdict(list)
    rows = profile_files(spark, glob).select("file", F.make_valid_utf8("header").alias("header"), "utf8")
    for row in rows.toLocalIterator():
        layouts[(tuple(column_names(row["header"])), row["utf8"], row["header"].endswith("\r"))].append(escaped(unquote(row["file"])))
    return layouts
