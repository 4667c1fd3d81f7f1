"""Word lists, landed tables, written results and the compute-once cache."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from glyphline.functions.fixed_values import LABEL_SYMBOLS
from glyphline.functions.text import strip


def read_wordlist(spark: SparkSession, path: str) -> DataFrame:
    """Words of a text file: trimmed, lower case, no blanks, no repeats."""
    return (
        spark.read.text(path)
        .select(F.lower(strip("value")).alias("word"))
        .filter(F.col("word") != "")
        .distinct()
    )


def label_table(spark: SparkSession) -> DataFrame:
    """The known post labels and the symbol each stands for."""
    entries = F.array(*[F.struct(F.lit(k).alias("label"), F.lit(v).alias("symbol")) for k, v in LABEL_SYMBOLS.items()])
    return spark.range(1).select(F.inline(entries))


def polarity_lexicon(positive: DataFrame, negative: DataFrame) -> DataFrame:
    return positive.select("word", F.lit("pos").alias("polarity")).unionByName(
        negative.select("word", F.lit("neg").alias("polarity"))
    )


def read_dataset(spark: SparkSession, path: str) -> DataFrame:
    """A landed copy of the source dataset."""
    return spark.read.parquet(path)


def flat_for_csv(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text; the CSV sink takes no others."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.select(
        *[
            F.to_json(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, nested) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def write_rows(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: tuple[str, ...] = (),
    encoding: str = "UTF-8",
    mode: str = "errorifexists",
) -> None:
    """Write a table as Parquet, or as CSV with header and quoted line breaks."""
    if fmt == "csv":
        writer = (
            flat_for_csv(df)
            .write.option("header", True)
            .option("quoteAll", True)
            .option("escape", '"')
            .option("encoding", encoding)
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
        )
    else:
        writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.mode(mode).format(fmt).save(path)


def labelled_or_compute(spark: SparkSession, path: str, compute: Callable[[], DataFrame]) -> DataFrame:
    """The table at ``path``; computed and written there first when it is missing."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    compute().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
