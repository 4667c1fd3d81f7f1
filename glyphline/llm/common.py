"""Shared pieces of the training-data operators: words, row keys and written intermediate tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from glyphline.plans.registry import Query
from glyphline.session import scratch_path

#: One word: a run of anything but space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"

CATALOG: dict[str, tuple[Query, str | None]] = {}


def query(sql: str | None = None):
    """Register a training-data query under its function name."""

    def register(run: Query) -> Query:
        CATALOG[run.__name__] = (run, sql)
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: str | Column) -> Column:
    """The text, or the empty text where there is none."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def text_key(text: str | Column) -> Column:
    """A key of a text for joins that also compare the document's id."""
    return F.xxhash64(whole(text))


def as_text(column: str) -> Column:
    """An id on its way through pandas, which would turn long integers beside a null to doubles."""
    return F.col(column).cast("string")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder: lineage ends here, and a lost executor
    costs a read instead of the work before."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)
