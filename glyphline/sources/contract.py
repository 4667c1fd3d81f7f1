"""Reading a landed dataset whose parts were written at different times, under one schema.

A census takes the schema of each part (a file or folder below the dataset's path, as batches land them). Columns
are matched by name and their types reconciled: a column may be missing from a part or be narrower there.
Types that no common type holds without loss are a clash, and the error names the parts and the column.
The read then has an explicit schema: no part's schema is taken for that of all, and nothing is cast
in silence.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

READERS = 16
INTEGERS = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]


class SchemaClash(ValueError):
    """Parts, or a part and the contract, that do not go together."""


def common_type(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The narrowest type that holds all values of both, None where there is none."""
    if a == b:
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(b, T.NullType):
        return a
    if a in INTEGERS and b in INTEGERS:
        return max(a, b, key=INTEGERS.index)
    floats = (T.FloatType(), T.DoubleType())
    if a in floats and b in floats:
        return T.DoubleType()
    for x, y in ((a, b), (b, a)):
        # a double holds every 32-bit integer
        if x in INTEGERS[:3] and y == T.DoubleType():
            return y
        if isinstance(x, T.DateType) and isinstance(y, T.TimestampNTZType):
            return y
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        precision = max(a.precision - a.scale, b.precision - b.scale) + scale
        return T.DecimalType(precision, scale) if precision <= 38 else None
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        element = common_type(a.elementType, b.elementType)
        return None if element is None else T.ArrayType(element)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        key, value = common_type(a.keyType, b.keyType), common_type(a.valueType, b.valueType)
        return None if key is None or value is None else T.MapType(key, value)
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        fields = {f.name: f.dataType for f in a.fields}
        for f in b.fields:
            found = common_type(fields[f.name], f.dataType) if f.name in fields else f.dataType
            if found is None:
                return None
            fields[f.name] = found
        return T.StructType([T.StructField(n, t) for n, t in fields.items()])
    return None


def parts_of(spark: SparkSession, path: str) -> list[str]:
    """The files and folders directly below a path, those that Spark would read; the path itself for a file."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)
    names = [(s.getPath().getName(), s.getPath().toString()) for s in found]
    return sorted(p for n, p in names if not n.startswith((".", "_")) or "=" in n)


def census(spark: SparkSession, path: str) -> dict[str, T.StructType]:
    """The schema of every part, from one footer each. Parts that hold no file have none."""

    def schema(part: str) -> T.StructType | None:
        try:
            return spark.read.parquet(part).schema
        except AnalysisException as empty:
            if empty.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
            return None

    parts = parts_of(spark, path)
    with ThreadPoolExecutor(READERS) as pool:
        return {p: s for p, s in zip(parts, pool.map(schema, parts)) if s is not None}


def reconciled(schemas: dict[str, T.StructType]) -> T.StructType:
    """One schema for all parts, columns in the order in which they first occur.

    Names that differ in case only are a clash, as Spark would take them for one column.
    """
    found: dict[str, tuple[str, T.DataType, str]] = {}
    for part, schema in schemas.items():
        for field in schema.fields:
            name, kind, first = found.get(field.name.lower(), (field.name, field.dataType, part))
            if name != field.name:
                raise SchemaClash(f"{field.name} in {part} is {name} in {first}")
            both = common_type(kind, field.dataType)
            if both is None:
                raise SchemaClash(
                    f"{name} is {field.dataType.simpleString()} in {part} and {kind.simpleString()} in {first}"
                )
            # the part named in a clash is the one that made the type what it is
            found[name.lower()] = (name, both, part if both != kind else first)
    return T.StructType([T.StructField(name, kind) for name, kind, _ in found.values()])


def checked(schema: T.StructType, contract: T.StructType, strict: bool, path: str) -> T.StructType:
    """The contract's columns, where what the parts hold fits into them."""
    held = {f.name: f.dataType for f in schema.fields}
    for field in contract.fields:
        if field.name not in held:
            if not field.nullable:
                raise SchemaClash(f"{path} has no column {field.name}, which must not be null")
        elif common_type(held[field.name], field.dataType) != field.dataType:
            raise SchemaClash(
                f"{field.name} is {held[field.name].simpleString()} in {path} and {field.dataType.simpleString()} by contract"
            )
    more = [n for n in held if n not in contract.names]
    if strict and more:
        raise SchemaClash(f"{path} has columns beside the contract: {more}")
    return contract


def read_parts(
    spark: SparkSession, path: str, contract: T.StructType | str | None = None, strict: bool = False
) -> DataFrame:
    """The rows of all parts under one schema: the reconciled one, or the contract's columns in its order.

    A column that a part lacks is null there; a column the contract lacks is not read, or an error when
    ``strict``; a null in a column that the contract calls not null is an error when its row is read.
    """
    schemas = census(spark, path)
    if not schemas:
        raise SchemaClash(f"no part in {path} holds data")
    schema = reconciled(schemas)
    if contract is None:
        return spark.read.schema(schema).parquet(*schemas)
    wanted = T.StructType.fromDDL(contract) if isinstance(contract, str) else contract
    wanted = checked(schema, wanted, strict, path)
    rows = spark.read.schema(wanted).parquet(*schemas)

    def column(field: T.StructField):
        value = F.col(f"`{field.name}`")
        if field.nullable:
            return value
        complaint = F.concat(F.lit(f"{field.name} is null in "), F.col("_metadata.file_path"))
        kind = field.dataType.simpleString()
        return F.coalesce(value, F.raise_error(complaint).cast(kind)).alias(field.name)

    return rows.select(*[column(f) for f in wanted.fields])
