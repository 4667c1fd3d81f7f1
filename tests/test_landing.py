"""Published results, datasets of several parts, and sketches that grow."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glyphline.operators import profile, reach
from glyphline.sources.contract import SchemaClash, census, common_type, read_parts, reconciled
from glyphline.sources.publish import ASIDE, Published, files_fingerprint, rows_fingerprint


@pytest.fixture
def cache(spark, tmp_path):
    return Published(spark, str(tmp_path / "cache"))


def _never(spark):
    return lambda: spark.sql("SELECT raise_error('computed again')")


def test_published_once_and_again_for_changed_input(spark, cache):
    rows = spark.range(10)
    assert cache.get(lambda: rows.filter("id > 3"), rows, version=1).count() == 6
    assert cache.get(_never(spark), rows.repartition(4), version=1).count() == 6
    changed = spark.range(11)
    assert cache.get(lambda: changed.filter("id > 3"), changed, version=1).count() == 7
    assert cache.get(lambda: rows.filter("id > 8"), rows, version=2).count() == 1


def test_a_killed_write_shows_nothing(spark, cache, tmp_path):
    rows = spark.range(100).repartition(4)
    broken = rows.withColumn("x", F.when(F.col("id") == 99, F.raise_error(F.lit("killed")).cast("bigint")).otherwise(F.col("id")))
    key = cache.key(rows)
    with pytest.raises(Exception, match="killed"):
        cache.publish(key, broken)
    assert not cache.exists(key)
    # a writer whose process ended leaves its folder, with whole files in it
    aside = tmp_path / "cache" / f"{ASIDE}{key}-dead"
    spark.range(5).write.parquet(str(aside))
    assert not cache.exists(key)
    assert cache.get(lambda: rows, rows).count() == 100
    assert cache.sweep(hours=1) == 0
    old = aside.stat().st_mtime - 7200
    os.utime(aside, (old, old))
    assert cache.sweep(hours=1) == 1 and not aside.exists()
    assert cache.get(_never(spark), rows).count() == 100


def test_of_two_writers_the_first_wins(spark, cache, tmp_path):
    cache.publish("k", spark.range(3))
    cache.publish("k", spark.range(7))
    assert cache.read("k").count() == 3
    assert [p.name for p in (tmp_path / "cache").iterdir() if not p.name.endswith(".crc")] == ["k"]


def test_fingerprints(spark, tmp_path):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (2, "y")], "id bigint, t string")
    assert rows_fingerprint(a) == rows_fingerprint(a.repartition(3))
    assert rows_fingerprint(a) != rows_fingerprint(a.distinct())
    assert rows_fingerprint(a) != rows_fingerprint(a.union(a.filter("id = 1")).union(a.filter("id = 1")))
    assert rows_fingerprint(a) != rows_fingerprint(a.withColumnRenamed("t", "u"))
    assert rows_fingerprint(a.limit(0)) == rows_fingerprint(a.filter("id > 9"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("x")
    before = files_fingerprint(spark, str(tmp_path / "in"))
    assert before == files_fingerprint(spark, str(tmp_path / "in"))
    (tmp_path / "in" / "a.csv").write_text("xy")
    assert before != files_fingerprint(spark, str(tmp_path / "in"))


@pytest.mark.parametrize(("a", "b", "both"), [
    ("int", "bigint", "bigint"), ("tinyint", "smallint", "smallint"), ("float", "double", "double"), ("int", "double", "double"),
    ("bigint", "double", None), ("string", "int", None), ("decimal(5,2)", "decimal(10,0)", "decimal(12,2)"),
    ("decimal(38,0)", "decimal(38,5)", None), ("void", "string", "string"), ("array<int>", "array<bigint>", "array<bigint>"),
    ("struct<a:int>", "struct<a:bigint,b:string>", "struct<a:bigint,b:string>"), ("struct<a:int>", "struct<a:string>", None),
    ("map<string,int>", "map<string,bigint>", "map<string,bigint>"), ("boolean", "int", None), ("date", "timestamp", None),
    ("date", "timestamp_ntz", "timestamp_ntz"),
])
def test_common_types(a, b, both):
    kind = lambda t: T.NullType() if t == "void" else T.StructType.fromDDL(f"x {t}").fields[0].dataType
    for x, y in ((a, b), (b, a)):
        found = common_type(kind(x), kind(y))
        assert (found.simpleString() if found is not None else None) == both


def _land(spark, root, **parts):
    for name, (rows, schema) in parts.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}")


def test_parts_read_as_one(spark, tmp_path, rows):
    _land(
        spark, tmp_path,
        a=([(1, 2, 1.5)], "id int, n int, f float"), b=([(2**40, 3, "x")], "id bigint, n int, tag string"),
        c=([("y", 5, 2.25)], "tag string, id bigint, n double"),
    )
    (tmp_path / "_SUCCESS").write_text("")
    (tmp_path / ".writing").mkdir()
    (tmp_path / "empty").mkdir()
    read = read_parts(spark, str(tmp_path))
    assert read.schema.simpleString() == "struct<id:bigint,n:double,f:float,tag:string>"
    assert rows(read) == sorted([(1, 2.0, 1.5, None), (2**40, 3.0, None, "x"), (5, 2.25, None, "y")], key=repr)
    assert len(census(spark, str(tmp_path))) == 3


def test_a_clash_names_the_parts(spark, tmp_path):
    _land(spark, tmp_path, a=([(1,)], "id int"), b=([(2,)], "id bigint"), c=([("x",)], "id string"))
    with pytest.raises(SchemaClash, match=r"id is string in .*/c and bigint in .*/b"):
        read_parts(spark, str(tmp_path))


def test_names_that_differ_in_case_clash():
    schema = lambda n: T.StructType([T.StructField(n, T.StringType())])
    with pytest.raises(SchemaClash, match="ID in two is id in one"):
        reconciled({"one": schema("id"), "two": schema("ID")})


def test_contract(spark, tmp_path, rows):
    _land(spark, tmp_path, a=([(1, "x")], "id int, t string"), b=([(2, 9)], "id bigint, more int"))
    path = str(tmp_path)
    assert rows(read_parts(spark, path, "t string, id bigint, later double")) == [("x", 1, None), (None, 2, None)]
    with pytest.raises(SchemaClash, match="beside the contract: .'more'."):
        read_parts(spark, path, "t string, id bigint", strict=True)
    with pytest.raises(SchemaClash, match="id is bigint in .* and int by contract"):
        read_parts(spark, path, "id int")
    with pytest.raises(SchemaClash, match="no column later"):
        read_parts(spark, path, "id bigint, later double not null")
    assert rows(read_parts(spark, path, "id bigint not null")) == [(1,), (2,)]
    with pytest.raises(Exception, match="t is null in file:.*/b/"):
        read_parts(spark, path, "t string not null").collect()
    with pytest.raises(SchemaClash, match="no part"):
        (tmp_path / "none").mkdir()
        read_parts(spark, f"{path}/none")


def _frame(spark, seed, n):
    rng = random.Random(seed)
    rows = [([rng.choice("abc") for _ in range(rng.randint(0, 4))], rng.choice([None, *range(3000)])) for _ in range(n)]
    return spark.createDataFrame(rows, "symbols array<string>, item_id bigint")


def test_sketches_of_parts_are_the_sketch_of_the_whole(spark, tmp_path, rows):
    parts = [_frame(spark, k, 1500) for k in range(3)]
    whole = parts[0].union(parts[1]).union(parts[2])
    for k, part in enumerate(parts):
        reach.update_reach(part, str(tmp_path / "r"), k)
    reach.update_reach(parts[1], str(tmp_path / "r"), 1)  # run again
    found = rows(reach.reach(reach.read_reach(spark, str(tmp_path / "r"))))
    once = reach.reach_sketches(whole)
    assert [r[:2] for r in found] == rows(once, "symbol", "reviews")
    # united with itself, so that both are estimates of united sketches
    direct = rows(reach.reach(reach.united(once, once)), "symbol", "items")
    assert [(s, n) for s, _, n in found] == direct
    exact = {r["symbol"]: r["items"] for r in profile.symbol_reach(whole).collect()}
    for symbol, items in direct:
        assert abs(items - exact[symbol]) <= reach.error_bound() * exact[symbol]
    reach.compact_reach(spark, str(tmp_path / "r"), str(tmp_path / "s"))
    assert rows(reach.reach(reach.read_reach(spark, str(tmp_path / "s")))) == found


def test_few_items_are_exact_and_nulls_count_as_none(spark, rows):
    df = spark.createDataFrame([(["a", "a"], "x"), (["a", "b"], None), (["b"], "y"), ([], "z")], "symbols array<string>, item_id string")
    sketches = reach.reach_sketches(df)
    assert rows(reach.reach(sketches)) == [("a", 2, 1), ("b", 2, 1)]
    a, b = (sketches.filter(F.col("symbol") == s).select(F.col("sketch").alias(s)) for s in "ab")
    assert a.join(b).select(reach.both("a", "b")).first()[0] == 0
