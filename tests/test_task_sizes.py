"""What one task gets to read follows the input, and no fixed number of parts."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

PARTS = 7


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents and labels, the documents in PARTS files."""
    root = tmp_path_factory.mktemp("parts")
    text = F.concat(F.lit('the "é", and\n\nto '), F.repeat(F.lit("die! "), F.col("doc_id").cast("int") % 5), F.lit(","))
    docs = spark.range(70).select(
        F.col("id").alias("doc_id"), text.alias("text"), F.lit("en").alias("lang"), F.lit("src0").alias("source"),
        F.length(text).cast("bigint").alias("n_chars"),
    )
    docs.repartition(PARTS).write.parquet(f"{root}/documents.parquet")
    spark.range(70).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic").write.parquet(f"{root}/labels.parquet")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    yield str(root)
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_parts_of_quoted_reviews_are_landed_by_many_tasks(spark, folder, monkeypatch):
    from glyphline.plans import catalog_sources as c

    landed, write = [], c.tables.write_rows
    monkeypatch.setattr(c.tables, "write_rows", lambda df, *a, **k: (landed.append(df.rdd.getNumPartitions()), write(df, *a, **k)))
    found = c.s1_reviews_by_blocks(spark, folder)
    assert landed[0] >= PARTS
    body = F.concat(F.lit('"'), "text", F.lit('\n\n"\n,"",'))
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang", F.md5(body))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, docs.collect()))


def test_published_rows_are_dealt_to_as_many_tasks_as_they_are_read_by(spark, folder, monkeypatch):
    from glyphline.plans import catalog_sources as c

    dealt, get = [], c.Published.get
    monkeypatch.setattr(
        c.Published, "get", lambda self, how, rows, **k: (dealt.append(rows.rdd.getNumPartitions()), get(self, how, rows, **k))[1]
    )
    found = c.s8_published(spark, folder)
    assert min(dealt) >= PARTS
    assert sorted(map(tuple, found.groupBy("version").agg(F.sum("n")).collect())) == [("all", 70), ("even", 35)]


def test_buckets_of_long_texts_are_more(spark):
    from glyphline.operators import dedup

    rows = spark.range(128).select("id", F.floor(F.col("id") / 2).alias("k"), F.repeat(F.lit("x"), 1 << 20).alias("text"))
    assert len(dedup._borders(rows, "id", 1_000_000)) >= 3
    assert len(dedup._borders(rows.drop("text"), "id", 1_000_000)) == 1
    kept = dedup.first_of_run(rows, "id", "k", F.lit(True)).select("id", F.length("text").alias("n"))
    assert sorted(map(tuple, kept.collect())) == [(i, 1 << 20) for i in range(0, 128, 2)]


def test_the_stream_gets_as_many_files_as_the_table_is_read_in(spark, folder, monkeypatch):
    from glyphline.plans import catalog_scoring as c

    paths, scratch = {}, c.scratch_path
    monkeypatch.setattr(c, "scratch_path", lambda spark, name: paths.setdefault(name, scratch(spark, name)))
    found = c.g6_append_stream(spark, folder)
    assert len(spark.read.parquet(paths["landed"]).inputFiles()) >= PARTS
    batches = spark.read.text(f"{paths['append-state']}/commits").select(F.input_file_name()).distinct().count()
    assert 2 <= batches <= 3
    assert found.count() == 70


def test_packing_hands_few_texts_at_a_time_to_a_worker(spark, folder, monkeypatch):
    from glyphline.llm import packing as p

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    seen, write, before = {}, p.written, spark.conf.get(name)
    monkeypatch.setattr(p, "written", lambda df, at: (seen.update({at: int(spark.conf.get(name))}), write(df, at))[1])
    packed = p.pack(spark.read.parquet(f"{folder}/documents.parquet"))
    assert seen["pieces"] <= 500 and spark.conf.get(name) == before
    assert packed.select("doc_id").distinct().count() == 70


def test_collocations_of_a_cloud_are_computed_once(spark, rows):
    from glyphline.functions.text import cloud_tokens
    from glyphline.operators import terms

    texts = spark.createDataFrame([("Ice creams 12 ice cream's 7's It's x1 ٣٤ été",), ("ice cream one",), (None,), ("",)], "text string")
    assert [r[0] for r in texts.select(cloud_tokens("text")).collect()] == [
        ["ice", "creams", "ice", "cream", "it", "x1", "été"], ["ice", "cream", "one"], None, []
    ]
    stop = spark.createDataFrame([("it",)], "word string")
    found = terms.cloud_frequencies(texts, stop, "text", threshold=8)
    # words and pairs both come from the written collocations, so no join is left in the plan
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert rows(found) == [("ice cream", 3), ("one", 1), ("x1", 1), ("été", 1)]
    forms = spark.createDataFrame([("bus", 2), ("bu", 1), ("cats", 1), ("glass", 1), ("s", 1)], "word string, n int")
    assert rows(terms.merge_plurals(forms)) == [("bu", 3), ("cats", 1), ("glass", 1), ("s", 1)]
