"""Invariants, equal results of alternative plans, skew, and plan shapes."""

from __future__ import annotations

from itertools import combinations

import pytest
from pyspark.sql import Window, functions as F

import __spark_entry__ as contract
from glyphline.operators import dedup, emotion, frequency, groups, pairs, polarity, profile, sentiment, suggest
from glyphline.plans import bindings as b
from glyphline.plans.registry import CATALOG
from glyphline.session import checkpointed

JOINS = "spark.sql.autoBroadcastJoinThreshold"


@pytest.fixture(scope="module")
def rows_with_symbols(spark, sf_dir):
    cached = b.symbol_rows(spark, sf_dir, "doc_id", "lang", "source", "text").cache()
    yield cached
    cached.unpersist()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get(JOINS)
    spark.conf.set(JOINS, "-1")
    yield
    spark.conf.set(JOINS, before)


def test_shares_sum_to_one(spark, rows_with_symbols, sf_dir):
    shares = groups.row_share(groups.group_profile(rows_with_symbols, "source", 10))
    sums = shares.groupBy("symbol").agg(F.sum("share").alias("s"))
    assert sums.filter(F.abs(F.col("s") - 1) > 1e-9).count() == 0
    polar = polarity.polarity_share(polarity.polarity_counts(b.posts(spark, sf_dir), b.lexicon(spark)))
    assert polar.filter(~F.col("no_words") & (F.abs(F.col("pos_share") + F.col("neg_share") - 1) > 1e-9)).count() == 0


def test_pair_counts(rows_with_symbols):
    """Symmetric, never above either single count, and equal to plain Python counting."""
    counts = {(r["s1"], r["s2"]): r["n"] for r in pairs.cooccurrence_counts(rows_with_symbols).collect()}
    sets = [set(r["symbols"]) for r in rows_with_symbols.select("symbols").collect()]
    expected: dict[tuple[str, str], int] = {}
    single: dict[str, int] = {}
    for found in sets:
        for s in found:
            single[s] = single.get(s, 0) + 1
        for pair in combinations(sorted(found), 2):
            expected[pair] = expected.get(pair, 0) + 1
    assert counts == expected
    assert all(n <= min(single[x], single[y]) for (x, y), n in counts.items())
    matrix = {(r["row"], r["col"]): r["n"] for r in pairs.pair_matrix(pairs.cooccurrence_counts(rows_with_symbols)).collect()}
    assert all(matrix[y, x] == n for (x, y), n in matrix.items())


def test_chi2_is_zero_for_proportional_rows(spark):
    cells = spark.sql(
        """SELECT concat('g', g) AS g, concat('s', s) AS symbol, CAST(g * s * 10 AS BIGINT) AS n
        FROM (SELECT explode(sequence(1, 4)) AS g) LATERAL VIEW explode(sequence(1, 3)) AS s"""
    )
    assert groups.chi2_from_cells(cells, "g").filter(F.abs("chi2") > 1e-9).count() == 0


def test_result_does_not_depend_on_partitioning(rows_with_symbols, rows):
    once = rows(groups.top_symbols_per_group(rows_with_symbols, "lang"))
    again = rows(groups.top_symbols_per_group(rows_with_symbols.repartition(7), "lang"))
    assert once == again


@pytest.mark.parametrize("bucket_rows", [1, 7, 100, 1000, 10**6])
def test_bucketed_lag_equals_global_lag(spark, sf_dir, rows, bucket_rows):
    events = b.table(spark, sf_dir, "events").select("event_id", "event_type")
    gaps = events.filter("event_id < 90 OR event_id > 400").limit(600)
    before = F.lag(F.struct("event_type")).over(Window.orderBy("event_id"))
    expected = gaps.withColumn("b", before).filter("b IS NULL OR NOT (b.event_type <=> event_type)")
    kept = dedup.first_of_run(gaps, "event_id", "event_type", F.lit(True), bucket_rows)
    assert rows(kept, "event_id") == rows(expected, "event_id")


def test_negative_order_values(spark, rows):
    df = spark.createDataFrame([(i, k) for i, k in zip(range(-5, 5), "aabbaabbba")], "i bigint, k string")
    kept = dedup.first_of_run(df, "i", "k", F.lit(True), bucket_rows=3)
    assert rows(kept, "i") == [(-1,), (-3,), (-5,), (1,), (4,)]


def test_dedup_is_idempotent(spark, sf_dir, rows):
    docs = b.table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    once = dedup.dedup_scalar(docs, "doc_id")
    assert rows(once) == rows(dedup.dedup_scalar(once, "doc_id"))


def test_weighting_by_damped_count_never_changes_the_winner(spark, rows_with_symbols, rows):
    model = frequency.symbol_counts_by(rows_with_symbols.withColumnRenamed("lang", "emotion"), "emotion")
    texts = rows_with_symbols.select("doc_id", F.col("lang").alias("emotion"))
    assert rows(suggest.suggest_top(texts, model)) == rows(suggest.suggest_damped(texts, model))


def _lexicon_results(spark, sf_dir, rows):
    docs = b.documents(spark, sf_dir, "doc_id", "text")
    return [
        rows(polarity.polarity_counts(b.posts(spark, sf_dir), b.lexicon(spark))),
        rows(polarity.lexicon_hits(docs, b.lexicon(spark), "text", "doc_id")),
        rows(sentiment.valence_shares(docs, b.valence(spark), "text", "doc_id")),
        rows(emotion.labelled(docs, b.emotions(spark), "text", "doc_id")),
    ]


def test_large_lexicons_give_the_same_result(spark, sf_dir, rows, request):
    small = _lexicon_results(spark, sf_dir, rows)
    request.getfixturevalue("no_broadcast")
    assert _lexicon_results(spark, sf_dir, rows) == small


def test_one_group_with_a_third_of_all_rows(spark):
    """A hot group reaches the shuffle as one line per task and symbol, not per row."""
    df = spark.range(200_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 500)).alias("g"),
        F.when(F.col("id") % 2 == 0, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("a"))).alias("symbols"),
        (F.col("id") % 5).cast("double").alias("rating"),
        F.concat(F.lit("i"), F.col("id") % 7).alias("item_id"),
    )
    (hot,) = groups.top_symbols_per_group(df, "g", top=1, n=1).collect()
    assert (hot["g"], hot["symbol"], hot["n"]) == ("hot", "a", 66_667)
    found = {r["symbol"]: r for r in profile.symbol_profile(df).collect()}
    assert (found["a"]["n"], found["b"]["n"], found["a"]["items"]) == (200_000, 100_000, 7)


def test_a_text_full_of_symbols(spark):
    """The row's list must not be carried along with each of its symbols."""
    df = spark.sql(
        "SELECT flatten(array_repeat(array('a', 'b', 'c'), 50000)) AS symbols, 1.0D AS rating, 'x' AS item_id"
    )
    assert {r["n"] for r in profile.symbol_profile(df).collect()} == {50_000}
    assert {r["n"] for r in frequency.symbol_counts(df).collect()} == {50_000}


def test_checkpoint_uses_the_shared_folder(spark):
    assert checkpointed(spark.range(3)).count() == 3
    shared = spark.conf.get("spark.checkpoint.dir")
    assert spark.sparkContext.getCheckpointDir().removeprefix("file:").startswith(shared)


def test_sparse_ids_make_no_more_lines_than_buckets(spark):
    ids = spark.range(5000).select(F.xxhash64("id").alias("o"))
    borders = dedup._borders(ids, "o", 100)
    assert len(borders) <= 49
    buckets = ids.select(dedup._bucket_of(F.col("o"), borders).alias("b")).groupBy("b").count().collect()
    assert len(buckets) <= 50
    assert max(r["count"] for r in buckets) <= 300


def test_dedup_hashes_digests_and_sorts_no_text(spark, sf_dir):
    for name in ("d1_dedup_scalar", "d2_dedup_key"):
        plan = CATALOG[name][0](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "Sort [text" not in plan and "SortAggregate" not in plan, name


def test_emotions_need_no_sort_aggregate(spark, sf_dir):
    for name in ("e4_dominant_emotion", "e5_top_emotions", "g1_suggest_top", "g4_suggest_weighted", "j8_emotion_lookup"):
        plan = CATALOG[name][0](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan, name


def test_a_null_group_survives_exclusions(spark):
    df = spark.createDataFrame([("a", ["x"]), (None, ["x"]), (None, ["y"]), ("b", ["x"])], "g string, symbols array<string>")
    assert {r["g"] for r in groups.top_groups(df, "g", 5, exclude=["a"]).collect()} == {None, "b"}
    assert {r["g"] for r in groups.group_profile(df, "g", 5, exclude_groups=["a"]).collect()} == {None, "b"}
    assert {r["g"] for r in groups.association_cells(df, "g", 5, drop_groups=["a"]).collect()} == {None, "b"}


def test_a_matrix_loses_no_cell_in_silence(spark, rows):
    cells = spark.createDataFrame([("s", "de", 1), ("s", "it", 7)], "symbol string, lang string, n bigint")
    assert pairs.to_matrix(cells, "symbol", "lang", "n").columns == ["symbol", "de", "it"]
    with pytest.raises(Exception, match="outside the columns"):
        pairs.to_matrix(cells, "symbol", "lang", "n", ["de", "en"]).collect()
    assert rows(pairs.to_matrix(cells, "symbol", "lang", "n", ["de", "en"], checked=False)) == [("s", 1, 0)]


PYTHON_ALLOWED = {"e6_label_with", "e6_label_batches"}


def test_plans_have_no_cross_join_and_no_python(spark, sf_dir):
    for name, (run, _) in CATALOG.items():
        plan = run(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
        if name not in PYTHON_ALLOWED:
            assert "EvalPython" not in plan and "MapInPandas" not in plan, name


def test_top_k_needs_no_full_sort(spark, sf_dir):
    def plan(name):
        return contract.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()

    assert "TakeOrderedAndProject" in plan("t1_top_symbols")
    assert "WindowGroupLimit" in plan("w2_top_n_per_group")
    assert "WindowGroupLimit" in plan("a18_term_weights")
    # one scan: counts per group and symbol and the group ranking come from one aggregate
    assert plan("t5_top_symbols_per_group").count("FileScan") == 1
    assert plan("a12_chi2_association").count("FileScan") == 1
    assert plan("a7_symbol_profile").count("FileScan") == 2  # texts once, ratings once


def test_scans_read_only_what_is_needed(spark, sf_dir):
    plan = contract.queries()["a1_symbol_counts"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<text:string>" in plan


def test_a_matrix_has_a_bounded_width(spark, request):
    spark.conf.set("spark.sql.pivotMaxValues", "3")
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.pivotMaxValues"))
    cells = spark.range(4).selectExpr("'s' AS symbol", "concat('c', id) AS lang", "1L AS n")
    with pytest.raises(ValueError, match="more than 3 values"):
        pairs.to_matrix(cells, "symbol", "lang", "n")
    assert pairs.to_matrix(cells.filter("lang < 'c3'"), "symbol", "lang", "n").columns == ["symbol", "c0", "c1", "c2"]


def test_few_copies_move_no_row(spark):
    """Rows leave by a broadcast of the few later copies; nothing but digests is shuffled."""
    df = spark.range(5000).select(F.col("id"), F.concat(F.lit("text "), F.least("id", F.lit(4990))).alias("text"))
    kept = dedup.dedup_key(df, "text", "id")
    assert kept.agg(F.count("*"), F.max("id")).first() == (4991, 4990)
    rows = kept.collect()
    assert len(rows) == 4991
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "SortMergeJoin" not in plan.split("Initial Plan")[0]
