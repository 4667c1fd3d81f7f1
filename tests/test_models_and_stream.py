"""Clusters, projection, classifier, and scoring of streams."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from glyphline.operators import emotion, models, profile, suggest
from glyphline.plans import bindings as b
from glyphline.streaming.score import append_to, emotion_in_row, lookup_literal, score_batches, score_stream


@pytest.fixture(scope="module")
def symbol_profile(spark, sf_dir):
    cached = profile.symbol_profile(b.rated_symbol_rows(spark, sf_dir)).cache()
    yield cached
    cached.unpersist()  # other tests look at the plan of the same query


def test_clusters(symbol_profile):
    once = models.cluster_symbols(symbol_profile).groupBy("cluster").count().collect()
    again = models.cluster_symbols(symbol_profile).groupBy("cluster").count().collect()
    assert sorted(r["count"] for r in once) == sorted(r["count"] for r in again)
    assert len([r for r in once if r["cluster"] is not None]) == 5
    assert sum(r["count"] for r in once) == symbol_profile.count()


def test_unrated_symbols_stay(spark):
    features = ", ".join(f"{c} double" for c in profile.FEATURES)
    rated = [(f"s{i}", *[float((i * k) % 7) for k in range(1, len(profile.FEATURES) + 1)]) for i in range(12)]
    unrated = ("none", *[None if "rating" in c else 1.0 for c in profile.FEATURES])
    df = spark.createDataFrame([*rated, unrated], f"symbol string, {features}")
    assert [r["cluster"] for r in models.cluster_symbols(df, k=3).collect() if r["symbol"] == "none"] == [None]
    placed = models.pca2(df).collect()
    assert len(placed) == 13
    assert [(r["pca1"], r["pca2"]) for r in placed if r["symbol"] == "none"] == [(None, None)]


def test_no_symbol_is_cut_from_the_vocabulary(spark):
    df = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(300_000)), lambda i: i.cast("string")).alias("symbols"))
    assert len(models.symbol_vectors(df).vocabulary) == 300_000


def test_projection(symbol_profile):
    placed = models.pca2(symbol_profile).filter("pca1 IS NOT NULL").toPandas()
    scaled = models.standardize(symbol_profile).select(
        "symbol", *[f"z_{c}" for c in profile.FEATURES]
    ).toPandas().dropna().set_index("symbol").loc[placed["symbol"]]
    values = scaled.to_numpy()
    _, singular, axes = np.linalg.svd(values - values.mean(axis=0), full_matrices=False)
    for i in range(2):
        expected = values @ axes[i]
        got = placed[f"pca{i + 1}"].to_numpy()
        assert np.allclose(np.abs(got), np.abs(expected), atol=1e-6)
    assert placed["pca1"].var() >= placed["pca2"].var()
    assert abs(np.dot(placed["pca1"], placed["pca2"])) < 1e-6 * len(placed)


def test_classifier_learns_a_clear_rule(spark):
    df = spark.range(200).select(
        "id",
        F.when(F.col("id") % 2 == 0, F.array(F.lit("a"))).otherwise(F.array(F.lit("b"), F.lit("c"))).alias("symbols"),
        F.when(F.col("id") % 10 == 0, None).when(F.col("id") % 2 == 0, "joy").otherwise("fear").alias("emotion"),
    )
    model = models.fit_symbol_classifier(df, trees=10)
    predicted = models.predicted_labels(model, df)
    assert predicted.count() == 200
    assert predicted.filter("predicted = IF(id % 2 = 0, 'joy', 'fear')").count() == 200


@pytest.fixture(scope="module")
def landed(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("texts") / "docs")
    docs = b.table(spark, sf_dir, "documents").select("doc_id", "text")
    docs.repartition(3).write.parquet(path)
    return path, docs


@pytest.fixture(scope="module")
def model(spark):
    return spark.createDataFrame(
        [("joy", "ñ", 5), ("joy", "é", 2), ("sadness", "ü", 3), ("trust", "!", 1)], "emotion string, symbol string, n bigint"
    )


def test_stream_equals_batch(spark, landed, model, tmp_path, rows):
    path, docs = landed
    stream = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 1).parquet(path)
    run = (
        score_batches(stream, b.emotions(spark), model, f"{tmp_path}/out", "text", "doc_id")
        .option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
    )
    run.awaitTermination()
    labelled = emotion.labelled(docs, b.emotions(spark), "text", "doc_id")
    direct = suggest.suggest_topk(labelled, model, "doc_id").select("doc_id", "emotion", "symbol")
    found = spark.read.parquet(f"{tmp_path}/out").select("doc_id", "emotion", "symbol")
    assert rows(found) == rows(direct)


@pytest.fixture(scope="module")
def lines(spark, model, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("model") / "lines")
    suggest.folded_model(model).write.parquet(path)
    return spark.read.parquet(path)


def _run(spark, landed, lines, root, **options):
    path, docs = landed
    stream = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 1).parquet(path)
    scored = score_stream(stream, b.EMOTIONS, lines, "text", "doc_id").drop("text")
    run = append_to(scored, f"{root}/out", f"{root}/state").trigger(availableNow=True).start()
    run.awaitTermination()
    return run


def _direct(spark, landed, model):
    labelled = emotion.labelled(landed[1], b.emotions(spark), "text", "doc_id")
    return suggest.suggest_topk(labelled, model, "doc_id").select("doc_id", "emotion", "symbol")


def test_append_stream_equals_batch(spark, landed, model, lines, tmp_path, rows):
    run = _run(spark, landed, lines, tmp_path)
    assert run.lastProgress.batchId >= 2
    assert rows(spark.read.parquet(f"{tmp_path}/out"), "doc_id", "emotion", "symbol") == rows(_direct(spark, landed, model))


def test_append_stream_has_no_state(spark, landed, lines, tmp_path):
    run = _run(spark, landed, lines, tmp_path)
    assert run.lastProgress.stateOperators == []
    assert not (tmp_path / "state" / "state").exists()
    plan = run._jsq.explainInternal(True)
    assert "StateStore" not in plan and "Python" not in plan


@pytest.mark.parametrize("logged", [True, False])
def test_a_killed_batch_loses_and_doubles_nothing(spark, landed, model, lines, tmp_path, rows, logged):
    """The last batch is killed before it is reported as done, after or before its files are logged."""
    _run(spark, landed, lines, tmp_path)
    last = max(int(p.name) for p in (tmp_path / "state" / "commits").iterdir() if p.name.isdigit())
    killed = [tmp_path / "state" / "commits"] + ([] if logged else [tmp_path / "out" / "_spark_metadata"])
    for folder in killed:
        for name in (f"{last}", f".{last}.crc"):
            (folder / name).unlink(missing_ok=True)
    before = rows(spark.read.parquet(f"{tmp_path}/out"), "doc_id")
    assert (len(before) == landed[1].count()) == logged
    _run(spark, landed, lines, tmp_path)
    assert rows(spark.read.parquet(f"{tmp_path}/out"), "doc_id", "emotion", "symbol") == rows(_direct(spark, landed, model))


def test_new_files_are_appended(spark, landed, model, lines, tmp_path, rows):
    docs = spark.createDataFrame(landed[1].limit(7).collect(), landed[1].schema)
    path = str(tmp_path / "in")
    docs.write.parquet(path)
    _run(spark, (path, docs), lines, tmp_path)
    more = spark.createDataFrame([(-1, None), (-2, ""), (-3, "and la que")], docs.schema)
    more.write.mode("append").parquet(path)
    _run(spark, (path, docs), lines, tmp_path)
    found = {r["doc_id"]: (r["emotion"], r["symbol"]) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert len(found) == 10 and found[-1] == found[-2] == (None, None) and found[-3][0] == "joy"


def test_emotion_in_row_breaks_ties_by_name(spark):
    look_up = lookup_literal([("x", "joy"), ("y", "fear"), ("y", "joy"), ("z", "anger")], "string")
    df = spark.createDataFrame([("x z",), ("y",), ("x y",), ("z z y",), ("none",), (None,)], "text string")
    found = [r["emotion"] for r in emotion_in_row(df, look_up, "text").collect()]
    assert found == ["anger", "fear", "joy", "anger", None, None]


def test_cluster_quality_finds_wrong_centres(spark, symbol_profile, monkeypatch):
    good = models.cluster_quality(symbol_profile).first()
    assert good["clusters"] == 5 and good["centre_gap"] < 1e-9 and good["spread"] < 0.5
    fitted = models.fit_clusters

    def shuffled(profile, k=5, seed=42, cols=profile.FEATURES):
        placed, model = fitted(profile, k, seed, cols)
        number = F.when(F.col("cluster").isNotNull(), F.pmod(F.xxhash64("symbol"), F.lit(k)).cast("int"))
        return placed.withColumn("cluster", number), model

    monkeypatch.setattr(models, "fit_clusters", shuffled)
    bad = models.cluster_quality(symbol_profile).first()
    assert bad["centre_gap"] > 0.1 and bad["spread"] > good["spread"]


def test_held_out_accuracy(spark):
    df = spark.range(400).select(
        "id",
        F.when(F.col("id") % 3 == 0, F.array(F.lit("a"))).otherwise(F.array(F.lit("b"), F.lit("c"))).alias("symbols"),
        F.when(F.col("id") % 50 == 1, None).when(F.col("id") % 3 == 0, "joy").otherwise("fear").alias("emotion"),
    )
    test = F.col("id") % 4 == 0
    found = models.held_out_accuracy(df, test, trees=10).first()
    held = df.filter(test & F.col("emotion").isNotNull())
    assert found["rows"] == found["right"] == held.count()
    assert found["majority"] == held.filter("emotion = 'fear'").count()
    noise = df.withColumn("symbols", F.array(F.lit("x")))
    found = models.held_out_accuracy(noise, test, trees=5).first()
    assert found["right"] == found["majority"] < found["rows"]
