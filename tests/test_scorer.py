"""Batches of a scorer: labels for any batch size, truncation, reasons, one load per worker."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from glyphline.operators import scorer


def _length_scorer(folder=None):
    def make():
        if folder:
            open(f"{folder}/{os.getpid()}-{random.random()}", "w").close()

        def score(texts):
            if any("boom" in t for t in texts):
                raise ValueError("boom in the batch")
            return [{"even": 0.5, "odd": 0.5, "none": 0.1} if not t else ("odd" if len(t.split()) % 2 else "even") for t in texts]

        return score

    return make


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices(["a", "bb", "ccc"], k=rng.randint(0, 40)))) for i in range(300)]
    rows += [(300, None), (301, "x boom y"), (302, ""), (303, "boom")]
    return spark.createDataFrame(rows, "id bigint, text string").repartition(3).cache()


def _labels(df):
    return sorted(map(tuple, df.select("id", "emotion", "reason", "truncated").collect()))


def test_labels_do_not_depend_on_the_batches(texts):
    found = _labels(scorer.label_batches(texts, _length_scorer(), "text", limit=10))
    for most, budget in ((1, 1), (7, 50), (1000, 10**6)):
        assert _labels(scorer.label_batches(texts, _length_scorer(), "text", limit=10, most=most, budget=budget)) == found
    by_id = {r[0]: r[1:] for r in found}
    assert by_id[301] == (None, "ValueError: boom in the batch", False) == by_id[303]
    assert by_id[300] == by_id[302] == ("even", None, False)
    for row in texts.filter("id < 300 AND text <> ''").collect():
        n = len(row["text"].split())
        assert by_id[row["id"]] == ("odd" if min(n, 10) % 2 else "even", None, n > 10)


def test_truncation_by_the_tokenizer_of_the_model(spark):
    def characters():
        return list, "".join

    def make():
        return lambda texts: list(texts)

    df = spark.createDataFrame([(1, "abcdef"), (2, "abc")], "id bigint, text string")
    found = scorer.label_batches(df, make, "text", make_tokenizer=characters, limit=4)
    assert _labels(found) == [(1, "abcd", None, True), (2, "abc", None, False)]
    assert _labels(scorer.label_batches(df, make, "text", limit=None))[0] == (1, "abcdef", None, False)


def test_one_load_per_worker(texts, tmp_path):
    scorer.label_batches(texts.repartition(12), _length_scorer(str(tmp_path)), "text").collect()
    loads = [p.name.split("-")[0] for p in tmp_path.iterdir()]
    assert 0 < len(loads) == len(set(loads))


def test_a_scorer_that_cannot_be_loaded_fails_the_job(texts):
    def make():
        raise OSError("no weights")

    with pytest.raises(Exception, match="cannot be loaded: OSError: no weights"):
        scorer.label_batches(texts, make, "text").collect()


def test_a_wrong_number_of_results_is_found_out(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, text string")
    found = _labels(scorer.label_batches(df, lambda: lambda texts: ["x"], "text"))
    assert found == [(1, "x", None, False), (2, "x", None, False)]
    found = _labels(scorer.label_batches(df, lambda: lambda texts: [], "text"))
    assert [r[2] for r in found] == ["ValueError: 0 results for 1 texts"] * 2


def test_runs_keep_to_both_limits():
    rng = random.Random(3)
    lengths = [rng.randint(0, 50) for _ in range(200)] + [500]
    found = list(scorer.runs(lengths, 8, 100))
    assert sorted(i for run in found for i in run) == list(range(201))
    for run in found:
        assert len(run) <= 8 and (len(run) == 1 or len(run) * max(lengths[i] for i in run) <= 100)
    assert list(scorer.runs([], 8, 100)) == []


def test_top_label():
    assert scorer.top_label({"b": 0.5, "a": 0.5}) == "a"
    assert scorer.top_label([("x", 0.1), ("y", 0.2)]) == "y"
    assert scorer.top_label("z") == "z" and scorer.top_label([]) is None and scorer.top_label(None) is None


def test_columns_stay(texts):
    found = scorer.label_batches(texts.withColumn("n", F.lit(1)), _length_scorer(), "text", out="mood")
    assert found.columns == ["id", "text", "n", "mood", "reason", "truncated"]
