"""The end-to-end jobs, and word clouds against plain Python counting."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from glyphline.functions.symbols import symbol_class
from glyphline.operators import frequency, suggest, terms
from glyphline.plans import bindings as b
from glyphline.plans import flows

VOCAB = symbol_class("😂😭🔥👍🏽")


def _merged(counts: Counter) -> tuple[Counter, dict[str, str]]:
    out, form = Counter(), {}
    for word, n in counts.items():
        single = word[:-1] if word.endswith("s") and not word.endswith("ss") and word[:-1] in counts else word
        out[single] += n
        form[word] = single
    return out, form


def _log_l(k, n, x):
    return (k * math.log(x) if k else 0.0) + ((n - k) * math.log(1 - x) if n - k else 0.0)


def cloud_by_hand(texts: list[str], stop: set[str], threshold: float) -> dict[str, int]:
    words, pair_list = [], []
    for text in texts:
        found = [w.removesuffix("'s") for w in re.findall(r"\w[\w']+", text.lower())]
        found = [w for w in found if not w.isdigit()]
        words += [w for w in found if w not in stop]
        pair_list += [p for p in zip(found, found[1:]) if not set(p) & stop]
    counts, form = _merged(Counter(words))
    pair_counts, _ = _merged(Counter(" ".join(p) for p in pair_list))
    total, final = len(words), counts.copy()
    for pair, c12 in pair_counts.items():
        one, two = (form[w] for w in pair.split(" "))
        c1, c2 = counts[one], counts[two]
        if total <= c1 or total <= c2:
            continue
        p, p1, p2 = c2 / total, c12 / c1, (c2 - c12) / (total - c1)
        score = -2 * (
            _log_l(c12, c1, p) + _log_l(c2 - c12, total - c1, p)
            - _log_l(c12, c1, p1) - _log_l(c2 - c12, total - c1, p2)
        )
        if score > threshold:
            final[one] -= c12
            final[two] -= c12
            final[pair] = c12
    return {w: n for w, n in final.items() if n > 0}


@pytest.fixture(scope="module")
def cloud_texts():
    rng = random.Random(5)
    words = "car cars boss new york the castle castles tree's 1984 go goes red".split()
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 12))) for _ in range(120)]
    return texts + ["new york cars"] * 40 + ["new york car"] * 3 + ["old castles the red"] * 25


def test_cloud_frequencies(spark, cloud_texts):
    stop = {"the", "go"}
    df = spark.createDataFrame([(t,) for t in cloud_texts], "text string")
    words = spark.createDataFrame([(w,) for w in stop], "word string")
    found = {r["word"]: r["n"] for r in terms.cloud_frequencies(df, words, "text", threshold=10).collect()}
    expected = cloud_by_hand(cloud_texts, stop, 10)
    assert any(" " in w for w in expected)
    assert found == expected


def test_cloud_frequencies_per_corpus(spark, cloud_texts):
    rows = [("a" if i % 3 else "b", t) for i, t in enumerate(cloud_texts)]
    df = spark.createDataFrame(rows, "symbol string, text string")
    stop = spark.sql("SELECT 'the' AS word")
    found = terms.cloud_frequencies(df, stop, "text", "symbol", threshold=10).collect()
    for corpus in "ab":
        expected = cloud_by_hand([t for c, t in rows if c == corpus], {"the"}, 10)
        assert {r["word"]: r["n"] for r in found if r["symbol"] == corpus} == expected


def test_landing_to_suggestion(spark, reviews, tmp_path, rows):
    (counter,) = flows.land_reviews(reviews, f"{tmp_path}/landed", VOCAB).collect()
    assert (counter["kept"], counter["total"]) == (5, 6)
    landed = spark.read.parquet(f"{tmp_path}/landed").filter("n_symbols > 0")
    assert "GreaterThan(n_symbols,0)" in landed._jdf.queryExecution().executedPlan().toString()
    lexicon = spark.sql("SELECT * FROM VALUES ('loved', 'joy'), ('fine', 'joy'), ('sad', 'sadness') AS t(word, emotion)")
    model = flows.emotion_model(landed, lexicon)
    assert rows(model) == sorted(
        [("joy", "😂", 2), ("joy", "🔥", 1), ("joy", "👍", 1), ("joy", "🏽", 1), ("sadness", "😭", 1)], key=repr
    )
    texts = spark.createDataFrame([(1, "joy"), (2, "sadness"), (3, None)], "id bigint, emotion string")
    assert rows(suggest.suggest_top(texts, model), "id", "symbol") == [(1, "😂"), (2, "😭"), (3, None)]


def test_landing_drops_runs_of_a_title(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, "A", "🔥"), (2, "A", "😂"), (3, "B", "none"), (4, "B", "😂"), (5, "A", "🔥"), (6, None, "😭")],
        "review_id bigint, title string, text string",
    )
    flows.land_reviews(df, f"{tmp_path}/runs", VOCAB)
    kept = spark.read.parquet(f"{tmp_path}/runs")
    assert sorted(r["review_id"] for r in kept.collect()) == [1, 5, 6]


def test_landing_distinct_rows(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, "A", "🔥"), (2, "A", "🔥"), (3, "🇫🇷", "none"), (4, "B", "none"), (5, "A", "😂"), (6, None, "😂"), (7, None, "😂")],
        "review_id bigint, title string, text string",
    ).withColumn("tags", F.array(F.lit("t")))
    (counter,) = flows.land_distinct(df, f"{tmp_path}/distinct").collect()
    assert (counter["kept"], counter["total"]) == (4, 7)
    kept = spark.read.option("header", True).csv(f"{tmp_path}/distinct")
    assert sorted(r["review_id"] for r in kept.collect()) == ["1", "3", "5", "6"]


def test_usual_exclusions(spark, reviews, rows):
    found = flows.group_association(reviews, VOCAB, min_support=1).collect()
    assert {r["symbol"] for r in found} == set("😂😭🔥👍")
    assert "['Movies & TV'" not in {r["grp"] for r in found}
    model = spark.createDataFrame([("joy", "👍", 9), ("joy", "🏽", 8), ("joy", "🔥", 1)], "emotion string, symbol string, n bigint")
    texts = spark.createDataFrame([(1, "joy")], "review_id bigint, emotion string")
    assert rows(flows.suggestions(texts, model), "symbol") == [("🔥",)]
    assert rows(flows.suggestions(texts, model, k=1, without_tones=False), "symbol") == [("🏽",)]
    assert rows(flows.suggestions(texts, model, k=1, exclude=()), "symbol") == [("👍",)]


def test_symbol_map(spark, sf_dir):
    found = flows.symbol_map(b.rated_symbol_rows(spark, sf_dir)).collect()
    rated = [r for r in found if r["avg_rating"] is not None]
    assert len({r["cluster"] for r in rated}) == 5
    assert all((r["pca1"] is None) == (r["avg_rating"] is None) == (r["cluster"] is None) for r in found)
    assert all(r["labelled"] == (r["n"] > 10) for r in found)


def test_matrix_of_labelled_posts(spark, sf_dir):
    found = flows.cooccurrence_matrix(b.posts(spark, sf_dir), b.label_dimension(spark), b.VOCAB, k=5)
    cells = {(r["row"], r["col"]): r for r in found.collect()}
    assert all(cells[c, r]["n"] == cell["n"] for (r, c), cell in cells.items())
    assert max(c["scaled"] for c in cells.values()) == 1.0 and min(c["scaled"] for c in cells.values()) == 0.0


def test_association_shares(spark, reviews):
    found = flows.group_association(reviews, VOCAB, min_support=1, drop_symbols=["🏽"]).collect()
    shares: dict[str, float] = {}
    for r in found:
        shares[r["symbol"]] = shares.get(r["symbol"], 0) + r["share"]
    assert set(shares) == set("😂😭🔥👍")
    assert all(abs(s - 1) < 1e-9 for s in shares.values())


def test_clouds_and_polarity(spark, sf_dir):
    rows = b.symbol_rows(spark, sf_dir, "text")
    clouds = flows.symbol_clouds(rows, b.stopwords(spark), "text", k=3, max_words=20)
    tops = clouds.groupBy("symbol").agg(F.max("weight").alias("top"), F.count(F.lit(1)).alias("n")).collect()
    assert len(tops) == 3 and all(r["top"] == 1.0 and r["n"] == 20 for r in tops)
    found = flows.polarity_by_label(b.posts(spark, sf_dir), b.lexicon(spark))
    assert {"pos", "neg", "ratio", "pos_share", "neg_share", "no_words"} < set(found.columns)
    assert frequency.symbol_counts(rows).count() > 0
