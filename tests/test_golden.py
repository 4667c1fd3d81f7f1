"""Hand-computed results (FIXTURES.md) and the semantic traps that concern values."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from glyphline.functions import fixed_values, symbols as sy
from glyphline.functions import text as tx
from glyphline.sources.tables import label_table
from glyphline.operators import dedup, emotion, frequency, groups, models, pairs, polarity, profile, sentiment, suggest, terms

VOCAB = sy.symbol_class("😂😭🔥👍🏽")


@pytest.fixture(scope="module")
def with_symbols(reviews):
    return frequency.with_symbols(reviews, VOCAB, "title", "text")


def test_extraction(with_symbols, rows):
    assert rows(with_symbols, "review_id", F.array_join("symbols", "")) == [
        (1, "😂😂😂🔥"),
        (2, "😭"),
        (3, "👍🏽😂"),
        (6, "🔥😂"),
    ]


def test_whole_emoji_class_finds_the_same(reviews, with_symbols, rows):
    every = frequency.with_symbols(reviews, sy.emoji_class(), "title", "text")
    assert rows(every, "review_id", "symbols") == rows(with_symbols, "review_id", "symbols")


def test_vocabulary_from_a_table(spark):
    vocab = spark.sql("SELECT explode(array('😂', '🔥', '🔥')) AS symbol")
    assert sy.class_from_table(vocab) == sy.symbol_class("😂🔥")
    many = [chr(0x4E00 + i) for i in range(12_000)]
    assert sy.class_from_table(spark.createDataFrame([(c,) for c in many], "symbol string")) == sy.symbol_class(many)
    with pytest.raises(ValueError):
        sy.class_from_table(vocab.limit(0))


def test_sequences_and_single_symbols_are_different_tests(spark, reviews, rows):
    """A flag passes the sequence test and holds no single symbol."""
    pattern = sy.emoji_sequence_patterns()
    found = reviews.filter(sy.has_symbol_seq(pattern, "title", "text"))
    assert rows(found, "review_id") == [(1,), (2,), (3,), (5,), (6,)]
    texts = spark.createDataFrame(
        [(1, "🇫🇷🇩🇪"), (2, "1️⃣ 2 # 3"), (3, "👩‍👩‍👧 ❤️"), (4, "👍🏽"), (5, "plain 12 #"), (6, None)], "id int, t string"
    )
    assert rows(texts.select("id", sy.symbol_seq_count("t", pattern))) == [(1, 2), (2, 1), (3, 2), (4, 1), (5, 0), (6, 0)]
    assert rows(texts.filter(sy.has_symbol("t", sy.emoji_class())).select("id")) == [(3,), (4,)]


def test_longest_sequence_first(spark, rows):
    df = spark.createDataFrame([("aab",)], "t string")
    pattern = sy.sequence_regex(["a", "aa", "aab"])
    assert rows(df.select(sy.symbol_seq_count("t", pattern))) == [(1,)]


def test_block_class(spark, rows):
    df = spark.createDataFrame([("😀 ✈ ☀ ■ x é 🤖",)], "t string")
    assert rows(df.select(F.size(sy.extract_symbols("t", sy.block_class())))) == [(5,)]


def test_classes_match_exactly_their_code_points(spark):
    """Every code point, against the plain list of ranges."""
    points = [c for c in range(1, 0x20000) if not 0xD800 <= c < 0xE000]
    text = spark.createDataFrame([("".join(map(chr, points)),)], "t string")
    wanted = set()
    for piece in fixed_values.EMOJI_RANGES.split():
        first, _, last = piece.partition("-")
        wanted |= set(range(int(first, 16), int(last or first, 16) + 1))
    (found,) = text.select(sy.extract_symbols("t", sy.emoji_class())).first()
    assert set(map(ord, found)) == wanted
    (blocks,) = text.select(sy.extract_symbols("t", sy.block_class())).first()
    assert set(map(ord, blocks)) == {c for a, b in fixed_values.SYMBOL_BLOCKS for c in range(a, b + 1)}


def test_white_space_is_unicode_white_space(spark):
    """The same characters as ``str.isspace``."""
    points = [c for c in range(1, 0x10000) if not 0xD800 <= c < 0xE000]
    text = spark.createDataFrame([("".join(map(chr, points)),)], "t string")
    (parts,) = text.select(tx.words("t")).first()
    assert "".join(parts) == "".join(chr(c) for c in points if not chr(c).isspace())
    (cleaned,) = text.select(tx.clean_text("t")).first()
    assert {c for c in cleaned if c.isspace()} == {chr(c) for c in points if chr(c).isspace()}
    assert {c for c in cleaned if not c.isspace()} == set("abcdefghijklmnopqrstuvwxyz")


def test_labels_are_symbols(spark):
    df = label_table(spark)
    assert df.count() == df.select("label").distinct().count() == 43
    assert df.filter(sy.has_symbol("symbol", sy.emoji_class())).count() == 43


def test_primary_category(reviews, rows):
    assert [c for (_, c) in rows(reviews.select("review_id", tx.primary_category("categories")))] == [
        "['Movies & TV'", "Drama", "Drama", "Comedy", "", "Comedy",
    ]


PROFILE = [
    ("😂", 5, 4.5, 0.866025, 3, 2, 1.333333, 3),
    ("🔥", 2, 5.0, 0.0, 2, 2, 1.0, 1),
    ("😭", 1, 1.0, 0.0, 1, 1, 0.0, 0),
    ("👍", 1, 3.0, 0.0, 1, 1, 2.0, 2),
    ("🏽", 1, 3.0, 0.0, 1, 1, 2.0, 2),
]


def test_profile(with_symbols, rows):
    assert rows(profile.symbol_profile(with_symbols)) == sorted(PROFILE, key=repr)


def test_profile_parts_agree(with_symbols, rows):
    parts = (
        profile.symbol_rating_stats(with_symbols)
        .join(profile.symbol_reach(with_symbols), "symbol")
        .join(profile.symbol_company(with_symbols), "symbol")
    )
    assert rows(parts) == sorted(PROFILE, key=repr)


def test_symbol_without_a_rating(spark, rows):
    df = spark.createDataFrame(
        [(["a", "a"], None, "x"), (["a", "b"], None, None), (["b"], 4.0, "y")],
        "symbols array<string>, rating double, item_id string",
    )
    assert rows(profile.symbol_profile(df)) == [
        ("a", 3, None, None, 2, 1, 0.5, 1),
        ("b", 2, 4.0, 0.0, 2, 1, 0.5, 1),
    ]


def test_pairs(with_symbols, rows):
    counts = pairs.cooccurrence_counts(with_symbols)
    assert rows(counts) == sorted(
        [("🔥", "😂", 2), ("🏽", "👍", 1), ("🏽", "😂", 1), ("👍", "😂", 1)], key=repr
    )
    matrix = {(r["row"], r["col"]): r["n"] for r in pairs.top_pair_matrix(counts, 1).collect()}
    assert matrix == {("🔥", "😂"): 2, ("😂", "🔥"): 2, ("🔥", "🔥"): 0, ("😂", "😂"): 0}
    scaled = {(r["row"], r["col"]): r["scaled"] for r in pairs.log_minmax(pairs.top_pair_matrix(counts, 1)).collect()}
    assert scaled == {("🔥", "😂"): 1.0, ("😂", "🔥"): 1.0, ("🔥", "🔥"): 0.0, ("😂", "😂"): 0.0}


def test_flat_matrix_has_no_scale(spark):
    flat = spark.createDataFrame([("a", "b", 3), ("b", "a", 3)], "row string, col string, n bigint")
    assert [r["scaled"] for r in pairs.log_minmax(flat).collect()] == [None, None]


def test_chi2(spark, rows):
    cells = spark.createDataFrame(
        [("g1", "a", 10), ("g2", "b", 10), ("g1", "c", 10), ("g2", "c", 10)], "g string, symbol string, n bigint"
    )
    assert rows(groups.chi2_from_cells(cells, "g")) == [("a", 10, 10.0), ("b", 10, 10.0), ("c", 20, 0.0)]


def test_chi2_support_does_not_change_the_margins(spark, rows):
    cells = spark.createDataFrame(
        [("g1", "a", 12), ("g2", "a", 8), ("g1", "rare", 4)], "g string, symbol string, n bigint"
    )
    (scored,) = groups.chi2_from_cells(cells, "g").collect()
    exp1, exp2 = 20 * 16 / 24, 20 * 8 / 24
    assert scored["chi2"] == pytest.approx((12 - exp1) ** 2 / exp1 + (8 - exp2) ** 2 / exp2)


def test_top_groups_break_ties_by_name_and_exclude_first(spark, rows):
    df = spark.createDataFrame(
        [("b", ["x"]), ("a", ["x", "x", "y"]), ("c", ["y"]), ("c", ["x"]), ("z", ["x"]), ("z", ["x"]), ("z", ["x"])],
        "g string, symbols array<string>",
    )
    top = groups.top_symbols_per_group(df, "g", top=2, n=1, exclude_groups=["z"])
    assert rows(top, "g", "symbol", "n") == [("a", "x", 1), ("c", "x", 1)]
    assert rows(groups.top_groups(df, "g", 2), "g", "rows") == [("c", 2), ("z", 3)]


@pytest.fixture(scope="module")
def lexicon(spark):
    return spark.sql(
        "SELECT * FROM VALUES ('good', 'pos'), ('all-around', 'pos'), ('bad', 'neg') AS t(word, polarity)"
    )


def test_polarity(spark, lexicon, rows):
    posts = spark.createDataFrame(
        [("x", "Good good BAD don't"), ("y", "nothing here"), ("z", "good all-around"), ("n", None)],
        "label string, text string",
    )
    counts = polarity.polarity_counts(posts, lexicon)
    shares = polarity.polarity_share(polarity.polarity_ratio(counts))
    assert rows(shares, "label", "pos", "neg", "ratio", "pos_share", "no_words") == [
        ("n", 0, 0, None, None, True),
        ("x", 2, 1, 2.0, 0.666667, False),
        ("y", 0, 0, None, None, True),
        ("z", 1, 0, None, 1.0, False),
    ]
    # entries the tokeniser cannot produce match only when they are normalised
    hyphen = spark.createDataFrame([("z", "good allaround")], "label string, text string")
    assert rows(polarity.polarity_counts(hyphen, polarity.normalise_lexicon(lexicon)), "pos") == [(2,)]


def test_cleaning(spark, rows):
    df = spark.createDataFrame(
        [("See https://a.b/c NOW!! 50% www.x.y ok",), ("one two don't",), (None,)], "t string"
    )
    assert rows(df.select(F.array_join(tx.words(tx.clean_text("t")), " "))) == [("",), ("one two dont",), ("see now ok",)]
    assert rows(df.select(F.array_join(tx.clean_words("t"), " "))) == [("",), ("one two dont",), ("see now ok",)]


def test_cloud_tokens(spark, rows):
    df = spark.createDataFrame([("The movie's 1984 café a I'm cafés 2b x's '90s",)], "t string")
    assert rows(df.select(F.array_join(tx.cloud_tokens("t"), " "))) == [("the movie café i'm cafés 2b x 90s",)]


def test_merge_plurals(spark, rows):
    df = spark.createDataFrame(
        [("cat", 3), ("cats", 2), ("dogs", 4), ("boss", 1), ("bos", 1), ("s", 1)], "word string, n bigint"
    )
    assert rows(terms.merge_plurals(df)) == [("bos", 1), ("boss", 1), ("cat", 5), ("dogs", 4), ("s", 1)]


def test_term_frequency_by_symbol(spark, rows):
    df = spark.createDataFrame(
        [(["a", "b"], "red red sun"), (["a"], "sun the"), (["c"], "moon"), (["b"], None)],
        "symbols array<string>, text string",
    )
    stop = spark.sql("SELECT 'the' AS word")
    found = terms.term_frequency_by_symbol(df, stop, "text", k=2).select("symbol", "word", "n")
    assert rows(found) == [("a", "red", 2), ("a", "sun", 2), ("b", "red", 2), ("b", "sun", 1)]


def test_collocations(spark, rows):
    lines = ["new york is big"] * 20 + ["new ideas are good", "york castle is old"] + ["filler words go here"] * 30
    df = spark.createDataFrame([(t,) for t in lines], "text string")
    found = terms.bigram_collocations(df, spark.sql("SELECT 'is' AS word"), threshold=30)
    pair = {(r["w1"], r["w2"]): r["c12"] for r in found.collect()}
    assert pair[("new", "york")] == 20
    assert not any("is" in p for p in pair)


def test_run_dedup(spark, rows):
    keys = ["a", "a", "b", "b", "a", None, None]
    df = spark.createDataFrame([(i, k, i > 1) for i, k in enumerate(keys, 1)], "i bigint, k string, p boolean")
    for size in (1, 2, 3, 100):
        kept = dedup.first_of_run(df, "i", "k", F.col("p"), bucket_rows=size)
        assert rows(kept, "i") == [(3,), (5,), (6,)]


def test_first_row_counts_as_different(spark, rows):
    df = spark.createDataFrame([(1, None), (2, None)], "i bigint, k string")
    assert rows(dedup.first_of_run(df, "i", "k", F.lit(True)), "i") == [(1,)]


def test_dedup(spark, rows):
    df = spark.createDataFrame(
        [(3, "x", None, [1]), (1, "x", None, [2]), (2, "x", 1, [3]), (4, None, None, None), (5, None, None, [4])],
        "id bigint, a string, b int, nested array<int>",
    )
    assert rows(dedup.dedup_scalar(df, "id"), "id", "a", "b", "nested") == [
        (1, "x", None, [2]), (2, "x", 1, [3]), (4, None, None, None),
    ]
    assert rows(dedup.dedup_key(df, "a", "id"), "id", "nested") == [(1, [2]), (4, None)]


def test_selectivity(reviews, rows):
    kept = dedup.selectivity(reviews, F.col("text").rlike(VOCAB))
    assert rows(kept) == [(4, 6, round(400 / 6, 6))]


def test_valence(spark, rows):
    valence = spark.sql("SELECT * FROM VALUES ('good', 2D), ('bad', -1D) AS t(word, valence)")
    df = spark.createDataFrame(
        [(1, "good good bad"), (2, "nothing"), (3, None), (4, "bad bad plain")], "id int, text string"
    )
    scores = sentiment.valence_score(df, valence, "text", "id")
    assert rows(scores, "id", "compound") == [
        (1, 0.612372), (2, 0.0), (3, 0.0), (4, round(-2 / 19**0.5, 6)),
    ]
    assert rows(sentiment.bucketed(scores), "id", "bucket") == [
        (1, "positive"), (2, "neutral"), (3, "neutral"), (4, "negative"),
    ]
    shares = sentiment.valence_shares(df, valence, "text", "id")
    assert rows(shares) == [
        (1, 0.8, 0.2, 0.0), (2, 0.0, 0.0, 1.0), (3, None, None, None), (4, 0.0, 0.666667, 0.333333),
    ]


def test_scores_that_differ_only_by_summing_order_tie(spark, rows):
    means = spark.createDataFrame([("b", 0.1 + 0.2, 1), ("a", 0.3, 1), ("c", -0.5, 1)], "symbol string, avg_sentiment double, n bigint")
    found = sentiment.sentiment_extremes(means, 1)
    assert rows(found, "symbol", "side") == [("a", "top"), ("c", "bottom")]
    scored = spark.createDataFrame([("b", 0.1 + 0.2), ("a", 0.3)], "symbol string, chi2 double")
    assert rows(groups.top_associations(scored, 1), "symbol") == [("a",)]


@pytest.fixture(scope="module")
def emotions(spark):
    return spark.sql(
        """SELECT * FROM VALUES ('sun', 'joy'), ('sun', 'trust'), ('rain', 'sadness'), ('war', 'fear'), ('war', 'anger')
        AS t(word, emotion)"""
    )


def test_emotions(spark, emotions, rows):
    df = spark.createDataFrame([(1, "sun sun rain"), (2, "war"), (3, "table"), (4, None)], "id int, text string")
    counts = emotion.emotion_counts(df, emotions, "text", "id")
    assert rows(counts) == [(1, "joy", 2), (1, "sadness", 1), (1, "trust", 2), (2, "anger", 1), (2, "fear", 1)]
    assert rows(emotion.dominant_emotion(counts, counts, "id")) == [(1, "joy", 2), (2, "anger", 1)]
    assert rows(emotion.labelled(df, emotions, "text", "id")) == [(1, "joy"), (2, "anger"), (3, None), (4, None)]
    assert rows(emotion.top_emotions(df, emotions, "text", "id", key="label_score")) == [(1, "trust", 0.4), (2, "fear", 0.5)]


def test_labelling_with_a_callable(spark, rows):
    def make():
        def score(text):
            if not text:
                raise ValueError("empty")
            return "loud" if text.isupper() else "calm"

        return score

    df = spark.createDataFrame([(1, "HEY"), (2, "hey"), (3, ""), (4, None)], "id int, text string")
    assert rows(emotion.label_with(df, make, "text"), "id", "emotion") == [(1, "loud"), (2, "calm"), (3, None), (4, None)]


@pytest.fixture(scope="module")
def model(spark):
    return spark.createDataFrame(
        [("joy", "😂", 5), ("joy", "🔥", 2), ("joy", "👍", 2), ("sad", "😭", 3)], "emotion string, symbol string, n bigint"
    )


@pytest.fixture(scope="module")
def texts(spark):
    known = [(i, "joy") for i in range(300)]
    return spark.createDataFrame(known + [(900, "sad"), (901, "rage"), (902, None)], "id bigint, emotion string")


def test_suggest_top_and_damped(texts, model, rows):
    top = {r["id"]: r["symbol"] for r in suggest.suggest_top(texts, model).collect()}
    assert (top[0], top[900], top[901], top[902]) == ("😂", "😭", None, None)
    assert rows(suggest.suggest_damped(texts, model)) == rows(suggest.suggest_top(texts, model))


def test_suggest_topk(texts, model, rows):
    picked = suggest.suggest_topk(texts, model, "id", k=3, exclude=["👍"])
    joy = [r["symbol"] for r in picked.filter("emotion = 'joy'").collect()]
    assert set(joy) == {"😂", "🔥"} and 90 < joy.count("😂") < 210
    assert rows(picked) == rows(suggest.suggest_topk(texts.repartition(3), model, "id", k=3, exclude=["👍"]))
    assert rows(picked) != rows(suggest.suggest_topk(texts, model, "id", k=3, seed=7, exclude=["👍"]))


def test_suggest_weighted_follows_the_counts(texts, model):
    joy = [r["symbol"] for r in suggest.suggest_weighted(texts, model, "id").filter("emotion = 'joy'").collect()]
    assert len(joy) == 300 and set(joy) == {"😂", "🔥", "👍"}
    assert 125 < joy.count("😂") < 210


def test_race_follows_the_counts(spark, model):
    """Shares of many draws lie within five deviations of the counts' shares, for the first and for the second pick."""
    n = 6000
    texts = spark.range(n).select("id", F.lit("joy").alias("emotion"))
    weights = {r["symbol"]: r["n"] for r in model.filter("emotion = 'joy'").collect()}
    total = sum(weights.values())
    picks = [r["symbols"] for r in suggest.suggest_picks(texts, model, "id", k=2).collect()]
    assert len(picks) == n and all(len(set(p)) == 2 for p in picks)
    for symbol, weight in weights.items():
        chance = weight / total
        spread = 5 * (n * chance * (1 - chance)) ** 0.5
        assert abs(sum(p[0] == symbol for p in picks) - n * chance) < spread
        # without replacement: the second is drawn from what the first leaves
        second = sum(w / total * weight / (total - w) for s, w in weights.items() if s != symbol)
        assert abs(sum(p[1] == symbol for p in picks) - n * second) < 5 * (n * second * (1 - second)) ** 0.5


def test_race_and_its_aggregate_agree(spark, texts, model, rows):
    once = rows(suggest.suggest_race(texts, model, "id"), "id", "emotion", "symbol")
    assert once == rows(suggest.suggest_race(texts.repartition(5), model, "id"), "id", "emotion", "symbol")
    assert once == rows(suggest.race_by_aggregate(texts, model, "id"), "id", "emotion", "symbol")
    assert once != rows(suggest.suggest_race(texts, model, "id", seed=7), "id", "emotion", "symbol")
    first = suggest.suggest_picks(texts, model, "id", k=1).select("id", "emotion", F.get("symbols", F.lit(0)).alias("symbol"))
    assert once == rows(first)


def test_race_changes_only_where_a_dropped_symbol_won(texts, model):
    before = {r["id"]: r["symbol"] for r in suggest.suggest_race(texts, model, "id").collect()}
    after = {r["id"]: r["symbol"] for r in suggest.suggest_race(texts, model, "id", exclude=["🔥"]).collect()}
    assert all(after[i] == s for i, s in before.items() if s != "🔥")
    assert any(s == "🔥" for s in before.values()) and "🔥" not in after.values()


def test_race_without_weight(spark, rows):
    model = spark.createDataFrame([("joy", "a", 0), ("joy", "b", 2), ("fear", "c", 0)], "emotion string, symbol string, n bigint")
    texts = spark.createDataFrame([(1, "joy"), (2, "fear"), (3, None), (4, "none")], "id bigint, emotion string")
    expected = [(1, "joy", "b"), (2, "fear", None), (3, None, None), (4, "none", None)]
    assert rows(suggest.suggest_race(texts, model, "id")) == expected
    assert rows(suggest.race_by_aggregate(texts, model, "id")) == expected


def test_first_present(spark, rows):
    df = spark.createDataFrame([(None, "x"), ("a", "y")], "a string, b string")
    assert rows(df.select(tx.first_present(df, ["missing", "a", "b"]))) == [("a",), (None,)]
    with pytest.raises(ValueError):
        tx.first_present(df, ["missing"])


def test_argmax_and_max_pair(spark, rows):
    df = spark.sql("SELECT map('b', 2, 'a', 2, 'c', 1) AS m, array(struct('a', 9.0D), struct('b', 1.0D)) AS p")
    assert rows(df.select(tx.argmax_label("m"), tx.max_pair("p")["col1"])) == [("a", "b")]


def test_standardize_uses_the_population_deviation(spark):
    df = spark.createDataFrame([(float(i), 7.0) for i in range(20)], "x double, flat double")
    scaled = models.standardize(df, ["x", "flat"]).orderBy("x").collect()
    assert scaled[0]["z_x"] == pytest.approx(-9.5 / 5.766281297335398)
    assert {r["z_flat"] for r in scaled} == {0.0}
