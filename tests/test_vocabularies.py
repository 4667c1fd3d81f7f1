"""Sequences and vocabularies held as tables."""

from __future__ import annotations

import random
import re
import time

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from glyphline.functions.symbols import (
    emoji_class, extract_symbols, has_symbol_seq, sequence_regex, sequence_trie, symbol_class, symbol_seq_count, trie_from_table,
)
from glyphline.operators.frequency import symbols_by_table

ALPHABET = "abcé🇫🇷👍🏽\u200d😂#\ufe0f\u20e3"
SEQUENCE = st.text(ALPHABET, min_size=1, max_size=5)


def _longest_first(sequences, text):
    pattern = "|".join(re.escape(s) for s in sorted(set(sequences), key=lambda s: (-len(s), s)))
    return re.findall(pattern, text)


@settings(max_examples=300, deadline=None)
@given(st.lists(SEQUENCE, min_size=1, max_size=40), st.text(ALPHABET, max_size=40))
def test_trie_finds_what_the_alternation_finds(spark, sequences, text):
    matcher = spark._jvm.java.util.regex.Pattern.compile(sequence_trie(sequences)).matcher(text)
    found = []
    while matcher.find():
        found.append(matcher.group())
    assert found == _longest_first(sequences, text)


@pytest.fixture(scope="module")
def many():
    rng = random.Random(1)
    starts = [chr(0x1F300 + k) for k in range(0, 600, 2)] + list("#*0123456789") + [chr(0x1F1E6 + k) for k in range(26)]
    out = set()
    while len(out) < 4000:
        s = rng.choice(starts) + "".join(rng.choices(["\u200d", "\ufe0f", "\U0001F3FD", *starts[:40]], k=rng.randint(0, 5)))
        out.add(s)
    return sorted(out)


def _texts(spark, many, n=300):
    rng = random.Random(2)
    words = ["plain", "words", "é", "#", "\u200d"] + many[:500] + [s[:-1] for s in many if len(s) > 1][:500]
    return [(i, "".join(rng.choices(words, k=rng.randint(0, 60)))) for i in range(n)] + [(-1, None), (-2, "")]


def test_thousands_of_sequences_in_spark(spark, many):
    rows = _texts(spark, many)
    table = spark.createDataFrame([(s,) for s in many] + [(many[0],), (None,), ("",)], "sequence string")
    pattern = trie_from_table(table)
    df = spark.createDataFrame(rows, "id bigint, text string")
    found = df.select(
        "id", extract_symbols("text", pattern).alias("x"), symbol_seq_count("text", pattern).alias("n"), has_symbol_seq(pattern, "text").alias("any")
    ).collect()
    for r in found:
        text = dict(rows)[r["id"]]
        expected = _longest_first(many, text or "")
        assert (r["x"] or []) == expected and r["n"] == len(expected) and r["any"] == bool(expected)


def test_cost_does_not_follow_the_number_of_sequences(spark, many):
    df = spark.range(2000).select(F.repeat(F.lit("plain words and # signs 👍🏽 "), 60).alias("text")).cache()

    def seconds(pattern):
        best = 1e9
        for _ in range(3):
            start = time.perf_counter()
            df.agg(F.sum(symbol_seq_count("text", pattern))).collect()
            best = min(best, time.perf_counter() - start)
        return best

    trie, few = seconds(sequence_trie(many)), seconds(sequence_trie(many[::400]))
    alternation = seconds(sequence_regex(many[::8]))
    df.unpersist()
    assert trie < 5 * few + 0.5
    assert trie < alternation


def test_no_sequences():
    with pytest.raises(ValueError):
        sequence_trie([])
    with pytest.raises(ValueError):
        sequence_trie([""])


def _by_table(spark, rows, symbols, **options):
    df = spark.createDataFrame(rows, "id bigint, title string, text string")
    vocab = spark.createDataFrame([(s,) for s in symbols], "symbol string")
    return sorted(map(tuple, symbols_by_table(df, vocab, "title", "text", keep=["id"], **options).collect()), key=repr)


def test_vocabulary_table_keeps_order_and_repeats(spark):
    rows = [
        (1, "👍", "a👍🏽b\n😂😂"), (2, None, "none"), (3, None, None), (4, "", ""), (4, "", ""), (None, "😂", "é"), (5, "x", "e\u0301é🇫🇷"),
    ]
    symbols = ["😂", "👍", "🏽", "é", "😂", None, "", "🇫🇷", "\n"]
    found = _by_table(spark, rows, symbols)
    expected = [
        (1, ["👍", "👍", "🏽", "\n", "😂", "😂"]), (2, []), (3, []), (4, []), (4, []), (None, ["😂", "é"]), (5, ["é"]),
    ]
    assert found == sorted(expected, key=repr)


def test_vocabulary_table_equals_the_class(spark, many):
    symbols = sorted({c for s in many for c in s})
    rows = [(i, "", t) for i, t in _texts(spark, many)]
    df = spark.createDataFrame(rows, "id bigint, title string, text string")
    by_class = df.select("id", F.coalesce(extract_symbols("text", symbol_class(symbols)), F.array().cast("array<string>")).alias("x"))
    assert _by_table(spark, rows, symbols) == sorted(map(tuple, by_class.collect()), key=repr)


def test_a_vocabulary_beyond_the_broadcast_size(spark, request):
    """Every code point of several planes, in rows that Spark would not broadcast by itself."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.autoBroadcastJoinThreshold"))
    vocab = spark.range(0x3400, 0x3400 + 27_000).select(
        F.decode(F.encode(F.expr("concat('\\\\u', lpad(hex(id), 4, '0'))"), "UTF-8"), "UTF-8").alias("name"), "id"
    ).select(F.decode(F.unhex(F.concat(F.lpad(F.hex("id"), 8, "0"))), "UTF-32").alias("symbol"))
    df = spark.createDataFrame([(1, "漢字 kanji 漢 かな"), (2, "none")], "id bigint, text string")
    found = symbols_by_table(df, vocab, "text", keep=["id"])
    assert sorted(map(tuple, found.collect())) == [(1, ["漢", "字", "漢"]), (2, [])]


def test_texts_do_not_move(spark):
    df = spark.createDataFrame([(1, "a")], "id bigint, text string")
    vocab = spark.createDataFrame([("a",)], "symbol string")
    plan = symbols_by_table(df, vocab, "text", keep=["id"])._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning(_row" in line]
    assert exchanges and "Python" not in plan
    assert emoji_class()
