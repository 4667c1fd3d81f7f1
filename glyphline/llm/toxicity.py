"""Toxicity of texts whose words may be disguised, by a noisy channel.

A character language model is counted over all texts. A token with digits or marks among
its letters, with long repetitions or with its letters spaced out is a lattice of what each
character may stand for; the Viterbi path under the model and the channel's costs restores it.
Chances of restored words and their beginnings, learned from labelled rows, are then
combined to a probability for the restored text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from glyphline.llm.common import as_text, query, table, whole, written

#: Labelled rows the classifier is fitted on at most; that bounds the words that can become features.
FIT_ROWS = 20_000
#: Families of texts that must have a word, words that must have a beginning, and how clearly a word
#: must point to toxic texts.
MIN_FAMILIES = 3
MIN_WORDS = 8
MIN_Z = 3.0
#: A feature whose texts are toxic less often says nothing of a text that is short of other signs.
MIN_SHARE = 0.4
PREFIXES = (4, 5)
#: Clean texts that every word is taken to have been seen in besides, and clean words of a beginning.
PRIOR = 8
#: The worst word of a text counts in full, the second by this share, each further one half as much as the one before:
#: long texts are no worse for their length.
SECOND = 1 / 3
THRESHOLD = 0.3
CACHE = 300_000

#: What a character may stand for beside itself.
LOOKS = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s",
    "!": "il", "|": "il", "+": "t", "*": "aeiou", "€": "e", "£": "l", "(": "c", "<": "c", "¡": "i", "#": "h", "%": "x",
}
#: Channel costs, as log probabilities: a look-alike; a character dropped that looks like no letter, or
#: that does; a repeated letter merged, or a repeated look-alike.
LOOK, DROP, DROP_LOOK, MERGE, MERGE_LOOK = -0.7, -2.0, -10.0, -0.5, -4.0
#: A look-alike dropped at either end of a token, where it may be punctuation; a word's end between letters spaced out.
DROP_END, BREAK = -1.0, -0.5
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7)
SIZE = len(LETTERS) + 1  # 0 is the border of a word
_NUMBER = {c: i + 1 for i, c in enumerate(LETTERS)}
_CODES = np.zeros(256, np.int64)
_CODES[[ord(c) for c in LETTERS]] = np.arange(1, SIZE)

_ENDS = ".,;:!?\"'`)]}>*$%&#|-_~…»”’"
_STARTS = "\"'`([{<*%&#|-_~«“‘.,;:"
_SPACED = re.compile(r"(?<!\S)\S(?:[ _.\-]\S){2,}(?!\S)")
_LONG = re.compile(r"(.)\1\1")
_DOUBLE = re.compile(r"(.)\1")
_SPLIT = re.compile(r"[-'’./_,;:?&=]+")
#: Marks at the ends of a token that look like letters; the others go.
_MARKS = "".join(c for c in _ENDS + _STARTS if c in LOOKS)
_PLAIN_ENDS, _PLAIN_STARTS = ("".join(c for c in marks if c not in LOOKS) for marks in (_ENDS, _STARTS))


def _trigrams(texts: DataFrame) -> DataFrame:
    """code, n: how often three characters follow each other, over all texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(SIZE**3, np.int64)
        for batch in batches:
            for text in batch["text"]:
                raw = np.frombuffer(f"  {text.lower()}  ".encode("latin-1", "replace"), np.uint8)
                for at in range(0, len(raw), 1 << 20):  # blocks overlap by two characters
                    c = _CODES[raw[at : at + (1 << 20) + 2]]
                    total += np.bincount((c[:-2] * SIZE + c[1:-1]) * SIZE + c[2:], minlength=SIZE**3)
        used = np.flatnonzero(total)
        yield pd.DataFrame({"code": used, "n": total[used]})

    return texts.mapInPandas(run, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n"))


def language_model(texts: DataFrame) -> np.ndarray:
    """log P(c | a, b) as an array over three characters: counts smoothed by those of shorter contexts.

    The table is as large as the alphabet allows, whatever the number of texts.
    """
    counts = np.zeros(SIZE**3)
    for row in _trigrams(texts).collect():
        counts[row["code"]] = row["n"]
    three = counts.reshape(SIZE, SIZE, SIZE)
    three[0, 0, 0] = 0
    two, one = three.sum(axis=0), three.sum(axis=(0, 1))
    p1 = (one + 1) / (one.sum() + SIZE)
    p2 = (two + 5 * p1) / (two.sum(axis=1, keepdims=True) + 5)
    p3 = (three + 5 * p2[None]) / (three.sum(axis=2, keepdims=True) + 5)
    return np.log(p3).astype(np.float32)


def moves(token: str, at: int, state: tuple[int, int], model: np.ndarray, spaced: bool, inner: range):
    """What the channel may do at one character: (next state, log probability, letter or 0, whether a word ended before).

    A state is the last two letters. A letter stands for itself, or merges with the letter before it that it
    repeats; another character stands for what it looks like, merges with the same one before it, or is dropped. In a
    token of letters spaced out a word may end before each of them. ``inner`` are the places between the marks at the ends.
    """
    char, (a, b) = token[at], state
    letter = _NUMBER.get(char)
    options = [(letter, 0.0)] if letter else [(_NUMBER[c], LOOK) for c in LOOKS.get(char, "")]
    repeated = at > 0 and token[at - 1] == char
    for c, cost in options:
        yield (b, c), cost + model[a][b][c], c, False
        if spaced and b:
            yield (0, c), cost + BREAK + model[a][b][0] + model[b][0][c], c, True
    if letter:
        if repeated:
            yield state, MERGE, 0, False
    else:
        lost = (DROP_LOOK if at in inner else DROP_END) if options else DROP
        yield state, max(lost, MERGE_LOOK) if options and repeated else lost, 0, False


def _inner(token: str) -> range:
    return range(len(token) - len(token.lstrip(_MARKS)), len(token.rstrip(_MARKS)))


def decode(token: str, model: np.ndarray, spaced: bool = False) -> str:
    """The likeliest word behind a token, or words with a space between them: Viterbi over the last two letters.

    ``model`` is an array, or the same as lists, which are read faster one number at a time.
    """
    # a state's score, and its path as a chain of (what came before, letter, whether a word ended)
    states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    inner = _inner(token)
    for at, char in enumerate(token):
        reached: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        letter = _NUMBER.get(char)
        if letter and not spaced and not (at and token[at - 1] == char):  # the only move: the letter stands for itself
            for (a, b), (score, path) in states.items():
                value = score + model[a][b][letter]
                if (b, letter) not in reached or value > reached[b, letter][0]:
                    reached[b, letter] = (value, (path, letter, False))
        else:
            for state, (score, path) in states.items():
                for to, cost, c, broken in moves(token, at, state, model, spaced, inner):
                    if to not in reached or score + cost > reached[to][0]:
                        reached[to] = (score + cost, (path, c, broken) if c else path)
        states = reached
    _, (_, path) = max(states.items(), key=lambda item: item[1][0] + model[item[0][0]][item[0][1]][0])
    word = []
    while path:
        path, c, broken = path
        word.append((" " if broken else "") + LETTERS[c - 1])
    return "".join(reversed(word))


def restored(token: str, model: np.ndarray) -> list[str]:
    """The words of one lower-case token without white space; where marks at its ends or doubled letters may be
    part of a disguise, the word as it stands and the restored one."""
    token = token.lstrip(_PLAIN_STARTS).rstrip(_PLAIN_ENDS)
    core = token.strip(_MARKS + _PLAIN_ENDS + _PLAIN_STARTS)
    if not token:
        return []
    if token.isalpha() and not _LONG.search(token):
        return [token, decode(token, model)] if _DOUBLE.search(token) else [token]
    pieces = [p for p in _SPLIT.split(token) if p]
    if len(pieces) > 2 and all(len(p) == 1 for p in pieces):
        return _spaced("".join(pieces), model)
    if len(pieces) > 1:
        return [w for p in pieces for w in restored(p, model)]
    if not any(c.isalpha() for c in token):
        return []
    found = [w] if (w := decode(token, model)) else []
    if core != token and core.isalpha() and not _LONG.search(core):
        found.append(core)
    return found


def _spaced(letters: str, model: np.ndarray) -> list[str]:
    """The words behind letters that stood apart."""
    if not any(c.isalpha() for c in letters):
        return []
    return [w for w in decode(letters, model, spaced=True).split(" ") if w]


def _tokens(text: str) -> set[str]:
    """The distinct lower-case tokens of a text; letters spaced out are one token, a space before it, beside themselves."""
    text = text.lower()
    found = set(text.split())
    found.update(" " + re.sub(r"[ _.\-]", "", m.group()) for m in _SPACED.finditer(text))
    return found


class _Words(dict):
    """Token to its restored words, kept for tokens that come again."""

    def __init__(self, model: np.ndarray):
        self.model = model.tolist()

    def __missing__(self, token: str) -> tuple[str, ...]:
        if len(self) >= CACHE:
            self.clear()
        found = _spaced(token[1:], self.model) if token[0] == " " else restored(token, self.model)
        words = self[token] = tuple(dict.fromkeys(found))
        return words


def beginnings(word: str) -> list[str]:
    return [word[:n] + "-" for n in PREFIXES if len(word) > n]


def _family(text: str) -> int:
    """One min-hash over three-word shingles: copies of a text, with few words changed, mostly agree."""
    words = text.lower().split()
    shingles = (" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2)))
    return min(xxhash.xxh64_intdigest(s) for s in shingles) >> 1


def _examples(docs: DataFrame, labels: DataFrame, held: Column, model) -> DataFrame:
    """label, words of one text of each family among the rows to fit on."""
    known = labels.filter(F.col("label").isNotNull() & F.col("id").isNotNull() & ~held)
    known = known.groupBy("id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("id"), "id").limit(FIT_ROWS)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = _Words(model.value)
        for batch in batches:
            rows = [
                (_family(text), label, sorted({w for t in _tokens(text) for w in words[t]}))
                for text, label in zip(batch["text"], batch["label"])
            ]
            yield pd.DataFrame(rows, columns=["family", "label", "words"])

    # FIT_ROWS rows of two numbers, so this side is sent to every task
    rows = docs.join(F.broadcast(known), F.col("doc_id") == F.col("id")).select("text", "label")
    found = rows.mapInPandas(run, "family bigint, label int, words array<string>")
    return found.dropDuplicates(["family", "label"])


def _weights(examples: DataFrame) -> dict[str, float]:
    """Chances of words and of beginnings of words.

    A word's chance is the share of toxic texts among the texts with it, drawn towards zero by
    PRIOR texts, so that a rare word proves little. A beginning, for words that are new, is
    judged by the *different* words with it: those that are mostly in toxic texts, against the
    others. One frequent word says nothing of words that merely begin alike; words seen often
    enough under a kept beginning keep their own chance, if only none.
    """
    totals = examples.groupBy("label").agg(F.count("*").alias("n")).collect()
    n = {r["label"]: r["n"] for r in totals}
    toxic, clean = n.get(1, 0), n.get(0, 0)
    words = examples.select("label", F.explode("words").alias("feature")).groupBy("feature").agg(
        F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b")
    )
    words = written(words, "words")
    odds = F.log((F.col("a") + 0.5) / (toxic + 1)) - F.log((F.col("b") + 0.5) / (clean + 1))
    z = odds / F.sqrt(1 / (F.col("a") + 0.5) + 1 / (F.col("b") + 0.5))
    share = F.col("a") / (F.col("a") + F.col("b") + PRIOR)
    judged = words.select("feature", share.alias("weight"), z.alias("z"), (F.col("a") + F.col("b")).alias("seen"))
    telling = (F.col("z") >= MIN_Z) & (F.col("weight") >= MIN_SHARE)
    kept = judged.filter(telling & (F.col("seen") >= MIN_FAMILIES))
    starts = [F.when(F.length("feature") > k, F.concat(F.left("feature", F.lit(k)), F.lit("-"))) for k in PREFIXES]
    begun = words.select("feature", "a", "b", F.explode(F.array_compact(F.array(*starts))).alias("start"))
    mostly = F.col("a") > F.col("b")
    by_start = begun.groupBy("start").agg(F.count_if(mostly).alias("a"), F.count_if(~mostly).alias("b"))
    by_start = by_start.select("start", "a", (F.col("a") / (F.col("a") + F.col("b") + PRIOR)).alias("weight"))
    by_start = by_start.filter((F.col("weight") >= MIN_SHARE) & (F.col("a") >= MIN_WORDS))
    known = begun.filter(F.col("a") + F.col("b") >= MIN_FAMILIES).join(by_start.select("start"), "start", "left_semi")
    known = known.select("feature").distinct()
    weights = {r["start"]: r["weight"] for r in by_start.collect()}
    weights |= {r["feature"]: 0.0 for r in known.collect()}
    return weights | {r["feature"]: r["weight"] for r in kept.collect()}


def _best(word: str, weights: dict[str, float]) -> float:
    """The word's own chance, or for a word without one that of its beginnings."""
    if word in weights:
        return weights[word]
    return max((weights.get(f, 0.0) for f in beginnings(word)), default=0.0)


def combined(found: list[float]) -> float:
    """The chance that a text is toxic, from its words: the worst counts in full, the next ones less."""
    clean, part = 1.0, 1.0
    for k, p in enumerate(sorted(found, reverse=True)):
        clean *= 1 - p * part
        part = SECOND if k == 0 else part / 2
    return 1 - clean


def score(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    held_out: Column | None = None, threshold: float = THRESHOLD,
) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per row of ``docs``.

    ``held_out`` is a condition on ``id``; labels of such rows are never read. Labels that are null,
    or without an id, do not count; of labels that repeat an id the larger does. A null text is
    empty, and a text without toxic words has score 0; without any labels all have. Null and repeated ids are carried through, and an empty table gives an
    empty result. The score reads the text alone.
    """
    id_text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rule = held_out if held_out is not None else F.pmod(F.crc32(id_text("id").cast("binary")), F.lit(4)) == 2
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), whole(text_col).alias("text"))
    model = spark.sparkContext.broadcast(language_model(rows.select("text")))
    named = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    learned = spark.sparkContext.broadcast(_weights(written(_examples(rows, named, rule, model), "examples")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights = learned.value
        words = _Words(model.value)
        value: dict[str, dict[str, float]] = {}

        def toxic(token: str) -> dict[str, float]:
            if token not in value:
                if len(value) >= CACHE:
                    value.clear()
                found = {w: _best(w, weights) for w in words[token]}
                value[token] = {w: x for w, x in found.items() if x > 0}
            return value[token]

        for batch in batches:
            scores = []
            for text in batch["text"]:
                found: dict[str, float] = {}
                for token in _tokens(text):
                    if hit := toxic(token):
                        found.update(hit)
                scores.append(combined(list(found.values())))
            out = batch[["doc_id", "held_out"]].assign(score=scores)
            yield out.assign(predicted=(out["score"] >= threshold).astype("int32"))

    tested = rows.withColumnRenamed("doc_id", "id").select(as_text("id").alias("doc_id"), rule.alias("held_out"), "text")
    found = tested.mapInPandas(run, "doc_id string, held_out boolean, score double, predicted int")
    return found.withColumn("doc_id", F.col("doc_id").cast(docs.schema[id_col].dataType))


@query()
def op9_toxicity(spark, sf):
    return score(table(spark, sf, "documents"), table(spark, sf, "labels"))
