"""Labels from any model that scores lists of texts, in batches of like length.

A model that pads its batches wastes what the shortest text of a batch lacks to the longest, so the texts
of an Arrow batch are cut to the model's limit, sorted by length and scored in runs that keep to a
budget of padded tokens. A batch that fails is scored again text by text: one bad text costs its own label only.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, functions as F

#: What a model may say of a text: a label, or scores by label.
Scores = str | dict[str, float] | Sequence[tuple[str, float]] | None
Scorer = Callable[[list[str]], Sequence[Scores]]
#: Splits a text into tokens, and joins some of them again.
Tokenizer = tuple[Callable[[str], Sequence], Callable[[Sequence], str]]

REASON_CHARS = 200
#: The scorer and tokenizer of the last call that this worker process served.
_loaded: dict[str, tuple] = {}


def words() -> Tokenizer:
    """White-space words."""
    return str.split, " ".join


def load_once(key: str, *makers: Callable) -> tuple:
    """What the makers make, once for a key in a worker process; that of another key is let go."""
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = tuple(make() for make in makers)
    return _loaded[key]


def top_label(scores: Scores) -> str | None:
    """The label itself, or the one with the highest score, the first by name on ties."""
    if scores is None or isinstance(scores, str):
        return scores
    pairs = scores.items() if isinstance(scores, dict) else scores
    return min(((-score, label) for label, score in pairs), default=(0, None))[1]


def runs(lengths: Sequence[int], most: int, budget: int) -> Iterator[list[int]]:
    """Positions in runs of like length: at most ``most`` texts, and padded to the longest within ``budget`` tokens,
    but for a text that is longer than that alone."""
    run: list[int] = []
    for at in sorted(range(len(lengths)), key=lambda i: (lengths[i], i)):
        # sorted ascending, so the newest is the longest
        if run and (len(run) == most or (len(run) + 1) * max(1, lengths[at]) > budget):
            yield run
            run = []
        run.append(at)
    if run:
        yield run


def _reason(error: Exception) -> str:
    return f"{type(error).__name__}: {error}"[:REASON_CHARS]


def _scored(scorer: Scorer, texts: list[str]) -> list[tuple[str | None, str | None]]:
    """(label, reason for its absence) of each text."""
    try:
        found = list(scorer(texts))
        if len(found) != len(texts):
            raise ValueError(f"{len(found)} results for {len(texts)} texts")
        labels = [top_label(s) for s in found]
    except Exception as error:  # noqa: BLE001  any failure of the model is that of its texts
        if len(texts) == 1:
            return [(None, _reason(error))]
        return [pair for text in texts for pair in _scored(scorer, [text])]
    return [(label, None if label is not None else "no label") for label in labels]


def label_batches(
    df: DataFrame,
    make_scorer: Callable[[], Scorer],
    text: str,
    out: str = "emotion",
    make_tokenizer: Callable[[], Tokenizer] = words,
    limit: int | None = 512,
    most: int = 64,
    budget: int = 16_384,
) -> DataFrame:
    """The frame with the label of each text in ``out``, ``reason`` for a missing label, and ``truncated``.

    A worker process calls ``make_scorer`` and ``make_tokenizer`` once, however many batches and tasks it serves. A text
    with more than ``limit`` tokens is cut to its first ones. A null text is scored as an empty one. A text
    that the scorer fails on has a null label and the error as its reason. Labels do not depend on ``most``
    and ``budget`` as long as the scorer gives a text the same scores in any company.
    """
    key = uuid.uuid4().hex

    @F.pandas_udf("label string, reason string, truncated boolean")
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            try:
                scorer, (split, join) = load_once(key, make_scorer, make_tokenizer)
            except Exception as error:
                raise RuntimeError(f"the scorer cannot be loaded: {_reason(error)}") from error
            texts, lengths, cut = [], [], []
            for value in batch:
                value = "" if value is None else value
                tokens = split(value)
                long = limit is not None and len(tokens) > limit
                texts.append(join(tokens[:limit]) if long else value)
                lengths.append(min(len(tokens), limit) if limit is not None else len(tokens))
                cut.append(long)
            found: list[tuple] = [(None, None)] * len(texts)
            for run in runs(lengths, most, budget):
                for at, pair in zip(run, _scored(scorer, [texts[i] for i in run])):
                    found[at] = pair
            yield pd.DataFrame({
                "label": pd.Series([x for x, _ in found], dtype="object"),
                "reason": pd.Series([x for _, x in found], dtype="object"), "truncated": cut,
            })

    held = df.withColumn("_label", label(F.col(text)))
    return held.withColumns({
        out: F.col("_label.label"), "reason": F.col("_label.reason"), "truncated": F.col("_label.truncated")
    }).drop("_label")
