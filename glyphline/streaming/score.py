"""Emotion and symbol suggestion for a stream of texts.

``score_stream`` is a streaming plan of its own: the emotion is looked up inside the row, in a
lexicon that the caller holds as a list and that becomes part of the plan, and the symbol comes
from a join of the stream with the static model lines. Nothing is grouped, so there is no state and
no watermark, rows leave in the batch they came in, and ``append_to`` writes them once even if a batch
is run again. ``score_batches`` applies the batch operators (joins and aggregates of any size) to each
micro-batch, for lexicons that are tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter

from glyphline.functions.text import tokenize
from glyphline.operators.emotion import labelled
from glyphline.operators.suggest import suggest_from_lines, suggest_topk

ENTRIES_PER_BUCKET = 8


def lookup_literal(entries: Iterable[tuple[str, float | str]], kind: str = "double") -> Callable[[Column], Column]:
    """word -> list of values of type ``kind``, as a function on columns.

    The entries become a literal array of small maps picked by the word's hash, since a
    lookup in one large map walks it.
    """
    rows = [(word, float(value) if kind == "double" else value) for word, value in entries]
    n = max(1, len(rows) // ENTRIES_PER_BUCKET)
    buckets: list[dict[str, set]] = [{} for _ in range(n)]
    for word, value in rows:
        hashed = xxhash.xxh64_intdigest(word.encode(), 42)
        signed = hashed - (1 << 64) if hashed >> 63 else hashed
        buckets[signed % n].setdefault(word, set()).add(value)
    maps = F.array(
        *[
            F.create_map(*[x for w, vs in sorted(b.items()) for x in (F.lit(w), F.array(*map(F.lit, sorted(vs))))])
            if b
            else F.create_map().cast(f"map<string,array<{kind}>>")
            for b in buckets
        ]
    )

    def look_up(word: Column) -> Column:
        found = F.get(maps, F.pmod(F.xxhash64(word), F.lit(n)).cast("int"))[word]
        return F.coalesce(found, F.array().cast(f"array<{kind}>"))

    return look_up


def valence_in_row(text: Column, look_up) -> Column:
    """Summed valence of one text."""
    values = F.flatten(F.transform(tokenize(text), look_up))
    return F.aggregate(values, F.lit(0.0), lambda a, v: a + v)


def emotion_in_row(df: DataFrame, look_up: Callable[[Column], Column], text: str, out: str = "emotion") -> DataFrame:
    """The most frequent emotion of each text, the first by name on ties, null without a hit.

    ``look_up`` gives the emotions of a word (``lookup_literal`` with strings).
    """
    hits = F.flatten(F.transform(tokenize(F.col(text)), look_up))
    # a column of its own: inside the lambda the list would be computed once for every emotion
    counted = df.withColumn("_hits", hits)
    ranked = F.transform(
        F.array_distinct("_hits"), lambda e: F.struct((-F.size(F.filter("_hits", lambda h: h == e))).alias("n"), e.alias("e"))
    )
    return counted.withColumn(out, F.array_min(ranked)["e"]).drop("_hits")


def score_stream(
    stream: DataFrame,
    lexicon: Iterable[tuple[str, str]],
    lines: DataFrame,
    text: str = "text",
    id_col: str = "review_id",
    k: int = 3,
    seed: int = 42,
) -> DataFrame:
    """The stream with ``emotion`` and ``symbol``: an even, seeded choice among the k most frequent symbols.

    ``lexicon`` holds (word, emotion) pairs; ``lines`` is a static folded model (``suggest.folded_model``, best
    written first: a streaming plan reads its static side anew in every batch). A null or empty text and an unknown
    emotion keep their rows with nulls. The same function scores a table.
    """
    labels = emotion_in_row(stream, lookup_literal(lexicon, "string"), text)
    return suggest_from_lines(labels, lines, id_col, k, seed)


def append_to(scored: DataFrame, path: str, state: str) -> DataStreamWriter:
    """A writer that appends every batch to the folder ``path``.

    The folder keeps a log of the files that belong to finished batches, and readers follow it: a batch
    that was killed leaves files that nobody reads, and one that is run again after it was logged adds none.
    """
    return (
        scored.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", state)
    )


def score_batches(
    stream: DataFrame,
    lexicon: DataFrame,
    model: DataFrame,
    path: str,
    text: str = "text",
    id_col: str = "review_id",
    k: int = 3,
    seed: int = 42,
    exclude: tuple[str, ...] = (),
) -> DataStreamWriter:
    """A stream writer that scores every micro-batch with the batch operators.

    Each batch has its own folder and is overwritten when it is run again, so a
    restarted query leaves no duplicates.
    """

    def score(batch: DataFrame, batch_id: int) -> None:
        emotions = labelled(batch, lexicon, text, id_col)
        scored = suggest_topk(emotions, model, id_col, k, seed, exclude)
        scored.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return stream.writeStream.foreachBatch(score)
