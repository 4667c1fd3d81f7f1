"""Repeated byte strings by a depth-limited radix sort of suffixes.

Every suffix of every text is sorted only through its first ``depth`` bytes, most significant
digit first, and a group of one is settled as soon as it is alone. What remains equal at
full depth is exactly the repeated windows.

The first digit of a suffix is the least ``GRAM``-byte gram inside its window and its place in
the window, which depends on the window alone. Neighbouring suffixes share that gram, so a
text falls into *segments* of consecutive suffixes, some sixty bytes apart, and one row for
each segment is sorted instead of one for each byte:

1. Segments with a gram that nothing else has are alone: no window in them repeats.
2. Segments with equal bytes are settled too: all their windows repeat.
3. For the others, the bytes of the segment go to the task of its gram, and there their
   suffixes are sorted digit by digit; equal groups are compared byte for byte.

Grams with more than ``hot`` different segments are not gathered: their windows are digested one
by one and counted by digest with map-side combine.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window as W, functions as F

from glyphline.llm.common import query, table, whole, written

DEPTH = 200
GRAM = 32
HOT = 20_000
#: Bytes of one digit of the later passes, and suffixes sorted at once when groups are small.
DIGIT = 50
CHUNK = 1 << 20

_BYTE = np.random.default_rng(20).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def string_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """Hash of every string of ``length`` bytes, built from strings of powers of two."""
    power = _BYTE[data]
    span, total, have = 1, None, 0
    while True:
        if length & span:
            if total is None:
                total, have = power, span
            else:
                n = len(data) - have - span + 1
                total = power[:n] * np.uint64(pow(_BASE, have, 1 << 64)) + total[span : span + n]
                have += span
        if span * 2 > length:
            return _mixed(total)
        power = power[:-span] * np.uint64(pow(_BASE, span, 1 << 64)) + power[span:]
        span *= 2


def _least_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def segments(data: np.ndarray, depth: int, gram: int) -> tuple[np.ndarray, ...]:
    """gram hash, first suffix, number of suffixes, and the gram's place in the first window, of each segment."""
    hashes = string_hashes(data, gram)
    places = np.arange(len(hashes), dtype=np.uint64)
    ranked = (hashes & np.uint64(0xFFFFFFFF00000000)) | places
    place = (_least_in_windows(ranked, depth - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.concatenate([[0], np.flatnonzero(place[1:] != place[:-1]) + 1])
    number = np.diff(np.append(first, len(place)))
    return hashes[place[first]], first, number, place[first] - first


def _cut(texts: DataFrame, depth: int, gram: int) -> DataFrame:
    """key, bytes, uid, first, number, inner, settled: a row for each segment.

    Segments that are equal inside one batch are settled there: two of them go on to tell the
    others of their bytes, and runs of the rest are merged into one settled row, so copies and
    periodic texts do not flood the gram's task.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch[batch["uid"].groupby(batch["uid"]).cumcount() < 2]
            parts = [[] for _ in range(6)]
            for uid, text in zip(batch["uid"], batch["text"]):
                raw = text.encode("utf-8", "surrogatepass")
                if len(raw) < depth:
                    continue
                key, first, number, inner = segments(np.frombuffer(raw, np.uint8), depth, gram)
                ends = (first + number + depth - 1).tolist()
                digest = [xxhash.xxh3_64_intdigest(raw[s:e]) for s, e in zip(first.tolist(), ends)]
                whole_row = (key, np.array(digest, np.uint64), np.full(len(key), uid), first, number, inner)
                for column, values in zip(parts, whole_row):
                    column.append(values)
            if not parts[0]:
                continue
            key, digest, uid, first, number, inner = (np.concatenate(p) for p in parts)
            order = np.lexsort((digest, key))
            new = np.ones(len(order), bool)
            new[1:] = (key[order][1:] != key[order][:-1]) | (digest[order][1:] != digest[order][:-1])
            starts = np.flatnonzero(new)
            rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
            extra = np.zeros(len(order), bool)
            extra[order] = rank >= 2
            out = pd.DataFrame({
                "key": key.view(np.int64), "bytes": digest.view(np.int64), "uid": uid, "first": first.astype(np.int64),
                "number": number.astype(np.int64), "inner": inner.astype(np.int32),
                "settled": extra,
            })
            if extra.any():
                done = out[extra]
                run_on = (done["uid"].shift() == done["uid"]) & (done["first"].shift() + done["number"].shift() == done["first"])
                number = done.groupby((~run_on).cumsum())["number"].transform("sum")
                done = done.assign(number=number)[~run_on]
                # settled rows need no company, so they are dealt out evenly
                done = done.assign(key=done["uid"] ^ (done["first"] * 2654435761))
                out = pd.concat([out[~extra], done])
            yield out

    return texts.mapInPandas(
        run, "key bigint, bytes bigint, uid bigint, first bigint, number bigint, inner int, settled boolean"
    )


def _judged(cut: DataFrame) -> DataFrame:
    """uid, first, number, inner, key, settled, needed: segments that repeat or may in part.

    A segment is settled when another has its bytes, and left out when nothing else has its
    gram. ``needed`` marks those whose suffixes must be sorted: segments that are alone, and one
    model of every settled kind, where a gram has several kinds of bytes. The rows of a gram are
    small and pass the window operator sorted, which spills; no text moves here.
    """
    kind = W.partitionBy("key", "bytes")
    gram = W.partitionBy("key")
    rows = cut.repartition("key").select(
        "*",
        F.count("*").over(kind).alias("same"),
        F.row_number().over(kind.orderBy("uid", "first")).alias("nth"),
        (F.min("bytes").over(gram) != F.max("bytes").over(gram)).alias("several"),
    )
    repeated = F.col("settled") | (F.col("same") > 1)
    return rows.filter(repeated | F.col("several")).select(
        "uid", "first", "number", "inner", "key", repeated.alias("settled"),
        (~F.col("settled") & F.col("several") & (F.col("nth") == 1)).alias("needed"),
    )


def _with_bytes(texts: DataFrame, wanted: DataFrame, depth: int) -> DataFrame:
    """The wanted segments with the bytes that their suffixes cover; a text is read once for all of its own."""
    fields = ["key", "first", "number", "inner", "settled"]
    listed = wanted.groupBy(F.col("uid").alias("of")).agg(F.collect_list(F.struct(*fields)).alias("parts"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for uid, text, parts in zip(batch["uid"], batch["text"], batch["parts"]):
                raw = text.encode("utf-8", "surrogatepass")
                for p in parts:
                    stop = p["first"] + p["number"] + depth - 1
                    rows.append((uid, *(p[f] for f in fields), raw[p["first"] : stop]))
            yield pd.DataFrame(rows, columns=["uid", *fields, "content"])

    joined = texts.join(listed, F.col("uid") == F.col("of")).select("uid", "text", "parts")
    return joined.mapInPandas(
        run, "uid bigint, key bigint, first bigint, number bigint, inner int, settled boolean, content binary"
    )


def equal_suffixes(data: np.ndarray, start: np.ndarray, key: np.ndarray, depth: int) -> np.ndarray:
    """Which suffixes have an equal one of the same first digit: positions in ``start``.

    One pass for each digit: suffixes with the same digits so far are grouped by the next, and
    those alone in their group leave. Digits are hashed, so the last pass compares the bytes.
    """
    at = np.arange(len(start))
    cuts = list(range(0, depth - DIGIT + 1, DIGIT)) or [0]
    if cuts[-1] + DIGIT < depth:
        cuts.append(depth - DIGIT)
    digits = string_hashes(data, min(DIGIT, depth))
    for cut in cuts:
        key = _mixed(key ^ digits[start[at] + cut])
        order = np.argsort(key, kind="stable")
        key, at = key[order], at[order]
        same = np.zeros(len(at) + 1, bool)
        same[1:-1] = key[1:] == key[:-1]
        company = same[:-1] | same[1:]
        key, at = key[company], at[company]
    if not len(at):
        return at
    leads = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    lead = np.repeat(at[leads], np.diff(np.append(leads, len(at))))
    windows = np.lib.stride_tricks.sliding_window_view(data, depth)
    equal = np.ones(len(at), bool)
    for k in range(0, len(at), 1 << 15):
        part = slice(k, k + (1 << 15))
        equal[part] = (windows[start[at[part]]] == windows[start[lead[part]]]).all(axis=1)
    if not equal.all():  # two strings of one hash: group these by their bytes
        counted: dict[tuple[int, bytes], list[int]] = {}
        for k, i in zip(key.tolist(), at.tolist()):
            counted.setdefault((k, windows[start[i]].tobytes()), []).append(i)
        at = np.array([i for group in counted.values() if len(group) > 1 for i in group], np.int64)
    return at


def _runs(segment: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of consecutive places inside a segment: segment, first place, length."""
    order = np.lexsort((place, segment))
    segment, place = segment[order], place[order]
    new = np.ones(len(order), bool)
    new[1:] = (segment[1:] != segment[:-1]) | (place[1:] != place[:-1] + 1)
    starts = np.flatnonzero(new)
    return segment[starts], place[starts], np.diff(np.append(starts, len(order)))


def _sorted_grams(rows: pd.DataFrame, depth: int) -> pd.DataFrame:
    """uid, first, number of the repeated suffixes of all grams in the rows."""
    number = rows["number"].to_numpy()
    contents = rows["content"].tolist()
    data = np.frombuffer(b"".join(contents), np.uint8)
    begin = np.concatenate([[0], np.cumsum([len(c) for c in contents])[:-1]]).astype(np.int64)
    segment = np.repeat(np.arange(len(rows)), number)
    place = np.arange(len(segment)) - np.repeat(np.cumsum(number) - number, number)
    inner = rows["inner"].to_numpy()[segment] - place
    key = _mixed(rows["key"].to_numpy().view(np.uint64)[segment] + inner.astype(np.uint64))
    found = equal_suffixes(data, begin[segment] + place, key, depth)
    found = found[~rows["settled"].to_numpy(dtype=bool)[segment[found]]]
    if not len(found):
        return pd.DataFrame({"uid": [], "first": [], "number": []}, dtype="int64")
    which, first, length = _runs(segment[found], place[found])
    return pd.DataFrame({
        "uid": rows["uid"].to_numpy()[which], "first": rows["first"].to_numpy()[which] + first, "number": length,
    })


def _sort_by_gram(parts: DataFrame, depth: int) -> DataFrame:
    """Sort the suffixes of every gram in the gram's task, as many grams at once as make a chunk."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, waiting = [], 0
        for batch in batches:
            held.append(batch)
            waiting += int(batch["number"].sum())
            if waiting >= CHUNK:
                rows = pd.concat(held, ignore_index=True)
                key = rows["key"].to_numpy()
                done = int(np.argmax(key == key[-1]))  # the last gram may go on
                if done:
                    yield _sorted_grams(rows.iloc[:done], depth)
                held, waiting = [rows.iloc[done:]], int(rows["number"].iloc[done:].sum())
        if held:
            rows = pd.concat(held, ignore_index=True)
            if len(rows):
                yield _sorted_grams(rows, depth)

    ordered = parts.repartition("key").sortWithinPartitions("key")
    return ordered.mapInPandas(run, "uid bigint, first bigint, number bigint")


def _count_by_digest(parts: DataFrame, depth: int) -> DataFrame:
    """The same for grams with very many segments: one row per suffix, counted by a strong digest."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for uid, first, number, settled, content in zip(
                batch["uid"], batch["first"], batch["number"], batch["settled"], batch["content"]
            ):
                for k in range(number):
                    rows.append((hashlib.md5(content[k : k + depth]).digest(), uid, first + k, settled))
            yield pd.DataFrame(rows, columns=["digest", "uid", "first", "settled"])

    suffixes = parts.mapInPandas(run, "digest binary, uid bigint, first bigint, settled boolean")
    repeated = suffixes.groupBy(F.col("digest").alias("d")).agg(F.count("*").alias("n")).filter("n > 1")
    return suffixes.filter(~F.col("settled")).join(repeated, F.col("digest") == F.col("d"), "left_semi").select(
        "uid", "first", F.lit(1).cast("bigint").alias("number")
    )


def removed_runs(first: np.ndarray, number: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of bytes covered by repeated windows: starts and ends."""
    order = np.argsort(first, kind="stable")
    start, end = first[order], np.maximum.accumulate((first + number + depth - 1)[order])
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > end[:-1]
    heads = np.flatnonzero(new)
    return start[heads], end[np.append(heads[1:], len(start)) - 1]


def _without(texts: DataFrame, repeats: DataFrame, depth: int) -> DataFrame:
    """of (the uid), kept (the remaining bytes), starts and stops (of the removed spans) of texts with repeats."""
    listed = repeats.groupBy(F.col("uid").alias("of")).agg(F.collect_set(F.struct("first", "number")).alias("parts"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for uid, text, parts in zip(batch["uid"], batch["text"], batch["parts"]):
                raw = text.encode("utf-8", "surrogatepass")
                spans = np.array([(p["first"], p["number"]) for p in parts], np.int64)
                starts, ends = removed_runs(spans[:, 0], spans[:, 1], depth)
                kept = b"".join(raw[s:e] for s, e in zip([0, *ends.tolist()], [*starts.tolist(), len(raw)]))
                rows.append((uid, kept, starts, ends))
            yield pd.DataFrame(rows, columns=["of", "kept", "starts", "stops"])

    joined = texts.join(listed, F.col("uid") == F.col("of")).select("uid", "text", "parts")
    return joined.mapInPandas(run, "of bigint, kept binary, starts array<bigint>, stops array<bigint>")


def repeated_suffixes(docs: DataFrame, text_col: str = "text", depth: int = DEPTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """uid (the text's 64-bit key), first, number: all windows of ``depth`` bytes that start twice or more."""
    rows = docs.select(F.xxhash64(whole(text_col)).alias("uid"), whole(text_col).alias("text"))
    judged = written(_judged(_cut(rows.filter(F.octet_length("text") >= depth), depth, gram)), "segments")
    wanted = judged.filter("needed").drop("needed")
    many = wanted.groupBy(F.col("key").alias("k")).agg(F.count("*").alias("n")).filter(F.col("n") > hot)
    texts = _distinct_texts(docs, text_col)
    usual = _with_bytes(texts, wanted.join(many, F.col("key") == F.col("k"), "left_anti"), depth)
    crowded = _with_bytes(texts, wanted.join(many, F.col("key") == F.col("k"), "left_semi"), depth)
    settled = judged.filter("settled").select("uid", "first", "number")
    return settled.unionByName(_sort_by_gram(usual, depth)).unionByName(_count_by_digest(crowded, depth))


def _distinct_texts(docs: DataFrame, text_col: str) -> DataFrame:
    """uid, text: every text once; copies meet after map-side combine."""
    rows = docs.select(F.xxhash64(whole(text_col)).alias("uid"), whole(text_col).alias("text"))
    return rows.groupBy("uid").agg(F.first("text").alias("text"))


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH, gram: int = GRAM, hot: int = HOT
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept, spans: one row per input row.

    ``kept`` holds the bytes that remain, ``spans`` the removed ones as (start, stop) in bytes; the
    numbers and the digest come from them. Every byte under a ``depth``-byte string that also
    starts elsewhere, in any text, is removed; copies of a text repeat each other. A null text is
    empty; texts shorter than ``depth`` keep all; ids are carried through, null or repeated; an
    empty table gives an empty result; other columns are not read. Texts are told apart by a
    64-bit key. What remains need not be valid UTF-8 where a repeat begins inside a character.
    """
    repeats = repeated_suffixes(docs, text_col, depth, gram, hot)
    cleaned = _without(_distinct_texts(docs, text_col), repeats, depth)
    text = whole(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("uid"), text.cast("binary").alias("raw"))
    span = F.transform("starts", lambda s, i: F.struct(s.alias("start"), F.get("stops", i).alias("stop")))
    none = F.array().cast("array<struct<start:bigint,stop:bigint>>")
    rows = rows.join(cleaned, F.col("uid") == F.col("of"), "left").select(
        "doc_id", F.octet_length("raw").cast("bigint").alias("n_bytes"),
        F.coalesce("kept", "raw").alias("kept"), F.coalesce(span, none).alias("spans"),
    )
    return rows.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"), "kept", "spans",
    )


@query()
def op3_suffix_dedup(spark, sf):
    cleaned = remove_repeats(table(spark, sf, "documents"))
    return cleaned.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
