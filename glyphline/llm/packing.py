"""Packing documents into sequences by a configuration linear program.

A document is its tokens and an end token; one longer than a sequence is cut into full pieces
behind a shorter first one. What is to be packed is then a histogram of lengths with at most
``capacity`` entries, however many documents there are, and the driver solves the packing on
that histogram: configurations (multisets of lengths that fit) are priced by a knapsack
dynamic program, lengths get prices by multiplicative weights, the fractional solution is
rounded down and the remainder goes best fit. The plan has one row per configuration and
place in it; pieces take their places by their rank among pieces of their length.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F
from tokenizers import Tokenizer

from glyphline.llm.common import as_text, query, table, written

TOKENIZER = "byte_bpe_50k.json"
CAPACITY = 1024
END = 2
#: Tokens that leave a Python worker together.
CHUNK = 1 << 20
#: Rows and bytes of text that go to a Python worker together: worker and executor hold a batch several times over.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "500", "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}
#: Rounds of price updates, their learning rate, how many rounds' share a length may run ahead,
#: and the weight of the random tie-break, all in parts of what one token is worth.
ROUNDS = 40
RATE = 0.5
AHEAD = 1
TIE = 0.1
#: Share of every length that the program serves: best fit needs short pieces to go with the rest.
SHARE = 0.9


@lru_cache(maxsize=2)
def _encoders(path: str):
    """The tokenizer, and the same merges and pattern in a library without offsets.

    Both give the same ids; texts that hold a special token's string go to the tokenizer.
    """
    exact = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    to_byte = {chr(b): b for b in printable}
    to_byte |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(printable))}
    special = {t.content for t in exact.get_added_tokens_decoder().values()}
    ranks = {bytes(to_byte[c] for c in token): i for token, i in vocabulary.items() if token not in special}
    fast = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return exact, fast, tuple(special)


def encode(text: str, path: str) -> array:
    """Token ids of a text as unsigned 32-bit integers, without special tokens added."""
    exact, fast, special = _encoders(path)
    if not any(s in text for s in special):
        try:
            return array("I", fast.encode_ordinary(text))
        except Exception:  # noqa: BLE001  the pattern engine gives up on some very long runs of one kind
            pass
    return array("I", exact.encode(text, add_special_tokens=False).ids)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What is run inside hands few texts at a time to its Python workers, however long they are."""
    kept = {name: spark.conf.get(name) for name in BATCH}
    try:
        for name, value in BATCH.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value)


def pieces(docs: DataFrame, id_col: str, text_col: str, path: str, capacity: int, end_token: int) -> DataFrame:
    """doc_id (as text), piece, start, length, ids_crc32, row, task, number, ids: all but the first piece of a document are full.

    ``number`` counts the pieces of one length that a task makes.
    """
    fields = {
        "doc_id": pa.string(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(),
        "row": pa.int64(), "task": pa.int64(), "number": pa.int64(),
    }

    def framed(rows: list[tuple], tokens: array) -> pa.RecordBatch:
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), fields.values())]
        ends = np.concatenate([[0], np.cumsum([r[3] for r in rows])]).astype(np.int32)
        ids = pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(tokens, np.int32)))
        return pa.RecordBatch.from_arrays([*columns, ids], [*fields, "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = [0] * (capacity + 1)
        rows, held = [], array("I")
        for batch in batches:
            for doc_id, text, row in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "row"))):
                tokens = encode(text or "", path)
                tokens.append(end_token)
                view = memoryview(tokens)
                first = len(tokens) % capacity or capacity
                start = 0
                for piece, stop in enumerate(range(first, len(tokens) + 1, capacity)):
                    length = stop - start
                    # the upper bits of a row's number are its task's
                    rows.append((doc_id, piece, start, length, zlib.crc32(view[start:stop]), row, row >> 33, made[length]))
                    made[length] += 1
                    start = stop
                held += tokens
                if len(held) >= CHUNK:
                    yield framed(rows, held)
                    rows, held = [], array("I")
        if rows:
            yield framed(rows, held)

    rows = docs.select(
        as_text(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.monotonically_increasing_id().alias("row")
    )
    kinds = (
        "doc_id string, piece int, start bigint, length bigint, ids_crc32 bigint, row bigint, task bigint, number bigint, "
        "ids array<int>"
    )
    return rows.mapInArrow(run, kinds)


def _best_values(price: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Unbounded knapsack: the best value for every room, and the length taken there (0: none)."""
    best = np.zeros(capacity + 1)
    taken = np.zeros(capacity + 1, np.int64)
    upto = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        k = upto[room]
        best[room], taken[room] = best[room - 1], 0
        if k:
            value = price[:k] + best[room - lengths[:k]]
            at = int(value.argmax())
            if value[at] > best[room]:
                best[room], taken[room] = value[at], lengths[at]
    return best, taken


def _filled(taken: np.ndarray, room: int) -> list[int]:
    """The lengths that the knapsack puts into a room."""
    chosen = []
    while room > 0:
        if taken[room]:
            chosen.append(int(taken[room]))
            room -= int(taken[room])
        else:
            room -= 1
    return chosen


def fractional(counts: np.ndarray, capacity: int, rounds: int = ROUNDS) -> dict[tuple, float]:
    """Configurations with fractional multiplicities that together cover SHARE of the histogram.

    Prices start at the length itself, so a configuration's value is how full it is. In every
    round the dynamic program prices all rooms; lengths behind their share each get the best
    configuration that holds them, as much of it as its scarcest member needs; prices of
    lengths covered ahead of the average are multiplied down, those behind up. One step is less
    than a token is worth, so at first the prices only choose among equally full
    configurations, and a length that stays behind gains until it is served.
    """
    lengths = np.flatnonzero(counts)
    need = counts[lengths].astype(float)
    place = np.zeros(capacity + 1, np.int64)
    place[lengths] = np.arange(len(lengths))
    log_price = np.zeros(len(lengths))
    covered = np.zeros(len(lengths))
    total: dict[tuple, float] = {}
    noise = np.random.default_rng(0)
    for turn in range(1, rounds + 1):
        # ties between equally full configurations fall differently in every round
        tie = noise.uniform(0, TIE / capacity, len(lengths))
        _, taken = _best_values(lengths / capacity * np.exp(log_price) + tie, lengths, capacity)
        goal = SHARE * turn / rounds * need
        ahead = np.minimum(SHARE * need, goal + AHEAD * need / rounds)
        for at in np.argsort(-(goal - covered) * lengths):
            length = int(lengths[at])
            if covered[at] >= goal[at]:
                continue
            chosen = sorted([length, *_filled(taken, capacity - length)], reverse=True)
            members, copies = np.unique(place[chosen], return_counts=True)
            own = copies[np.searchsorted(members, at)]
            times = min((goal[at] - covered[at]) / own, float(np.min((ahead[members] - covered[members]) / copies)))
            if times > 0:
                total[tuple(chosen)] = total.get(tuple(chosen), 0.0) + times
                covered[members] += times * copies
        log_price += RATE / capacity * np.clip((goal - covered) / need * rounds, -1, 1)
    return total


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[tuple, int]]:
    """Best fit, longest first, on a histogram: equal pieces go to equal bins together."""
    bins: dict[int, dict[tuple, int]] = {}
    for length in range(capacity, 0, -1):
        left = int(counts[length]) if length < len(counts) else 0
        while left:
            room = next((r for r in range(length, capacity) if bins.get(r)), None)
            if room is None:
                each = capacity // length
                full, rest = divmod(left, each)
                for size, times in ((each, full), (rest, 1)):
                    if size and times:
                        where = bins.setdefault(capacity - size * length, {})
                        where[(length,) * size] = where.get((length,) * size, 0) + times
                break
            content, number = bins[room].popitem()
            moved = min(number, left)
            if number > moved:
                bins[room][content] = number - moved
            where = bins.setdefault(room - length, {})
            where[(*content, length)] = where.get((*content, length), 0) + moved
            left -= moved
    return [(content, number) for group in bins.values() for content, number in group.items()]


def solve(histogram: dict[int, int], capacity: int) -> list[tuple[tuple, int]]:
    """Configurations and how often each is used, so that every piece has one place."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    plan = [((capacity,), int(counts[capacity]))] if counts[capacity] else []
    counts[capacity] = 0
    if not counts.any():
        return plan
    found = fractional(counts, capacity)
    fullest = max(map(sum, found))
    for chosen, times in sorted(found.items(), key=lambda x: -x[1]):
        if sum(chosen) < fullest:
            continue  # less than the best use of a sequence: its pieces fit better among the remainder
        members, copies = np.unique(chosen, return_counts=True)
        whole = min(int(times), int(np.min(counts[members] // copies)))
        if whole:
            counts[members] -= whole * copies
            plan.append((chosen, whole))
    return plan + best_fit(counts, capacity)


def places(plan: list[tuple[tuple, int]]) -> pd.DataFrame:
    """length, low, high, first_sequence, offset: ranks low to high - 1 of a length go to consecutive sequences."""
    rows, used, sequence = [], {}, 0
    for chosen, times in plan:
        offset = 0
        for length in chosen:
            low = used.get(length, 0)
            rows.append((length, low, low + times, sequence, offset))
            used[length] = low + times
            offset += length
        sequence += times
    return pd.DataFrame(rows, columns=["length", "low", "high", "first_sequence", "offset"]).astype("int64")


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
    capacity: int = CAPACITY, end_token: int = END,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset, row, ids: one row per piece.

    ``ids`` are the tokens of the piece, so a sequence is its pieces' ids by ``offset``. ``row`` is a
    number of the input row, which tells the copies of an id apart. A null or empty text is the end token alone; rows that repeat an id are documents of their
    own; a null id is carried through; an empty table gives an empty result; other columns are not
    read. The rank of a piece among those of its length is its number in its task and the pieces that
    tasks before have of that length, so ids are neither sorted nor grouped, and a length that a third
    of all pieces have is no group. The plan's size is bounded by the number of configurations
    (at most rounds times ``capacity``, and best fit on a histogram of ``capacity`` entries), not by the data.
    """
    spark = docs.sparkSession
    path = tokenizer or public_tokenizers.path(TOKENIZER)
    with small_batches(spark):
        cut = written(pieces(docs, id_col, text_col, path, capacity, end_token), "pieces")
    tasks = written(cut.groupBy("length", "task").agg(F.count("*").alias("n")), "tasks")
    histogram = {r["length"]: r["n"] for r in tasks.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    sums = tasks.select(
        F.col("length").alias("of_length"), F.col("task").alias("of_task"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
    )
    # one line per task and length; Spark broadcasts it while it is small, and moves the pieces where it is not
    match = (F.col("length") == F.col("of_length")) & (F.col("task") == F.col("of_task"))
    fields = ["doc_id", "piece", "start", "length", "ids_crc32"]
    ranked = cut.join(written(sums, "before"), match).select(*fields, "row", "ids", (F.col("before") + F.col("number")).alias("rank"))
    plan = places(solve(histogram, capacity)).sort_values(["length", "low"], ignore_index=True)
    held = spark.sparkContext.broadcast({n: g.drop(columns="length").to_numpy() for n, g in plan.groupby("length")})

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def seat(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        for n, rows in length.groupby(length).indices.items():
            low, _, first, at = held.value[n].T
            own = rank.to_numpy()[rows]
            k = np.searchsorted(low, own, side="right") - 1
            sequence[rows], offset[rows] = first[k] + own - low[k], at[k]
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    seated = ranked.withColumn("seat", seat("length", "rank")).select(*fields, "seat.*", "row", "ids")
    return seated.withColumn("doc_id", F.col("doc_id").cast(docs.schema[id_col].dataType))


@query()
def op6_pack_sequences(spark, sf):
    return pack(table(spark, sf, "documents")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
