"""Periodic runs of words, found online by dyadic square catchers.

Words are appended to a stream. Whenever a block of 2 ** k words at a multiple of 2 ** k is
complete, a catcher watches it for as long as a square whose first half holds the block can
still come: the words that follow are suffixes of the stream, and each appended word advances
one comparison per level, that of the suffix of 2 ** k words with the block between 2 ** k and
2 ** (k + 1) words before it (on the lowest level also of the block less than that before it).
A caught square is compared word by word and widened to the stretch that keeps its period;
squares of one stretch merge, and a stretch that reaches the end of the stream stays open and
is widened by the words that come later.

Suffixes are compared by fingerprints, which double from level to level, so a word costs a
constant time per level. A level keeps the fingerprints of its blocks and of the last 2 ** k
suffixes only, so memory stays proportional to the stream. Advancing takes any number of words
at once as arrays; documents go through one stream, parted by words that occur once.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from glyphline.llm.common import as_text, query, table

MIN_LENGTH = 24
MIN_REPEATS = 3
#: The lowest level has blocks of 8 words: a run of 24 words holds a whole block and its copy one period on.
LOWEST = 3
#: Words that go through one stream together.
STREAM = 1 << 17
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= _B
    return x ^ (x >> np.uint64(29))


class SquareCatchers:
    """The stream, its catchers and the stretches found so far.

    ``longest`` bounds the length of a run that can occur, where the caller knows it: levels
    above need no catchers.
    """

    def __init__(self, longest: int | None = None):
        self.longest = longest
        self.size = 0
        self._words = np.zeros(64, np.int64)
        #: for each level the fingerprints of its last suffixes, the place of the first of them, and those of the blocks
        self._tails: list[np.ndarray] = []
        self._first: list[int] = []
        self._blocks: list[np.ndarray] = []
        self._closed: list[tuple[int, int, int]] = []
        self._open: list[tuple[int, int, int]] = []

    def append(self, words: np.ndarray) -> None:
        """Advance by words given as integers."""
        old, self.size = self.size, self.size + len(words)
        if self.size > len(self._words):
            self._words = np.concatenate([self._words[:old], np.zeros(max(old, len(words)), np.int64)])
        self._words[old : self.size] = words
        self._advance_open()
        level = 0
        new, place = _mixed(words.astype(np.int64).view(np.uint64) + _A), old
        while True:
            if level == len(self._tails):
                self._tails.append(np.zeros(0, np.uint64))
                self._first.append(0)
                self._blocks.append(np.zeros(0, np.uint64))
            if level >= LOWEST:
                self._catch(level, new, place)
            half = 1 << level
            known = np.concatenate([self._tails[level], new])
            start = self._first[level]
            # suffixes of twice the length whose second half has come
            upto = max(start, self.size - 2 * half + 1)
            if upto == start or not self._wanted(level + 1):
                self._tails[level] = known
                break
            self._tails[level], self._first[level] = known[upto - start :], upto
            here = np.arange(upto - start)
            new, place = _mixed(known[here] * _A + known[here + half]), start
            level += 1

    def _wanted(self, level: int) -> bool:
        """Whether a run of the periods of the level fits."""
        most = self.size if self.longest is None else min(self.longest, self.size)
        return level <= LOWEST or MIN_REPEATS * ((1 << level) + 1) <= most

    def _catch(self, level: int, new: np.ndarray, place: int) -> None:
        """Compare the suffixes that the appended words complete with the blocks before them."""
        length = 1 << level
        self._blocks[level] = np.concatenate([self._blocks[level], new[-place % length :: length]])
        blocks = self._blocks[level]
        at = np.arange(place, place + len(new))
        found = []
        for gap in (0, length) if level == LOWEST else (length,):
            some = at > gap
            block = (at[some] - gap - 1) >> level
            hit = np.flatnonzero(blocks[block] == new[some])
            found.append((block[hit] << level, at[some][hit]))
        block, copy = (np.concatenate(x) for x in zip(*found))
        if len(block):
            self._merge(block, copy - block, length)

    def _merge(self, block: np.ndarray, period: np.ndarray, length: int) -> None:
        """Widen caught squares, those of neighbouring blocks with one period together."""
        order = np.lexsort((block, period))
        block, period = block[order], period[order]
        new = np.flatnonzero((np.diff(period) != 0) | (np.diff(block) != length)) + 1
        first = np.concatenate([[0], new])
        last = np.concatenate([new, [len(block)]]) - 1
        start, stop, period = block[first], block[last] + length, period[first]
        alive = np.ones(len(start), bool)
        for known in self._open:
            alive &= ~_inside(start, stop, period, known)
        for i in range(len(start)):
            if not alive[i]:
                continue
            pieces = [(int(start[i]), int(stop[i]))]
            if not self._equal(*pieces[0], int(period[i])):  # fingerprints clash: block by block
                pieces = [(b, b + length) for b in range(*pieces[0], length) if self._equal(b, b + length, int(period[i]))]
            for piece in pieces:
                stretch = self._widened(*piece, int(period[i]))
                (self._open if stretch[1] == self.size else self._closed).append(stretch)
                alive &= ~_inside(start, stop, period, stretch)

    def _equal(self, start: int, stop: int, period: int) -> bool:
        return np.array_equal(self._words[start:stop], self._words[start + period : stop + period])

    def _widened(self, start: int, stop: int, period: int) -> tuple[int, int, int]:
        """The stretch of words that keeps the period around words start to stop and their copies."""
        step = 32
        while start:
            low = max(0, start - step)
            other = np.flatnonzero(self._words[low:start] != self._words[low + period : start + period])
            if len(other):
                start = low + int(other[-1]) + 1
                break
            start, step = low, 2 * step
        return start, self._widened_right(stop + period, period), period

    def _widened_right(self, end: int, period: int) -> int:
        step = 32
        while end < self.size:
            high = min(self.size, end + step)
            other = np.flatnonzero(self._words[end:high] != self._words[end - period : high - period])
            if len(other):
                return end + int(other[0])
            end, step = high, 2 * step
        return end

    def _advance_open(self) -> None:
        still = []
        for start, end, period in self._open:
            end = self._widened_right(end, period)
            (still if end == self.size else self._closed).append((start, end, period))
        self._open = still

    def runs(self, min_length: int = MIN_LENGTH, min_repeats: int = MIN_REPEATS) -> list[tuple[int, int, int]]:
        """(start, length, period) of the runs of the stream so far, by start, then period.

        A stretch of three periods that also keeps a smaller one keeps it over its whole length, so of
        stretches with equal ends the smallest period is the run's.
        """
        least: dict[tuple[int, int], int] = {}
        for start, end, period in self._closed + self._open:
            if end - start >= max(min_length, min_repeats * period):
                least[start, end] = min(period, least.get((start, end), period))
        return sorted((start, end - start, period) for (start, end), period in least.items())


def _inside(start: np.ndarray, stop: np.ndarray, period: np.ndarray, known: tuple[int, int, int]) -> np.ndarray:
    """Which squares are implied by a stretch: they lie in it, at a multiple of its period."""
    low, end, own = known
    return (start >= low) & (stop + period <= end) & (period % own == 0)


def runs_of(documents: list[list], min_length: int = MIN_LENGTH, min_repeats: int = MIN_REPEATS) -> list[list[tuple]]:
    """The runs of each of some lists of words, from one stream."""
    if min_length < MIN_LENGTH or min_repeats < MIN_REPEATS:
        raise ValueError("catchers find runs from 24 words and three periods on")
    number: dict = defaultdict(count().__next__)
    parts, starts, at = [], [], 0
    for k, words in enumerate(documents):
        own = np.empty(len(words) + 1, np.int64)
        own[:-1] = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        own[-1] = -1 - k
        parts.append(own)
        starts.append(at)
        at += len(own)
    stream = SquareCatchers(max(map(len, documents), default=0))
    if parts:
        stream.append(np.concatenate(parts))
    out: list[list[tuple]] = [[] for _ in documents]
    for start, length, period in stream.runs(min_length, min_repeats):
        k = int(np.searchsorted(starts, start, side="right")) - 1
        out[k].append((start - starts[k], length, period))
    return out


def collapse(words: list, runs: list[tuple]) -> list:
    """The words, of each run only the first period."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(keep)]


def _split(doc_id: str | None, text: bytes) -> list[bytes]:
    return text.split()


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    min_length: int = MIN_LENGTH, min_repeats: int = MIN_REPEATS,
    words_of: Callable[[str | None, bytes], list[bytes]] = _split,
) -> DataFrame:
    """doc_id, n_words, runs (start, length, period by start, then period) and collapsed, one row per input row.

    Words are runs of anything but ASCII white space. A run keeps its smallest period for at least
    ``min_length`` words and ``min_repeats`` periods and no neighbouring word extends it; ``collapsed`` has the
    words outside runs and the first period of each, joined by one space. A null or empty text has no
    words, no runs and an empty ``collapsed``; a null or repeated id is carried through and each row judged
    for itself; an empty table gives an empty result; other columns are not read. ``words_of`` may
    rewrite the words of a document, given its id as text and its text in UTF-8.
    """

    def judged(ids: list, documents: list[list[bytes]]) -> pd.DataFrame:
        found = runs_of(documents, min_length, min_repeats)
        return pd.DataFrame({
            "doc_id": pd.Series(ids, dtype="object"),
            "n_words": np.fromiter(map(len, documents), np.int64, len(documents)),
            "runs": [[{"start": s, "length": n, "period": p} for s, n, p in own] for own in found],
            "collapsed": [b" ".join(collapse(words, own)) for words, own in zip(documents, found)],
        })

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, documents, held = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                words = words_of(doc_id, text or b"")
                ids.append(doc_id)
                documents.append(words)
                held += len(words) + 1
                if held >= STREAM:
                    yield judged(ids, documents)
                    ids, documents, held = [], [], 0
        if ids:
            yield judged(ids, documents)

    rows = docs.select(as_text(id_col).alias("doc_id"), as_text(text_col).cast("binary").alias("text"))
    kinds = "doc_id string, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed binary"
    found = rows.mapInPandas(run, kinds)
    return found.select(
        F.col("doc_id").cast(docs.schema[id_col].dataType).alias("doc_id"), "n_words", "runs",
        F.col("collapsed").cast("string").alias("collapsed"),
    )


def _planted(doc_id: str | None, text: bytes) -> list[bytes]:
    """The words of a document; those of every tenth id made periodic from a place on. A null id plants nothing."""
    words = text.split()
    if doc_id is None or not words:
        return words
    h = zlib.crc32(doc_id.encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + period] * ((n - a) // period + 1))[: n - a]


def _stronger(x, y):
    """Order of runs: greatest length over period, then smallest start, then period."""
    gap = y["length"] * x["period"] - x["length"] * y["period"]
    later = F.when(x["start"] != y["start"], x["start"] - y["start"]).otherwise(x["period"] - y["period"])
    return F.signum(F.when(gap != 0, gap).otherwise(later)).cast("int")


@query()
def op13_periodic_runs(spark, sf):
    found = periodic_runs(table(spark, sf, "documents"), words_of=_planted)
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    best = F.when(F.size("runs") > 0, F.get(F.array_sort("runs", _stronger), F.lit(0)))
    found = found.withColumn("best", best)
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
