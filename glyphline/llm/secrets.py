"""Secret scans: patterns, and a guess-cost dynamic program for values in credential contexts.

Three base patterns find assignments, access keys and long hexadecimal runs. Beside them, a
value that stands where a credential stands (``password is …``, ``Authorization: Bearer …``,
``scheme://user:…@host``) is segmented at minimum cost into dictionary words, dates, repeats,
keyboard walks and brute-force spans; the cost is the decimal logarithm of the guesses an
attacker needs, and a value that needs many is a secret. "password: required" is not.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import public_tokenizers
from pyspark.sql import Column, DataFrame, functions as F

from glyphline.llm.common import as_text, query, table

VOCABULARY = "byte_bpe_50k.json"
#: Decimal logarithm of guesses from which a value counts as a secret.
MIN_GUESSES = 10.0
KINDS = ("assign", "access", "hex", "guess")

_KEYS = r"(password|passwd|secret|token|api_?key)"
ASSIGN = re.compile(_KEYS + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_VALUE = 6
MIN_ACCESS = 20

_CREDENTIAL = (
    r"(?:pass(?:word|wd|phrase|code)|pwd|secret|token|api[ _-]?key|access[ _-]?key|private[ _-]?key|credentials?"
    r"|authorization|auth|login)"
)
_VALUE = r"""(?:"([^"\s]{6,})"|'([^'\s]{6,})'|`([^`\s]{6,})`|([^\s"'`]{6,}))"""
CONTEXTS = [
    re.compile(rf"""{_CREDENTIAL}["'`]?\s*(?:=>|:=|[:=]|\bis\b|\bwas\b)\s*{_VALUE}""", re.ASCII | re.IGNORECASE),
    re.compile(rf"\b(?:bearer|basic)\s+{_VALUE}", re.ASCII | re.IGNORECASE),
    re.compile(rf"--?(?:password|pass|token|secret|key)[ =]+{_VALUE}", re.ASCII | re.IGNORECASE),
    re.compile(r"://[^\s:/@]*:([^\s/@]{6,})@"),
]
#: Words without which no context matches; a text without any of them is not searched.
HINTS = ("pass", "pwd", "secret", "token", "key", "credential", "auth", "login", "bearer", "basic", "://")
TRAILING = ".,;:!?)]}>"

ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./", "abcdefghijklmnopqrstuvwxyz")
_NEXT = {a + b for row in ROWS for a, b in zip(row, row[1:])}
WALKS = frozenset(_NEXT | {p[::-1] for p in _NEXT})
DATE = re.compile(
    r"(?:19|20)\d\d[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:0[1-9]|[12]\d|3[01])"
    r"|(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:(?:19|20)\d\d|\d\d)"
)
YEAR = re.compile(r"(?:19|20)\d\d")
DATE_COST, YEAR_COST = math.log10(365 * 120), math.log10(120)
#: Every segment after the first multiplies the guesses: where it is cut is part of the secret.
SEGMENT_COST = 0.3
LONGEST_WORD = 20


@lru_cache(maxsize=2)
def _dictionary(path: str) -> dict[str, float]:
    """Lower-case words of the tokenizer's vocabulary with the logarithm of their rank."""
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    words: dict[str, float] = {}
    for token, rank in sorted(vocabulary.items(), key=lambda x: x[1]):
        word = token.lstrip("Ġ").lower()
        if 3 <= len(word) <= LONGEST_WORD and word.isascii() and word.isalpha():
            words.setdefault(word, math.log10(rank + 1))
    return words


def _brute(char: str) -> float:
    if char.isdigit():
        return 1.0
    return math.log10(26) if char.isalpha() else math.log10(33)


def guess_cost(value: str, words: dict[str, float]) -> float:
    """Least decimal logarithm of guesses over all segmentations of the value.

    One pass over the places of the value: each looks back at the words, the date, the repeat
    and the walk that end there, so the work grows with the length and not its square.
    """
    lower = value.lower()
    n = len(value)
    best = [0.0] * (n + 1)
    in_brute = [math.inf] * (n + 1)  # cost when the last segment is a brute-force span
    dates: dict[int, list[tuple[int, float]]] = {}
    for pattern, cost in ((DATE, DATE_COST), (YEAR, YEAR_COST)):
        for start in range(n):
            if value[start].isdigit() and (m := pattern.match(value, start)):
                dates.setdefault(m.end(), []).append((start, cost))
    repeat = walk = 0  # where the runs that end here began
    for end in range(1, n + 1):
        char = value[end - 1]
        if end > 1 and value[end - 2] != char:
            repeat = end - 1
        if end > 1 and lower[end - 2 : end] not in WALKS:
            walk = end - 1
        opening = lambda start: SEGMENT_COST if start else 0.0
        brute = _brute(char)
        in_brute[end] = brute + min(in_brute[end - 1], best[end - 1] + opening(end - 1))
        options = [in_brute[end]]
        for start in range(max(0, end - LONGEST_WORD), end - 2):
            word = lower[start:end]
            if word in words:
                case = 0.0 if value[start:end] == word else math.log10(2 if value[start:end].istitle() else 4)
                options.append(best[start] + opening(start) + words[word] + case)
        if end - repeat >= 3:
            options.append(best[repeat] + opening(repeat) + brute + math.log10(end - repeat))
        if end - walk >= 3:
            options.append(best[walk] + opening(walk) + math.log10(47 * (end - walk)))
        for start, cost in dates.get(end, ()):
            options.append(best[start] + opening(start) + cost)
        best[end] = min(options)
    return best[n]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """The spans of the three patterns, each leftmost and without overlap, as (start, kind number, end)."""
    found = []
    lower = text.lower()
    if any(k in lower for k in ("password", "passwd", "secret", "token", "apikey", "api_key")):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def guessed_spans(text: str, words: dict[str, float], min_guesses: float) -> set[tuple[int, int, int]]:
    """Values in credential contexts that need many guesses."""
    lower = text.lower()
    if not any(h in lower for h in HINTS):
        return set()
    found = set()
    for pattern in CONTEXTS:
        for m in pattern.finditer(text):
            start, end = m.span(next(g for g in range(1, (m.lastindex or 0) + 1) if m[g] is not None))
            while end > start and text[end - 1] in TRAILING:
                end -= 1
            if end - start >= MIN_VALUE and guess_cost(text[start:end], words) >= min_guesses:
                found.add((start, 3, end))
    return found


def spans(text: str | None, words: dict[str, float], min_guesses: float) -> tuple[list, list]:
    """Base spans, and all spans in order: guessed values inside a base span add nothing."""
    text = text or ""
    base = base_spans(text)
    added = [
        g for g in guessed_spans(text, words, min_guesses) if not any(s <= g[0] and g[2] <= e for s, _, e in base)
    ]
    return base, sorted(base + added)


def _listed(found: list) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in found)


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
    min_guesses: float = MIN_GUESSES,
) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans: one row per input row, in code points.

    A null text is empty and has no spans; ids are carried through, null or repeated; an empty
    table gives an empty result; columns beside the two named ones are not read. Texts are
    searched whole and values segmented whole, whatever their length.
    """
    path = vocabulary or public_tokenizers.path(VOCABULARY)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = _dictionary(path)
        for batch in batches:
            rows = []
            for text in batch["text"]:
                base, found = spans(text, words, min_guesses)
                kinds = [kind for _, kind, _ in base]
                digest = hashlib.sha256(_listed(base).encode()).hexdigest()
                rows.append((kinds.count(0), kinds.count(1), kinds.count(2), digest, _listed(found)))
            out = pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans"])
            out.insert(0, "doc_id", batch["doc_id"].array)
            yield out

    rows = docs.select(as_text(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = rows.mapInPandas(
        run, "doc_id string, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
    )
    return found.withColumn("doc_id", F.col("doc_id").cast(docs.schema[id_col].dataType))


def redacted(text: str | Column, vocabulary: str | None = None, min_guesses: float = MIN_GUESSES, mark: str = "[SECRET]") -> Column:
    """The text with every span, overlapping ones as one, replaced by a mark; null stays null."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)

    def clean(value: str | None, words: dict[str, float]) -> str | None:
        if value is None:
            return None
        _, found = spans(value, words, min_guesses)
        parts, at = [], 0
        for start, _, end in found:
            if start >= at:
                parts += [value[at:start], mark]
            at = max(at, end)
        return "".join(parts) + value[at:] if found else value

    @F.pandas_udf("string")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words = _dictionary(path)
        for batch in texts:
            yield pd.Series([clean(t, words) for t in batch], dtype=object)

    return run(text)


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents with their secrets replaced; ``n_chars``, where there is one, follows the text.

    A null text stays null and has no characters; every row stays, repeated ones as well; an empty table stays empty.
    """
    out = docs.withColumn(text_col, redacted(text_col))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length(text_col), F.lit(0)).cast("bigint"))
    return out


@query()
def op8_secret_scan(spark, sf):
    return scan(table(spark, sf, "documents"))
