"""Symbol extraction.

A vocabulary is a regular-expression character class of single code points, so
extraction is one JVM regex pass and needs no join. Sequences (flags, keycaps,
joined emoji) are a second, separate pattern: a row can hold a sequence and no
vocabulary symbol, or the other way round.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from glyphline.functions.fixed_values import EMOJI_RANGES, SYMBOL_BLOCKS


def _code_point(cp: int) -> str:
    return rf"\x{{{cp:04X}}}"


def symbol_class(symbols: Iterable[str]) -> str:
    """Character class for single-code-point symbols."""
    points = sorted({ord(s) for s in symbols})
    if not points:
        raise ValueError("an empty vocabulary matches nothing")
    return "[" + "".join(_code_point(p) for p in points) + "]"


def _ranges(blocks: list[tuple[int, int]]) -> str:
    return "".join(_code_point(a) if a == b else f"{_code_point(a)}-{_code_point(b)}" for a, b in blocks)


def _nested(blocks: list[tuple[int, int]]) -> str:
    """Ranges in groups, each group behind a test of its whole span."""
    if len(blocks) <= 4:
        return _ranges(blocks)
    step = -(-len(blocks) // 4)
    groups = [blocks[i : i + step] for i in range(0, len(blocks), step)]
    return "".join(f"[[{_ranges([(g[0][0], g[-1][1])])}]&&[{_nested(g)}]]" for g in groups)


def block_class(blocks: Iterable[tuple[int, int]] = SYMBOL_BLOCKS) -> str:
    """Character class for whole code-point ranges.

    Java tests the ranges of a class one after the other, for every character of every
    text. So characters below the first range (all of ASCII, as a rule) are turned away
    by one comparison, and the rest goes through nested groups.
    """
    ordered = sorted(blocks)
    return f"[[^{_ranges([(0, ordered[0][0] - 1)])}]&&[{_nested(ordered)}]]"


def emoji_class() -> str:
    """Character class of every code point that is an emoji on its own."""
    pairs = []
    for piece in EMOJI_RANGES.split():
        first, _, last = piece.partition("-")
        pairs.append((int(first, 16), int(last or first, 16)))
    return block_class(pairs)


def class_from_table(vocab: DataFrame, column: str = "symbol") -> str:
    """Character class for a vocabulary held as a table.

    The symbols travel to the driver because they become part of the plan: distinct code
    points, of which Unicode bounds the number.
    """
    return symbol_class(r[0] for r in vocab.select(column).distinct().collect())


def sequence_regex(sequences: Iterable[str]) -> str:
    """Alternation over symbol sequences, longest first so that none is cut short."""
    ordered = sorted(set(sequences), key=lambda s: (-len(s), s))
    return "|".join("".join(_code_point(ord(c)) for c in s) for s in ordered)


class _Trie(dict):
    """Children by code point; ``ends`` where a sequence ends."""

    ends = False


def _class_of(points: list[int]) -> str:
    """Character class of sorted code points, neighbours as ranges, many ranges nested."""
    blocks: list[tuple[int, int]] = []
    for p in points:
        if blocks and blocks[-1][1] == p - 1:
            blocks[-1] = (blocks[-1][0], p)
        else:
            blocks.append((p, p))
    return f"[{_nested(blocks)}]"


def _after(node: _Trie) -> str:
    """What may follow a code point: the longest continuation first, by greed."""
    if not node:
        return ""
    return f"(?:{_branch(sorted(node.items()))})?" if node.ends else f"(?:{_branch(sorted(node.items()))})"


def _branch(children: list[tuple[int, _Trie]]) -> str:
    """One of the children. Those without children of their own are one class; many others are cut into
    groups behind a look-ahead of their span, so that a code point is not compared with each of them."""
    plain = [point for point, node in children if not node]
    deep = [(point, node) for point, node in children if node]
    parts = [_class_of(plain)] if plain else []
    if len(deep) <= 4:
        parts += [_code_point(point) + _after(node) for point, node in deep]
    else:
        step = -(-len(deep) // 4)
        for at in range(0, len(deep), step):
            group = deep[at : at + step]
            parts.append(f"(?=[{_ranges([(group[0][0], group[-1][0])])}])(?:{_branch(group)})")
    return "|".join(parts)


def sequence_trie(sequences: Iterable[str]) -> str:
    """One pattern for many sequences, by their common beginnings.

    Equal to ``sequence_regex`` in what it finds: at every place the longest sequence. An alternation tries
    all sequences at every code point; the trie reads each code point of a text once, whatever their
    number, and those that start none are turned away by one class. Java compiles it once per task.
    """
    root = _Trie()
    for sequence in sequences:
        node = root
        for c in sequence:
            node = node.setdefault(ord(c), _Trie())
        node.ends = True
    if not root:
        raise ValueError("no sequences match nothing")
    return f"(?={_class_of(sorted(root))})(?:{_branch(sorted(root.items()))})"


def trie_from_table(sequences: DataFrame, column: str = "sequence") -> str:
    """``sequence_trie`` of a table; null and empty sequences are left out.

    Like a vocabulary the sequences become part of the plan, so they travel to the driver: a list that people
    keep, not one that grows with the texts.
    """
    known = sequences.select(F.col(column).alias("s")).filter("s <> ''").distinct()
    return sequence_trie(r["s"] for r in known.toLocalIterator())


def emoji_sequence_patterns() -> tuple[str, str]:
    """Flags, tag flags and joined or modified emoji; and keycaps.

    Two patterns that cannot overlap. As one alternation Java would run several times
    slower; the look-ahead spares ordinary characters the alternatives.
    """
    one = emoji_class() + r"[\x{FE0F}\x{1F3FB}-\x{1F3FF}]*"
    alternatives = (
        r"[\x{1F1E6}-\x{1F1FF}]{2}",
        r"\x{1F3F4}[\x{E0030}-\x{E0039}\x{E0061}-\x{E007A}]+\x{E007F}",
        one + r"(?:\x{200D}" + one + ")*",
    )
    return r"(?=[^\x{0000}-\x{00A8}])(?:" + "|".join(alternatives) + ")", r"[0-9#*]\x{FE0F}?\x{20E3}"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def extract_symbols(text: Column | str, vocab: str) -> Column:
    """Symbols of the vocabulary in reading order, repeats kept."""
    return F.regexp_extract_all(_col(text), F.lit(vocab), F.lit(0))


def symbols_string(symbols: Column | str) -> Column:
    return F.array_join(_col(symbols), " ")


def has_symbol(text: Column | str, vocab: str) -> Column:
    """True when at least one vocabulary symbol occurs."""
    return F.coalesce(_col(text), F.lit("")).rlike(vocab)


def _patterns(pattern: str | Iterable[str]) -> list[str]:
    return [pattern] if isinstance(pattern, str) else list(pattern)


def has_symbol_seq(pattern: str | Iterable[str], *texts: Column | str) -> Column:
    """True when a sequence occurs in any of the columns; null counts as no."""
    found = F.lit(False)
    for t in texts:
        for p in _patterns(pattern):
            found = found | F.coalesce(_col(t).rlike(p), F.lit(False))
    return found


def symbol_seq_count(text: Column | str, pattern: str | Iterable[str]) -> Column:
    """Number of sequences; several patterns must not be able to overlap."""
    total = F.lit(0)
    for p in _patterns(pattern):
        total = total + F.coalesce(F.regexp_count(_col(text), F.lit(p)), F.lit(0))
    return total
