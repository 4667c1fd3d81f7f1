"""Text columns: combining, cleaning, tokenising.

White space is the full Unicode set in every pattern (Java's ``\\s`` is ASCII only,
so a no-break space would glue words together).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

SPACE = (
    r"\x{0009}-\x{000D}\x{001C}-\x{0020}\x{0085}\x{00A0}\x{1680}"
    r"\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
WORD = r"\p{L}\p{N}_"

# Java tests the parts of a class in order, so the common ASCII cases come first
NOT_SPACE = rf"[[^\s]&&[!-~[^{SPACE}]]]"

TOKEN_PATTERN = "[a-zA-Z']+"
URL_PATTERN = f"http{NOT_SPACE}+|www{NOT_SPACE}+|https{NOT_SPACE}+"
NOT_LETTER_PATTERN = rf"[[^a-z\s]&&[!-~[^{SPACE}]]]+"
NOT_SPACE_PATTERN = f"{NOT_SPACE}+"
EDGE_SPACES_PATTERN = f"^[{SPACE}]+|[{SPACE}]+$"
CLOUD_TOKEN_PATTERN = f"[{WORD}][{WORD}']+"
CLEAN_WORD_PATTERN = "[a-z]+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def none_of(column: Column | str, values) -> Column:
    """True unless the column is one of the values. Null is none of them: a plain ``NOT IN``
    would be null for it, and a filter would drop the row."""
    return ~F.coalesce(_col(column).isin(list(values)), F.lit(False))


def combined_text(*cols: Column | str) -> Column:
    """The columns with a space between them, null as empty."""
    parts: list[Column] = []
    for c in cols:
        parts += [F.lit(" "), F.coalesce(_col(c).cast("string"), F.lit(""))]
    return F.concat(*parts[1:])


def strip(text: Column | str) -> Column:
    return F.regexp_replace(_col(text), EDGE_SPACES_PATTERN, "")


def tokenize(text: Column | str) -> Column:
    """Lower-cased runs of ASCII letters and apostrophes."""
    return F.regexp_extract_all(F.lower(_col(text)), F.lit(TOKEN_PATTERN), F.lit(0))


def clean_text(text: Column | str) -> Column:
    """Lower case, links removed, then everything but a-z and white space removed."""
    lowered = F.lower(F.coalesce(_col(text), F.lit("")))
    linked = F.contains(lowered, F.lit("http")) | F.contains(lowered, F.lit("www"))
    no_links = F.when(linked, F.regexp_replace(lowered, URL_PATTERN, "")).otherwise(lowered)
    return F.regexp_replace(no_links, NOT_LETTER_PATTERN, "")


def words(text: Column | str) -> Column:
    """White-space split without empty pieces."""
    return F.regexp_extract_all(_col(text), F.lit(NOT_SPACE_PATTERN), F.lit(0))


def clean_words(text: Column | str) -> Column:
    """Words of the cleaned text, which holds nothing but letters and white space."""
    return F.regexp_extract_all(clean_text(text), F.lit(CLEAN_WORD_PATTERN), F.lit(0))


def raw_cloud_tokens(text: Column | str) -> Column:
    """Case-folded runs of two or more word characters."""
    return F.regexp_extract_all(F.lower(_col(text)), F.lit(CLOUD_TOKEN_PATTERN), F.lit(0))


def cloud_word(token: Column) -> Column:
    """A raw token without a final 's; null for a pure number."""
    cut = F.when(token.endswith("'s"), F.left(token, F.length(token) - F.lit(2))).otherwise(token)
    # a token that starts with a-z is no number; the pattern is for the few others
    return F.when(F.ascii(cut).between(97, 122) | cut.rlike(r"\P{Nd}"), cut)


def cloud_tokens(text: Column | str) -> Column:
    """Tokens of a word cloud: two or more word characters, a final 's cut off,
    pure numbers dropped, case folded."""
    tokens = raw_cloud_tokens(text)
    # only texts with a digit or an 's have tokens to cut or drop, which is a step for each token
    odd = F.rlike(F.lower(_col(text)), F.lit(r"'s|\p{Nd}"))
    return F.when(odd, F.filter(F.transform(tokens, cloud_word), lambda w: w.isNotNull())).otherwise(tokens)


def primary_category(categories: Column | str) -> Column:
    """First comma-separated piece, trimmed; missing gives the empty category."""
    first = F.split_part(F.coalesce(_col(categories), F.lit("")), F.lit(","), F.lit(1))
    return F.coalesce(strip(first), F.lit(""))


def first_present(df: DataFrame, names: list[str]) -> Column:
    """The first of the named columns that exists; its nulls do not fall through."""
    for name in names:
        if name in df.columns:
            return F.col(name)
    raise ValueError(f"none of {names} is a column")


def argmax_label(scores: Column | str) -> Column:
    """Key with the largest value of a map, smallest key on ties; empty gives null."""
    ranked = F.transform(
        F.map_entries(_col(scores)), lambda e: F.struct((-e["value"]).alias("v"), e["key"].alias("k"))
    )
    return F.array_min(ranked)["k"]


def max_pair(pairs: Column | str) -> Column:
    """Largest (label, score) tuple of an array of structs, compared field by field."""
    return F.array_max(_col(pairs))
