"""Quality rules with cross-document line frequency.

Lines are normalised and hashed, and for each host the distinct documents with a line are
counted. Lines of too many documents of a host are removed from the texts, and a document that
loses most of its characters with them is rejected. Copies of one text count as one document,
so a text is not rejected for having been copied.

Everything is DataFrame functions. A first pass over the texts keeps line hashes and counts
them; a second has the list of its host beside each text, so no text is shuffled while the
lists are small enough for Spark to broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from glyphline.llm.common import SPACES, WORD, query, same, table, text_key, whole, written

SYMBOLS = "#*$%&|<>"
#: A line is boilerplate on a host when more documents than this, and than this share, have it.
MIN_DOCUMENTS = 10
MAX_SHARE = 0.05
#: A document is depleted when less than this share of its characters is left.
MIN_LEFT = 0.5
MIN_WORDS = 50


def normalised_line(line: Column) -> Column:
    """Lower case, digits as 0, everything but letters and digits as one space."""
    plain = F.translate(F.lower(line), "123456789", "000000000")
    return F.trim(F.regexp_replace(plain, r"[^\p{L}\p{N}]+", " "))


def _placed(grams: Column) -> Column:
    """The 3-word windows as sorted (hash, place) pairs; empty when no two are equal."""
    pairs = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    some = F.size(F.array_distinct(grams)) < F.size(grams)
    return F.when(some, pairs).otherwise(F.array().cast("array<struct<g:bigint,i:int>>"))


def _covered(placed: Column) -> Column:
    """Number of words inside windows whose hash a neighbour in the sorted pairs shares."""
    repeats = F.filter(
        placed,
        lambda e, k: (F.get(placed, k - 1)["g"] == e["g"]) | (F.get(placed, k + 1)["g"] == e["g"]),
    )
    words = F.flatten(F.transform(repeats, lambda e: F.array(e["i"], e["i"] + 1, e["i"] + 2)))
    return F.size(F.array_distinct(words)).cast("bigint")


def line_hashes(docs: DataFrame, text_col: str, host_col: str) -> DataFrame:
    """host, digest of the text, and the distinct hashes of its lines that have letters or digits."""
    plain = F.filter(F.transform(F.split(whole(text_col), "\n"), normalised_line), lambda n: F.length(n) > 0)
    return docs.select(
        F.col(host_col).alias("host"), text_key(text_col).alias("digest"),
        F.array_distinct(F.transform(plain, lambda n: F.xxhash64(n))).alias("lines"),
    )


def boilerplate(rows: DataFrame, min_documents: int, max_share: float) -> DataFrame:
    """Lines that more than ``min_documents`` distinct documents, and more than the share, of a host have.

    Document and line are grouped first, so a line that a third of all documents have is
    spread over them and only counts meet.
    """
    seen = rows.select("host", "digest", F.explode("lines").alias("h")).distinct()
    counts = seen.groupBy("host", "h").agg(F.count("*").alias("n")).filter(F.col("n") > min_documents)
    hosts = rows.groupBy("host").agg(F.countDistinct("digest").alias("documents"))
    return (
        counts.alias("c")
        .join(hosts.alias("d"), same(F.col("c.host"), F.col("d.host")))
        .filter(F.col("c.n") > max_share * F.col("d.documents"))
        .select("c.host", "c.h")
    )


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _cleaned(
    docs: DataFrame, id_col: str, text_col: str, host_col: str, min_documents: int, max_share: float, min_left: float
) -> DataFrame:
    """One row per input row: ``own`` (its other columns), counts, verdict, and ``text`` without its flagged lines.

    With a share of s a host's list has at most 1/s times as many lines as its documents have on average.
    """
    lines = written(line_hashes(docs, text_col, host_col), "quality")
    common = boilerplate(lines, min_documents, max_share).groupBy("host").agg(F.collect_list("h").alias("flagged"))
    common = written(common, "boilerplate").alias("b")
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col])
    rows = docs.select(
        own.alias("own"), F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"), F.col(text_col).alias("given")
    ).alias("d")
    rows = rows.join(common, same(F.col("d.host"), F.col("b.host")), "left").select(
        "own", "doc_id", "d.host", "given", whole("given").alias("text"), "flagged"
    )
    rows = rows.select(
        "*", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("words"), F.split("text", "\n").alias("lines")
    )
    at = lambda k: F.get("words", k)
    last = F.size("words") - 3
    grams = F.when(
        last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(at(i), at(i + 1), at(i + 2)))
    ).otherwise(F.array().cast("array<bigint>"))
    counted = rows.select(
        "own", "doc_id", "host", "given", "lines", "flagged",
        text_key("text").alias("digest"),
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.translate("text", SPACES, "")).cast("bigint").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        F.filter("lines", lambda x: F.length(F.translate(x, SPACES, "")) > 0).alias("full"),
        grams.alias("grams"),
        F.transform(
            F.transform("lines", normalised_line),
            lambda n: F.struct(F.xxhash64(n).alias("h"), F.length(n).cast("bigint").alias("n")),
        ).alias("marks"),
    )
    # stages of their own: a column read inside a lambda is then computed once for a row
    counted = counted.withColumns({
        "placed": _placed(F.col("grams")), "bad": F.array_intersect(F.col("marks.h"), F.col("flagged")),
    })
    some = F.size(F.coalesce("bad", F.array().cast("array<bigint>"))) > 0
    length = lambda marks: F.aggregate(marks, F.lit(0).cast("bigint"), lambda a, m: a + m["n"])
    stay = F.filter("lines", lambda x, i: ~F.array_contains("bad", F.get("marks", i)["h"]))
    judged = counted.select(
        "own", "doc_id", "host", "digest", "n_words", "word_chars", "n_symbols",
        (F.size("full") - F.size(F.array_distinct("full"))).cast("bigint").alias("n_dup_lines"),
        _covered(F.col("placed")).alias("n_repeat_words"),
        length("marks").alias("line_chars"),
        F.when(some, length(F.filter("marks", lambda m: F.array_contains("bad", m["h"])))).otherwise(0).alias("removed_chars"),
        some.alias("cut"),
        F.when(some, F.array_join(stay, "\n")).otherwise(F.col("given")).alias("text"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    left = F.col("line_chars") - F.col("removed_chars")
    judged = judged.withColumn("base_failed", failed)
    return judged.withColumn("kept", ~F.col("base_failed") & (left >= min_left * F.col("line_chars")))


def judge(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    min_documents: int = MIN_DOCUMENTS,
    max_share: float = MAX_SHARE,
    min_left: float = MIN_LEFT,
) -> DataFrame:
    """One row per input row with its counts, its verdict and its ``text`` without the flagged lines.

    The counts are those of the whole text. A null text has no words, fails the base rules and
    stays null; a null host is a host of its own; a null or repeated id is carried through; an
    empty table gives an empty result. Columns beside the three named ones are not read, so
    their names cannot clash. ``host``, ``digest``, ``line_chars`` and ``removed_chars`` explain
    the verdict.
    """
    found = _cleaned(docs, id_col, text_col, host_col, min_documents, max_share, min_left)
    return found.select("doc_id", *COUNTS, "base_failed", "kept", "host", "digest", "line_chars", "removed_chars", "text")


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The documents that the rules keep, without their flagged lines, with all columns of ``docs``.

    A null text fails the base rules and goes; a null or repeated id, a null host and further columns of
    any name are carried through; rows that repeat all columns each stay; an empty table stays empty.
    """
    found = _cleaned(docs, id_col, text_col, host_col, MIN_DOCUMENTS, MAX_SHARE, MIN_LEFT)
    # judged rows are written before they are filtered: pushed below, the filter would repeat every
    # expression that the verdict is made of, and compute the words of a text once for each word
    found = written(found.select("own", "text", "cut", "kept"), "judged").filter("kept")
    changed = {text_col: F.col("text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("cut"), F.length("text").cast("bigint")).otherwise(F.col("own.n_chars"))
    return found.select(*[changed.get(c, F.col(f"own.`{c}`")).alias(c) for c in docs.columns])


SQL = rf"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT r, regexp_extract_all(text, '{WORD}') AS words, string_split(text, chr(10)) AS lines FROM d),
g AS (
  SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) > 2)),
rep AS (
  SELECT r, count(DISTINCT p) AS n_repeat_words FROM (
    SELECT r, unnest([i, i + 1, i + 2]) AS p FROM (SELECT *, count(*) OVER (PARTITION BY r, gram) AS n FROM g) WHERE n > 1)
  GROUP BY r),
l AS (
  SELECT r, trim(regexp_replace(translate(lower(line), '123456789', '000000000'), '[^\p{{L}}\p{{N}}]+', ' ', 'g')) AS line
  FROM (SELECT r, unnest(lines) AS line FROM w)),
h AS (SELECT source, count(DISTINCT text) AS documents FROM d GROUP BY source),
c AS (SELECT source, line, count(DISTINCT text) AS n FROM l JOIN d USING (r) WHERE line <> '' GROUP BY source, line),
f AS (
  SELECT c.source, c.line FROM c JOIN h ON c.source IS NOT DISTINCT FROM h.source
  WHERE n > {MIN_DOCUMENTS} AND n > {MAX_SHARE} * documents),
s AS (
  SELECT r, sum(length(l.line)) AS total, coalesce(sum(length(l.line)) FILTER (f.line IS NOT NULL), 0) AS removed
  FROM l JOIN d USING (r) LEFT JOIN f ON f.line = l.line AND f.source IS NOT DISTINCT FROM d.source GROUP BY r),
b AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
    (length(text) - length(translate(text, '{SYMBOLS}', '')))::BIGINT AS n_symbols,
    (len(list_filter(lines, lambda x: regexp_matches(x, '{WORD}')))
      - len(list_distinct(list_filter(lines, lambda x: regexp_matches(x, '{WORD}')))))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, total, removed
  FROM d JOIN w USING (r) LEFT JOIN rep USING (r) LEFT JOIN s USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed AS base_failed,
  NOT failed AND total - removed >= {MIN_LEFT} * total AS kept
FROM (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS failed FROM b)
"""


@query(SQL)
def op7_quality_rules(spark, sf):
    return judge(table(spark, sf, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
