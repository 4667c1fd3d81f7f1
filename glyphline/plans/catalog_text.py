"""Queries on words: tokens, lexicon polarity, term frequencies, cloud tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from glyphline.functions import text as tx
from glyphline.operators import polarity as po
from glyphline.operators import terms as tm
from glyphline.plans import bindings as b
from glyphline.plans.catalog_symbols import D, PAIR_COUNTS, S, _cells, _rounded
from glyphline.plans.registry import query
from glyphline.operators import groups as gr
from glyphline.operators import pairs as pr

TOKENS = "unnest(regexp_extract_all(lower(text), '[a-zA-Z'']+'))"
CLEAN = (
    "regexp_replace(regexp_replace(lower(coalesce(text, '')), "
    r"'http\S+|www\S+|https\S+', '', 'g'), '[^a-z\s]', '', 'g')"
)
WORDS = rf"unnest(regexp_extract_all({CLEAN}, '\S+'))"


def _cloud(text: str = "text") -> str:
    """Cloud tokens of a text as a SQL list."""
    found = rf"regexp_extract_all(lower({text}), '[\p{{L}}\p{{N}}_][\p{{L}}\p{{N}}_'']+')"
    cut = f"[regexp_replace(w, '''s$', '') FOR w IN {found}]"
    return rf"[w FOR w IN {cut} IF NOT regexp_full_match(w, '\p{{Nd}}+')]"


STOP = f"(SELECT word FROM {b.STOPWORDS_SQL})"


# ---------------------------------------------------------------- scalar functions


@query("SELECT doc_id, array_to_string(regexp_extract_all(lower(text), '[a-zA-Z'']+'), ' ') AS tokens FROM documents")
def f1_tokenize(spark, sf):
    return b.documents(spark, sf, "doc_id", "text").select(
        "doc_id", F.array_join(tx.tokenize("text"), " ").alias("tokens")
    )


@query(f"SELECT doc_id, {CLEAN} AS cleaned FROM documents")
def f2_clean_text(spark, sf):
    return b.documents(spark, sf, "doc_id", "text").select("doc_id", tx.clean_text("text").alias("cleaned"))


@query(r"SELECT doc_id, array_to_string(regexp_extract_all(text, '\S+'), ' ') AS words FROM documents")
def f3_words(spark, sf):
    return b.documents(spark, sf, "doc_id", "text").select(
        "doc_id", F.array_join(tx.words("text"), " ").alias("words")
    )


@query("SELECT source, string_agg(lang, '+' ORDER BY lang) AS langs FROM (SELECT DISTINCT source, lang FROM documents) GROUP BY source")
def f4_string_join(spark, sf):
    pairs = b.table(spark, sf, "documents").select("source", "lang").distinct()
    return pairs.groupBy("source").agg(F.array_join(F.array_sort(F.collect_list("lang")), "+").alias("langs"))


@query(
    """SELECT p_partkey, upper(left(trim(lower(split_part('  ' || p_name || ' ,x', ',', 1))), 1)) AS initial,
      CAST(p_size AS VARCHAR) AS size_text FROM part"""
)
def f5_trim_lower_split_cast(spark, sf):
    padded = F.concat(F.lit("  "), "p_name", F.lit(" ,x"))
    return b.table(spark, sf, "part").select(
        "p_partkey",
        F.upper(F.left(F.lower(tx.primary_category(padded)), F.lit(1))).alias("initial"),
        F.col("p_size").cast("string").alias("size_text"),
    )


@query(
    f"""WITH {PAIR_COUNTS} SELECT s1, s2, round(ln(1 + n), 6) AS log1p_n, round(ln(n + 2), 6) AS ln_n,
      abs(10 - n)::BIGINT AS distance, (n * n)::BIGINT AS square, round(n / 7.0::DOUBLE, 6) AS seventh FROM c"""
)
def f7_numeric_functions(spark, sf):
    n = F.col("n")
    return _rounded(
        pr.cooccurrence_counts(b.symbol_rows(spark, sf)).select(
            "s1", "s2", F.log1p(n).alias("log1p_n"), F.ln(n + 2).alias("ln_n"), F.abs(10 - n).alias("distance"),
            F.pow(n, F.lit(2)).cast("bigint").alias("square"), (n / F.lit(7.0)).alias("seventh"),
        ),
        "log1p_n", "ln_n", "seventh",
    )


@query(
    f"""WITH {_cells('lang', 4)}, r AS (SELECT symbol, sum(n) AS r FROM cells GROUP BY symbol),
      c AS (SELECT lang, sum(n) AS c FROM cells GROUP BY lang)
    SELECT symbol, lang, round(r * c / (SELECT sum(n) FROM cells)::DOUBLE, 6) AS expected
    FROM cells JOIN r USING (symbol) JOIN c USING (lang)"""
)
def f10_expected_counts(spark, sf):
    cells = gr.group_profile(b.symbol_rows(spark, sf, "lang"), "lang", 4)
    return _rounded(gr.with_expected(cells, "lang").select("symbol", "lang", "expected"), "expected")


@query(f"SELECT doc_id, array_to_string({_cloud()}, ' ') AS tokens FROM documents")
def f11_cloud_tokens(spark, sf):
    return b.documents(spark, sf, "doc_id", "text").select(
        "doc_id", F.array_join(tx.cloud_tokens("text"), " ").alias("tokens")
    )


# ---------------------------------------------------------------- lexicon


@query(
    f"""SELECT doc_id, word, polarity, count(*)::BIGINT AS n
    FROM (SELECT doc_id, {TOKENS} AS word FROM documents) JOIN {b.POLARITY_SQL} USING (word)
    GROUP BY doc_id, word, polarity"""
)
def j1_lexicon_hits(spark, sf):
    return po.lexicon_hits(b.documents(spark, sf, "doc_id", "text"), b.lexicon(spark), "text", "doc_id")


@query(f"""SELECT word, count(*)::BIGINT AS n FROM (SELECT {TOKENS} AS word FROM conversations)
    WHERE word NOT IN {STOP} GROUP BY word""")
def j6_drop_stopwords(spark, sf):
    found = po.tokens(b.conversations(spark, sf), "text").filter(F.col("word").isNotNull())
    return tm.drop_stopwords(found.groupBy("word").agg(F.count(F.lit(1)).alias("n")), b.stopwords(spark))


def _polarity(table: str, label: str) -> str:
    return f"""WITH h AS (SELECT label, polarity FROM (SELECT {label} AS label, {TOKENS} AS word FROM {table})
      JOIN {b.POLARITY_SQL} USING (word)),
    k AS (SELECT l.label, count(*) FILTER (polarity = 'pos')::BIGINT AS pos, count(*) FILTER (polarity = 'neg')::BIGINT AS neg
      FROM (SELECT DISTINCT {label} AS label FROM {table}) l LEFT JOIN h USING (label) GROUP BY l.label)"""


@query(_polarity("documents", "source") + " SELECT * FROM k")
def a9_polarity_counts(spark, sf):
    return po.polarity_counts(b.posts(spark, sf), b.lexicon(spark))


@query(_polarity("conversations", "role") + " SELECT * FROM k")
def a9_polarity_by_role(spark, sf):
    return po.polarity_counts(b.conversations(spark, sf).withColumnRenamed("role", "label"), b.lexicon(spark))


@query(_polarity("documents", "source") + " SELECT label, pos, neg, round(pos / nullif(neg, 0)::DOUBLE, 6) AS ratio FROM k")
def a10_polarity_ratio(spark, sf):
    return _rounded(po.polarity_ratio(po.polarity_counts(b.posts(spark, sf), b.lexicon(spark))), "ratio")


@query(
    _polarity("documents", "source")
    + """ SELECT label, pos, neg, round(pos / nullif(pos + neg, 0)::DOUBLE, 6) AS pos_share,
      round(neg / nullif(pos + neg, 0)::DOUBLE, 6) AS neg_share, pos + neg = 0 AS no_words FROM k"""
)
def a11_polarity_share(spark, sf):
    counts = po.polarity_counts(b.posts(spark, sf), b.lexicon(spark))
    return _rounded(po.polarity_share(counts), "pos_share", "neg_share")


# ---------------------------------------------------------------- terms

TERM_SQL = f"""WITH t AS (SELECT word, count(*)::BIGINT AS n FROM (SELECT {WORDS} AS word FROM documents)
  WHERE word NOT IN {STOP} GROUP BY word)"""


@query(TERM_SQL + " SELECT * FROM t")
def a16_term_frequency(spark, sf):
    return tm.term_frequency(b.documents(spark, sf, "text"), b.stopwords(spark))


TOP5 = f"""{D}, o AS (SELECT doc_id, unnest(syms) AS symbol FROM s),
  top AS (SELECT symbol FROM o GROUP BY symbol ORDER BY count(*) DESC, symbol LIMIT 5),
  ct AS (SELECT doc_id, unnest({_cloud()}) AS word FROM s),
  t AS (SELECT symbol, word, count(*)::BIGINT AS n FROM d JOIN top USING (symbol) JOIN ct USING (doc_id)
    WHERE word NOT IN {STOP} GROUP BY symbol, word)"""


def _symbol_terms(spark, sf):
    rows = b.symbol_rows(spark, sf, "text")
    return tm.term_frequency_by_symbol(rows, b.stopwords(spark), "text", 5)


@query(f"WITH {TOP5} SELECT * FROM t")
def a17_term_frequency_by_symbol(spark, sf):
    return _symbol_terms(spark, sf)


@query(
    f"""WITH {S}, ct AS (SELECT unnest({_cloud()}) AS word FROM s WHERE list_contains(syms, 'ñ'))
    SELECT 'ñ' AS symbol, word, count(*)::BIGINT AS n FROM ct WHERE word NOT IN {STOP} GROUP BY word"""
)
def a17_terms_of_one_symbol(spark, sf):
    rows = b.symbol_rows(spark, sf, "text")
    one = spark.sql("SELECT 'ñ' AS symbol")
    return tm.term_frequency_by_symbol(rows, b.stopwords(spark), "text", symbols=one)


@query(
    f"""WITH {TOP5}, w AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY n DESC, word)::BIGINT AS rnk,
      max(n) OVER (PARTITION BY symbol) AS top FROM t)
    SELECT symbol, word, n, rnk, round(n / top::DOUBLE, 6) AS weight FROM w WHERE rnk <= 200"""
)
def a18_term_weights(spark, sf):
    return _rounded(tm.term_weights(_symbol_terms(spark, sf), "symbol"), "weight")


@query(
    TERM_SQL
    + """, w AS (SELECT *, row_number() OVER (ORDER BY n DESC, word)::BIGINT AS rnk, max(n) OVER () AS top FROM t)
    SELECT word, n, rnk, round(n / top::DOUBLE, 6) AS weight FROM w WHERE rnk <= 200"""
)
def a18_corpus_weights(spark, sf):
    terms = tm.term_frequency(b.documents(spark, sf, "text"), b.stopwords(spark))
    return _rounded(tm.term_weights(terms), "weight")


SCORE = """
  y AS (SELECT *, c2 / nn AS p, c12 / c1 AS p1, (c2 - c12) / nullif(nn - c1, 0) AS p2 FROM x),
  z AS (SELECT *, CASE WHEN nn <= c1 OR nn <= c2 THEN 0 ELSE -2 * (
      (CASE WHEN c12 > 0 THEN c12 * ln(p) ELSE 0 END) + (CASE WHEN c1 - c12 > 0 THEN (c1 - c12) * ln(1 - p) ELSE 0 END)
    + (CASE WHEN c2 - c12 > 0 THEN (c2 - c12) * ln(p) ELSE 0 END)
    + (CASE WHEN nn - c1 - (c2 - c12) > 0 THEN (nn - c1 - (c2 - c12)) * ln(1 - p) ELSE 0 END)
    - (CASE WHEN c12 > 0 THEN c12 * ln(p1) ELSE 0 END) - (CASE WHEN c1 - c12 > 0 THEN (c1 - c12) * ln(1 - p1) ELSE 0 END)
    - (CASE WHEN c2 - c12 > 0 THEN (c2 - c12) * ln(p2) ELSE 0 END)
    - (CASE WHEN nn - c1 - (c2 - c12) > 0 THEN (nn - c1 - (c2 - c12)) * ln(1 - p2) ELSE 0 END)) END AS score FROM y)"""

NEIGHBOURS = f"""WITH l AS MATERIALIZED (SELECT {_cloud()} AS ws FROM documents),
  u AS MATERIALIZED (SELECT word, count(*) AS n FROM (SELECT unnest(ws) AS word FROM l) WHERE word NOT IN {STOP} GROUP BY word),
  g AS MATERIALIZED (SELECT unnest(list_zip(ws[:-2], ws[2:])) AS p FROM l WHERE len(ws) > 1),
  c AS MATERIALIZED (SELECT p[1] AS w1, p[2] AS w2, count(*) AS c12 FROM g
    WHERE p[1] NOT IN {STOP} AND p[2] NOT IN {STOP} GROUP BY ALL)"""

COLLOCATIONS = f"""{NEIGHBOURS},
  x AS (SELECT w1, w2, c12::DOUBLE AS c12, a.n::DOUBLE AS c1, z.n::DOUBLE AS c2, (SELECT sum(n) FROM u)::DOUBLE AS nn
    FROM c JOIN u a ON a.word = w1 JOIN u z ON z.word = w2),{SCORE}"""

@query(
    COLLOCATIONS
    + """ SELECT w1, w2, c12::BIGINT AS c12, c1::BIGINT AS c1, c2::BIGINT AS c2, round(score, 4) AS score
    FROM z WHERE score > 30"""
)
def a19_bigram_collocations(spark, sf):
    found = tm.bigram_collocations(b.documents(spark, sf, "text"), b.stopwords(spark))
    return found.withColumn("score", F.round("score", 4))


# every join is by equality of two columns: the singular of a term that may be a plural is a column of its own
SINGULAR = "CASE WHEN {0} LIKE '%s' AND {0} NOT LIKE '%ss' THEN left({0}, length({0}) - 1) END"
MERGED = f"""{NEIGHBOURS},
    us AS MATERIALIZED (SELECT word, n, {SINGULAR.format('word')} AS base FROM u),
    f AS MATERIALIZED (SELECT us.word, us.n, coalesce(b.word, us.word) AS std FROM us LEFT JOIN u b ON b.word = us.base),
    m AS MATERIALIZED (SELECT std, sum(n) AS n FROM f GROUP BY std),
    b AS MATERIALIZED (SELECT w1, w2, w1 || ' ' || w2 AS s, c12, {SINGULAR.format("(w1 || ' ' || w2)")} AS base FROM c),
    bm AS MATERIALIZED (SELECT coalesce(o.w1, b.w1) AS w1, coalesce(o.w2, b.w2) AS w2, sum(b.c12) AS c12
      FROM b LEFT JOIN b o ON o.s = b.base GROUP BY 1, 2),
    k AS MATERIALIZED (SELECT f.word, f.std, m.n FROM f JOIN m ON m.std = f.std),
    nn AS MATERIALIZED (SELECT sum(n)::DOUBLE AS nn FROM u),
    x AS MATERIALIZED (SELECT w1, w2, k1.std AS s1, k2.std AS s2, c12::DOUBLE AS c12, k1.n::DOUBLE AS c1, k2.n::DOUBLE AS c2, nn
      FROM bm JOIN k k1 ON k1.word = w1 JOIN k k2 ON k2.word = w2, nn),
    {SCORE}, hit AS MATERIALIZED (SELECT * FROM z WHERE score > 30),
    taken AS MATERIALIZED (SELECT word, sum(c12) AS n FROM (SELECT s1 AS word, c12 FROM hit UNION ALL SELECT s2, c12 FROM hit) GROUP BY word)"""


@query(
    f"""{MERGED} SELECT std AS word, (m.n - coalesce(taken.n, 0))::BIGINT AS n FROM m LEFT JOIN taken ON std = word
    WHERE m.n > coalesce(taken.n, 0)"""
)
def a19_cloud_words(spark, sf):
    """The single words of the cloud, without the occurrences that collocations take."""
    found = tm.cloud_frequencies(b.documents(spark, sf, "text"), b.stopwords(spark), "text")
    return found.filter(~F.contains("word", F.lit(" ")))


@query(f"{MERGED} SELECT w1 || ' ' || w2 AS word, c12::BIGINT AS n FROM hit")
def a19_cloud_pairs(spark, sf):
    """The collocations of the cloud."""
    found = tm.cloud_frequencies(b.documents(spark, sf, "text"), b.stopwords(spark), "text")
    return found.filter(F.contains("word", F.lit(" ")))


@query(
    f"""{MERGED} SELECT std AS word, (m.n - coalesce(taken.n, 0))::BIGINT AS n FROM m LEFT JOIN taken ON std = word
    WHERE m.n > coalesce(taken.n, 0) UNION ALL SELECT w1 || ' ' || w2, c12::BIGINT FROM hit"""
)
def a19_cloud_terms(spark, sf):
    return tm.cloud_frequencies(b.documents(spark, sf, "text"), b.stopwords(spark), "text")


@query(
    TERM_SQL
    + """ SELECT coalesce(b.word, t.word) AS word, sum(t.n)::BIGINT AS n
    FROM t LEFT JOIN t b ON t.word = b.word || 's' AND t.word NOT LIKE '%ss' GROUP BY 1"""
)
def a23_merge_plurals(spark, sf):
    return tm.merge_plurals(tm.term_frequency(b.documents(spark, sf, "text"), b.stopwords(spark)))
