"""Queries on symbols: projections, filters, counts, pairs, groups, profile, top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from glyphline.functions.symbols import (
    block_class,
    extract_symbols,
    has_symbol,
    has_symbol_seq,
    sequence_regex,
    symbol_seq_count,
    symbols_string,
    trie_from_table,
)
from glyphline.functions.text import combined_text, first_present, primary_category
from glyphline.operators import frequency as fq
from glyphline.operators import groups as gr
from glyphline.operators import pairs as pr
from glyphline.operators import profile as pf
from glyphline.operators import reach as rc
from glyphline.operators.polarity import restrict_labels
from glyphline.operators.sentiment import symbol_sentiment
from glyphline.operators.suggest import ranked_model
from glyphline.plans import bindings as b
from glyphline.plans.registry import query
from glyphline.session import scratch_path

CLS = "[éèêçäöüßñíóÉÈÊÇÄÖÜÑÍÓ|%*&$#!+=@-]"
SEQUENCES = ["!", "!!", "é", "éè", "ß", "%%", "ü"]
SEQ = "éè|!!|%%|!|é|ß|ü"

# documents with their symbol lists, rows without a symbol left out
S = f"""s AS (
  SELECT * FROM (SELECT doc_id, lang, source, text, regexp_extract_all(text, '{CLS}') AS syms FROM documents)
  WHERE len(syms) > 0)"""
D = f"{S}, d AS (SELECT DISTINCT doc_id, lang, source, unnest(syms) AS symbol FROM s)"
O = f"{S}, o AS (SELECT doc_id, source, unnest(syms) AS symbol FROM s)"
PAIRS = f"{D}, p AS (SELECT x.doc_id, x.symbol AS s1, y.symbol AS s2 FROM d x JOIN d y ON x.doc_id = y.doc_id AND x.symbol < y.symbol)"
PAIR_COUNTS = f"{PAIRS}, c AS (SELECT s1, s2, count(*)::BIGINT AS n FROM p GROUP BY s1, s2)"


def _top_groups(group: str, k: int, where: str = "true") -> str:
    return f"SELECT {group} FROM s WHERE {where} GROUP BY {group} ORDER BY count(*) DESC, {group} LIMIT {k}"


def _cells(group: str, k: int, where: str = "true") -> str:
    return (
        f"{D}, cells AS (SELECT {group}, symbol, count(*)::BIGINT AS n FROM d "
        f"WHERE {group} IN ({_top_groups(group, k, where)}) GROUP BY {group}, symbol)"
    )


# ---------------------------------------------------------------- projections and filters


@query("SELECT conv_id, turn, coalesce(role, '') || ' ' || coalesce(text, '') AS combined FROM conversations")
def p1_combined_text(spark, sf):
    return b.conversations(spark, sf).select("conv_id", "turn", combined_text("role", "text").alias("combined"))


@query(
    f"""SELECT doc_id, array_to_string(x, '') AS symbols, len(x)::BIGINT AS n
    FROM (SELECT doc_id, regexp_extract_all(text, '{CLS}') AS x FROM documents)"""
)
def p2_extract_symbols(spark, sf):
    found = b.documents(spark, sf, "doc_id", "text").select("doc_id", extract_symbols("text", b.VOCAB).alias("x"))
    return found.select("doc_id", F.array_join("x", "").alias("symbols"), F.size("x").cast("bigint").alias("n"))


@query(f"SELECT doc_id, array_to_string(regexp_extract_all(text, '{CLS}'), ' ') AS symbols FROM documents")
def p3_symbols_string(spark, sf):
    return b.documents(spark, sf, "doc_id", "text").select(
        "doc_id", symbols_string(extract_symbols("text", b.VOCAB)).alias("symbols")
    )


@query(f"WITH {S} SELECT doc_id, len(syms)::BIGINT AS n FROM s")
def p4_with_symbols(spark, sf):
    return b.symbol_rows(spark, sf, "doc_id").select("doc_id", F.size("symbols").cast("bigint").alias("n"))


@query(
    f"""SELECT conv_id, turn FROM conversations
    WHERE coalesce(regexp_matches(text, '{SEQ}'), false) OR coalesce(regexp_matches(role, '{SEQ}'), false)"""
)
def p5_has_symbol_seq(spark, sf):
    rows = b.conversations(spark, sf)
    return rows.filter(has_symbol_seq(sequence_regex(SEQUENCES), "text", "role")).select("conv_id", "turn")


@query(
    f"""SELECT doc_id, len(regexp_extract_all(source || ' ' || text, '{SEQ}'))::BIGINT AS n FROM documents"""
)
def p6_symbol_seq_count(spark, sf):
    docs = b.documents(spark, sf, "doc_id", "source", "text")
    count = symbol_seq_count(combined_text("source", "text"), sequence_regex(SEQUENCES))
    return docs.select("doc_id", count.cast("bigint").alias("n"))


LETTERS = "[A-Za-zéèêçäöüßñíó]"
#: Beginnings of the words of one table, longest first: some thousand sequences, many the beginning of others.
BEGINNINGS = f"""q AS (SELECT DISTINCT left(w, k) AS s FROM (SELECT unnest(regexp_extract_all(text, '{LETTERS}+')) AS w FROM benchmark),
    (SELECT unnest(range(3, 9)) AS k) WHERE length(w) >= k),
  p AS (SELECT string_agg(s, '|' ORDER BY length(s) DESC, s) AS p FROM q)"""


def _beginnings(spark, sf):
    words = b.table(spark, sf, "benchmark").select(F.explode(F.regexp_extract_all("text", F.lit(f"{LETTERS}+"), F.lit(0))).alias("w"))
    cut = words.select("w", F.explode(F.sequence(F.lit(3), F.lit(8))).alias("k")).filter(F.length("w") >= F.col("k"))
    return cut.select(F.substring("w", F.lit(1), F.col("k")).alias("sequence")).distinct()


@query(f"WITH {BEGINNINGS} SELECT conv_id, turn FROM conversations WHERE regexp_matches(text, (SELECT p FROM p))")
def p5_sequences_by_table(spark, sf):
    pattern = trie_from_table(_beginnings(spark, sf))
    return b.conversations(spark, sf).filter(has_symbol_seq(pattern, "text")).select("conv_id", "turn")


@query(
    f"""WITH {BEGINNINGS}, f AS (SELECT doc_id, regexp_extract_all(text, (SELECT p FROM p)) AS x FROM documents)
    SELECT doc_id, len(x)::BIGINT AS n, md5(array_to_string(x, ' ')) AS found FROM f"""
)
def p6_sequences_by_table(spark, sf):
    pattern = trie_from_table(_beginnings(spark, sf))
    docs = b.documents(spark, sf, "doc_id", "text")
    found = docs.select(
        "doc_id", symbol_seq_count("text", pattern).cast("bigint").alias("n"), extract_symbols("text", pattern).alias("x")
    )
    return found.select("doc_id", "n", F.md5(F.array_join("x", " ")).alias("found"))


@query(
    """WITH v AS (SELECT DISTINCT c FROM (SELECT unnest(string_split(text, '')) AS c FROM benchmark) WHERE c > 'z'),
      x AS (SELECT doc_id, unnest(string_split(text, '')) AS c, unnest(range(length(text))) AS i FROM documents),
      f AS (SELECT doc_id, string_agg(c, '' ORDER BY i) AS symbols, count(*)::BIGINT AS n FROM x JOIN v USING (c) GROUP BY doc_id)
    SELECT doc_id, coalesce(symbols, '') AS symbols, coalesce(n, 0)::BIGINT AS n FROM documents LEFT JOIN f USING (doc_id)"""
)
def p2_symbols_by_table(spark, sf):
    """The vocabulary is a table: the characters beyond z of another corpus."""
    points = F.regexp_extract_all("text", F.lit("(?s)."), F.lit(0))
    vocab = b.table(spark, sf, "benchmark").select(F.explode(points).alias("symbol")).filter("symbol > 'z'").distinct()
    found = fq.symbols_by_table(b.documents(spark, sf, "doc_id", "text"), vocab, "text", keep=["doc_id"])
    return found.select("doc_id", F.array_join("symbols", "").alias("symbols"), F.size("symbols").cast("bigint").alias("n"))


@query(f"SELECT doc_id, regexp_matches(text, '{CLS}') AS found FROM documents")
def p7_any_symbol(spark, sf):
    return b.documents(spark, sf, "doc_id", "text").select("doc_id", has_symbol("text", b.VOCAB).alias("found"))


@query(
    r"""SELECT doc_id, len(regexp_extract_all(text, '[\x{00C0}-\x{00DF}\x{00E8}-\x{00FF}]'))::BIGINT AS n
    FROM documents"""
)
def p8_symbol_blocks(spark, sf):
    blocks = block_class([(0xC0, 0xDF), (0xE8, 0xFF)])
    return b.documents(spark, sf, "doc_id", "text").select(
        "doc_id", F.size(extract_symbols("text", blocks)).cast("bigint").alias("n")
    )


@query(
    """SELECT p_partkey, trim(split_part(coalesce(p_type || ' , ' || p_brand, ''), ',', 1)) AS category FROM part"""
)
def p9_primary_category(spark, sf):
    part = b.table(spark, sf, "part")
    listed = part.withColumn("categories", F.concat("p_type", F.lit(" , "), "p_brand"))
    return listed.select("p_partkey", primary_category("categories").alias("category"))


@query(f"WITH {S} SELECT lang, count(*)::BIGINT AS rows FROM s WHERE lang <> 'en' GROUP BY lang ORDER BY rows DESC, lang LIMIT 2")
def p10_exclude_before_topk(spark, sf):
    return gr.top_groups(b.symbol_rows(spark, sf, "lang"), "lang", 2, exclude=["en"])


@query(
    f"""WITH {S}, g AS (SELECT CASE WHEN lang <> 'en' THEN lang END AS grp FROM s)
    SELECT grp, count(*)::BIGINT AS rows FROM g WHERE grp IS DISTINCT FROM 'fr' GROUP BY grp
    ORDER BY rows DESC, grp NULLS FIRST LIMIT 3"""
)
def p10_null_group(spark, sf):
    """Rows without a group are a group, which an exclusion of others keeps."""
    rows = b.symbol_rows(spark, sf, "lang").withColumn("grp", F.when(F.col("lang") != "en", F.col("lang")))
    return gr.top_groups(rows, "grp", 3, exclude=["fr"])


@query(
    f"WITH {_cells('source', 10)} SELECT * FROM cells WHERE source NOT IN ('src0', 'src17') AND symbol NOT IN ('!', 'ß')"
)
def p11_exclude_after_topk(spark, sf):
    rows = b.symbol_rows(spark, sf, "source")
    cells = gr.association_cells(rows, "source", 10, drop_groups=["src0", "src17"], drop_symbols=["!", "ß"])
    return cells.select("source", "symbol", "n")


@query(
    f"""WITH {S} SELECT doc_id AS review_id, quality::DOUBLE AS rating
    FROM s JOIN labels USING (doc_id) WHERE quality IS NOT NULL"""
)
def p12_labelled_rows(spark, sf):
    rows = b.rated_symbol_rows(spark, sf)
    return rows.filter(F.col("rating").isNotNull()).select("review_id", "rating")


@query(f"WITH {S} SELECT doc_id, len(syms)::BIGINT AS n FROM s WHERE list_contains(syms, 'é')")
def p13_containing(spark, sf):
    return fq.containing(b.symbol_rows(spark, sf, "doc_id"), "é").select(
        "doc_id", F.size("symbols").cast("bigint").alias("n")
    )


@query(
    f"""WITH {O} SELECT DISTINCT doc_id, symbol FROM o
    WHERE symbol IN (SELECT symbol FROM o GROUP BY symbol ORDER BY count(*) DESC, symbol LIMIT 5)"""
)
def p13_containing_any(spark, sf):
    rows = b.symbol_rows(spark, sf, "doc_id")
    return fq.containing_any(rows, F.broadcast(fq.top_symbols(rows, 5)), "doc_id")


@query(
    f"""WITH {D} SELECT lang AS emotion, symbol, count(*)::BIGINT AS n,
      row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, symbol)::BIGINT AS rnk
    FROM d WHERE symbol NOT IN ('!', '%') GROUP BY lang, symbol"""
)
def p14_exclude_symbols(spark, sf):
    model = fq.symbol_counts_by(b.symbol_rows(spark, sf, "lang").withColumnRenamed("lang", "emotion"), "emotion")
    return ranked_model(model, exclude=["!", "%"])


@query(
    f"""WITH {D}, v AS (
      SELECT doc_id, sum(coalesce(valence, 0)) AS t
      FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-zA-Z'']+')) AS word FROM s)
      LEFT JOIN {b.VALENCE_SQL} USING (word) GROUP BY doc_id)
    SELECT symbol, count(*)::BIGINT AS n FROM d LEFT JOIN v USING (doc_id) GROUP BY symbol HAVING count(*) >= 40"""
)
def p15_min_support(spark, sf):
    rows = b.symbol_rows(spark, sf, "doc_id", "text")
    return symbol_sentiment(rows, b.valence(spark), "text", "doc_id", min_support=40).select("symbol", "n")


@query("SELECT p_partkey, p_name AS item FROM part")
def p16_first_present(spark, sf):
    part = b.table(spark, sf, "part")
    return part.select("p_partkey", first_present(part, ["item_name", "p_name", "p_type"]).alias("item"))


# ---------------------------------------------------------------- joins


@query(f"SELECT doc_id AS post_id, source AS label FROM documents WHERE source IN (SELECT label FROM {b.LABELS_SQL})")
def j2_restrict_labels(spark, sf):
    docs = b.table(spark, sf, "documents").select(F.col("doc_id").alias("post_id"), F.col("source").alias("label"))
    return restrict_labels(docs, b.label_dimension(spark))


@query(
    """SELECT doc_id, source FROM documents
    WHERE source IN (SELECT source FROM documents GROUP BY source ORDER BY count(*) DESC, source LIMIT 5)"""
)
def j3_in_top_groups(spark, sf):
    docs = b.table(spark, sf, "documents").select("doc_id", "source")
    return gr.in_top_groups(docs, "source", 5).select("doc_id", "source")


@query(
    f"""WITH {_cells('lang', 4)} SELECT lang, symbol, n, spread FROM (
      SELECT *, count(*) OVER (PARTITION BY symbol)::BIGINT AS spread FROM cells) WHERE spread <= 2"""
)
def j4_bounded_spread(spark, sf):
    rows = b.symbol_rows(spark, sf, "lang")
    return gr.keep_spread(gr.group_profile(rows, "lang", 4), 2).select("lang", "symbol", "n", "spread")


@query(f"WITH {PAIRS} SELECT doc_id, s1, s2 FROM p")
def j7_symbol_pairs(spark, sf):
    return pr.symbol_pairs(b.symbol_rows(spark, sf, "doc_id"), "doc_id")


# ---------------------------------------------------------------- aggregates


@query(f"WITH {O} SELECT symbol, count(*)::BIGINT AS n FROM o GROUP BY symbol")
def a1_symbol_counts(spark, sf):
    return fq.symbol_counts(b.symbol_rows(spark, sf))


@query(f"WITH {D} SELECT lang, symbol, count(*)::BIGINT AS n FROM d GROUP BY lang, symbol")
def a2_symbol_counts_by(spark, sf):
    return fq.symbol_counts_by(b.symbol_rows(spark, sf, "lang"), "lang")


RATED = f"{O}, r AS (SELECT o.*, quality::DOUBLE AS rating FROM o LEFT JOIN labels USING (doc_id))"


@query(
    f"""WITH {RATED} SELECT symbol, count(*)::BIGINT AS n, round(avg(rating), 6) AS avg_rating,
      round(stddev_pop(rating), 6) AS std_rating FROM r GROUP BY symbol"""
)
def a3_symbol_rating_stats(spark, sf):
    return _rounded(pf.symbol_rating_stats(b.rated_symbol_rows(spark, sf)), "avg_rating", "std_rating")


@query(f"WITH {D} SELECT symbol, count(DISTINCT doc_id)::BIGINT AS reviews FROM d GROUP BY symbol")
def a4_reviews_per_symbol(spark, sf):
    rows = b.symbol_rows(spark, sf, "source").withColumnRenamed("source", "item_id")
    return pf.symbol_reach(rows).select("symbol", "reviews")


@query(f"WITH {D} SELECT symbol, count(DISTINCT source)::BIGINT AS items FROM d GROUP BY symbol")
def a5_items_per_symbol(spark, sf):
    rows = b.symbol_rows(spark, sf, "source").withColumnRenamed("source", "item_id")
    return pf.symbol_reach(rows).select("symbol", "items")


@query(f"WITH {D} SELECT symbol, count(*)::BIGINT AS reviews, count(DISTINCT source)::BIGINT AS items FROM d GROUP BY symbol")
def a5_items_by_sketch(spark, sf):
    rows = b.symbol_rows(spark, sf, "source").withColumnRenamed("source", "item_id")
    return rc.reach(rc.reach_sketches(rows))


@query(f"WITH {D} SELECT symbol, count(*)::BIGINT AS reviews, true AS within FROM d GROUP BY symbol")
def a5_sketches_of_batches(spark, sf):
    """Documents per symbol from the sketches of three batches, one of which comes twice, against the exact number."""
    rows = b.symbol_rows(spark, sf, "doc_id")
    path = scratch_path(spark, "reach")
    for batch in (0, 1, 2, 1):
        rc.update_reach(rows.filter(F.col("doc_id") % 3 == batch), path, batch, "doc_id")
    found = rc.reach(rc.read_reach(spark, path))
    exact = fq.exploded(rows, "doc_id", once_per_row=True).groupBy("symbol").agg(F.count_distinct("doc_id").alias("n"))
    within = F.abs(F.col("items") - F.col("n")) <= F.greatest(F.lit(1.0), rc.error_bound() * F.col("n"))
    return found.join(exact, "symbol").select("symbol", "reviews", within.alias("within"))


COMPANY = """x AS (SELECT doc_id, count(*) - 1 AS others FROM d GROUP BY doc_id),
  y AS (SELECT a.symbol, count(DISTINCT z.symbol) AS partners FROM d a JOIN d z ON a.doc_id = z.doc_id AND a.symbol <> z.symbol GROUP BY a.symbol)"""


@query(
    f"""WITH {D}, {COMPANY} SELECT symbol, round(avg(others), 6) AS avg_cooccurring,
      coalesce(max(partners), 0)::BIGINT AS partners
    FROM d JOIN x USING (doc_id) LEFT JOIN y USING (symbol) GROUP BY symbol"""
)
def a6_symbol_company(spark, sf):
    return _rounded(pf.symbol_company(b.symbol_rows(spark, sf)), "avg_cooccurring")


PROFILE_SQL = f"""WITH {D}, {COMPANY},
  o AS (SELECT doc_id, unnest(syms) AS symbol FROM s),
  r AS (SELECT symbol, count(*) AS n, avg(quality) AS avg_rating, stddev_pop(quality) AS std_rating
        FROM o LEFT JOIN labels USING (doc_id) GROUP BY symbol),
  e AS (SELECT symbol, count(DISTINCT doc_id) AS reviews, count(DISTINCT source) AS items, avg(others) AS avg_cooccurring
        FROM d JOIN x USING (doc_id) GROUP BY symbol),
  profile AS (SELECT symbol, n::BIGINT AS n, avg_rating, std_rating, reviews::BIGINT AS reviews, items::BIGINT AS items,
        avg_cooccurring, coalesce(partners, 0)::BIGINT AS partners
        FROM r JOIN e USING (symbol) LEFT JOIN y USING (symbol))"""


@query(
    PROFILE_SQL
    + """ SELECT symbol, n, round(avg_rating, 6) AS avg_rating, round(std_rating, 6) AS std_rating, reviews, items,
      round(avg_cooccurring, 6) AS avg_cooccurring, partners FROM profile"""
)
def a7_symbol_profile(spark, sf):
    return _rounded(pf.symbol_profile(b.rated_symbol_rows(spark, sf)), "avg_rating", "std_rating", "avg_cooccurring")


@query(
    PROFILE_SQL
    + """ SELECT symbol, round(avg_rating, 6) AS avg_rating, reviews, items, partners FROM profile WHERE n > 10"""
)
def j5_aligned_metrics(spark, sf):
    profile = pf.symbol_profile(b.rated_symbol_rows(spark, sf)).filter(F.col("n") > 10)
    return _rounded(profile.select("symbol", "avg_rating", "reviews", "items", "partners"), "avg_rating")


@query(f"WITH {PAIR_COUNTS} SELECT * FROM c")
def a8_cooccurrence_counts(spark, sf):
    return pr.cooccurrence_counts(b.symbol_rows(spark, sf))


def _chi2_sql(group: str, top: int, where: str = "true") -> str:
    return f"""WITH {_cells(group, top)}, k AS (SELECT * FROM cells WHERE {where}),
      rt AS (SELECT symbol, sum(n) AS r FROM k GROUP BY symbol),
      ct AS (SELECT {group}, sum(n) AS c FROM k GROUP BY {group}),
      e AS (SELECT symbol, {group}, r, r * c / (SELECT sum(n) FROM k)::DOUBLE AS expected FROM rt, ct WHERE r >= 10)
    SELECT symbol, total, round(x, 6) AS chi2 FROM (
      SELECT symbol, max(r)::BIGINT AS total, sum((coalesce(n, 0) - expected) ** 2 / expected) AS x
      FROM e LEFT JOIN k USING (symbol, {group}) GROUP BY symbol)
    ORDER BY round(x, 9) DESC, symbol LIMIT 10"""


@query(_chi2_sql("source", 10, "source <> 'src0' AND symbol NOT IN ('!', '%')"))
def a12_chi2_association(spark, sf):
    rows = b.symbol_rows(spark, sf, "source")
    top = gr.chi2_association(rows, "source", 10, 10, 10, drop_groups=["src0"], drop_symbols=["!", "%"])
    return _rounded(top, "chi2")


@query(_chi2_sql("lang", 10))
def a12_chi2_by_language(spark, sf):
    return _rounded(gr.chi2_association(b.symbol_rows(spark, sf, "lang"), "lang"), "chi2")


@query(
    f"""WITH {_cells('source', 8)} SELECT symbol, count(DISTINCT source)::BIGINT AS spread
    FROM cells GROUP BY symbol HAVING count(DISTINCT source) <= 5"""
)
def a13_group_spread(spark, sf):
    cells = gr.group_profile(b.symbol_rows(spark, sf, "source"), "source", 8)
    return gr.keep_spread(cells, 5).groupBy("symbol").agg(F.max("spread").alias("spread"))


@query(
    f"""WITH {_cells('lang', 4)} SELECT symbol, {', '.join(
      f"coalesce(sum(n) FILTER (lang = '{g}'), 0)::BIGINT AS {g}" for g in ('de', 'en', 'es', 'fr'))}
    FROM cells GROUP BY symbol"""
)
def a21_group_matrix(spark, sf):
    cells = gr.group_profile(b.symbol_rows(spark, sf, "lang"), "lang", 4)
    return pr.to_matrix(cells, "symbol", "lang", "n")


@query(
    f"""WITH {PAIR_COUNTS}, sym AS (SELECT s1 AS r, s2 AS c2, n FROM c UNION ALL SELECT s2, s1, n FROM c)
    SELECT r AS "row", {', '.join(f"coalesce(sum(n) FILTER (c2 = '{x}'), 0)::BIGINT AS u{ord(x):04x}"
      for x in sorted(b.SYMBOLS))} FROM sym GROUP BY r"""
)
def a21_cooccurrence_matrix(spark, sf):
    """The whole matrix: a column for every symbol of the vocabulary, named by its code point."""
    long = pr.pair_matrix(pr.cooccurrence_counts(b.symbol_rows(spark, sf)))
    # column names do not tell É from é, code points do
    named = long.withColumn("col", F.concat(F.lit("u"), F.lower(F.lpad(F.hex(F.ascii("col")), 4, "0"))))
    return pr.to_matrix(named, "row", "col", "n", [f"u{ord(x):04x}" for x in sorted(b.SYMBOLS)])


@query(f"WITH {S} SELECT lang, count(*)::BIGINT AS rows FROM s GROUP BY lang")
def a22_group_sizes(spark, sf):
    return gr.group_sizes(b.symbol_rows(spark, sf, "lang"), "lang")


# ---------------------------------------------------------------- windows, top-k


def _top_symbols_sql(group: str, k: int, n: int, spread: int, where: str = "true") -> str:
    return f"""WITH {_cells(group, k, where)}, w AS (
        SELECT *, count(*) OVER (PARTITION BY symbol)::BIGINT AS spread FROM cells)
    SELECT * FROM (SELECT {group}, symbol, n, spread,
        row_number() OVER (PARTITION BY {group} ORDER BY n DESC, symbol)::BIGINT AS rnk FROM w WHERE spread <= {spread})
    WHERE rnk <= {n}"""


@query(_top_symbols_sql("lang", 5, 5, 5, "lang <> 'en'"))
def t5_top_symbols_per_group(spark, sf):
    rows = b.symbol_rows(spark, sf, "lang")
    return gr.top_symbols_per_group(rows, "lang", exclude_groups=["en"])


@query(_top_symbols_sql("source", 20, 3, 20))
def w2_top_n_per_group(spark, sf):
    return gr.top_symbols_per_group(b.symbol_rows(spark, sf, "source"), "source", top=20, n=3, max_spread=20)


@query(
    f"""WITH {_cells('source', 10)} SELECT source, symbol, n,
      round(n / sum(n) OVER (PARTITION BY symbol), 6) AS share FROM cells"""
)
def w3_row_share(spark, sf):
    cells = gr.association_cells(b.symbol_rows(spark, sf, "source"), "source", 10)
    return _rounded(gr.row_share(cells).select("source", "symbol", "n", "share"), "share")


TOP_MATRIX = f"""{PAIR_COUNTS}, tp AS (SELECT * FROM c ORDER BY n DESC, s1, s2 LIMIT 20),
  ts AS (SELECT s1 AS symbol FROM tp UNION SELECT s2 FROM tp),
  m AS (SELECT a.symbol AS "row", z.symbol AS "col", coalesce(c.n, 0)::BIGINT AS n FROM ts a CROSS JOIN ts z
    LEFT JOIN c ON c.s1 = least(a.symbol, z.symbol) AND c.s2 = greatest(a.symbol, z.symbol))"""


@query(f"WITH {TOP_MATRIX} SELECT * FROM m")
def t6_top_pair_matrix(spark, sf):
    return pr.top_pair_matrix(pr.cooccurrence_counts(b.symbol_rows(spark, sf)))


@query(
    f"""WITH {TOP_MATRIX} SELECT "row", "col", n, round(ln(1 + n), 6) AS logged, round((ln(1 + n) - min(ln(1 + n)) OVER ())
      / nullif(max(ln(1 + n)) OVER () - min(ln(1 + n)) OVER (), 0), 6) AS scaled FROM m"""
)
def w4_log_minmax(spark, sf):
    matrix = pr.top_pair_matrix(pr.cooccurrence_counts(b.symbol_rows(spark, sf)))
    return _rounded(pr.log_minmax(matrix), "logged", "scaled")


@query(f"WITH {O} SELECT symbol, count(*)::BIGINT AS n FROM o GROUP BY symbol ORDER BY n DESC, symbol LIMIT 5")
def t1_top_symbols(spark, sf):
    return fq.top_symbols(b.symbol_rows(spark, sf), 5)


@query(f"WITH {PAIR_COUNTS} SELECT * FROM c ORDER BY n DESC, s1, s2 LIMIT 20")
def t1_top_pairs(spark, sf):
    return pr.top_pairs(pr.cooccurrence_counts(b.symbol_rows(spark, sf)), 20)


@query(f"WITH {S} SELECT source, count(*)::BIGINT AS rows FROM s GROUP BY source ORDER BY rows DESC, source LIMIT 5")
def t4_top_groups(spark, sf):
    return gr.top_groups(b.symbol_rows(spark, sf, "source"), "source", 5)


@query("SELECT DISTINCT source AS label FROM documents ORDER BY label")
def t7_label_listing(spark, sf):
    return b.table(spark, sf, "documents").select(F.col("source").alias("label")).distinct().orderBy("label")


# ---------------------------------------------------------------- sets and lists


@query(
    f"""SELECT DISTINCT symbol FROM (SELECT unnest(regexp_extract_all(text, '{CLS}')) AS symbol FROM documents
    UNION ALL SELECT unnest(regexp_extract_all(text, '{CLS}')) FROM conversations)"""
)
def d3_symbol_union(spark, sf):
    talks = fq.with_symbols(b.conversations(spark, sf), b.VOCAB, "text", keep=())
    return fq.symbol_counts(b.symbol_rows(spark, sf)).select("symbol").union(
        fq.symbol_counts(talks).select("symbol")
    ).distinct()


@query(
    f"""WITH {D} SELECT doc_id, symbol, coalesce((SELECT string_agg(z.symbol, '' ORDER BY z.symbol) FROM d z
      WHERE z.doc_id = d.doc_id AND z.symbol <> d.symbol), '') AS others FROM d"""
)
def d4_other_symbols(spark, sf):
    rows = b.symbol_rows(spark, sf, "doc_id").withColumn("_set", F.array_distinct("symbols"))
    each = fq.exploded(rows, "doc_id", "_set", once_per_row=True)
    others = F.array_sort(F.array_except("_set", F.array("symbol")))
    return each.select("doc_id", "symbol", F.array_join(others, "").alias("others"))


@query(f"WITH {D} SELECT doc_id, string_agg(symbol, '' ORDER BY symbol) AS symbols FROM d GROUP BY doc_id")
def d5_distinct_per_row(spark, sf):
    rows = b.symbol_rows(spark, sf, "doc_id")
    return rows.select("doc_id", F.array_join(F.array_sort(fq.distinct_symbols()), "").alias("symbols"))


@query(
    f"""WITH {S} SELECT doc_id, len(syms)::BIGINT AS n, list_contains(syms, 'ü') AS has_u,
      array_to_string(list_sort(syms), '') AS sorted FROM s"""
)
def f8_list_functions(spark, sf):
    return b.symbol_rows(spark, sf, "doc_id").select(
        "doc_id",
        F.size("symbols").cast("bigint").alias("n"),
        F.array_contains("symbols", "ü").alias("has_u"),
        F.array_join(F.sort_array("symbols"), "").alias("sorted"),
    )


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})
