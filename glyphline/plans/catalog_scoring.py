"""Queries on scores: sentiment, emotion, suggestion, de-duplication, models, streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from glyphline.functions.text import argmax_label, max_pair
from glyphline.operators import dedup as dd
from glyphline.operators import emotion as em
from glyphline.operators import models as ml
from glyphline.operators import profile as pf
from glyphline.operators import scorer as sc
from glyphline.operators import sentiment as st
from glyphline.operators import suggest as sg
from glyphline.operators.frequency import symbol_counts_by
from glyphline.plans import bindings as b
from glyphline.plans.catalog_symbols import CLS, D, PROFILE_SQL, S, _rounded
from glyphline.plans.catalog_text import TOKENS
from glyphline.plans.flows import land_reviews
from glyphline.plans.registry import query
from glyphline.session import checkpointed, part_count, scratch_path
from glyphline.streaming.score import append_to, emotion_in_row, lookup_literal, score_batches, score_stream, valence_in_row

# ---------------------------------------------------------------- valence


def _totals(source: str) -> str:
    return f"""v AS (SELECT doc_id, sum(coalesce(valence, 0)) AS total,
      coalesce(sum(valence) FILTER (valence > 0), 0) AS p, coalesce(-sum(valence) FILTER (valence < 0), 0) AS g,
      count(*) FILTER (word IS NOT NULL AND coalesce(valence, 0) = 0) AS u
    FROM {source} LEFT JOIN (SELECT doc_id, {TOKENS} AS word FROM {source}) USING (doc_id)
    LEFT JOIN {b.VALENCE_SQL} USING (word) GROUP BY doc_id)"""


COMPOUND = "total / sqrt(total * total + 15)"


@query(f"WITH {_totals('documents')} SELECT doc_id, total, round({COMPOUND}, 6) AS compound FROM v")
def e1_valence_score(spark, sf):
    docs = b.documents(spark, sf, "doc_id", "text")
    return _rounded(st.valence_score(docs, b.valence(spark), "text", "doc_id"), "compound")


@query(
    f"""WITH {_totals('documents')} SELECT doc_id, round(p / nullif(p + g + u, 0), 6) AS pos,
      round(g / nullif(p + g + u, 0), 6) AS neg, round(u / nullif(p + g + u, 0), 6) AS neu FROM v"""
)
def e2_valence_shares(spark, sf):
    docs = b.documents(spark, sf, "doc_id", "text")
    return _rounded(st.valence_shares(docs, b.valence(spark), "text", "doc_id"), "pos", "neg", "neu")


@query(
    f"""WITH {_totals('documents')}, c AS (SELECT doc_id, {COMPOUND} AS c FROM v)
    SELECT doc_id, CASE WHEN c >= 0.05 THEN 'positive' WHEN c <= -0.05 THEN 'negative' ELSE 'neutral' END AS bucket FROM c"""
)
def e3_sentiment_bucket(spark, sf):
    docs = b.documents(spark, sf, "doc_id", "text")
    return st.bucketed(st.valence_score(docs, b.valence(spark), "text", "doc_id")).select("doc_id", "bucket")


MEANS = f"""{D}, {_totals('s')}, m AS (SELECT symbol, avg({COMPOUND}) AS avg_sentiment, count(*)::BIGINT AS n
  FROM d JOIN v USING (doc_id) GROUP BY symbol)"""


def _means(spark, sf):
    return st.symbol_sentiment(b.symbol_rows(spark, sf, "doc_id", "text"), b.valence(spark), "text", "doc_id")


@query(f"WITH {MEANS} SELECT symbol, round(avg_sentiment, 6) AS avg_sentiment, n FROM m")
def a14_symbol_sentiment(spark, sf):
    return _rounded(_means(spark, sf), "avg_sentiment")


POLARITY = f"""{D}, {_totals('s')}, q AS (SELECT symbol, avg(p / nullif(p + g + u, 0)) AS avg_pos,
    avg(g / nullif(p + g + u, 0)) AS avg_neg, count(*)::BIGINT AS n FROM d JOIN v USING (doc_id)
    GROUP BY symbol HAVING count(*) >= 50),
  m AS (SELECT *, avg_pos / nullif(avg_pos + avg_neg, 0) AS pos_share FROM q)"""


@query(
    f"""WITH {POLARITY} SELECT symbol, round(avg_pos, 6) AS avg_pos, round(avg_neg, 6) AS avg_neg, n,
      round(pos_share, 6) AS pos_share, round(1 - pos_share, 6) AS neg_share,
      round(abs(pos_share - 0.5), 6) AS polarity_gap FROM m"""
)
def a15_symbol_polarity(spark, sf):
    rows = b.symbol_rows(spark, sf, "doc_id", "text")
    found = st.symbol_polarity(rows, b.valence(spark), "text", "doc_id")
    return _rounded(found, "avg_pos", "avg_neg", "pos_share", "neg_share", "polarity_gap")


@query(
    f"""WITH {MEANS} SELECT symbol, round(avg_sentiment, 6) AS avg_sentiment, n, side FROM (
      (SELECT *, 'top' AS side FROM m ORDER BY round(avg_sentiment, 9) DESC, symbol LIMIT 10) UNION ALL
      (SELECT *, 'bottom' FROM m ORDER BY round(avg_sentiment, 9), symbol LIMIT 10))"""
)
def t2_sentiment_extremes(spark, sf):
    return _rounded(st.sentiment_extremes(_means(spark, sf)), "avg_sentiment")


@query(
    f"""WITH {POLARITY}, r AS (SELECT *, abs(pos_share - 0.5) AS gap FROM m WHERE pos_share IS NOT NULL)
    SELECT symbol, round(pos_share, 6) AS pos_share, n, side FROM (
      (SELECT *, 'head' AS side FROM r ORDER BY round(gap, 9) DESC, symbol LIMIT 6) UNION ALL
      (SELECT *, 'tail' FROM r ORDER BY round(gap, 9), symbol DESC LIMIT 6))"""
)
def t3_polarity_extremes(spark, sf):
    rows = b.symbol_rows(spark, sf, "doc_id", "text")
    found = st.polarity_extremes(st.symbol_polarity(rows, b.valence(spark), "text", "doc_id"))
    return _rounded(found.select("symbol", "pos_share", "n", "side"), "pos_share")


# ---------------------------------------------------------------- emotion


def _emotion(source: str) -> str:
    return f"""ec AS (SELECT doc_id, emotion, count(*)::BIGINT AS n FROM (SELECT doc_id, {TOKENS} AS word FROM {source})
      JOIN {b.EMOTIONS_SQL} USING (word) GROUP BY doc_id, emotion),
    dom AS (SELECT doc_id, emotion, n FROM ec QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, emotion) = 1)"""


@query(f"WITH {_emotion('documents')} SELECT * FROM ec")
def e4_emotion_counts(spark, sf):
    return em.emotion_counts(b.documents(spark, sf, "doc_id", "text"), b.emotions(spark), "text", "doc_id")


@query(f"WITH {_emotion('documents')} SELECT * FROM dom")
def e4_dominant_emotion(spark, sf):
    docs = b.documents(spark, sf, "doc_id", "text")
    counts = em.emotion_counts(docs, b.emotions(spark), "text", "doc_id")
    return em.dominant_emotion(counts, b.emotions(spark), "doc_id")


TOP_EMOTION = """SELECT doc_id, emotion, round(n / total, 6) AS score FROM (
  SELECT *, sum(n) OVER (PARTITION BY doc_id)::DOUBLE AS total, max(n) OVER (PARTITION BY doc_id) AS most FROM ec)
  WHERE n = most QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY emotion DESC) = 1"""


@query(f"WITH {_emotion('documents')}, x AS ({TOP_EMOTION}) SELECT doc_id, emotion FROM x")
def e5_top_emotions(spark, sf):
    docs = b.documents(spark, sf, "doc_id", "text")
    return em.top_emotions(docs, b.emotions(spark), "text", "doc_id")


@query(f"WITH {_emotion('documents')} {TOP_EMOTION}")
def e5_top_emotions_with_score(spark, sf):
    docs = b.documents(spark, sf, "doc_id", "text")
    return _rounded(em.top_emotions(docs, b.emotions(spark), "text", "doc_id", key="label_score"), "score")


@query(
    """SELECT doc_id, CASE WHEN n < 5 THEN NULL WHEN n > 300 THEN 'long' WHEN n > 60 THEN 'middle' ELSE 'brief' END AS emotion
    FROM (SELECT doc_id, length(text) - length(replace(text, ' ', '')) + 1 AS n FROM documents)"""
)
def e6_label_with(spark, sf):
    # defined here, so that it travels with the plan and workers need not import this module
    def length_scorer():
        def score(text: str) -> str:
            n = text.count(" ") + 1
            if n < 5:
                raise ValueError("too short")
            return "long" if n > 300 else "middle" if n > 60 else "brief"

        return score

    docs = b.documents(spark, sf, "doc_id", "text")
    return em.label_with(docs, length_scorer, "text").select("doc_id", "emotion")


@query(
    r"""SELECT doc_id, n > 200 AS truncated, CASE WHEN n < 5 THEN 'ValueError: too short' WHEN n = 60 THEN 'no label' END AS reason,
      CASE WHEN n < 5 OR n = 60 THEN NULL WHEN n >= 200 THEN 'long' WHEN n > 60 THEN 'middle' ELSE 'brief' END AS emotion
    FROM (SELECT doc_id, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS n FROM documents)"""
)
def e6_label_batches(spark, sf):
    # defined here, so that it travels with the plan and workers need not import this module
    def batch_scorer():
        def one(n):
            rest = 0.5 if 60 < n < 200 else 0.0
            return [] if n == 60 else [("brief", 0.4 if n < 60 else 0.1), ("middle", rest), ("long", 0.9 if n >= 200 else 0.2)]

        def score(texts):
            sizes = [len(t.split()) for t in texts]
            if min(sizes) < 5:
                raise ValueError("too short")
            return [one(n) for n in sizes]

        return score

    docs = b.documents(spark, sf, "doc_id", "text")
    return sc.label_batches(docs, batch_scorer, "text", limit=200).select("doc_id", "emotion", "reason", "truncated")


@query(
    f"""WITH {_emotion('documents')} SELECT doc_id, max(n)::BIGINT AS n,
      (list(emotion ORDER BY n DESC, emotion))[1] AS emotion FROM ec GROUP BY doc_id"""
)
def f9_argmax_of_map(spark, sf):
    docs = b.documents(spark, sf, "doc_id", "text")
    counts = em.emotion_counts(docs, b.emotions(spark), "text", "doc_id")
    maps = counts.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("emotion", "n"))).alias("m"))
    return maps.select("doc_id", F.array_max(F.map_values("m")).alias("n"), argmax_label("m").alias("emotion"))


@query(f"WITH {_emotion('documents')} SELECT doc_id, max(emotion) AS emotion, arg_max(n, emotion)::BIGINT AS n FROM ec GROUP BY doc_id")
def f9_max_pair(spark, sf):
    docs = b.documents(spark, sf, "doc_id", "text")
    counts = em.emotion_counts(docs, b.emotions(spark), "text", "doc_id")
    listed = counts.groupBy("doc_id").agg(max_pair(F.collect_list(F.struct("emotion", "n"))).alias("p"))
    return listed.select("doc_id", "p.emotion", "p.n")


# ---------------------------------------------------------------- suggestion

MODEL = f"""{D}, {_emotion('documents')}, mo AS (SELECT emotion, symbol, count(*)::BIGINT AS n
    FROM d JOIN dom USING (doc_id) GROUP BY emotion, symbol),
  te AS (SELECT doc_id, emotion FROM documents LEFT JOIN dom USING (doc_id))"""


def _ranked(where: str = "true") -> str:
    return f"""rk AS (SELECT *, row_number() OVER w AS rnk, sum(n) OVER w AS running, sum(n) OVER (PARTITION BY emotion) AS total,
      count(*) OVER (PARTITION BY emotion) AS size FROM mo WHERE {where} WINDOW w AS (PARTITION BY emotion ORDER BY n DESC, symbol))"""


DRAW = "('0x' || substr(md5('42|' || doc_id), 1, 13))::BIGINT"


def _model(spark, sf):
    """The emotion of every symbol-bearing text, in one pass over the texts."""
    rows = b.symbol_rows(spark, sf, "doc_id", "text").withColumn("symbols", F.array_distinct("symbols"))
    return sg.emotion_model(em.labelled(rows, b.emotions(spark), "text", "doc_id", "symbols"))


def _texts(spark, sf):
    return em.labelled(b.documents(spark, sf, "doc_id", "text"), b.emotions(spark), "text", "doc_id")


@query(f"WITH {MODEL} SELECT * FROM mo")
def g_emotion_model(spark, sf):
    return _model(spark, sf)


@query(
    f"""WITH {MODEL}, {_ranked()}, li AS (SELECT emotion, count(*)::BIGINT AS symbols, sum(n)::BIGINT AS total,
      string_agg(symbol, '' ORDER BY rnk) AS ranking FROM rk GROUP BY emotion)
    SELECT doc_id, emotion, symbols, total, md5(ranking) AS line FROM te LEFT JOIN li USING (emotion)"""
)
def j8_emotion_lookup(spark, sf):
    """The model line that each text meets: its key, size and total, and a digest of its ranking."""
    lines = sg.folded_model(_model(spark, sf)).select(
        "emotion", F.size("_symbols").cast("bigint").alias("symbols"), F.element_at("_running", -1).alias("total"),
        F.md5(F.array_join("_symbols", "")).alias("line"),
    )
    found = _texts(spark, sf).join(lines, "emotion", "left")
    return found.select("doc_id", "emotion", "symbols", "total", "line")


@query(f"WITH {MODEL}, {_ranked()} SELECT doc_id, te.emotion, symbol FROM te LEFT JOIN rk ON rk.emotion = te.emotion AND rnk = 1")
def g1_suggest_top(spark, sf):
    return sg.suggest_top(_texts(spark, sf), _model(spark, sf))


@query(
    f"""WITH {MODEL}, {_ranked("symbol NOT IN ('!', '%')")}
    SELECT doc_id, te.emotion, symbol FROM te LEFT JOIN rk
      ON rk.emotion = te.emotion AND rnk = {DRAW} % least(3, size) + 1"""
)
def g2_suggest_topk(spark, sf):
    return sg.suggest_topk(_texts(spark, sf), _model(spark, sf), "doc_id", k=3, exclude=["!", "%"])


@query(
    f"""WITH {MODEL}, dm AS (SELECT emotion, symbol, row_number() OVER (
      PARTITION BY emotion ORDER BY n / ln(n + 2) DESC, symbol) AS rnk FROM mo)
    SELECT doc_id, te.emotion, symbol FROM te LEFT JOIN dm ON dm.emotion = te.emotion AND rnk = 1"""
)
def g3_suggest_damped(spark, sf):
    return sg.suggest_damped(_texts(spark, sf), _model(spark, sf))


@query(
    f"""WITH {MODEL}, {_ranked()} SELECT doc_id, te.emotion, symbol FROM te LEFT JOIN rk
      ON rk.emotion = te.emotion AND {DRAW} % total < running AND {DRAW} % total >= running - n"""
)
def g4_suggest_weighted(spark, sf):
    return sg.suggest_weighted(_texts(spark, sf), _model(spark, sf), "doc_id")


RACE = f"""{MODEL}, ra AS (SELECT doc_id, te.emotion, symbol, row_number() OVER (PARTITION BY doc_id ORDER BY
      -ln((('0x' || substr(md5('42|' || doc_id || '|' || symbol), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE) / n,
      symbol) AS place FROM te LEFT JOIN mo ON mo.emotion = te.emotion)"""


@query(f"WITH {RACE} SELECT doc_id, emotion, symbol FROM ra WHERE place = 1")
def g4_weighted_race(spark, sf):
    return sg.suggest_race(_texts(spark, sf), _model(spark, sf), "doc_id")


@query(f"WITH {RACE} SELECT doc_id, emotion, symbol FROM ra WHERE place = 1")
def g4_race_by_aggregate(spark, sf):
    return sg.race_by_aggregate(_texts(spark, sf), _model(spark, sf), "doc_id")


@query(
    f"""WITH {RACE} SELECT doc_id, emotion, CASE WHEN emotion IS NOT NULL THEN string_agg(symbol, ' ' ORDER BY place) END AS picks
    FROM ra WHERE place <= 3 GROUP BY doc_id, emotion"""
)
def g4_weighted_picks(spark, sf):
    found = sg.suggest_picks(_texts(spark, sf), _model(spark, sf), "doc_id", k=3)
    return found.select("doc_id", "emotion", F.array_join("symbols", " ").alias("picks"))


@query(
    f"""WITH {MODEL}, {_ranked("emotion <> 'joy'")} SELECT doc_id, te.emotion, symbol
    FROM te LEFT JOIN rk ON rk.emotion = te.emotion AND rnk = 1"""
)
def g5_unknown_emotion(spark, sf):
    model = _model(spark, sf).filter(F.col("emotion") != "joy")
    return sg.suggest_top(_texts(spark, sf), model)


@query(
    f"""WITH {MODEL}, {_ranked()} SELECT doc_id, emotion, symbol FROM (
      SELECT doc_id, te.emotion, symbol FROM te LEFT JOIN rk ON rk.emotion = te.emotion AND rnk = {DRAW} % least(3, size) + 1)"""
)
def g6_score_stream(spark, sf):
    """The documents, landed as a folder of files, scored as a stream in micro-batches."""
    landed = scratch_path(spark, "landed")
    docs = b.documents(spark, sf, "doc_id", "text")
    docs.write.parquet(landed)
    stream = spark.readStream.schema(docs.schema).parquet(landed)
    model_path = scratch_path(spark, "model")
    _model(spark, sf).write.parquet(model_path)
    model = spark.read.parquet(model_path)
    out = scratch_path(spark, "scored")
    run = (
        score_batches(stream, b.emotions(spark), model, out, "text", "doc_id", k=3)
        .option("checkpointLocation", scratch_path(spark, "stream-state"))
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    return spark.read.parquet(out).select("doc_id", "emotion", "symbol")


@query(
    f"""WITH {MODEL}, {_ranked()} SELECT doc_id, te.emotion, symbol FROM te LEFT JOIN rk
      ON rk.emotion = te.emotion AND rnk = {DRAW} % least(3, size) + 1"""
)
def g6_append_stream(spark, sf):
    """The documents as a stream of several micro-batches, scored in the row and appended to a folder."""
    docs = b.documents(spark, sf, "doc_id", "text")
    landed, lines, out = (scratch_path(spark, name) for name in ("landed", "lines", "appended"))
    files = part_count(docs, 4)
    docs.repartition(files).write.parquet(landed)
    sg.folded_model(_model(spark, sf)).write.parquet(lines)
    stream = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", files // 2).parquet(landed)
    scored = score_stream(stream, b.EMOTIONS, spark.read.parquet(lines), "text", "doc_id", k=3)
    run = append_to(scored.drop("text"), out, scratch_path(spark, "append-state")).trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.parquet(out)


@query(f"WITH {_emotion('documents')} SELECT doc_id, emotion FROM documents LEFT JOIN dom USING (doc_id)")
def g6_emotion_in_row(spark, sf):
    look_up = lookup_literal(b.EMOTIONS, "string")
    docs = b.documents(spark, sf, "doc_id", "text")
    return emotion_in_row(docs, look_up, "text").select("doc_id", "emotion")


@query(f"WITH {_totals('documents')} SELECT doc_id, total FROM v")
def g6_valence_in_row(spark, sf):
    look_up = lookup_literal(b.VALENCE)
    docs = b.documents(spark, sf, "doc_id", "text")
    return docs.select("doc_id", valence_in_row(F.col("text"), look_up).alias("total"))


# ---------------------------------------------------------------- de-duplication


@query(
    """SELECT event_id, event_type, value FROM (SELECT *, lag(event_type) OVER (ORDER BY event_id) AS before,
      row_number() OVER (ORDER BY event_id) AS i FROM events) WHERE value >= 5 AND (i = 1 OR event_type IS DISTINCT FROM before)"""
)
def w1_first_of_run(spark, sf):
    events = b.table(spark, sf, "events").select("event_id", "event_type", "value")
    return dd.first_of_run(events, "event_id", "event_type", F.col("value") >= 5, bucket_rows=50_000)


SPARSE = "('0x' || substr(md5(event_id::VARCHAR), 1, 15))::BIGINT"


@query(
    f"""SELECT event_id, event_type FROM (SELECT *, lag(event_type) OVER (ORDER BY o) AS before,
      row_number() OVER (ORDER BY o) AS i FROM (SELECT *, {SPARSE} AS o FROM events))
    WHERE value >= 5 AND (i = 1 OR event_type IS DISTINCT FROM before)"""
)
def w1_sparse_ids(spark, sf):
    """The same in the order of 60-bit hashes, which leave most of their range empty."""
    hashed = F.conv(F.substring(F.md5(F.col("event_id").cast("string").cast("binary")), 1, 15), 16, 10).cast("bigint")
    events = b.table(spark, sf, "events").select(hashed.alias("o"), "event_id", "event_type", "value")
    kept = dd.first_of_run(events, "o", "event_type", F.col("value") >= 5, bucket_rows=500)
    return kept.select("event_id", "event_type")


@query(
    f"""SELECT doc_id, lang, md5(text) AS digest FROM (SELECT *, lag(lang) OVER (ORDER BY doc_id) AS before FROM documents)
    WHERE regexp_matches(text, '{CLS}') AND lang IS DISTINCT FROM before"""
)
def w1_landing_filter(spark, sf):
    docs = b.documents(spark, sf, "doc_id", "lang", "text")
    kept = dd.first_of_run(docs, "doc_id", "lang", F.col("text").rlike(b.VOCAB), bucket_rows=50_000)
    return kept.select("doc_id", "lang", F.md5("text").alias("digest"))


@query(
    f"""SELECT count(*)::BIGINT AS kept, (SELECT count(*) FROM documents)::BIGINT AS total,
      round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM documents), 6) AS percent
    FROM (SELECT *, lag(lang) OVER (ORDER BY doc_id) AS before FROM documents)
    WHERE regexp_matches(text, '{CLS}') AND lang IS DISTINCT FROM before"""
)
def a20_landing_counter(spark, sf):
    docs = b.documents(spark, sf, "doc_id", "lang", "text")
    path = scratch_path(spark, "landing")
    return _rounded(land_reviews(docs, path, b.VOCAB, b.VOCAB, "doc_id", "lang"), "percent")


@query(
    f"""SELECT doc_id, lang, md5(text) AS digest, array_to_string(regexp_extract_all(text, '{CLS}'), '') AS symbols
    FROM documents QUALIFY row_number() OVER (PARTITION BY lang, text ORDER BY doc_id) = 1"""
)
def d1_dedup_scalar(spark, sf):
    from glyphline.functions.symbols import extract_symbols

    docs = b.documents(spark, sf, "doc_id", "lang", "text").withColumn("symbols", extract_symbols("text", b.VOCAB))
    kept = dd.dedup_scalar(docs, "doc_id")
    return kept.select("doc_id", "lang", F.md5("text").alias("digest"), F.array_join("symbols", "").alias("symbols"))


@query("SELECT doc_id, lang, source FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1")
def d2_dedup_key(spark, sf):
    docs = b.documents(spark, sf, "doc_id", "lang", "source", "text")
    return dd.dedup_key(docs, "text", "doc_id").select("doc_id", "lang", "source")


@query(
    f"""SELECT count(*) FILTER (regexp_matches(text, '{CLS}'))::BIGINT AS kept, count(*)::BIGINT AS total,
      round(count(*) FILTER (regexp_matches(text, '{CLS}')) * 100.0::DOUBLE / count(*), 6) AS percent FROM documents"""
)
def a20_selectivity(spark, sf):
    docs = b.documents(spark, sf, "text")
    return _rounded(dd.selectivity(docs, F.col("text").rlike(b.VOCAB)), "percent")


@query(
    f"""WITH {D} SELECT lang AS emotion, symbol, count(*)::BIGINT AS n FROM d GROUP BY lang, symbol
    QUALIFY row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, symbol) <= 5"""
)
def t8_top_k_of_counts(spark, sf):
    rows = b.symbol_rows(spark, sf, "lang").withColumnRenamed("lang", "emotion")
    ranked = sg.ranked_model(symbol_counts_by(rows, "emotion"))
    return ranked.filter(F.col("rnk") <= 5).select("emotion", "symbol", "n")


# ---------------------------------------------------------------- models


def _profile(spark, sf):
    """The profile, written once: the models pass over it many times, over the texts never."""
    return checkpointed(pf.symbol_profile(b.rated_symbol_rows(spark, sf)))


@query(
    PROFILE_SQL
    + " SELECT symbol, "
    + ", ".join(
        f"round(coalesce(({c} - avg({c}) OVER ()) / nullif(stddev_pop({c}) OVER (), 0), "
        f"CASE WHEN {c} IS NOT NULL THEN 0 END), 6) AS z_{c}"
        for c in pf.FEATURES
    )
    + " FROM profile"
)
def m1_standardize(spark, sf):
    scaled = ml.standardize(pf.symbol_profile(b.rated_symbol_rows(spark, sf)))
    names = [f"z_{c}" for c in pf.FEATURES]
    return _rounded(scaled.select("symbol", *names), *names)


@query(PROFILE_SQL + " SELECT symbol, CASE WHEN avg_rating IS NOT NULL THEN true END AS nearest FROM profile")
def m2_cluster_symbols(spark, sf):
    """Every symbol is in the cluster with the nearest centre; unrated symbols are in none."""
    return ml.distance_to_centres(_profile(spark, sf)).select("symbol", "nearest")


@query(
    PROFILE_SQL + """ SELECT count(*) FILTER (avg_rating IS NOT NULL)::BIGINT AS rated, 5::BIGINT AS clusters,
      0.0::DOUBLE AS centre_gap, true AS apart FROM profile"""
)
def m2_cluster_centres(spark, sf):
    """Five clusters, each centre the mean of its members, and most of the spread between the clusters."""
    found = ml.cluster_quality(_profile(spark, sf))
    return found.select(
        "rated", F.col("clusters").cast("bigint").alias("clusters"), F.round("centre_gap", 6).alias("centre_gap"),
        (F.col("spread") < 0.5).alias("apart"),
    )


@query(
    """SELECT * FROM (VALUES (1::BIGINT, 1::BIGINT, 1.0::DOUBLE, 0.0::DOUBLE), (1, 2, 0.0, 0.0), (2, 2, 1.0, 0.0))
    AS t(axis, other, product, residual)"""
)
def m3_pca(spark, sf):
    """The axes are orthonormal and solve C v = lambda v for the covariance of the scaled features."""
    checked = ml.axis_residuals(_profile(spark, sf))
    near = lambda c: F.abs(F.round(c, 6)) * F.when(F.round(c, 6) < 0, -1).otherwise(1)
    return checked.select(
        F.col("axis").cast("bigint").alias("axis"), F.col("other").cast("bigint").alias("other"),
        near("product").alias("product"), near("residual").alias("residual"),
    )


@query(
    f"""WITH {S}, k AS (SELECT doc_id, symbol, count(*) AS n FROM (SELECT doc_id, unnest(syms) AS symbol FROM s) GROUP BY ALL)
    SELECT doc_id, sum(n)::DOUBLE AS total, count(*)::BIGINT AS kinds, max(n)::DOUBLE AS most FROM k GROUP BY doc_id"""
)
def m4_symbol_vectors(spark, sf):
    rows = checkpointed(b.symbol_rows(spark, sf, "doc_id"))
    counts = ml.symbol_vectors(rows).transform(rows)
    # a sparse vector's own values, without the zeros of the vocabulary
    counts = counts.withColumn("v", F.unwrap_udt("features")["values"])
    return counts.select(
        "doc_id",
        F.aggregate("v", F.lit(0.0), lambda a, x: a + x).alias("total"),
        F.size(F.filter("v", lambda x: x > 0)).cast("bigint").alias("kinds"),
        F.array_max("v").alias("most"),
    )


@query(
    f"""WITH {D}, {_emotion('documents')}, r AS (SELECT DISTINCT doc_id FROM d)
    SELECT emotion, count(*)::BIGINT AS rows, count(*)::BIGINT AS predicted FROM r LEFT JOIN dom USING (doc_id) GROUP BY emotion"""
)
def m5_symbol_classifier(spark, sf):
    """Every row with or without a label is predicted, and no prediction is null."""
    # the symbols, with repeats, join by id: carried through the labelling, every token would hold them
    rows = b.symbol_rows(spark, sf, "doc_id")
    labelled = checkpointed(rows.join(_texts(spark, sf), "doc_id"))
    model = ml.fit_symbol_classifier(labelled)
    found = ml.predicted_labels(model, labelled)
    return found.groupBy("emotion").agg(F.count(F.lit(1)).alias("rows"), F.count("predicted").alias("predicted"))


@query(f"WITH {S} SELECT count(*)::BIGINT AS rows, true AS learned FROM s WHERE doc_id % 5 = 0")
def m5_held_out(spark, sf):
    """A planted label, whether é or ü is among a row's symbols, on rows that the forest has not seen:
    better than always the most frequent label, by more than half of what that leaves."""
    rows = checkpointed(b.symbol_rows(spark, sf, "doc_id"))
    rows = rows.withColumn("emotion", F.when(F.arrays_overlap("symbols", F.array(F.lit("é"), F.lit("ü"))), "joy").otherwise("trust"))
    found = ml.held_out_accuracy(rows, F.col("doc_id") % 5 == 0, trees=30)
    return found.select("rows", (2 * F.col("right") > F.col("rows") + F.col("majority")).alias("learned"))
