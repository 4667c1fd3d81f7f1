"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

Every source has a weight; its target is its share of all words, stopped at a number of
passes over the source, and the excess goes to the others by weight. The budget is cut into
blocks of equal length, given to sources one by one to the highest quotient
``target / (2 k + 1)``, and inside a source to its shards by the same rule. In a shard the
documents stand in a seeded order, and the blocks taken are a run from a seeded place,
round the end when needed, after as many whole passes as fit. A document takes the words
that the run covers.

A source with n documents has about sqrt(n) shards of sqrt(n) documents, so neither the
shards of a source nor the documents of a shard gather more than that in one task. The
highest quotients are found without listing blocks: two thresholds hold the last seat
between them, and only the seats between the thresholds are ranked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from glyphline.llm.common import WORD, fresh, query, same, table, whole
from glyphline.session import checkpointed

BLOCK_WORDS = 32
MAX_PASSES = 3
WEIGHTS = (1, 2, 3)
SEED = "mix-1"


def sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str) -> DataFrame:
    """Documents without their texts: key, source, number of words and the seeded order."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), whole(text_col).alias("text"))
    rows = rows.select(
        "doc_id", "source", F.xxhash64("text").alias("digest"), F.regexp_count("text", F.lit(WORD)).cast("bigint").alias("size")
    )
    order = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "size"))
    return checkpointed(rows.withColumn("place", order))


def targets(sized: DataFrame, weights=WEIGHTS, max_passes: int = MAX_PASSES) -> DataFrame:
    """One row per source: words, documents and the target in words.

    The cap of a source over its weight says at which level it fills up. In that order the
    level of what is not yet full is known from sums before and after, so the targets
    need one window over the sources and no iteration.
    """
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("documents"))
    everything = W.partitionBy(F.lit(0))
    listed = F.array(*[F.lit(float(w)) for w in weights])
    ranked = by_source.select(
        "*",
        F.get(listed, ((F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)).cast("int")).alias("weight"),
        F.sum("source_size").over(everything).alias("total"),
        (F.lit(max_passes) * F.col("source_size")).alias("cap"),
    )
    fill = everything.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(W.unboundedPreceding, -1)
    after = fill.rowsBetween(0, W.unboundedFollowing)
    levels = ranked.select(
        "*",
        ((F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(after)).alias("level"),
        (F.col("cap") / F.col("weight")).alias("full_at"),
    )
    # sources up to the first that is not full are capped; its level holds for it and all after
    open_level = F.min(F.when(F.col("full_at") > F.col("level"), F.struct("full_at", "level"))).over(everything)
    return levels.select("*", open_level.alias("open")).select(
        "source", "source_size", "documents", "total",
        F.when(
            F.col("open").isNull() | (F.col("full_at") < F.col("open.full_at")), F.col("cap").cast("double")
        ).otherwise(F.least(F.col("cap").cast("double"), F.col("weight") * F.col("open.level"))).alias("target"),
    )


def sainte_lague(parties: DataFrame, group: list[str], key: str, votes: str, seats: str) -> DataFrame:
    """Add ``quota``: the seats of each party when every seat goes to the highest quotient.

    ``votes / (2 k + 1)`` is the quotient of a party's seat number k. With V votes, S parties
    and n seats, at least n - S and at most n quotients reach V / (2n - S), and at least n
    reach V / (2n + S): seats above the first threshold are given at once, those between the
    two are ranked, ties by key. A group holds as many rows as it has parties.
    """
    per_group = W.partitionBy(*[F.col(c) for c in group])
    total, count = F.sum(votes).over(per_group), F.count(F.when(F.col(votes) > 0, 1)).over(per_group)
    n = F.col(seats)
    bound = parties.select("*", total.cast("double").alias("_v"), count.alias("_s"))

    def reached(double_seats: Column) -> Column:
        theta = F.col("_v") / double_seats
        k = F.floor((F.col(votes) / theta + 1) / 2)
        return F.when((double_seats > 0) & (F.col("_v") > 0), F.greatest(k, F.lit(0))).otherwise(F.lit(0))

    # one seat of slack on both sides keeps the bounds true under rounding
    low = F.greatest(reached(2 * n - F.col("_s")) - 1, F.lit(0)).cast("bigint")
    high = (reached(2 * n + F.col("_s")) + 1).cast("bigint")
    open_ = bound.select("*", low.alias("_low"), high.alias("_high")).withColumn(
        "_left", F.col(seats) - F.sum("_low").over(per_group)
    )
    contested = open_.filter(F.col(votes) > 0).select(
        *group, key, votes, "_left", F.explode(F.sequence("_low", "_high")).alias("_k")
    )
    by_quotient = per_group.orderBy((F.col(votes) / (2 * F.col("_k") + 1)).desc(), F.col(key).asc_nulls_last())
    won = (
        contested.select("*", F.row_number().over(by_quotient).alias("_rank"))
        .filter(F.col("_rank") <= F.col("_left"))
        .groupBy(*dict.fromkeys([*group, key]))
        .agg(F.count("*").alias("_won"))
    )
    left, right = open_.alias("p"), won.alias("w")
    match = [same(F.col(f"p.{c}"), F.col(f"w.{c}")) for c in dict.fromkeys([*group, key])]
    return left.join(right, match, "left").select(
        *[F.col(f"p.{c}") for c in parties.columns], (F.col("p._low") + F.coalesce("w._won", F.lit(0))).alias("quota")
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=WEIGHTS,
    max_passes: int = MAX_PASSES,
    block_words: int = BLOCK_WORDS,
    seed: str = SEED,
) -> DataFrame:
    """One row per input row: size, source_size, target of the source and words taken.

    ``passes`` whole passes are taken, and besides the words from ``first`` on, ``extra`` in
    number, round the document's end when first + extra exceeds its size. ``taken`` is their
    sum, at most ``max_passes`` times the size. A null text has no words; the null source
    comes last; rows equal in id and size are told apart by nothing and share one place's
    words in any order; an empty table gives an empty result. Words taken of a source differ
    from its target by less than a block; a source that is taken ``max_passes`` times is taken exactly so often.
    """
    sized = sizes(docs, id_col, text_col, source_col, seed)
    goal = targets(sized, weights, max_passes).withColumns({
        "everything": F.lit(0),
        "blocks": F.round(F.col("total") / block_words).cast("bigint"),
        "shards": F.ceil(F.sqrt("documents")).cast("bigint"),
    })
    by_source = checkpointed(sainte_lague(goal, ["everything"], "source", "target", "blocks"))
    number = F.conv(F.substring("place", 1, 8), 16, 10).cast("bigint")
    dealt = sized.alias("d").join(by_source.alias("s"), same(F.col("d.source"), F.col("s.source"))).select(
        "d.*", "s.source_size", "s.target", F.col("s.quota").alias("source_quota"),
        F.pmod(number, F.col("s.shards")).alias("shard"),
    )
    # a source whose target is its cap is taken whole, whatever blocks its shards would get
    capped = F.first(F.col("target") >= F.lit(max_passes) * F.col("source_size")).alias("capped")
    shards = dealt.groupBy("source", "shard").agg(
        F.sum("size").alias("shard_size"), F.first("source_quota").alias("source_quota"), capped
    )
    quotas = sainte_lague(shards, ["source"], "shard", "shard_size", "source_quota")
    key = ["source", "shard"]
    start = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.col("q.shard"), F.col("q.source"))), 1, 8), 16, 10)
    most = max_passes * F.col("q.shard_size")
    words = F.when(F.col("q.capped"), most).otherwise(F.least(F.col("q.quota") * block_words, most))
    quotas = quotas.alias("q").filter("shard_size > 0").withColumn("words", words).select(
        *key, "shard_size", F.expr("words div shard_size").alias("passes"),
        F.pmod(F.col("words"), F.col("shard_size")).alias("run"),
        F.pmod(start.cast("bigint"), F.col("q.shard_size")).alias("start"),
    )
    run_so_far = W.partitionBy(*key).orderBy("place", "doc_id").rowsBetween(W.unboundedPreceding, -1)
    placed = dealt.withColumn("at", F.coalesce(F.sum("size").over(run_so_far), F.lit(0)))
    joined = placed.alias("d").join(quotas.alias("q"), [same(F.col(f"d.{c}"), F.col(f"q.{c}")) for c in key], "left")
    zero = F.lit(0).cast("bigint")
    end, stop = F.col("at") + F.col("size"), F.col("start") + F.col("run")
    # the run is [start, stop); what passes the shard's end goes on at its beginning
    in_first = F.greatest(zero, F.least(end, stop, F.col("shard_size")) - F.greatest("at", "start"))
    in_wrap = F.greatest(zero, F.least(end, stop - F.col("shard_size")) - F.col("at"))
    first = F.when(in_first > 0, F.greatest("at", "start") - F.col("at")).otherwise(zero)
    return joined.select(
        "d.doc_id", "d.source", "d.digest", "d.size", "d.source_size", "d.target",
        F.coalesce("q.passes", zero).alias("passes"),
        F.coalesce(first, zero).alias("first"),
        F.coalesce(in_first + in_wrap, zero).alias("extra"),
    ).withColumn("taken", F.col("passes") * F.col("size") + F.col("extra"))


def draw(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **settings) -> DataFrame:
    """The mixed table with the columns of ``docs``: a row for each whole pass over a document,
    and one for the words of a partial pass, cut at words with the white space between.

    A null or empty text has no words and gives no row; a null id or source is carried through; rows that are
    equal in id, source and text are taken each by a plan of their own; an empty table stays empty."""
    plan = mix(docs, id_col, text_col, source_col, **settings)
    # repeated rows have equal plans but for the run, so each keeps its own plan by number
    numbered = W.partitionBy("doc_id", "source", "digest").orderBy("first", "extra")
    plan = plan.filter("taken > 0").select(
        "doc_id", "source", "digest", "size", "passes", "first", "extra", F.row_number().over(numbered).alias("copy")
    ).alias("p")
    digest, copy, drawn_text = fresh(docs, "_digest"), fresh(docs, "_copy"), fresh(docs, "_drawn")
    rows = docs.withColumn(digest, F.xxhash64(whole(text_col)))
    keys = [F.col(id_col), F.col(source_col), F.col(digest)]
    rows = rows.withColumn(copy, F.row_number().over(W.partitionBy(*keys).orderBy(F.lit(0)))).alias("d")
    match = (
        same(F.col(f"d.`{id_col}`"), F.col("p.doc_id"))
        & same(F.col(f"d.`{source_col}`"), F.col("p.source"))
        & (F.col(f"d.{digest}") == F.col("p.digest"))
        & (F.col(f"d.{copy}") == F.col("p.copy"))
    )
    text = whole(F.col(f"d.`{text_col}`"))
    words = F.regexp_extract_all(text, F.lit(rf"{WORD}[\x20\x09-\x0D]*"), F.lit(0))
    size, first, extra = F.col("p.size").cast("int"), F.col("p.first").cast("int"), F.col("p.extra").cast("int")
    twice = F.when(first + extra > size, F.concat(words, words)).otherwise(words)
    part = F.array_join(F.slice(twice, first + 1, F.greatest(extra, F.lit(1))), "")
    whole_rows = F.array_repeat(text, F.col("p.passes").cast("int"))
    drawn = F.concat(whole_rows, F.when(extra > 0, F.array(part)).otherwise(F.array().cast("array<string>")))
    kept = [F.col(f"d.`{c}`") for c in docs.columns]
    out = rows.join(plan, match).select(*kept, F.explode(drawn).alias(drawn_text))
    changed = {text_col: F.col(drawn_text)}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length(drawn_text).cast("bigint")
    return out.withColumns(changed).select(*docs.columns)


#: The mix by definition: every seat of every party is listed and the highest quotients win.
SQL = f"""
WITH d AS MATERIALIZED (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size FROM documents),
p AS (SELECT *, md5(concat_ws(':', '{SEED}', coalesce(doc_id::VARCHAR, ''), size::VARCHAR)) AS place FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size, count(*)::BIGINT AS documents FROM p GROUP BY source),
w AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 3 END::DOUBLE AS weight,
    (sum(source_size) OVER ())::BIGINT AS total, ({MAX_PASSES} * source_size)::BIGINT AS cap FROM s),
v AS (
  SELECT *, cap / weight AS full_at,
    (total - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
      / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w),
o AS (SELECT full_at AS open_at, level AS open_level FROM v WHERE full_at > level ORDER BY full_at, level LIMIT 1),
t AS (
  SELECT source, source_size, documents, round(total / {BLOCK_WORDS})::BIGINT AS blocks, ceil(sqrt(documents))::BIGINT AS shards,
    CASE WHEN open_at IS NULL OR full_at < open_at THEN cap::DOUBLE ELSE least(cap::DOUBLE, weight * open_level) END AS target
  FROM v LEFT JOIN o ON true),
q AS (
  SELECT source, count(*)::BIGINT AS quota FROM (
    SELECT source, blocks, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, source NULLS LAST) AS place
    FROM (SELECT *, unnest(range(0, blocks)) AS k FROM t WHERE target > 0))
  WHERE place <= blocks GROUP BY source),
h AS (
  SELECT p.*, t.source_size, t.target, coalesce(q.quota, 0) AS source_quota,
    ('0x' || substr(place, 1, 8))::BIGINT % t.shards AS shard
  FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source LEFT JOIN q ON p.source IS NOT DISTINCT FROM q.source),
z AS (
  SELECT source, shard, sum(size)::BIGINT AS shard_size, max(source_quota)::BIGINT AS source_quota,
    bool_or(target >= {MAX_PASSES} * source_size) AS capped FROM h GROUP BY source, shard),
r AS (
  SELECT source, shard, count(*)::BIGINT AS quota FROM (
    SELECT source, shard, source_quota, row_number() OVER (PARTITION BY source ORDER BY shard_size / (2 * k + 1) DESC, shard) AS place
    FROM (SELECT *, unnest(range(0, source_quota)) AS k FROM z WHERE shard_size > 0))
  WHERE place <= source_quota GROUP BY source, shard),
m AS (
  SELECT z.source, z.shard, shard_size,
    CASE WHEN capped THEN {MAX_PASSES} * shard_size ELSE least(coalesce(quota, 0) * {BLOCK_WORDS}, {MAX_PASSES} * shard_size) END AS words,
    ('0x' || substr(md5(concat_ws(':', '{SEED}', z.shard::VARCHAR, z.source)), 1, 8))::BIGINT % shard_size AS starts
  FROM z LEFT JOIN r ON z.source IS NOT DISTINCT FROM r.source AND z.shard = r.shard WHERE shard_size > 0),
a AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source, shard ORDER BY place, doc_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begins FROM h)
SELECT doc_id, size, source_size, target, coalesce(
    (words // shard_size) * size
    + greatest(0, least(begins + size, starts + words % shard_size, shard_size) - greatest(begins, starts))
    + greatest(0, least(begins + size, starts + words % shard_size - shard_size) - begins), 0)::BIGINT AS taken
FROM a LEFT JOIN m ON a.source IS NOT DISTINCT FROM m.source AND a.shard = m.shard
"""


@query(SQL)
def op2_mix_sources(spark, sf):
    return mix(table(spark, sf, "documents")).select("doc_id", "size", "source_size", "target", "taken")
