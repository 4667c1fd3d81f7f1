"""Term frequencies, per corpus and per symbol, and the tables behind word clouds.

Stop words are removed from the counts of words, not from the tokens: Catalyst chooses the
place, as it moves the anti join under the count when the list is small enough to
broadcast. Pairs of neighbours are many more than words, so there stop words go first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from glyphline.functions.scoring import bigram_likelihood
from glyphline.functions.text import clean_words, cloud_tokens, cloud_word, raw_cloud_tokens
from glyphline.operators.frequency import top_symbols
from glyphline.session import scratch_path


def _written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table that is computed once, of which each reader takes the columns it needs."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stopwords(terms: DataFrame, stopwords: DataFrame, word: str = "word") -> DataFrame:
    return terms.join(stopwords.select(F.col("word").alias(word)), word, "left_anti")


def term_frequency(df: DataFrame, stopwords: DataFrame, text: str = "text") -> DataFrame:
    """Cleaned, white-space split words and their counts."""
    found = df.select(F.explode_outer(clean_words(text)).alias("word")).filter(F.col("word").isNotNull())
    return drop_stopwords(found.groupBy("word").agg(F.count(F.lit(1)).alias("n")), stopwords)


def symbol_corpora(df: DataFrame, text: str, k: int = 5, symbols: DataFrame | None = None) -> DataFrame:
    """Every text with ``hits``, the chosen symbols it holds (none gives an empty list).

    The choice is the k most frequent symbols, or the given ``symbols``. It becomes a
    one-row scalar subquery, so each text is kept once, however many it matches.
    """
    chosen = symbols if symbols is not None else top_symbols(df, k)
    wanted = chosen.agg(F.array_sort(F.collect_set("symbol")).alias("_wanted")).scalar()
    return df.select(text, F.sort_array(F.array_intersect("symbols", wanted)).alias("hits"))


def term_frequency_by_symbol(
    df: DataFrame, stopwords: DataFrame, text: str = "text", k: int = 5, symbols: DataFrame | None = None
) -> DataFrame:
    """Word counts of the texts holding each of the chosen symbols.

    Words are counted per combination of chosen symbols first and split over the
    symbols afterwards: a text holding all five is tokenised and counted once. A text
    holding none is not tokenised at all; a filter would extract the symbols twice.
    """
    corpora = symbol_corpora(df, text, k, symbols)
    wanted_tokens = F.when(F.size("hits") > 0, raw_cloud_tokens(text))
    counted = (
        corpora.select("hits", F.explode_outer(wanted_tokens).alias("token"))
        .select("hits", cloud_word(F.col("token")).alias("word"))
        .filter(F.col("word").isNotNull())
        .groupBy("hits", "word")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    per_symbol = (
        counted.select(F.explode("hits").alias("symbol"), "word", "_n")
        .groupBy("symbol", "word")
        .agg(F.sum("_n").alias("n"))
    )
    return drop_stopwords(per_symbol, stopwords)


def _stem(word: Column) -> Column:
    """The word without a plural s; ``-ss`` is no plural."""
    plural = word.endswith("s") & ~word.endswith("ss") & (F.length(word) > 1)
    return F.when(plural, F.left(word, F.length(word) - F.lit(1))).otherwise(word)


def _least_form(word: Column, stem: Column) -> Column:
    """The smallest word of a stem's group: the stem where it occurs, else its plural. A flag is
    aggregated by hashing, where the least string would sort all lines."""
    return F.when(F.max(word == _stem(word)), stem).otherwise(F.concat(stem, F.lit("s")))


def merge_plurals(terms: DataFrame, *corpus: str) -> DataFrame:
    """Add the count of ``words`` to ``word`` where both occur.

    Singular and plural share a stem, so one regrouping does it without a self join: the
    smaller of the two is the stem itself whenever that occurs.
    """
    return (
        terms.groupBy(*corpus, _stem(F.col("word")).alias("_stem"))
        .agg(F.sum("n").alias("n"), _least_form(F.col("word"), F.col("_stem")).alias("word"))
        .select(*corpus, "word", "n")
    )


def term_weights(terms: DataFrame, *corpus: str, max_words: int = 200) -> DataFrame:
    """The ``max_words`` most frequent terms with their count relative to the largest.

    The rank limit is applied by each task before the shuffle, so one large corpus
    does not land in one task as a whole.
    """
    order = (
        Window.partitionBy(*corpus)
        .orderBy(F.desc("n"), "word")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranked = terms.withColumn("rnk", F.row_number().over(order)).filter(F.col("rnk") <= max_words)
    top = F.first("n").over(order)
    return ranked.withColumn("weight", F.col("n") / top).withColumn("rnk", F.col("rnk").cast("bigint"))


def bigrams(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """Each cloud token of a text (w1) with the one after it (w2, null for the last).

    The pairs are zipped inside the row: exploding positions instead would carry the
    whole token list along with every token.
    """
    listed = df.select(*keep, cloud_tokens(text).alias("_t"))
    following = F.slice("_t", F.lit(2), F.size("_t"))
    zipped = F.arrays_zip(F.col("_t").alias("w1"), following.alias("w2"))
    return listed.select(*keep, F.explode_outer(zipped).alias("_p")).select(*keep, "_p.*").filter(
        F.col("w1").isNotNull()
    )


def _neighbour_counts(df: DataFrame, stopwords: DataFrame, text: str, *corpus: str, unfold: str | None = None):
    """(word counts, pair counts) from one pass over the texts.

    The pass counts (token, next token); word counts are sums of those lines. The table
    is written, as words, pairs and totals all come from it. Lines that start with a
    stop word are dropped before the count, and a stop word as the next token is blanked:
    no word or pair counted loses anything, and most keys are never shuffled. ``unfold``
    names an array of corpus keys: lines are counted per list of keys and split over the
    keys afterwards.
    """
    keys = (unfold,) if unfold else corpus
    stop = stopwords.select("word").distinct()
    found = drop_stopwords(bigrams(df, text, *keys), stop, "w1")
    marked = found.join(stop.select(F.col("word").alias("w2"), F.lit(True).alias("_stop")), "w2", "left")
    found = marked.withColumn("w2", F.when(F.col("_stop").isNull(), F.col("w2")))
    counts = found.groupBy(*keys, "w1", "w2").agg(F.count(F.lit(1)).alias("n"))
    if unfold:
        unfolded = counts.select(F.explode(unfold).alias(corpus[0]), "w1", "w2", "n")
        counts = unfolded.groupBy(*corpus, "w1", "w2").agg(F.sum("n").alias("n"))
    counts = _written(counts, "neighbours")
    unigrams = counts.groupBy(*corpus, F.col("w1").alias("word")).agg(F.sum("n").alias("n"))
    return unigrams, counts.filter(F.col("w2").isNotNull()).withColumnRenamed("n", "c12")


def _collocated(pairs: DataFrame, threshold: float) -> DataFrame:
    as_double = [F.col(c).cast("double") for c in ("c12", "c1", "c2", "total")]
    return pairs.withColumn("score", bigram_likelihood(*as_double)).filter(F.col("score") > threshold)


def bigram_collocations(
    df: DataFrame, stopwords: DataFrame, text: str = "text", threshold: float = 30.0
) -> DataFrame:
    """Word pairs whose likelihood ratio exceeds the threshold."""
    unigrams, pairs = _neighbour_counts(df, stopwords, text)
    counted = (
        pairs.join(unigrams.select(F.col("word").alias("w1"), F.col("n").alias("c1")), "w1")
        .join(unigrams.select(F.col("word").alias("w2"), F.col("n").alias("c2")), "w2")
        .withColumn("total", unigrams.agg(F.sum("n")).scalar())
    )
    return _collocated(counted, threshold).select("w1", "w2", "c12", "c1", "c2", "score")


def cloud_frequencies(
    df: DataFrame,
    stopwords: DataFrame,
    text: str,
    *corpus: str,
    threshold: float = 30.0,
    unfold: str | None = None,
) -> DataFrame:
    """The terms of one cloud per corpus: words with plurals merged, and collocations.

    A collocation takes its count away from both of its words; a word left with nothing
    disappears. Plurals of pairs are merged like those of words. With ``unfold`` a text
    belongs to all corpora named in that array, under the one ``corpus`` column.
    """
    unigrams, pairs = _neighbour_counts(df, stopwords, text, *corpus, unfold=unfold)
    same_stem = Window.partitionBy(*corpus, _stem(F.col("word")))
    forms = unigrams.select(
        *corpus, "word", F.min("word").over(same_stem).alias("std"), F.sum("n").over(same_stem).alias("c")
    )
    merged = pairs.groupBy(*corpus, "w1", _stem(F.col("w2")).alias("_stem")).agg(
        F.sum("c12").alias("c12"), _least_form(F.col("w2"), F.col("_stem")).alias("w2")
    )
    for side in ("1", "2"):
        form = forms.select(
            *corpus, F.col("word").alias(f"w{side}"), F.col("std").alias(f"std{side}"), F.col("c").alias(f"c{side}")
        )
        merged = merged.join(form, [*corpus, f"w{side}"])
    if corpus:
        merged = merged.join(unigrams.groupBy(*corpus).agg(F.sum("n").alias("total")), [*corpus])
    else:
        merged = merged.withColumn("total", unigrams.agg(F.sum("n")).scalar())
    kept = _collocated(merged, threshold).select(*corpus, "w1", "w2", "std1", "std2", "c12")
    # both words and pairs come from it
    found = _written(kept, "collocations")
    taken = found.select(*corpus, F.explode(F.array("std1", "std2")).alias("word"), (-F.col("c12")).alias("n"))
    words = merge_plurals(unigrams, *corpus).unionByName(taken).groupBy(*corpus, "word").agg(F.sum("n").alias("n"))
    both = found.select(*corpus, F.concat_ws(" ", "w1", "w2").alias("word"), F.col("c12").alias("n"))
    return words.filter(F.col("n") > 0).unionByName(both)
