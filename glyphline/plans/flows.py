"""End-to-end jobs on a reviews table and on a folder of posts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from glyphline.functions.fixed_values import (
    ASSOCIATION_DROPPED_SYMBOLS,
    CATCH_ALL_CATEGORY,
    EXTRA_CLOUD_STOPWORDS,
    SUGGESTION_EXCLUDED,
    SUGGESTION_EXCLUDED_WITH_TONES,
)
from glyphline.functions.symbols import emoji_class, emoji_sequence_patterns, extract_symbols, has_symbol_seq
from glyphline.functions.text import combined_text
from glyphline.operators import emotion, frequency, groups, models, pairs, polarity, profile, suggest, terms
from glyphline.operators.dedup import dedup_scalar, first_of_run
from glyphline.session import checkpointed
from glyphline.sources.tables import label_table, write_rows


def land_reviews(
    reviews: DataFrame,
    path: str,
    vocab: str | None = None,
    sequences: str | Iterable[str] | None = None,
    order: str = "review_id",
    title: str = "title",
    text: str = "text",
    fmt: str = "parquet",
) -> DataFrame:
    """Keep reviews with a symbol sequence whose title differs from the row before, write
    them with their symbols, and return the kept / total counter.

    ``n_symbols`` is written because a regex is never pushed into a Parquet scan, while
    ``n_symbols > 0`` is: later jobs skip the texts.
    """
    vocab = vocab or emoji_class()
    from_row = has_symbol_seq(sequences or emoji_sequence_patterns(), text, title)
    kept = first_of_run(reviews, order, title, from_row)
    landed = kept.withColumn("symbols", extract_symbols(combined_text(title, text), vocab)).withColumn(
        "n_symbols", F.size("symbols")
    )
    write_rows(landed, path, fmt)
    return _counter(reviews, path, fmt)


def _counter(reviews: DataFrame, path: str, fmt: str) -> DataFrame:
    """Rows written, rows given, and the percentage."""
    written = reviews.sparkSession.read.format(fmt).option("header", True).option("multiLine", True).option(
        "escape", '"'
    ).load(path)
    total = reviews.agg(F.count(F.lit(1))).scalar()
    return written.agg(F.count(F.lit(1)).alias("kept")).select(
        "kept", total.alias("total"), (F.col("kept") * F.lit(100.0) / F.nullif(total, F.lit(0))).alias("percent")
    )


def land_distinct(
    reviews: DataFrame,
    path: str,
    sequences: str | Iterable[str] | None = None,
    order: str = "review_id",
    title: str = "title",
    text: str = "text",
    fmt: str = "csv",
) -> DataFrame:
    """Keep reviews with a symbol sequence in text or title, one of each combination of the
    scalar columns, write them as CSV, and return the kept / total counter."""
    kept = reviews.filter(has_symbol_seq(sequences or emoji_sequence_patterns(), text, title))
    write_rows(dedup_scalar(kept, order), path, fmt)
    return _counter(reviews, path, fmt)


def symbol_map(
    landed: DataFrame, rating: str = "rating", item: str = "item_id", k: int = 5, seed: int = 42, label_above: int = 10
) -> DataFrame:
    """Profile, cluster and two coordinates of every symbol (null for symbols without a rating),
    and ``labelled``: whether the symbol is frequent enough to be named on a map."""
    features = checkpointed(profile.symbol_profile(landed, rating, item))
    placed = models.pca2(features).select("symbol", "pca1", "pca2")
    mapped = models.cluster_symbols(features, k, seed).join(placed, "symbol")
    return mapped.withColumn("labelled", F.col("n") > label_above)


def cooccurrence_matrix(
    posts: DataFrame, labels: DataFrame | None = None, vocab: str | None = None, k: int = 20
) -> DataFrame:
    """Scaled matrix of the symbols in the k most frequent pairs of the labelled posts."""
    known = polarity.restrict_labels(posts, label_table(posts.sparkSession) if labels is None else labels)
    rows = frequency.with_symbols(known, vocab or emoji_class(), "text", keep=())
    return pairs.log_minmax(pairs.top_pair_matrix(pairs.cooccurrence_counts(rows), k))


def group_association(
    reviews: DataFrame,
    vocab: str | None = None,
    drop_groups: Iterable[str] = (CATCH_ALL_CATEGORY,),
    drop_symbols: Iterable[str] = ASSOCIATION_DROPPED_SYMBOLS,
    **settings,
) -> DataFrame:
    """Symbols tied to primary categories, with their share per category. The catch-all
    category, skin tones and the gender sign are left out unless told otherwise."""
    rows = frequency.with_symbols(reviews, vocab or emoji_class(), "title", "text", keep=("categories",))
    grouped = groups.with_primary_category(rows, "categories")
    top = settings.pop("top", 10)
    support = settings.pop("min_support", 10)
    cells = checkpointed(groups.association_cells(grouped, "grp", drop_groups=drop_groups, drop_symbols=drop_symbols, **settings))
    best = groups.top_associations(groups.chi2_from_cells(cells, "grp", support), top)
    return groups.row_share(cells).join(F.broadcast(best), "symbol").select("symbol", "chi2", "grp", "n", "share")


def symbol_clouds(reviews: DataFrame, stopwords: DataFrame, text: str = "cleaned_text", k: int = 5, max_words: int = 200) -> DataFrame:
    """Weighted terms (words and collocations) of the texts holding each of the k most
    frequent symbols. ``reviews`` is a symbols frame with a text column."""
    extra = reviews.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(w) for w in EXTRA_CLOUD_STOPWORDS])).alias("word")
    )
    corpora = terms.symbol_corpora(reviews, text, k)
    # texts without a chosen symbol are blanked, so they are not tokenised
    texts = corpora.select("hits", F.when(F.size("hits") > 0, F.col(text)).alias(text))
    stop = stopwords.select("word").union(extra).distinct()
    found = terms.cloud_frequencies(texts, stop, text, "symbol", unfold="hits")
    return terms.term_weights(found, "symbol", max_words=max_words)


def polarity_by_label(posts: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Counts, ratio, shares and the no-words flag per label."""
    return polarity.polarity_share(polarity.polarity_ratio(polarity.polarity_counts(posts, lexicon)))


def emotion_model(landed: DataFrame, lexicon: DataFrame, text: str = "text", id_col: str = "review_id") -> DataFrame:
    """(emotion, symbol, n) of a symbols frame, each text labelled by its words."""
    sets = landed.withColumn("symbols", F.array_distinct("symbols"))
    return suggest.emotion_model(emotion.labelled(sets, lexicon, text, id_col, "symbols"))


def suggestions(
    texts: DataFrame,
    model: DataFrame,
    id_col: str = "review_id",
    k: int = 3,
    seed: int = 42,
    without_tones: bool = True,
    exclude: Iterable[str] | None = None,
) -> DataFrame:
    """A seeded choice among the k most frequent symbols of each text's emotion. Thumbs, which
    suit every text, are left out, and skin tones with them; ``exclude`` names others instead."""
    usual = SUGGESTION_EXCLUDED_WITH_TONES if without_tones else SUGGESTION_EXCLUDED
    return suggest.suggest_topk(texts, model, id_col, k, seed, usual if exclude is None else exclude)
