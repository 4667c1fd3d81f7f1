"""Numeric expressions used by scoring and ranking."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

COMPOUND_ALPHA = 15.0
BUCKET_CUT = 0.05


def compound(total: Column) -> Column:
    """Summed valence squeezed into (-1, 1) (Hutto and Gilbert, 2014)."""
    return total / F.sqrt(total * total + F.lit(COMPOUND_ALPHA))


def sentiment_bucket(score: Column) -> Column:
    return (
        F.when(score >= BUCKET_CUT, "positive")
        .when(score <= -BUCKET_CUT, "negative")
        .when(score.isNotNull(), "neutral")
    )


def damped(n: Column) -> Column:
    return n / F.ln(n + F.lit(2))


def share(part: Column, whole: Column) -> Column:
    """part / whole, null when whole is 0."""
    return part / F.nullif(whole, F.lit(0))


def rank_value(score: Column) -> Column:
    """A computed double as a ranking key. Sums of doubles depend on the order in which
    tasks finish, so equal scores may differ in their last digits; rounded, they tie."""
    return F.round(score, 9)


def seeded_uniform(seed: int, *keys: Column) -> Column:
    """52-bit integer that depends only on the seed and the keys, so that a retried
    task draws the same number again."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint")


def bigram_likelihood(c12: Column, c1: Column, c2: Column, n: Column) -> Column:
    """Dunning's log-likelihood ratio of a word pair (1993); 0 when undefined."""

    def log_l(k: Column, m: Column, x: Column) -> Column:
        hit = F.when(k > 0, k * F.ln(x)).otherwise(F.lit(0.0))
        miss = F.when(m - k > 0, (m - k) * F.ln(F.lit(1.0) - x)).otherwise(F.lit(0.0))
        return hit + miss

    p = c2 / n
    p1 = c12 / c1
    p2 = (c2 - c12) / F.nullif(n - c1, F.lit(0))
    ratio = (
        log_l(c12, c1, p) + log_l(c2 - c12, n - c1, p) - log_l(c12, c1, p1) - log_l(c2 - c12, n - c1, p2)
    )
    return F.when((n <= c1) | (n <= c2), F.lit(0.0)).otherwise(F.lit(-2.0) * ratio)
