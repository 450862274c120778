"""Scores of newsletter candidates. All arithmetic is in double."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Weights, window and caps of the weekly ranking.
QUALITY_WEIGHT = 0.4
RECENCY_WEIGHT = 0.4
DIVERSITY_WEIGHT = 0.2
TOP_RATING = 5.0
WINDOW_DAYS = 7
PER_CATEGORY = 5
PER_ISSUE = 20


def quality_recency(rating: Column, published: Column, as_of: Column) -> Column:
    """Source quality plus freshness; freshness falls from 1 to 0 over the window, counted from midnight."""
    age = (F.unix_timestamp(as_of) - F.unix_timestamp(published.cast("timestamp"))).cast("double")
    fresh = F.greatest(F.lit(1.0) - age / F.lit(WINDOW_DAYS * 86400.0), F.lit(0.0))
    return rating.cast("double") / F.lit(TOP_RATING) * F.lit(QUALITY_WEIGHT) + fresh * F.lit(RECENCY_WEIGHT)


def diversity(category_rank: Column) -> Column:
    """First of its category gets the full bonus, the last one kept a fifth of it."""
    steps = F.greatest(F.lit(PER_CATEGORY + 1) - category_rank, F.lit(0)).cast("double")
    return steps / F.lit(float(PER_CATEGORY)) * F.lit(DIVERSITY_WEIGHT)
