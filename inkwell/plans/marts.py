"""Mart models: posts, authors, sources and the health of sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from inkwell.functions.text import initcap_words
from inkwell.operators.upsert import first_per_key

UNKNOWN = "Unknown"


def mart_posts(stg_posts: DataFrame, stg_summaries: DataFrame, stg_authors: DataFrame) -> DataFrame:
    """Posts with their summary and author id.

    Every named post's author is in ``stg_authors`` and the id is a hash of the name, so the id is
    computed in place and posts are not shuffled by author. Only 'Unknown' can be missing there:
    it stands for posts without a name, and has a row only when a feed really said 'Unknown'.
    """
    summary = stg_summaries.select(
        F.col("post_id").alias("id"), "summary_text", "tags", "difficulty_classification", "is_low_quality"
    )
    listed = stg_authors.filter(F.col("author_name") == UNKNOWN).select(F.col("author_name").alias("_listed")).limit(1)
    key = initcap_words("author_name")
    joined = (
        stg_posts.join(summary, "id", "left")
        .withColumn("_key", key)
        .join(F.broadcast(listed), F.col("_key") == F.col("_listed"), "left")  # at most one row
    )
    known = (F.col("_key") != UNKNOWN) | F.col("_listed").isNotNull()
    return joined.select(
        "id", "source_id", "source_name", "category", "title", "body", "url", "author_name",
        F.when(known, F.md5("_key")).alias("author_id"),
        "publication_date", "post_slug", "summary_text", "tags", "difficulty_classification", "is_low_quality",
        "created_at",
    )


def mart_authors(stg_authors: DataFrame, stg_posts: DataFrame, normalize_names: bool = False) -> DataFrame:
    """Authors with the category they write most for (ties: the first in alphabetical order).

    Categories are counted under the name as posts spell it, so an author whose feeds never use
    title case has none. ``normalize_names`` counts under the normalised name instead.
    """
    name = initcap_words("author_name") if normalize_names else F.col("author_name")
    counted = (
        stg_posts.filter(F.col("author_name") != UNKNOWN)
        .groupBy(name.alias("author_name"), "category")
        .agg(F.count(F.lit(1)).alias("posts"))
    )
    primary = first_per_key(counted, ["author_name"], [F.desc("posts"), F.asc_nulls_last("category")])
    return stg_authors.join(
        primary.select("author_name", F.col("category").alias("primary_category")), "author_name", "left"
    ).select(*stg_authors.columns, "primary_category")


def mart_sources(sources: DataFrame, stg_posts: DataFrame) -> DataFrame:
    """Sources with their number of posts and the newest post's date."""
    metrics = stg_posts.groupBy(F.col("source_id").alias("id")).agg(
        F.count(F.lit(1)).alias("total_post_count"), F.max("publication_date").alias("latest_post_date")
    )
    return sources.join(metrics, "id", "left").select(
        "id", "name", "rss_feed_url", "category", "quality_rating", "status", "last_checked_at",
        F.coalesce("total_post_count", F.lit(0).cast("long")).alias("total_post_count"),
        "latest_post_date", "created_at", "updated_at",
    )


def source_health(mart_sources: DataFrame, as_of: Column, empty_days: int = 7, stale_days: int = 3) -> DataFrame:
    """Flags inactive sources, sources still empty after ``empty_days`` and sources not checked for ``stale_days``."""

    def whole_days(since: str) -> Column:
        return F.floor((F.unix_timestamp(as_of) - F.unix_timestamp(since)) / 86400)

    unhealthy = (
        ~F.col("status").eqNullSafe("active")
        | ((F.col("total_post_count") == 0) & F.coalesce(whole_days("created_at") > empty_days, F.lit(False)))
        | F.coalesce(whole_days("last_checked_at") > stale_days, F.lit(False))
    )
    return mart_sources.select(
        "id", "name", "category", "status", "quality_rating", "total_post_count", "latest_post_date",
        "last_checked_at", unhealthy.alias("is_unhealthy"),
    ).orderBy("id")
