"""Reads of the raw and mart tables with their fixed columns and orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from inkwell.schemas import BLOG_SOURCES, column_names


def active_sources(sources: DataFrame) -> DataFrame:
    return sources.filter("status = 'active'").select(*column_names(BLOG_SOURCES)).orderBy("id")


def source_by_id(sources: DataFrame, source_id: int) -> DataFrame:
    """The source with this id, or no row."""
    return sources.filter(F.col("id") == source_id).select(*column_names(BLOG_SOURCES))


POST_COLUMNS = [
    "id", "source_id", "source_name", "category", "title", "url", "author_name", "author_id", "publication_date",
    "summary_text", "tags", "difficulty_classification",
]


def posts_for_notes(mart_posts: DataFrame) -> DataFrame:
    """Newest first; undated posts lead, as they do in the warehouse."""
    return mart_posts.select(*POST_COLUMNS).orderBy(F.desc_nulls_first("publication_date"), "id")


def sources_for_notes(mart_sources: DataFrame) -> DataFrame:
    return mart_sources.select(
        "id", "name", "category", "rss_feed_url", "status", "last_checked_at", "total_post_count", "latest_post_date"
    ).orderBy(F.asc_nulls_last("name"), "id")


def authors_for_notes(mart_authors: DataFrame) -> DataFrame:
    return mart_authors.select(
        "author_id", "author_name", "post_count", "source_ids", "first_seen_at", "last_seen_at", "primary_category"
    ).orderBy(F.asc_nulls_last("author_name"))


CANDIDATE_COLUMNS = [
    "post_id", "title", "summary_text", "tags", "difficulty_classification", "author_name", "source_name", "category",
    "quality_rating", "publication_date", "url", "rank_score", "category_rank",
]


def ranked_candidates(candidates: DataFrame) -> DataFrame:
    """Best first, with an empty list in place of missing tags."""
    tags = F.coalesce("tags", F.array().cast("array<string>"))
    return candidates.select(*CANDIDATE_COLUMNS).withColumn("tags", tags).orderBy(F.desc("rank_score"), "post_id")
