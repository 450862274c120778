"""Staging models: cleaned posts, author profiles, validated summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from inkwell.functions.text import initcap_words, or_default, preview_slug


def stg_posts(posts: DataFrame, sources: DataFrame) -> DataFrame:
    """Posts with trimmed text, plain dates, a preview slug and their source's name and category.

    The source side carries no broadcast hint: Spark broadcasts it while its size is under the
    session's limit and shuffles (with AQE splitting hot sources) beyond that.
    """
    lookup = sources.select(F.col("id").alias("source_id"), F.col("name").alias("source_name"), "category")
    return posts.join(lookup, "source_id", "left").select(
        "id",
        "source_id",
        "source_name",
        "category",
        F.trim("title").alias("title"),
        F.trim("body").alias("body"),
        "url",
        or_default(F.trim("author_name"), "Unknown").alias("author_name"),
        F.col("publication_date").cast("date").alias("publication_date"),
        preview_slug("title").alias("post_slug"),
        "created_at",
    )


def stg_authors(posts: DataFrame) -> DataFrame:
    """One row per normalised author name. Counts, dates and the set of sources combine before the shuffle."""
    named = posts.filter(F.col("author_name").isNotNull() & (F.trim("author_name") != ""))
    normal = named.select(F.trim(initcap_words("author_name")).alias("author_name"), "source_id", "publication_date")
    return normal.groupBy("author_name").agg(
        F.md5("author_name").alias("author_id"),
        F.count(F.lit(1)).alias("post_count"),
        F.array_sort(F.collect_set("source_id")).alias("source_ids"),
        F.min("publication_date").alias("first_seen_at"),
        F.max("publication_date").alias("last_seen_at"),
    ).select("author_id", "author_name", "post_count", "source_ids", "first_seen_at", "last_seen_at")


def stg_summaries(summaries: DataFrame) -> DataFrame:
    """Summaries without the raw response, flagged when they are short or carry no tags."""
    low = (
        F.when(F.col("tags").isNull(), True)
        .when(F.length("summary_text") < 50, True)
        .when(F.size("tags") == 0, True)
        .otherwise(False)
    )
    return summaries.select(
        "id", "post_id", "summary_text", "tags", "difficulty_classification", low.alias("is_low_quality"), "created_at"
    )
