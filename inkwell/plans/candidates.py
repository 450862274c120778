"""Weekly newsletter candidates, for one issue or for many back-dated issues in one job."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from inkwell.functions import scoring
from inkwell.sources.tables import CANDIDATE_COLUMNS


def _eligible(mart_posts: DataFrame, mart_sources: DataFrame) -> DataFrame:
    rated = mart_sources.filter("status = 'active' and quality_rating is not null").select(
        F.col("id").alias("source_id"), "quality_rating"
    )
    posts = mart_posts.filter("summary_text is not null").select(
        F.col("id").alias("post_id"), "source_id", "title", "summary_text", "tags", "difficulty_classification",
        "author_name", "source_name", "category", "publication_date", "url",
    )
    return posts.join(rated, "source_id")


def _rank_in_category(posts: DataFrame, as_of: Column, issue: list[str]) -> DataFrame:
    """Keeps the best few per category. The cap is a group limit that runs before the shuffle, too,
    so a category with very many posts sends a handful per task."""
    scored = posts.withColumn(
        "_score", scoring.quality_recency(F.col("quality_rating"), F.col("publication_date"), as_of)
    )
    order = Window.partitionBy(*issue, "category").orderBy(F.desc("_score"), "post_id")
    return (
        scored.withColumn("category_rank", F.row_number().over(order))
        .filter(F.col("category_rank") <= scoring.PER_CATEGORY)
        .withColumn("rank_score", F.round(F.col("_score") + scoring.diversity(F.col("category_rank")), 4))
    )


def newsletter_candidates(mart_posts: DataFrame, mart_sources: DataFrame, as_of: Column) -> DataFrame:
    """The issue's top posts: past week, active rated sources, summarised; five per category, twenty in all.

    Scores are not clamped: ratings above five and dates after ``as_of`` can lift them over 1. Ties
    go to the lower post id.
    """
    oldest = F.date_sub(as_of.cast("date"), scoring.WINDOW_DAYS)
    weekly = _eligible(mart_posts, mart_sources).filter(F.col("publication_date") >= oldest)
    best = _rank_in_category(weekly, as_of, [])
    return best.select(*CANDIDATE_COLUMNS).orderBy(F.desc("rank_score"), "post_id").limit(scoring.PER_ISSUE)


def issue_candidates(mart_posts: DataFrame, mart_sources: DataFrame, issues: list[datetime]) -> DataFrame:
    """Candidates of every issue in ``issues`` (one time per issue), as one job.

    A post belongs to the issues whose week contains its date; posts dated after an issue are left
    to later issues. The weeks are spelled out by day, so the join is an equi-join on the date
    against a table of eight rows per issue.
    """
    times = F.array(*[F.lit(t.isoformat(sep=" ")).cast("timestamp") for t in issues])
    week = F.sequence(F.date_sub(F.col("issue_at").cast("date"), scoring.WINDOW_DAYS), F.col("issue_at").cast("date"))
    days = (
        mart_posts.sparkSession.range(1).select(F.explode(times).alias("issue_at"))
        .select("issue_at", F.explode(week).alias("publication_date"))
    )
    weekly = _eligible(mart_posts, mart_sources).join(F.broadcast(days), "publication_date")
    best = _rank_in_category(weekly, F.col("issue_at"), ["issue_at"])
    nth = F.row_number().over(Window.partitionBy("issue_at").orderBy(F.desc("rank_score"), "post_id"))
    return (
        best.withColumn("issue_rank", nth)
        .filter(F.col("issue_rank") <= scoring.PER_ISSUE)
        .select("issue_at", "issue_rank", *CANDIDATE_COLUMNS)
    )
