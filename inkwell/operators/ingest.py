"""Ingestion of feed entries: validity, insert-if-absent by URL, failures, metrics, age filter."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from inkwell.operators.dead_letters import INGESTION, dead_letter_rows
from inkwell.operators.upsert import insert_wide_if_absent
from inkwell.schemas import BLOG_POSTS, column_names
from inkwell.session import cut_lineage

ROW_ID = "entry_row"
REQUIRED = ("title", "body", "url", "author_name")


class Ingested(NamedTuple):
    inserted: DataFrame  # rows to append to the posts table
    failures: DataFrame  # rows to append to the dead-letter table
    metrics: DataFrame  # source_id, success_count, duplicate_count, failure_count


def _missing() -> Column:
    """The first required column that is NULL, or NULL."""
    return F.coalesce(*[F.when(F.col(c).isNull(), F.lit(c)) for c in REQUIRED])


def numbered(entries: DataFrame) -> DataFrame:
    """The entries with a column ROW_ID that tells them apart, as a written table gives the same one each time."""
    return entries.withColumn(ROW_ID, F.monotonically_increasing_id())


def ingest_posts(entries: DataFrame, posts: DataFrame, arrival: list[Column], as_of: Column) -> Ingested:
    """Entries whose URL is new, once each: the first by ``arrival``. Post ids are hashes of the URL,
    so a repeated task or run makes the same rows.

    Bodies are neither sorted nor shuffled to find the new entries. This needs a ROW_ID that stays; entries without one
    are numbered and written to the shared folder first. Of entries that are alike in URL and arrival any one is taken.
    """
    if ROW_ID not in entries.columns:
        entries = cut_lineage(numbered(entries))
    valid = entries.filter(_missing().isNull())
    inserted = (
        insert_wide_if_absent(valid, posts, ["url"], arrival, ROW_ID)
        .withColumn("id", F.xxhash64("url"))
        .withColumn("created_at", as_of)
        .select(*column_names(BLOG_POSTS))
    )
    failed = entries.withColumn("_missing", _missing()).filter("_missing is not null")
    reason = F.concat(
        F.lit("Insert failed for source "), F.col("source_id"), F.lit(": null value in column "), F.col("_missing")
    )
    failures = dead_letter_rows(failed, F.coalesce("url", F.lit("unknown")), INGESTION, reason, as_of, arrival)
    return Ingested(inserted, failures, ingest_metrics(entries, inserted))


def ingest_metrics(entries: DataFrame, inserted: DataFrame) -> DataFrame:
    """Inserted, duplicate and failed entries per source; the three add up to the entries."""
    seen = entries.groupBy("source_id").agg(
        F.count_if(_missing().isNull()).alias("_valid"), F.count_if(_missing().isNotNull()).alias("failure_count")
    )
    added = inserted.groupBy("source_id").agg(F.count(F.lit(1)).alias("_added"))
    success = F.coalesce("_added", F.lit(0).cast("long"))
    return seen.join(added, "source_id", "left").select(
        "source_id",
        success.alias("success_count"),
        (F.col("_valid") - success).alias("duplicate_count"),
        "failure_count",
    )


def run_metrics(metrics: DataFrame, sources: DataFrame, feeds: DataFrame) -> DataFrame:
    """One row for the whole run. A source counts as processed when it has a feed row (even an unreadable
    one) and as failed when its step left none."""
    fetched = feeds.select(F.col("source_id").alias("id")).distinct().withColumn("_fetched", F.lit(True))
    steps = (
        sources.select("id").join(fetched, "id", "left")
        .join(metrics.withColumnRenamed("source_id", "id"), "id", "left")
    )

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0).cast("long"))

    return steps.agg(
        total("success_count").alias("total_success"),
        total("duplicate_count").alias("total_duplicates"),
        total("failure_count").alias("total_failures"),
        F.count_if(F.col("_fetched").isNotNull()).alias("sources_processed"),
        F.count_if(F.col("_fetched").isNull()).alias("sources_failed"),
    )


def _recent(as_of: Column, max_age_days: int) -> Column:
    cutoff = F.timestamp_seconds(F.unix_timestamp(as_of) - F.lit(max_age_days * 86400))
    return F.col("publication_date").isNull() | (F.col("publication_date") >= cutoff)


def recent_entries(entries: DataFrame, as_of: Column, max_age_days: int = 30) -> DataFrame:
    """Entries up to ``max_age_days`` old; entries without a date are kept."""
    return entries.filter(_recent(as_of, max_age_days))


def age_filter_counts(entries: DataFrame, as_of: Column, max_age_days: int = 30) -> DataFrame:
    """Parsed, kept and filtered entries per source."""
    kept = F.count_if(_recent(as_of, max_age_days))
    return entries.groupBy("source_id").agg(
        F.count(F.lit(1)).alias("total_parsed"),
        kept.alias("kept_count"),
        (F.count(F.lit(1)) - kept).alias("filtered_count"),
    )
