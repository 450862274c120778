"""The dead-letter table: adding failures, listing, counting, and set-based reprocessing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from inkwell.operators.skew import join_hot_keys
from inkwell.operators.upsert import present_keys
from inkwell.schemas import DEAD_LETTERS, column_names

SUMMARIZATION, INGESTION, GENERATION = "summarization", "ingestion", "generation"

# A stage's job: takes distinct post_reference values, returns (post_reference, error); NULL error is success.
StageJob = Callable[[DataFrame], DataFrame]


def dead_letter_rows(
    failed: DataFrame, reference: Column, stage: str, reason: Column, as_of: Column, identity: list[Column | str]
) -> DataFrame:
    """Failed rows in the layout of the dead-letter table, ready to append.

    ``identity`` are the columns of ``failed`` that tell its rows apart (such as source, fetch and position of a feed
    entry). They go into the id, so rows that fail alike in one run are letters of their own.
    """
    rows = failed.select(
        F.xxhash64(*identity, reference.cast("string"), F.lit(stage), reason, as_of).alias("id"),
        reference.cast("string").alias("post_reference"),
        F.lit(stage).alias("failure_stage"),
        reason.alias("failure_reason"),
        F.lit(0).alias("retry_count"),
        as_of.alias("created_at"),
        F.lit(None).cast("timestamp").alias("last_retry_at"),
        F.lit(False).alias("resolved"),
    )
    return rows.select(*column_names(DEAD_LETTERS))


def list_failures(dead_letters: DataFrame, stage: str | None = None, include_resolved: bool = False) -> DataFrame:
    """Entries newest first, by default the unresolved ones of all stages."""
    rows = dead_letters if include_resolved else dead_letters.filter(~F.col("resolved"))
    if stage:
        rows = rows.filter(F.col("failure_stage") == stage)
    return rows.orderBy(F.desc("created_at"), "id")


def failure_summary(dead_letters: DataFrame) -> DataFrame:
    """Unresolved entries per stage, and in all (the row without a stage)."""
    return (
        dead_letters.filter(~F.col("resolved"))
        .rollup("failure_stage")
        .agg(F.count(F.lit(1)).alias("unresolved"), F.grouping("failure_stage").cast("int").alias("is_total"))
    )


def numeric_reference(references: DataFrame) -> DataFrame:
    """Adds post_id, NULL where the reference is no whole number."""
    return references.withColumn("post_id", F.expr("try_cast(post_reference AS BIGINT)"))


def not_a_number() -> Column:
    return F.concat(F.lit("invalid literal for int() with base 10: '"), "post_reference", F.lit("'"))


def _found(table: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    return present_keys(table, [column], wanted).select(column, F.lit(True).alias("_found"))


def ingestion_job(posts: DataFrame) -> StageJob:
    """An ingestion failure is settled when its URL is among the posts by now; the feed itself is gone."""

    def run(references: DataFrame) -> DataFrame:
        urls = references.withColumn("url", F.col("post_reference"))
        joined = urls.join(_found(posts, "url", urls), "url", "left")
        missing = F.concat(F.lit("Post not found in raw_blog_posts for URL: "), "post_reference")
        return joined.select("post_reference", F.when(F.col("_found").isNull(), missing).alias("error"))

    return run


def generation_job(mart_posts: DataFrame) -> StageJob:
    """A note can be written again when its post is in the mart."""

    def run(references: DataFrame) -> DataFrame:
        numbered = numeric_reference(references).withColumn("id", F.col("post_id"))
        joined = numbered.join(_found(mart_posts, "id", numbered), "id", "left")
        missing = F.concat(F.lit("Post "), "post_id", F.lit(" not found in mart_posts"))
        error = F.when(F.col("post_id").isNull(), not_a_number()).when(F.col("_found").isNull(), missing)
        return joined.select("post_reference", error.alias("error"))

    return run


def unknown_stage(stage: Column) -> Column:
    return F.concat(F.lit("Unknown failure_stage: '"), stage, F.lit("'"))


def reprocess(dead_letters: DataFrame, jobs: dict[str, StageJob], stages: list[str] | None = None) -> DataFrame:
    """Outcomes (id, failure_stage, error) of one retry of the unresolved entries, all or of some stages.

    Each stage's job runs once over its distinct references, whatever the number of entries. An
    entry that fails has its error text here; it never stops the others.
    """
    open_rows = dead_letters.filter(~F.col("resolved"))
    if stages is not None:
        open_rows = open_rows.filter(F.col("failure_stage").isin(stages))
    open_rows = open_rows.select("id", "failure_stage", "post_reference")
    outcomes = []
    for stage, job in jobs.items():
        if stages is not None and stage not in stages:
            continue
        rows = open_rows.filter(F.col("failure_stage") == stage)
        counts = rows.groupBy("post_reference").count()
        results = job(counts.select("post_reference"))
        joined = join_hot_keys(rows, results, "post_reference", counts, "id")
        outcomes.append(joined.select("id", "failure_stage", "error"))
    strangers = open_rows.filter(~F.col("failure_stage").isin(list(jobs)))
    outcomes.append(strangers.select("id", "failure_stage", unknown_stage(F.col("failure_stage")).alias("error")))
    result = outcomes[0]
    for more in outcomes[1:]:
        result = result.unionByName(more)
    return result


def reprocess_counts(outcomes: DataFrame) -> DataFrame:
    """Attempted, succeeded and failed entries per stage."""
    return outcomes.groupBy("failure_stage").agg(
        F.count(F.lit(1)).alias("attempted"),
        F.count_if(F.col("error").isNull()).alias("succeeded"),
        F.count_if(F.col("error").isNotNull()).alias("failed"),
    )


def apply_outcomes(dead_letters: DataFrame, outcomes: DataFrame, as_of: Column) -> DataFrame:
    """The next snapshot of the table: every retried entry counts one more, is resolved or has a new reason.

    The table keeps its rows whatever the outcomes hold: several for one id count as one, which succeeded only if all did.
    """
    results = outcomes.groupBy("id").agg(F.max("error").alias("_error"), F.lit(True).alias("_tried"))
    tried, failed = F.coalesce("_tried", F.lit(False)), F.col("_error").isNotNull()
    return dead_letters.join(results, "id", "left").select(
        "id",
        "post_reference",
        "failure_stage",
        F.when(tried & failed, F.col("_error")).otherwise(F.col("failure_reason")).alias("failure_reason"),
        (F.col("retry_count") + F.when(tried, 1).otherwise(0)).cast("int").alias("retry_count"),
        "created_at",
        F.when(tried, as_of).otherwise(F.col("last_retry_at")).alias("last_retry_at"),
        (F.col("resolved") | (tried & ~failed)).alias("resolved"),
    )
