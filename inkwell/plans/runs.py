"""The scheduled runs, put together from the operators: daily, weekly, and retries of failures.

Each step's result is written below ``out_dir`` (a folder all executors share) before the next step
reads it. Nothing is overwritten: new rows and new snapshots go to new folders.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from inkwell.operators import dead_letters, expectations, ingest, newsletter, note_checks, notes, source_admin, summaries
from inkwell.plans import candidates, marts, staging
from inkwell.plans.materialize import write_tables
from inkwell.sources import feeds as feed_source
from inkwell.sources import tables as scans


class Store(NamedTuple):
    """The four raw tables."""

    sources: DataFrame
    posts: DataFrame
    summaries: DataFrame
    dead_letters: DataFrame


class Run(NamedTuple):
    store: Store  # the raw tables after the run
    written: dict[str, DataFrame]  # every table the run wrote, by folder name
    report: DataFrame  # one row of counts


class ChecksFailed(RuntimeError):
    """A data-quality check failed, so nothing after it ran. ``run`` has what was done and written until then."""

    def __init__(self, run: Run, failed: int) -> None:
        super().__init__(f"{failed} data-quality checks failed; see the table 'quality' of the run")
        self.run = run


def build_models(store: Store) -> dict[str, DataFrame]:
    """Staging models over the raw tables, as views would be."""
    return {
        "stg_posts": staging.stg_posts(store.posts, store.sources),
        "stg_authors": staging.stg_authors(store.posts),
        "stg_summaries": staging.stg_summaries(store.summaries),
    }


def build_marts(store: Store, out_dir: str) -> dict[str, DataFrame]:
    """Mart models as tables below ``out_dir``."""
    models = build_models(store)
    return write_tables(
        {
            "mart_posts": marts.mart_posts(models["stg_posts"], models["stg_summaries"], models["stg_authors"]),
            "mart_authors": marts.mart_authors(models["stg_authors"], models["stg_posts"]),
            "mart_sources": marts.mart_sources(store.sources, models["stg_posts"]),
        },
        out_dir,
    )


def run_daily(
    store: Store,
    feeds: DataFrame,
    out_dir: str,
    as_of: Column,
    summarize_with: Callable[[str], str] | None = None,
    published_notes: DataFrame | None = None,
    published_fingerprints: DataFrame | None = None,
    max_age_days: int | None = None,
    max_concurrent: int = summaries.DEFAULT_CONCURRENCY,
    stop_on_failed_checks: bool = True,
) -> Run:
    """Feeds of active sources to posts, summaries, marts, checks and notes.

    Raises :class:`ChecksFailed` before any note is rendered if a data-quality check has violations, unless
    ``stop_on_failed_checks`` is off. With the ``published_notes`` of an earlier run and their ``published_fingerprints``
    (its table ``note_fingerprints``) only notes whose inputs changed are rendered. ``max_age_days`` limits the entries, as for the first feed of a new source. Without
    ``summarize_with`` posts stay unsummarised.
    """
    active = scans.active_sources(store.sources)
    active_feeds = feeds.join(active.select(F.col("id").alias("source_id")), "source_id", "left_semi")
    parsed = feed_source.parse_feeds(active_feeds, as_of)
    written = write_tables({"entries": ingest.numbered(parsed.entries)}, out_dir)
    entries = written["entries"]
    if max_age_days is not None:
        entries = ingest.recent_entries(entries, as_of, max_age_days)
    ingested = ingest.ingest_posts(entries, store.posts, feed_source.arrival_order(), as_of)
    written |= write_tables({"new_posts": ingested.inserted}, out_dir)
    posts = store.posts.unionByName(written["new_posts"])
    metrics = ingest.ingest_metrics(entries, written["new_posts"])

    failures = [parsed.failures, ingested.failures]
    all_summaries = store.summaries
    if summarize_with is not None:
        todo = summaries.unsummarized_posts(posts, store.summaries, ordered=False)
        attempts = summaries.summarize(todo, summarize_with, max_concurrent)
        stored = summaries.store_summaries(attempts, store.summaries, as_of)
        written |= write_tables({"new_summaries": stored.inserted, "summary_outcomes": stored.outcomes}, out_dir)
        all_summaries = store.summaries.unionByName(written["new_summaries"])
        failures.append(stored.failures)
    new_failures = failures[0]
    for more in failures[1:]:
        new_failures = new_failures.unionByName(more)
    # a run that is repeated over the same feeds at the same time makes the same letters
    new_failures = new_failures.join(store.dead_letters.select("id"), "id", "left_anti").select(*store.dead_letters.columns)
    sources = source_admin.touch_last_checked(store.sources, active.select("id"), as_of)
    written |= write_tables({"new_dead_letters": new_failures, "sources": sources}, out_dir)
    after = Store(
        written["sources"], posts, all_summaries, store.dead_letters.unionByName(written["new_dead_letters"])
    )

    written |= build_marts(after, out_dir)
    issue = candidates.newsletter_candidates(written["mart_posts"], written["mart_sources"], as_of)
    written |= write_tables({"mart_newsletter_candidates": issue}, out_dir)
    checked = {"raw_blog_posts": posts, "dead_letter_posts": after.dead_letters, **build_models(after), **written}
    written |= write_tables({"quality": expectations.run_expectations(checked)}, out_dir)
    if stop_on_failed_checks and not expectations.all_passed(written["quality"]):
        failed = written["quality"].filter(~F.col("passed")).count()
        raise ChecksFailed(Run(after, written, _report(written, metrics, active, active_feeds)), failed)

    models = notes.Marts(written["mart_posts"], written["mart_sources"], written["mart_authors"])
    written |= write_tables({"note_fingerprints": notes.note_fingerprints(models)}, out_dir)
    if published_notes is not None and published_fingerprints is not None:
        found = notes.note_changes(
            models, published_fingerprints, lambda some: published_notes.join(some.select("path"), "path", "left_semi"),
            written["note_fingerprints"])
        written |= write_tables({"note_changes": found.changes}, out_dir)
        kept = written["note_changes"].filter("change = 'unchanged'").join(found.rendered.select("path"), "path", "left_anti")
        rendered = found.rendered.unionByName(
            published_notes.join(kept.select("path"), "path", "left_semi").select(*found.rendered.columns))
    else:
        rendered = notes.all_notes(*models)
    notes.write_notes(rendered, f"{out_dir}/notes")
    written["notes"] = rendered.sparkSession.read.schema(rendered.schema).parquet(f"{out_dir}/notes")
    check = note_checks.check_notes(written["notes"])
    written |= write_tables({"note_failures": check.failures, "note_results": check.results}, out_dir)
    if published_notes is not None and "note_changes" not in written:
        written |= write_tables({"note_changes": notes.changed_notes(written["notes"], published_notes)}, out_dir)
    return Run(after, written, _report(written, metrics, active, active_feeds))


def _report(written: dict[str, DataFrame], metrics: DataFrame, active: DataFrame, feeds: DataFrame) -> DataFrame:
    """All counts of the run as one row; each part has one row itself. A run that was stopped has no counts of notes."""
    parts = [
        ingest.run_metrics(metrics, active, feeds),
        written["quality"].agg(F.count_if(~F.col("passed")).alias("checks_failed")),
        written["new_dead_letters"].agg(F.count(F.lit(1)).alias("new_dead_letters")),
    ]
    if "note_results" in written:
        parts.append(note_checks.check_summary(written["note_results"]).select(
            F.col("total").alias("notes"), F.col("passed").alias("notes_passed"), F.col("failed").alias("notes_failed")
        ))
    if "summary_outcomes" in written:
        parts.append(summaries.processing_result(written["summary_outcomes"]))
    return _side_by_side(parts)


def _side_by_side(parts: list[DataFrame]) -> DataFrame:
    """One-row frames as one row: each fills its own columns of a union, which one aggregation folds."""
    names = [c for part in parts for c in part.columns]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return rows.agg(*[F.max(c).alias(c) for c in names])


def run_weekly(mart_posts: DataFrame, mart_sources: DataFrame, out_dir: str, as_of: Column) -> dict[str, DataFrame]:
    """The week's candidates and their newsletter; no document when nothing qualifies."""
    issue = candidates.newsletter_candidates(mart_posts, mart_sources, as_of)
    written = write_tables({"candidates": issue}, out_dir)
    document = newsletter.newsletters(written["candidates"].withColumn("issue_at", as_of))
    newsletter.write_newsletters(document, f"{out_dir}/newsletter")
    stored = document.sparkSession.read.schema(document.schema).parquet(f"{out_dir}/newsletter")
    return written | {"newsletter": stored.select(*document.columns)}


def run_retry(
    store: Store,
    mart_posts: DataFrame,
    out_dir: str,
    as_of: Column,
    summarize_with: Callable[[str], str],
    stages: list[str] | None = None,
) -> Run:
    """Retries unresolved dead letters, all or of some stages, and keeps the summaries this yields."""
    made: list[DataFrame] = []

    def attempt(rows: DataFrame) -> DataFrame:
        made.append(summaries.summarize(rows, summarize_with))
        return made[0]

    jobs = {
        dead_letters.INGESTION: dead_letters.ingestion_job(store.posts),
        dead_letters.GENERATION: dead_letters.generation_job(mart_posts),
        dead_letters.SUMMARIZATION: summaries.summarization_job(store.posts, store.summaries, attempt),
    }
    written = write_tables({"outcomes": dead_letters.reprocess(store.dead_letters, jobs, stages)}, out_dir)
    letters = dead_letters.apply_outcomes(store.dead_letters, written["outcomes"], as_of)
    written |= write_tables({"dead_letters": letters}, out_dir)
    known = store.summaries
    if made:
        stored = summaries.store_summaries(made[0], store.summaries, as_of)
        written |= write_tables({"new_summaries": stored.inserted}, out_dir)
        known = known.unionByName(written["new_summaries"])
    after = Store(store.sources, store.posts, known, written["dead_letters"])
    return Run(after, written, dead_letters.reprocess_counts(written["outcomes"]))
