"""Changes to the list of sources: seeding, adding, activating, updating, check times."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from inkwell.functions.text import is_blank
from inkwell.operators.upsert import apply_changes, insert_if_absent
from inkwell.schemas import BLOG_SOURCES, column_names

UPDATABLE = {"rss_feed_url", "name", "category", "quality_rating"}
MIN_RATING, MAX_RATING = 1, 10


class Changed(NamedTuple):
    table: DataFrame  # new rows (adding) or the whole next snapshot (updating)
    outcomes: DataFrame  # one row per request


def _as_sources(rows: DataFrame, as_of: Column) -> DataFrame:
    """Rows completed to the sources table. Ids are hashes of the feed URL."""
    return rows.select(
        F.xxhash64("rss_feed_url").alias("id"), "rss_feed_url", "name", "category",
        F.col("quality_rating").cast("int").alias("quality_rating"),
        F.lit("active").alias("status"),
        F.lit(None).cast("timestamp").alias("last_checked_at"),
        as_of.alias("created_at"),
        as_of.alias("updated_at"),
    ).select(*column_names(BLOG_SOURCES))


def seed_sources(seed: DataFrame, sources: DataFrame, order: list[Column], as_of: Column) -> DataFrame:
    """The seed rows to append: first per feed URL, URL not known yet."""
    return _as_sources(insert_if_absent(seed, sources, ["rss_feed_url"], order), as_of)


def seed_metrics(seed: DataFrame, inserted: DataFrame) -> DataFrame:
    """inserted, skipped and total of one seed run."""
    counts = seed.select(F.lit(False).alias("added")).unionAll(inserted.select(F.lit(True)))
    added, total = F.count_if("added"), F.count_if(~F.col("added"))
    return counts.agg(added.alias("inserted"), (total - added).alias("skipped"), total.alias("total"))


def _bad_rating() -> Column:
    whole = F.col("quality_rating").cast("double") == F.floor(F.col("quality_rating").cast("double"))
    return ~F.coalesce(whole & F.col("quality_rating").between(MIN_RATING, MAX_RATING), F.lit(False))


def add_sources(requests: DataFrame, sources: DataFrame, request_id: str, as_of: Column) -> Changed:
    """Adds the valid requests with a new feed URL, in the order of ``request_id``.

    Each request ends as inserted, skipped (duplicate) or rejected with the first rule it breaks. Rows that repeat a
    request id are requests of their own.
    """
    blanks = [(F.col(c), c) for c in ("rss_feed_url", "name", "category")]
    broken = F.coalesce(
        *[F.when(is_blank(column), F.lit(f"{name} must not be empty")) for column, name in blanks],
        F.when(_bad_rating(), F.lit(f"quality_rating must be an integer between {MIN_RATING} and {MAX_RATING}")),
    )
    copies = Window.partitionBy(request_id, "rss_feed_url").orderBy(*requests.columns)
    checked = requests.withColumn("_broken", broken).withColumn("_copy", F.row_number().over(copies))
    request = [request_id, "rss_feed_url", "_copy"]
    winners = insert_if_absent(
        checked.filter("_broken is null").drop("_broken"), sources, ["rss_feed_url"], [F.col(request_id), F.col("_copy")]
    )
    marked = checked.join(winners.select(*request, F.lit(True).alias("_won")), request, "left")
    action = F.when(F.col("_broken").isNotNull(), "rejected").when(F.col("_won"), "inserted").otherwise("skipped")
    outcomes = marked.select(
        request_id,
        action.alias("action"),
        F.when(F.col("_won"), F.xxhash64("rss_feed_url")).alias("source_id"),
        F.coalesce("_broken", F.when(F.col("_won").isNull(), F.lit("duplicate"))).alias("reason"),
    )
    return Changed(_as_sources(winners, as_of), outcomes)


def _outcomes(changes: DataFrame, sources: DataFrame, done: str) -> DataFrame:
    known = sources.select("id", F.lit(True).alias("_known"))
    action = F.when(F.col("_known"), done).otherwise("not_found")
    return changes.join(known, "id", "left").select(*changes.columns, action.alias("action"))


def set_status(sources: DataFrame, ids: DataFrame, active: bool, as_of: Column) -> Changed:
    """Activates or deactivates the sources in ``ids`` (column id)."""
    changes = ids.select("id").distinct().withColumn("status", F.lit("active" if active else "inactive"))
    table = apply_changes(sources, changes, "id", {"status"}, {"updated_at": as_of})
    return Changed(table, _outcomes(changes.select("id"), sources, "activated" if active else "deactivated"))


def update_sources(sources: DataFrame, changes: DataFrame, as_of: Column, request_id: str | None = None) -> Changed:
    """Sets the non-NULL columns of ``changes``, in the order of the column ``request_id`` if there is one.

    An id may have several changes; each is judged by itself. Blank text and ratings out of range reject the change;
    columns that may not be updated raise.
    """
    names = ["id"] if request_id is None else [request_id, "id"]
    fields = [c for c in changes.columns if c not in names]
    rules = []
    for name in fields:
        given = F.col(name).isNotNull()
        if name == "quality_rating":
            rule = f"quality_rating must be an integer between {MIN_RATING} and {MAX_RATING}"
            rules.append(F.when(given & _bad_rating(), F.lit(rule)))
        else:
            rules.append(F.when(given & is_blank(name), F.lit(f"Empty value for field: {name}")))
    nothing = F.when(F.coalesce(*[F.col(c).cast("string") for c in fields]).isNull(), F.lit("No fields provided to update"))
    checked = changes.withColumn("_broken", F.coalesce(*rules, nothing))
    accepted = checked.filter("_broken is null").drop("_broken")
    table = apply_changes(sources, accepted, "id", UPDATABLE, {"updated_at": as_of}, request_id)
    rejected = checked.filter("_broken is not null").select(
        *names, F.lit("rejected").alias("action"), F.col("_broken").alias("reason")
    )
    done = _outcomes(accepted.select(*names), sources, "updated").withColumn("reason", F.lit(None).cast("string"))
    return Changed(table, done.unionByName(rejected))


def touch_last_checked(sources: DataFrame, ids: DataFrame, as_of: Column) -> DataFrame:
    """The next snapshot with the check time of the sources in ``ids`` set."""
    changes = ids.select("id").distinct().withColumn("last_checked_at", as_of)
    return apply_changes(sources, changes, "id", {"last_checked_at"}, {"updated_at": as_of})
