"""File slugs and paths of notes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from inkwell.functions.text import hashed_slug, title_slug
from inkwell.operators.upsert import first_per_key
from inkwell.session import cut_lineage


def post_slugs(posts: DataFrame) -> DataFrame:
    """Adds slug and path to posts (id, title, category). Titles whose plain slug occurs more than once
    over all posts, whatever their category, get a hash suffix.

    Slugs and folders are made once and written with the rows, so ``posts`` should have no columns that are not needed.
    They are counted with map-side combining; the join back meets one row per shared slug, and Spark splits the
    partition of a slug that very many posts have.
    """
    based = posts.withColumn("_base", title_slug("title")).withColumn("_folder", title_slug("category"))
    based = cut_lineage(based)
    shared = based.select("_base").groupBy("_base").count().filter("count > 1")
    marked = based.join(shared.select("_base", F.lit(True).alias("_shared")), "_base", "left")
    slug = F.when(F.col("_shared"), hashed_slug("title")).otherwise(F.col("_base"))
    path = F.concat(F.lit("posts/"), F.col("_folder"), F.lit("/"), F.col("slug"), F.lit(".md"))
    return marked.withColumn("slug", slug).withColumn("path", path).select(*posts.columns, "slug", "path")


def flat_slugs(rows: DataFrame, name: str, folder: str) -> DataFrame:
    """Adds slug and path to sources or authors; there is no suffix for equal slugs."""
    slugged = rows.withColumn("slug", title_slug(name))
    return slugged.withColumn("path", F.concat(F.lit(f"{folder}/"), F.col("slug"), F.lit(".md")))


def last_writer(rows: DataFrame, written_last_first: list[Column]) -> DataFrame:
    """Rows that share a path leave one file: the one written last."""
    return first_per_key(rows, ["path"], written_last_first)


def overwritten(rows: DataFrame) -> DataFrame:
    """Paths written more than once, with the number of rows that were overwritten."""
    return (
        rows.groupBy("path").agg((F.count(F.lit(1)) - 1).alias("overwritten")).filter("overwritten > 0")
    )
