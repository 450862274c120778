"""The source list that ships as a CSV file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from inkwell.functions.text import strip
from inkwell.schemas import SEED_CSV


def read_source_seed(spark: SparkSession, path: str) -> DataFrame:
    """Seed rows ready for the sources table; a missing path raises. Malformed ratings fail the read."""
    rows = spark.read.schema(SEED_CSV).option("header", True).option("mode", "FAILFAST").csv(path)
    return rows.select(
        strip("rss_feed_url").alias("rss_feed_url"),
        strip("name").alias("name"),
        strip("category").alias("category"),
        "quality_rating",
        F.lit("active").alias("status"),
    )
