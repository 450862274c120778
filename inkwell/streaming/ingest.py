"""Incremental ingestion: every new batch of entries goes through the same insert-if-absent.

The posts table is a folder per URL bucket, and in it a folder per batch. A URL always falls into the same bucket, so a
batch is compared with the folders of its own buckets only; the others are not even listed.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from inkwell.operators.ingest import ingest_posts, numbered, recent_entries
from inkwell.schemas import BLOG_POSTS, DEAD_LETTERS, column_names
from inkwell.session import cut_lineage

BATCH, BUCKET = "batch_id", "bucket"
BUCKETS = 64
LAYOUT = "_layout"  # beside the buckets; readers of the table pass over names that begin with an underscore


def url_bucket(url: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(buckets)).cast("int")


def bucket_count(spark: SparkSession, path: str) -> int:
    return spark.read.schema("buckets INT").parquet(f"{path}/{LAYOUT}").first()["buckets"]


def read_posts(spark: SparkSession, path: str, buckets: Iterable[int] | None = None) -> DataFrame:
    """The posts written so far, with the number of the batch that brought them; of some buckets or of all."""
    reader = spark.read.schema(f"{BLOG_POSTS}, {BUCKET} INT, {BATCH} BIGINT").option("basePath", path)
    if buckets is None:
        return reader.parquet(path)
    # a bucket without posts has no folder, so it is named by a pattern; buckets in a pattern are listed as one path
    numbers = ",".join(str(b) for b in sorted(buckets)) or "none"
    try:
        return reader.parquet(f"{path}/{BUCKET}={{{numbers}}}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], reader.parquet(path).schema)


def read_failures(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{DEAD_LETTERS}, {BATCH} BIGINT").parquet(path)


def _write_buckets(posts: DataFrame, path: str) -> None:
    """Replaces the folders (bucket, batch) that the rows fall into and leaves all others."""
    posts.write.mode("overwrite").partitionBy(BUCKET, BATCH).option("partitionOverwriteMode", "dynamic").parquet(path)


def create_tables(
    spark: SparkSession, posts: DataFrame, posts_path: str, dead_letters_path: str, buckets: int = BUCKETS
) -> None:
    """Writes the posts that exist already as batch -1, and an empty dead-letter table.

    A batch reads at most as many buckets as it has entries, so a table that gets small batches should have many.
    """
    spark.createDataFrame([(buckets,)], "buckets INT").coalesce(1).write.mode("errorifexists").parquet(f"{posts_path}/{LAYOUT}")
    _write_buckets(
        posts.select(*column_names(BLOG_POSTS), url_bucket(F.col("url"), buckets).alias(BUCKET), F.lit(-1).cast("bigint").alias(BATCH))
        .repartitionByRange(BUCKET, "url"), posts_path)
    nothing = spark.createDataFrame([], DEAD_LETTERS)
    nothing.write.mode("errorifexists").parquet(f"{dead_letters_path}/{BATCH}=-1")


def merge_batches(spark: SparkSession, posts_path: str, merged_path: str) -> None:
    """Copies the table to a new folder with one folder per bucket instead of one per bucket and batch.

    The last batch keeps its own folders, since a stream that stopped in it will repeat it. Start the stream again with
    ``merged_path`` and the same checkpoint; nothing is changed in ``posts_path``.
    """
    posts = read_posts(spark, posts_path)
    last = posts.agg(F.max(BATCH)).first()[0]
    spark.createDataFrame([(bucket_count(spark, posts_path),)], "buckets INT").coalesce(1).write.mode("errorifexists").parquet(
        f"{merged_path}/{LAYOUT}")
    _write_buckets(
        posts.withColumn(BATCH, F.when(F.col(BATCH) == last, F.col(BATCH)).otherwise(-1)).repartitionByRange(BUCKET, "url"),
        merged_path)


def start_ingest(
    entries: DataFrame,
    posts_path: str,
    dead_letters_path: str,
    checkpoint: str,
    arrival: list[Column],
    as_of: Column | None = None,
    max_age_days: int | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Starts a query that adds new posts and failures for each micro-batch of ``entries``.

    URLs are checked against the posts table itself, so a URL is never forgotten and no state grows.
    Every batch writes folders of its own and is compared with the other batches only; one that runs
    again after a failure replaces what it left. ``max_age_days`` leaves out old entries; undated ones
    pass. ``trigger`` goes to the writer, by default what is available now.
    """

    def append(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        now = F.current_timestamp() if as_of is None else as_of
        rows = batch if max_age_days is None else recent_entries(batch, now, max_age_days)
        buckets = bucket_count(spark, posts_path)
        # read several times: for the buckets, the first row per URL, the known URLs, the new rows and the failures
        rows = cut_lineage(numbered(rows).withColumn(BUCKET, url_bucket(F.col("url"), buckets)))
        touched = [r[BUCKET] for r in rows.filter("url is not null").select(BUCKET).distinct().collect()]
        others = read_posts(spark, posts_path, touched).filter(F.col(BATCH) != number)
        result = ingest_posts(rows.drop(BUCKET), others, arrival, now)
        _write_buckets(
            result.inserted.withColumn(BUCKET, url_bucket(F.col("url"), buckets)).withColumn(BATCH, F.lit(number).cast("bigint")),
            posts_path)
        result.failures.write.mode("overwrite").parquet(f"{dead_letters_path}/{BATCH}={number}")

    writer = entries.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
