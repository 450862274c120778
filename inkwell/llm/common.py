"""Helpers the operators share: tables in the shared folder, Arrow batches of bounded size, reading the inputs."""

from __future__ import annotations

import ctypes
import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from inkwell.session import run_dir


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def keep_table(df: DataFrame, name: str) -> DataFrame:
    """Writes the rows below the shared checkpoint folder and reads them back: lineage ends here, and a lost
    executor costs later steps a reread instead of a recomputation."""
    path = run_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def give_back_memory() -> None:
    """Returns freed memory of an idle Python worker to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def map_arrow(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | Iterator[pa.RecordBatch]],
              schema: str, rows: int = 512) -> DataFrame:
    """``function`` on slices of at most ``rows`` rows; memory in a task does not grow with its partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                made = function(batch.slice(start, rows))
                if isinstance(made, pa.RecordBatch):
                    yield made
                else:
                    yield from made
        give_back_memory()

    return df.mapInArrow(run, schema)


def held_out(key: Column | str) -> Column:
    """True for the rows that no model may learn from: crc32(key as text) mod 3 is 1. A null key counts as ''."""
    text = (F.col(key) if isinstance(key, str) else key).cast("string")
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary")) % 3 == 1


def in_sample(share: float, key: Column, *more: Column) -> Column:
    """True for about ``share`` of the rows, by hashes of ``key`` and, where it is null, of the other columns; those also
    give the last digits, so that no share, however small, comes out as none of all rows."""
    text = key.cast("string")
    coarse = F.pmod(F.xxhash64(F.coalesce(text, *more)), F.lit(1_000_000))
    fine = F.pmod(F.xxhash64(F.lit("fine"), text, *more), F.lit(1 << 40)) / (1 << 40)
    return coarse + fine < share * 1_000_000


def bits_for(rows: int, per_bucket: int, most: int = 24) -> int:
    """Bits of a hash prefix that make buckets of about ``per_bucket`` rows."""
    return min(most, max(0, math.ceil(math.log2(max(1, rows) / per_bucket))))
