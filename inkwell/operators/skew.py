"""Joins and positions that keep one very frequent key from ending up in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from inkwell.session import cut_lineage

ROWS_PER_TASK = 1_000_000


def join_hot_keys(
    rows: DataFrame, lookup: DataFrame, key: str, counts: DataFrame, row_id: str, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Left join with a table that has one row per key, with the rows of frequent keys spread over several tasks.

    ``counts`` has the number of rows per key (key, count). Every key with more than ``rows_per_task`` rows, the NULL key
    too, is spread over as many salts as it fills tasks, and the lookup is repeated for those only. The list of such
    keys is broadcast: it has less than one row for every ``rows_per_task`` rows.
    """
    hot = counts.filter(F.col("count") > rows_per_task).select(
        F.col(key).alias("_key"), F.ceil(F.col("count") / rows_per_task).cast("int").alias("_salts")
    )

    def marked(table: DataFrame) -> DataFrame:
        same = F.col(key).eqNullSafe(F.col("_key"))
        return table.join(F.broadcast(hot), same, "left").withColumn("_salts", F.coalesce("_salts", F.lit(1))).drop("_key")

    salted_rows = marked(rows).withColumn("_salt", F.pmod(F.xxhash64(row_id), "_salts").cast("int")).drop("_salts")
    salted_lookup = marked(lookup).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))).drop("_salts")
    return salted_rows.join(salted_lookup, [key, "_salt"], "left").drop("_salt")


def with_position(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Adds ``position``, counted from 0 within each key in ``order``, without gathering a key in one task.

    Rows are range-partitioned by key and order, so a frequent key spans many partitions. Its rows'
    positions are their index within the partition plus the number of the key's rows in earlier
    partitions. The partitioning is written first, since both steps must see the same one.
    ``order`` should end in a unique column.
    """
    ranged = rows.repartitionByRange(*[F.col(k) for k in keys], *order).sortWithinPartitions(*keys, *order)
    # monotonically_increasing_id is the partition number in the upper 31 bits, the row index below
    numbered = cut_lineage(ranged.withColumn("_row", F.monotonically_increasing_id()))
    numbered = numbered.withColumn("_slice", F.shiftright("_row", 33))
    slices = numbered.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_rows"), F.min("_row").alias("_first"))
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0))).drop("_rows")
    position = F.col("_before") + F.col("_row") - F.col("_first")
    return numbered.join(offsets, [*keys, "_slice"]).withColumn("position", position).select(*rows.columns, "position")
