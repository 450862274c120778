"""Keyed table changes without MERGE: first row per key, insert-if-absent, keyed updates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def first_per_key(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in ``order``.

    Spark turns the rank filter into a group limit that already runs before the shuffle, so a key
    with very many copies sends one row per input task.
    """
    ranked = rows.withColumn("_nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter("_nth = 1").drop("_nth")


def present_keys(table: DataFrame, keys: list[str], wanted: DataFrame) -> DataFrame:
    """The keys among ``wanted`` that the table holds.

    The table is by far the larger side in daily use. While the wanted keys are few, Spark broadcasts
    them and only scans the table's key columns, without a shuffle; a join that keeps all wanted rows
    would have to shuffle the table.
    """
    return table.select(*keys).join(wanted.select(*keys).distinct(), keys, "left_semi")


def insert_if_absent(rows: DataFrame, table: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The rows to append: first per key, key not in the table yet. Running it again yields nothing.

    ``rows`` is read twice, so it should be a written table when it is costly to compute.
    """
    return first_per_key(rows, keys, order).join(present_keys(table, keys, rows), keys, "left_anti")


def insert_wide_if_absent(
    rows: DataFrame, table: DataFrame, keys: list[str], order: list[Column], row_id: str
) -> DataFrame:
    """As :func:`insert_if_absent`, for rows with large columns: only keys, order and the column ``row_id`` are sorted and
    shuffled until the rows to append are known; these are then fetched by their ids.

    ``row_id`` tells the rows apart and stays the same when they are read again, as in a written table. While the ids to
    append are few they are broadcast, so the large columns are read but never shuffled.
    """
    names = [f"_order{i}" for i in range(len(order))]
    narrow = rows.select(*keys, row_id, *[c.alias(n) for c, n in zip(order, names)])
    firsts = first_per_key(narrow, keys, [*[F.col(n) for n in names], F.col(row_id)]).select(*keys, row_id)
    new = firsts.join(present_keys(table, keys, firsts), keys, "left_anti")
    return rows.join(new.select(row_id), row_id, "left_semi")


def apply_changes(
    table: DataFrame, changes: DataFrame, key: str, updatable: set[str], touched: dict[str, Column],
    order: str | None = None,
) -> DataFrame:
    """A new snapshot of ``table``: non-NULL columns of ``changes`` replace the old values.

    A key may have several changes: per column the last non-NULL value by the column ``order`` wins, as if the changes
    were applied one after the other, and the table keeps its number of rows. Without ``order`` the largest change
    counts as the last. ``touched`` gives values, such as the update time, set on every changed row.
    """
    fields = [c for c in changes.columns if c not in (key, order)]
    unknown = sorted(set(fields) - updatable)
    if not fields:
        raise ValueError("No fields provided to update")
    if unknown:
        raise ValueError(f"Unknown fields: {unknown}")
    place = F.struct(*([order] if order else []), *fields)
    latest = [F.max_by(c, F.when(F.col(c).isNotNull(), place)).alias(f"_new_{c}") for c in fields]
    joined = table.join(changes.groupBy(key).agg(F.lit(True).alias("_changed"), *latest), key, "left")

    def value(name: str) -> Column:
        new = F.coalesce(f"_new_{name}", name) if name in fields else F.col(name)
        return F.when(F.col("_changed"), touched[name]).otherwise(new) if name in touched else new

    return joined.select(*[value(c).alias(c) for c in table.columns])
