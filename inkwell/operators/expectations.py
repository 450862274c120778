"""Data-quality checks over tables: each gives one row with its number of violations."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F


class Declared(NamedTuple):
    """What to check of one table."""

    unique: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    most_rows: int | None = None


class Reference(NamedTuple):
    """Every value of the child column has to stand in the parent column."""

    check: str
    child: tuple[str, str]  # table, column
    parent: tuple[str, str]
    reported: tuple[str, str]  # table and column of the result row
    null_counts: bool = False  # whether a child row without a value is a violation


def _rows(tables: dict[str, DataFrame], literals: list[Column]) -> DataFrame:
    """A row for each literal struct."""
    spark = next(iter(tables.values())).sparkSession
    return spark.range(1).select(F.explode(F.array(*literals)).alias("d")).select("d.*")


def _result(rows: DataFrame) -> DataFrame:
    violations = F.coalesce("violations", F.lit(0)).cast("long")
    return rows.select("check", "table", "column", violations.alias("violations"), (violations == 0).alias("passed"))


def check_tables(tables: dict[str, DataFrame], declared: dict[str, Declared]) -> DataFrame:
    """Unique, not_null and row_cap checks of all tables: each table is scanned once, and all share one shuffle.

    Rows are taken apart into (column, digest of the value) pairs and counted; of columns that need not be unique only
    whether they are NULL is kept, so a task sends two rows for each of those, and no text is shuffled. unique counts the
    values that occur more than once, NULLs aside; not_null counts rows; row_cap is 1 for a table with more rows than
    ``most_rows``. Digests have 128 bits: among 10^12 values two share one with a chance of some 10^-15.
    """

    def digest(column: str, salt: list[Column]) -> Column:
        return F.when(F.col(column).isNotNull(), F.xxhash64(*salt, F.col(column).cast("string")))

    def cell(column: str, first: Column, second: Column) -> Column:
        return F.struct(F.lit(column).alias("column"), first.alias("value"), second.alias("more"))

    zero = F.lit(0).cast("long")
    cells = []
    for table, what in declared.items():
        names = list(dict.fromkeys([*what.unique, *what.not_null]))
        pairs = [
            cell(c, digest(c, []), digest(c, [F.lit("more")])) if c in what.unique
            else cell(c, F.when(F.col(c).isNotNull(), zero), F.when(F.col(c).isNotNull(), zero))
            for c in names
        ]
        # the empty name stands for the table itself
        pairs.append(cell("", zero, zero))
        cells.append(tables[table].select(F.lit(table).alias("table"), F.explode(F.array(*pairs)).alias("c")).select("table", "c.*"))
    counted = reduce(DataFrame.unionAll, cells).groupBy("table", "column", "value", "more").agg(F.count(F.lit(1)).alias("n"))
    found = counted.groupBy("table", "column").agg(
        F.sum(F.when(F.col("value").isNull(), F.col("n"))).alias("nulls"),
        F.count_if(F.col("value").isNotNull() & (F.col("n") > 1)).alias("repeated"),
        F.sum("n").alias("rows"),
    )
    wanted = [
        F.struct(F.lit(check).alias("check"), F.lit(t).alias("table"), F.lit(c).alias("column"), F.lit(most).alias("most"))
        for t, what in declared.items()
        for check, columns, most in (
            ("unique", what.unique, 0), ("not_null", what.not_null, 0),
            ("row_cap", () if what.most_rows is None else ("",), what.most_rows or 0),
        )
        for c in columns
    ]
    violations = (
        F.when(F.col("check") == "unique", F.col("repeated")).when(F.col("check") == "not_null", F.col("nulls"))
        .otherwise((F.col("rows") > F.col("most")).cast("long"))
    )
    return _result(_rows(tables, wanted).join(found, ["table", "column"], "left").withColumn("violations", violations))


def check_references(tables: dict[str, DataFrame], references: list[Reference]) -> DataFrame:
    """Child rows without a parent, for all references: each table is scanned once, and all share one shuffle.

    Values are counted before they meet, so a frequent one is a single row.
    """
    sides: dict[str, list[Column]] = {}
    for number, r in enumerate(references):
        for child, (table, column) in ((1, r.child), (0, r.parent)):
            side = F.struct(F.lit(number).alias("r"), F.lit(child).alias("child"), F.col(column).cast("string").alias("value"))
            sides.setdefault(table, []).append(side)
    facts = [tables[t].select(F.explode(F.array(*s)).alias("f")).select("f.*") for t, s in sides.items()]
    values = reduce(DataFrame.unionAll, facts).groupBy("r", "value").agg(
        F.sum("child").alias("children"), F.count_if(F.col("child") == 0).alias("parents")
    )
    lost = F.col("value").isNull() | (F.col("parents") == 0)
    found = values.filter(lost).groupBy("r").agg(
        F.sum("children").alias("all"), F.sum(F.when(F.col("value").isNotNull(), F.col("children"))).alias("with_value")
    )
    wanted = [
        F.struct(F.lit(number).alias("r"), F.lit(r.check).alias("check"), F.lit(r.reported[0]).alias("table"),
                 F.lit(r.reported[1]).alias("column"), F.lit(r.null_counts).alias("null_counts"))
        for number, r in enumerate(references)
    ]
    violations = F.when(F.col("null_counts"), F.col("all")).otherwise(F.col("with_value"))
    return _result(_rows(tables, wanted).join(found, "r", "left").withColumn("violations", violations))


def unique(rows: DataFrame, table: str, column: str) -> DataFrame:
    """Values that occur more than once; NULLs are ignored."""
    return check_tables({table: rows}, {table: Declared(unique=(column,))})


def not_null(rows: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Rows with NULL, for all columns of a table in one pass."""
    return check_tables({table: rows}, {table: Declared(not_null=tuple(columns))})


def relationship(
    child: DataFrame, table: str, column: str, parent: DataFrame, parent_column: str, where: Column | None = None
) -> DataFrame:
    """Child rows whose non-NULL value is not in the parent."""
    tables = {table: child if where is None else child.filter(where), "": parent}
    return check_references(tables, [Reference("relationships", (table, column), ("", parent_column), (table, column))])


def row_cap(rows: DataFrame, table: str, most: int) -> DataFrame:
    """One violation when the table has more than ``most`` rows."""
    return check_tables({table: rows}, {table: Declared(most_rows=most)})


def duplicates(rows: DataFrame, column: str) -> DataFrame:
    """The values that occur more than once, with their counts."""
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias("occurrences")).filter("occurrences > 1")


def orphans(child: DataFrame, parent: DataFrame, column: str, parent_column: str) -> DataFrame:
    """Child rows without a parent row."""
    return child.join(parent.select(F.col(parent_column).alias(column)), column, "left_anti")


# The checks declared for the models.
UNIQUE = {
    "stg_posts": ["id", "url"],
    "stg_authors": ["author_id", "author_name"],
    "stg_summaries": ["id", "post_id"],
    "mart_posts": ["id", "url"],
    "mart_authors": ["author_id", "author_name"],
    "mart_sources": ["id"],
    "mart_newsletter_candidates": ["post_id"],
    "dead_letter_posts": ["id"],
}
NOT_NULL = {
    "stg_posts": ["id", "source_id", "title", "url", "author_name"],
    "stg_authors": ["author_id", "author_name", "post_count"],
    "stg_summaries": ["id", "post_id", "summary_text"],
    "mart_posts": ["id", "source_id", "title", "url", "author_name"],
    "mart_authors": ["author_id", "author_name", "post_count"],
    "mart_sources": ["id", "name", "total_post_count"],
    "mart_newsletter_candidates": [
        "post_id", "title", "summary_text", "author_name", "source_name", "category", "quality_rating",
        "publication_date", "url", "rank_score", "category_rank",
    ],
}
CANDIDATE_CAP = 20


REFERENCES = [
    Reference("relationships", ("stg_summaries", "post_id"), ("raw_blog_posts", "id"), ("stg_summaries", "post_id")),
    Reference("relationships", ("mart_posts", "author_id"), ("mart_authors", "author_id"), ("mart_posts", "author_id")),
    Reference("summary_join_integrity", ("stg_summaries", "post_id"), ("mart_posts", "id"), ("mart_posts", "id"), True),
]


def run_expectations(tables: dict[str, DataFrame]) -> DataFrame:
    """All declared checks over the models, one row each: check, table, column, violations, passed.

    ``tables`` holds the models by name plus raw_blog_posts, and may hold dead_letter_posts, whose ids then have to be
    unique. Every table is read twice at most.
    """
    declared = {
        t: Declared(tuple(UNIQUE[t]), tuple(NOT_NULL.get(t, ())), CANDIDATE_CAP if t == "mart_newsletter_candidates" else None)
        for t in UNIQUE if t != "dead_letter_posts" or t in tables
    }
    return check_tables(tables, declared).unionByName(check_references(tables, REFERENCES))


def all_passed(results: DataFrame) -> bool:
    """The gate: False when any check has violations."""
    return results.filter(~F.col("passed")).isEmpty()
