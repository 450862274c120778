from pyspark.sql import functions as F

from helpers import values
from inkwell.operators import expectations as ex


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), "id INT, name STRING")


def test_unique_ignores_nulls(spark):
    rows = frame(spark, (1, "a"), (1, "b"), (2, None), (None, None), (None, "c"))
    assert values(ex.unique(rows, "t", "id")) == [("unique", "t", "id", 1, False)]
    assert values(ex.unique(rows, "t", "name")) == [("unique", "t", "name", 0, True)]


def test_not_null_is_one_pass(spark):
    rows = frame(spark, (1, "a"), (2, None), (3, None))
    got = ex.not_null(rows, "t", ["id", "name"])
    assert values(got) == [("not_null", "t", "id", 0, True), ("not_null", "t", "name", 2, False)]


def test_relationship_counts_child_rows(spark):
    child = frame(spark, (1, "a"), (1, "b"), (2, "c"), (None, "d"))
    parent = frame(spark, (2, "x"))
    assert values(ex.relationship(child, "c", "id", parent, "id"), "violations", "passed") == [(2, False)]
    kept = ex.relationship(child, "c", "id", parent, "id", F.col("name") == "c")
    assert values(kept, "violations", "passed") == [(0, True)]
    assert values(ex.orphans(child, parent, "id", "id"), "name") == ["a", "b", "d"]


def test_row_cap_duplicates_and_gate(spark):
    rows = frame(spark, (1, "a"), (2, "a"), (3, "b"))
    assert values(ex.row_cap(rows, "t", 3), "passed") == [True]
    assert values(ex.row_cap(rows, "t", 2), "violations", "passed") == [(1, False)]
    assert values(ex.duplicates(rows, "name")) == [("a", 2)]
    assert ex.all_passed(ex.row_cap(rows, "t", 3)) and not ex.all_passed(ex.row_cap(rows, "t", 2))
    assert values(ex.unique(frame(spark).limit(0), "t", "id"), "passed") == [True]


def test_each_table_is_read_twice_at_most(spark, tmp_path):
    tables = {}
    for name, columns in {**ex.NOT_NULL, "raw_blog_posts": ["id"]}.items():
        names = sorted({*columns, *ex.UNIQUE.get(name, []), "post_id" if "summaries" in name else "id", "author_id"})
        path = str(tmp_path / name)
        spark.createDataFrame([tuple(str(i) for _ in names) for i in range(3)], ", ".join(f"{n} STRING" for n in names)).write.parquet(path)
        tables[name] = spark.read.parquet(path)
    results = ex.run_expectations(tables)
    plan = results._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") <= 2 * len(tables)
    assert all(values(results, "passed"))
