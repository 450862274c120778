import random

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from helpers import plan, values
from inkwell.operators.skew import join_hot_keys, with_position
from inkwell.operators.upsert import first_per_key, insert_if_absent, present_keys


def test_positions_of_a_hot_key(spark):
    """Half of all rows share a key; positions equal those of a plain sort."""
    random.seed(1)
    rows = [(i, "hot" if i % 2 else f"k{i % 7}", random.choice([None, 1, 2, 3])) for i in range(3000)]
    frame = spark.createDataFrame(rows, "id INT, key STRING, day INT").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # keep several slices
    try:
        placed = with_position(frame, ["key"], [F.desc_nulls_first("day"), F.asc("id")])
        got = {(r["key"], r["id"]): r["position"] for r in placed.collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    expected = {}
    for key in {k for _, k, _ in rows}:
        ordered = sorted((r for r in rows if r[1] == key), key=lambda r: (r[2] is not None, -(r[2] or 0), r[0]))
        expected |= {(key, r[0]): n for n, r in enumerate(ordered)}
    assert got == expected


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 3)), min_size=1, max_size=20))
def test_positions_match_a_window(spark, rows):
    frame = spark.createDataFrame([(i, k, d) for i, (k, d) in enumerate(rows)], "id INT, key STRING, day INT")
    placed = with_position(frame, ["key"], [F.asc("day"), F.asc("id")])
    for key in "ab":
        ordered = [r["id"] for r in placed.filter(F.col("key") == key).orderBy("position").collect()]
        assert ordered == [i for _, i in sorted((d, i) for i, (k, d) in enumerate(rows) if k == key)]


def test_join_hot_keys_equals_a_left_join(spark):
    rows = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(600)], "id INT, key STRING")
    lookup = rows.select("key").distinct().filter("key <> 'k3'").withColumn("value", F.upper("key"))
    counts = rows.groupBy("key").count()
    for most in (1_000_000, 50, 1):
        joined = join_hot_keys(rows, lookup, "key", counts, "id", most)
        assert values(joined, "id", "key", "value") == values(rows.join(lookup, "key", "left"), "id", "key", "value")


def test_every_frequent_key_is_spread_and_null_too(spark):
    rows = spark.createDataFrame([(i, None if i % 3 == 0 else f"k{i % 400}") for i in range(6000)], "id INT, key STRING")
    lookup = rows.select("key").distinct().filter("key is not null").withColumn("value", F.upper("key"))
    counts = rows.groupBy("key").count()
    joined = join_hot_keys(rows, lookup, "key", counts, "id", 5)
    assert values(joined, "id", "value") == values(rows.withColumn("value", F.upper("key")), "id", "value")


def test_first_per_key_limits_before_the_shuffle(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "n INT, k STRING")
    first = first_per_key(rows, ["k"], [F.desc("n")])
    assert values(first) == [(2, "a"), (3, "b")]
    text = plan(first)
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Partial") > text.index("Exchange")  # printed top down: partial limit below the exchange


def test_insert_if_absent(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "c")], "n INT, k STRING")
    table = spark.createDataFrame([("c", 0), ("z", 0)], "k STRING, other INT")
    assert values(insert_if_absent(rows, table, ["k"], [F.col("n")]), "n", "k") == [(1, "a"), (3, "b")]
    assert values(present_keys(table, ["k"], rows)) == ["c"]
