from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from helpers import NOW, as_of, posts, sources, values
from inkwell.operators import source_admin
from inkwell.operators.ingest import age_filter_counts, ingest_posts, recent_entries, run_metrics
from inkwell.schemas import FEEDS
from inkwell.sources.seeds import read_source_seed
from inkwell.sources.tables import active_sources, source_by_id

ENTRY = "n INT, source_id BIGINT, title STRING, body STRING, url STRING, publication_date TIMESTAMP, author_name STRING"


def entries(spark, *rows):
    """(n, source_id, url, author)"""
    return spark.createDataFrame([(n, s, f"t{n}", "b", u, NOW, a) for n, s, u, a in rows], ENTRY)


def ingest(spark, rows, existing=None):
    return ingest_posts(rows, existing if existing is not None else posts(spark), [F.col("n")], as_of())


def test_first_entry_per_url_wins_and_known_urls_are_skipped(spark):
    rows = entries(spark, (2, 1, "u1", "A"), (1, 1, "u1", "B"), (3, 1, "https://p/9", "C"), (4, 2, "u2", None),
                   (5, 2, None, "D"))
    got = ingest(spark, rows, posts(spark, (9, 1, "old", NOW, "Z")))
    assert values(got.inserted, "url", "title", "author_name", "created_at") == [("u1", "t1", "B", NOW)]
    assert values(got.metrics) == [(1, 1, 2, 0), (2, 0, 0, 2)]
    assert values(got.failures, "post_reference", "failure_reason") == [
        ("u2", "Insert failed for source 2: null value in column author_name"),
        ("unknown", "Insert failed for source 2: null value in column url"),
    ]


def test_ingesting_again_inserts_nothing(spark):
    rows = entries(spark, (1, 1, "u1", "A"), (2, 1, "u2", "A"))
    first = ingest(spark, rows).inserted
    again = ingest(spark, rows, first)
    assert again.inserted.isEmpty()
    assert values(again.metrics) == [(1, 0, 2, 0)]
    assert values(first, "id") == values(ingest(spark, rows).inserted, "id")


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 3), st.sampled_from(["a", "b", "c", None]), st.sampled_from(["x", None])),
                min_size=1, max_size=15))
def test_metrics_add_up(spark, rows):
    frame = entries(spark, *[(n, s, u, a) for n, (s, u, a) in enumerate(rows)])
    got = ingest(spark, frame)
    totals = got.metrics.agg(*[F.sum(c) for c in ("success_count", "duplicate_count", "failure_count")]).first()
    valid = {u for _, u, a in rows if u is not None and a is not None}
    assert sum(totals) == len(rows)
    assert totals[0] == len(valid)
    assert got.failures.count() == totals[2]


def test_run_metrics_count_sources_with_and_without_a_feed(spark):
    frame = sources(spark, (1, "A", "c", 5, "active"), (2, "B", "c", 5, "active"), (3, "C", "c", 5, "active"))
    feeds = spark.createDataFrame([(1, "u", NOW, "x"), (2, "u", NOW, None)], FEEDS)
    metrics = ingest(spark, entries(spark, (1, 1, "u1", "A"), (2, 1, "u1", "A"))).metrics
    assert values(run_metrics(metrics, frame, feeds)) == [(1, 1, 0, 2, 1)]


def test_age_filter_keeps_undated_and_boundary(spark):
    at = [NOW - timedelta(days=30), NOW - timedelta(days=30, seconds=1), None, NOW + timedelta(days=1)]
    rows = spark.createDataFrame([(1, d) for d in at], "source_id BIGINT, publication_date TIMESTAMP")
    assert recent_entries(rows, as_of()).count() == 3
    assert values(age_filter_counts(rows, as_of())) == [(1, 4, 3, 1)]


def test_seed_file(spark, tmp_path):
    path = tmp_path / "seed.csv"
    path.write_text("name,rss_feed_url,blog_url,category,quality_rating\n"
                    '"  Ann\'s, blog ",https://a/feed ,https://a,Data,5\nBo,https://b/feed,,Web\t,3\nBo2,https://a/feed,,W,4\n')
    seed = read_source_seed(spark, str(path))
    assert values(seed, "name", "category", "quality_rating", "status") == [
        ("Ann's, blog", "Data", 5, "active"), ("Bo", "Web", 3, "active"), ("Bo2", "W", 4, "active")]
    added = source_admin.seed_sources(seed, sources(spark), [F.col("name")], as_of())
    assert values(added, "rss_feed_url", "name") == [("https://a/feed", "Ann's, blog"), ("https://b/feed", "Bo")]
    assert values(source_admin.seed_metrics(seed, added)) == [(2, 1, 3)]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_source_seed(spark, str(tmp_path / "none.csv"))


REQUEST = "n INT, rss_feed_url STRING, name STRING, category STRING, quality_rating INT"


def test_add_sources(spark):
    table = sources(spark, (1, "A", "c", 5, "active"))
    requests = spark.createDataFrame([
        (1, "https://new", "N", "c", 10), (2, "https://new", "again", "c", 1), (3, "https://s1/feed", "A", "c", 3),
        (4, " ", "N", "c", 3), (5, "u", "", "c", 3), (6, "u", "n", None, 3), (7, "u", "n", "c", 11), (8, "u", "n", "c", None),
    ], REQUEST)
    got = source_admin.add_sources(requests, table, "n", as_of())
    assert values(got.outcomes, "n", "action", "reason") == [
        (1, "inserted", None), (2, "skipped", "duplicate"), (3, "skipped", "duplicate"),
        (4, "rejected", "rss_feed_url must not be empty"), (5, "rejected", "name must not be empty"),
        (6, "rejected", "category must not be empty"),
        (7, "rejected", "quality_rating must be an integer between 1 and 10"),
        (8, "rejected", "quality_rating must be an integer between 1 and 10"),
    ]
    assert values(got.table, "name", "quality_rating", "status") == [("N", 10, "active")]


def test_status_changes(spark):
    table = sources(spark, (1, "A", "c", 5, "active"), (2, "B", "c", 5, "inactive"))
    ids = spark.createDataFrame([(1,), (7,), (1,)], "id BIGINT")
    off = source_admin.set_status(table, ids, False, as_of())
    assert values(off.table, "id", "status") == [(1, "inactive"), (2, "inactive")]
    assert values(off.outcomes) == [(1, "deactivated"), (7, "not_found")]
    on = source_admin.set_status(off.table, ids, True, as_of())
    assert values(on.table, "id", "status") == [(1, "active"), (2, "inactive")]


def test_update_sources(spark):
    table = sources(spark, (1, "A", "c", 5, "active"), (2, "B", "c", 5, "active"))
    changes = spark.createDataFrame(
        [(1, "New", None), (2, " ", 4), (3, "X", 2), (4, None, 0), (5, None, None)], "id BIGINT, name STRING, quality_rating INT")
    got = source_admin.update_sources(table, changes, as_of())
    assert values(got.table, "id", "name", "quality_rating") == [(1, "New", 5), (2, "B", 5)]
    assert values(got.outcomes) == [
        (1, "updated", None), (2, "rejected", "Empty value for field: name"), (3, "not_found", None),
        (4, "rejected", "quality_rating must be an integer between 1 and 10"),
        (5, "rejected", "No fields provided to update"),
    ]
    with pytest.raises(ValueError, match="Unknown fields"):
        source_admin.update_sources(table, changes.withColumn("status", F.lit("x")), as_of())


def test_touch_and_reads(spark):
    later = F.lit("2024-02-01 00:00:00").cast("timestamp")
    table = sources(spark, (1, "A", "c", 5, "active"), (2, "B", "c", 5, "inactive"))
    touched = source_admin.touch_last_checked(table, spark.createDataFrame([(2,)], "id BIGINT"), later)
    assert values(touched, "id", "last_checked_at", "updated_at") == [
        (1, NOW, NOW), (2, datetime(2024, 2, 1), datetime(2024, 2, 1))]
    assert values(active_sources(table), "id") == [1]
    assert values(source_by_id(table, 2), "name") == ["B"]
    assert source_by_id(table, 9).isEmpty()


def test_failures_that_look_alike_are_letters_of_their_own(spark):
    rows = entries(spark, (1, 1, None, "A"), (2, 1, None, "A"), (3, 1, None, "A"), (4, 1, "u", None), (5, 1, "u", None))
    failures = ingest(spark, rows).failures
    assert failures.count() == 5
    assert failures.select("id").distinct().count() == 5
    assert values(failures, "id") == values(ingest(spark, rows).failures, "id")


def test_several_changes_of_one_source_leave_one_row(spark):
    table = sources(spark, (1, "old", "cat", 3, "active"), (2, "other", "cat", 4, "active"))
    changes = spark.createDataFrame(
        [(1, 1, "first", 5), (2, 1, None, 7), (3, 1, "last", None), (4, 1, " ", None), (5, 9, "x", None)],
        "request_id INT, id BIGINT, name STRING, quality_rating INT",
    )
    changed = source_admin.update_sources(table, changes, as_of(), "request_id")
    assert values(changed.table, "id", "name", "quality_rating") == [(1, "last", 7), (2, "other", 4)]
    assert values(changed.outcomes, "request_id", "action") == [
        (1, "updated"), (2, "updated"), (3, "updated"), (4, "rejected"), (5, "not_found")]


def test_requests_that_share_an_id_are_requests_of_their_own(spark):
    requests = spark.createDataFrame(
        [(1, "https://a", "n", "c", 5), (1, "https://a", "n", "c", 5), (1, "https://b", "n", "c", 5)],
        "request_id INT, rss_feed_url STRING, name STRING, category STRING, quality_rating INT",
    )
    changed = source_admin.add_sources(requests, sources(spark), "request_id", as_of())
    assert values(changed.table, "rss_feed_url") == ["https://a", "https://b"]
    assert values(changed.outcomes, "action") == ["inserted", "inserted", "skipped"]


def wide_steps(df, column):
    """Steps of the plan that sort, shuffle, group or number rows which hold the column."""
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    found = []
    for section in text.split("\n\n"):
        title = section.strip().split("\n")[0]
        if any(name in title for name in ("Exchange", "Sort", "Window", "Aggregate")) and title.startswith("("):
            inputs = [line for line in section.split("\n") if line.startswith("Input") or line.startswith("Arguments")]
            if any(f"{column}#" in line for line in inputs):
                found.append(title)
    return found


def test_bodies_are_neither_sorted_nor_shuffled(spark, tmp_path):
    rows = entries(spark, *[(i, 1, f"u{i % 7}", "A") for i in range(50)])
    rows.write.parquet(str(tmp_path / "entries"))
    stored = spark.read.schema(rows.schema).parquet(str(tmp_path / "entries"))
    posts(spark, (1, 1, "t", NOW, "x")).write.parquet(str(tmp_path / "posts"))
    got = ingest(spark, stored, spark.read.parquet(str(tmp_path / "posts"))).inserted
    assert got.count() == 7
    assert wide_steps(got, "url") and not wide_steps(got, "body")


def test_order_of_arrival_with_ties_and_missing_places(spark):
    rows = entries(spark, (3, 1, "u", "A"), (None, 1, "u", "B"), (1, 1, "v", "C"), (1, 1, "v", "C"))
    got = ingest(spark, rows).inserted
    assert values(got, "url", "author_name") == [("u", "B"), ("v", "C")]
