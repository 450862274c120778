from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from helpers import NOW, as_of, mart_post, mart_posts, mart_sources, plan, posts, sources, summaries, values
from inkwell.operators import newsletter
from inkwell.plans import candidates, marts, staging
from inkwell.plans.materialize import create_views, write_tables


def models(spark, raw, known):
    stg_posts = staging.stg_posts(raw, sources(spark, (1, "Blog", "Data", 5, "active"), (2, "Other", "Web", 4, "active")))
    stg_authors = staging.stg_authors(raw)
    return stg_posts, stg_authors, marts.mart_posts(stg_posts, staging.stg_summaries(known), stg_authors)


def test_staging(spark):
    raw = posts(spark, (1, 1, "  A Title! ", datetime(2024, 1, 2, 23, 59), " ann lee "), (2, 9, "B", None, "  "),
                (3, 2, "C", datetime(2024, 1, 5), "ANN LEE"))
    stg_posts, stg_authors, _ = models(spark, raw, summaries(spark))
    assert values(stg_posts, "id", "source_name", "category", "title", "author_name", "publication_date", "post_slug") == [
        (1, "Blog", "Data", "A Title!", "ann lee", date(2024, 1, 2), "a-title"),
        (2, None, None, "B", "Unknown", None, "b"),
        (3, "Other", "Web", "C", "ANN LEE", date(2024, 1, 5), "c"),
    ]
    assert values(stg_authors, "author_name", "post_count", "source_ids", "first_seen_at", "last_seen_at") == [
        ("Ann Lee", 2, [1, 2], datetime(2024, 1, 2, 23, 59), datetime(2024, 1, 5))]


def test_low_quality_flag(spark):
    long = "x" * 50
    known = summaries(spark, (1, long, ["a"]), (2, long[1:], ["a"]), (3, long, []), (4, long, None), (5, None, ["a"]), (6, None, []))
    assert values(staging.stg_summaries(known), "id", "is_low_quality") == [
        (1, False), (2, True), (3, True), (4, True), (5, False), (6, True)]


def test_author_ids_equal_the_join_with_authors(spark):
    """Posts without a name have an author id only when some feed spells out 'unknown'."""
    for literal in (None, "unknown"):
        raw = posts(spark, (1, 1, "a", NOW, "jean-luc"), (2, 1, "b", NOW, None), (3, 1, "c", NOW, literal))
        stg_posts, stg_authors, mart = models(spark, raw, summaries(spark))
        names = stg_authors.select(F.col("author_id").alias("wanted"), F.upper("author_name").alias("name"))
        joined = mart.join(names, F.upper("author_name") == F.col("name"), "left")
        assert joined.filter(~F.col("wanted").eqNullSafe(F.col("author_id"))).isEmpty()
        assert mart.filter("author_id is null").count() == (2 if literal is None else 0)


def test_primary_category(spark):
    raw = posts(spark, (1, 1, "a", NOW, "Ann Lee"), (2, 2, "b", NOW, "Ann Lee"), (3, 2, "c", NOW, "bo"), (4, 2, "d", NOW, None))
    stg_posts, stg_authors, _ = models(spark, raw, summaries(spark))
    strict = marts.mart_authors(stg_authors, stg_posts)
    assert values(strict, "author_name", "primary_category") == [("Ann Lee", "Data"), ("Bo", None)]
    normal = marts.mart_authors(stg_authors, stg_posts, normalize_names=True)
    assert values(normal, "author_name", "primary_category") == [("Ann Lee", "Data"), ("Bo", "Web")]


def test_mart_sources_counts(spark):
    raw = posts(spark, (1, 1, "a", datetime(2024, 1, 2), "x"), (2, 1, "b", None, "x"))
    stg_posts = models(spark, raw, summaries(spark))[0]
    mart = marts.mart_sources(sources(spark, (1, "A", "c", 5, "active"), (2, "B", "c", 5, "active")), stg_posts)
    assert values(mart, "id", "total_post_count", "latest_post_date") == [(1, 2, date(2024, 1, 2)), (2, 0, None)]


def test_source_health(spark):
    def days(n, seconds=0):
        return NOW - timedelta(days=n, seconds=seconds)

    frame = mart_sources(
        spark,
        (1, "fine", 5, "active", 3, days(90), days(0)),
        (2, "inactive", 5, "inactive", 3, days(90), days(0)),
        (3, "empty, seven days", 5, "active", 0, days(7, 86399), days(0)),
        (4, "empty, eight days", 5, "active", 0, days(8), days(0)),
        (5, "checked three days ago", 5, "active", 3, days(90), days(3, 86399)),
        (6, "checked four days ago", 5, "active", 3, days(90), days(4)),
        (7, "no dates", 5, "active", 0, None, None),
    )
    assert values(marts.source_health(frame, as_of()).filter("is_unhealthy"), "id") == [2, 4, 6]


def weekly(spark, *rows):
    """(id, category, day, rating-source)"""
    frame = mart_posts(spark, *[mart_post(i, f"t{i}", category=c, publication_date=d, source_id=s) for i, c, d, s in rows])
    rated = mart_sources(spark, (1, "A", 5, "active", 1, NOW, NOW), (2, "B", 1, "active", 1, NOW, NOW),
                         (3, "C", None, "active", 1, NOW, NOW), (4, "D", 5, "inactive", 1, NOW, NOW))
    return frame, rated


def test_candidates_filters_and_score(spark):
    frame, rated = weekly(
        spark, (1, "X", date(2024, 1, 31), 1), (2, "X", date(2024, 1, 24), 1), (3, "X", date(2024, 1, 23), 1),
        (4, "X", date(2024, 1, 31), 2), (5, "X", date(2024, 1, 31), 3), (6, "X", date(2024, 1, 31), 4), (7, "X", None, 1))
    got = candidates.newsletter_candidates(frame, rated, as_of())
    fresh = 1 - 0.5 / 7
    assert values(got, "post_id", "category_rank", "rank_score") == [
        (1, 1, round(0.4 + fresh * 0.4 + 0.2, 4)), (2, 3, 0.4 + 0.12), (4, 2, round(0.08 + fresh * 0.4 + 0.16, 4))]
    unsummarised = frame.withColumn("summary_text", F.lit(None).cast("string"))
    assert candidates.newsletter_candidates(unsummarised, rated, as_of()).isEmpty()


def test_candidate_caps(spark):
    frame, rated = weekly(spark, *[(i, f"C{i % 6}", date(2024, 1, 25 + i % 6), 1 + i % 2) for i in range(1, 61)])
    got = candidates.newsletter_candidates(frame, rated, as_of())
    rows = got.collect()
    assert len(rows) == 20
    assert max(values(got.groupBy("category").count(), "count")) <= 5
    assert [r["rank_score"] for r in rows] == sorted((r["rank_score"] for r in rows), reverse=True)
    text = plan(got)
    assert text.count("WindowGroupLimit") == 2 and "TakeOrderedAndProject" in text
    assert "Python" not in text and "Pandas" not in text


def test_scores_are_not_clamped(spark):
    frame = mart_posts(spark, mart_post(1, publication_date=date(2024, 2, 7)))
    rated = mart_sources(spark, (1, "A", 10, "active", 1, NOW, NOW))
    assert values(candidates.newsletter_candidates(frame, rated, as_of()), "rank_score")[0] > 1


def test_issues_in_one_job_equal_single_issues(spark):
    frame, rated = weekly(spark, *[(i, f"C{i % 3}", date(2024, 1, 1 + i % 31), 1 + i % 2) for i in range(1, 91)])
    times = [datetime(2024, 1, 8, 8), datetime(2024, 1, 15, 8), datetime(2024, 1, 31, 8)]
    many = candidates.issue_candidates(frame, rated, times)
    for time in times:
        at = F.lit(time.isoformat(sep=" ")).cast("timestamp")
        until = frame.filter(F.col("publication_date") <= F.lit(time.date()))
        single = candidates.newsletter_candidates(until, rated, at)
        assert values(many.filter(F.col("issue_at") == at), "post_id", "rank_score", "category_rank") == values(
            single, "post_id", "rank_score", "category_rank")
    text = plan(many)
    assert "NestedLoop" not in text and "Cartesian" not in text


CANDIDATE = ("issue_at TIMESTAMP, post_id BIGINT, title STRING, summary_text STRING, author_name STRING, source_name STRING, "
             "category STRING, url STRING, rank_score DOUBLE")


def test_newsletter_text(spark):
    rows = spark.createDataFrame([
        (NOW, 1, "Second", "Sum 2.", "Ann", "Blog", "Web", "https://2", 0.5),
        (NOW, 2, "First", "Sum 1.", "Bo", "Blog", "Web", "https://1", 0.9),
        (NOW, 3, None, "", None, "", "", None, 0.1),
        (NOW, 4, "D", "S", "A", "B", "AI", "https://4", 0.1),
    ], CANDIDATE)
    document = newsletter.newsletters(rows).first()
    assert document["title"] == "Weekly Knowledge Digest - 2024-01-31"
    assert document["file"] == "newsletter_2024-01-31.md"
    assert document["candidate_count"] == 4
    assert document["content"].split("\n") == [
        "[EDITORIAL INTRO — Please add your intro here before publishing]", "", "---", "",
        "## AI", "", "### [D](https://4)", "*B · A*", "", "S", "", "[Read more](https://4)", "", "---", "",
        "## Uncategorized", "", "### [Untitled](#missing-url)", "*Unknown Source · Unknown Author*", "",
        "Summary unavailable.", "", "[Read more](#missing-url)", "", "---", "",
        "## Web", "", "### [First](https://1)", "*Blog · Bo*", "", "Sum 1.", "", "[Read more](https://1)", "", "---", "",
        "### [Second](https://2)", "*Blog · Ann*", "", "Sum 2.", "", "[Read more](https://2)", "", "---", "",
        "[EDITORIAL COMMENTARY — Add your commentary and closing thoughts here]",
    ]


def test_empty_issue_has_no_document(spark, tmp_path):
    documents = newsletter.newsletters(spark.createDataFrame([], CANDIDATE))
    assert documents.isEmpty()
    assert newsletter.EMPTY_NEWSLETTER.count("EDITORIAL") == 2
    newsletter.write_newsletters(documents, str(tmp_path / "out"))


def test_tables_and_views(spark, tmp_path):
    frame = spark.createDataFrame([(1, "a")], "id INT, name STRING")
    written = write_tables({"things": frame}, str(tmp_path))
    create_views(written)
    assert values(spark.sql("SELECT name FROM things WHERE id = 1")) == ["a"]
