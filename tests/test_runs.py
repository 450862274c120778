import json
import os
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from helpers import NOW, as_of, letters, one, posts, sources, summaries, values
from inkwell.operators import notes
from inkwell.plans import runs
from inkwell.schemas import BLOG_POSTS, FEEDS
from inkwell.streaming import ingest as stream


def feed(*items):
    body = "".join(f"<item><title>{t}</title><link>{u}</link><author>{a}</author>"
                   f"<pubDate>{d:%d %b %Y} 10:00:00 GMT</pubDate></item>" for t, u, a, d in items)
    return f"<rss><channel>{body}</channel></rss>"


@pytest.fixture()
def answer():
    def reply(prompt):
        if "Fail" in prompt:
            raise RuntimeError("no answer")
        return json.dumps({"summary": "A summary that is long enough to count as good quality.", "tags": ["a"],
                           "difficulty": "beginner"})

    return reply


@pytest.fixture()
def store(spark):
    return runs.Store(
        sources(spark, (1, "Some Blog", "Data", 5, "active"), (2, "Quiet", "Web", 4, "active"), (3, "Off", "Web", 4, "inactive")),
        posts(spark, (1, 1, "Known post", NOW - timedelta(days=2), "Ann Lee")),
        summaries(spark, (1, "Known summary of the post, long enough to be fine.", ["x"])),
        letters(spark, (1, "https://p/1", "ingestion", False), (2, "99", "generation", False)),
    )


def test_daily_run(spark, store, answer, tmp_path):
    yesterday, old = NOW - timedelta(days=1), NOW - timedelta(days=60)
    feeds = spark.createDataFrame([
        (1, "https://s1/feed", NOW, feed(("New post", "https://n/1", "bo", yesterday), ("Again", "https://n/1", "bo", yesterday),
                                         ("Known post", "https://p/1", "Ann Lee", yesterday), ("Fail here", "https://n/2", "", old))),
        (2, "https://s2/feed", NOW, "<rss><channel><item>"),
        (3, "https://s3/feed", NOW, feed(("Ignored", "https://off/1", "x", yesterday))),
    ], FEEDS)
    run = runs.run_daily(store, feeds, str(tmp_path / "first"), as_of(), answer)
    report = run.report.first().asDict()
    assert {k: report[k] for k in ("total_success", "total_duplicates", "total_failures", "sources_processed", "sources_failed")} == {
        "total_success": 2, "total_duplicates": 2, "total_failures": 0, "sources_processed": 2, "sources_failed": 0}
    assert (report["total_found"], report["succeeded"], report["failed"]) == (2, 1, 1)
    assert values(run.written["new_dead_letters"], "failure_stage", "failure_reason") == [
        ("ingestion", "Feed parse failed with no entries"), ("summarization", "RuntimeError: no answer")]
    assert values(run.store.posts, "title") == ["Fail here", "Known post", "New post"]
    assert values(run.written["notes"].filter("part = 0"), "path") == [
        "authors/ann-lee.md", "authors/bo.md", "authors/unknown.md", "posts/data/fail-here.md", "posts/data/known-post.md",
        "posts/data/new-post.md", "sources/off.md", "sources/quiet.md", "sources/some-blog.md"]
    assert report["notes_failed"] == 0 and report["checks_failed"] == 0
    assert values(run.store.sources.filter("last_checked_at = updated_at"), "id") == [1, 2, 3]

    again = runs.run_daily(run.store, feeds, str(tmp_path / "second"), as_of(), answer, run.written["notes"])
    assert again.report.first()["total_success"] == 0
    assert set(values(again.written["note_changes"], "change")) == {"unchanged"}

    weekly = runs.run_weekly(run.written["mart_posts"], run.written["mart_sources"], str(tmp_path / "weekly"), as_of())
    assert values(weekly["candidates"], "title") == ["Known post", "New post"]
    assert weekly["newsletter"].first()["candidate_count"] == 2


def test_failing_checks_stop_the_run_before_rendering(spark, store, tmp_path):
    orphan = store._replace(summaries=store.summaries.unionByName(
        summaries(spark, (77, "Summary of a post that does not exist, long enough.", ["x"]))))
    feeds = spark.createDataFrame([(1, "https://s1/feed", NOW, feed(("New", "https://n/1", "bo", NOW)))], FEEDS)
    with pytest.raises(runs.ChecksFailed) as stopped:
        runs.run_daily(orphan, feeds, str(tmp_path / "stopped"), as_of())
    run = stopped.value.run
    assert "notes" not in run.written and not (tmp_path / "stopped" / "notes").exists()
    assert run.report.first()["checks_failed"] == 2 and values(run.store.posts, "title") == ["Known post", "New"]
    went_on = runs.run_daily(orphan, feeds, str(tmp_path / "on"), as_of(), stop_on_failed_checks=False)
    assert went_on.report.first()["checks_failed"] == 2 and went_on.report.first()["notes"] > 0


def test_first_feed_of_a_source_is_limited_by_age(spark, store, tmp_path):
    feeds = spark.createDataFrame([(1, "https://s1/feed", NOW, feed(
        ("New", "https://n/1", "bo", NOW), ("Old", "https://n/2", "bo", NOW - timedelta(days=60))))], FEEDS)
    run = runs.run_daily(store, feeds, str(tmp_path), as_of(), max_age_days=30)
    assert values(run.written["new_posts"], "title") == ["New"]
    assert "total_found" not in run.report.columns


def test_retry_run(spark, store, answer, tmp_path):
    more = store._replace(
        posts=store.posts.unionByName(posts(spark, (5, 1, "Later", NOW, "bo"))),
        dead_letters=store.dead_letters.unionByName(letters(spark, (3, "5", "summarization", False))),
    )
    marts = runs.build_marts(more, str(tmp_path / "marts"))
    run = runs.run_retry(more, marts["mart_posts"], str(tmp_path / "retry"), as_of(), answer)
    assert values(run.report) == [("generation", 1, 0, 1), ("ingestion", 1, 1, 0), ("summarization", 1, 1, 0)]
    assert values(run.store.dead_letters, "id", "resolved") == [(1, True), (2, False), (3, True)]
    assert values(run.store.summaries, "post_id") == [1, 5]


ENTRY = "n INT, source_id BIGINT, title STRING, body STRING, url STRING, publication_date TIMESTAMP, author_name STRING"


def test_stream_remembers_every_url(spark, tmp_path):
    inbox, table, lost = (str(tmp_path / name) for name in ("inbox", "posts", "lost"))
    stream.create_tables(spark, posts(spark, (1, 1, "old", NOW, "x")), table, lost)

    def arrive(*rows):
        full = [(n, 1, f"t{n}", "b", u, d, a) for n, u, d, a in rows]
        spark.createDataFrame(full, ENTRY).coalesce(1).write.mode("append").parquet(inbox)

    def run():
        entries = spark.readStream.schema(ENTRY).parquet(inbox)
        stream.start_ingest(entries, table, lost, str(tmp_path / "progress"), [F.col("n")], as_of(), 30).awaitTermination()
        return values(stream.read_posts(spark, table), "url")

    arrive((1, "u1", NOW, "a"), (2, "u1", NOW, "a"), (3, "https://p/1", NOW, "a"), (4, "u2", None, "a"), (5, "u3", NOW, None))
    assert run() == ["https://p/1", "u1", "u2"]
    arrive((6, "u1", NOW, "a"), (7, "u4", NOW, "a"), (8, "u5", NOW - timedelta(days=40), "a"))
    assert run() == ["https://p/1", "u1", "u2", "u4"]
    assert values(stream.read_failures(spark, lost), "post_reference", "batch_id") == [("u3", 0)]
    assert run() == ["https://p/1", "u1", "u2", "u4"]


def test_stream_batch_that_runs_again_replaces_itself(spark, tmp_path):
    """A batch that left files but was not committed adds its rows once when it is repeated."""
    table, lost, inbox = (str(tmp_path / name) for name in ("posts", "lost", "inbox"))
    stream.create_tables(spark, spark.createDataFrame([], BLOG_POSTS), table, lost)
    spark.createDataFrame([(1, 1, "t", "b", "u1", NOW, "a")], ENTRY).write.parquet(inbox)
    for attempt in ("one", "two"):  # a new progress folder makes the query start over with batch 0
        entries = spark.readStream.schema(ENTRY).parquet(inbox)
        stream.start_ingest(entries, table, lost, str(tmp_path / attempt), [F.col("n")], as_of()).awaitTermination()
    assert values(stream.read_posts(spark, table), "url") == ["u1"]


def test_batch_reads_the_buckets_it_touches_only(spark, tmp_path):
    table, lost, inbox = (str(tmp_path / name) for name in ("posts", "lost", "inbox"))
    stream.create_tables(spark, posts(spark, *[(i, 1, f"t{i}", NOW, "x") for i in range(40)]), table, lost, buckets=8)
    bucket = {u: b for u, b in values(stream.read_posts(spark, table), "url", "bucket")}
    assert len(set(bucket.values())) > 4
    known = "https://p/3"
    others = [b for b in range(8) if b != bucket[known]]
    some = stream.read_posts(spark, table, [bucket[known]])
    assert values(some, "url") == sorted(u for u, b in bucket.items() if b == bucket[known])
    assert all(f"bucket={bucket[known]}/" in path for path in some.inputFiles())
    for b in others:  # any look into another bucket would fail
        os.makedirs(f"{table}/bucket={b}/batch_id=-1", exist_ok=True)
        with open(f"{table}/bucket={b}/batch_id=-1/broken.parquet", "w") as file:
            file.write("no parquet")
    same = next(f"n{i}" for i in range(1000) if one(spark, stream.url_bucket(F.col("u"), 8), u=f"n{i}") == bucket[known])
    spark.createDataFrame([(1, 1, "t", "b", known, NOW, "a"), (2, 1, "t", "b", same, NOW, "a")], ENTRY).write.parquet(inbox)
    entries = spark.readStream.schema(ENTRY).parquet(inbox)
    stream.start_ingest(entries, table, lost, str(tmp_path / "progress"), [F.col("n")], as_of()).awaitTermination()
    assert values(stream.read_posts(spark, table, [bucket[known]]).filter("batch_id = 0"), "url") == [same]


def test_buckets_that_do_not_exist_yet(spark, tmp_path):
    table, lost = str(tmp_path / "posts"), str(tmp_path / "lost")
    stream.create_tables(spark, posts(spark, (1, 1, "t", NOW, "x")), table, lost, buckets=4)
    (there,) = values(stream.read_posts(spark, table), "bucket")
    assert stream.read_posts(spark, table, [b for b in range(4) if b != there]).isEmpty()
    assert stream.read_posts(spark, table, []).isEmpty()
    assert stream.read_posts(spark, table, range(4)).count() == 1


def test_merged_batches_go_on_where_they_stopped(spark, tmp_path):
    table, lost, inbox, merged = (str(tmp_path / name) for name in ("posts", "lost", "inbox", "merged"))
    stream.create_tables(spark, posts(spark, (1, 1, "t", NOW, "x")), table, lost, buckets=2)

    def arrive_and_run(path, *urls):
        rows = [(i, 1, "t", "b", u, NOW, "a") for i, u in enumerate(urls)]
        spark.createDataFrame(rows, ENTRY).coalesce(1).write.mode("append").parquet(inbox)
        entries = spark.readStream.schema(ENTRY).parquet(inbox)
        stream.start_ingest(entries, path, lost, str(tmp_path / "progress"), [F.col("n")], as_of()).awaitTermination()

    for urls in (["u1", "u2"], ["u2", "u3", "u4"], ["u5", "u6", "u7"]):
        arrive_and_run(table, *urls)
    stream.merge_batches(spark, table, merged)
    assert values(stream.read_posts(spark, merged), "url") == values(stream.read_posts(spark, table), "url")
    assert {b for b in values(stream.read_posts(spark, merged), "batch_id")} == {-1, 2}
    arrive_and_run(merged, "u1", "u7", "u8")
    assert values(stream.read_posts(spark, merged), "url") == ["https://p/1", *[f"u{i}" for i in range(1, 9)]]


def test_daily_run_renders_only_what_changed(spark, tmp_path):
    store = runs.Store(sources(spark, (1, "Some Blog", "Data", 5, "active")), posts(spark, (1, 1, "Old", NOW, "Ann Lee")),
                       summaries(spark, (1, "text", ["a"])), letters(spark))
    feeds = spark.createDataFrame([(1, "u", NOW, feed(("New", "https://n/1", "Bo Li", NOW)))], FEEDS)
    first = runs.run_daily(store, feeds.limit(0), str(tmp_path / "one"), as_of(), stop_on_failed_checks=False)
    second = runs.run_daily(
        first.store, feeds, str(tmp_path / "two"), as_of(), published_notes=first.written["notes"],
        published_fingerprints=first.written["note_fingerprints"], stop_on_failed_checks=False)
    assert values(second.written["note_changes"]) == [
        ("authors/ann-lee.md", "unchanged"), ("authors/bo-li.md", "added"), ("posts/data/new.md", "added"),
        ("posts/data/old.md", "unchanged"), ("sources/some-blog.md", "changed")]
    whole = notes.all_notes(*[second.written[name] for name in ("mart_posts", "mart_sources", "mart_authors")])
    assert values(second.written["notes"].select(*whole.columns)) == values(whole)
