import hashlib
from datetime import date

from pyspark.sql import functions as F

from helpers import NOW, mart_authors, mart_post, mart_posts, mart_sources, values
from inkwell.operators import note_checks, notes, slugs


def content(df):
    return df.first()["content"]


def texts(df):
    """Path to text: the contents of a note's rows in the order of part."""
    found = {}
    for row in df.orderBy("path", "part").collect():
        found[row["path"]] = found.get(row["path"], "") + row["content"]
    return found


def test_post_note_text(spark):
    note = notes.post_notes(mart_posts(spark, mart_post(7, "Big Data: why?"))).first()
    assert (note["note_type"], note["path"], note["slug"], note["part"]) == (
        "post", "posts/data/big-data-why.md", "big-data-why", 0)
    assert note["content"] == r'''---
uid: 7
source: "[[Some Blog]]"
author: "[[Ann Lee]]"
date: 2024-01-30
tags: [spark, sql]
category: Data
url: https://p/7
status: "\U0001F331 Seedling"
---

# Big Data: why?

## AI Summary
What it says.

## Topics
- [[spark]]
- [[sql]]

## Source
- Blog: [[Some Blog]]
- Author: [[Ann Lee]]
- Original: [Read Full Post](https://p/7)
'''


def test_post_note_defaults(spark):
    text = content(notes.post_notes(mart_posts(spark, mart_post(
        1, author_name="", publication_date=None, summary_text=None, tags=None, category=None, source_name=None))))
    assert "date: None\ntags: []\ncategory: None\n" in text
    assert 'author: "[[Unknown]]"' in text and 'source: "[[None]]"' in text
    assert "## AI Summary\n_No summary available yet._\n\n## Topics\n_No topics tagged yet._\n\n## Source\n" in text


def test_colliding_titles_get_hashes_whatever_their_category(spark):
    frame = mart_posts(spark, mart_post(1, "Hello World!!!"), mart_post(2, "Hello World???", category="Web"),
                       mart_post(3, "Other"), mart_post(4, "???"), mart_post(5, None, category=None))
    got = {r["id"]: r["path"] for r in slugs.post_slugs(frame).collect()}

    def digest(title):
        return hashlib.md5(title.encode()).hexdigest()[:6]

    assert got == {
        1: f"posts/data/hello-world-{digest('Hello World!!!')}.md", 2: f"posts/web/hello-world-{digest('Hello World???')}.md",
        3: "posts/data/other.md", 4: f"posts/data/{digest('???')}.md", 5: f"posts/untitled/{digest('')}.md"}


def test_equal_titles_leave_the_post_written_last(spark):
    days = [date(2024, 1, 3), date(2024, 1, 1), None, date(2024, 1, 1)]
    frame = mart_posts(spark, *[mart_post(i, "Same", publication_date=d) for i, d in enumerate(days)])
    assert "uid: 3\n" in content(notes.post_notes(frame))  # oldest day, highest id
    assert values(slugs.overwritten(slugs.post_slugs(frame)), "overwritten") == [3]


def test_notes_for_single_posts(spark):
    frame = mart_posts(spark, mart_post(1, "Same"), mart_post(2, "Same"))
    found, missing = notes.post_notes_for(spark.createDataFrame([(2,), (9,)], "id BIGINT"), frame)
    assert values(found, "path") == ["posts/data/same.md"]
    assert values(missing) == [9]


def test_source_note_text(spark):
    sources = mart_sources(spark, (1, "Some Blog", 5, "active", 3, NOW, NOW), (2, "Empty", 5, "inactive", 0, NOW, NOW))
    posts = mart_posts(spark, mart_post(1, "Old", publication_date=date(2024, 1, 1)), mart_post(3, "Undated", publication_date=None),
                       mart_post(2, "New"), mart_post(4, "Lost", source_id=None))
    got = texts(notes.source_notes(sources, posts))
    assert got["sources/some-blog.md"] == '''---
name: Some Blog
category: Data
rss_url: https://s1/feed
total_post_count: 3
status: active
---

# Some Blog

## Source Info
- Category: Data
- RSS Feed: https://s1/feed
- Total Posts: 3
- Latest Post: 2024-01-30
- Status: active

## Posts
- [[Undated]]
- [[New]]
- [[Old]]
'''
    assert got["sources/empty.md"].endswith("- Latest Post: N/A\n- Status: inactive\n\n## Posts\n_No posts from this source yet._\n")


def test_each_link_is_a_row_of_its_own(spark):
    sources = mart_sources(spark, (1, "Some Blog", 5, "active", 10, NOW, NOW))
    posts = mart_posts(spark, *[mart_post(i, f"P{i}", publication_date=date(2024, 1, 1 + i % 4)) for i in range(10)])
    rows = notes.source_notes(sources, posts).orderBy("part").collect()
    assert [r["part"] for r in rows] == list(range(11))
    assert [r["content"] for r in rows[1:]] == [f"- [[P{i}]]\n" for i in (3, 7, 2, 6, 1, 5, 9, 0, 4, 8)]


def test_names_in_other_scripts_keep_their_notes_and_links_to_them_are_checked(spark):
    names = ["北京作者", "كاتب", "लेखक", "作者北京"]
    authors = mart_authors(spark, *[(f"a{i}", name, 1, "Data") for i, name in enumerate(names)])
    sources = mart_sources(spark, *[(i, name, 5, "active", 1, NOW, NOW) for i, name in enumerate(names)])
    posts = mart_posts(spark, mart_post(1, "X", author_name="北京作者", source_name="كاتب"),
                       mart_post(2, "Y", author_name="不在這裡", source_name="लेखक"))
    rendered = notes.all_notes(posts, sources, authors)
    assert rendered.filter("note_type = 'author' and part = 0").select("path").distinct().count() == 4
    assert rendered.filter("note_type = 'source' and part = 0").select("path").distinct().count() == 4
    assert values(note_checks.note_failures(rendered), "path", "field") == [("posts/data/y.md", "author")]


def test_author_note_text(spark):
    authors = mart_authors(spark, ("a1", "Ann Lee", 2, "Data"), ("a2", "Bo", 1, None), ("a3", "", 1, None), ("a4", None, 1, None))
    sources = mart_sources(spark, (2, "B Blog", 5, "active", 1, NOW, NOW), (1, "Some Blog", 5, "active", 1, NOW, NOW))
    posts = mart_posts(spark, mart_post(1, "X"), mart_post(2, "Y", source_id=2), mart_post(3, "Z", source_id=77))
    got = texts(notes.author_notes(authors, posts, sources))
    assert got["authors/ann-lee.md"] == '''---
name: Ann Lee
primary_category: Data
post_count: 2
---

# Ann Lee

## Author Info
- Primary Category: Data
- Total Posts: 2
- First Seen: 2024-01-02 03:04:05+00:00
- Last Seen: 2024-01-06 07:08:09.000120+00:00

## Sources
- [[Some Blog]]
- [[B Blog]]

## Posts
- [[X]]
- [[Y]]
- [[Z]]
'''
    assert set(got) == {"authors/ann-lee.md", "authors/bo.md"}
    assert "primary_category: Uncategorized" in got["authors/bo.md"]
    assert got["authors/bo.md"].endswith("## Sources\n_No sources linked._\n\n## Posts\n_No posts by this author yet._\n")


def test_stats_write_and_changes(spark, tmp_path):
    posts = mart_posts(spark, mart_post(1, "X"), mart_post(2, "X"), mart_post(3, "Y"))
    sources = mart_sources(spark, (1, "Some Blog", 5, "active", 1, NOW, NOW))
    authors = mart_authors(spark, ("a1", "Ann Lee", 2, "Data"))
    assert values(notes.note_stats(posts, sources, authors)) == [
        ("author", 1, 1), ("post", 3, 2), ("source", 1, 1), ("total", 5, 4)]
    rendered = notes.all_notes(posts, sources, authors)
    notes.write_notes(rendered, str(tmp_path / "notes"))
    back = spark.read.schema(rendered.schema).parquet(str(tmp_path / "notes"))
    assert values(back, "path", "content") == values(rendered, "path", "content")
    published = rendered.filter("note_type <> 'source'").withColumn(
        "content", F.when(F.col("path").contains("posts/data/y"), "old").otherwise(F.col("content"))
    ).unionByName(rendered.limit(1).withColumn("path", F.lit("posts/gone.md")))
    got = dict(values(notes.changed_notes(back, published)))
    assert got["posts/gone.md"] == "removed" and got["posts/data/y.md"] == "changed"
    assert got["sources/some-blog.md"] == "added" and got["authors/ann-lee.md"] == "unchanged"


def two_states(spark):
    """Marts before and after: a new post, a changed summary, a changed date that moves no link, a changed rating, a renamed
    source, a post that is gone, a title that now collides."""
    day = date(2024, 1, 10)
    old_posts = [
        mart_post(1, "One"), mart_post(2, "Two", publication_date=day), mart_post(3, "Three", source_id=2, author_id="a2", author_name="Bo Li"),
        mart_post(4, "Four", source_id=2, author_id="a2", author_name="Bo Li"), mart_post(5, "Five", summary_text=""),
        mart_post(6, "Six", source_id=3, author_id="a3", author_name="Cy Fox"), mart_post(8, "Eight", source_id=4, author_id=None),
    ]
    new_posts = [
        mart_post(1, "One", summary_text="Another."), mart_post(2, "Two", publication_date=date(2024, 1, 11)), old_posts[2],
        mart_post(5, "Five", summary_text=None), mart_post(6, "Six", source_id=3, author_id="a3", author_name="Cy Fox"),
        mart_post(7, "Seven", source_id=2, author_id="a2", author_name="Bo Li"), mart_post(8, "Eight", source_id=4, author_id=None),
        mart_post(9, "eight!", source_id=4, author_id=None),
    ]
    sources_ = [(1, "Some Blog", 5, "active", 3, NOW, NOW), (2, "Second", 5, "active", 2, NOW, NOW), (3, "Third", 5, "active", 1, NOW, NOW),
                (4, "Fourth", 5, "active", 1, NOW, NOW)]
    new_sources = [sources_[0], sources_[1], (3, "Third Renamed", 5, "active", 1, NOW, NOW), sources_[3]]
    authors_ = [("a1", "Ann Lee", 3, "Data"), ("a2", "Bo Li", 2, "Data"), ("a3", "Cy Fox", 1, "Data")]
    before = notes.Marts(mart_posts(spark, *old_posts), mart_sources(spark, *sources_), mart_authors(spark, *authors_))
    after = notes.Marts(mart_posts(spark, *new_posts), mart_sources(spark, *new_sources), mart_authors(spark, *authors_))
    return before, after


def test_note_changes_by_fingerprints_agree_with_whole_texts(spark):
    before, after = two_states(spark)
    asked = []

    def published(some):
        asked.extend(values(some, "path"))
        return notes.notes_at(some, before)

    found = notes.note_changes(after, notes.note_fingerprints(before), published)
    want = notes.changed_notes(notes.all_notes(*after), notes.all_notes(*before))
    assert values(found.changes) == values(want)
    kinds = dict(values(want))
    assert {"added", "removed", "changed", "unchanged"} == set(kinds.values())
    paths = set(values(found.rendered, "path"))
    assert {p for p, c in kinds.items() if c in ("added", "changed")} <= paths
    # rendered and compared although nothing changed: a date that moves no link
    assert kinds["sources/some-blog.md"] == "unchanged" and "sources/some-blog.md" in asked
    assert kinds["authors/cy-fox.md"] == "changed"  # it lists the source that has another name now
    assert not paths & {"posts/data/three.md", "posts/data/five.md", "posts/data/six.md"}
    whole = notes.all_notes(*after)
    assert values(found.rendered) == [r for r in values(whole) if r[1] in paths]


def test_same_marts_render_nothing(spark):
    before, _ = two_states(spark)
    found = notes.note_changes(before, notes.note_fingerprints(before), lambda some: notes.notes_at(some, before))
    assert found.rendered.isEmpty() and set(values(found.changes, "change")) == {"unchanged"}
    assert values(notes.note_fingerprints(before), "path") == values(notes.all_notes(*before).filter("part = 0"), "path")


def test_notes_at_all_places_are_all_notes(spark):
    before, _ = two_states(spark)
    assert values(notes.notes_at(notes.note_fingerprints(before), before)) == values(notes.all_notes(*before))
