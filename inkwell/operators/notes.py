"""Markdown notes for posts, sources and authors, as a table of their pieces.

A note's text is the contents of its rows in the order of ``part``: part 0 is the head, and each link of a source or
author note to one of its posts is a row of its own, from part 1. So the shape never depends on the number of links, and
no source or author, however many posts it has, has to fit into one row or one task.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from inkwell.functions.text import or_default, printed, python_timestamp, title_slug
from inkwell.operators.skew import with_position
from inkwell.operators.slugs import flat_slugs, last_writer, post_slugs
from inkwell.schemas import NOTES, column_names
from inkwell.session import cut_lineage
from inkwell.sources.tables import POST_COLUMNS

NO_SOURCE_POSTS, NO_AUTHOR_POSTS = "_No posts from this source yet._\n", "_No posts by this author yet._\n"


class Marts(NamedTuple):
    """The models that notes are made from."""

    posts: DataFrame
    sources: DataFrame
    authors: DataFrame


class NoteChanges(NamedTuple):
    changes: DataFrame  # path, change: added, removed, changed or unchanged
    rendered: DataFrame  # the notes that are added or may have changed


def _text(*pieces: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in pieces])


def _links(names: Column) -> Column:
    return F.array_join(F.transform(names, lambda n: _text("- [[", printed(n), "]]\n")), "")


def _section(links: Column, empty: str) -> Column:
    return or_default(links, F.lit(empty))


def _newest_first() -> list[Column]:
    """The order in which posts are written and listed; undated ones lead."""
    return [F.desc_nulls_first("publication_date"), F.asc("id")]


def _post_content() -> Column:
    author = or_default("author_name", "Unknown")
    source = printed("source_name")
    tags = F.coalesce(F.col("tags"), F.array().cast("array<string>"))
    # The layout of a post note. The status is the escape sequence, not the sign itself.
    return _text(
        "---\nuid: ", printed("id"),
        '\nsource: "[[', source,
        ']]"\nauthor: "[[', author,
        ']]"\ndate: ', printed("publication_date"),
        "\ntags: [", F.array_join(tags, ", ", "None"),
        "]\ncategory: ", printed("category"),
        "\nurl: ", printed("url"),
        '\nstatus: "\\U0001F331 Seedling"\n---\n\n# ', printed("title"),
        "\n\n## AI Summary\n", or_default("summary_text", "_No summary available yet._"),
        "\n\n## Topics\n", _section(_links(tags), "_No topics tagged yet._\n"),
        "\n## Source\n- Blog: [[", source,
        "]]\n- Author: [[", author,
        "]]\n- Original: [Read Full Post](", printed("url"), ")\n",
    )


def render_post(slugged: DataFrame) -> DataFrame:
    """Note text of posts that have slug and path."""
    return slugged.select(
        F.lit("post").alias("note_type"), "path", "slug", F.lit(0).alias("part"), _post_content().alias("content")
    )


def _written_last_first() -> list[Column]:
    return [F.asc_nulls_last("publication_date"), F.desc("id")]


def post_notes(mart_posts: DataFrame) -> DataFrame:
    """One note per path; equal titles in one category leave the note of the post written last."""
    slugged = post_slugs(mart_posts.select(*POST_COLUMNS))
    return render_post(last_writer(slugged, _written_last_first()))


def post_notes_for(ids: DataFrame, mart_posts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Notes of single posts under their plain slugs, and the requested ids that have no post."""
    wanted = ids.select("id").distinct()
    posts = mart_posts.select(*POST_COLUMNS).join(wanted, "id", "left_semi")
    path = F.concat(F.lit("posts/"), title_slug("category"), F.lit("/"), F.col("slug"), F.lit(".md"))
    notes = render_post(posts.withColumn("slug", title_slug("title")).withColumn("path", path))
    return notes, wanted.join(mart_posts.select("id"), "id", "left_anti")


def _with_links(heads: DataFrame, note_type: str, posts: DataFrame, key: str, empty: str) -> DataFrame:
    """Heads (key, path, slug, head) as part 0, and a row for each post of the key, newest first.

    Only ids and dates are put in order; titles join the numbered rows. A head without posts ends with ``empty``.
    """
    linked = posts.filter(F.col(key).isNotNull()).select(F.col(key).alias("key"), "id", "publication_date")
    placed = with_position(linked, ["key"], _newest_first())
    some = placed.filter("position = 0").select("key", F.lit(True).alias("_some"))
    first = heads.join(some, "key", "left").select(
        F.lit(note_type).alias("note_type"), "path", "slug", F.lit(0).alias("part"),
        F.concat("head", F.when(F.col("_some"), "").otherwise(empty)).alias("content"),
    )
    lines = placed.join(posts.select("id", "title"), "id").join(heads.select("key", "path", "slug"), "key").select(
        F.lit(note_type).alias("note_type"), "path", "slug", (F.col("position") + 1).cast("int").alias("part"),
        _text("- [[", printed("title"), "]]\n").alias("content"),
    )
    return first.unionByName(lines)


def _source_heads(mart_sources: DataFrame) -> DataFrame:
    """(key, path, slug, head) of the source notes."""
    slugged = last_writer(
        flat_slugs(mart_sources, "name", "sources"), [F.desc_nulls_first("name"), F.desc("id")]
    )
    name, category, feed, status = (printed(c) for c in ("name", "category", "rss_feed_url", "status"))
    count, latest = printed("total_post_count"), F.coalesce(F.col("latest_post_date").cast("string"), F.lit("N/A"))
    # The layout of a source note.
    head = _text(
        "---\nname: ", name,
        "\ncategory: ", category,
        "\nrss_url: ", feed,
        "\ntotal_post_count: ", count,
        "\nstatus: ", status,
        "\n---\n\n# ", name,
        "\n\n## Source Info\n- Category: ", category,
        "\n- RSS Feed: ", feed,
        "\n- Total Posts: ", count,
        "\n- Latest Post: ", latest,
        "\n- Status: ", status,
        "\n\n## Posts\n",
    )
    return slugged.select(F.col("id").alias("key"), "path", "slug", head.alias("head"))


def source_notes(mart_sources: DataFrame, mart_posts: DataFrame) -> DataFrame:
    """One note per source name with links to all its posts."""
    return _with_links(_source_heads(mart_sources), "source", mart_posts, "source_id", NO_SOURCE_POSTS)


def author_sources(mart_posts: DataFrame, mart_sources: DataFrame) -> DataFrame:
    """Distinct (author_id, source) pairs of posts whose source exists."""
    pairs = mart_posts.filter("author_id is not null and source_id is not null").select("author_id", "source_id")
    names = mart_sources.select(F.col("id").alias("source_id"), F.col("name").alias("source_name"))
    return pairs.distinct().join(names, "source_id")


def _author_heads(mart_authors: DataFrame, mart_posts: DataFrame, mart_sources: DataFrame) -> DataFrame:
    """(key, path, slug, head) of the author notes."""
    named = mart_authors.filter(F.coalesce("author_name", F.lit("")) != "")
    slugged = last_writer(flat_slugs(named, "author_name", "authors"), [F.desc("author_name")])
    # bounded by the number of sources, like the author's source_ids themselves
    listed = author_sources(mart_posts, mart_sources).groupBy("author_id").agg(
        F.sort_array(F.collect_list(F.struct("source_id", "source_name"))).alias("listed")
    )
    name = printed("author_name")
    category, count = or_default("primary_category", "Uncategorized"), printed("post_count")
    names = F.transform("listed", lambda s: s["source_name"])
    # The layout of an author note.
    head = _text(
        "---\nname: ", name,
        "\nprimary_category: ", category,
        "\npost_count: ", count,
        "\n---\n\n# ", name,
        "\n\n## Author Info\n- Primary Category: ", category,
        "\n- Total Posts: ", count,
        "\n- First Seen: ", python_timestamp("first_seen_at"),
        "\n- Last Seen: ", python_timestamp("last_seen_at"),
        "\n\n## Sources\n", _section(_links(names), "_No sources linked._\n"),
        "\n## Posts\n",
    )
    return slugged.join(listed, "author_id", "left").select(
        F.col("author_id").alias("key"), "path", "slug", head.alias("head")
    )


def author_notes(mart_authors: DataFrame, mart_posts: DataFrame, mart_sources: DataFrame) -> DataFrame:
    """One note per author with the sources written for and links to all posts. Nameless authors have none."""
    heads = _author_heads(mart_authors, mart_posts, mart_sources)
    return _with_links(heads, "author", mart_posts, "author_id", NO_AUTHOR_POSTS)


def all_notes(mart_posts: DataFrame, mart_sources: DataFrame, mart_authors: DataFrame) -> DataFrame:
    """The notes of all three kinds."""
    return (
        post_notes(mart_posts)
        .unionByName(source_notes(mart_sources, mart_posts))
        .unionByName(author_notes(mart_authors, mart_posts, mart_sources))
        .select(*column_names(NOTES))
    )


def note_stats(mart_posts: DataFrame, mart_sources: DataFrame, mart_authors: DataFrame) -> DataFrame:
    """Notes written per kind, the files they leave, and the total over all kinds."""
    kinds = [
        ("post", post_slugs(mart_posts.select("id", "title", "category"))),
        ("source", flat_slugs(mart_sources, "name", "sources")),
        ("author", flat_slugs(mart_authors.filter("author_name <> ''"), "author_name", "authors")),
    ]
    paths = [rows.select(F.lit(kind).alias("note_type"), "path") for kind, rows in kinds]
    per_path = paths[0].unionAll(paths[1]).unionAll(paths[2]).groupBy("note_type", "path").count()
    return per_path.rollup("note_type").agg(
        F.sum("count").alias("generated"), F.count(F.lit(1)).alias("files"),
    ).withColumn("note_type", F.coalesce("note_type", F.lit("total")))


def write_notes(notes: DataFrame, path: str) -> None:
    """Notes to a new folder, one sub-folder per kind. Rows of a note may be in several files; part tells their order."""
    notes.write.mode("errorifexists").partitionBy("note_type").parquet(path)


def changed_notes(notes: DataFrame, published: DataFrame) -> DataFrame:
    """Per path: added, removed, changed or unchanged against the notes published before."""

    def digests(rows: DataFrame, name: str) -> DataFrame:
        return rows.select("path", "part", F.sha2("content", 256).alias(name))

    both = digests(notes, "_new").join(digests(published, "_old"), ["path", "part"], "full_outer")
    per_path = both.groupBy("path").agg(
        F.count("_new").alias("_in_new"),
        F.count("_old").alias("_in_old"),
        F.bool_and(F.col("_new").eqNullSafe(F.col("_old"))).alias("_same"),
    )
    status = (
        F.when(F.col("_in_old") == 0, "added").when(F.col("_in_new") == 0, "removed")
        .when(F.col("_same"), "unchanged").otherwise("changed")
    )
    return per_path.select("path", status.alias("change"))


def note_fingerprints(marts: Marts) -> DataFrame:
    """(note_type, key, path, slug, fingerprint) per note, without rendering any link: equal fingerprints mean equal notes.

    A post's is the digest of its text, made where the post is; of a source or author it is that of the head and of all
    its posts' ids, dates and titles, summed in any order, as ids and dates decide the order of the links. It may differ
    though the text does not, for one when a date changes and no place. Kept beside published notes it tells later which
    of them to render.
    """
    digests = marts.posts.select("id", "title", "category", "publication_date", F.md5(_post_content()).alias("fingerprint"))
    posts = last_writer(post_slugs(digests), _written_last_first()).select(
        F.lit("post").alias("note_type"), F.col("id").cast("string").alias("key"), "path", "slug", "fingerprint")

    def linked(heads: DataFrame, note_type: str, key: str) -> DataFrame:
        place = [F.col(c) for c in ("id", "publication_date", "title")]
        links = marts.posts.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(
            F.count(F.lit(1)).alias("_links"), F.sum(F.xxhash64(*place).cast("decimal(38,0)")).alias("_sum"),
            F.bit_xor(F.xxhash64(F.lit("second"), *place)).alias("_xor"))
        digest = F.md5(F.concat_ws("\n", "head", "_links", "_sum", "_xor"))
        return heads.join(links, "key", "left").select(
            F.lit(note_type).alias("note_type"), F.col("key").cast("string").alias("key"), "path", "slug", digest.alias("fingerprint"))

    sources = linked(_source_heads(marts.sources), "source", "source_id")
    return posts.unionByName(sources).unionByName(linked(_author_heads(marts.authors, marts.posts, marts.sources), "author", "author_id"))


def notes_at(wanted: DataFrame, marts: Marts) -> DataFrame:
    """The notes of some rows of :func:`note_fingerprints`; posts and links of other notes are not rendered."""

    def of(note_type: str, kind: str) -> DataFrame:
        return wanted.filter(F.col("note_type") == note_type).select(F.col("key").cast(kind).alias("key"), "path", "slug")

    placed = of("post", "bigint").withColumnRenamed("key", "id")
    made = [render_post(marts.posts.select(*POST_COLUMNS).join(placed, "id"))]
    for note_type, kind, heads, key, empty in (
        ("source", "bigint", _source_heads(marts.sources), "source_id", NO_SOURCE_POSTS),
        ("author", "string", _author_heads(marts.authors, marts.posts, marts.sources), "author_id", NO_AUTHOR_POSTS),
    ):
        some = of(note_type, kind)
        posts = marts.posts.join(some.select(F.col("key").alias(key)), key, "left_semi")
        made.append(_with_links(heads.join(some.select("path"), "path", "left_semi"), note_type, posts, key, empty))
    return made[0].unionByName(made[1]).unionByName(made[2]).select(*column_names(NOTES))


def note_changes(
    marts: Marts, published: DataFrame, published_notes: Callable[[DataFrame], DataFrame], fingerprints: DataFrame | None = None
) -> NoteChanges:
    """What to publish, given the fingerprints of what is ``published``: notes are rendered only where they differ.

    ``published_notes`` gives the published notes at some paths (note_type, key, path, slug), in daily use a semi join
    with the stored ones; they decide whether a note with another fingerprint has another text. ``fingerprints`` are
    those of ``marts``, where they are written already.
    """
    if fingerprints is None:
        fingerprints = note_fingerprints(marts)
    old = published.select("path", F.col("fingerprint").alias("_old"), F.struct("note_type", "key", "slug").alias("_published"))
    both = fingerprints.join(old, "path", "full_outer")
    change = (
        F.when(F.col("_old").isNull(), "added").when(F.col("fingerprint").isNull(), "removed")
        .when(F.col("fingerprint") == F.col("_old"), "unchanged")
    )
    both = cut_lineage(both.select("path", change.alias("change"), "note_type", "key", "slug", "_published"))
    place = ["note_type", "key", "path", "slug"]
    rendered = cut_lineage(notes_at(both.filter("change = 'added' or change is null").select(*place), marts))
    unsure = both.filter("change is null")
    before = published_notes(unsure.select("_published.note_type", "_published.key", "path", "_published.slug"))
    decided = changed_notes(rendered.join(unsure.select("path"), "path", "left_semi"), before)
    return NoteChanges(both.filter("change is not null").select("path", "change").unionByName(decided), rendered)
