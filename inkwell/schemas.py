"""Explicit schemas, as DDL text, of the raw tables and of the feed documents."""

from __future__ import annotations


def column_names(ddl: str) -> list[str]:
    """Column names of a flat schema text."""
    return [field.split()[0] for field in ddl.split(", ")]


BLOG_SOURCES = (
    "id BIGINT, rss_feed_url STRING, name STRING, category STRING, quality_rating INT, status STRING, "
    "last_checked_at TIMESTAMP, created_at TIMESTAMP, updated_at TIMESTAMP"
)
BLOG_POSTS = (
    "id BIGINT, source_id BIGINT, title STRING, body STRING, url STRING, publication_date TIMESTAMP, "
    "author_name STRING, created_at TIMESTAMP"
)
AI_SUMMARIES = (
    "id BIGINT, post_id BIGINT, summary_text STRING, tags ARRAY<STRING>, difficulty_classification STRING, "
    "raw_api_response STRING, created_at TIMESTAMP"
)
DEAD_LETTERS = (
    "id BIGINT, post_reference STRING, failure_stage STRING, failure_reason STRING, retry_count INT, "
    "created_at TIMESTAMP, last_retry_at TIMESTAMP, resolved BOOLEAN"
)
SEED_CSV = "name STRING, rss_feed_url STRING, blog_url STRING, category STRING, quality_rating INT"
FEEDS = "source_id BIGINT, rss_feed_url STRING, fetched_at TIMESTAMP, payload STRING"
ENTRIES = (
    "source_id BIGINT, title STRING, body STRING, url STRING, publication_date TIMESTAMP, author_name STRING"
)
NOTES = "note_type STRING, path STRING, slug STRING, part INT, content STRING"

# Feed documents. Only the elements that the entry columns are made of are declared, so the parser
# skips everything else. Namespaced names lose their prefix (option ignoreNamespace), and an element
# read as STRING keeps its inner markup. A damaged document is kept in _corrupt_record.
GUID = "STRUCT<_VALUE: STRING, _isPermaLink: STRING>"
RSS_ITEM_FIELDS = (
    f"title STRING, link ARRAY<STRING>, guid {GUID}, encoded STRING, summary STRING, description STRING, "
    "author STRING, creator STRING, pubDate STRING, date STRING, updated STRING"
)
RSS_FEED = f"channel STRUCT<item: ARRAY<STRUCT<{RSS_ITEM_FIELDS}>>>, _corrupt_record STRING"
ATOM_ENTRY_FIELDS = (
    "title STRING, link ARRAY<STRUCT<_href: STRING, _rel: STRING>>, content ARRAY<STRING>, summary STRING, "
    "author ARRAY<STRUCT<name: STRING>>, published STRING, updated STRING"
)
ATOM_FEED = f"entry ARRAY<STRUCT<{ATOM_ENTRY_FIELDS}>>, _corrupt_record STRING"
JSON_ITEM = (
    "STRUCT<url: STRING, external_url: STRING, title: STRING, content_html: STRING, content_text: STRING, "
    "summary: STRING, date_published: STRING, date_modified: STRING, author: STRUCT<name: STRING>, "
    "authors: ARRAY<STRUCT<name: STRING>>>"
)
JSON_FEED = f"items ARRAY<{JSON_ITEM}>, _corrupt_record STRING"
