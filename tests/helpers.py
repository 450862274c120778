"""Small frames for tests."""

from datetime import date, datetime

from pyspark.sql import functions as F

from inkwell.schemas import AI_SUMMARIES, BLOG_POSTS, BLOG_SOURCES, DEAD_LETTERS

NOW = datetime(2024, 1, 31, 12)


def as_of():
    return F.lit(NOW.isoformat(sep=" ")).cast("timestamp")


def values(df, *columns):
    """Rows as a sorted list of tuples (or of plain values for one column)."""
    columns = columns or df.columns
    rows = [tuple(r[c] for c in columns) for r in df.select(*columns).collect()]
    rows.sort(key=lambda r: tuple((v is None, str(v)) for v in r))
    return [r[0] for r in rows] if len(columns) == 1 else rows


def one(spark, expression, **inputs):
    """The value of one expression over one row."""
    schema = ", ".join(f"{k} STRING" for k in inputs) or "dummy STRING"
    row = tuple(inputs.values()) or (None,)
    return spark.createDataFrame([row], schema).select(expression.alias("x")).first()["x"]


def sources(spark, *rows):
    """(id, name, category, rating, status) to the sources table."""
    full = [(i, f"https://s{i}/feed", n, c, r, s, NOW, NOW, NOW) for i, n, c, r, s in rows]
    return spark.createDataFrame(full, BLOG_SOURCES)


def posts(spark, *rows):
    """(id, source_id, title, publication_date, author_name) to the posts table."""
    full = [(i, s, t, "body", f"https://p/{i}", p, a, NOW) for i, s, t, p, a in rows]
    return spark.createDataFrame(full, BLOG_POSTS)


def summaries(spark, *rows):
    """(post_id, text, tags) to the summaries table."""
    full = [(i, i, t, g, "beginner", None, NOW) for i, t, g in rows]
    return spark.createDataFrame(full, AI_SUMMARIES)


def letters(spark, *rows):
    """(id, reference, stage, resolved) to the dead-letter table."""
    full = [(i, r, s, "first reason", 1, datetime(2024, 1, i), None, done) for i, r, s, done in rows]
    return spark.createDataFrame(full, DEAD_LETTERS)


MART_POSTS = (
    "id BIGINT, source_id BIGINT, source_name STRING, category STRING, title STRING, body STRING, url STRING, "
    "author_name STRING, author_id STRING, publication_date DATE, post_slug STRING, summary_text STRING, "
    "tags ARRAY<STRING>, difficulty_classification STRING, is_low_quality BOOLEAN, created_at TIMESTAMP"
)


def mart_post(id, title="A title", **changes):
    row = {
        "id": id, "source_id": 1, "source_name": "Some Blog", "category": "Data", "title": title, "body": "text",
        "url": f"https://p/{id}", "author_name": "Ann Lee", "author_id": "a1", "publication_date": date(2024, 1, 30),
        "post_slug": "a-title", "summary_text": "What it says.", "tags": ["spark", "sql"],
        "difficulty_classification": "beginner", "is_low_quality": False, "created_at": NOW,
    }
    return tuple((row | changes).values())


def mart_posts(spark, *rows):
    return spark.createDataFrame(list(rows), MART_POSTS)


MART_SOURCES = (
    "id BIGINT, name STRING, rss_feed_url STRING, category STRING, quality_rating INT, status STRING, "
    "last_checked_at TIMESTAMP, total_post_count BIGINT, latest_post_date DATE, created_at TIMESTAMP, "
    "updated_at TIMESTAMP"
)


def mart_sources(spark, *rows):
    """(id, name, rating, status, posts, created_at, last_checked_at)."""
    full = [(i, n, f"https://s{i}/feed", "Data", r, s, k, p, date(2024, 1, 30) if p else None, c, NOW)
            for i, n, r, s, p, c, k in rows]
    return spark.createDataFrame(full, MART_SOURCES)


MART_AUTHORS = (
    "author_id STRING, author_name STRING, post_count BIGINT, source_ids ARRAY<BIGINT>, first_seen_at TIMESTAMP, "
    "last_seen_at TIMESTAMP, primary_category STRING"
)


def mart_authors(spark, *rows):
    """(author_id, author_name, post_count, primary_category)."""
    full = [(i, n, k, [1], datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 6, 7, 8, 9, 120), c) for i, n, k, c in rows]
    return spark.createDataFrame(full, MART_AUTHORS)


def plan(df):
    """Physical plan of a frame as it stands before it runs."""
    return df.select("*")._jdf.queryExecution().executedPlan().toString()
