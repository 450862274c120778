"""The raw tables of the curation model, derived from the star-schema test tables.

Each function reads its whole input tables. ``AS_OF`` stands in for the wall clock.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from inkwell.functions.text import bind
from inkwell.operators.upsert import first_per_key
from inkwell.session import SETTINGS

AS_OF = datetime(2024, 1, 31, 12, 0, 0)
# The columns in use, so that opening a table neither infers a schema nor starts a job.
TABLES = {
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_orderpriority STRING",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING",
    "labels": "doc_id BIGINT, quality INT",
    "pages": "page_id BIGINT, html STRING",
}
OTHER_SCRIPTS = ["北京作者", "كاتب", "लेखक"]  # author names that have no spelling in ASCII
SNAPSHOT_DAYS = 5  # age of the "yesterday" tables that incremental operators start from


def as_of_column() -> Column:
    return F.lit(AS_OF.isoformat(sep=" ")).cast("timestamp")


def _before(hours: Column) -> Column:
    return F.timestamp_seconds(F.unix_timestamp(as_of_column()) - hours * 3600)


def once(build: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A method whose DataFrame is built once per object and argument."""

    @wraps(build)
    def cached(self, *args):
        key = (build.__name__, args)
        if key not in self.frames:
            self.frames[key] = build(self, *args)
        return self.frames[key]

    return cached


def _escaped(name: str) -> Column:
    """Column text for use in markup."""
    text = F.replace(F.col(name), F.lit("&"), F.lit("&amp;"))
    return F.replace(F.replace(text, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def _element(name: str, text: Column) -> Column:
    """An element, or nothing where the text is NULL."""
    return F.coalesce(F.concat(F.lit(f"<{name}>"), text, F.lit(f"</{name}>")), F.lit(""))


class RawTables:
    """Raw tables over one test-data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        spark.conf.set("spark.sql.session.timeZone", SETTINGS["spark.sql.session.timeZone"])
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.frames: dict = {}

    @once
    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    @once
    def sources(self) -> DataFrame:
        joined = self.table("nation").join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        key = F.col("n_nationkey").cast("long")
        return joined.select(
            key.alias("id"),
            F.concat(F.lit("https://src"), key, F.lit(".example.com/feed")).alias("rss_feed_url"),
            F.col("n_name").alias("name"),
            F.col("r_name").alias("category"),
            (1 + key % 5).cast("int").alias("quality_rating"),
            F.when(key % 7 == 6, "inactive").otherwise("active").alias("status"),
            _before(key % 6 * 24).alias("last_checked_at"),
            _before(key * 24).alias("created_at"),
            _before(key * 24).alias("updated_at"),
        )

    @once
    def entries(self, documents: DataFrame | None = None) -> DataFrame:
        """One feed entry per document, with ``arrival`` giving the order in which entries came in.

        ``documents`` may be a stream of the table instead.
        """
        documents = self.table("documents") if documents is None else documents
        doc = F.col("doc_id")
        name = F.col("p_name")
        author = (
            F.when(doc % 11 == 0, F.lit(None))
            .when(doc % 23 == 0, F.element_at(F.array(*map(F.lit, OTHER_SCRIPTS)), (doc % 3 + 1).cast("int")))
            .when(doc % 3 == 0, F.upper(name))
            .when(doc % 3 == 1, F.concat(F.lit("  "), name))
            .otherwise(F.concat(name, F.lit("  ")))
        )
        published = F.when(doc % 17 != 0, _before(doc % 14 * 24 + doc % 24))
        joined = documents.join(self.table("part"), F.col("p_partkey") == doc % 50, "left")
        return joined.select(
            doc.alias("arrival"),
            F.regexp_extract("source", r"([0-9]+)$", 1).cast("long").alias("source_id"),
            F.regexp_extract("text", r"^[^.\n|]*", 0).alias("title"),
            F.col("text").alias("body"),
            F.concat(F.lit("https://"), F.col("source"), F.lit(".example.com/post/"), F.md5("text")).alias("url"),
            published.alias("publication_date"),
            author.alias("author_name"),
            _before(doc % 14 * 24).alias("created_at"),
        )

    @once
    def posts(self) -> DataFrame:
        return first_per_key(self.entries(), ["url"], [F.col("arrival")]).select(
            F.col("arrival").alias("id"), "source_id", "title", "body", "url", "publication_date", "author_name",
            "created_at",
        )

    @once
    def summaries(self) -> DataFrame:
        doc = F.col("doc_id")
        joined = self.table("labels").join(self.table("documents"), "doc_id")
        words = r"([a-z]+)[^a-z]+([a-z]+)[^a-z]+([a-z]+)"
        found = bind(F.lower("text"), lambda t: F.array(*[F.regexp_extract(t, words, k) for k in (1, 2, 3)]))
        return joined.select(
            doc.alias("id"),
            doc.alias("post_id"),
            F.col("text").alias("summary_text"),
            F.when(doc % 6 == 0, F.array().cast("array<string>"))
            .otherwise(F.filter(found, lambda w: w != "")).alias("tags"),
            F.when(doc % 3 == 0, "beginner").when(doc % 3 == 1, "intermediate").otherwise("advanced")
            .alias("difficulty_classification"),
            F.lit(None).cast("string").alias("raw_api_response"),
            _before(doc % 7 * 24).alias("created_at"),
        )

    @once
    def dead_letters(self) -> DataFrame:
        """Failed items: a third per stage, some with a stage or reference nobody can process."""
        event, user = F.col("event_id"), F.col("user_id").cast("string")
        urls = self.entries().select(F.col("arrival").alias("doc_id"), "url")
        errors = self.table("events").filter("event_type = 'error'")
        stage = (
            F.when(event % 31 == 0, "publishing").when(event % 3 == 0, "summarization")
            .when(event % 3 == 1, "ingestion").otherwise("generation")
        )
        staged = errors.withColumn("failure_stage", stage)
        found = staged.join(
            urls, (F.col("failure_stage") == "ingestion") & (F.col("user_id") == F.col("doc_id")), "left"
        )
        reference = F.when(event % 29 == 0, F.concat(F.lit("post-"), user)).otherwise(F.coalesce("url", user))
        return found.select(
            event.alias("id"),
            reference.alias("post_reference"),
            "failure_stage",
            F.concat(F.lit("error code "), F.col("event_id") % 5).alias("failure_reason"),
            (event % 4).cast("int").alias("retry_count"),
            F.col("ts").cast("timestamp").alias("created_at"),
            F.lit(None).cast("timestamp").alias("last_retry_at"),
            (F.col("value") > 30).alias("resolved"),
        )

    @staticmethod
    def earlier(posts: DataFrame) -> DataFrame:
        """The posts table as it was ``SNAPSHOT_DAYS`` ago; it only holds posts that name an author."""
        return posts.filter(
            F.col("author_name").isNotNull() & (F.col("created_at") < _before(F.lit(SNAPSHOT_DAYS * 24)))
        )

    def earlier_posts(self) -> DataFrame:
        return self.earlier(self.posts())

    def pages(self) -> DataFrame:
        return self.table("pages")

    @once
    def feeds(self) -> DataFrame:
        """Feed documents of up to 100 entries each, in turn RSS, Atom and JSON; some are cut off before
        their last entry ends. Sources without entries have no payload or no feed row at all."""
        entries = self.entries().withColumn("batch", F.expr("arrival div 100"))
        url, title, body, author = (_escaped(c) for c in ("url", "title", "body", "author_name"))
        published = F.col("publication_date")
        rss = F.concat(
            F.lit("<item><title>"), title, F.lit("</title><link>"), url, F.lit("</link><description>"), body,
            F.lit("</description>"), _element("author", author),
            _element("pubDate", F.date_format(published, "EEE, d MMM yyyy HH:mm:ss 'GMT'")), F.lit("</item>"),
        )
        atom = F.concat(
            F.lit("<entry><title>"), title, F.lit('</title><link rel="self" href="self"/><link href="'), url,
            F.lit('"/><content type="html">'), body, F.lit("</content>"),
            F.coalesce(F.concat(F.lit("<author><name>"), author, F.lit("</name></author>")), F.lit("")),
            _element("published", F.date_format(published, "yyyy-MM-dd'T'HH:mm:ss'Z'")), F.lit("</entry>"),
        )
        json = F.to_json(F.struct(
            "title", "url", F.col("body").alias("content_text"),
            F.when(F.col("author_name").isNotNull(), F.array(F.struct(F.col("author_name").alias("name")))).alias("authors"),
            F.date_format(published, "yyyy-MM-dd'T'HH:mm:ssXXX").alias("date_published"),
        ))
        kind = F.col("batch") % 3
        item = F.when(kind == 0, rss).when(kind == 1, atom).otherwise(json)
        grouped = entries.select("source_id", "batch", F.struct("arrival", item.alias("item")).alias("e")).groupBy(
            "source_id", "batch"
        ).agg(F.transform(F.sort_array(F.collect_list("e")), lambda e: e["item"]).alias("items"))
        whole = (
            F.when(kind == 0, F.concat(F.lit('<rss version="2.0"><channel><title>t</title>'),
                                       F.array_join("items", ""), F.lit("</channel></rss>")))
            .when(kind == 1, F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom"><title>t</title>'),
                                      F.array_join("items", ""), F.lit("</feed>")))
            .otherwise(F.concat(F.lit('{"title": "t", "items": ['), F.array_join("items", ", "), F.lit("]}")))
        )
        tail = F.when(kind == 0, len("</item></channel></rss>")).when(kind == 1, len("</entry></feed>")).otherwise(len("}]}"))
        payload = F.when(F.col("batch") % 4 == 0, F.left(whole, F.length(whole) - tail)).otherwise(whole)
        fetched = grouped.select("source_id", "batch", payload.alias("payload"))
        silent = self.sources().select(F.col("id").alias("source_id")).join(
            entries.select("source_id").distinct(), "source_id", "left_anti"
        ).filter("source_id % 2 = 0").select("source_id", F.lit(0).alias("batch"), F.lit(None).cast("string").alias("payload"))
        return fetched.unionByName(silent).select(
            "source_id",
            F.concat(F.lit("https://src"), "source_id", F.lit(".example.com/feed")).alias("rss_feed_url"),
            _before(F.col("batch")).alias("fetched_at"),
            "payload",
        )

    def _listing(self, item: Column) -> DataFrame:
        """Listing pages of up to 25 entries per source; page_id numbers them."""
        entries = self.entries().withColumn("batch", F.expr("arrival div 500"))
        grouped = entries.select("source_id", "batch", F.struct("arrival", item.alias("item")).alias("e")).groupBy(
            "source_id", "batch"
        ).agg(F.transform(F.sort_array(F.collect_list("e")), lambda e: e["item"]).alias("items"))
        page_id = F.col("batch") * 100 + F.col("source_id")
        html = F.concat(F.lit('<html><body><a class="logo" href="/">Blog</a><p>All posts</p><ul>'),
                        F.array_join("items", "\n"), F.lit("</ul></body></html>"))
        return grouped.select(page_id.alias("page_id"), html.alias("html"))

    def card_pages(self) -> DataFrame:
        """Cards in turn with double, single and without quotes; in every other one the date stands before the link,
        every fifth has its tags in capitals, some leave out the paragraph's end tag."""
        quote = F.element_at(F.array(F.lit('"'), F.lit("'"), F.lit("")), (F.col("arrival") % 3 + 1).cast("int"))
        label = F.concat(F.lit('<div aria-label="Avatar of '), _escaped("author_name"), F.lit('"></div>'))
        day = _element("p", F.date_format("publication_date", "yyyy-MM-dd"))
        first = F.col("arrival") % 2 == 0
        day = F.when(~first & (F.col("arrival") % 7 == 0), F.replace(day, F.lit("</p>"), F.lit(""))).otherwise(day)
        card = F.concat(
            F.lit("<article>"), F.when(first, day).otherwise(""), F.lit("<a class="), quote, F.lit("card-title"), quote,
            F.lit(" href="), quote, F.lit("/post/"), F.md5("url"), F.lit("?a=1&amp;b=2"), quote, F.lit(">"), _escaped("title"),
            F.lit("</a><div class='avatars'>"), F.coalesce(label, F.lit("")), F.lit("</div>"),
            F.when(first, "").otherwise(day),
            F.lit("<div class='prose'><!-- lead --><b> "), _escaped("body"), F.lit(" </b></div></article>"),
        )
        capitals = card
        for tag in ("<a class", " href=", "</a>", "<p>", "</p>", "<div class", "<div aria-label", "</div>", "article>"):
            capitals = F.replace(capitals, F.lit(tag), F.lit(tag.upper()))
        return self._listing(F.when(F.col("arrival") % 5 == 0, capitals).otherwise(card))

    def entry_pages(self) -> DataFrame:
        """Every third item has lists of its own before the article, every fourth no end tag, every fifth capitals."""
        article = F.concat(
            F.lit("<article>"), _element("time", F.date_format("publication_date", "yyyy-MM-dd")),
            F.lit('<h2><a href="/post/'), F.md5("url"), F.lit('">'), _escaped("title"), F.lit("</a></h2></article>"),
        )
        inside = F.when(F.col("arrival") % 10 == 0, F.lit("<p>draft</p>")).otherwise(article)
        item = F.when(F.col("arrival") % 2 == 0, '<li class="wide blog-entry">').otherwise("<li class=blog-entry>")
        item = F.when(F.col("arrival") % 5 == 0, F.replace(item, F.lit("<li class"), F.lit("<LI CLASS"))).otherwise(item)
        tags = F.when(F.col("arrival") % 3 == 0, "<ol><li>one</li><li>two<ul><li>three</ul></ol>").otherwise("")
        ending = F.when(F.col("arrival") % 4 == 1, "").otherwise("</li>")
        return self._listing(F.concat(item, tags, inside, ending))

    @once
    def envelopes(self) -> DataFrame:
        """Provider messages for the labelled documents, in two layouts; some answers break a rule."""
        doc = F.col("doc_id")
        case = doc % 12
        good = F.to_json(F.struct(
            F.col("text").alias("summary"), F.array(F.lit("topic"), F.col("lang")).alias("tags"),
            F.lit("beginner").alias("difficulty"),
        ))
        answer = (
            F.when(case == 1, F.left(good, F.length(good) - 1))
            .when(case == 2, '{"summary": 5, "tags": ["a"], "difficulty": "beginner"}')
            .when(case == 3, '{"summary": "s", "tags": [], "difficulty": "beginner"}')
            .when(case == 4, '{"summary": "s", "tags": ["a"], "difficulty": "expert"}')
            .when(case == 5, '["summary"]')
            .when(case == 6, '{"summary": "s", "tags": [1, true, null, "x"], "difficulty": "advanced"}')
            .when(case == 7, '{"summary": "s", "tags": ["a"]}')
            .otherwise(good)
        )
        usage = F.struct(F.length("text").cast("long").alias("input_tokens"), F.lit(7).cast("long").alias("output_tokens"))
        message = F.struct(
            F.concat(F.lit("msg-"), doc).alias("id"), F.lit("m1").alias("model"),
            F.array(F.struct(F.lit("text").alias("type"), answer.alias("text"))).alias("content"), usage.alias("usage"),
        )
        choice = F.struct(
            F.concat(F.lit("cmpl-"), doc).alias("id"), F.lit("m2").alias("model"),
            F.array(F.struct(F.struct(answer.alias("content")).alias("message"))).alias("choices"),
        )
        joined = self.table("labels").join(self.table("documents"), "doc_id")
        return joined.select(
            doc.alias("post_id"), F.when(doc % 2 == 0, F.to_json(message)).otherwise(F.to_json(choice)).alias("envelope")
        )

    @once
    def catalogue(self) -> DataFrame:
        """A longer list of sources, one per customer."""
        key = F.col("c_custkey")
        return self.table("customer").select(
            key.alias("id"),
            F.concat(F.lit("https://blog"), key, F.lit(".example.com/feed")).alias("rss_feed_url"),
            F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("category"),
            (1 + key % 5).cast("int").alias("quality_rating"),
            F.when(key % 7 == 6, "inactive").otherwise("active").alias("status"),
            _before(key % 6 * 24).alias("last_checked_at"),
            _before(key % 30 * 24).alias("created_at"),
            _before(key % 30 * 24).alias("updated_at"),
        )

    @once
    def source_requests(self) -> DataFrame:
        """Requests to add sources, one per order; many repeat a feed URL or break a rule."""
        key, customer = F.col("o_orderkey"), F.col("o_custkey")
        return self.table("orders").select(
            key.alias("request_id"),
            F.when(key % 13 == 0, "\t ").otherwise(
                F.concat(F.lit("https://blog"), customer * 2, F.lit(".example.com/feed"))
            ).alias("rss_feed_url"),
            F.when(key % 17 == 0, "").otherwise(F.concat(F.lit("Blog "), customer)).alias("name"),
            F.when(key % 19 == 0, F.lit(None)).otherwise(F.col("o_orderpriority")).alias("category"),
            (key % 12).cast("int").alias("quality_rating"),
        )

    @once
    def source_changes(self) -> DataFrame:
        """Update requests, one per order, so most sources have several; some name no known source or break a rule."""
        key = F.col("o_orderkey")
        return self.table("orders").select(
            key.alias("request_id"),
            (F.col("o_custkey") + 100).alias("id"),
            F.when(key % 5 == 0, "  ").when(key % 5 == 1, F.concat(F.lit("Renamed "), key)).alias("name"),
            F.when(key % 4 == 0, (key % 12).cast("int")).when(key % 4 == 1, 9).alias("quality_rating"),
        )
