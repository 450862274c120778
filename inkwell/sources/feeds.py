"""Feed payloads (RSS, Atom, JSON Feed) to entry rows, with recovery of damaged documents."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from inkwell.functions.dates import feed_timestamp
from inkwell.functions.text import bind, or_default
from inkwell.operators.dead_letters import INGESTION, dead_letter_rows
from inkwell.schemas import ATOM_ENTRY_FIELDS, ATOM_FEED, JSON_FEED, JSON_ITEM, RSS_FEED, RSS_ITEM_FIELDS

XML_OPTIONS = {"ignoreNamespace": "true", "mode": "PERMISSIVE"}
ENTRY_FIELDS = ["title", "url", "body", "author", "published"]

MISSING, OK, DAMAGED, FAILED = "missing", "ok", "damaged", "failed"


class ParsedFeeds(NamedTuple):
    entries: DataFrame  # source_id, fetched_at, position in the feed, title, body, url, publication_date, author_name
    failures: DataFrame  # rows for the dead-letter table: one per feed that gave nothing
    status: DataFrame  # source_id, fetched_at, format, feed_status, entries_found


def arrival_order() -> list[Column]:
    """The order in which entries count as having come in: by source, fetch and position in the feed."""
    return [F.col("source_id"), F.col("fetched_at"), F.col("position")]


def _first_text(*candidates: Column) -> Column:
    """The first candidate that is neither NULL nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in candidates])


def _entry(title: Column, url: Column, body: Column, author: Column, published: Column) -> Column:
    parts = zip(ENTRY_FIELDS, (title, url, body, author, published))
    return F.struct(*[c.alias(n) for n, c in parts])


def _rss_entry(item: Column) -> Column:
    guid = F.when(F.coalesce(item["guid"]["_isPermaLink"], F.lit("true")) == "true", item["guid"]["_VALUE"])
    link = F.try_element_at(F.filter(item["link"], lambda x: x != ""), F.lit(1))
    return _entry(
        item["title"],
        _first_text(link, guid),
        _first_text(item["encoded"], item["summary"], item["description"]),
        _first_text(item["author"], item["creator"]),
        _first_text(item["pubDate"], item["date"], item["updated"]),
    )


def _atom_entry(item: Column) -> Column:
    pages = F.filter(item["link"], lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate")
    return _entry(
        item["title"],
        F.try_element_at(pages, F.lit(1))["_href"],
        _first_text(F.try_element_at(item["content"], F.lit(1)), item["summary"]),
        F.try_element_at(item["author"], F.lit(-1))["name"],
        _first_text(item["published"], item["updated"]),
    )


def _json_entry(item: Column) -> Column:
    return _entry(
        item["title"],
        _first_text(item["url"], item["external_url"]),
        _first_text(item["content_html"], item["content_text"], item["summary"]),
        _first_text(item["author"]["name"], F.try_element_at(item["authors"], F.lit(1))["name"]),
        _first_text(item["date_published"], item["date_modified"]),
    )


def _whole_elements(payload: Column, name: str, fields: str) -> Column:
    """The complete ``name`` elements of a document that does not parse as a whole."""
    pieces = F.regexp_extract_all(payload, F.lit(rf"(?s)(<{name}[ \t\r\n>].*?</{name}\s*>)"), F.lit(1))
    parsed = F.transform(pieces, lambda p: F.from_xml(p, f"{fields}, _corrupt_record STRING", XML_OPTIONS))
    return F.filter(parsed, lambda p: p["_corrupt_record"].isNull())


JSON_STRING = r'"(?:[^"\\]++|\\.)*+"'
DEEPEST = 12  # objects within objects


def _object(depth: int) -> str:
    """Pattern of a JSON object that holds objects ``depth`` levels deep. No part of it can match in two ways, so a text
    is read once, in a loop."""
    inner = f"|{_object(depth - 1)}" if depth else ""
    return rf'\{{(?:[^{{}}"]++|{JSON_STRING}{inner})*+\}}'


def _whole_objects(payload: Column) -> Column:
    """The complete objects of ``items`` in a JSON feed that is cut off: each begins where the one before it ended, so
    what lies inside the last, incomplete one is not taken for an item."""
    start = r'(?s)^.*?"items"\s*:\s*\['
    listed = F.when(payload.rlike(start), F.regexp_replace(payload, start, ""))
    whole = F.regexp_extract_all(listed, F.lit(rf"(?s)\G[\s,]*+({_object(DEEPEST)})"), F.lit(1))
    parsed = F.transform(whole, lambda o: F.from_json(o, JSON_ITEM))
    return F.filter(parsed, lambda o: o.isNotNull())


def _format(payload: Column) -> Column:
    return (
        F.when(payload.isNull(), F.lit(None))
        .when(payload.rlike(r"^\s*\{"), "json")
        .when(payload.rlike(r"<feed[\s>]"), "atom")
        .otherwise("rss")
    )


def _read(payload: Column, kind: Column) -> Column:
    """Entries and damage of one document. Only the parser of the feed's own format runs, and element-wise
    recovery runs only where the document as a whole gave no list."""

    def collect(doc: Column) -> Column:
        rss = F.coalesce(
            F.transform(doc["rss"]["channel"]["item"], _rss_entry),
            # also reached by RSS 1.0, whose items stand outside the channel
            F.transform(_whole_elements(payload, "item", RSS_ITEM_FIELDS), _rss_entry),
        )
        atom = F.coalesce(
            F.transform(doc["atom"]["entry"], _atom_entry),
            F.transform(_whole_elements(payload, "entry", ATOM_ENTRY_FIELDS), _atom_entry),
        )
        json = F.when(doc["json"]["_corrupt_record"].isNull(), F.transform(doc["json"]["items"], _json_entry))
        json = F.coalesce(json, F.transform(_whole_objects(payload), _json_entry))
        found = F.when(kind == "rss", rss).when(kind == "atom", atom).otherwise(json)
        corrupt = F.coalesce(*[doc[name]["_corrupt_record"] for name in ("rss", "atom", "json")])
        return F.struct(found.alias("entries"), corrupt.isNotNull().alias("damaged"))

    document = F.struct(
        F.when(kind == "rss", F.from_xml(payload, RSS_FEED, XML_OPTIONS)).alias("rss"),
        F.when(kind == "atom", F.from_xml(payload, ATOM_FEED, XML_OPTIONS)).alias("atom"),
        F.when(kind == "json", F.from_json(payload, JSON_FEED)).alias("json"),
    )
    return bind(document, collect)


def _status(document: Column) -> Column:
    """Feed status and number of entries, before any entry is judged."""
    found = F.greatest(F.coalesce(F.size(document["entries"]), F.lit(0)), F.lit(0))
    status = F.when(~document["damaged"], OK).when(found > 0, DAMAGED).otherwise(FAILED)
    return F.struct(status.alias("feed_status"), found.alias("entries_found"))


def _parsed(feeds: DataFrame) -> DataFrame:
    """Feeds with their format and the struct ``document`` (entries, damaged), NULL without a payload."""
    with_format = feeds.withColumn("format", _format(F.col("payload")))
    document = F.when(F.col("payload").isNotNull(), _read(F.col("payload"), F.col("format")))
    return with_format.withColumn("document", document)


def parse_feeds(feeds: DataFrame, as_of: Column) -> ParsedFeeds:
    """Entries with URL and title; body, author ('Unknown') and date by their fall-back chains.

    Damaged documents give the entries that are complete. A feed without payload, or damaged and
    without one complete entry, becomes a failure.
    """
    parsed = _parsed(feeds)
    rows = parsed.select(
        "source_id", "fetched_at", F.posexplode("document.entries").alias("position", "e")
    ).select("source_id", "fetched_at", "position", "e.*")
    valid = rows.filter((F.coalesce("url", F.lit("")) != "") & (F.coalesce("title", F.lit("")) != ""))
    entries = valid.select(
        "source_id",
        "fetched_at",
        "position",
        "title",
        F.coalesce("body", F.lit("")).alias("body"),
        "url",
        feed_timestamp(F.col("published")).alias("publication_date"),
        or_default("author", "Unknown").alias("author_name"),
    )
    nothing = F.struct(F.lit(MISSING).alias("feed_status"), F.lit(0).alias("entries_found"))
    outcome = F.when(F.col("payload").isNull(), nothing).otherwise(bind(F.col("document"), _status))
    status = parsed.withColumn("outcome", outcome).select(
        "source_id", "rss_feed_url", "fetched_at", "format", "outcome.*"
    )
    lost = status.filter(F.col("feed_status").isin(MISSING, FAILED))
    reason = F.when(F.col("feed_status") == MISSING, "Feed fetch failed: no payload").otherwise(
        "Feed parse failed with no entries"
    )
    failures = dead_letter_rows(
        lost, F.col("rss_feed_url"), INGESTION, reason, as_of, ["source_id", "fetched_at"]
    )
    return ParsedFeeds(entries, failures, status.drop("rss_feed_url"))
