import json
import time
from datetime import datetime

from helpers import NOW, as_of, values
from inkwell.schemas import FEEDS
from inkwell.sources.feeds import parse_feeds

RSS = """<?xml version="1.0"?><rss version="2.0" xmlns:content="http://purl.org/rss/1.0/modules/content/"
 xmlns:dc="http://purl.org/dc/elements/1.1/"><channel><title>Blog</title><link>https://blog</link>
<item><title> First &amp; last </title><link>https://blog/1</link><description>short</description>
<content:encoded><![CDATA[<p>long &amp; rich</p>]]></content:encoded><dc:creator>Ann</dc:creator>
<pubDate>Mon, 5 Feb 2024 10:00:00 GMT</pubDate></item>
<item><title>By guid</title><guid>https://blog/2</guid><description>d</description><author>Bo</author></item>
<item><title>No link</title><guid isPermaLink="false">77</guid></item>
<item><title></title><link>https://blog/4</link></item></channel></rss>"""

ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><title>Atom</title><link href="https://atom"/>
<entry><title type="html">One</title><link rel="self" href="https://atom/self"/><link href="https://atom/1"/>
<content type="html">Body</content><summary>S</summary><author><name>X</name></author><author><name>Y</name></author>
<updated>2024-02-05T10:00:00+01:00</updated></entry></feed>"""

JSON = json.dumps({"items": [
    {"title": "J", "url": "https://json/1", "content_html": "<b>h</b>", "authors": [{"name": "Jo"}],
     "date_published": "2024-02-05T00:00:00Z"},
    {"title": "no url"},
]})

DAMAGED = """<rss><channel><title>D</title><item><title>Whole</title><link>https://d/1</link></item>
<item><title></title><link></link></item><item><title>Cut off"""

RDF = """<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns="http://purl.org/rss/1.0/">
<channel><title>r</title></channel><item><title>Old</title><link>https://rdf/1</link></item></rdf:RDF>"""


def parse(spark, *payloads):
    rows = [(i, f"https://feed/{i}", NOW, p) for i, p in enumerate(payloads)]
    return parse_feeds(spark.createDataFrame(rows, FEEDS), as_of())


def test_rss_fall_backs(spark):
    got = values(parse(spark, RSS).entries, "title", "url", "body", "author_name", "publication_date")
    assert got == [
        ("By guid", "https://blog/2", "d", "Bo", None),
        ("First & last", "https://blog/1", "<p>long &amp; rich</p>", "Ann", datetime(2024, 2, 5, 10)),
    ]


def test_atom_takes_the_alternate_link_and_content(spark):
    assert values(parse(spark, ATOM).entries, "title", "url", "body", "author_name", "publication_date") == [
        ("One", "https://atom/1", "Body", "Y", datetime(2024, 2, 5, 9))
    ]


def test_json_feed(spark):
    assert values(parse(spark, JSON).entries, "title", "url", "body", "author_name") == [
        ("J", "https://json/1", "<b>h</b>", "Jo")
    ]


def test_rss_1_items_outside_the_channel(spark):
    assert values(parse(spark, RDF).entries, "title", "url", "author_name", "body") == [
        ("Old", "https://rdf/1", "Unknown", "")
    ]


def test_damaged_and_missing_feeds(spark):
    parsed = parse(spark, DAMAGED, "<rss><channel><item><title>x", None, "{not json", RSS, "<html></html>")
    assert values(parsed.status, "source_id", "format", "feed_status", "entries_found") == [
        (0, "rss", "damaged", 2), (1, "rss", "failed", 0), (2, None, "missing", 0), (3, "json", "failed", 0),
        (4, "rss", "ok", 4), (5, "rss", "ok", 0),
    ]
    assert values(parsed.entries.filter("source_id = 0"), "title", "url") == [("Whole", "https://d/1")]
    assert values(parsed.failures, "post_reference", "failure_stage", "failure_reason", "retry_count", "resolved") == [
        ("https://feed/1", "ingestion", "Feed parse failed with no entries", 0, False),
        ("https://feed/2", "ingestion", "Feed fetch failed: no payload", 0, False),
        ("https://feed/3", "ingestion", "Feed parse failed with no entries", 0, False),
    ]


def test_cut_json_feed_keeps_its_complete_entries(spark):
    items = [{"title": f"T{i} {{[\\\"", "url": f"https://j/{i}", "authors": [{"name": "A"}], "content_text": "]} ,"} for i in range(3)]
    whole = json.dumps({"title": "{", "items": items})
    for cut, found in ((3, 2), (20, 2), (1, 3), (0, 3)):
        parsed = parse(spark, whole[:len(whole) - cut])
        assert values(parsed.entries, "url") == [f"https://j/{i}" for i in range(found)]
        assert values(parsed.status, "feed_status", "entries_found") == [("ok" if cut == 0 else "damaged", found)]
    assert values(parse(spark, '{"items": [{"title": "x"').status, "feed_status") == ["failed"]


def test_failed_fetches_of_one_feed_are_letters_of_their_own(spark):
    rows = [(1, "https://feed", NOW, None), (1, "https://feed", NOW.replace(hour=1), None), (2, "https://feed", NOW, None)]
    failures = parse_feeds(spark.createDataFrame(rows, FEEDS), as_of()).failures
    assert failures.select("id").distinct().count() == 3


def json_item(i, extra=""):
    return '{"title": "t%d", "url": "https://x/%d", "content_text": "a } \\" { b", "authors": [{"name": "A"}]%s}' % (i, i, extra)


def test_items_inside_a_cut_json_item_are_not_entries(spark):
    nested = ', "attachments": [{"url": "https://no", "title": "no", "meta": {"a": {"b": [{}, {"c": 1}]}}}]'
    whole = '{"items": [' + ", ".join([json_item(1, nested), json_item(2), json_item(3, nested)])
    for cut, want in ((len(whole), 3), (len(whole) - 1, 2), (len(whole) - 40, 2)):
        rows = spark.createDataFrame([(1, "u", NOW, whole[:cut])], FEEDS)
        got = values(parse_feeds(rows, as_of()).entries, "url")
        assert got == [f"https://x/{i}" for i in range(1, want + 1)]


def test_long_cut_json_feed(spark):
    payload = '{"items": [' + ",".join(json_item(i, ', "content_html": "%s"' % ("word " * 100)) for i in range(30_000))
    assert len(payload) > 15_000_000
    rows = spark.createDataFrame([(1, "u", NOW, payload[:-10])], FEEDS)
    start = time.time()
    assert parse_feeds(rows, as_of()).entries.count() == 29_999
    assert time.time() - start < 60
