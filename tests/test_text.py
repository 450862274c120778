import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from helpers import one
from inkwell.functions import text
from inkwell.functions.dates import feed_timestamp


@pytest.mark.parametrize("title, slug", [
    ("Über die Straße", "uber-die-strasse"),
    ("Hello World!!!", "hello-world"),
    ("It's 1,000,000 rows", "it-s-1000000-rows"),
    ("Don’t stop", "dont-stop"),
    ("Rock &amp; Roll &#38; &#x26; more", "rock-roll-more"),
    ("  --  ", "untitled"),
    ("", "untitled"),
    (None, "untitled"),
    ("Æsir œuvre ﬁn", "aesir-oeuvre-fin"),
    ("Привет, мир! Ещё объём", "privet-mir-eshche-obem"),
    ("Ελλάδα Χίος", "ellada-khios"),
    ("Kernel№5… ØRE ŁÓDŹ", "kernelno5-ore-lodz"),
    ("日本語", hashlib.md5("日本語".encode()).hexdigest()[:6]),
    (" كاتب ", hashlib.md5("كاتب".encode()).hexdigest()[:6]),
    ("Spark 入門", "spark-" + hashlib.md5("Spark 入門".encode()).hexdigest()[:6]),
    ("?!", "untitled"),
    ("Ａｂｃ１２３", "abc123"),
    ("a" * 100, "a" * 80),
    ("a" * 79 + " b", "a" * 79),
])
def test_title_slug(spark, title, slug):
    assert one(spark, text.title_slug("t"), t=title) == slug


def test_hashed_slug(spark):
    digest = hashlib.md5("Hello?".encode()).hexdigest()[:6]
    assert one(spark, text.hashed_slug("t"), t="Hello?") == f"hello-{digest}"
    assert one(spark, text.hashed_slug("t"), t="???") == hashlib.md5(b"???").hexdigest()[:6]
    long = one(spark, text.hashed_slug("t"), t="word " * 40)
    assert len(long) <= 80 and long[-7] == "-"


@pytest.mark.parametrize("name, expected", [
    ("jean-luc o'neil", "Jean-Luc O'Neil"),
    ("ANN  LEE", "Ann  Lee"),
    ("élodie 2nd", "Élodie 2nd"),
    ("", ""),
    (None, None),
])
def test_initcap_words(spark, name, expected):
    assert one(spark, text.initcap_words("n"), n=name) == expected


def test_preview_slug_takes_the_first_80_characters(spark):
    assert one(spark, text.preview_slug("t"), t="  Café au lait: 3 ways ") == "caf-au-lait-3-ways"
    assert one(spark, text.preview_slug("t"), t="x" * 79 + "é" + "y") == "x" * 79


def test_unescape_html(spark):
    raw = "a &lt;b&gt; &amp;lt; &#228;&#x1F600; &unknown; & &nbsp;"
    assert one(spark, text.unescape_html("t"), t=raw) == "a <b> &lt; ä😀 &unknown; & \xa0"


@pytest.mark.parametrize("raw, plain", [
    ("&#0000039;", "'"), ("&frac12; &rarr; &Eacute;", "½ → É"), ("&#x01F600;", "😀"), ("&CounterClockwiseContourIntegral;", "∳"),
    ("&#1114112; &#55296; &#0; &#99999999999999999999999;", "&#1114112; &#55296; &#0; &#99999999999999999999999;"),
    ("&amp &#39", "&amp &#39"),
])
def test_unescape_all_references(spark, raw, plain):
    assert one(spark, text.unescape_html("t"), t=raw) == plain


def test_strip_takes_all_white_space(spark):
    assert one(spark, text.strip("t"), t=" \t\n x y \xa0") == "x y"


def test_python_timestamp(spark):
    def printed(value):
        return one(spark, text.python_timestamp(F.lit(value).cast("timestamp")))

    assert printed("2024-01-02 03:04:05") == "2024-01-02 03:04:05+00:00"
    assert printed("2024-01-02 03:04:05.00012") == "2024-01-02 03:04:05.000120+00:00"
    assert printed(None) == "None"


@pytest.mark.parametrize("written, expected", [
    ("Mon, 24 Feb 2026 10:00:00 GMT", datetime(2026, 2, 24, 10)),  # that day is a Tuesday
    ("24 Feb 2026 10:00:00 +0200", datetime(2026, 2, 24, 8)),
    ("Tue, 3 Mar 2026 10:00 PST", datetime(2026, 3, 3, 18)),
    ("2026-02-24T10:00:00+02:00", datetime(2026, 2, 24, 8)),
    ("2026-02-24", datetime(2026, 2, 24)),
    ("2026-13-40T99:00:00Z", None),
    ("last week", None),
    (None, None),
])
def test_feed_timestamp(spark, written, expected):
    assert one(spark, F.date_format(feed_timestamp(F.col("t")), "yyyy-MM-dd HH:mm:ss"), t=written) == (
        expected and expected.isoformat(sep=" ")
    )
