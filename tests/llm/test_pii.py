import hashlib
import random
import re

import pytest

from cases import ODD, SMALL, none, odd, table
from inkwell.llm import pii
from inkwell.llm.queries import QUERIES

PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def good(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def plain(text):
    order = list(PATTERNS)
    found = [(m.start(), order.index(k), m.end()) for k, p in PATTERNS.items() for m in p.finditer(text or "") if good(k, m[0])]
    return [(order[k], a, b) for a, k, b in sorted(found)]


def test_base_spans_against_patterns():
    rnd = random.Random(1)
    for _ in range(30_000):
        text = "".join(rnd.choice("01923.+@a-b %_( )é:/") for _ in range(rnd.randint(0, 40)))
        assert [s for s in pii.find_spans(text) if s[0] in pii.BASE] == plain(text), text


def test_query_against_patterns(spark):
    got = {r["doc_id"]: r for r in QUERIES["op9_pii"](spark, SMALL).collect()}
    for row in table("documents"):
        spans = plain(row["text"])
        r = got[row["doc_id"]]
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.BASE] == [sum(s[0] == k for s in spans) for k in pii.BASE]
        assert set(filter(None, joined.split(","))) <= set(r["spans"].split(","))


@pytest.mark.parametrize("text, spans", [
    ("see ftp://joe:pw@files.example.com:21/x", [("login", 4, 37), ("email", 14, 34)]),
    ("IBAN: DE89 3704 0044 0532 0130 00.", [("iban", 6, 33)]),
    ("iban DE88370400440532013000", []),
    ("9" * 5000, []),
])
def test_added_kinds_and_validation(text, spans):
    assert pii.find_spans(text) == spans


def test_mask_joins_overlapping_spans():
    assert pii.mask("call +1 (583) 555-8469, mail a@b.co") == "call [PHONE], mail [EMAIL]"
    assert pii.mask("ftp://joe:pw@files.example.com") == "[LOGIN]"
    assert pii.mask(None) is None and pii.mask("") == "" and pii.mask("clean") == "clean"


def test_odd_rows_and_none(spark):
    docs = odd(spark, "spans", "kind")
    assert sorted((r["doc_id"] or -1, len(r["spans"])) for r in pii.find_pii(docs).collect()) == sorted((i or -1, 0) for i, *_ in ODD)
    masked = pii.mask_pii(docs)
    assert masked.columns == docs.columns and masked.dtypes == docs.dtypes
    assert sorted(map(repr, masked.collect())) == sorted(map(repr, docs.collect()))
    assert pii.find_pii(none(spark)).count() == pii.mask_pii(none(spark)).count() == 0
