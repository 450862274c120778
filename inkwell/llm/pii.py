"""Personal data by anchor expansion: an Aho-Corasick automaton finds at-signs, schemes and identifier cues in one pass
over a text; a small parser for each kind expands from the cue to the span's boundaries and validates it."""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from inkwell.llm.common import map_arrow, read

# Kinds in the order in which spans of one start are listed. The first four are the base.
KINDS = ("email", "ip", "card", "phone", "login", "iban")
BASE = KINDS[:4]

LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
ADDRESS = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
LOGIN = re.compile(r"://[^\s/@:?#]+(?::[^\s/@?#]*)?@[A-Za-z0-9.-]*[A-Za-z0-9](?::[0-9]+)?")
SCHEME = re.compile(r"[A-Za-z0-9+.-]")
IBAN = re.compile(r"[ :]{0,3}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})(?![A-Za-z0-9])")


def _cues() -> ahocorasick.Automaton:
    cues = ahocorasick.Automaton()
    cues.add_word("@", (1, "@"))
    cues.add_word("+", (1, "+"))
    cues.add_word("://", (3, ":"))
    for word in ("IBAN", "Iban", "iban"):
        cues.add_word(word, (4, "i"))
    for digit in "0123456789":
        cues.add_word(digit, (1, "0"))
    cues.make_automaton()
    return cues


CUES = _cues()


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def iban_valid(code: str) -> bool:
    turned = code[4:] + code[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _left(text: str, at: int, least: int, allowed: re.Pattern) -> int:
    while at > least and allowed.match(text, at - 1):
        at -= 1
    return at


def find_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, end exclusive, by start and then by kind.

    Within a kind, spans are the leftmost that do not overlap; a match that fails its check is dropped and its
    characters are not tried again.
    """
    found: list[tuple[str, int, int]] = []
    if not text:
        return found
    done = dict.fromkeys(("email", "ip", "card", "phone", "login", "iban"), 0)
    for last, (length, cue) in CUES.iter(text):
        at = last - length + 1
        if cue == "0":
            if at >= done["ip"]:
                end = DOTTED.match(text, at).end()
                done["ip"] = end
                for m in ADDRESS.finditer(text, at, end):
                    if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                        found.append(("ip", m.start(), m.end()))
            if at >= done["card"] and (m := CARD.match(text, at)):
                done["card"] = m.end()
                digits = m[0].replace(" ", "").replace("-", "")
                if 12 <= len(digits) <= 19 and luhn(digits):
                    found.append(("card", at, m.end()))
        elif cue == "@":
            start = _left(text, at, done["email"], LOCAL)
            if start < at and (m := DOMAIN.match(text, at + 1)):
                done["email"] = m.end()
                found.append(("email", start, m.end()))
        elif cue == "+":
            if at >= done["phone"] and (m := PHONE.match(text, at)):
                done["phone"] = m.end()
                if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                    found.append(("phone", at, m.end()))
        elif cue == ":":
            if at >= done["login"] and (m := LOGIN.match(text, at)):
                start = _left(text, at, done["login"], SCHEME)
                if start < at:
                    done["login"] = m.end()
                    found.append(("login", start, m.end()))
        elif at >= done["iban"] and (m := IBAN.match(text, last + 1)):
            done["iban"] = m.end()
            if iban_valid(m[1].replace(" ", "")):
                found.append(("iban", m.start(1), m.end(1)))
    found.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    return found


def mask(text: str | None) -> str | None:
    """The text with ``[KIND]`` for each span; spans that overlap become one, named after the first of them."""
    spans = find_spans(text)
    if not spans:
        return text
    pieces, at, i = [], 0, 0
    while i < len(spans):
        kind, start, end = spans[i]
        i += 1
        while i < len(spans) and spans[i][1] < end:
            end = max(end, spans[i][2])
            i += 1
        pieces += [text[at:start], f"[{kind.upper()}]"]
        at = end
    return "".join([*pieces, text[at:]])


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans) per row; spans: array of struct(kind, start, end) in code points, by start and kind.

    Null and empty texts have no spans; ids may be null or repeat; an empty table gives an empty result; other columns
    are ignored. Texts are searched whole and each is read once, so time and memory follow its length.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans = [[{"kind": k, "start": a, "end": b} for k, a, b in find_spans(t)] for t in batch.column(1).to_pylist()]
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], names=[id_col, "spans"])

    rows = docs.select(id_col, F.col(text_col).cast("string").alias("text"))
    return map_arrow(rows, run, f"`{id_col}` {dict(rows.dtypes)[id_col]}, "
                                "spans array<struct<kind:string,start:bigint,end:bigint>>")


def mask_pii(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with its texts masked (see :func:`mask`); rows and other columns stay as they are, null texts null."""
    place = docs.columns.index(text_col)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        masked = pa.array([mask(t) for t in batch.column(place).to_pylist()], pa.string())
        return batch.set_column(place, batch.schema.field(place).name, masked.cast(batch.schema.field(place).type))

    schema = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes)
    return map_arrow(docs, run, schema)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document."""
    found = find_pii(read(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [(F.size("spans") - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}") for kind in BASE]
    return found.select(
        "doc_id", *counts, F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )
