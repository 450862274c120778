"""Text columns: trimming, title case, slugs, HTML entities. All built from Spark's own functions."""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column, functions as F

# The characters that str.strip() takes as white space.
WHITE_SPACE = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())

# Letters and marks that do not decompose to ASCII, and their ASCII spelling. Small
# letters stand for their capitals, too.
ASCII_SPELLING = {
    "ß": "ss", "æ": "ae", "œ": "oe", "þ": "th", "ø": "o", "đ": "d", "ð": "d", "ł": "l", "ħ": "h", "ı": "i", "ŋ": "ng",
    "‘": "'", "’": "'", "‚": ",", "“": '"', "”": '"', "€": "EUR", "©": "(c)", "®": "(r)", "™": "tm",
    "α": "a", "β": "b", "γ": "g", "δ": "d", "ε": "e", "ζ": "z", "η": "e", "θ": "th", "ι": "i", "κ": "k", "λ": "l", "μ": "m",
    "ν": "n", "ξ": "x", "ο": "o", "π": "p", "ρ": "r", "σ": "s", "ς": "s", "τ": "t", "υ": "u", "φ": "ph", "χ": "kh", "ψ": "ps",
    "ω": "o",
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ж": "zh", "з": "z", "и": "i", "к": "k", "л": "l", "м": "m",
    "н": "n", "о": "o", "п": "p", "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f", "х": "kh", "ц": "ts", "ч": "ch",
    "ш": "sh", "щ": "shch", "ъ": "'", "ы": "y", "ь": "'", "э": "e", "ю": "iu", "я": "ia", "є": "ie", "і": "i", "ґ": "g",
}

# All named character references with their semicolon left out, from the standard library's table.
NAMED_REFERENCES = json.dumps({name[:-1]: text for name, text in html5.items() if name.endswith(";")})
LAST_CODE_POINT = 0x10FFFF


def _ascii_letters() -> dict[str, str]:
    """Every character whose compatibility decomposition, without marks, spells in ASCII."""
    spelling = {c.upper(): text.capitalize() for c, text in ASCII_SPELLING.items() if len(c.upper()) == 1} | ASCII_SPELLING
    blocks = [(0xA0, 0x250), (0x370, 0x492), (0x1E00, 0x2300), (0xFB00, 0xFB07), (0xFF01, 0xFF5F)]
    letters = {}
    for code in (code for first, end in blocks for code in range(first, end)):
        plain = [ch for ch in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(ch)]
        text = "".join(spelling.get(ch, ch) for ch in plain)
        if text and text.isascii():
            letters[chr(code)] = text
    return letters


_LETTERS = _ascii_letters()
_SINGLE = {c: text for c, text in _LETTERS.items() if len(text) == 1}
_LONGER = {c: text for c, text in _LETTERS.items() if len(text) > 1}
# combining marks come last and have no target: translate() drops them
_FOLD_FROM, _FOLD_TO = "".join(_SINGLE) + "".join(map(chr, range(0x300, 0x370))), "".join(_SINGLE.values())


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` applied to a value that is computed once, however often ``use`` refers to it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def strip(c: Column | str) -> Column:
    """Trim all white space, not only blanks."""
    return F.btrim(_column(c), F.lit(WHITE_SPACE))


def is_blank(c: Column | str) -> Column:
    """True for NULL, empty and all-white-space text."""
    return F.coalesce(strip(c) == "", F.lit(True))


def or_default(c: Column | str, default: Column | str) -> Column:
    """The text, or the default where it is NULL or empty."""
    return F.coalesce(F.nullif(_column(c), F.lit("")), F.lit(default) if isinstance(default, str) else default)


def initcap_words(c: Column | str) -> Column:
    """Title case where every run of letters and digits is a word (Spark's initcap only splits at blanks)."""
    runs = F.regexp_extract_all(F.lower(_column(c)), F.lit(r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda t: F.concat(F.upper(F.left(t, F.lit(1))), F.substring(t, 2, 1 << 30))), "")


def trim_dashes(c: Column) -> Column:
    return F.btrim(c, F.lit("-"))


def preview_slug(title: Column | str) -> Column:
    """Plain slug of a title's first 80 characters; every other character than ASCII letters and digits separates."""
    head = F.left(F.trim(_column(title)), F.lit(80))
    return trim_dashes(F.lower(F.regexp_replace(head, "[^a-zA-Z0-9]+", "-")))


def fold_to_ascii(c: Column | str) -> Column:
    """Latin, Greek and Cyrillic letters as ASCII without accents; other scripts are left alone."""
    special = "".join(_LONGER)
    pieces = F.lit(f"([{special}]|[^{special}]+)")
    spelled = F.create_map(*[F.lit(x) for kv in _LONGER.items() for x in kv])

    def fold(text: Column) -> Column:
        runs = F.regexp_extract_all(text, pieces, F.lit(1))
        longer = F.array_join(F.transform(runs, lambda r: F.coalesce(F.try_element_at(spelled, r), r)), "")
        whole = F.when(text.rlike(f"[{special}]"), longer).otherwise(text)
        return F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(whole, _FOLD_FROM, _FOLD_TO)).otherwise(text)

    return bind(_column(c), fold)


def _code_point(digits: Column, base: int) -> Column:
    """The character of a number; NULL beyond the last code point, for surrogates and for 0."""
    short = F.ltrim(digits, F.lit("0"))
    number = F.when(F.length(short).between(1, 8), F.conv(short, base, 10).cast("bigint"))
    valid = number.between(1, LAST_CODE_POINT) & ~number.between(0xD800, 0xDFFF)
    return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32"))


def unescape_html(c: Column | str) -> Column:
    """Resolve character references; unknown names and numbers that are no character stay as they are."""
    pattern = F.lit(r"(&#[0-9]+;|&#[xX][0-9a-fA-F]+;|&[a-zA-Z][a-zA-Z0-9]*;|[^&]+|&)")
    # one literal for the optimizer to fold, not thousands
    names = F.from_json(F.lit(NAMED_REFERENCES), "map<string,string>")

    def resolve(piece: Column) -> Column:
        return F.coalesce(
            F.when(piece.rlike("^&#[0-9]+;$"), _code_point(F.regexp_extract(piece, "([0-9]+)", 1), 10))
            .when(piece.rlike("^&#[xX][0-9a-fA-F]+;$"), _code_point(F.regexp_extract(piece, "^&#.([0-9a-fA-F]+)", 1), 16))
            .when(piece.rlike("^&[a-zA-Z][a-zA-Z0-9]*;$"), F.try_element_at(names, F.btrim(piece, F.lit("&;")))),
            piece,
        )

    def join(text: Column) -> Column:
        pieces = F.regexp_extract_all(text, pattern, F.lit(1))
        return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(pieces, resolve), "")).otherwise(text)

    return bind(_column(c), join)


def _spelled(text: Column | str) -> Column:
    """The text in ASCII as far as letters can be spelled, character references resolved."""
    dashed = F.regexp_replace(_column(text), "'+", "-")
    return F.lower(fold_to_ascii(unescape_html(fold_to_ascii(dashed))))


def _kebab(spelled: Column, max_length: int) -> Column:
    plain = F.regexp_replace(spelled, "'+", "")
    plain = F.regexp_replace(plain, "(?<=[0-9]),(?=[0-9])", "")
    kebab = trim_dashes(F.regexp_replace(F.regexp_replace(plain, "[^-a-z0-9]+", "-"), "-{2,}", "-"))
    return trim_dashes(F.left(kebab, F.lit(max_length)))


def slug_base(text: Column | str, max_length: int = 80) -> Column:
    """ASCII kebab-case slug; empty when the text has no letter or digit that can be spelled in ASCII."""
    return _kebab(_spelled(text), max_length)


def _digest(text: Column) -> Column:
    return F.left(F.md5(text), F.lit(6))


def title_slug(title: Column | str, max_length: int = 80) -> Column:
    """File slug of a title or name.

    Where letters or digits of other scripts would be lost, the first six hex digits of the name's MD5 keep it apart
    from others. Titles without any letter or digit (or none at all) are 'untitled'.
    """

    def slug(pair: Column) -> Column:
        text, spelled = pair["text"], pair["spelled"]
        lossy = spelled.rlike(r"[\p{L}\p{N}&&[^\x00-\x7F]]")
        base = F.nullif(_kebab(spelled, max_length - 7), F.lit(""))
        marked = F.concat_ws("-", base, _digest(strip(text)))
        return F.when(lossy, marked).otherwise(or_default(_kebab(spelled, max_length), "untitled"))

    return bind(F.struct(_column(title).alias("text"), _spelled(title).alias("spelled")), slug)


def hashed_slug(title: Column | str, max_length: int = 80) -> Column:
    """Slug with the first six hex digits of the title's MD5, within the same length."""
    text = F.coalesce(_column(title), F.lit(""))
    base = bind(slug_base(text, max_length - 7), lambda slug: F.nullif(slug, F.lit("")))
    return F.concat_ws("-", base, _digest(text))


def python_timestamp(c: Column | str) -> Column:
    """A UTC timestamp the way notes print it: seconds, micros only when there are any, offset; NULL is 'None'."""
    ts = _column(c)
    micros = F.when(F.pmod(F.unix_micros(ts), F.lit(1_000_000)) != 0, F.date_format(ts, ".SSSSSS")).otherwise("")
    return F.coalesce(F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), micros, F.lit("+00:00")), F.lit("None"))


def printed(c: Column | str) -> Column:
    """Any scalar as text, NULL as 'None'."""
    return F.coalesce(_column(c).cast("string"), F.lit("None"))
