"""Dates as feeds write them."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from inkwell.functions.text import bind

# Layouts tried in this order once the weekday name is gone.
RFC_822 = [
    "d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm:ss z", "d MMM yyyy HH:mm Z", "d MMM yyyy HH:mm z",
    "d MMM yy HH:mm:ss Z", "d MMM yy HH:mm:ss z", "d MMM yyyy",
]
# Zone names of RFC 822 as offsets.
ZONES = {"EST": "-0500", "EDT": "-0400", "CST": "-0600", "CDT": "-0500", "MST": "-0700", "MDT": "-0600",
         "PST": "-0800", "PDT": "-0700", "UT": "+0000", "UTC": "+0000", "GMT": "+0000", "Z": "+0000"}


def feed_timestamp(text: Column) -> Column:
    """RFC 822 or ISO 8601 text to a timestamp; anything else is NULL. Weekday names are not checked."""
    names = F.create_map(*[F.lit(x) for kv in ZONES.items() for x in kv])

    def with_offset(plain: Column) -> Column:
        offset = F.try_element_at(names, F.upper(F.regexp_extract(plain, r"\s([A-Za-z]{1,3})$", 1)))
        return F.coalesce(F.concat(F.regexp_replace(plain, r"\s[A-Za-z]{1,3}$", " "), offset), plain)

    def parse(plain: Column) -> Column:
        iso = F.when(plain.rlike(r"^\d{4}-\d{2}-\d{2}"), plain.try_cast("timestamp"))
        return F.coalesce(iso, *[F.try_to_timestamp(plain, F.lit(layout)) for layout in RFC_822])

    no_weekday = F.btrim(F.regexp_replace(text, r"^\s*[A-Za-z]{3,9},\s*", ""))
    return bind(bind(no_weekday, with_offset), parse)
