"""Checks of rendered notes: front matter, required fields, wikilinks, tags."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from inkwell.functions.text import bind, strip, title_slug
from inkwell.operators.skew import join_hot_keys
from inkwell.operators.upsert import present_keys
from inkwell.session import cut_lineage

# Front-matter fields every note of a kind must have.
REQUIRED_FIELDS = {
    "post": ["uid", "source", "author", "date", "tags", "category", "url", "status"],
    "source": ["name", "category", "rss_url", "status"],
    "author": ["name", "primary_category", "post_count"],
}
LINK_FIELDS = ["source", "author"]
WIKILINK = r"^\[\[([^\]|]+)(?:\|[^\]]+)?\]\]"

FIELD = "STRUCT<kind: STRING, text: STRING>"
TYPED = f"path STRING, frame_error STRING, error STRING, fields MAP<STRING, {FIELD}>, tags ARRAY<{FIELD}>"


def note_type_of(path: Column) -> Column:
    """Kind of a note by its folders: the first of posts, sources, authors; posts must hold something."""
    parts = F.split(path, "/")
    deep = F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0)))
    first = {name: F.array_position(deep if name == "posts" else parts, name) for name in ("posts", "sources", "authors")}
    at = {name: F.when(position > 0, position) for name, position in first.items()}
    nearest = F.least(*at.values())
    return (
        F.when(nearest.isNull(), "unknown")
        .when(at["posts"] == nearest, "post")
        .when(at["sources"] == nearest, "source")
        .otherwise("author")
    )


def wikilink_target(text: Column) -> Column:
    """Target of a wikilink at the start of the text, without its alias; NULL when there is none."""
    found = strip(text)
    return F.when(found.rlike(WIKILINK), strip(F.regexp_extract(found, WIKILINK, 1)))


# What YAML makes of plain words; each also stands capitalised and in capitals.
YAML_WORDS = {
    "true": ("bool", "True"), "yes": ("bool", "True"), "on": ("bool", "True"), "false": ("bool", "False"),
    "no": ("bool", "False"), "off": ("bool", "False"), "null": ("NoneType", "None"),
}
FIELD_LINE = r"^([A-Za-z_][A-Za-z0-9_]*):(?: (.*))?$"
# Text that YAML reads as a string whatever stands around it: from a letter on, without quotes and comments. Each pattern
# repeats one class of characters, which Java does in a loop; repeated alternatives would take a stack frame each.
PLAIN_SIGNS = r"\p{L}\p{M}\p{N}._/&+%?=~;()!@*|$-"
PLAIN_TEXT = rf"^\p{{L}}[: {PLAIN_SIGNS}]*+\z"
# In it, a colon that may end a key, and a blank before another, before a colon or at the end.
UNCLEAR = rf":(?![\p{{L}}\p{{N}}/])| (?![{PLAIN_SIGNS}])"
QUOTED_TEXT = r'^"[^"\\]*+"\z'
PLAIN_ITEM = r"^\p{L}[\p{L}\p{M}\p{N}._-]*+\z"
STATUS = r'"\U0001F331 Seedling"'  # the one escape that rendered notes have


def _typed_word(text: Column) -> Column:
    """Struct(kind, text) of a plain word or text."""
    words = F.create_map(*[
        x for word, (kind, printed) in YAML_WORDS.items() for form in (word, word.capitalize(), word.upper())
        for x in (F.lit(form), F.struct(F.lit(kind).alias("kind"), F.lit(printed).alias("text")))
    ])
    return F.coalesce(F.try_element_at(words, text), F.struct(F.lit("str").alias("kind"), text.alias("text")))


def _listed(value: Column) -> Column:
    """The items of a plain list, each a struct(kind, text); NULL for anything else."""
    in_brackets = value.startswith("[") & value.endswith("]") & (F.length(value) > 1)

    def typed(texts: Column) -> Column:
        # an empty text between commas is no item, so the list is left to YAML
        return F.when(F.forall(texts, lambda t: t.rlike(PLAIN_ITEM)), F.transform(texts, _typed_word))

    inner = F.substr(value, F.lit(2), F.length(value) - 2)
    return F.when(value == "[]", F.array().cast(f"array<{FIELD}>")).when(in_brackets, bind(F.split(inner, ", "), typed))


def _quoted_texts(items: Column) -> Column:
    """The items as a list prints them: texts in quotes."""
    return F.transform(items, lambda w: F.struct(
        w["kind"].alias("kind"), F.when(w["kind"] == "str", F.concat(F.lit("'"), w["text"], F.lit("'"))).otherwise(w["text"]).alias("text")))


def _typed_value(value: Column) -> Column:
    """Struct(kind, text, items) of what stands behind a key; kind is NULL for YAML beyond plain values and lists."""

    def field(kind: str, text: Column | str) -> Column:
        return F.struct(F.lit(kind).alias("kind"), (F.lit(text) if isinstance(text, str) else text).alias("text"))

    single = (
        F.when(value == "", field("NoneType", "None"))
        .when(value.rlike("^(?:0|[1-9][0-9]{0,17})$"), field("int", value))
        .when(value.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.when(value.try_cast("date").isNotNull(), field("date", value)))
        .when(value == STATUS, field("str", "\U0001F331 Seedling"))
        .when(value.rlike(QUOTED_TEXT), field("str", F.regexp_replace(value, '^"|"$', "")))
        .when(value.rlike(PLAIN_TEXT) & ~value.rlike(UNCLEAR), _typed_word(value))
    )
    listed = bind(_listed(value), lambda items: F.when(items.isNotNull(), F.struct(
        F.lit("list").alias("kind"),
        F.concat(F.lit("["), F.array_join(F.transform(_quoted_texts(items), lambda w: w["text"]), ", "), F.lit("]")).alias("text"),
        _quoted_texts(items).alias("items"))))
    no_items = F.lit(None).cast(f"array<{FIELD}>")
    plain = bind(single, lambda v: F.struct(v["kind"].alias("kind"), v["text"].alias("text"), no_items.alias("items")))
    return F.when(value.startswith("["), listed).otherwise(plain)


def _typed_line(line: Column) -> Column:
    """Struct(key, kind, text, items) of a front-matter line; kind is NULL for YAML beyond plain values and lists."""
    value = F.when(line.rlike(FIELD_LINE), F.coalesce(F.regexp_extract(line, FIELD_LINE, 2), F.lit("")))
    return bind(bind(value, _typed_value), lambda v: F.struct(
        F.regexp_extract(line, FIELD_LINE, 1).alias("key"), v["kind"].alias("kind"), v["text"].alias("text"), v["items"].alias("items")))


def _typed_plainly(heads: DataFrame) -> DataFrame:
    """Adds ``lines``, the typed lines of the front matter, NULL where any needs a YAML parser."""
    lines = F.filter(F.split("front_matter", "\n"), lambda t: t != "")

    def simple(typed: Column) -> Column:
        keys = F.array_distinct(F.transform(typed, lambda e: e["key"]))
        return F.when(F.forall(typed, lambda e: e["kind"].isNotNull()) & (F.size(keys) == F.size(typed)), typed)

    return heads.withColumn("lines", bind(F.transform(lines, _typed_line), simple))


def _typed_front_matter(heads: DataFrame) -> DataFrame:
    """Adds the YAML values of ``front_matter`` with their type names; text is what str() prints, for tags repr()."""
    try:
        import yaml  # noqa: F401
    except ImportError as error:
        raise ImportError("typing of note front matter needs PyYAML") from error

    def run(batches):
        import pandas as pd
        import yaml

        loader = getattr(yaml, "CSafeLoader", yaml.SafeLoader)

        def typed(source):
            try:
                values = yaml.load(source, Loader=loader)
            except (yaml.YAMLError, ValueError) as error:  # ValueError: dates that do not exist
                return f"YAML parse error: {error}", None, None
            values = values if isinstance(values, dict) else {}
            fields = {str(k): {"kind": type(v).__name__, "text": str(v)} for k, v in values.items()}
            tags = values.get("tags")
            if not isinstance(tags, list):
                return None, fields, None
            kinds = ["blank" if isinstance(t, str) and not t.strip() else type(t).__name__ for t in tags]
            return None, fields, [{"kind": kind, "text": repr(t)} for kind, t in zip(kinds, tags)]

        for batch in batches:
            rows = [typed(source) for source in batch["front_matter"]]
            yield pd.DataFrame({
                "path": batch["path"],
                "frame_error": batch["frame_error"],
                "error": [r[0] for r in rows],
                "fields": [r[1] for r in rows],
                "tags": [r[2] for r in rows],
            })

    return heads.mapInPandas(run, TYPED)


def parse_front_matter(notes: DataFrame) -> DataFrame:
    """Per note: path, note_type, error, typed fields and tag items.

    Front matter of plain values and lists, as notes are rendered, is typed by column expressions, in time proportional
    to its length; only that of notes with other YAML (their first part, without the text) reaches a parser in Python.
    What the expressions made is written once, so the notes are read once for both.
    """
    first = notes.filter("part = 0").select("path", "content")
    pieces = F.split("content", "---", 3)
    cut = first.select(
        "path",
        F.when(~F.col("content").startswith("---"), "Note does not begin with '---' frontmatter delimiter")
        .when(F.size(pieces) < 3, "Frontmatter block not properly closed with '---'").alias("frame_error"),
        F.try_element_at(pieces, F.lit(2)).alias("front_matter"),
    )
    # notes with a broken frame pass through with an empty (valid) text
    text = F.when(F.col("frame_error").isNull(), F.col("front_matter")).otherwise(F.lit(""))
    read = _typed_plainly(cut.withColumn("front_matter", text))
    read = cut_lineage(read.withColumn("front_matter", F.when(F.col("lines").isNull(), F.col("front_matter"))))
    field = F.transform("lines", lambda e: F.struct(e["key"], F.struct(e["kind"].alias("kind"), e["text"].alias("text"))))
    tags = F.get(F.filter("lines", lambda e: (e["key"] == "tags") & (e["kind"] == "list")), F.lit(0))["items"]
    plain = read.filter("lines is not null").select(
        "path", "frame_error", F.lit(None).cast("string").alias("error"), F.map_from_entries(field).alias("fields"), tags.alias("tags")
    )
    typed = plain.unionByName(_typed_front_matter(read.filter("lines is null").drop("lines")))
    return typed.select(
        "path",
        note_type_of(F.col("path")).alias("note_type"),
        F.coalesce("frame_error", "error").alias("error"),
        "fields",
        "tags",
    )


def _failure(field: Column, reason: Column, target: Column | None = None) -> Column:
    no_target = F.lit(None).cast("string")
    return F.struct(
        field.alias("field"), reason.alias("reason"), (no_target if target is None else target).alias("target")
    )


def _required() -> Column:
    """Failures of the note type's required fields."""
    rules = F.create_map(*[x for kind, names in REQUIRED_FIELDS.items()
                           for x in (F.lit(kind), F.array(*map(F.lit, names)))])
    names = F.coalesce(F.try_element_at(rules, F.col("note_type")), F.array().cast("array<string>"))

    def check(name: Column) -> Column:
        value = F.try_element_at("fields", name)
        problem = (
            F.when(value.isNull(), F.lit("missing from "))
            .when(value["kind"] == "NoneType", F.lit("is null in "))
            .when((value["kind"] == "str") & (strip(value["text"]) == ""), F.lit("is empty in "))
        )
        reason = F.concat(
            F.lit("Required field '"), name, F.lit("' "), problem, F.col("note_type"), F.lit(" note frontmatter")
        )
        return _failure(name, reason)

    return F.filter(F.transform(names, check), lambda f: f["reason"].isNotNull())


def _wikilinks() -> Column:
    """Possible failures: links with the slug that has to exist."""

    def check(name: Column) -> Column:
        target = wikilink_target(F.try_element_at("fields", name)["text"])
        slug = F.when((F.lower(target) != "unknown") & target.rlike(r"[\p{L}\p{N}]"), title_slug(target))
        reason = F.concat(F.lit("Wikilink target '[["), target, F.lit("]]' has no corresponding note in generated/"))
        return _failure(name, reason, slug)

    return F.filter(F.transform(F.array(*map(F.lit, LINK_FIELDS)), check), lambda f: f["target"].isNotNull())


def _tags() -> Column:
    field = F.lit("tags")
    value = F.try_element_at("fields", field)
    no_list = _failure(field, F.concat(F.lit("'tags' must be a YAML list, got "), value["kind"]))

    def check(item: Column, index: Column) -> Column:
        where = F.concat(F.lit("tags["), index.cast("string"), F.lit("] is empty or not a string: "))
        return _failure(field, F.when(item["kind"] != "str", F.concat(where, item["text"])))

    items = F.filter(F.transform("tags", check), lambda f: f["reason"].isNotNull())
    nothing = F.filter(F.array(no_list), lambda f: F.lit(False))
    return F.when(value.isNull(), nothing).when(value["kind"] != "list", F.array(no_list)).otherwise(items)


class Checked(NamedTuple):
    failures: DataFrame  # path, field, reason
    results: DataFrame  # path, note_type, passed, failures; in the order of paths
    summary: DataFrame  # one row: total, passed, failed


def note_failures(notes: DataFrame) -> DataFrame:
    """All failures of all notes: path, field, reason.

    Everything but the wikilinks is decided within the row. The findings are checkpointed, so the
    front matter is parsed once. Links are judged by their distinct targets: those no note has as its
    slug are joined back to the links, with frequent targets spread over tasks.
    """
    parsed = parse_front_matter(notes)
    broken = F.array(_failure(F.lit("frontmatter"), F.col("error")))
    found = F.when(F.col("error").isNotNull(), broken).otherwise(F.concat(_required(), _wikilinks(), _tags()))
    findings = cut_lineage(parsed.select("path", F.explode(found).alias("f")).select("path", "f.*"))
    links = findings.filter("target is not null")
    targets = links.groupBy("target").count()
    slugs = notes.filter("part = 0").select(F.col("slug").alias("target"))
    lost = targets.join(present_keys(slugs, ["target"], targets), "target", "left_anti")
    marks = lost.select("target", F.lit(True).alias("_lost"))
    unresolved = join_hot_keys(links, marks, "target", lost, "path").filter("_lost")
    return findings.filter("target is null").select("path", "field", "reason").unionByName(
        unresolved.select("path", "field", "reason")
    )


def check_notes(notes: DataFrame) -> Checked:
    """Failures, one result per note and the totals. A failing note never stops the others."""
    failures = note_failures(notes)
    counts = failures.groupBy("path").agg(F.count(F.lit(1)).alias("failures"))
    number = F.coalesce("failures", F.lit(0).cast("long"))
    results = notes.filter("part = 0").select("path").join(counts, "path", "left").select(
        "path", note_type_of(F.col("path")).alias("note_type"), (number == 0).alias("passed"), number.alias("failures")
    ).orderBy("path")
    return Checked(failures, results, check_summary(results))


def check_summary(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count(F.lit(1)).alias("total"), F.count_if("passed").alias("passed"), F.count_if(~F.col("passed")).alias("failed")
    )
