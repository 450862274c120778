import random

import pytest
from pyspark.sql import functions as F

from helpers import NOW, mart_authors, mart_post, mart_posts, mart_sources, one, values
from inkwell.operators import note_checks, notes
from inkwell.schemas import NOTES

FRONT = {"uid": "1", "source": '"[[Some Blog]]"', "author": '"[[Ann Lee]]"', "date": "2024-01-30", "tags": "[a, b]",
         "category": "Data", "url": "https://p/1", "status": "new"}


def note(path="posts/data/x.md", body="text", **changes):
    lines = [f"{k}: {v}" for k, v in (FRONT | changes).items() if v is not None]
    return path, "---\n" + "\n".join(lines) + f"\n---\n{body}\n"


def failures(spark, *pairs):
    others = [("sources/some-blog.md", "---\nname: n\ncategory: c\nrss_url: u\nstatus: s\n---\n"),
              ("authors/ann-lee.md", "---\nname: n\nprimary_category: c\npost_count: 0\n---\n")]
    rows = [("x", path, path.split("/")[-1].removesuffix(".md"), 0, text) for path, text in [*pairs, *others]]
    return values(note_checks.note_failures(spark.createDataFrame(rows, NOTES)), "path", "field", "reason")


def reasons(spark, *pairs):
    return [(f, r) for _, f, r in failures(spark, *pairs)]


def test_good_note(spark):
    assert failures(spark, note()) == []


def test_frame(spark):
    assert reasons(spark, ("posts/a/b.md", "no front")) == [
        ("frontmatter", "Note does not begin with '---' frontmatter delimiter")]
    assert reasons(spark, ("posts/a/b.md", "---\nuid: 1\n")) == [
        ("frontmatter", "Frontmatter block not properly closed with '---'")]
    (field, reason), = reasons(spark, note(category="a: b: c"))
    assert field == "frontmatter" and reason.startswith("YAML parse error: ")
    (field, reason), = reasons(spark, note(date="2024-13-45"))
    assert field == "frontmatter" and reason.startswith("YAML parse error: ")


def test_required_fields(spark):
    assert reasons(spark, note(uid=None, category="", url='"  "')) == [
        ("category", "Required field 'category' is null in post note frontmatter"),
        ("uid", "Required field 'uid' missing from post note frontmatter"),
        ("url", "Required field 'url' is empty in post note frontmatter"),
    ]
    assert len(reasons(spark, ("posts/a/b.md", "---\n- a list\n---\n"))) == 8
    assert reasons(spark, ("other/b.md", "---\nanything: 1\n---\n")) == []
    assert reasons(spark, note(uid="0")) == []


def test_wikilinks(spark):
    assert reasons(spark, note(source='"[[Nowhere|home]]"', author='"[[Unknown]]"')) == [
        ("source", "Wikilink target '[[Nowhere]]' has no corresponding note in generated/")]
    assert reasons(spark, note(source='" [[ some blog ]] and more"', author="plain text")) == []
    assert reasons(spark, note(source='"see [[Nowhere]]"', author='"[[???]]"')) == []
    assert reasons(spark, note(author="[[ann lee]]")) == []  # a YAML list, printed like a link


def test_tags(spark):
    assert reasons(spark, note(tags="topic")) == [("tags", "'tags' must be a YAML list, got str")]
    assert ("tags", "'tags' must be a YAML list, got NoneType") in reasons(spark, note(tags=""))
    assert reasons(spark, note(tags='[ok, 2024, yes, "a: b", " ", {a: b}]')) == [
        ("tags", "tags[1] is empty or not a string: 2024"), ("tags", "tags[2] is empty or not a string: True"),
        ("tags", "tags[4] is empty or not a string: ' '"), ("tags", "tags[5] is empty or not a string: {'a': 'b'}")]
    assert reasons(spark, note(tags="[]")) == []


@pytest.mark.parametrize("path, kind", [
    ("posts/data/x.md", "post"), ("generated/sources/x.md", "source"), ("authors/x.md", "author"), ("posts", "unknown"),
    ("a/posts", "unknown"), ("sources", "source"), ("sources/posts/x.md", "source"), ("posts/sources/x.md", "post"),
    ("x.md", "unknown"), ("authors/posts", "author"),
])
def test_note_type(spark, path, kind):
    assert one(spark, note_checks.note_type_of(F.col("p")), p=path) == kind


def test_rendered_notes_and_totals(spark):
    posts = mart_posts(spark, mart_post(1, "X"), mart_post(2, "Y", tags=["on", "b"]), mart_post(3, "Z", source_name="Gone"))
    rendered = notes.all_notes(
        posts, mart_sources(spark, (1, "Some Blog", 5, "active", 1, NOW, NOW)), mart_authors(spark, ("a1", "Ann Lee", 2, "Data")))
    checked = note_checks.check_notes(rendered)
    assert values(checked.failures, "path", "field") == [("posts/data/y.md", "tags"), ("posts/data/z.md", "source")]
    assert values(checked.results, "path", "passed", "failures")[2:] == [
        ("posts/data/y.md", False, 1), ("posts/data/z.md", False, 1), ("sources/some-blog.md", True, 0)]
    assert values(checked.summary) == [(5, 3, 2)]


def test_plain_front_matter_is_typed_as_a_parser_would(spark):
    """Column expressions give the parser's answer wherever they give one."""
    values_ = ["", "7", "007", "0", "-3", "1.5", "2024-01-30", "2024-02-31", "None", "null", "Yes", "yEs", "off", "y", "Some Blog",
               "Some: Blog", "a #b", "a#b", "https://p/7?x=1&y=2", "北京作者", "लेखक", "it's", '"[[A|b]]"', '"a\\tb"', "'q'", "[a, b]",
               "[]", "[a, true, null]", "[a,b]", "[a, 1]", "{a: b}", "x:", "a: b", "- a", "* a", "&a", "!x", "a, b", "a [b]", "x ", " x",
               r'"\U0001F331 Seedling"', "2024-01-30T10:00:00", "0x1F", "1_000", "1e5", "~", "=", "a |", "e5", "Infinity", "C++", "ab."]
    heads = spark.createDataFrame([(f"n{i}", None, f"\nkey: {v}\nother: x\n") for i, v in enumerate(values_)],
                                  "path STRING, frame_error STRING, front_matter STRING")
    plain = {r["path"]: r["lines"] for r in note_checks._typed_plainly(heads).collect()}
    parsed = {r["path"]: r for r in note_checks._typed_front_matter(heads).collect()}
    for i, value in enumerate(values_):
        lines = plain[f"n{i}"]
        if lines is not None:
            want = parsed[f"n{i}"]["fields"]["key"]
            assert (lines[0]["kind"], lines[0]["text"]) == (want["kind"], want["text"]), value
    typed = {v for i, v in enumerate(values_) if plain[f"n{i}"] is not None}
    assert {"", "7", "2024-01-30", "None", "Yes", "Some Blog", "https://p/7?x=1&y=2", "北京作者", "[a, true, null]"} <= typed
    assert not {"Some: Blog", "a #b", "it's", "{a: b}", "x:", "- a", "2024-02-31"} & typed


def test_tags_of_plain_lists(spark):
    rows = spark.createDataFrame([("posts/a/b.md", 0, "---\ntags: [a, On, b.c]\n---\nx")], "path STRING, part INT, content STRING")
    got = note_checks.parse_front_matter(rows).first()
    assert [tuple(t) for t in got["tags"]] == [("str", "'a'"), ("bool", "True"), ("str", "'b.c'")]
    assert got["fields"]["tags"]["text"] == "['a', True, 'b.c']"


def typed_lines(spark, front_matters):
    """(typed by expressions, fields by YAML) per front matter; the first is None where expressions leave it to YAML."""
    import yaml

    df = spark.createDataFrame(list(enumerate(front_matters)), "i int, front_matter string")
    out = []
    for row, text in zip(note_checks._typed_plainly(df).orderBy("i").collect(), front_matters):
        try:
            values = yaml.safe_load(text)
            parsed = {str(k): (type(v).__name__, str(v)) for k, v in values.items()} if isinstance(values, dict) else {}
        except (yaml.YAMLError, ValueError):
            parsed = None
        out.append((row["lines"] and {e["key"]: (e["kind"], e["text"]) for e in row["lines"]}, parsed))
    return out


def test_plain_typing_agrees_with_yaml(spark):
    values = ["a", "a b", "a  b", "a ", "a: b", "a:b", "a :b", "a :", "a:", "a #b", "a# b", "#a", "é ü", "yes", "No", "a\tb", "a\r",
              "1", "01", "1.5", "1e3", "2024-01-30", "2024-13-45", "[]", "[a]", "[a, b]", "[a,b]", "[a, ]", "[, a]", "[a b]",
              "[a, yes, Null]", "[a: b]", "[a", "a]", "[[a]]", "[1, a]", '"a b"', '"a" b', '"a\\n"', "'a'", "a'b", "a - b", "- a",
              "a, b", "a [b]", "a {b}", "@a", "a@b", "a|b", "a > b", "a & b", "~", "null", "a?b", "a ?", "http://x/y?z=1&k=2", "[a.b, c-d]"]
    rng = random.Random(1)
    values += ["".join(rng.choice('ab:  #"-é,[]1') for _ in range(rng.randint(1, 8))) for _ in range(400)]
    got = typed_lines(spark, [f"name: {v}" for v in values])
    for value, (plain, parsed) in zip(values, got):
        assert plain is None or plain == parsed, value
    by_value = dict(zip(values, got))
    for value in ("a", "a b", "a:b", "yes", "2024-01-30", "[]", "[a, b]", '"a b"', "http://x/y?z=1&k=2"):
        assert by_value[value][0] is not None
    for value in ("a: b", "a ", "a  b", "a #b", "[1, a]", "[a, ]", "[a: b]"):
        assert by_value[value][0] is None or by_value[value][0] == by_value[value][1]


def test_long_values(spark):
    long = "word " * 200_000 + "end"
    tags = "[" + ", ".join(f"tag{i}" for i in range(10_000)) + "]"
    odd_tags = "[" + ", ".join(f"{i}" for i in range(10_000)) + "]"
    assert failures(spark, note(category=long), note("posts/data/y.md", tags=tags), note("posts/data/z.md", category="x:" * 500_000 + "y"),
                    note("posts/data/q.md", category='"' + "q " * 500_000 + '"')) == []
    assert len(failures(spark, note(tags=odd_tags))) == 10_000
    (field, reason), = reasons(spark, note(category="a: b " * 200_000))
    assert field == "frontmatter" and reason.startswith("YAML parse error: ")
    many = "\n".join(f"key{i}: value {i}" for i in range(10_000))
    assert failures(spark, note(status="new\n" + many)) == []
