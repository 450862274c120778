import time

import pyarrow as pa

from helpers import values
from inkwell.sources.elements import Elements, named
from inkwell.sources.pages import CHUNK, extract_cards, extract_entries, first_paragraphs


def pages(spark, *html):
    return spark.createDataFrame(list(enumerate(html)), "page_id BIGINT, html STRING")


def test_cards(spark):
    html = """<a class="nav" href="/">Home</a>
      <article><a class="post-title big" href="/blog/a?x=1&amp;y=2">Version <b> 1 </b></a>
        <p>Monday</p><div aria-label="Avatar of Ann"></div><div aria-label="Avatar of Bo &amp; Co"></div>
        <div class="prose lead"><!-- x --> It <i>is</i> here </div></article>
      <article><a class="title" href="/blog/b">Bare</a></article>"""
    rows = extract_cards(pages(spark, html), "https://site").orderBy("position").collect()
    assert [tuple(r)[2:] for r in rows] == [
        ("Version1", "Itishere", ["Ann", "Bo & Co"], "Monday", "https://site/blog/a?x=1&y=2"),
        ("Bare", None, [], None, "https://site/blog/b"),
    ]


def test_entries(spark):
    html = """<ul><li class="blog-entry"><article><time>May 1</time><h2><a href="/p/1">One</a></h2></article></li>
      <li class="blog-entry"><p>no article</p></li><li class="blog-entry-not"><article><a href="/x">x</a></article></li>
      <li class="a blog-entry b"><article>no link</article></li></ul>"""
    got = values(extract_entries(pages(spark, html), "https://site"), "title", "posted_date", "link")
    assert got == [("One", "May 1", "https://site/p/1"), (None, None, None)]


def test_first_paragraph(spark):
    long = "This paragraph is certainly longer than forty characters."
    notice = "Check out the new version's announcement, it is also long enough."
    got = values(first_paragraphs(pages(
        spark,
        f'<p>{long} outside</p><div class="vp-doc x"><p>short</p><p class="n">{notice}</p><p>{long} &amp; more</p></div>',
        f'<div class="vp-doc"><p>short<p>{long}<p>later</div>',
        f"<p>{long}</p>",
        '<div class="vp-doc"><p>tiny</p></div>',
    ), "div", "vp-doc"))
    assert got == [(0, f"{long} & more"), (1, long)]


def test_paragraphs_count_inside_the_block_alone(spark):
    long = "This paragraph is certainly longer than forty characters."
    rows = pages(spark, f"<article><p>x</p></article><p>{long}</p>", f"<ARTICLE><DIV><P>{long}</DIV>tail</ARTICLE>",
                 f"<article>none</article><article><p>{long}</article>", None, "")
    assert values(first_paragraphs(rows, "article")) == [(1, long)]


def test_cards_with_parts_before_the_link_and_any_quotes(spark):
    html = """<ul><li><p>May 1</p><div aria-label='Avatar of Ann'></div><a class='big title' href='/1'>One</a>
      <div class='prose'>First<br>text</div></li>
      <li><a href=/2 class=title>Two</a><p>May 2</p></li><!-- <a class="title" href="/no">No</a> -->
      <li><div class="prose x">Third <img src="a.png"></div><a data-x="1>0" class="title" href="/3">Three</a><p>May 3</p></li></ul>
      <div class="prose">outside</div>"""
    rows = extract_cards(pages(spark, html), "https://site").orderBy("position").collect()
    assert [tuple(r)[2:] for r in rows] == [
        ("One", "Firsttext", ["Ann"], "May 1", "https://site/1"),
        ("Two", None, [], "May 2", "https://site/2"),
        ("Three", "Third", [], "May 3", "https://site/3"),
    ]


def test_title_link_without_an_element_around_it(spark):
    rows = extract_cards(pages(spark, '<a class="title" href="/1">One</a><p>May 1</p>', "<p>none</p>"), "").collect()
    assert [tuple(r)[2:] for r in rows] == [("One", None, [], "May 1", "/1")]


def test_entries_with_any_quotes(spark):
    html = """<li class='x blog-entry'><article><time>May 1</time><a href='/p/1'>One</a></article></li>
      <li class=blog-entry><article><a id=a href=/p/2>Two</a></article></li><li class=blog-entry-not><article></article></li>"""
    got = values(extract_entries(pages(spark, html), "https://site"), "title", "posted_date", "link")
    assert got == [("One", "May 1", "https://site/p/1"), ("Two", None, "https://site/p/2")]


def test_tags_in_capitals(spark):
    html = """<UL><LI CLASS="blog-entry"><ARTICLE><TIME>May 1</TIME><A HREF="/p/1">One</A></ARTICLE></LI></UL>"""
    got = values(extract_entries(pages(spark, html), "https://site"), "title", "posted_date", "link")
    assert got == [("One", "May 1", "https://site/p/1")]
    html = """<DIV><A CLASS="Card title" HREF="/2">Two</A><P>May 2<DIV ARIA-LABEL='Avatar of Ann'></DIV><DIV Class=prose>Text</DIV></DIV>"""
    rows = extract_cards(pages(spark, html), "https://site").collect()
    assert [tuple(r)[2:] for r in rows] == [("Two", "Text", ["Ann"], "May 2", "https://site/2")]


def test_entries_with_lists_inside_and_without_end_tags(spark):
    html = """<ul><li class="blog-entry"><ul><li>a</li><li>b<ol><li>c</ol></ul><article><a href="/1">One</a></article>
      <li class="blog-entry"><article><ul><li>x<li>y</ul><a href="/2">Two</a><time>May 2</time></article>
      <li>other<article><a href="/no">No</a></article></ul><li class="blog-entry"><article><a href="/3">Three</a>"""
    got = values(extract_entries(pages(spark, html), ""), "position", "title", "posted_date", "link")
    assert got == [(0, "One", None, "/1"), (1, "Two", "May 2", "/2"), (2, "Three", None, "/3")]


def test_elements_as_intervals():
    page = Elements("<div id=a><p>one<p>two<span><b><p>three</b></span><table><tr><td>x<td>y<tr><td>z</table></div><br/>end</p><script><p></script>")
    assert list(zip(page.tags, page.parents, page.lasts)) == [
        ("div", -1, 11), ("p", 0, 1), ("p", 0, 4), ("span", 2, 4), ("b", 3, 4), ("p", 0, 5), ("table", 0, 11), ("tr", 6, 9),
        ("td", 7, 8), ("td", 7, 9), ("tr", 6, 11), ("td", 10, 11), ("br", -1, 12), ("script", -1, 13)]
    assert page.text(0) == "onetwothreexyz" and page.text(2) == "two" and page.texts[-1] == "end"
    cells = page.where(named("td"))
    assert page.inside(7, cells) == [8, 9] and page.first_inside(10, cells) == 11 and page.first_inside(11, cells) is None


def test_pages_take_linear_time():
    for piece in ("<div>", "<li>", '<a class="title">', '<a ">', "<p>x</b>", "<!--", "<a ", "<"):
        start = time.time()
        Elements(piece * 100_000)
        assert time.time() - start < 10


def test_many_cards_on_one_page(spark):
    html = "".join(f'<li><a class="title" href="/{i}">T{i}</a><p>D{i}</li>' for i in range(20_000))
    rows = extract_cards(pages(spark, html), "").orderBy("position").collect()
    assert len(rows) == 20_000 and rows[-1]["posted_date"] == "D19999"


def test_rows_leave_in_bounded_batches(spark):
    """Whether many pages or one page has them, rows do not pile up in the task."""

    class Pages:
        sparkSession = spark
        select = filter = lambda self, *_: self
        mapInArrow = lambda self, run, schema: run

    card = '<li><a class="title" href="/{}">T</a><p>D</p><div aria-label="Ann"></div><div class="prose">{}</div></li>'
    small = "".join(card.format(i, "x" * 2000) for i in range(25))
    large = "".join(card.format(i, "y" * 2000) for i in range(3000))
    batch = pa.RecordBatch.from_pydict({"page_id": [*range(60), 60], "html": [small] * 60 + [large]})
    made = list(extract_cards(Pages(), "")(iter([batch])))
    assert max(b.nbytes for b in made) < 2 * CHUNK
    rows = [(r["page_id"], r["position"], r["link"]) for b in made for r in b.to_pylist()]
    assert rows == [(p, i, f"/{i}") for p in range(60) for i in range(25)] + [(60, i, f"/{i}") for i in range(3000)]
