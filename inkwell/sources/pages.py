"""Stored listing and article pages to rows: cards, entries, first paragraphs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema

from inkwell.sources.elements import Elements, named

SHORTEST_PARAGRAPH = 40
CHUNK = 1 << 20  # characters, about, of the rows that leave a task together
CARD = (
    "page_id BIGINT, position INT, title STRING, description STRING, authors ARRAY<STRING>, posted_date STRING, link STRING")
ENTRY = "page_id BIGINT, position INT, title STRING, posted_date STRING, link STRING"
PARAGRAPH = "page_id BIGINT, description STRING"


def _size(value: str | list[str] | int | None) -> int:
    """Characters of a value, and some for what else it takes."""
    return 16 + (len(value) if isinstance(value, str) else sum(map(_size, value)) if isinstance(value, list) else 0)


def _from_elements(pages: DataFrame, rows_of: Callable[[Elements], Iterator[tuple]], schema: str) -> DataFrame:
    """The rows that ``rows_of`` makes of each page's elements, behind its page_id; a page is in memory alone, and so are
    about ``CHUNK`` characters of rows, however many pages or rows of one page a batch has."""

    target = to_arrow_schema(pages.sparkSession.createDataFrame([], schema).schema)

    def run(batches):
        import pyarrow as pa

        def made(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * len(target)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, target)], schema=target)

        for batch in batches:
            rows, held = [], 0
            for page_id, html in zip(batch.column(0), batch.column(1)):
                for row in rows_of(Elements(html.as_py())):
                    rows.append((page_id.as_py(), *row))
                    held += sum(map(_size, row))
                    if held >= CHUNK:
                        yield made(rows)
                        rows, held = [], 0
            yield made(rows)

    return pages.select("page_id", "html").filter("html is not null").mapInArrow(run, schema)


def _title_link(tag: str, values: dict[str, str]) -> bool:
    return tag == "a" and "title" in values.get("class", "")


def extract_cards(pages: DataFrame, base_url: str) -> DataFrame:
    """One row per title link of a listing page; its card is the element that holds the link, or else the page, so the
    other parts may stand before or after the link."""

    def cards(page: Elements) -> Iterator[tuple]:
        paragraphs = page.where(named("p"))
        labelled = page.where(lambda tag, values: tag == "div" and "aria-label" in values)
        prose = page.where(lambda tag, values: tag == "div" and "prose" in values.get("class", ""))
        for position, link in enumerate(page.where(_title_link)):
            card = page.parents[link]
            authors = [page.attributes[i]["aria-label"].replace("Avatar of ", "") for i in page.inside(card, labelled)]
            yield (
                position, page.text(link), page.text(page.first_inside(card, prose)), authors,
                page.text(page.first_inside(card, paragraphs)), base_url + page.attributes[link].get("href", ""),
            )

    return _from_elements(pages, cards, CARD)


def extract_entries(pages: DataFrame, base_url: str) -> DataFrame:
    """One row per ``li.blog-entry`` that holds an article; its parts come from the first one."""

    def entries(page: Elements) -> Iterator[tuple]:
        articles, times = page.where(named("article")), page.where(named("time"))
        links = page.where(lambda tag, values: tag == "a" and "href" in values)
        for position, item in enumerate(page.where(named("li", "blog-entry"))):
            article = page.first_inside(item, articles)
            if article is None:
                continue
            link = page.first_inside(article, links)
            yield (
                position, page.text(link), page.text(page.first_inside(article, times)),
                None if link is None else base_url + page.attributes[link]["href"],
            )

    return _from_elements(pages, entries, ENTRY)


def first_paragraphs(pages: DataFrame, tag: str, css_class: str | None = None) -> DataFrame:
    """Per page the first paragraph of the content block that is long enough and no notice of a newer version; pages
    without one are left out.

    The block is the page's first element with this tag and class. A paragraph ends at its end tag, at the start of the
    next paragraph or block element, or with the element around it.
    """

    def paragraphs(page: Elements) -> Iterator[tuple]:
        blocks = page.where(named(tag, css_class))
        for paragraph in page.inside(blocks[0], page.where(named("p"))) if blocks else ():
            text = page.text(paragraph)
            if len(text) >= SHORTEST_PARAGRAPH and not ("Check out the" in text and "announcement" in text):
                yield (text,)
                return

    return _from_elements(pages, paragraphs, PARAGRAPH)
