"""Fetched pages: text blocks, links, catalogue items."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin, urlparse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edupipe import fixed_values as fv

BATCH_CHARS = 4 << 20   # texts and rows of blocks that a task holds before it gives them out
BATCH_BLOCKS = 16_384
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SILENT = frozenset(("script", "style", "template"))


class _Page(HTMLParser):
    """One pass over a page: stripped texts and, per element, which texts it spans."""

    def __init__(self, html: str) -> None:
        super().__init__(convert_charrefs=True)
        self.texts: list[str] = []
        self.elements: list[list] = []  # [tag, attributes, first text, end text, last element]
        self._open: list[list] = []
        self._pending: list[str] = []
        self.feed(html)
        self.close()
        self._flush()
        self._shut(0)

    def _flush(self) -> None:
        text = "".join(self._pending).strip()
        self._pending.clear()
        if text and not (self._open and self._open[-1][0] in _SILENT):
            self.texts.append(text)

    def _shut(self, depth: int) -> None:
        for element in self._open[depth:]:
            element[3], element[4] = len(self.texts), len(self.elements)
        del self._open[depth:]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self._flush()
        element = [tag, dict(attrs), len(self.texts), len(self.texts), len(self.elements) + 1]
        self.elements.append(element)
        if tag not in _VOID:
            self._open.append(element)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self._flush()
        for depth in range(len(self._open) - 1, -1, -1):
            if self._open[depth][0] == tag:
                self._shut(depth)
                break

    def handle_data(self, data: str) -> None:
        self._pending.append(data)

    def handle_comment(self, data: str) -> None:
        self._flush()

    def text_of(self, element: list) -> str:
        return "".join(self.texts[element[2]:element[3]])


def blocks_of(html: str) -> list[tuple[str, str]]:
    """(tag, text) of every block element with text, in order; nested blocks repeat their text."""
    page = _Page(html)
    pairs = ((e[0], page.text_of(e)) for e in page.elements if e[0] in fv.BLOCK_TAGS)
    return [(tag, text) for tag, text in pairs if text]


def _menu(page: _Page) -> list | None:
    for wanted in ("nav", "ul"):
        for element in page.elements:
            marks = (element[1].get("id") or "", element[1].get("class") or "")
            if element[0] == wanted and any("menu" in m.lower() for m in marks):
                return element
    return None


def links_of(url: str, html: str) -> list[str]:
    """Distinct links of the page's menu, else its links to the same host except anchors and itself."""
    page = _Page(html)
    menu = _menu(page)
    inside = page.elements if menu is None else page.elements[page.elements.index(menu) + 1:menu[4]]
    found: dict[str, None] = {}
    for tag, attributes, *_ in inside:
        if tag != "a" or attributes.get("href") is None:
            continue
        try:
            link = urljoin(url, attributes["href"])
            local = urlparse(link).netloc == urlparse(url).netloc
        except ValueError:
            continue
        if menu is not None or (local and link != url and "#" not in link):
            found[link] = None
    return list(found)


def page_blocks(pages: DataFrame, project: str, main_link: str, subpage: str, html: str) -> DataFrame:
    """(project, main_link, subpage, position, tag, text) rows of every page, whole."""
    given = pages.select(
        F.col(project).cast("string").alias("project"),
        F.col(main_link).alias("main_link"),
        F.col(subpage).alias("subpage"),
        F.col(html).alias("html"),
    ).where("html is not null")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def given_out(batch, rows, positions, tags, texts) -> pa.RecordBatch:
            index = pa.array(rows, pa.int64())
            return pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c).take(index) for c in ("project", "main_link", "subpage")],
                    pa.array(positions, pa.int32()), pa.array(tags, pa.string()), pa.array(texts, pa.string()),
                ],
                ["project", "main_link", "subpage", "position", "tag", "text"],
            )

        for batch in batches:
            html, held, found = batch.column("html"), 0, ([], [], [], [])
            for row in range(batch.num_rows):  # one page at a time: blocks in blocks repeat their text
                for position, block in enumerate(blocks_of(html[row].as_py())):
                    for column, value in zip(found, (row, position, *block), strict=True):
                        column.append(value)
                    held += len(block[1])
                    if held >= BATCH_CHARS or len(found[0]) >= BATCH_BLOCKS:
                        yield given_out(batch, *found)
                        held, found = 0, ([], [], [], [])
            if found[0]:
                yield given_out(batch, *found)

    return given.mapInArrow(
        parse, "project string, main_link string, subpage string, position int, tag string, text string"
    )


def page_links(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    """(key, url, links): the distinct links of every page."""
    given = pages.select(F.col(key), F.col(url), F.col(html).alias("html")).where("html is not null")
    out = T.StructType([*given.drop("html").schema.fields, T.StructField("links", T.ArrayType(T.StringType()))])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column(url).to_pylist(), batch.column("html").to_pylist(), strict=True)
            links = pa.array([links_of(u or "", h) for u, h in pairs], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column(key), batch.column(url), links], [key, url, "links"])

    return given.mapInArrow(parse, out)


def link_rows(pages: DataFrame, key: str, main: str, links: str, fragment: str = "/#") -> DataFrame:
    """One row per link without ``fragment``, with the number of such links of its page.

    The links of a page are one array in one row, so the count needs no shuffle.
    A page without links keeps one row with a null link and the count 0.
    """
    kept = F.filter(links, lambda x: x.isNull() | ~F.contains(x, F.lit(fragment)))
    counted = F.size(F.filter(kept, lambda x: x.isNotNull()))
    had_none = F.coalesce(F.size(links), F.lit(0)) <= 0
    rows = pages.select(
        key, main, counted.alias("__n"), F.explode(F.when(had_none, F.array(F.lit(None).cast("string"))).otherwise(kept)).alias("link")
    )
    return rows.select(key, main, "link", F.greatest("__n", F.lit(0)).alias("num_subpages"))


def _has(element: list, tag: str | None, classes: frozenset[str]) -> bool:
    return (tag is None or element[0] == tag) and classes <= set((element[1].get("class") or "").split())


def items_of(
    html: str, item: tuple[str | None, str] | None, title: tuple[str | None, str], link: tuple[str | None, str]
) -> list[tuple[str, str]]:
    """(title, link) of every item element that has both.

    ``item``, ``title`` and ``link`` name elements by tag (None: any) and the classes they have to have.  The first title and
    the first link inside an item count.  Without ``item`` every link element is an item, with the
    title inside it, or its own text when no class of a title is given.
    """
    page = _Page(html)
    marks = [(tag, frozenset(classes.split())) for tag, classes in (item or link, title, link)]
    found = []
    for at, element in enumerate(page.elements):
        if not _has(element, *marks[0]):
            continue
        inside = page.elements[at : element[4]] if item is None else page.elements[at + 1 : element[4]]
        named = element if item is None and title == (None, "") else next((e for e in inside if _has(e, *marks[1])), None)
        linked = next((e for e in inside if _has(e, *marks[2])), None)
        if named is not None and linked is not None:
            pair = page.text_of(named), linked[1].get("href") or ""
            if all(pair):
                found.append(pair)
    return found


def catalogue_items(
    pages: DataFrame, key: str, html: str,
    item: tuple[str | None, str] | None = fv.CATALOGUE_ITEM,
    title: tuple[str | None, str] = fv.CATALOGUE_TITLE,
    link: tuple[str | None, str] = fv.CATALOGUE_LINK,
) -> DataFrame:
    """(key, title, link) of the items of catalogue pages, by tag and classes; the title may be nested in the link."""
    given = pages.select(F.col(key), F.col(html).alias("html")).where("html is not null")
    texts = [T.StructField("title", T.StringType()), T.StructField("link", T.StringType())]
    out = T.StructType([*given.drop("html").schema.fields, *texts])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(row, *pair) for row, page in enumerate(batch.column("html").to_pylist()) for pair in items_of(page, item, title, link)]
            index = pa.array([r[0] for r in rows], pa.int64())
            columns = [pa.array([r[i] for r in rows], pa.string()) for i in (1, 2)]
            yield pa.RecordBatch.from_arrays([batch.column(key).take(index), *columns], [key, "title", "link"])

    return given.mapInArrow(parse, out)


def anchors(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, title, link) of every link of a page that has a text and an address."""
    return catalogue_items(pages, key, html, None, (None, ""), ("a", ""))


def register_page_blocks(spark: SparkSession, name: str = "page_blocks") -> None:
    """A table function for SQL: ``SELECT … FROM pages, LATERAL page_blocks(html)``."""

    class PageBlocks:
        def eval(self, html: str) -> Iterator[tuple[int, str, str]]:
            for position, (tag, text) in enumerate(blocks_of(html or "")):
                yield position, tag, text

    spark.udtf.register(name, F.udtf(PageBlocks, returnType="position int, tag string, text string", useArrow=True))
