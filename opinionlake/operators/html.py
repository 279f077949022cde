"""Fields of stored HTML pages.

Attributes (links, images, classes, metadata, time stamps) are read with
expressions in the JVM.  Element texts need nesting, which a pattern cannot
follow; they come from one vectorised function over the standard library parser,
and Spark leaves it out of the plan when no text column is selected.
"""

from __future__ import annotations

from dataclasses import dataclass
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from opinionlake import fixed
from opinionlake.functions.lookup import let
from opinionlake.functions.text import unescape
from opinionlake.operators.dedup import dedup_first

_ATTRS = r"""(?:[^>"']|"[^"]*"|'[^']*')*+"""
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# their character data is not part of the text of the elements around them
_NO_TEXT = frozenset("script style template rt rp".split())
_BYLINE_TAGS = frozenset(("p", "span", "div"))


# --- attributes -------------------------------------------------------------
def markup(html: Column) -> Column:
    """The page without comments and without the content of scripts and styles."""
    bare = F.regexp_replace(html, r"(?s)<!--.*?-->", "")
    return F.regexp_replace(bare, r"(?is)(<(script|style)\b[^>]*>).*?</\2\s*>", "$1")


def tags(html: Column, name: str) -> Column:
    """The start tags of one element, in document order."""
    return F.regexp_extract_all(markup(html), F.lit(rf"(?is)<{name}(?=[\s/>]){_ATTRS}>"), F.lit(0))


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of a start tag; null when it is absent."""
    pattern = rf"""(?is)\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    value = F.concat(*[F.regexp_extract(tag, pattern, g) for g in (1, 2, 3)])
    return F.when(tag.rlike(rf"(?is)\s{name}(?=[\s=/>])"), value)


def _decoded(values: Column) -> Column:
    """Entities decoded in an array of attribute values (one text per row crosses to Python)."""
    mark = "\u0001"
    return F.when(F.size(values) > 0, F.split(unescape(F.array_join(values, mark)), mark)).otherwise(values)


def _first(values: Column, n: int | None) -> Column:
    return values if n is None else F.slice(values, 1, n)


def hrefs(html: Column, n: int | None = None) -> Column:
    """All link targets, or the first ``n``."""
    return _decoded(_first(F.array_compact(F.transform(tags(html, "a"), lambda t: attribute(t, "href"))), n))


def srcs(html: Column, n: int | None = None) -> Column:
    """All image sources, or the first ``n``."""
    found = F.transform(tags(html, "img"), lambda t: F.coalesce(attribute(t, "src"), F.lit("")))
    return _decoded(_first(found, n))


def classes(html: Column) -> Column:
    """Distinct class names, sorted."""
    every = F.transform(tags(html, "[a-z][a-z0-9]*"), lambda t: F.split(F.coalesce(attribute(t, "class"), F.lit("")), r"\s+"))
    return F.array_sort(F.array_distinct(F.filter(F.flatten(every), lambda c: c != "")))


def metas(html: Column) -> Column:
    """Metadata map: ``property`` or else ``name`` to ``content``; the last of equal keys wins."""
    entries = F.filter(F.transform(tags(html, "meta"), lambda t: F.struct(
        F.coalesce(F.nullif(attribute(t, "property"), F.lit("")), attribute(t, "name")).alias("key"),
        attribute(t, "content").alias("value"))),
        lambda e: (F.coalesce(e["key"], F.lit("")) != "") & (F.coalesce(e["value"], F.lit("")) != ""))

    contents = _decoded(F.transform(entries, lambda e: e["value"]))
    pairs = F.zip_with(entries, contents, lambda e, v: F.struct(e["key"].alias("key"), v.alias("value")))

    def last_of_key(all_pairs: Column) -> Column:
        return let(F.transform(all_pairs, lambda e: e["key"]), lambda keys: F.filter(all_pairs, lambda e, i: ~F.array_contains(
            F.slice(keys, i + 2, F.greatest(F.size(keys), F.lit(1))), e["key"])))

    return F.map_from_entries(let(pairs, last_of_key))


def times(html: Column) -> Column:
    """The ``time`` elements: text, datetime attribute and class list."""
    found = F.regexp_extract_all(markup(html), F.lit(rf"(?is)<time(?=[\s/>]){_ATTRS}>.*?</time\s*>"), F.lit(0))
    return F.transform(found, lambda t: F.struct(
        F.trim(F.regexp_replace(t, r"<[^>]+>", "")).alias("text"),
        attribute(F.regexp_extract(t, rf"(?is)^<time{_ATTRS}>", 0), "datetime").alias("datetime"),
        F.filter(F.split(F.coalesce(attribute(F.regexp_extract(t, rf"(?is)^<time{_ATTRS}>", 0), "class"), F.lit("")), r"\s+"),
                 lambda c: c != "").alias("class")))


# --- texts ------------------------------------------------------------------
@dataclass(slots=True)
class _Element:
    tag: str
    attrs: dict
    first: int  # text pieces [first, end)
    end: int = 0
    last: int = 0  # index after the last element nested in this one


class _Outline(HTMLParser):
    """Elements in document order, each as a range over the page's text pieces."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.elements: list[_Element] = []
        self.pieces: list[str] = []
        self._open: list[_Element] = []
        self._buffer: list[str] = []

    def _flush(self) -> None:
        if self._buffer:
            text = "".join(self._buffer).strip()
            self._buffer.clear()
            if text and not any(e.tag in _NO_TEXT for e in self._open):
                self.pieces.append(text)

    def _end(self, element: _Element) -> None:
        element.end, element.last = len(self.pieces), len(self.elements)

    def handle_data(self, data: str) -> None:
        self._buffer.append(data)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self._flush()
        element = _Element(tag, dict(attrs), len(self.pieces))
        self.elements.append(element)
        if tag in _VOID:
            self._end(element)
        else:
            self._open.append(element)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self._flush()
        if any(e.tag == tag for e in self._open):
            while self._open:
                element = self._open.pop()
                self._end(element)
                if element.tag == tag:
                    break

    def handle_comment(self, data: str) -> None:
        self._flush()

    def handle_decl(self, decl: str) -> None:
        self._flush()

    def finish(self) -> _Outline:
        self.close()
        self._flush()
        for element in self._open:
            self._end(element)
        return self

    def lines(self, element: _Element) -> list[str]:
        return self.pieces[element.first:element.end]


def outline(page: str) -> _Outline:
    parser = _Outline()
    parser.feed(page)
    return parser.finish()


def _element_texts(page: _Outline) -> dict[str, list[str]]:
    found: dict[str, list[str]] = {tag: [] for tag in fixed.PAGE_TAGS}
    for element in page.elements:
        texts = found.get(element.tag)
        if texts is not None:
            text = "".join(page.lines(element))
            if text:
                texts.append(text)
    return found


def _byline(page: _Outline) -> tuple[str | None, str | None]:
    """The two lines after the byline mark in the first block that holds it."""
    for element in page.elements:
        if element.tag in _BYLINE_TAGS:
            block = "\n".join(page.lines(element))
            if fixed.BYLINE_MARK in block:
                lines = [line.strip() for line in block.split("\n") if line.strip()]
                after = lines[lines.index(fixed.BYLINE_MARK) + 1:] if fixed.BYLINE_MARK in lines else []
                return (after[0] if after else None), (after[1] if len(after) > 1 else None)
    return None, None


_TEXTS_TYPE = T.StructType(
    [T.StructField(f"{tag}_all_texts", T.ArrayType(T.StringType())) for tag in fixed.PAGE_TAGS]
    + [T.StructField("author", T.StringType()), T.StructField("byline_date", T.StringType()), T.StructField("error", T.StringType())])


_TEXTS_ARROW = pa.struct([(f"{tag}_all_texts", pa.list_(pa.string())) for tag in fixed.PAGE_TAGS]
                         + [("author", pa.string()), ("byline_date", pa.string()), ("error", pa.string())])
# a batch of Spark's may hold many large pages; only so many are Python objects at a time
_PAGES_AT_ONCE = 64


def _page_row(page: str | None) -> dict:
    if page is None:
        return {}
    try:
        parsed = outline(page)
    except (AssertionError, ValueError) as broken:  # what the parser raises on malformed declarations
        return {"error": str(broken) or type(broken).__name__}
    author, date = _byline(parsed)
    return {**{f"{tag}_all_texts": texts for tag, texts in _element_texts(parsed).items()}, "author": author, "byline_date": date}


@F.arrow_udf(_TEXTS_TYPE)
def page_texts(pages: pa.Array) -> pa.Array:
    """Texts of the tracked elements and the byline of each page; a page that cannot be parsed gives its error only."""
    parts = [pa.array([_page_row(page.as_py()) for page in pages.slice(at, _PAGES_AT_ONCE)], _TEXTS_ARROW)
             for at in range(0, len(pages), _PAGES_AT_ONCE)]
    return pa.concat_arrays(parts) if parts else pa.array([], _TEXTS_ARROW)


@F.pandas_udf(T.ArrayType(T.StringType()))
def container_links(pages: pd.Series) -> pd.Series:
    """First link of each listing container of each page; null where the page cannot be parsed."""
    def links(page: str | None) -> list[str] | None:
        if page is None:
            return None
        try:
            elements = outline(page).elements
        except (AssertionError, ValueError):
            return None
        found = []
        for at, element in enumerate(elements):
            if element.tag == "div" and fixed.LINK_CONTAINER in (element.attrs.get("class") or "").split():
                inside = (e for e in elements[at + 1:element.last] if e.tag == "a" and "href" in e.attrs)
                first = next(inside, None)
                if first is not None:
                    found.append(first.attrs["href"] or "")
        return found

    return pages.map(links)


def listing_links(df: DataFrame, html: str, site: str, order: list[str]) -> DataFrame:
    """Article links of listing pages: absolute, each kept where it occurs first.

    ``order`` names the columns that order the pages.
    """
    found = df.select(*order, F.posexplode(container_links(F.col(html))).alias("position", "href"))
    absolute = F.when(F.startswith("href", F.lit("/")), F.concat(F.lit(site), F.col("href"))).otherwise(F.col("href"))
    return dedup_first(found.withColumn("url", absolute), "url", [*order, "position"]).select(*order, "position", "url")


def extract_pages(df: DataFrame, html: str = "html", url: str = "url", ingested_at: str | None = None) -> DataFrame:
    """Bronze page records; a page without content, or one that cannot be parsed, becomes an error record."""
    page = F.col(html)
    texts = df.withColumn("_t", page_texts(page))
    meta = metas(page)
    missing = page.isNull()
    return texts.select(
        F.col(url).alias("url"),
        *[F.col(f"_t.{tag}_all_texts").alias(f"{tag}_all_texts") for tag in fixed.PAGE_TAGS],
        hrefs(page).alias("all_hrefs"), srcs(page).alias("all_src"), classes(page).alias("all_classes"),
        meta.alias("all_meta"), F.col("_t.author").alias("author"),
        F.coalesce(F.nullif(F.col("_t.byline_date"), F.lit("")), F.try_element_at(meta, F.lit(fixed.META_PUBLISHED))).alias("published_time"),
        F.lit(ingested_at).cast("string").alias("ingestion_timestamp"),
        F.when(missing, "no content").otherwise(F.col("_t.error")).alias("error"),
        F.when(missing | F.col("_t.error").isNotNull(), "error").alias("status"),
        times(page).alias("time_all"))
