"""Extraction from stored HTML pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinionlake.operators import html as H
from opinionlake.registry.base import Query, table

_SITE = "https://news.example"


def _pages(spark, sf):
    return table(spark, sf, "pages")


def page_links(spark, sf):
    found = _pages(spark, sf).select("page_id", F.posexplode(H.hrefs(F.col("html"))).alias("position", "href"))
    return found.withColumn("position", F.col("position").cast("long"))


def page_classes(spark, sf):
    return _pages(spark, sf).select("page_id", F.array_join(H.classes(F.col("html")), " ").alias("classes"))


def page_metas(spark, sf):
    """Metadata of pages whose title is rewritten into the tags a news site carries."""
    title = F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1)
    html = F.concat(
        F.lit('<meta property="og:title" content="'), F.replace(title, F.lit('"'), F.lit("")),
        F.lit("\" name='twitter'><meta content='"), F.col("page_id").cast("string"),
        F.lit(" minutes' name=twitter:data2><meta name=\"empty\" content=\"\"><meta name=\"twitter:data2\" content=\"9 min\">"), F.col("html"))
    m = H.metas(html)
    return _pages(spark, sf).select(
        "page_id", F.size(m).cast("long").alias("n"), F.try_element_at(m, F.lit("twitter:data2")).alias("reading_time"),
        F.length(F.try_element_at(m, F.lit("og:title"))).cast("long").alias("title_chars"))


def page_media(spark, sf):
    """Images and time stamps of pages whose list items are rewritten into them."""
    image = F.regexp_replace("html", r"<li><a href=\"([^\"]*)\">", '<img alt="x>y" src="$1"/><time datetime="2024-01-0$1" class="b a">')
    html = F.replace(image, F.lit("</a></li>"), F.lit("</time>"))
    t = H.times(html)
    return _pages(spark, sf).select(
        "page_id", F.array_join(H.srcs(html), "|").alias("srcs"), F.size(t).cast("long").alias("n_times"),
        F.get(t, F.lit(0))["text"].alias("first_text"), F.get(t, F.lit(0))["datetime"].alias("first_datetime"),
        F.array_join(F.get(t, F.lit(0))["class"], "+").alias("first_class"))


def _tag_texts(tag: str):
    def run(spark, sf):
        texts = H.page_texts(F.col("html"))[f"{tag}_all_texts"]
        return _pages(spark, sf).select("page_id", texts.alias("t")).select("page_id", F.array_join("t", "|").alias("texts"))
    return run


def page_paragraphs(spark, sf):
    """Bodies put together from the paragraph texts (nested as the pages have them)."""
    from opinionlake.functions.text import body_from_paragraphs

    texts = _pages(spark, sf).withColumn("p", H.page_texts(F.col("html"))["p_all_texts"])
    return texts.select("page_id", body_from_paragraphs(F.col("p")).alias("body_text"))


def flat_paragraphs(spark, sf):
    """The same from paragraphs cut by pattern, which SQL can repeat."""
    from opinionlake.functions.text import body_from_paragraphs

    flat = F.regexp_extract_all("html", F.lit(r"<p>([^<]*)</p>"), F.lit(1))
    return _pages(spark, sf).select("page_id", body_from_paragraphs(flat, phrases=("with the", "et la")).alias("body_text"))


def listing_links(spark, sf):
    """Links of pages whose navigation list is renamed to a listing container."""
    listing = F.replace(F.replace("html", F.lit("<ul>"), F.lit('<div class="wide post-container">')), F.lit("</ul>"), F.lit("</div>"))
    found = H.listing_links(_pages(spark, sf).withColumn("html", listing), "html", _SITE, ["page_id"])
    return found.select("page_id", "url")


def page_records(spark, sf):
    """Whole bronze records: counts of every list."""
    rows = H.extract_pages(_pages(spark, sf))
    return rows.select("url", *[F.size(c).cast("long").alias(f"n_{c}") for c in
                                ("h1_all_texts", "p_all_texts", "li_all_texts", "all_hrefs", "all_src", "all_meta")], "error", "status")


def page_errors(spark, sf):
    """Records of pages that are missing or cannot be parsed: each says so, and none ends the job."""
    page = F.when(F.col("page_id") % 5 == 0, F.lit("<p>x<![foo[bar]]></p>")).when(F.col("page_id") % 7 != 0, F.col("html"))
    rows = H.extract_pages(_pages(spark, sf).withColumn("html", page))
    kind = F.when(F.col("error") == "no content", F.col("error")).when(F.col("error").isNotNull(), F.lit("malformed"))
    return rows.groupBy("status", kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"), F.count("p_all_texts").alias("with_texts"))


_DEC = "replace(replace(replace(replace({0}, '&quot;', '\"'), '&middot;', '·'), '&copy;', '©'), '&amp;', '&')"

QUERIES = [
    Query("page_links", page_links, f"""
SELECT page_id, i - 1 AS position, {_DEC.format('h')} AS href FROM (
  SELECT page_id, unnest(hs) AS h, generate_subscripts(hs, 1) AS i
  FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS hs FROM pages))"""),
    Query("page_classes", page_classes, """
SELECT page_id, coalesce(array_to_string(list_sort(list_distinct(regexp_extract_all(html, 'class="([^" ]+)"', 1))), ' '), '') AS classes FROM pages"""),
    Query("page_metas", page_metas, f"""
SELECT page_id, 2 AS n, '9 min' AS reading_time, length({_DEC.format("replace(regexp_extract(html, '(?s)<title>(.*?)</title>', 1), chr(34), '')")}) AS title_chars
FROM pages"""),
    Query("page_media", page_media, f"""
SELECT page_id, array_to_string(list_transform(h, lambda x: {_DEC.format('x')}), '|') AS srcs, len(h) AS n_times, t[1] AS first_text,
  '2024-01-0' || h[1] AS first_datetime, 'b+a' AS first_class
FROM (SELECT page_id, regexp_extract_all(html, '<li><a href="([^"]*)">', 1) AS h, regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)<', 1) AS t FROM pages)"""),
    *[Query(f"page_texts_{tag}", _tag_texts(tag), f"""
SELECT page_id, coalesce(array_to_string(list_filter(list_transform(regexp_extract_all(html, '<{tag}(?: [^>]*)?>((?:[^<]|<a[^>]*>|</a>)*)</{tag}>', 1),
  lambda x: trim({_DEC.format("regexp_replace(x, '<[^>]+>', '', 'g')")})), lambda x: x <> ''), '|'), '') AS texts FROM pages""") for tag in ("h1", "a", "li")],
    Query("page_paragraphs", page_paragraphs),
    Query("flat_paragraphs", flat_paragraphs, f"""
SELECT page_id, nullif(array_to_string(list_filter(list_transform(regexp_extract_all(html, '<p>([^<]*)</p>', 1),
  lambda x: trim(regexp_replace({_DEC.format('x')}, '\\s+', ' ', 'g'))), lambda x: length(x) >= 80 AND NOT contains(x, 'with the') AND NOT contains(x, 'et la')), ' '), '') AS body_text
FROM pages"""),
    Query("listing_links", listing_links, f"""
SELECT page_id, url FROM (
  SELECT page_id, CASE WHEN h LIKE '/%' THEN '{_SITE}' || h ELSE h END AS url
  FROM (SELECT page_id, {_DEC.format("regexp_extract(html, '<ul><li><a href=\"([^\"]*)\"', 1)")} AS h FROM pages) WHERE h <> '')
QUALIFY row_number() OVER (PARTITION BY url ORDER BY page_id) = 1"""),
    Query("page_records", page_records),
    Query("page_errors", page_errors, """
SELECT CASE WHEN page_id % 5 = 0 OR page_id % 7 = 0 OR html IS NULL THEN 'error' END AS status,
  CASE WHEN page_id % 5 = 0 THEN 'malformed' WHEN page_id % 7 = 0 OR html IS NULL THEN 'no content' END AS kind,
  count(*) AS n, count(*) FILTER (WHERE NOT (page_id % 5 = 0 OR page_id % 7 = 0 OR html IS NULL)) AS with_texts FROM pages GROUP BY ALL"""),
]
