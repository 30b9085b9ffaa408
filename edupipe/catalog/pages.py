"""Fetched pages: blocks, links and catalogue items."""

from pyspark.sql import functions as F

from edupipe.catalog.registry import query
from edupipe.functions.links import with_main_link
from edupipe.operators import web


# As in HTML, an entity may lack its semicolon.
_TEXT = "trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace({}, '<[^>]*>', '', 'g'), '&quot;?', '\"', 'g'), '&lt;?', '<', 'g'), '&amp;?', '&', 'g'))"

# A block runs from its tag to the end tag.  The pages have one shape, in which paragraphs that begin with
# bold text are never closed and run to the end of the article.
_BLOCKS_SQL = f"""WITH parts AS (SELECT page_id, url, string_split(html, '<') AS cut FROM pages),
    starts AS (SELECT page_id, url, i, regexp_extract(cut[i], '^(h[1-6]|p|li|div|ul|ol)[ >]', 1) AS tag, array_to_string(cut[i:], '<') AS rest
               FROM (SELECT *, unnest(range(2, len(cut) + 1)) AS i FROM parts)),
    bodies AS (SELECT page_id, url, i, tag, regexp_replace(split_part(rest, CASE WHEN rest LIKE 'p><b>%' THEN '</article>' ELSE '</' || tag || '>' END, 1), '^[^>]*>', '') AS body
               FROM starts WHERE tag <> ''),
    texts AS (SELECT page_id, url, i, tag, array_to_string(list_transform(regexp_split_to_array(body, '<[^>]*>'), lambda x: {_TEXT.format("x")}), '') AS text FROM bodies)
    SELECT CAST(page_id AS VARCHAR) AS project, url AS main_link, url AS subpage,
           CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS INTEGER) AS position, tag, text FROM texts WHERE text <> ''"""


@query("page_blocks", _BLOCKS_SQL)
def page_blocks(t):
    return web.page_blocks(t.pages, "page_id", "url", "url", "html")


@query(
    "page_headings",
    f"""SELECT project, tag, text FROM (
          SELECT CAST(page_id AS VARCHAR) AS project, 'h1' AS tag, {_TEXT.format("unnest(regexp_extract_all(html, '<h1>(.*?)</h1>', 1))")} AS text FROM pages
          UNION ALL
          SELECT CAST(page_id AS VARCHAR), 'li', {_TEXT.format("unnest(regexp_extract_all(html, '<li>(.*?)</li>', 1))")} FROM pages)
        WHERE text <> ''""",
)
def page_headings(t):
    blocks = web.page_blocks(t.pages, "page_id", "url", "url", "html")
    return blocks.where(F.col("tag").isin("h1", "li")).select("project", "tag", "text")


@query(
    "page_links",
    """SELECT DISTINCT page_id, link FROM (
         SELECT page_id, url, regexp_extract(url, '^(https?://[^/]+)', 1) || replace(unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)), '&amp;', '&') AS link FROM pages)
       WHERE link <> url AND NOT contains(link, '#')""",
)
def page_links(t):
    found = web.page_links(t.pages, "page_id", "url", "html")
    return found.select("page_id", F.explode("links").alias("link"))


def _hrefs():
    return F.regexp_extract_all("html", F.lit('href="([^"]*)"'), 1)


@query(
    "links_with_main",
    """SELECT page_id, len(links) AS num_subpages, array_to_string(list_sort(links), ' ') AS links FROM (
         SELECT page_id, list_distinct(list_concat([regexp_replace(url, '/+$', '') || CASE WHEN page_id % 2 = 0 THEN '/' ELSE '' END],
                list_filter(regexp_extract_all(html, 'href="([^"]*)"', 1), lambda x: true))) AS links FROM pages)""",
)
def links_with_main(t):
    bare = F.regexp_replace("url", "/+$", "")
    # Every other page lists its own address already, with a trailing slash.
    own = F.when(F.col("page_id") % 2 == 0, F.array(F.concat(bare, F.lit("/")))).otherwise(F.array().cast("array<string>"))
    linked = t.pages.select("page_id", with_main_link(F.concat(own, _hrefs()), bare).alias("links"))
    return linked.select(
        "page_id", F.size("links").cast("long").alias("num_subpages"), F.array_join(F.array_sort("links"), " ").alias("links")
    )


@query(
    "link_counts",
    """SELECT page_id, link, count(link) OVER (PARTITION BY page_id) AS num_subpages FROM (
         SELECT page_id, unnest(list_concat(regexp_extract_all(html, 'href="([^"]*)"', 1), [url])) AS link FROM pages)
       WHERE NOT contains(link, '#')""",
)
def link_counts(t):
    linked = t.pages.select("page_id", "url", F.concat(_hrefs(), F.array("url")).alias("links"))
    rows = web.link_rows(linked, "page_id", "url", "links", "#")
    return rows.select("page_id", "link", F.col("num_subpages").cast("long").alias("num_subpages"))


_LINKS_SQL = f"""SELECT page_id, {_TEXT.format("regexp_extract(a, '>([^<]*)</a>', 1)")} AS title, replace(regexp_extract(a, 'href="([^"]*)"', 1), '&amp;', '&') AS link
       FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a [^>]*href="[^"]*"[^>]*>[^<]*</a>')) AS a FROM pages)
       WHERE trim(regexp_extract(a, '>([^<]*)</a>', 1)) <> '' AND regexp_extract(a, 'href="([^"]*)"', 1) <> ''"""


@query("page_anchors", _LINKS_SQL)
def page_anchors(t):
    return web.anchors(t.pages, "page_id", "html")


@query("catalogue_items", _LINKS_SQL)
def catalogue_items(t):
    """Every item of the pages' lists holds one link with its title."""
    return web.catalogue_items(t.pages, "page_id", "html", ("li", ""), ("a", ""), ("a", ""))
