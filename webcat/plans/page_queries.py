"""Registered queries on the given pages: tokens, links, curation, text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webcat.functions import urls as U
from webcat.functions.text import decode_entities
from webcat.operators import content, curation, frontier, links, tokens
from webcat.operators.curation import StatusRule
from webcat.plans import sqltext as Q
from webcat.plans.inputs import given_pages


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given_pages(spark, sf_dir)


def _links(spark, sf_dir):
    return links.extract_links(_pages(spark, sf_dir))


def _unique(spark, sf_dir):
    return links.unique_links(_links(spark, sf_dir))


# --- tokens and elements -----------------------------------------------------------------------

def token_counts(spark, sf_dir):
    return tokens.page_tokens(_pages(spark, sf_dir)).groupBy("page_id", "kind").agg(
        F.count("*").alias("n_tokens"), F.sum(F.length("token")).alias("n_chars")
    )


def page_tokens(spark, sf_dir):
    return tokens.page_tokens(_pages(spark, sf_dir))


def element_spans(spark, sf_dir):
    return tokens.page_elements(_pages(spark, sf_dir)).select(
        "page_id", "pos", "end_pos", "tag", F.size("attrs").alias("n_attrs"), F.col("attrs")["href"].alias("href")
    )


def element_text(spark, sf_dir):
    return tokens.element_text(_pages(spark, sf_dir))


# --- links -------------------------------------------------------------------------------------

def links_per_site_and_method(spark, sf_dir):
    return _links(spark, sf_dir).filter(F.col("link_type") == "internal").groupBy(
        U.site_name(F.col("source_page")).alias("site_name"), "discovery_method"
    ).agg(F.count_distinct("url").alias("n_urls"))


def anchor_links(spark, sf_dir):
    return links.links_by_method(_pages(spark, sf_dir), "anchor")


def comment_links(spark, sf_dir):
    # the given comments hold no address, so each is read together with the page's own one
    marked = _pages(spark, sf_dir).withColumn(
        "html", F.regexp_replace("html", "<!-- ad ([0-9]+) -->", F.concat(F.lit("<!-- ad $1 at /ads/$1.html -->")))
    )
    return links.links_by_method(marked, "comment")


def script_links(spark, sf_dir):
    marked = _pages(spark, sf_dir).withColumn(
        "html", F.regexp_replace("html", r"track\(([0-9]+)\);", 'location.href = "/track/$1"; go("/a/$1/a");')
    )
    return links.links_by_method(marked, "javascript")


def all_links(spark, sf_dir):
    return _links(spark, sf_dir)


def unique_links(spark, sf_dir):
    return _unique(spark, sf_dir)


def source_page_stats(spark, sf_dir):
    pages = _pages(spark, sf_dir)
    return links.source_page_stats(pages, links.extract_links(pages))


# --- curation ----------------------------------------------------------------------------------

RULES = [
    StatusRule("internal_only", "keep"), StatusRule.parse("contains_th", "skip"), StatusRule.parse("method_css", "skip"),
    StatusRule.parse("skip_extension_and", "pending"), StatusRule("external", "skip"),
]
_RULES_SQL = """
CASE WHEN link_type = 'external' THEN 'skip' WHEN lower(url) LIKE '%.and' THEN 'pending'
     WHEN discovery_method = 'css' THEN 'skip' WHEN contains(lower(url), 'th') THEN 'skip'
     WHEN link_type = 'internal' THEN 'keep' ELSE status END"""
_UPDATED = f"updated AS (SELECT * EXCLUDE (status), status AS old_status, {_RULES_SQL} AS status FROM ulink)"


def _updated(spark, sf_dir):
    return curation.update_status(_unique(spark, sf_dir), RULES)


def status_update(spark, sf_dir):
    return _updated(spark, sf_dir)


def status_changes(spark, sf_dir):
    return curation.update_counts(_updated(spark, sf_dir))


def kept_links(spark, sf_dir):
    return curation.select_status(_updated(spark, sf_dir)).select("site_name", "url", "page_id")


def link_breakdown(spark, sf_dir):
    return curation.link_breakdown(_updated(spark, sf_dir))


def link_preview(spark, sf_dir):
    return curation.link_preview(_unique(spark, sf_dir), 25)


def _visited(spark, sf_dir):
    """Pages whose address is also a link target: every second link counts as stored."""
    return _unique(spark, sf_dir).filter(F.length("url") % 2 == 0).select("url")


def uncrawled_links(spark, sf_dir):
    return curation.uncrawled(_links(spark, sf_dir), _visited(spark, sf_dir))


def failed_links(spark, sf_dir):
    return curation.not_scraped(_updated(spark, sf_dir), _visited(spark, sf_dir)).select("site_name", "url")


def scrape_summary(spark, sf_dir):
    return curation.scrape_summary(_updated(spark, sf_dir), _visited(spark, sf_dir))


# --- frontier ----------------------------------------------------------------------------------

def site_edges(found: DataFrame) -> DataFrame:
    """Graph of the stored corpus: (src, dst), each page to its link targets and each target to the pages that name it.

    The given links lead to no stored page, so targets stand for pages that link back. One row per link and
    direction; a target named by very many pages is a hub that the walk itself splits.
    """
    pairs = found.select(F.col("source_page").alias("src"), F.lower("url").alias("dst"))
    return pairs.union(pairs.select("dst", "src")).distinct()


BUDGET = 60
WALK = 400


def frontier_reach(spark, sf_dir):
    found = _links(spark, sf_dir)
    edges = site_edges(found)
    seeds = found.groupBy(F.regexp_extract("source_page", "^[a-z]+://([^/?#]*)", 1)).agg(F.min("source_page").alias("url")).select("url")
    return frontier.frontier(edges, seeds, BUDGET)


def crawl_walk(spark, sf_dir):
    """A walk on which addresses of some lengths redirect to their first neighbour, in chains and loops, and others fail."""
    found = _links(spark, sf_dir)
    edges = site_edges(found)
    nodes = edges.groupBy("src").agg(F.min("dst").alias("first"))
    redirects = nodes.filter(F.length("src") % 3 == 1).select(F.col("src").alias("from_url"), F.col("first").alias("to_url"))
    failed = nodes.filter(F.length("src") % 7 == 3).select(F.col("src").alias("url"))
    seeds = found.groupBy(F.regexp_extract("source_page", "^[a-z]+://([^/?#]*)", 1)).agg(F.min("source_page").alias("url")).select("url")
    return frontier.walk(edges, seeds, WALK, redirects, failed).select("url", "depth", "state", "final_url")


def redirect_duplicates(spark, sf_dir):
    found = _unique(spark, sf_dir)
    # every page without www. in front redirects to its first link
    redirects = found.groupBy(F.col("source_page").alias("from_url")).agg(F.min("url").alias("to_url"))
    visited = _pages(spark, sf_dir).filter(~F.col("url").contains("//www.")).select("url")
    return frontier.resolve_redirects(found, redirects, visited).select("site_name", "url", "is_duplicate")


def crawl_stats(spark, sf_dir):
    pages = _pages(spark, sf_dir).select("url")
    failed = pages.filter(F.contains("url", F.lit("#top")))
    return frontier.crawl_stats(pages, _links(spark, sf_dir), failed, pages)


# --- text --------------------------------------------------------------------------------------

def titles(spark, sf_dir):
    return content.titles(_pages(spark, sf_dir))


def clean_text(spark, sf_dir):
    return content.clean_text(_pages(spark, sf_dir))


def full_text(spark, sf_dir):
    return content.full_text(_pages(spark, sf_dir))


KEYWORDS = ["Option", "THEREA", "ouver"]


def keyword_pages(spark, sf_dir):
    return content.pages_with_keywords(_pages(spark, sf_dir), KEYWORDS)


def content_ratio(spark, sf_dir):
    return content.content_ratio(_pages(spark, sf_dir))


def empty_text_pages(spark, sf_dir):
    # beside the given pages, the same pages with their markup only
    pages = _pages(spark, sf_dir)
    hollow = pages.select(
        (-F.col("page_id") - 1).alias("page_id"), "url",
        F.regexp_replace("html", r"(?s)<title>.*</article>|<footer>.*", " <br> ").alias("html"),
    )
    return content.empty_text_pages(pages.unionByName(hollow))


def entity_text(spark, sf_dir):
    return _pages(spark, sf_dir).select(
        "page_id", decode_entities(F.regexp_extract("html", r"(?s)<footer>(.*?)</footer>", 1)).alias("footer"),
        decode_entities(F.concat(
            F.lit("&lt;p&gt; &amp;lt; &#233;&#xE9; &eacute; &euro; &unknown; &#"), F.col("page_id") + 200, F.lit(";")
        )).alias("decoded"),
    )


def extraction_text(spark, sf_dir):
    return content.extraction_text(_pages(spark, sf_dir))


QUERIES = {f.__name__: f for f in [
    page_tokens, token_counts, element_spans, element_text, links_per_site_and_method, anchor_links, comment_links, script_links,
    all_links, unique_links, source_page_stats, status_update, status_changes, kept_links, link_breakdown,
    link_preview, uncrawled_links, failed_links, scrape_summary, frontier_reach, crawl_walk, redirect_duplicates, crawl_stats,
    titles, clean_text, full_text, keyword_pages, content_ratio, empty_text_pages, entity_text, extraction_text,
]}

_TEXT_OF_TOKEN = f"CASE WHEN kind = 'text' THEN {Q.decoded('token')} ELSE '' END"
_TEXTS = f"txt AS (SELECT page_id, pos, {Q.decoded('token')} AS text FROM tok WHERE kind = 'text')"
_FULL = f"""
fulltext AS (
  SELECT p.page_id, {Q.squeeze("coalesce(string_agg(t.text, '' ORDER BY t.pos), '')")} AS full_text
  FROM pages p LEFT JOIN txt t USING (page_id) GROUP BY p.page_id
)"""
_CLEAN = f"""
hide AS (SELECT page_id, pos, end_pos FROM el WHERE tag IN ('nav', 'footer', 'header')),
kept AS (
  SELECT t.page_id, t.pos, t.text FROM txt t
  WHERE NOT EXISTS (SELECT 1 FROM hide h WHERE h.page_id = t.page_id AND h.pos < t.pos AND t.pos < h.end_pos)
),
cleaned AS (
  SELECT p.page_id, p.url, {Q.squeeze("coalesce(string_agg(k.text, '' ORDER BY k.pos), '')")} AS clean_text
  FROM pages p LEFT JOIN kept k USING (page_id) GROUP BY p.page_id, p.url
)"""
_TITLE = Q.strip(Q.decoded("regexp_extract(html, '<title>(.*?)</title>', 1, 's')"))
_LINK_ROWS = "page_id, source_page, url, discovery_method, link_type, status, notes"
_VISITED = "visited AS (SELECT url FROM ulink WHERE length(url) % 2 = 0)"


def _marked_links(path: str, method: str) -> str:
    """Links added per page: one relative address with the page's running number."""
    return f"""
SELECT page_id, url AS source_page, regexp_extract(url, '^([a-z]+)://', 1) || '://' || {Q.host('url')} || {path} AS url,
  '{method}' AS discovery_method, 'internal' AS link_type, 'pending' AS status, '' AS notes
FROM pages"""


ORACLE = {
    "page_tokens": Q.with_tokens() + " SELECT page_id, pos, kind, tag, token FROM tok",
    "token_counts": Q.with_tokens() + """
SELECT page_id, kind, count(*) AS n_tokens, CAST(sum(length(token)) AS BIGINT) AS n_chars FROM tok GROUP BY page_id, kind""",
    "element_spans": Q.with_tokens(Q.SPANS) + f"""
SELECT e.page_id, e.pos, e.end_pos, e.tag,
  CAST((length(t.token) - length(replace(t.token, '=', ''))) AS INTEGER) AS n_attrs,
  CASE WHEN contains(t.token, 'href=') THEN {Q.decoded("regexp_extract(t.token, 'href=\"([^\"]*)\"', 1)")} END AS href
FROM el e JOIN tok t ON t.page_id = e.page_id AND t.pos = e.pos""",
    "element_text": Q.with_tokens(Q.SPANS, _TEXTS) + f"""
SELECT e.page_id, e.pos, e.tag, coalesce(string_agg({Q.strip('t.text')}, '' ORDER BY t.pos), '') AS text
FROM el e LEFT JOIN txt t ON t.page_id = e.page_id AND t.pos > e.pos AND t.pos < e.end_pos
GROUP BY e.page_id, e.pos, e.tag""",
    "links_per_site_and_method": Q.PAGE_LINKS + f"""
SELECT {Q.site('source_page')} AS site_name, discovery_method, count(DISTINCT url) AS n_urls FROM link GROUP BY 1, 2""",
    "anchor_links": Q.PAGE_LINKS + f" SELECT {_LINK_ROWS} FROM link",
    "comment_links": _marked_links("'/ads/' || regexp_extract(html, '<!-- ad ([0-9]+) -->', 1) || '.html'", "comment"),
    "script_links": _marked_links("'/track/' || regexp_extract(html, 'track\\(([0-9]+)\\);', 1)", "javascript"),
    "all_links": Q.PAGE_LINKS + f" SELECT {_LINK_ROWS} FROM link",
    "unique_links": Q.SITE_LINKS + " SELECT * FROM ulink",
    "source_page_stats": Q.PAGE_LINKS + f"""
SELECT p.page_id, p.url, {_TITLE} AS title, 'success' AS fetch_status, count(l.url) AS links_found,
  CASE WHEN count(l.url) > 0 THEN ['anchor'] ELSE [] END AS discovery_methods
FROM pages p LEFT JOIN link l USING (page_id) GROUP BY p.page_id, p.url, p.html""",
    "status_update": Q.SITE_LINKS + f", {_UPDATED} SELECT * FROM updated",
    "status_changes": Q.SITE_LINKS + f""", {_UPDATED}
SELECT status, count(*) AS n_changed FROM updated WHERE status <> old_status GROUP BY status""",
    "kept_links": Q.SITE_LINKS + f", {_UPDATED} SELECT site_name, url, page_id FROM updated WHERE status = 'keep'",
    "link_breakdown": Q.SITE_LINKS + f""", {_UPDATED}
SELECT CASE WHEN grouping(status) = 0 THEN 'status' WHEN grouping(discovery_method) = 0 THEN 'method' ELSE 'type' END AS dimension,
  coalesce(status, discovery_method, link_type) AS value, count(*) AS n_links
FROM updated GROUP BY GROUPING SETS ((status), (discovery_method), (link_type))""",
    "link_preview": Q.SITE_LINKS + " SELECT * FROM ulink ORDER BY page_id, url LIMIT 25",
    "uncrawled_links": Q.SITE_LINKS + f", {_VISITED} SELECT url FROM link EXCEPT SELECT url FROM visited",
    "failed_links": Q.SITE_LINKS + f""", {_UPDATED}, {_VISITED}
SELECT site_name, url FROM updated WHERE status = 'keep' AND url NOT IN (SELECT url FROM visited)""",
    "scrape_summary": Q.SITE_LINKS + f""", {_UPDATED}, {_VISITED}
SELECT site_name, count(*) AS total_links, count(*) FILTER (status = 'keep') AS filtered_links,
  count(*) FILTER (status = 'keep' AND url IN (SELECT url FROM visited)) AS scraped,
  count(*) FILTER (status = 'keep' AND url NOT IN (SELECT url FROM visited)) AS failed
FROM updated GROUP BY site_name""",
    "frontier_reach": Q.with_tokens(Q.ANCHORS, Q.LINKS).replace("WITH ", "WITH RECURSIVE ", 1) + f""",
pair AS (SELECT DISTINCT source_page AS page, lower(url) AS target FROM link),
edge AS (SELECT page AS src, target AS dst FROM pair UNION SELECT target, page FROM pair),
seed AS (SELECT DISTINCT min(source_page) AS url FROM link GROUP BY {Q.host('source_page')}),
walk(url, depth) USING KEY (url) AS (
  SELECT url, 0 FROM seed
  UNION
  SELECT e.dst, min(w.depth) + 1 FROM walk w JOIN edge e ON e.src = w.url
  WHERE e.dst NOT IN (SELECT url FROM recurring.walk) GROUP BY e.dst
)
SELECT url, CAST(depth AS INTEGER) AS depth FROM walk ORDER BY depth, url LIMIT {BUDGET}""",
    "crawl_walk": Q.with_tokens(Q.ANCHORS, Q.LINKS).replace("WITH ", "WITH RECURSIVE ", 1) + f""",
pair AS (SELECT DISTINCT source_page AS page, lower(url) AS target FROM link),
edge AS (SELECT page AS src, target AS dst FROM pair UNION SELECT target, page FROM pair),
seed AS (SELECT DISTINCT min(source_page) AS url FROM link GROUP BY {Q.host('source_page')}),
gone AS (SELECT DISTINCT src AS url FROM edge WHERE length(src) % 7 = 3),
hop AS (SELECT src AS url, min(dst) AS nxt FROM edge WHERE length(src) % 3 = 1 AND length(src) % 7 <> 3 GROUP BY src),
chain(url, nxt) AS (SELECT url, nxt FROM hop UNION SELECT c.url, h.nxt FROM chain c JOIN hop h ON h.url = c.nxt),
fate AS (
  SELECT url, CASE WHEN e IN (SELECT url FROM gone) THEN NULL ELSE e END AS final
  FROM (SELECT url, max(CASE WHEN nxt NOT IN (SELECT url FROM hop) THEN nxt END) AS e FROM chain GROUP BY url)
  UNION ALL SELECT url, NULL FROM gone
),
node AS (SELECT dst AS url FROM edge UNION SELECT url FROM seed),
asked AS (
  SELECT n.url AS via, n.url, 0 AS hop, f.final AS final_url,
    CASE WHEN f.url IS NULL THEN 'fetched' WHEN f.final IS NULL THEN 'failed' ELSE 'redirect' END AS state
  FROM node n LEFT JOIN fate f ON f.url = n.url
  UNION ALL SELECT n.url, f.final, 1, NULL, 'fetched' FROM node n JOIN fate f ON f.url = n.url WHERE f.final IS NOT NULL
),
walk(url, depth, key, state, final_url) USING KEY (url) AS (
  SELECT a.url, 0, min(struct_pack(via := a.via, hop := a.hop)), min(a.state), min(a.final_url)
  FROM seed s JOIN asked a ON a.via = s.url GROUP BY a.url
  UNION
  SELECT a.url, min(w.depth) + 1, min(struct_pack(via := a.via, hop := a.hop)), min(a.state), min(a.final_url)
  FROM walk w JOIN edge e ON e.src = w.url JOIN asked a ON a.via = e.dst
  WHERE w.state = 'fetched' AND e.dst NOT IN (SELECT url FROM recurring.walk) AND a.url NOT IN (SELECT url FROM recurring.walk) GROUP BY a.url
)
SELECT url, CAST(depth AS INTEGER) AS depth, state, final_url FROM walk ORDER BY depth, key, url LIMIT {WALK}""",
    "redirect_duplicates": Q.SITE_LINKS + """,
redirect AS (SELECT source_page AS from_url, min(url) AS to_url FROM ulink GROUP BY source_page)
SELECT site_name, url, url IN (
  SELECT to_url FROM redirect WHERE from_url IN (SELECT url FROM pages WHERE url NOT LIKE '%//www.%')) AS is_duplicate
FROM ulink""",
    "crawl_stats": Q.PAGE_LINKS + """,
n AS (
  SELECT (SELECT count(*) FROM pages) AS pages_crawled,
    (SELECT count(DISTINCT url) FROM pages WHERE url LIKE '%#top%') AS urls_failed,
    (SELECT count(DISTINCT url) FROM link) AS unique_links, (SELECT count(DISTINCT url) FROM pages) AS visited
)
SELECT pages_crawled, urls_failed, unique_links, pages_crawled / greatest(unique_links, 1) AS coverage_ratio,
  visited / greatest(unique_links, 1) AS visited_ratio FROM n""",
    "titles": f"SELECT page_id, {_TITLE} AS title FROM pages",
    "clean_text": Q.with_tokens(Q.SPANS, _TEXTS, _CLEAN) + " SELECT page_id, clean_text FROM cleaned",
    "full_text": Q.with_tokens(_TEXTS, _FULL) + " SELECT page_id, full_text FROM fulltext",
    "keyword_pages": Q.with_tokens(Q.SPANS, _TEXTS, _CLEAN) + f"""
SELECT page_id, c.url, {_TITLE} AS title FROM cleaned c JOIN pages p USING (page_id)
WHERE """ + " OR ".join(f"contains(lower(clean_text), '{k.lower()}')" for k in KEYWORDS),
    "content_ratio": Q.with_tokens(_TEXTS) + f""",
joined AS (SELECT page_id, string_agg(text, '' ORDER BY pos) AS text FROM txt GROUP BY page_id),
size AS (
  SELECT page_id, sum(length(token)) AS n FROM tok
  WHERE kind NOT IN ('script', 'style') AND coalesce(tag, '') NOT IN ('meta', 'link') GROUP BY page_id
)
SELECT page_id, CAST(length({Q.strip('text')}) AS DOUBLE) / n AS ratio FROM joined JOIN size USING (page_id)""",
    "empty_text_pages": "SELECT -page_id - 1 AS page_id, 'No text content extracted' AS error FROM pages",
    "entity_text": f"""
SELECT page_id, {Q.decoded("regexp_extract(html, '<footer>(.*?)</footer>', 1, 's')")} AS footer,
  '<p> &lt; éé é € &unknown; ' || chr(CAST(page_id + 200 AS INTEGER)) AS decoded FROM pages""",
    "extraction_text": Q.with_tokens(_TEXTS, _FULL) + """
SELECT page_id, CASE WHEN length(t) <= 50000 THEN t
  ELSE chr(10) || chr(10) || 'FULL PAGE CONTENT:' || chr(10) || substr(full_text, 1, 49900) || '...' END AS text
FROM (SELECT page_id, full_text,
  chr(10) || chr(10) || 'FULL PAGE CONTENT:' || chr(10) || full_text AS t FROM fulltext)""",
}
