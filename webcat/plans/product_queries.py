"""Registered queries on the product pages derived from ``part``: every link method, structured data, JavaScript."""

from __future__ import annotations

from pyspark.sql import functions as F

from webcat.operators import content, jsdep, links, structured
from webcat.operators.links import PROFILES
from webcat.plans import sqltext as Q
from webcat.plans.inputs import FILLER, given_pages, product_pages
from webcat.sources.readers import html_only

METHOD_QUERIES = {
    "product_anchor_links": "anchor", "area_links": "area", "product_script_links": "javascript", "meta_links": "meta",
    "form_links": "form", "data_links": "data_attribute", "css_links": "css", "jsonld_links": "json_ld",
    "microdata_links": "microdata", "header_links": "http_header", "product_comment_links": "comment",
}


def _method_query(method: str):
    def query(spark, sf_dir):
        return links.links_by_method(product_pages(spark, sf_dir), method)

    return query


def product_links(spark, sf_dir):
    return links.extract_links(product_pages(spark, sf_dir))


def links_by_profile(spark, sf_dir):
    return links.extract_links_by_profile(product_pages(spark, sf_dir), PROFILES).groupBy("profile", "discovery_method").agg(
        F.count("*").alias("n_links"), F.count_distinct("page_id").alias("n_pages"), F.min("url").alias("first_url")
    )


def html_only_pages(spark, sf_dir):
    return html_only(product_pages(spark, sf_dir)).select("page_id", "content_type")


def rendering_breakdown(spark, sf_dir):
    return jsdep.rendering_breakdown(product_pages(spark, sf_dir))


def description_sections(spark, sf_dir):
    return content.description_sections(product_pages(spark, sf_dir))


def product_extraction_text(spark, sf_dir):
    # every tenth page is made long enough to be cut
    pages = product_pages(spark, sf_dir).withColumn(
        "html",
        F.when(
            F.col("page_id") % 10 == 0,
            F.concat("html", F.lit("<p>"), F.repeat(F.lit("0123456789"), 6000), F.lit("</p>")),
        ).otherwise(F.col("html")),
    )
    return content.extraction_text(pages).select(
        "page_id", F.length("text").alias("n_chars"), F.split_part("text", F.lit("FULL PAGE CONTENT:"), F.lit(1)).alias("sections"),
        F.endswith("text", F.lit("...")).alias("cut"),
    )


def jsonld_items(spark, sf_dir):
    return structured.json_ld_items(product_pages(spark, sf_dir)).select(
        "page_id", "item_no", "type", F.get_json_object("item", "$.url").alias("url"),
        F.get_json_object("item", "$.brand.logo").alias("logo"),
    )


def microdata_items(spark, sf_dir):
    return structured.microdata_items(product_pages(spark, sf_dir))


def meta_tags(spark, sf_dir):
    return structured.meta_tags(product_pages(spark, sf_dir))


def opengraph(spark, sf_dir):
    return structured.opengraph(product_pages(spark, sf_dir))


def fallback_products(spark, sf_dir):
    return structured.fallback_products(product_pages(spark, sf_dir)).drop("pos")


def product_fields(spark, sf_dir):
    """One row per product, whatever number of selectors found it."""
    return structured.fallback_products(product_pages(spark, sf_dir)).groupBy("page_id", "name", "price", "currency").agg(
        F.count("*").alias("n_selectors"), F.max("description").alias("description")
    )


def prices(spark, sf_dir):
    found = structured.parse_price(F.regexp_extract("html", r'class="price"[^>]*>([^<]*)<', 1))
    odd = structured.parse_price(F.concat(F.lit("from "), F.col("page_id"), F.lit(" to 9,000")))
    return product_pages(spark, sf_dir).select(
        "page_id", found.alias("price"), odd.alias("from_price"), structured.parse_price(F.lit("n/a")).alias("no_price")
    )


def organizations(spark, sf_dir):
    return structured.organization_info(product_pages(spark, sf_dir))


def structured_data(spark, sf_dir):
    return structured.structured_data(product_pages(spark, sf_dir)).select(
        "page_id", F.size("json_ld").cast("int").alias("n_json_ld"), F.size("microdata").alias("n_microdata"),
        F.col("meta_tags")["keywords"].alias("keywords"), F.col("opengraph")["title"].alias("og_title"),
        F.size("products").alias("n_products"), F.col("organization.telephone").alias("telephone"), "extraction_methods",
    )


def js_features(spark, sf_dir):
    return jsdep.js_features(product_pages(spark, sf_dir))


def js_scores(spark, sf_dir):
    return jsdep.js_scores(jsdep.js_features(product_pages(spark, sf_dir))).select(
        "page_id", "score", "confidence", "js_dependent"
    )


def strict_js_scores(spark, sf_dir):
    return jsdep.js_scores(jsdep.js_features(product_pages(spark, sf_dir)), strict=True).select(
        "page_id", "score", "confidence", "js_dependent"
    )


def page_js_scores(spark, sf_dir):
    return jsdep.js_scores(jsdep.js_features(given_pages(spark, sf_dir)))


QUERIES = {
    **{name: _method_query(method) for name, method in METHOD_QUERIES.items()},
    **{f.__name__: f for f in [
        product_links, links_by_profile, html_only_pages, rendering_breakdown, description_sections,
        product_extraction_text, jsonld_items, microdata_items, meta_tags, opengraph, fallback_products, product_fields,
        prices, organizations, structured_data, js_features, js_scores, strict_js_scores, page_js_scores,
    ]},
}

_ROW = """k AS page_id, 'https://' || host || '/p/' || k AS source_page, 'https://' || host || path AS url,
  method AS discovery_method, 'internal' AS link_type, 'pending' AS status, '' AS notes"""


def _method_sql(method: str) -> str:
    return Q.PRODUCT_LINKS + f" SELECT DISTINCT {_ROW} FROM found WHERE method = '{method}' AND path IS NOT NULL"


# profile -> (methods left out, normalised)
_PROFILES = {
    "default": ([], False), "aggressive": ([], True), "conservative": (["css", "json_ld", "microdata"], True),
    "site": (["css", "microdata"], False),
}
# normalising cuts trailing slashes, the fragment, and sorts the one query with two keys
_NORMAL = (
    "CASE WHEN path LIKE '/abs/%' THEN '/abs/' || k || '?a=1&b=2' "
    "WHEN path LIKE '%/' THEN rtrim(path, '/') ELSE path END"
)


def _profile_sql() -> str:
    parts = []
    for name, (without, normal) in _PROFILES.items():
        listed = ", ".join(f"'{m}'" for m in without) or "''"
        path = _NORMAL if normal else "path"
        parts.append(f"""
SELECT '{name}' AS profile, k, 'https://' || host || {path} AS url, min(rank) AS rank
FROM found WHERE path IS NOT NULL AND method NOT IN ({listed}) GROUP BY 1, 2, 3""")
    names = "['anchor','area','javascript','meta','form','data_attribute','css','json_ld','microdata','http_header','comment']"
    return Q.PRODUCT_LINKS + f""", firsts AS ({' UNION ALL '.join(parts)})
SELECT profile, {names}[rank + 1] AS discovery_method, count(*) AS n_links, count(DISTINCT k) AS n_pages, min(url) AS first_url
FROM firsts GROUP BY profile, rank"""


_SECTIONS = Q.PARTS.replace("\npp AS", "pp AS", 1) + """,
lines AS (
  SELECT k, 0 AS o, 'META DESCRIPTION' AS kind, descr AS text FROM pp WHERE k % 2 = 0
  UNION ALL SELECT k, 1, 'OG DESCRIPTION', 'og ' || nm || ' text' FROM pp WHERE k % 3 = 1
  UNION ALL SELECT k, 2, 'TWITTER DESCRIPTION', 'tw ' || k FROM pp WHERE k % 3 = 1
  UNION ALL SELECT k, 3, 'PRODUCT DESCRIPTION', descr FROM pp WHERE NOT shell AND length(descr) > 50
  UNION ALL SELECT k, 4, 'PRODUCT DESCRIPTION', descr FROM pp WHERE NOT shell AND k % 4 = 2 AND length(descr) > 50
)"""
_PP = "WITH" + Q.PARTS
_LINKS_ONLY = "WITH " + _SECTIONS
_FEATURES = f"""
feat AS (
  SELECT k AS page_id, shell AS noscript, shell OR (k % 10 = 5 AND k % 4 <> 1) AS minimal_content, shell AS spa_framework,
    shell AS spa_root, NOT shell AND k % 10 = 3 AS loading, NOT shell AND k % 10 = 4 AS client_routing,
    false AS heavy_js, NOT shell AND k % 4 = 1 AS rich_content, NOT shell AS navigation, NOT shell AS form,
    k % 2 = 0 AND length(descr) > 50 AS meta_description
  FROM pp
),
scored AS (
  SELECT *, CAST(40 * noscript::INT + 35 * minimal_content::INT + 25 * spa_framework::INT + 20 * spa_root::INT
    + 15 * loading::INT + 10 * client_routing::INT + 8 * heavy_js::INT - 15 * rich_content::INT - 10 * navigation::INT
    - 5 * form::INT - 5 * meta_description::INT AS INTEGER) AS score
  FROM feat
)"""


def _scores_sql(threshold: int, columns: str) -> str:
    return f"""
SELECT {columns} score,
  CASE WHEN score >= {threshold} + 15 THEN 'high'
       WHEN score >= {threshold} OR (score >= 30 AND (noscript OR minimal_content)) THEN 'medium' ELSE 'low' END AS confidence,
  score >= {threshold} OR (score >= 30 AND (noscript OR minimal_content)) AS js_dependent
FROM scored"""


_PAGE_FEATURES = f"""
vis AS (
  SELECT t.page_id, t.pos, {Q.strip('t.text')} AS text FROM txt t
  JOIN el b ON b.page_id = t.page_id AND b.tag = 'body' AND b.pos < t.pos AND t.pos < b.end_pos
),
words AS (
  SELECT page_id, len(list_filter(string_split_regex(string_agg(text, '' ORDER BY pos), '\\s+'), lambda w: w <> '')) AS n
  FROM vis GROUP BY page_id
),
rich AS (
  SELECT DISTINCT page_id FROM (
    SELECT e.page_id, e.pos, sum(length({Q.strip('t.text')})) AS n FROM el e
    JOIN txt t ON t.page_id = e.page_id AND e.pos < t.pos AND t.pos < e.end_pos
    WHERE e.tag = 'article' GROUP BY e.page_id, e.pos) WHERE n > 200
),
nav AS (
  SELECT DISTINCT page_id FROM (
    SELECT e.page_id, e.pos, count(*) AS n FROM el e
    JOIN el a ON a.page_id = e.page_id AND a.tag = 'a' AND e.pos < a.pos AND a.pos < e.end_pos
    WHERE e.tag IN ('nav', 'ul') GROUP BY e.page_id, e.pos) WHERE n > 3
),
feat AS (
  SELECT p.page_id, false AS noscript, coalesce(w.n, 0) < 10 AS minimal_content, false AS spa_framework, false AS spa_root,
    false AS loading, false AS client_routing, false AS heavy_js, p.page_id IN (SELECT page_id FROM rich) AS rich_content,
    p.page_id IN (SELECT page_id FROM nav) AS navigation, false AS form, false AS meta_description
  FROM pages p LEFT JOIN words w USING (page_id)
),
scored AS (
  SELECT *, CAST(35 * minimal_content::INT - 15 * rich_content::INT - 10 * navigation::INT AS INTEGER) AS score FROM feat
)"""
_TEXTS = f"txt AS (SELECT page_id, pos, {Q.decoded('token')} AS text FROM tok WHERE kind = 'text')"

ORACLE = {
    **{name: _method_sql(method) for name, method in METHOD_QUERIES.items()},
    "product_links": Q.PRODUCT_LINKS + f"""
SELECT page_id, source_page, url, arg_min(discovery_method, rank) AS discovery_method, link_type, status, notes
FROM (SELECT {_ROW}, rank FROM found WHERE path IS NOT NULL) GROUP BY ALL""",
    "links_by_profile": _profile_sql(),
    "html_only_pages": """
SELECT p_partkey AS page_id, 'Text/HTML; charset=utf-8' AS content_type FROM part WHERE p_partkey % 13 <> 0""",
    "rendering_breakdown": """
WITH m AS (
  SELECT CASE WHEN p_partkey % 7 = 0 THEN 'dynamic' WHEN p_partkey % 5 <> 0 THEN 'static' ELSE 'unknown' END AS rendering_method
  FROM part
)
SELECT rendering_method, count(*) AS n_pages, count(*) * 100.0::DOUBLE / (SELECT count(*) FROM m) AS percent
FROM m GROUP BY rendering_method""",
    "description_sections": _LINKS_ONLY + """
SELECT k AS page_id, CAST(row_number() OVER (PARTITION BY k ORDER BY o) - 1 AS INTEGER) AS section, kind, text FROM lines""",
    "product_extraction_text": _LINKS_ONLY + f""",
sec AS (SELECT k, string_agg(kind || ': ' || text, chr(10) || chr(10) ORDER BY o) AS s FROM lines GROUP BY k),
price AS (SELECT k, '$' || CASE WHEN cents >= 100000 THEN (cents // 100000) || ',' || lpad(CAST(cents // 100 % 1000 AS VARCHAR), 3, '0')
    ELSE CAST(cents // 100 AS VARCHAR) END || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') AS price FROM pp),
body AS (
  SELECT k, coalesce(s, '') AS s, nm || ' & more ' || k || CASE WHEN shell THEN 'Please enable JavaScript' ELSE
      'goxmtbd' || nm || ' ' || k || price || descr || 'moreJant1t2b' || '{FILLER}'
      || CASE WHEN k % 4 = 1 THEN descr || ' ' || descr || ' ' || descr || ' ' || descr || ' ' || descr || ' ' || '{FILLER}' ELSE '' END
      || CASE WHEN k % 4 = 2 THEN descr ELSE '' END || CASE WHEN k % 10 = 4 THEN 'r' ELSE '' END
      || 'Call 555-123-' || lpad(CAST(k % 10000 AS VARCHAR), 4, '0') || k || ' Market Street, Town' END
    || CASE WHEN k % 10 = 0 THEN repeat('0123456789', 6000) ELSE '' END AS body
  FROM pp JOIN price USING (k) LEFT JOIN sec USING (k)
)
SELECT k AS page_id,
  CAST(CASE WHEN length(s) + 21 + length(body) <= 50000 THEN length(s) + 21 + length(body)
    ELSE 50000 - 100 + 21 + 3 END AS INTEGER) AS n_chars,
  s || chr(10) || chr(10) AS sections, length(s) + 21 + length(body) > 50000 AS cut
FROM body""",
    "jsonld_items": _PP + """
SELECT k AS page_id, 0 AS item_no, 'Product' AS type, '/ld/' || k AS url,
  CASE WHEN k % 9 <> 0 THEN 'https://' || host || '/logo/' || k END AS logo FROM pp WHERE k % 11 > 1
UNION ALL SELECT k, 1, 'Offer', NULL, NULL FROM pp WHERE k % 11 > 1 AND k % 9 = 0""",
    "microdata_items": _PP + """
, price AS (SELECT k, '$' || CASE WHEN cents >= 100000 THEN (cents // 100000) || ',' || lpad(CAST(cents // 100 % 1000 AS VARCHAR), 3, '0')
    ELSE CAST(cents // 100 AS VARCHAR) END || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') AS price FROM pp)
SELECT k AS page_id, 0 AS item_no, 'http://schema.org/Product' AS type,
  unnest(['name', 'price', 'description', 'sku', 'url', 'image', 'releaseDate', 'tag']) AS prop,
  unnest([[nm || ' ' || k], [price], [descr], ['S' || k], ['/md/' || k], ['/im/' || k || '.png'], ['2024-01-01'],
    ['t1', 't2']]) AS values
FROM pp JOIN price USING (k) WHERE NOT shell""",
    "meta_tags": _PP + """
SELECT k AS page_id, 'description' AS name, descr AS content FROM pp WHERE k % 2 = 0
UNION ALL SELECT k, 'keywords', br || ',' || ty FROM pp""",
    "opengraph": _PP + """
SELECT k AS page_id, 'title' AS name, CASE WHEN k % 5 = 0 THEN nm || ' again' ELSE nm END AS content FROM pp
UNION ALL SELECT k, 'description', 'og ' || nm || ' text' FROM pp WHERE k % 3 = 1""",
    "fallback_products": _PP + """
SELECT k AS page_id, CAST(s AS INTEGER) AS selector, nm || ' ' || k AS name, cents / 100.0::DOUBLE AS price, 'USD' AS currency,
  CASE WHEN length(descr) > 20 THEN descr END AS description
FROM pp, (SELECT unnest([0, 3, 4]) AS s) WHERE NOT shell AND (s <> 3 OR k % 2 = 1)""",
    "product_fields": _PP + """
SELECT k AS page_id, nm || ' ' || k AS name, cents / 100.0::DOUBLE AS price, 'USD' AS currency,
  CAST(CASE WHEN k % 2 = 1 THEN 3 ELSE 2 END AS BIGINT) AS n_selectors, CASE WHEN length(descr) > 20 THEN descr END AS description
FROM pp WHERE NOT shell""",
    "prices": _PP + """
SELECT k AS page_id, CASE WHEN NOT shell THEN cents / 100.0::DOUBLE END AS price, CAST(k AS DOUBLE) AS from_price,
  CAST(NULL AS DOUBLE) AS no_price FROM pp""",
    "organizations": _PP + """
SELECT k AS page_id, nm || ' & more ' || k AS name,
  CASE WHEN NOT shell THEN 'Call 555-123-' || lpad(CAST(k % 10000 AS VARCHAR), 4, '0') END AS telephone,
  CASE WHEN NOT shell THEN k || ' Market Street, Town' END AS address FROM pp""",
    "structured_data": _PP + """
SELECT k AS page_id, CAST(CASE WHEN k % 11 <= 1 THEN 0 WHEN k % 9 = 0 THEN 2 ELSE 1 END AS INTEGER) AS n_json_ld,
  CAST(CASE WHEN shell THEN 0 ELSE 1 END AS INTEGER) AS n_microdata, br || ',' || ty AS keywords,
  CASE WHEN k % 5 = 0 THEN nm || ' again' ELSE nm END AS og_title,
  CAST(CASE WHEN shell THEN 0 WHEN k % 2 = 1 THEN 3 ELSE 2 END AS INTEGER) AS n_products,
  CASE WHEN NOT shell THEN 'Call 555-123-' || lpad(CAST(k % 10000 AS VARCHAR), 4, '0') END AS telephone,
  list_filter([CASE WHEN k % 11 > 1 THEN 'page_json_ld' END, CASE WHEN NOT shell THEN 'microdata' END, 'meta_tags',
    'intelligent_fallback'], lambda m: m IS NOT NULL) AS extraction_methods
FROM pp""",
    "js_features": _PP + "," + _FEATURES + " SELECT * FROM feat",
    "js_scores": _PP + "," + _FEATURES + _scores_sql(45, "page_id,"),
    "strict_js_scores": _PP + "," + _FEATURES + _scores_sql(60, "page_id,"),
    "page_js_scores": Q.with_tokens(Q.SPANS, _TEXTS, _PAGE_FEATURES) + _scores_sql(45, "* EXCLUDE (score),"),
}
