"""Building blocks of the check SQL: plain text, independent of the Spark expressions."""

from __future__ import annotations

from webcat.functions.html import TOKEN
from webcat.functions.text import WORD_BREAK
from webcat.functions.vocab import VOID_TAGS


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strip(expr: str) -> str:
    return f"regexp_replace({expr}, {quoted('^' + WORD_BREAK + '|' + WORD_BREAK + '$')}, '', 'g')"


def decoded(expr: str) -> str:
    """The entities the given pages use."""
    return (
        f"replace(replace(replace(replace(replace(replace(replace({expr}, '&copy;', '©'), '&middot;', '·'), '&lt;', '<'), "
        f"'&gt;', '>'), '&quot;', chr(34)), '&#x27;', chr(39)), '&amp;', '&')"
    )


def squeeze(expr: str) -> str:
    pieces = f"string_split_regex({expr}, '[\\n\\x0b\\x0c\\r\\x1c-\\x1e\\x{{85}}\\x{{2028}}\\x{{2029}}]|  ')"
    return (
        f"array_to_string(list_filter(list_transform({pieces}, lambda p: {strip('p')}), lambda p: p <> ''), ' ')"
    )


def host(expr: str) -> str:
    return rf"regexp_extract({expr}, '^[a-zA-Z][a-zA-Z0-9+.\-]*://([^/?#]*)', 1)"


def path(expr: str) -> str:
    return rf"regexp_extract({expr}, '^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*([^?#]*)', 1)"


def site(expr: str) -> str:
    return f"replace(replace({host(expr)}, 'www.', ''), '.', '_')"


# tokens of the given pages: tok(page_id, pos, token, kind, tag)
TOKENS = f"""
tok0 AS (
  SELECT page_id, unnest(range(len(t))) AS pos, unnest(t) AS token
  FROM (SELECT page_id, regexp_extract_all(html, {quoted(TOKEN.replace('*+', '*'))}) AS t FROM pages)
),
tok1 AS (
  SELECT *, CASE
      WHEN token NOT LIKE '<%' THEN 'text'
      WHEN token LIKE '<!--%' THEN 'comment'
      WHEN regexp_matches(token, '(?i)^<script\\b') THEN 'script'
      WHEN regexp_matches(token, '(?i)^<style\\b') THEN 'style'
      WHEN token NOT LIKE '%>' THEN 'text'
      WHEN regexp_matches(token, '^</[a-zA-Z]') THEN 'close'
      WHEN regexp_matches(token, '^<[a-zA-Z]') THEN 'open'
      WHEN regexp_matches(token, '^<[/!?]') THEN 'decl'
      ELSE 'text' END AS kind
  FROM tok0
),
tok AS (
  SELECT page_id, CAST(pos AS INTEGER) AS pos, token, kind,
    CASE WHEN kind IN ('open', 'close', 'script', 'style')
         THEN lower(regexp_extract(token, '^</?([a-zA-Z][^\\s/>]*)', 1)) END AS tag
  FROM tok1
)"""

_VOID = ", ".join(f"'{t}'" for t in VOID_TAGS)

# element spans by running depth per (page, tag); an unclosed element ends with the smallest closed element
# around it. Right for pages without crossing tags, as the given ones are: el(page_id, pos, end_pos, tag)
SPANS = f"""
lev0 AS (
  SELECT *, CASE kind WHEN 'open' THEN 1 ELSE -1 END AS d FROM tok
  WHERE kind IN ('open', 'close') AND tag NOT IN ({_VOID})
),
lev AS (
  SELECT *, sum(d) OVER (PARTITION BY page_id, tag ORDER BY pos ROWS UNBOUNDED PRECEDING)
            + CASE WHEN d = -1 THEN 1 ELSE 0 END AS depth FROM lev0
),
nxt AS (
  SELECT *, lead(d) OVER w AS next_d, lead(pos) OVER w AS next_pos FROM lev
  WINDOW w AS (PARTITION BY page_id, tag, depth ORDER BY pos)
),
matched AS (
  SELECT page_id, pos, tag, CASE WHEN next_d = -1 THEN next_pos END AS end_pos FROM nxt WHERE d = 1
),
sized AS (SELECT page_id, count(*) AS n FROM tok GROUP BY page_id),
around AS (
  SELECT u.page_id, u.pos, min(m.end_pos) AS end_pos
  FROM matched u JOIN matched m ON u.page_id = m.page_id AND m.pos < u.pos AND m.end_pos > u.pos
  WHERE u.end_pos IS NULL GROUP BY u.page_id, u.pos
),
el AS (
  SELECT m.page_id, m.pos, CAST(coalesce(m.end_pos, a.end_pos, s.n) AS INTEGER) AS end_pos, m.tag
  FROM matched m JOIN sized s USING (page_id) LEFT JOIN around a ON a.page_id = m.page_id AND a.pos = m.pos
  UNION ALL
  SELECT page_id, pos, pos, tag FROM tok WHERE kind = 'open' AND tag IN ({_VOID})
)"""

# anchors of the given pages with their absolute address: anchor(page_id, source_page, host, pos, href, url)
ANCHORS = f"""
anchor AS (
  SELECT page_id, url AS source_page, {host('url')} AS host, pos, href,
    regexp_extract(url, '^([a-zA-Z]+)://', 1) || '://' || {host('url')} || href AS url
  FROM (
    SELECT t.page_id, p.url, t.pos, {decoded("regexp_extract(t.token, 'href=\"([^\"]*)\"', 1)")} AS href
    FROM tok t JOIN pages p USING (page_id) WHERE t.kind = 'open' AND t.tag = 'a'
  )
)"""
VALID = (
    "NOT regexp_matches(url, '[<>\"`{}|^]') AND length(url) <= 2000 AND url NOT LIKE '%://%://%'"
    " AND NOT regexp_matches(lower(" + path("url") + "), "
    "'\\.(pdf|jpg|jpeg|png|gif|css|js|xml|zip|doc|docx|svg|ico)$')"
    " AND " + path("url") + " NOT LIKE '%//%'"
)
# one row per (page, url): the given pages hold no other kind of link
LINKS = f"""
link AS (
  SELECT DISTINCT page_id, source_page, url, 'anchor' AS discovery_method, 'internal' AS link_type,
         'pending' AS status, '' AS notes
  FROM anchor WHERE {VALID}
)"""
UNIQUE_LINKS = f"""
ulink AS (
  SELECT site_name, page_id, source_page, url, discovery_method, link_type, status, notes FROM (
    SELECT *, {site('source_page')} AS site_name,
      row_number() OVER (PARTITION BY {site('source_page')}, url ORDER BY page_id) AS rn FROM link)
  WHERE rn = 1
)"""


def with_tokens(*parts: str) -> str:
    return "WITH " + ",\n".join([TOKENS, *parts])


PAGE_LINKS = with_tokens(ANCHORS, LINKS)
SITE_LINKS = with_tokens(ANCHORS, LINKS, UNIQUE_LINKS)

# the product pages' values per part: pp(k, host, nm, br, ty, cents, descr, shell)
PARTS = """
pp AS (
  SELECT p_partkey AS k, 'www.shop' || (p_partkey % 7) || '.example.com' AS host, p_name AS nm, p_brand AS br,
    p_type AS ty, CAST(round(p_retailprice * 100) AS BIGINT) AS cents,
    CASE WHEN p_partkey % 3 = 0 THEN 'Plain ' || p_name || '.'
         ELSE 'A ' || p_name || ' of brand ' || p_brand || ', with notes of cocoa and a clean finish.' END AS descr,
    p_partkey % 7 = 0 AS shell
  FROM part
)"""

# every link a product page holds: found(k, host, method, rank, path)
FOUND = """
found AS (
  SELECT k, host, 'anchor' AS method, 0 AS rank, unnest([CASE k % 8
      WHEN 0 THEN '/cat/' || k WHEN 1 THEN '/p/item' || k || '.html' WHEN 2 THEN '/up/' || k WHEN 3 THEN NULL
      WHEN 4 THEN '/w/' || k WHEN 5 THEN '/p/' || k || '?ref=' || k
      WHEN 6 THEN '/abs/' || k || '?b=2&a=1#f' ELSE '/dup/' || k END,
      '/aria/' || k, '/md/' || k]) AS path FROM pp WHERE NOT shell
  UNION ALL SELECT k, host, 'area', 1, '/area/' || k FROM pp WHERE NOT shell
  UNION ALL SELECT k, host, 'javascript', 2, unnest(['/js/' || k || '/go', '/api/' || k || '/list.php']) FROM pp
  UNION ALL SELECT k, host, 'javascript', 2, '/evt/' || k || '.html' FROM pp WHERE NOT shell
  UNION ALL SELECT k, host, 'javascript', 2, '/ld/' || k FROM pp WHERE k % 11 <> 1
  UNION ALL SELECT k, host, 'javascript', 2, '/no/' || k FROM pp WHERE k % 11 > 1 AND k % 9 = 0
  UNION ALL SELECT k, host, 'meta', 3, unnest(['/p/' || k, '/n/' || k || '/']) FROM pp
  UNION ALL SELECT k, host, 'meta', 3, '/r/' || k FROM pp WHERE k % 6 = 0
  UNION ALL SELECT k, host, 'form', 4, '/search?q=' || k FROM pp WHERE NOT shell
  UNION ALL SELECT k, host, 'data_attribute', 5, '/data/' || k FROM pp WHERE NOT shell
  UNION ALL SELECT k, host, 'css', 6, '/bg/' || k || '/' FROM pp
  UNION ALL SELECT k, host, 'css', 6, '/sa/' || k || '/' FROM pp WHERE NOT shell
  UNION ALL SELECT k, host, 'json_ld', 7, '/ld/' || k FROM pp WHERE k % 11 > 1
  UNION ALL SELECT k, host, 'json_ld', 7, '/logo/' || k FROM pp WHERE k % 11 > 1 AND k % 9 <> 0
  UNION ALL SELECT k, host, 'microdata', 8, '/md/' || k FROM pp WHERE NOT shell
  UNION ALL SELECT k, host, 'http_header', 9, '/h/' || k FROM pp
  UNION ALL SELECT k, host, 'comment', 10, '/cmt/' || k FROM pp WHERE NOT shell
)"""
PRODUCT_LINKS = "WITH " + PARTS + ",\n" + FOUND
