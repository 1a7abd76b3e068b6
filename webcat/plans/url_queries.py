"""Registered queries: URL functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webcat.functions import urls as U
from webcat.plans import sqltext as Q
from webcat.plans.inputs import table
from webcat.sources.writers import page_files


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", "url")


def site_pages(spark, sf_dir):
    return _pages(spark, sf_dir).groupBy(U.site_name(F.col("url")).alias("site_name")).agg(F.count("*").alias("n_pages"))


def safe_filenames(spark, sf_dir):
    return page_files(_pages(spark, sf_dir)).select("page_id", "site_name", "idx", "filename")


def url_parts(spark, sf_dir):
    url = F.col("url")
    return _pages(spark, sf_dir).select(
        "page_id", U.scheme(url).alias("scheme"), U.host(url).alias("host"), U.path(url).alias("path"),
        U.query(url).alias("query"),
    )


# endings hung on the page address in front of its own query: form number -> text
QUERY_ENDINGS = ["", "/?b=2&a=%41+b&a=9&c=#f", "///?z&y=%C3%A9", "/?#x"]


def normalized_urls(spark, sf_dir):
    plain = F.regexp_extract("url", r"^([^?#]*)", 1)
    forms = F.array(F.col("url"), *[F.concat(plain, F.lit(e)) for e in QUERY_ENDINGS[1:]])
    rows = _pages(spark, sf_dir).select("page_id", F.posexplode(forms).alias("form", "u"))
    return rows.select("page_id", "form", U.normalize_url(F.col("u")).alias("url"))


_NORMALIZED_SQL = rf"""
WITH plain AS (SELECT page_id, url, regexp_extract(url, '^([^?#]*)', 1) AS front FROM pages),
forms AS (
  SELECT page_id, CAST(unnest(range(4)) AS INTEGER) AS form,
    unnest([url, front || '/?b=2&a=%41+b&a=9&c=#f', front || '///?z&y=%C3%A9', front || '/?#x']) AS u FROM plain
),
parts AS (
  SELECT page_id, form, regexp_extract(u, '^([^?#]*)', 1) AS front,
    regexp_extract(u, '^[^?#]*\?([^#]*)', 1) AS query FROM forms
),
pairs AS (
  SELECT page_id, form, unnest(range(len(l))) AS seq, unnest(l) AS pair
  FROM (SELECT page_id, form, string_split(query, '&') AS l FROM parts WHERE query <> '')
),
decoded AS (
  SELECT page_id, form, seq, url_decode(replace(regexp_extract(pair, '^([^=]*)', 1), '+', ' ')) AS key,
    url_decode(replace(regexp_extract(pair, '^[^=]*=(.*)$', 1), '+', ' ')) AS value FROM pairs
),
firsts AS (
  SELECT page_id, form, key, arg_min(value, seq) AS value FROM decoded GROUP BY page_id, form, key
),
sorted AS (
  SELECT page_id, form, string_agg(key || '=' || value, '&' ORDER BY key) AS query FROM firsts GROUP BY page_id, form
)
SELECT p.page_id, p.form,
  CASE WHEN {Q.path('p.front')} = '/' THEN p.front ELSE rtrim(p.front, '/') END
  || coalesce('?' || s.query, '') AS url
FROM parts p LEFT JOIN sorted s USING (page_id, form)
"""

# references as they are written on pages: (text before the page's own address part, kind of expectation)
def _reference_forms(host, number) -> list:
    n = number.cast("string")
    c = F.concat
    lit = F.lit
    return [
        lit("  "), c(lit("https://other.example.org/"), n), c(lit("//cdn.example.org/"), n),
        c(host, lit("/products/"), n), c(lit("www.elsewhere.org/"), n), c(host, lit("/a/"), host, lit("/b/"), n),
        c(lit("/products/"), host, lit("/c/"), n), c(lit("#part"), n), c(lit("?k="), n), c(lit("/root/"), n),
        c(lit("/x/../y/./"), n), lit("/../up"), lit("index.html"), c(lit("mailto:a"), n), lit("/dir/.."),
    ]


def resolved_references(spark, sf_dir):
    rows = _pages(spark, sf_dir).select("page_id", U.base_parts(F.col("url")).alias("base"), U.host(F.col("url")).alias("h"))
    forms = rows.select("page_id", "base", F.posexplode(F.array(*_reference_forms(F.col("h"), F.col("page_id")))).alias("form", "ref"))
    resolved = forms.withColumn("url", U.resolve_url(F.col("ref"), F.col("base")))
    return resolved.select(
        "page_id", "form", "url", U.link_type(F.col("url"), F.col("base.host")).alias("link_type"),
        U.is_valid_url(F.col("url"), F.col("base.host")).alias("valid"),
    )


_RESOLVED_SQL = rf"""
WITH p AS (
  SELECT page_id, url, regexp_extract(url, '^([a-z]+)://', 1) AS s, {Q.host('url')} AS h,
    regexp_extract(url, '^([^#]*)', 1) AS no_fragment, regexp_extract(url, '^([^?#]*)', 1) AS plain,
    regexp_extract({Q.path('url')}, '^(.*/)', 1) AS folder
  FROM pages
),
f AS (
  SELECT page_id, h, CAST(unnest(range(15)) AS INTEGER) AS form, unnest([
    NULL, 'https://other.example.org/' || page_id, s || '://cdn.example.org/' || page_id,
    s || '://' || h || '/products/' || page_id, 'https://www.elsewhere.org/' || page_id,
    s || '://' || h || '/b/' || page_id, s || '://' || h || '/c/' || page_id, no_fragment || '#part' || page_id,
    plain || '?k=' || page_id, s || '://' || h || '/root/' || page_id, s || '://' || h || '/y/' || page_id,
    s || '://' || h || '/up', s || '://' || h || folder || 'index.html', 'mailto:a' || page_id, s || '://' || h || '/'
  ]) AS url FROM p
)
SELECT page_id, form, url, CASE WHEN {Q.host('url')} = h THEN 'internal' ELSE 'external' END AS link_type,
  coalesce({Q.host('url')} = h, false) AS valid
FROM f
"""


def _url_forms(url, host) -> list:
    c, lit = F.concat, F.lit
    plain = F.regexp_extract(url, r"^([^?#]*)", 1)
    return [
        url, c(plain, lit("/x//y")), c(plain, lit("/{id}")), c(lit("ftp://"), host), c(plain, lit("/http://b.com")),
        c(plain, lit("/"), host, lit("/"), host), c(plain, F.repeat(lit("/a"), 1000)), c(F.rtrim(plain, lit("/")), lit("/file.PDF")),
        c(lit("/only/path")), c(lit("https://other."), host),
    ]


def _url_rows(spark, sf_dir):
    return _pages(spark, sf_dir).select(
        "page_id", U.host(F.col("url")).alias("h"),
        F.posexplode(F.array(*_url_forms(F.col("url"), U.host(F.col("url"))))).alias("form", "u"),
    )


def url_malformed(spark, sf_dir):
    return _url_rows(spark, sf_dir).select("page_id", "form", U.is_malformed_url(F.col("u")).alias("malformed"))


def url_validity(spark, sf_dir):
    valid = U.is_valid_url(F.col("u"), F.col("h"))
    anywhere = U.is_valid_url(F.col("u"), F.col("h"), follow_external=True)
    return _url_rows(spark, sf_dir).select("page_id", "form", valid.alias("valid"), anywhere.alias("valid_anywhere"))


def final_urls(spark, sf_dir):
    return _url_rows(spark, sf_dir).select("page_id", "form", U.validate_final_url(F.col("u")).alias("url"))


def _truth(column: str, values: list[bool]) -> str:
    listed = ", ".join(str(v).lower() for v in values)
    return f"unnest([{listed}]) AS {column}"


_MALFORMED = [False, True, True, False, True, True, True, False, False, False]
_URL_MALFORMED_SQL = f"""
SELECT page_id, CAST(unnest(range(10)) AS INTEGER) AS form, {_truth('malformed', _MALFORMED)} FROM pages
"""
_URL_VALIDITY_SQL = f"""
SELECT page_id, CAST(unnest(range(10)) AS INTEGER) AS form,
  {_truth('valid', [True] + [False] * 9)}, {_truth('valid_anywhere', [True] + [False] * 8 + [True])}
FROM pages
"""
_FINAL_SQL = f"""
SELECT page_id, CAST(unnest(range(10)) AS INTEGER) AS form, unnest([
  url, NULL, NULL, 'ftp://' || {Q.host('url')}, NULL, NULL, NULL,
  rtrim(regexp_extract(url, '^([^?#]*)', 1), '/') || '/file.PDF', NULL, 'https://other.' || {Q.host('url')}]) AS url
FROM pages
"""

# strings as scripts and style sheets hold them, around the number of a part, and whether they are addresses
JS_FORMS = [
    ("/menu", True), ("/a/b/a", False), ("foo()", False), ("ab", False), ("MAX_SIZE", False), ("page/[k].html", True),
    ("/p?q=[k]#top", True), ("[k]", False), ("x [k]", False), ("//cdn/[k]", False), ("word", False),
    ("shop.example.com/shop.example.com", False), ("/[k]/x-y_z", True), ("return/[k]", False), ("/é/[k]", False),
    ("'/quoted/[k]'", True), ("#/[k]", False), ("a.b/[k]", True),
]
CSS_FORMS = [
    ("/dir/[k]/", True), ("/img/[k].png", False), ("data:[k]", False), ("#x[k]", False), ("/x/[k].cfm", False),
    ("/x/[k].html", True), ("x/[k].cfm", True), ("font[k].WOFF2", False), (" ", False), ("tel:[k]", False),
]


def _forms(spark, sf_dir, forms):
    k = F.col("p_partkey").cast("string")
    values = F.array(*[F.replace(F.lit(text), F.lit("[k]"), k) for text, _ in forms])
    return table(spark, sf_dir, "part").select("p_partkey", F.posexplode(values).alias("form", "u"))


def js_url_check(spark, sf_dir):
    return _forms(spark, sf_dir, JS_FORMS).select(
        "p_partkey", "form", U.is_valid_js_url(F.col("u"), F.lit("shop.example.com")).alias("valid")
    )


def css_url_check(spark, sf_dir):
    return _forms(spark, sf_dir, CSS_FORMS).select("p_partkey", "form", U.is_valid_css_url(F.col("u")).alias("valid"))


def _forms_sql(forms) -> str:
    return f"""
SELECT p_partkey, CAST(unnest(range({len(forms)})) AS INTEGER) AS form, {_truth('valid', [v for _, v in forms])}
FROM part
"""


QUERIES = {
    "site_pages": site_pages, "safe_filenames": safe_filenames, "url_parts": url_parts,
    "normalized_urls": normalized_urls, "resolved_references": resolved_references, "url_malformed": url_malformed,
    "url_validity": url_validity, "final_urls": final_urls, "js_url_check": js_url_check, "css_url_check": css_url_check,
}
ORACLE = {
    "site_pages": f"SELECT {Q.site('url')} AS site_name, count(*) AS n_pages FROM pages GROUP BY 1",
    "safe_filenames": rf"""
WITH n AS (
  SELECT page_id, url, {Q.site('url')} AS site_name, replace({Q.host('url')}, 'www.', '') AS domain,
    list_filter(string_split({Q.path('url')}, '/'), lambda p: p <> '') AS parts,
    row_number() OVER (PARTITION BY {Q.site('url')} ORDER BY url, page_id) - 1 AS idx
  FROM pages
),
named AS (
  SELECT *, CASE WHEN len(parts) > 0 THEN domain || '_' || array_to_string(parts, '_') ELSE domain || '_home' END AS raw
  FROM n
)
SELECT page_id, site_name, CAST(idx AS INTEGER) AS idx,
  substr(printf('%03d', idx) || '_' ||
    trim(regexp_replace(regexp_replace(raw, '[^\p{{L}}\p{{N}}_.\-]', '_', 'g'), '_+', '_', 'g'), '_'), 1, 200) AS filename
FROM named
""",
    "url_parts": rf"""
SELECT page_id, lower(regexp_extract(url, '^([a-zA-Z]+):', 1)) AS scheme, {Q.host('url')} AS host,
  {Q.path('url')} AS path, regexp_extract(url, '^[^?#]*\?([^#]*)', 1) AS query FROM pages
""",
    "normalized_urls": _NORMALIZED_SQL,
    "resolved_references": _RESOLVED_SQL,
    "url_malformed": _URL_MALFORMED_SQL,
    "url_validity": _URL_VALIDITY_SQL,
    "final_urls": _FINAL_SQL,
    "js_url_check": _forms_sql(JS_FORMS),
    "css_url_check": _forms_sql(CSS_FORMS),
}
