"""Registered queries: sources, sinks and the page stream, as round trips through the scratch folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from webcat.functions.urls import host, site_name
from webcat.operators import curation, links
from webcat.operators.payload import parse_bean_payload
from webcat.plans import catalog_queries, page_queries
from webcat.plans import sqltext as Q
from webcat.plans.inputs import bean_payloads, catalog, given_pages
from webcat.session import scratch_dir
from webcat.sources import readers, writers
from webcat.streaming import ingest


def pages_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "pages")
    pages = given_pages(spark, sf_dir)
    # every page a second time without a body: the index counts it, no file is written for it
    bare = pages.select((-F.col("page_id") - 1).alias("page_id"), "url", F.lit("").alias("html"))
    writers.write_pages_by_site(pages.unionByName(bare), path)
    return readers.read_pages(spark, path).select(
        "page_id", F.col("site_name").cast("string").alias("site_name"), "idx", "filename", F.md5("html").alias("body")
    )


def links_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "links")
    writers.write_links(links.unique_links(links.extract_links(given_pages(spark, sf_dir))), path)
    schema = "page_id bigint, source_page string, url string, discovery_method string, link_type string, status string, notes string, site_name string"
    return spark.read.schema(schema).json(path)


def link_documents(spark, sf_dir):
    """Discovery documents, one per source page, written as JSON and read back as link rows."""
    path = scratch_dir(spark, "documents")
    found = links.extract_links(given_pages(spark, sf_dir))
    docs = found.groupBy("source_page", "page_id").agg(  # a page's own links: as large as the page
        F.array_sort(F.collect_list(F.struct("url", "source_page", "discovery_method", "link_type", "status", "notes"))).alias("discovered_links")
    )
    docs.select(
        F.struct(
            F.col("source_page").alias("base_url"), host(F.col("source_page")).alias("base_domain"),
            site_name(F.col("source_page")).alias("site_name"),
        ).alias("discovery_metadata"),
        "discovered_links",
    ).write.option("ignoreNullFields", "false").json(path)
    return readers.read_links(spark, path, multiline=False).select("base_url", "site_name", "seq", "url", "discovery_method", "status")


def _site_documents(spark, sf_dir):
    """Discovery documents of the given sites, at most 40 entries of a list in each: where they were written."""
    path = scratch_dir(spark, "discovery")
    pages = given_pages(spark, sf_dir)
    found = links.extract_links(pages)
    unique = links.unique_links(found)
    seen = links.source_page_stats(pages, found).withColumn("site_name", site_name(F.col("url")))
    sites = pages.groupBy(site_name(F.col("url")).alias("site_name")).agg(F.min("url").alias("base_url"))
    # every link whose address has an odd length counts as failed
    failed = unique.filter(F.length("url") % 2 == 1)
    writers.write_discovery(unique, seen, failed, sites.withColumn("base_domain", host(F.col("base_url"))), path, roll=40)
    return path


def discovery_links(spark, sf_dir):
    return readers.read_links(spark, _site_documents(spark, sf_dir), multiline=False).select(
        "site_name", "base_url", "base_domain", "total_pages_scanned", "total_links_found", "failed_urls_count",
        "seq", "url", "source_page", "discovery_method", "link_type", "status",
    )


def discovery_pages(spark, sf_dir):
    return readers.read_source_pages(spark, _site_documents(spark, sf_dir), multiline=False).select(
        "site_name", "url", "title", "links_found", "fetch_status", "discovery_methods"
    )


def discovery_failures(spark, sf_dir):
    return readers.read_failed_urls(spark, _site_documents(spark, sf_dir), multiline=False)


def site_summaries(spark, sf_dir):
    """Scraping summaries with their failed addresses, at most 40 in a document, read back."""
    path = scratch_dir(spark, "site-summaries")
    updated = curation.update_status(links.unique_links(links.extract_links(given_pages(spark, sf_dir))), page_queries.RULES)
    stored = updated.filter(F.length("url") % 2 == 0).select("url")
    writers.write_summaries(updated, stored, path, roll=40, timestamp="2024-06-01T00:00:00", links_file="links", output_directory="pages")
    return readers.read_summaries(spark, path, multiline=False).select(
        "phase", "timestamp", "links_file_used", "status_filter_used", "base_domain", "total_links_in_file", "filtered_links_count",
        "successfully_scraped", "output_directory", F.explode_outer("failed_urls").alias("failed_url"),
    )


def processed_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "processed")
    writers.write_processed(parse_bean_payload(bean_payloads(spark, sf_dir)), path, "2024-06-01T00:00:00")
    return readers.read_processed(spark, path, multiline=False).select(
        "source_file", "processed_at", "beans_found", "idx", "name", "price", "currency"
    )


def summaries_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "summaries")
    rules = page_queries.RULES
    updated = curation.update_status(links.unique_links(links.extract_links(given_pages(spark, sf_dir))), rules)
    stored = updated.filter(F.length("url") % 2 == 0).select("url")
    summary = curation.scrape_summary(updated, stored)
    summary.select(
        F.lit("html_scraping").alias("phase"), F.lit("keep").alias("status_filter_used"),
        F.col("site_name").alias("base_domain"), F.col("total_links").alias("total_links_in_file"),
        F.col("filtered_links").alias("filtered_links_count"), F.col("scraped").alias("successfully_scraped"),
    ).write.json(path)
    return readers.read_summaries(spark, path, multiline=False).select(
        "phase", "base_domain", "total_links_in_file", "filtered_links_count", "successfully_scraped", "saved_files"
    )


def catalog_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "catalog")
    writers.write_catalog(catalog(spark, sf_dir), path)
    rows = None
    for name, table in readers.read_catalog(spark, path).items():
        n = table.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table"), "n_rows")
        rows = n if rows is None else rows.unionByName(n)
    return rows


def stream_links(spark, sf_dir):
    """The pages as a stream of ten files, the first occurrence of each link URL."""
    base = scratch_dir(spark, "stream")
    given_pages(spark, sf_dir).repartition(10, F.xxhash64("page_id")).write.parquet(f"{base}/in")
    pages = ingest.read_page_stream(spark, f"{base}/in", files_per_batch=1)
    ingest.start_link_store(pages, f"{base}/store", f"{base}/state").awaitTermination()
    return ingest.read_link_store(spark, f"{base}/store").select("url", "page_id", "source_page", "discovery_method", "link_type")


_SITES = f"""
site AS (SELECT {Q.site('url')} AS site_name, min(url) AS base_url, count(*) AS total_pages_scanned FROM pages GROUP BY 1),
total AS (SELECT site_name, count(*) AS total_links_found, count(*) FILTER (length(url) % 2 = 1) AS failed_urls_count FROM ulink GROUP BY 1)"""
QUERIES = {f.__name__: f for f in [
    pages_roundtrip, links_roundtrip, link_documents, discovery_links, discovery_pages, discovery_failures, site_summaries,
    processed_roundtrip, summaries_roundtrip,
    catalog_roundtrip, stream_links,
]}
ORACLE = {
    "pages_roundtrip": rf"""
WITH twice AS (
  SELECT page_id, url, html FROM pages UNION ALL SELECT -page_id - 1, url, '' FROM pages
),
n AS (
  SELECT page_id, {Q.site('url')} AS site_name, replace({Q.host('url')}, 'www.', '') AS domain, html,
    list_filter(string_split({Q.path('url')}, '/'), lambda p: p <> '') AS parts,
    row_number() OVER (PARTITION BY {Q.site('url')} ORDER BY url, page_id) - 1 AS idx
  FROM twice
)
SELECT page_id, site_name, CAST(idx AS INTEGER) AS idx,
  substr(printf('%03d', idx) || '_' || trim(regexp_replace(regexp_replace(
    CASE WHEN len(parts) > 0 THEN domain || '_' || array_to_string(parts, '_') ELSE domain || '_home' END,
    '[^\p{{L}}\p{{N}}_.\-]', '_', 'g'), '_+', '_', 'g'), '_'), 1, 200) AS filename, md5(html) AS body
FROM n WHERE html <> ''
""",
    "links_roundtrip": Q.SITE_LINKS + " SELECT * FROM ulink",
    "link_documents": Q.PAGE_LINKS + f"""
SELECT source_page AS base_url, {Q.site('source_page')} AS site_name,
  CAST(row_number() OVER (PARTITION BY page_id ORDER BY url) - 1 AS INTEGER) AS seq, url, discovery_method, status FROM link""",
    "discovery_links": Q.SITE_LINKS + f""", {_SITES}
SELECT u.site_name, base_url, {Q.host('base_url')} AS base_domain, total_pages_scanned, total_links_found, failed_urls_count,
  CAST(row_number() OVER (PARTITION BY u.site_name ORDER BY url) - 1 AS INTEGER) AS seq, url, source_page, discovery_method, link_type, status
FROM ulink u JOIN site USING (site_name) JOIN total USING (site_name)""",
    "discovery_pages": "SELECT " + f"{Q.site('url')} AS site_name, * EXCLUDE (page_id) FROM (" + page_queries.ORACLE["source_page_stats"] + ")",
    "discovery_failures": Q.SITE_LINKS + " SELECT site_name, url FROM ulink WHERE length(url) % 2 = 1",
    "site_summaries": Q.SITE_LINKS + f""", {page_queries._UPDATED}, {page_queries._VISITED},
gone AS (SELECT site_name, url AS failed_url FROM updated WHERE status = 'keep' AND url NOT IN (SELECT url FROM visited)),
counted AS (SELECT site_name, count(*) AS n, count(*) FILTER (status = 'keep') AS kept,
  count(*) FILTER (status = 'keep' AND url IN (SELECT url FROM visited)) AS scraped FROM updated GROUP BY site_name)
SELECT 'html_scraping' AS phase, '2024-06-01T00:00:00' AS timestamp, 'links' AS links_file_used, 'keep' AS status_filter_used,
  site_name AS base_domain, n AS total_links_in_file, kept AS filtered_links_count, scraped AS successfully_scraped,
  'pages' AS output_directory, failed_url
FROM counted LEFT JOIN gone USING (site_name)""",
    "processed_roundtrip": catalog_queries._BEANS + """,
n AS (SELECT source_file, count(*) AS n FROM bean GROUP BY source_file)
SELECT source_file, '2024-06-01T00:00:00' AS processed_at, CAST(n AS INTEGER) AS beans_found, idx, name, price, currency
FROM bean JOIN n USING (source_file)
UNION ALL SELECT source_file, '2024-06-01T00:00:00', 0, NULL, NULL, NULL, NULL FROM barren""",
    "summaries_roundtrip": page_queries.ORACLE["scrape_summary"].replace(
        "SELECT site_name, count(*) AS total_links", "SELECT 'html_scraping' AS phase, site_name AS base_domain, count(*) AS total_links_in_file"
    ).replace("AS filtered_links", "AS filtered_links_count").replace("AS scraped", "AS successfully_scraped").replace(
        "count(*) FILTER (status = 'keep' AND url NOT IN (SELECT url FROM visited)) AS failed", "CAST(NULL AS BIGINT) AS saved_files"
    ),
    "catalog_roundtrip": f"""
WITH {catalog_queries._LIKES}
SELECT 'cafes' AS "table", count(*) AS n_rows FROM nation UNION ALL SELECT 'cafe_locations', count(*) FROM supplier
UNION ALL SELECT 'beans', count(*) FROM part UNION ALL SELECT 'bean_specialties', count(*) FROM part WHERE p_partkey % 3 = 0
UNION ALL SELECT 'menu_items', count(*) FROM part
UNION ALL SELECT 'cafe_location_beans', count(DISTINCT (l_suppkey, l_partkey)) FROM lineitem
UNION ALL SELECT 'users', count(*) FROM customer UNION ALL SELECT 'user_preferences', count(*) FROM customer WHERE c_custkey % 2 = 0
UNION ALL SELECT 'user_flavor_preferences', CAST(sum(c_custkey % 3) AS BIGINT) FROM customer
UNION ALL SELECT 'user_liked_beans', count(DISTINCT (o_custkey, l_partkey)) FROM likes
UNION ALL SELECT 'user_liked_locations', count(DISTINCT (o_custkey, l_suppkey)) FROM likes
UNION ALL SELECT 'user_interactions', count(*) FROM events""",
    "stream_links": Q.PAGE_LINKS + """
SELECT url, page_id, source_page, discovery_method, link_type FROM link QUALIFY row_number() OVER (PARTITION BY url ORDER BY page_id) = 1""",
}
