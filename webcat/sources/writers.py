"""Sinks: page files, links, processed documents and the catalog."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField

from webcat.functions.urls import safe_filename, site_name
from webcat.operators import curation
from webcat.schemas import LINKS_DOCUMENT
from webcat.session import checkpointed, numbered_within


def _numbered(pages: DataFrame, *columns: str) -> DataFrame:
    keys = pages.select("page_id", site_name(F.col("url")).alias("site_name"), "url", *columns)
    numbered = numbered_within(keys, "site_name", "url", "page_id")
    return numbered.withColumn("filename", safe_filename(F.col("url"), F.col("idx")))


def page_files(pages: DataFrame) -> DataFrame:
    """Site and file name of every page: (page_id, site_name, url, idx, filename).

    The index counts all pages of a site in (url, page_id) order, empty ones included, so that a page
    without html leaves a gap and the names of the others do not change.
    """
    return _numbered(pages)


def write_pages_by_site(pages: DataFrame, path: str) -> None:
    """Page table in one directory per site; pages without html are left out.

    The bodies are moved once, to ranges of (site, url): a dominating site has many files, small sites are not scattered.
    """
    out = _numbered(pages, "html").filter(F.length("html") > 0).select(
        "page_id", "site_name", "url", "idx", "filename", "html")
    out.write.mode("overwrite").partitionBy("site_name").parquet(path)


def write_links(links: DataFrame, path: str, format: str = "json") -> None:
    """Links in one directory per site, one row per link."""
    if "site_name" not in links.columns:
        links = links.withColumn("site_name", site_name(F.col("source_page")))
    links.hint("rebalance", "site_name").write.mode("overwrite").partitionBy("site_name").format(format).save(path)


#: Entries of one list in one document; a site with more is written as several documents.
ROLL = 10_000


def _rolled(lists: dict[str, DataFrame], header: DataFrame, roll: int) -> DataFrame:
    """Documents of bounded size: (site_name, part, header, one array per list).

    ``lists`` are (site_name, entry, idx) numbered within the site, ``header`` is (site_name, header). Document ``part`` of a
    site holds entries part * roll and on of every list, and the header, which is as small as a row, stands in all of them.
    """
    kinds = list(lists)
    sizes = [
        rows.groupBy("site_name").agg(F.max("idx").alias("last")).select("site_name", F.floor(F.col("last") / roll).alias("last"))
        for rows in lists.values()
    ]
    heads = header.select("site_name", "header", F.lit(0).cast("long").alias("last"))
    for more in sizes:
        heads = heads.unionByName(more.select("site_name", F.lit(None).cast(header.schema["header"].dataType).alias("header"), "last"))
    heads = heads.groupBy("site_name").agg(F.first("header", ignorenulls=True).alias("header"), F.max("last").alias("last"))
    rows = heads.select("site_name", F.explode(F.sequence(F.lit(0).cast("long"), "last")).alias("part"), "header")
    for kind, entries in lists.items():
        rows = rows.unionByName(
            entries.select("site_name", F.floor(F.col("idx") / roll).alias("part"), F.struct("idx", "entry").alias(kind)), True
        )
    sorted_list = lambda kind: F.transform(F.array_sort(F.collect_list(kind)), lambda x: x["entry"]).alias(kind)
    return rows.groupBy("site_name", "part").agg(F.first("header", ignorenulls=True).alias("header"), *map(sorted_list, kinds))


def _entries(rows: DataFrame, entry: Column, *order: str) -> DataFrame:
    """(site_name, entry, idx) in the given order within the site."""
    kept = checkpointed(rows.select("site_name", *order, entry.alias("entry")))  # read several times to be numbered
    return numbered_within(kept, "site_name", *order).select("site_name", "entry", "idx")


def _shaped(rows: DataFrame, fields: list[StructField]) -> Column:
    """The fields as a struct, those that the table lacks null."""
    return F.struct(*[
        (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])


def discovery_documents(
    links: DataFrame, source_pages: DataFrame, failed: DataFrame, metadata: DataFrame, roll: int = ROLL
) -> DataFrame:
    """Discovery documents of every site of any input: (discovery_metadata, discovered_links, source_pages, failed_urls).

    ``metadata`` has a row per site: site_name and any of base_url, base_domain, timestamp, crawler_config; the counts of the
    header are those of the lists. Lists are in url order, and those of more than ``roll`` entries go on in further documents.
    Rows without a site name make one site of their own.
    """
    kinds = {f.name: f.dataType for f in LINKS_DOCUMENT.fields}
    head = [f for f in kinds["discovery_metadata"].fields if f.name not in ("part", "first_entry")]
    link, page = kinds["discovered_links"].elementType.fields, kinds["source_pages"].elementType.fields
    lists = {
        "discovered_links": _entries(links, _shaped(links, link), "url", "source_page", "discovery_method"),
        "source_pages": _entries(source_pages, _shaped(source_pages, page), "url"),
        "failed_urls": _entries(failed, F.col("url"), "url"),
    }
    totals = dict(zip(["total_links_found", "total_pages_scanned", "failed_urls_count"], lists.values()))
    header = metadata.drop(*totals)
    known = [c for c in header.columns if c != "site_name"]
    for name, rows in totals.items():
        header = header.unionByName(rows.groupBy("site_name").agg(F.count("*").alias(name)), True)
    header = header.groupBy("site_name").agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in known], *[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in totals]
    )
    docs = _rolled(lists, header.select("site_name", _shaped(header, head).alias("header")), roll)
    place = [F.col("part"), (F.col("part") * roll).alias("first_entry")]
    return docs.select(
        F.struct("header.*", *place).alias("discovery_metadata"), "discovered_links", "source_pages", "failed_urls"
    )


def write_discovery(
    links: DataFrame, source_pages: DataFrame, failed: DataFrame, metadata: DataFrame, path: str, roll: int = ROLL
) -> None:
    """Discovery documents as JSON, one per line."""
    docs = discovery_documents(links, source_pages, failed, metadata, roll)
    docs.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def summary_documents(
    links: DataFrame, pages: DataFrame, status: str = "keep", roll: int = ROLL, *, links_file: str | None = None,
    output_directory: str | None = None, timestamp: str | None = None,
) -> DataFrame:
    """Scraping summaries of every site that has links, in the shape of ``SITE_SUMMARY``.

    The failed URLs are those of ``not_scraped``, in URL order; a site with more than ``roll`` of them has several documents, which
    repeat its counts and carry ``part``. ``base_url`` is the root of the site's smallest source page.
    """
    links, pages = checkpointed(links), checkpointed(pages.select("url").distinct())
    counts = curation.scrape_summary(links, pages, status)
    base = links.groupBy(F.col("site_name").alias("_site")).agg(F.min("source_page").alias("page"))
    header = counts.join(base, F.col("site_name").eqNullSafe(F.col("_site"))).select("site_name", F.struct(
        F.lit("html_scraping").alias("phase"), F.lit(timestamp).cast("string").alias("timestamp"),
        F.lit(links_file).cast("string").alias("links_file_used"), F.lit(status).alias("status_filter_used"),
        F.col("total_links").alias("total_links_in_file"), F.col("filtered_links").alias("filtered_links_count"),
        F.col("scraped").alias("successfully_scraped"),
        F.lit(output_directory).cast("string").alias("output_directory"),
        F.regexp_extract("page", r"^[^/]+//[^/]+", 0).alias("base_url"), F.col("site_name").alias("base_domain"),
    ).alias("header"))
    failed = _entries(curation.not_scraped(links, pages, status), F.col("url"), "url")
    docs = _rolled({"failed_urls": failed}, header, roll)
    return docs.select("header.*", "failed_urls", "part")


def write_summaries(links: DataFrame, pages: DataFrame, path: str, status: str = "keep", roll: int = ROLL, **header: str) -> None:
    """Scraping summaries as JSON, one per line; ``header`` as in ``summary_documents``."""
    docs = summary_documents(links, pages, status, roll, **header)
    docs.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def processed_documents(beans: DataFrame, processed_at: str) -> DataFrame:
    """Bean rows -> one document per source file, beans in payload order.

    Grouped by source file: a document holds the beans of one page and is as large as that page's payload. Rows without a
    source file have no page in common: each makes a document of its own, equal rows share one.
    """
    entry = F.struct(*[c for c in beans.columns if c not in ("source_file", "idx", "error")])
    apart = F.when(F.col("source_file").isNull(), F.xxhash64(*beans.columns)).alias("apart")
    docs = beans.groupBy("source_file", apart).agg(
        F.array_sort(F.collect_list(F.when(F.col("idx").isNotNull(), F.struct("idx", entry.alias("bean"))))).alias("b"),
        *([F.max("error").alias("error")] if "error" in beans.columns else []),
    )
    return docs.select(
        "source_file", F.lit(processed_at).alias("processed_at"),
        F.transform("b", lambda x: x["bean"]).alias("coffee_beans"), F.size("b").alias("beans_found"),
        *(["error"] if "error" in beans.columns else []),
    )


def write_processed(beans: DataFrame, path: str, processed_at: str) -> None:
    """JSON documents, one row per source file."""
    processed_documents(beans, processed_at).write.mode("overwrite").json(path)


def write_catalog(catalog: dict[str, DataFrame], path: str) -> None:
    """Every catalog table as Parquet below one path."""
    for name, table in catalog.items():
        table.write.mode("overwrite").parquet(f"{path}/{name}")
