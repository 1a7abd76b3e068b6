"""Sources: page corpora, discovery documents, processed documents and site summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webcat.schemas import CATALOG, LINKS_DOCUMENT, PROCESSED_DOCUMENT, SITE_SUMMARY

SITE_METADATA = [n for n in LINKS_DOCUMENT["discovery_metadata"].dataType.fieldNames() if n not in ("part", "first_entry")]


def read_pages(spark: SparkSession, path: str, format: str = "parquet", recursive: bool = False) -> DataFrame:
    """A page table; or with format ``html`` the ``*.html`` files of a directory, one row per file.

    A file has no address of its own: ``page_id`` is the hash of its full path, so equal names in two folders
    stay apart, and ``url`` its name. Folders below the directory are read only if ``recursive``. Bytes that are not UTF-8
    become replacement characters; the file keeps its row, and ``malformed`` tells of it.
    """
    if format != "html":
        return spark.read.format(format).load(path)
    files = spark.read.text(path, wholetext=True, pathGlobFilter="*.html", recursiveFileLookup=recursive)
    return files.select(
        F.xxhash64(F.col("_metadata.file_path")).alias("page_id"),
        F.col("_metadata.file_name").alias("url"),
        F.make_valid_utf8("value").alias("html"),
        F.col("_metadata.file_name").alias("source_file"),
        (~F.is_valid_utf8("value")).alias("malformed"),
    )


def _discovery_documents(spark: SparkSession, path: str, multiline: bool) -> DataFrame:
    """One row per document: the site's metadata as columns, then the lists."""
    docs = spark.read.schema(LINKS_DOCUMENT).json(path, multiLine=multiline)
    return docs.select("discovery_metadata.*", "discovered_links", "source_pages", "failed_urls")


def read_links(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Discovery documents, one JSON object per file or per line: one row per link with its site's metadata.

    ``seq`` is the link's place in its site's list, also where that goes on in further documents.
    """
    docs = _discovery_documents(spark, path, multiline)
    first = F.coalesce("first_entry", F.lit(0)).cast("int")
    return docs.select(*SITE_METADATA, first.alias("first"), F.posexplode("discovered_links").alias("at", "link")).select(
        *SITE_METADATA, (F.col("first") + F.col("at")).alias("seq"), "link.*"
    )


def read_source_pages(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """The source-page records of discovery documents."""
    docs = _discovery_documents(spark, path, multiline)
    return docs.select("site_name", F.explode("source_pages").alias("page")).select("site_name", "page.*")


def read_failed_urls(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """The addresses that discovery documents list as failed: (site_name, url)."""
    return _discovery_documents(spark, path, multiline).select("site_name", F.explode("failed_urls").alias("url"))


def read_processed(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Processed documents: one row per bean; a document without beans keeps one row with idx NULL."""
    docs = spark.read.schema(PROCESSED_DOCUMENT).json(path, multiLine=multiline)
    return docs.select(
        "source_file", "processed_at", "error",
        F.coalesce("beans_found", F.size(F.coalesce("coffee_beans", F.array()))).alias("beans_found"),
        F.posexplode_outer("coffee_beans").alias("idx", "bean"),
    ).select("source_file", "processed_at", "error", "beans_found", "idx", "bean.*")


def read_summaries(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Site summaries of both shapes, one row per site and part: a site's failed URLs may go on in further parts."""
    return spark.read.schema(SITE_SUMMARY).json(path, multiLine=multiline)


def read_catalog(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The catalog tables stored below one path."""
    return {name: spark.read.schema(schema).parquet(f"{path}/{name}") for name, schema in CATALOG.items()}


def html_only(pages: DataFrame) -> DataFrame:
    """Pages with a body and, where the column exists, an HTML content type."""
    kept = pages.filter(F.length("html") > 0)
    if "content_type" in pages.columns:
        kept = kept.filter(F.contains(F.lower("content_type"), F.lit("html")))
    return kept
