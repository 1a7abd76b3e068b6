"""Incremental page ingest: new pages in, each link URL out once.

Two sinks: a store that keeps the first occurrence of each URL by (page, method, position), whatever the order in which
pages arrive, and an append-only stream that sends a URL when it first turns up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from webcat.functions import urls as U
from webcat.operators.links import PROFILES, LinkProfile, method_of, resolved_candidates
from webcat.session import listed, removed

PAGE_SCHEMA = "page_id bigint, url string, html string"
HEADER_SCHEMA = ", response_headers map<string, string>, content_type string"


def new_links(pages: DataFrame, profile: LinkProfile = PROFILES["default"]) -> DataFrame:
    """Links of a page stream, each URL the first time it is seen.

    Extraction is stateless; the only state is the set of URLs already sent, one row per URL, kept as long
    as the stream lives because a crawl may meet a URL again at any time. There is no event time to put a
    watermark on. Use the RocksDB state store for large corpora so that the set lives on disk.
    """
    found = resolved_candidates(pages, profile)
    return found.select(
        "page_id", "source_page", "url",
        method_of(F.col("first_seen")).alias("discovery_method"),
        U.link_type(F.col("url"), F.col("host")).alias("link_type"),
        F.lit("pending").alias("status"), F.lit("").alias("notes"),
    ).dropDuplicates(["url"])


def read_page_stream(
    spark: SparkSession, path: str, files_per_batch: int = 1000, glob: str = "*.parquet", headers: bool = False
) -> DataFrame:
    """Page files as they arrive: (page_id, url, html); ``headers`` adds response_headers and content_type.

    Links of the HTTP ``Link`` header are found only with ``headers``; files without these columns give nulls.
    """
    schema = PAGE_SCHEMA + HEADER_SCHEMA if headers else PAGE_SCHEMA
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("pathGlobFilter", glob)
        .parquet(path)
    )


def start_link_stream(
    pages: DataFrame, output: str, checkpoint: str, profile: LinkProfile = PROFILES["default"]
) -> StreamingQuery:
    """Write new links to Parquet, exactly once; takes what is there and stops."""
    return (
        new_links(pages, profile)
        .writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


# --- a store of first occurrences --------------------------------------------------------------

#: So many runs of one level are merged into one of the next.
RUNS = 8


def first_occurrences(found: DataFrame) -> DataFrame:
    """Of rows (url, page_id, first_seen, ..) the first of each URL by (page_id, method, position)."""
    rest = [c for c in found.columns if c not in ("url", "page_id", "first_seen")]
    first = F.min(F.struct("page_id", "first_seen", *rest)).alias("first")
    return found.groupBy("url").agg(first).select("url", "first.*")


def _merged(spark: SparkSession, store: str, level: int) -> None:
    """Merge the runs of a level if there are enough. A crash in between leaves rows twice, which changes no minimum."""
    runs = [r for r in listed(spark, f"{store}/level={level}") if r.startswith("run=")]
    if len(runs) < RUNS:
        return
    rows = spark.read.parquet(*[f"{store}/level={level}/{r}" for r in runs])
    first_occurrences(rows).write.mode("overwrite").parquet(f"{store}/level={level + 1}/{runs[-1]}")
    for run in runs:
        removed(spark, f"{store}/level={level}/{run}")
    _merged(spark, store, level + 1)


def start_link_store(pages: DataFrame, store: str, checkpoint: str, profile: LinkProfile = PROFILES["default"]) -> StreamingQuery:
    """Keep the first occurrence of every link URL in ``store``; takes what is there and stops.

    A batch writes the minimum of its own rows as a run named by the batch, so a batch that is repeated replaces itself
    and costs what it holds, not what the store holds. ``RUNS`` runs of a level are merged into one of the next, so a row is
    rewritten a logarithmic number of times. Minima need no order: the result is the same for any order and split of files.
    """
    def keep(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        first_occurrences(batch).write.mode("overwrite").parquet(f"{store}/level=0/run={number:012d}")
        _merged(spark, store, 0)

    found = resolved_candidates(pages, profile).select(
        "url", "page_id", "first_seen", "source_page", U.link_type(F.col("url"), F.col("host")).alias("link_type")
    )
    return (
        found.writeStream.foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_link_store(spark: SparkSession, store: str) -> DataFrame:
    """The links of a store: (page_id, source_page, url, discovery_method, link_type, status, notes), each URL once."""
    schema = "url string, page_id bigint, first_seen bigint, source_page string, link_type string, level int, run string"
    rows = spark.read.schema(schema).parquet(store).drop("level", "run")
    return first_occurrences(rows).select(
        "page_id", "source_page", "url", method_of(F.col("first_seen")).alias("discovery_method"), "link_type",
        F.lit("pending").alias("status"), F.lit("").alias("notes"),
    )
