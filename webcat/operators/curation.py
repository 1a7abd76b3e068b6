"""Link curation: rules, counts, previews and set differences."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class StatusRule:
    """kind: internal_only, external, contains, method or skip_extension; arg where the kind needs one."""

    kind: str
    target: str
    arg: str | None = None

    @classmethod
    def parse(cls, name: str, target: str) -> "StatusRule":
        """Rule from its one-word form, such as ``contains_coffee`` or ``skip_extension_pdf``."""
        for kind in ("skip_extension", "contains", "method"):
            if name.startswith(kind + "_"):
                return cls(kind, target, name[len(kind) + 1:])
        return cls(name, target)

    def condition(self) -> Column:
        url = F.lower("url")
        if self.kind == "internal_only":
            return F.col("link_type") == "internal"
        if self.kind == "external":
            return F.col("link_type") == "external"
        if self.kind == "contains":
            return F.contains(url, F.lit(self.arg))
        if self.kind == "method":
            return F.col("discovery_method") == self.arg
        if self.kind == "skip_extension":
            return F.endswith(url, F.lit(f".{self.arg}"))
        raise ValueError(f"unknown rule kind: {self.kind}")


def update_status(links: DataFrame, rules: list[StatusRule]) -> DataFrame:
    """Apply rules in order, the last match wins; adds ``old_status`` beside the new ``status``."""
    old = F.coalesce("status", F.lit("pending"))
    new = old
    for rule in reversed(rules):
        # the last rule is tested first, so one chain of conditions gives the last match
        new = F.when(rule.condition(), rule.target) if new is old else new.when(rule.condition(), rule.target)
    if new is not old:
        new = new.otherwise(old)
    return links.select(
        *[c for c in links.columns if c not in ("status", "old_status")], old.alias("old_status"), new.alias("status")
    )


def update_counts(updated: DataFrame) -> DataFrame:
    """Links whose status really changed, per new status."""
    return updated.filter(F.col("status") != F.col("old_status")).groupBy("status").agg(
        F.count("*").alias("n_changed")
    )


def select_status(links: DataFrame, status: str = "keep") -> DataFrame:
    return links.filter(F.col("status") == status)


def link_breakdown(links: DataFrame) -> DataFrame:
    """Counts by status, by discovery method and by link type in one pass: (dimension, value, n_links).

    Missing values count as unknown; link types other than internal and external are left out.
    """
    dims = {"status": "status", "discovery_method": "method", "link_type": "type"}
    filled = links.select(*[F.coalesce(c, F.lit("unknown")).alias(c) for c in dims])
    # one small pre-aggregation over the few combinations, then one row per dimension
    combos = filled.groupBy(*dims).agg(F.count("*").alias("n"))
    rows = combos.select(
        F.explode(F.array(*[F.struct(F.lit(label).alias("dimension"), F.col(c).alias("value"))
                            for c, label in dims.items()])).alias("d"),
        "n",
    )
    return (
        rows.groupBy("d.dimension", "d.value")
        .agg(F.sum("n").alias("n_links"))
        .filter((F.col("dimension") != "type") | F.col("value").isin("internal", "external"))
    )


def link_preview(links: DataFrame, n: int = 20) -> DataFrame:
    """First n links of a site file, in (page, url) order."""
    return links.orderBy("page_id", "url").limit(n)


def uncrawled(all_links: DataFrame, visited: DataFrame) -> DataFrame:
    """Distinct discovered URLs that were never visited: (url)."""
    return all_links.select("url").distinct().join(visited.select("url").distinct(), "url", "left_anti")


def not_scraped(links: DataFrame, pages: DataFrame, status: str = "keep") -> DataFrame:
    """Links of a status (kept ones) without a stored page."""
    return select_status(links, status).join(pages.select("url").distinct(), "url", "left_anti")


def scrape_summary(links: DataFrame, pages: DataFrame, status: str = "keep") -> DataFrame:
    """One row per site: total_links, filtered_links, scraped, failed.

    The failed URLs themselves are the rows of ``not_scraped``; a list per site would gather a third of
    all links in one task where one site dominates.
    """
    stored = pages.select("url").distinct().withColumn("stored", F.lit(True))
    marked = links.join(stored, "url", "left")
    kept = F.coalesce(F.col("status") == status, F.lit(False))
    found = F.col("stored").isNotNull()
    return marked.groupBy("site_name").agg(
        F.count("*").alias("total_links"),
        F.count_if(kept).alias("filtered_links"),
        F.count_if(kept & found).alias("scraped"),
        F.count_if(kept & ~found).alias("failed"),
    )
