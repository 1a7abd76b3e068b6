"""Breadth-first walk over a stored link graph, redirects and crawl statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webcat.operators.skew import join_unique
from webcat.session import checkpointed, numbered_within


HUB_EDGES = 1_000_000


def _prepared_edges(edges: DataFrame, hub_edges: int) -> tuple[DataFrame, DataFrame]:
    """Distinct edges, hash-partitioned once by (src, part), and the hubs: (src, parts).

    A source with more than ``hub_edges`` targets is cut into parts by its targets' hash, so no partition
    holds more of one source. There is at most one hub per ``hub_edges`` edges.
    """
    distinct = edges.select("src", "dst").filter(F.col("src") != F.col("dst")).distinct()
    hubs = checkpointed(
        distinct.groupBy("src").agg(F.count("*").alias("n")).filter(F.col("n") > hub_edges)
        .select("src", F.ceil(F.col("n") / hub_edges).cast("int").alias("parts"))
    )
    part = F.pmod(F.xxhash64("dst"), F.coalesce("parts", F.lit(1))).cast("int")
    placed = distinct.join(hubs, "src", "left").select("src", part.alias("part"), "dst")
    return checkpointed(placed.repartition("src", "part")), hubs


def redirect_ends(redirects: DataFrame, failed: DataFrame | None = None) -> DataFrame:
    """Where each address of a redirect or a failure leads in the end: (url, final), NULL where no page is got.

    ``redirects`` is (from_url, to_url), ``failed`` is (url). A failed address leads nowhere, whatever redirect is
    known of it; so does a chain that ends at one, and a chain that runs into a loop. Of several redirects of one
    address the smallest target counts.

    Chains are followed by pointer jumping: each round an address points to where its target points, so a chain of n
    takes log2(n) rounds, and only chains that are still open are worked on. Many addresses may point to one target; such
    a target does not gather them (``join_unique``). As long as a chain is open each round closes some of it; when a round
    closes nothing, what is left leads into a loop.
    """
    steps = redirects.filter(F.col("from_url").isNotNull() & F.col("to_url").isNotNull()).groupBy("from_url").agg(F.min("to_url").alias("to_url"))
    steps = steps.select(F.col("from_url").alias("url"), F.col("to_url").alias("final"))
    gone = None if failed is None else checkpointed(failed.select("url").filter("url IS NOT NULL").distinct())
    if gone is not None:
        steps = steps.join(gone, "url", "left_anti")
    pointers = checkpointed(steps)
    closed, still, left = [pointers.limit(0)], pointers, pointers.count()
    while left:
        # pointers of this round, by the address they are looked up under
        ahead = pointers.select(F.col("url").alias("final"), F.col("final").alias("next"))
        jumped = checkpointed(join_unique(still, ahead, "final", "left"))
        closed.append(jumped.filter("next IS NULL").select("url", "final"))
        still = jumped.filter("next IS NOT NULL").select("url", F.col("next").alias("final"))
        before, left = left, still.count()
        if left == before:
            break
        pointers = still.unionByName(_all(closed))
    ends = _all(closed).unionByName(still.select("url", F.lit(None).cast("string").alias("final")))
    if gone is None:
        return ends
    bad = gone.select(F.col("url").alias("final"), F.lit(True).alias("bad"))
    met = join_unique(ends, bad, "final", "left").select("url", F.when(F.col("bad").isNull(), F.col("final")).alias("final"))
    return met.unionByName(gone.select("url", F.lit(None).cast("string").alias("final")))


def _all(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def _outcomes(reached: DataFrame, ends: DataFrame | None) -> DataFrame:
    """Addresses (url) that the walk asks for -> a row (url, via, hop, state, final_url) for each and for each redirect's target."""
    nothing = F.lit(None).cast("string")
    own = [F.col("url").alias("via"), F.lit(0).alias("hop")]
    if ends is None:
        return reached.select("url", *own, F.lit("fetched").alias("state"), nothing.alias("final_url"))
    known = ends.select("url", F.lit(True).alias("known"), "final")
    met = reached.join(known, "url", "left")
    state = F.when(F.col("known").isNull(), "fetched").when(F.col("final").isNull(), "failed").otherwise("redirect")
    asked = F.struct(F.col("url").alias("url"), *own, state.alias("state"), F.col("final").alias("final_url"))
    target = F.struct(F.col("final").alias("url"), F.col("url").alias("via"), F.lit(1).alias("hop"), F.lit("fetched").alias("state"), nothing.alias("final_url"))
    return met.select(F.explode(F.array_compact(F.array(asked, F.when(F.col("final").isNotNull(), target)))).alias("r")).select("r.*")


def walk(
    edges: DataFrame, seeds: DataFrame, max_pages: int, redirects: DataFrame | None = None, failed: DataFrame | None = None,
    max_depth: int | None = None, hub_edges: int = HUB_EDGES,
) -> DataFrame:
    """Addresses that a breadth-first crawl visits: (url, depth, state, final_url, via, hop), at most ``max_pages``.

    ``edges`` is (src, dst), ``seeds`` is (url), ``redirects`` is (from_url, to_url), ``failed`` is (url). An address is visited
    once, in one state: ``fetched``; ``failed``, also where its redirects end at a failure or in a loop;
    ``redirect``, with ``final_url``, whose target is visited (``fetched``) together with it (hop 1, ``via`` the address asked for).
    All of them count. Only fetched pages have links to follow, so a link to a visited redirect's target or to a
    failed address starts nothing.

    The order is (depth, via, hop, url): what leads to an address comes before it, so a walk cut at any number is what a
    crawl would have done by then. Level by level the fetched pages of a level are joined with the edges, reduced to distinct
    targets before the shuffle, and cut against everything visited. The edges are partitioned and checkpointed once; a level
    shuffles its own pages and, to leave out those already visited, the visited addresses. Each level is checkpointed too:
    the plan stays short and a lost executor costs one level. The driver sees one count per level. The walk stops
    when a level is empty or the budget is full (later levels can only rank behind); only the last level is
    numbered, by ranges. There is no bound on the depth unless ``max_depth`` asks for one.
    """
    placed, hubs = _prepared_edges(edges, hub_edges)
    ends = None
    if redirects is not None or failed is not None:
        spark = edges.sparkSession
        none = spark.createDataFrame([], "from_url string, to_url string")
        ends = checkpointed(redirect_ends(none if redirects is None else redirects, failed))

    def visit(reached: DataFrame, depth: int) -> DataFrame:
        rows = _outcomes(reached, ends)
        if ends is None:
            return rows.withColumn("depth", F.lit(depth))
        # several redirects of a level may share a target, which may have been asked for as well
        first = F.min(F.struct("via", "hop", "state", "final_url")).alias("first")
        return rows.groupBy("url").agg(first).select("url", "first.*").withColumn("depth", F.lit(depth))

    level = checkpointed(visit(seeds.select("url").filter("url IS NOT NULL").distinct(), 0))
    done, visited, before, total, depth = [], level, 0, level.count(), 0
    while total < max_pages and (max_depth is None or depth < max_depth):
        depth += 1
        starts = level.filter("state = 'fetched'").select(F.col("url").alias("src")).join(hubs, "src", "left").select(
            "src", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part")
        )
        reached = starts.join(placed, ["src", "part"]).select(F.col("dst").alias("url")).distinct()
        fresh = reached if ends is None else reached.join(visited.select("url"), "url", "left_anti")
        found = checkpointed(visit(fresh, depth).join(visited.select("url"), "url", "left_anti"))
        n = found.count()
        if not n:
            break
        done.append(level)
        before, total = total, total + n
        level, visited = found, visited.unionByName(found)
    if total > max_pages:
        last = numbered_within(level, "depth", "via", "hop", "url").filter(F.col("idx") < max_pages - before).drop("idx")
        visited = _all([*done, last])
    return visited.select("url", "depth", "state", "final_url", "via", "hop")


def frontier(
    edges: DataFrame, seeds: DataFrame, max_pages: int, max_depth: int | None = None, hub_edges: int = HUB_EDGES
) -> DataFrame:
    """Pages that a crawl without redirects and failures visits: (url, depth), the first ``max_pages`` of ``walk``."""
    return walk(edges, seeds, max_pages, max_depth=max_depth, hub_edges=hub_edges).select("url", "depth").orderBy("depth", "url")


def resolve_redirects(links: DataFrame, redirects: DataFrame, visited: DataFrame) -> DataFrame:
    """Marks links that lead where a visited redirect already led: adds ``is_duplicate``.

    ``redirects`` is (from_url, to_url), ``visited`` is (url). The redirect table grows with the crawl, so
    the join is left to the optimizer instead of being forced to broadcast.
    """
    targets = (
        redirects.join(visited.select("url").distinct(), redirects["from_url"] == F.col("url"), "left_semi")
        .select(F.col("to_url").alias("url"))
        .distinct()
        .withColumn("is_target", F.lit(True))
    )
    return links.join(targets, "url", "left").select(
        *[links[c] if c != "url" else F.col("url") for c in links.columns],
        F.coalesce("is_target", F.lit(False)).alias("is_duplicate"),
    )


def crawl_stats(pages: DataFrame, links: DataFrame, failed: DataFrame, visited: DataFrame) -> DataFrame:
    """One row: pages_crawled, urls_failed, unique_links, coverage and visited ratio per unique link."""
    def counted(df: DataFrame, name: str, distinct: bool = False) -> DataFrame:
        n = F.count_distinct("url") if distinct else F.count("*")
        return df.select("url").agg(n.alias("n")).select(F.lit(name).alias("what"), "n")

    counts = (
        counted(pages, "pages_crawled")
        .unionByName(counted(failed, "urls_failed", distinct=True))
        .unionByName(counted(links, "unique_links", distinct=True))
        .unionByName(counted(visited, "visited", distinct=True))
    )

    def of(name: str):
        return F.max(F.when(F.col("what") == name, F.col("n")))

    row = counts.agg(*[of(n).alias(n) for n in ("pages_crawled", "urls_failed", "unique_links", "visited")])
    denominator = F.greatest("unique_links", F.lit(1))
    return row.select(
        "pages_crawled", "urls_failed", "unique_links",
        (F.col("pages_crawled") / denominator).alias("coverage_ratio"),
        (F.col("visited") / denominator).alias("visited_ratio"),
    )
