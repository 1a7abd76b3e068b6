"""Curation, frontier, payloads, catalog, sources, sinks and the stream."""

import collections
import json

import pytest
from pyspark.sql import functions as F

from webcat import schemas
from webcat.functions import normalize as N
from webcat.operators import catalog as C
from webcat.operators import curation, frontier, jsdep, payload
from webcat.operators import links as L
from webcat.operators.curation import StatusRule
from webcat.session import numbered_within, scratch_dir
from webcat.sources import readers, writers
from webcat.streaming import ingest

LINKS = "page_id bigint, source_page string, url string, discovery_method string, link_type string, status string, notes string"


def link(spark, *rows):
    return spark.createDataFrame([(i, "https://x.com/", *r, "") for i, r in enumerate(rows)], LINKS)


# --- curation ----------------------------------------------------------------------------------

def test_last_matching_rule_wins(spark):
    rules = [StatusRule("internal_only", "keep"), StatusRule.parse("contains_cart", "skip"),
             StatusRule.parse("skip_extension_html", "pending")]
    df = link(spark, ("https://x.com/CART", "anchor", "internal", "pending"), ("https://x.com/a", "anchor", "internal", "keep"),
              ("https://x.com/p.HTML", "meta", "internal", "pending"), ("https://y.com/", "anchor", "external", None))
    updated = curation.update_status(df, rules)
    assert [r.status for r in updated.orderBy("page_id").collect()] == ["skip", "keep", "pending", "pending"]
    assert {(r.status, r.n_changed) for r in curation.update_counts(updated).collect()} == {("skip", 1)}
    again = curation.update_status(updated, rules)
    assert curation.update_counts(again).count() == 0


def test_unknown_rule():
    with pytest.raises(ValueError):
        StatusRule("nonsense", "keep").condition()


def test_breakdown_counts_missing_as_unknown(spark):
    df = link(spark, ("u1", None, "internal", None), ("u2", "anchor", "odd", "keep"))
    got = {(r.dimension, r.value, r.n_links) for r in curation.link_breakdown(df).collect()}
    assert got == {("status", "unknown", 1), ("status", "keep", 1), ("method", "unknown", 1), ("method", "anchor", 1),
                   ("type", "internal", 1)}


def test_sets_and_summary(spark):
    df = link(spark, ("a", "anchor", "internal", "keep"), ("b", "anchor", "internal", "keep"), ("b", "meta", "internal", "skip"))
    pages = spark.createDataFrame([("a",)], "url string")
    assert [r.url for r in curation.uncrawled(df, pages).collect()] == ["b"]
    assert [r.url for r in curation.not_scraped(df, pages).collect()] == ["b"]
    row = curation.scrape_summary(df.withColumn("site_name", F.lit("s")), pages).first()
    assert tuple(row) == ("s", 3, 2, 1, 1)
    assert [r.url for r in curation.link_preview(df, 2).collect()] == ["a", "b"]


# --- frontier ----------------------------------------------------------------------------------

EDGES = [("a", "b"), ("a", "c"), ("b", "d"), ("c", "d"), ("d", "a"), ("d", "e"), ("e", "e")]


@pytest.mark.parametrize("budget,expected", [(3, ["a", "b", "c"]), (1, ["a"]), (100, ["a", "b", "c", "d", "e"])])
@pytest.mark.parametrize("hub_edges", [1, 1000])
def test_frontier(spark, budget, expected, hub_edges):
    edges = spark.createDataFrame(EDGES * 2, "src string, dst string")
    seeds = spark.createDataFrame([("a",)], "url string")
    got = frontier.frontier(edges, seeds, budget, hub_edges=hub_edges).collect()
    assert [r.url for r in got] == expected
    assert len(got) <= budget


def test_frontier_has_no_depth_cap(spark):
    chain = [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(61)]
    edges = spark.createDataFrame(chain, "src string, dst string")
    seeds = spark.createDataFrame([("n000",)], "url string")
    assert frontier.frontier(edges, seeds, 100).count() == 62


def test_payload_items_are_parsed_one_by_one(spark):
    rows = spark.createDataFrame([
        ("a", '[{"name":"A","price":1,"name":"B"}]'), ("b", '[1,{"name":"A","price":2}]'),
        ("c", '[{"name":"A","price":"$1,023.50","altitude":1850.5}]'), ("d", '[{"name": "cut'), ("e", '{"name":"A"}'),
    ], "source_file string, payload string")
    got = {(r["source_file"], r["idx"]): (r["name"], r["price"], r["altitude"]) for r in payload.parse_bean_payload(rows).collect()}
    assert got == {("a", 0): ("B", 1.0, None), ("b", 0): (None, None, None), ("b", 1): ("A", 2.0, None),
                   ("c", 0): ("A", 1023.5, 1850), ("d", None): (None, None, None), ("e", None): (None, None, None)}


def test_frontier_against_brute_force(spark):
    n = 300
    pairs = [(str(i), str(i * 7 % n)) for i in range(n)] + [("0", str(i)) for i in range(0, n, 3)]
    depth, level = {"0": 0, "5": 0}, {"0", "5"}
    while level:
        level = {d for s, d in pairs if s in level and d not in depth}
        depth.update(dict.fromkeys(level, max(depth.values()) + 1))
    want = sorted(depth.items(), key=lambda x: (x[1], x[0]))[:150]
    got = frontier.frontier(spark.createDataFrame(pairs, "src string, dst string"),
                            spark.createDataFrame([("0",), ("5",)], "url string"), 150, hub_edges=10)
    assert [tuple(r) for r in got.collect()] == want


def plain_ends(redirects, failed):
    """Final address by following one step after the other, None for failures and loops."""
    step = {}
    for a, b in sorted(redirects, reverse=True):
        step[a] = b
    step = {a: b for a, b in step.items() if a not in failed}
    out = dict.fromkeys(failed)
    for a in step:
        seen, at = {a}, step[a]
        while at in step and at not in seen:
            seen.add(at)
            at = step[at]
        out[a] = None if at in seen or at in failed or at in step else at
    return out


def plain_walk(edges, seeds, redirects, failed, budget):
    """The walk one address at a time, in order."""
    fate, after = plain_ends(redirects, failed), {}
    for a, b in edges:
        after.setdefault(a, set()).add(b)
    seen, out, level, depth = {}, [], sorted(set(seeds)), 0
    while level:
        rows = {}
        for u in level:
            state = "fetched" if u not in fate else "failed" if fate[u] is None else "redirect"
            for row in [(u, depth, state, fate.get(u), u, 0)] + ([(fate[u], depth, "fetched", None, u, 1)] if fate.get(u) else []):
                if row[0] not in seen:
                    rows[row[0]] = min(rows.get(row[0], row), row, key=lambda r: r[4:])
        seen.update(rows)
        out += sorted(rows.values(), key=lambda r: (r[4], r[5], r[0]))
        level = sorted({d for r in rows.values() if r[2] == "fetched" for d in after.get(r[0], ())} - seen.keys())
        depth += 1
    return out[:budget]


def test_redirect_ends(spark):
    redirects = [("a", "b"), ("b", "c"), ("c", "d"), ("a", "z"), ("x", "y"), ("y", "x"), ("t", "x"), ("s", "s"), ("f", "g"), ("h", "f"), ("k", "f"), (None, "q"), ("q", None)]
    redirects += [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(130)] + [(f"m{i}", "d") for i in range(300)]
    failed = ["f", "never", "n131"]
    got = frontier.redirect_ends(spark.createDataFrame(redirects, "from_url string, to_url string"), spark.createDataFrame([(u,) for u in [*failed, None, "f"]], "url string"))
    rows = got.collect()
    want = plain_ends([r for r in redirects if None not in r], set(failed))
    assert {r["url"]: r["final"] for r in rows} == want and len(rows) == len(want)
    assert want["a"] == "d" and want["t"] is None and want["h"] is None and want["n000"] == "n130"


@pytest.mark.parametrize("budget", [7, 60, 10_000])
def test_walk_against_one_address_at_a_time(spark, budget):
    import random

    rng = random.Random(5)
    name = [f"u{i:03d}" for i in range(400)]
    edges = [(rng.choice(name), rng.choice(name)) for _ in range(700)] + [("u000", u) for u in name[::9]]
    redirects = [(u, rng.choice(name)) for u in rng.sample(name[1:], 120)]
    failed = rng.sample(name[1:], 40)
    seeds = ["u000", "u007", redirects[0][0], failed[0]]
    got = frontier.walk(spark.createDataFrame(edges, "src string, dst string"), spark.createDataFrame([(u,) for u in [*seeds, None]], "url string"), budget,
                        spark.createDataFrame(redirects, "from_url string, to_url string"), spark.createDataFrame([(u,) for u in failed], "url string"), hub_edges=5)
    want = plain_walk(edges, seeds, redirects, set(failed), budget)
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) == min(budget, len(want))
    assert {r[2] for r in plain_walk(edges, seeds, redirects, set(failed), 10_000)} == {"fetched", "failed", "redirect"}


def test_join_unique_with_a_hot_key(spark):
    from webcat.operators import skew

    rows = spark.range(3000).select(F.when(F.col("id") % 10 < 9, F.lit(-1)).when(F.col("id") % 20 == 19, F.lit(None)).otherwise(F.col("id")).alias("k"), "id")
    table = spark.range(-5, 2000, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("inner", "left"):
        got = sorted(map(str, skew.join_unique(rows, table, "k", how, one_in=10).select("k", "id", "v").collect()))
        assert got == sorted(map(str, rows.join(table, "k", how).select("k", "id", "v").collect()))
    assert [r["k"] for r in skew.heavy_keys(rows, "k", 10).collect()] == [-1]
    assert skew.join_unique(rows.limit(0), table, "k").count() == 0


def test_a_popular_object_is_not_gathered(spark):
    from webcat.operators import catalog as C

    n = 60_000
    hot = F.when(F.col("id") % 10 < 9, F.lit(7)).otherwise(F.col("id") % 500)
    tables = {
        "user_interactions": spark.range(n).select("id", F.lit("bean").alias("object_type"), hot.alias("object_id")).repartition(8),
        "beans": spark.range(500).select("id", F.concat(F.lit("b"), "id").alias("name")),
        "cafe_locations": spark.range(0).select("id", F.lit("").alias("address")),
        "menu_items": spark.range(0).select("id", F.lit("").alias("name")),
    }
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = C.object_lookup(tables)
        sizes = [r["n"] for r in found.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert sum(sizes) == n and max(sizes) < 2 * n / 8
        assert found.filter("object_name IS NULL OR object_name <> concat('b', object_id)").count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_redirects(spark):
    df = link(spark, ("t", "anchor", "internal", "pending"), ("u", "anchor", "internal", "pending"))
    redirects = spark.createDataFrame([("s", "t"), ("never", "u")], "from_url string, to_url string")
    visited = spark.createDataFrame([("s",)], "url string")
    got = frontier.resolve_redirects(df, redirects, visited).collect()
    assert {(r.url, r.is_duplicate) for r in got} == {("t", True), ("u", False)}


def test_crawl_stats_without_links(spark):
    pages = spark.createDataFrame([("a",), ("b",)], "url string")
    empty = spark.createDataFrame([], "url string")
    assert tuple(frontier.crawl_stats(pages, empty, empty, pages).first()) == (2, 0, 0, 2.0, 2.0)


def test_rendering_breakdown(spark):
    df = spark.createDataFrame([("static",), ("static",), (None,), ("dynamic",)], "rendering_method string")
    got = {(r.rendering_method, r.n_pages, r.percent) for r in jsdep.rendering_breakdown(df).collect()}
    assert got == {("static", 2, 50.0), ("unknown", 1, 25.0), ("dynamic", 1, 25.0)}


# --- payloads ----------------------------------------------------------------------------------

def payloads(spark, *texts):
    return spark.createDataFrame([(f"f{i}", t) for i, t in enumerate(texts)], "source_file string, payload string")


def test_parse_bean_payload(spark):
    good = json.dumps([{"name": "A", "price": 3, "flavor_notes": ["x"]}, {"name": "B", "altitude": 1900}])
    got = payload.parse_bean_payload(payloads(spark, good, "{}", "not json", "[]", '[{"name": "cut', None)).collect()
    assert [(r.source_file, r.idx, r.name, r.price) for r in got] == [
        ("f0", 0, "A", 3.0), ("f0", 1, "B", None), ("f1", None, None, None), ("f2", None, None, None),
        ("f3", None, None, None), ("f4", None, None, None), ("f5", None, None, None)]


def test_menu_price_is_text(spark):
    row = payload.parse_menu_payload(payloads(spark, '[{"name":"Latte","price":"$4","category":"COFFEE","size_options":["8oz"]}]')).first()
    assert (row.price, row.size_options) == ("$4", ["8oz"])


def test_validate_description(spark):
    texts = [None, "", "  ", "short", "a description of enough length"]
    df = payload.parse_bean_payload(payloads(spark, json.dumps([{"description": t} for t in texts])))
    got = payload.validate_description(df).orderBy("idx").collect()
    assert [r.description_check for r in got] == ["missing", "missing", "missing", "short", "ok"]
    assert got[0].description == "Description not available in source content" and got[3].description == "short"


def test_checks(spark):
    df = payload.parse_bean_payload(payloads(spark, json.dumps([
        {"name": "A", "roast_level": "light", "grind_type": "ground", "suitable_brew_types": ["espresso", "bucket"]}])))
    outside = payload.check_domain(df, payload.BEAN_DOMAINS, ["source_file"]).collect()
    assert {(r.column, r.value) for r in outside} == {("grind_type", "ground"), ("suitable_brew_types", "bucket")}
    assert {r.column for r in payload.check_required(df, payload.BEAN_REQUIRED, ["source_file"]).collect()} == {"price", "description"}


@pytest.mark.parametrize("function,raw,expected", [
    (N.normalize_roast, " City+ ", "medium"), (N.normalize_roast, "Vienna", "medium_dark"),
    (N.normalize_roast, "medium-light", "medium_light"), (N.normalize_roast, "", None), (N.normalize_roast, "Omni", "omni"),
    (N.normalize_grind, "Whole Beans", "whole"), (N.normalize_process, "Giling Basah", "wet_hulled"),
    (N.normalize_bean_type, "Coffea canephora", "robusta"), (N.normalize_brew, "drip", "drip_filter"),
])
def test_normalize(value, function, raw, expected):
    assert value(function(F.lit(raw))) == expected


def test_normalize_brew_list(value):
    assert value(N.normalize_brew_list(F.array(F.lit("V60"), F.lit(None), F.lit("Siphon")))) == ["pour_over", "siphon"]
    assert value(N.normalize_brew_list(F.array().cast("array<string>"))) is None


def test_to_catalog_keeps_the_key(spark):
    df = payload.parse_bean_payload(payloads(spark, '[{"name":"A","producer":"P","region":"R","altitude":1900}]', "{}"))
    beans, specialties = payload.to_catalog(df)
    assert beans.schema.names == schemas.CATALOG["beans"].names
    b, s = beans.collect(), specialties.collect()
    assert len(b) == len(s) == 1 and b[0].id == s[0].bean_id
    assert (b[0].proprietor, b[0].region_area, s[0].altitude_masl) == ("P", "R", 1900)


def test_results_and_summary(spark):
    df = payload.parse_bean_payload(payloads(spark, '[{"name":"A"},{"name":"B"}]', "{}"))
    results = payload.processing_results(df)
    assert {(r.source_file, r.beans_found) for r in results.collect()} == {("f0", 2), ("f1", 0)}
    assert tuple(payload.processing_summary(results).first()) == (2, 2, 1.0)
    assert tuple(payload.processing_summary(results.filter("false")).first()) == (0, 0, 0.0)
    assert [tuple(r) for r in payload.top_files(results).collect()] == [("f0", 2)]


# --- catalog -----------------------------------------------------------------------------------

@pytest.fixture
def shop(spark):
    rows = {
        "cafes": [(1, "one"), (2, "two")], "cafe_locations": [(10, 1, "a"), (20, 2, "b"), (30, None, "c")],
        "beans": [(100, "bean"), (101, "other")], "menu_items": [(5, 10, "latte"), (6, 20, "tea")],
        "cafe_location_beans": [(10, 100), (20, 100), (20, 999)],
        "users": [(7, "f", "l", "u7", "e7"), (8, "f", "l", "u7", "e8"), (9, "f", "l", None, "e9")],
        "user_liked_locations": [(7, 10), (7, 20), (8, 10)],
    }
    columns = {
        "cafes": ["id", "name"], "cafe_locations": ["id", "cafe_id", "address"], "beans": ["id", "name"],
        "menu_items": ["id", "location_id", "name"], "cafe_location_beans": ["location_id", "bean_id"],
        "users": ["id", "first_name", "last_name", "username", "email"], "user_liked_locations": ["user_id", "location_id"],
    }
    tables = schemas.empty_catalog(spark)
    for name, data in rows.items():
        types = {f.name: f.dataType.simpleString() for f in schemas.CATALOG[name].fields}
        schema = ", ".join(f"{c} {types[c]}" for c in columns[name])
        tables[name] = schemas.conform(spark.createDataFrame(data, schema), name)
    return tables


def test_integrity(shop):
    assert [tuple(r) for r in C.fk_violations(shop).collect()] == [("cafe_location_beans", "bean_id", 999, 1)]
    assert [tuple(r) for r in C.unique_violations(shop).collect()] == [("users", "username", "u7", 2)]
    assert [tuple(r) for r in C.not_null_violations(shop).collect()] == [("users", "username", 1)]


def test_cascade_delete(spark, shop):
    left = C.cascade_delete(shop, "cafes", spark.createDataFrame([(1,)], "id bigint"))
    ids = lambda name, key: {r[key] for r in left[name].collect()}
    assert ids("cafes", "id") == {2} and ids("cafe_locations", "id") == {20, 30} and ids("menu_items", "id") == {6}
    assert {tuple(r) for r in left["cafe_location_beans"].collect()} == {(20, 100), (20, 999)}
    assert [r.location_id for r in left["user_liked_locations"].collect()] == [20]
    assert left["beans"].count() == 2 and left["users"].count() == 3


def test_lookup_keeps_dangling_objects(spark, shop):
    shop["user_interactions"] = schemas.conform(spark.createDataFrame(
        [(1, 7, "view", "bean", 100, '{"duration_s": 12}'), (2, 7, "view", "menu_item", 6, None), (3, 7, "click", "bean", 5, "x")],
        "id bigint, user_id bigint, interaction string, object_type string, object_id bigint, metadata string"), "user_interactions")
    assert {r.id: r.object_name for r in C.object_lookup(shop).collect()} == {1: "bean", 2: "tea", 3: None}
    counts = {(r.interaction, r.object_type): r.sum_duration_s for r in C.interaction_counts(shop["user_interactions"]).collect()}
    assert counts == {("view", "bean"): 12, ("view", "menu_item"): None, ("click", "bean"): None}


def test_defaults_are_fixed_per_load(shop):
    got = C.with_defaults(shop["beans"], "beans", "2024-06-01 00:00:00").select("created_at").distinct().collect()
    assert len(got) == 1 and got[0][0].year == 2024


# --- sources, sinks, stream --------------------------------------------------------------------

def test_html_directory(spark, tmp_path):
    (tmp_path / "b.html").write_text("<p>ü</p>\n<p>2</p>", encoding="utf-8")
    (tmp_path / "note.txt").write_text("no")
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "c.html").write_text("no")
    got = readers.read_pages(spark, str(tmp_path), "html").collect()
    assert [(r.source_file, r.html) for r in got] == [("b.html", "<p>ü</p>\n<p>2</p>")]
    (tmp_path / "deep" / "b.html").write_text("no")
    other = readers.read_pages(spark, str(tmp_path / "deep"), "html").filter("source_file = 'b.html'").first()
    assert other.page_id != got[0].page_id  # equal names in two folders
    (tmp_path / "deep" / "d.html").write_bytes(b"<p>caf\xe9 \xff</p>")
    (tmp_path / "deep" / "e.html").write_bytes(b"")
    every = {(r.source_file, r.html, r.malformed) for r in readers.read_pages(spark, str(tmp_path), "html", recursive=True).collect()}
    assert ("d.html", "<p>caf\ufffd \ufffd</p>", True) in every and ("b.html", "no", False) in every
    assert {f for f, _, _ in every} >= {"b.html", "c.html", "d.html"} and len(every) >= 4


def test_beans_without_a_source_file_are_not_gathered(spark):
    beans = spark.createDataFrame([("a", 1, "x"), ("a", 0, "y")] + [(None, i, "z") for i in range(50)], "source_file string, idx int, name string")
    docs = writers.processed_documents(beans, "t").collect()
    assert {d.source_file: [b.name for b in d.coffee_beans] for d in docs if d.source_file} == {"a": ["y", "x"]}
    assert sum(d.beans_found for d in docs if d.source_file is None) == 50 and max(d.beans_found for d in docs if d.source_file is None) == 1


def test_read_documents(spark, tmp_path):
    (tmp_path / "l").mkdir()
    (tmp_path / "l" / "x.json").write_text(json.dumps({
        "discovery_metadata": {"base_url": "https://x.com", "site_name": "x_com", "total_pages_scanned": 4, "timestamp": "t", "crawler_config": {"delay": "0.8"}},
        "discovered_links": [{"url": "https://x.com/a", "discovery_method": "anchor", "status": "keep"}, {"url": "https://x.com/b"}],
        "source_pages": [{"url": "https://x.com", "links_found": 2, "discovery_methods": ["anchor"]}], "failed_urls": ["https://x.com/z"]}, indent=2))
    links = readers.read_links(spark, str(tmp_path / "l")).collect()
    assert [(r.site_name, r.seq, r.url, r.status) for r in links] == [
        ("x_com", 0, "https://x.com/a", "keep"), ("x_com", 1, "https://x.com/b", None)]
    assert {(r.timestamp, r.total_pages_scanned, r.crawler_config["delay"]) for r in links} == {("t", 4, "0.8")}
    assert readers.read_source_pages(spark, str(tmp_path / "l")).first().links_found == 2
    failed = readers.read_failed_urls(spark, str(tmp_path / "l")).collect()
    assert [(r.site_name, r.url) for r in failed] == [("x_com", "https://x.com/z")]

    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "a.json").write_text(json.dumps({"source_file": "a", "coffee_beans": [{"name": "A", "price": 23.0}], "beans_found": 1}, indent=1))
    (tmp_path / "p" / "b.json").write_text(json.dumps({"source_file": "b", "coffee_beans": [], "error": "No text"}))
    docs = {r.source_file: r for r in readers.read_processed(spark, str(tmp_path / "p")).collect()}
    assert (docs["a"].name, docs["a"].beans_found, docs["b"].idx, docs["b"].beans_found, docs["b"].error) == ("A", 1, None, 0, "No text")

    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "1.json").write_text(json.dumps({"phase": "html_scraping", "total_links_in_file": 788, "failed_urls": []}, indent=1))
    (tmp_path / "s" / "2.json").write_text(json.dumps({"base_domain": "x.com", "total_pages": 3, "visited_urls": ["u"]}))
    got = {(r.phase, r.total_links_in_file, r.total_pages) for r in readers.read_summaries(spark, str(tmp_path / "s")).collect()}
    assert got == {("html_scraping", 788, None), (None, None, 3)}


def test_numbering_is_by_site_and_keeps_gaps(spark):
    pages = spark.createDataFrame(
        [(i, f"https://{'big' if i % 10 else 'small'}.com/{i:04d}", "" if i % 7 == 0 else "<p>") for i in range(500)],
        "page_id bigint, url string, html string")
    got = {r.page_id: r.idx for r in writers.page_files(pages).collect()}
    for site in (lambda i: i % 10 == 0, lambda i: i % 10 != 0):
        ids = sorted(i for i in got if site(i))
        assert [got[i] for i in ids] == list(range(len(ids)))
    path = scratch_dir(spark, "test-pages")
    writers.write_pages_by_site(pages, path)
    stored = spark.read.parquet(path)
    assert stored.count() == sum(1 for i in range(500) if i % 7)
    assert stored.select("site_name", "filename").distinct().count() == stored.count()


@pytest.mark.parametrize("files", [1, 3])
def test_stream_gives_each_url_once(spark, files):
    pages = spark.createDataFrame(
        [(i, f"https://x.com/{i}", f"<a href='/same'><a href='/only/{i}'>") for i in range(30)], "page_id bigint, url string, html string")
    base = scratch_dir(spark, "test-stream")
    pages.repartition(files).write.parquet(f"{base}/in")
    for _ in range(2):  # a second start finds nothing new
        stream = ingest.read_page_stream(spark, f"{base}/in", files_per_batch=1)
        ingest.start_link_stream(stream, f"{base}/out", f"{base}/state").awaitTermination()
    got = [r.url for r in spark.read.parquet(f"{base}/out").collect()]
    batch = {r.url for r in L.unique_links(L.extract_links(pages)).collect()}
    assert len(got) == len(set(got)) and set(got) == batch


@pytest.mark.parametrize("order", [1, -1])
def test_link_store_keeps_the_first_occurrence(spark, order, monkeypatch):
    from webcat.operators import links

    monkeypatch.setattr(ingest, "RUNS", 2)
    pages = [(i, "https://x.com/p", "<a href='/same'>" + (f"<script>location.href='/js/{i // 2}'</script>" if i % 2 else f"<a href='/js/{i // 2}'>")) for i in range(6)]
    base = scratch_dir(spark, "test-store")
    for page in pages[::order]:
        spark.createDataFrame([page], ingest.PAGE_SCHEMA).coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = ingest.read_page_stream(spark, f"{base}/in", files_per_batch=1)
        ingest.start_link_store(stream, f"{base}/store", f"{base}/state").awaitTermination()
    got = {(r.url, r.page_id, r.discovery_method) for r in ingest.read_link_store(spark, f"{base}/store").collect()}
    whole = links.unique_links(links.extract_links(spark.createDataFrame(pages, ingest.PAGE_SCHEMA)))
    assert got == {(r.url, r.page_id, r.discovery_method) for r in whole.collect()} and len(got) == 4
    runs = spark.read.parquet(f"{base}/store").select("level", "run").distinct().count()
    assert runs == 2  # six runs, merged by twos: one of level 2 and one of level 1


def test_links_of_a_page_are_not_shuffled(spark):
    from webcat.operators import links
    from webcat.plans.inputs import table

    pages = table(spark, "/root/testdata/sf0.001", "pages")
    plan = links.extract_links(pages)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    plan = links.unique_links(links.extract_links(pages))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_stream_reads_link_headers(spark):
    pages = spark.createDataFrame(
        [(1, "https://x.com/1", "<a href='/a'>", {"Link": '</next>; rel="next"'}, "text/html"), (2, "https://x.com/2", "<a href='/b'>", None, None)],
        "page_id bigint, url string, html string, response_headers map<string, string>, content_type string")
    base = scratch_dir(spark, "test-header-stream")
    pages.write.parquet(f"{base}/in")
    stream = ingest.read_page_stream(spark, f"{base}/in", headers=True)
    ingest.start_link_stream(stream, f"{base}/out", f"{base}/state").awaitTermination()
    got = {r.url: r.discovery_method for r in spark.read.parquet(f"{base}/out").collect()}
    assert got == {"https://x.com/a": "anchor", "https://x.com/b": "anchor", "https://x.com/next": "http_header"}


def test_html_only(spark):
    df = spark.createDataFrame([(1, "<p>", "Text/HTML"), (2, "", "text/html"), (3, "x", "image/png")], "page_id bigint, html string, content_type string")
    assert [r.page_id for r in readers.html_only(df).collect()] == [1]


def test_numbering_moves_rows_once(spark):
    rows = spark.range(5000).select(
        F.when(F.col("id") % 11 == 0, None).when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("é"), F.col("id") % 40)).alias("g"),
        F.when(F.col("id") % 13 > 0, F.col("id") % 97).alias("k"), "id", F.repeat(F.lit("x"), 50).alias("body"))
    numbered = numbered_within(rows, "g", "k", "id")
    want, seen = {}, collections.Counter()
    for r in sorted(rows.collect(), key=lambda r: (r.k is not None, r.k or 0, r.id)):
        want[r.id] = seen[r.g]
        seen[r.g] += 1
    assert {r.id: r.idx for r in numbered.collect()} == want
    plan = numbered._jdf.queryExecution().executedPlan().toString().split("BroadcastExchange")[0]
    assert plan.count("Exchange") == 1
    assert numbered_within(rows.filter("id < 0"), "g", "k").count() == 0


def test_discovery_documents_roll(spark, tmp_path):
    links = spark.createDataFrame(
        [("big", f"https://b/{i:03d}", "https://b", "anchor", i) for i in range(25)] + [("one", "https://o/x", None, None, 0), (None, "u", "p", "css", 0)],
        "site_name string, url string, source_page string, discovery_method string, extra int")
    pages = spark.createDataFrame([("big", "https://b", 25), ("idle", "https://i", 0)], "site_name string, url string, links_found long")
    failed = spark.createDataFrame([("lost", f"f{i}") for i in range(11)], "site_name string, url string")
    meta = spark.createDataFrame([("big", "https://b", {"max_pages": "5"}), ("bare", None, None)],
                                 "site_name string, base_url string, crawler_config map<string,string>")
    docs = writers.discovery_documents(links, pages, failed, meta, roll=10).collect()
    got = {(d.discovery_metadata.site_name, d.discovery_metadata.part): d for d in docs}
    assert set(got) == {("big", 0), ("big", 1), ("big", 2), ("one", 0), (None, 0), ("idle", 0), ("lost", 0), ("lost", 1), ("bare", 0)}
    assert [len(got["big", i].discovered_links) for i in range(3)] == [10, 10, 5]
    assert [len(got["lost", i].failed_urls) for i in range(2)] == [10, 1]
    for part in range(3):
        head = got["big", part].discovery_metadata
        assert (head.total_links_found, head.total_pages_scanned, head.failed_urls_count, head.crawler_config) == (25, 1, 0, {"max_pages": "5"})
    writers.write_discovery(links, pages, failed, meta, str(tmp_path / "d"), roll=10)
    back = readers.read_links(spark, str(tmp_path / "d"), multiline=False).filter("site_name = 'big'").collect()
    assert sorted((r.seq, r.url) for r in back) == [(i, f"https://b/{i:03d}") for i in range(25)]


def test_summary_documents_roll(spark):
    links = spark.createDataFrame([("s", f"u{i:02d}", "https://s/p", "keep" if i < 25 else "skip") for i in range(30)],
                                  "site_name string, url string, source_page string, status string")
    pages = spark.createDataFrame([("u00",), ("u29",)], "url string")
    docs = sorted(writers.summary_documents(links, pages, roll=10, links_file="f").collect(), key=lambda d: d.part)
    assert [u for d in docs for u in d.failed_urls] == [f"u{i:02d}" for i in range(1, 25)]
    assert {(d.phase, d.base_url, d.total_links_in_file, d.filtered_links_count, d.successfully_scraped, d.links_file_used) for d in docs} == {
        ("html_scraping", "https://s", 30, 25, 1, "f")}
