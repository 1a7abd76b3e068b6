import html as stdlib_html
import re

import pytest
from pyspark.sql import functions as F

from webcat.functions import html as H
from webcat.functions.text import decode_entities, squeeze_text
from webcat.operators import content, jsdep, links, structured, tokens
from webcat.plans import product_queries


def rows(df):
    return [tuple(r) for r in df.collect()]


# --- tokens and spans --------------------------------------------------------------------------

def walk(html_tokens):
    """Plain stack walk over (kind, tag, token) rows: the definition of a span."""
    void = set(H.VOID_TAGS)
    stack, spans = [], []
    for i, (kind, tag, token) in enumerate(html_tokens):
        if kind == "open":
            if tag in void or token.endswith("/>"):
                spans.append((i, i, tag))
            else:
                stack.append((i, tag))
        elif kind == "close" and any(t == tag for _, t in stack):
            while True:
                pos, top = stack.pop()
                spans.append((pos, i, top))
                if top == tag:
                    break
    spans += [(pos, len(html_tokens), tag) for pos, tag in stack]
    return sorted(spans)


@pytest.mark.parametrize("html", [
    "<div><p>a<b>b</b><br><p>c</p></div>",
    "<div0><section><div><div></div></section></div></i>x",
    "<b><i>x</b>y</i><i>z</i></p></p><p>",
    "<i><b><i></b></i>t",
    "<ul><li>a<li>b<ul><li>c</ul><li>d</ul><hr/></br>",
    "<!-- <p> --><script>'<p>'</script><style>p{}</style><p title='a>b'>5 < 6 <",
    "no tags at all",
    "<a title=\"open><b>x</b>",
])
def test_spans_follow_the_stack_walk(page, html):
    df = page(html)
    toks = [(r.kind, r.tag, r.token) for r in tokens.page_tokens(df).orderBy("pos").collect()]
    got = df.select(H.page(F.col("html"))["spans"].alias("s")).first()["s"]
    assert [tuple(s) for s in got] == walk(toks)
    assert "".join(t for _, _, t in toks) == html or "<" in html


@pytest.mark.parametrize("closing", [0.02, 0.3, 0.6])
def test_spans_of_deep_pages_follow_the_stack_walk(page, closing):
    import random

    rng = random.Random(closing)
    names = ["li", "p", "div", "span", "td"]
    htmls = []
    for size in (63, 64, 65, 130, 1500):
        parts = [f"</{rng.choice([*names, 'x'])}>" if rng.random() < closing else f"<{rng.choice(names)}>" for _ in range(size)]
        htmls += ["".join(parts), "<ul>" + "<li>" * size + "</b></ul>" + "".join(parts), "<x>" * size + "</x>" * size]
    df = page(*htmls)
    toks = {}
    for r in tokens.page_tokens(df).orderBy("page_id", "pos").collect():
        toks.setdefault(r.page_id, []).append((r.kind, r.tag, r.token))
    for r in df.select("page_id", H.page(F.col("html"))["spans"].alias("s")).collect():
        assert [tuple(s) for s in r["s"]] == walk(toks[r.page_id])


def test_unclosed_items_cost_their_number(spark):
    import time

    def seconds(n, copies):
        html = "<ul>" + "<li><a href='/x'>y" * (n // 2) + "</b>" * (n // 8) + "</ul>"
        df = spark.createDataFrame([(i, html) for i in range(copies)], "page_id long, html string").repartition(8)
        best = 1e9
        for _ in range(3):
            start = time.perf_counter()
            df.select(F.size(H.page(F.col("html"))["spans"]).alias("n")).agg(F.sum("n")).collect()
            best = min(best, time.perf_counter() - start)
        return best

    seconds(100, 8)
    few, many = seconds(2000, 8), seconds(16000, 8)
    assert many < 8 * few * 1.6  # eight times the tags


def test_ranks_count_positions_inside(spark):
    import random

    rng = random.Random(1)
    cases = [([], 0), ([], 5), ([0], 1), ([5], 5), ([2, 2, 2], 4), *[(sorted(rng.randrange(41) for _ in range(rng.randrange(30))), 40) for _ in range(20)]]
    df = spark.createDataFrame([(i, p, n) for i, (p, n) in enumerate(cases)], "i int, p array<int>, n int")
    for r in df.select("i", H.ranks(F.col("p"), F.col("n")).alias("r")).collect():
        positions, n = cases[r["i"]]
        assert r["r"] == [sum(p < t for p in positions) for t in range(n + 1)]


def test_tokens(page):
    found = rows(tokens.page_tokens(page("<!DOCTYPE html><P class='x>y'>a &lt; 5 < 6</P><script>var t='</p>'</script><!-- c -->")))
    assert [(r[2], r[3]) for r in found] == [
        ("decl", None), ("open", "p"), ("text", None), ("close", "p"), ("script", "script"), ("comment", None)]


def test_element_text(page):
    found = rows(tokens.element_text(page("<article><p>a<b>b</b><br><p>c</p></article>"), ["p"]))
    assert [(r[1], r[3]) for r in found] == [(1, "abc"), (7, "c")]


def test_attributes(page):
    el = tokens.page_elements(page("<a HREF='/x?a=1&amp;b=2' data-x=y checked title=\"it's\" data-x=z>t</a>")).first()
    assert el.attrs == {"href": "/x?a=1&b=2", "data-x": "z", "checked": "", "title": "it's"}


def test_many_stray_brackets_do_not_overflow(page):
    text = "a <3 " * 20000
    assert tokens.page_tokens(page(f"<p {'x=\"1\" ' * 20000}>{text}</p>")).count() == 3


@pytest.mark.parametrize("text", [
    "a &amp;lt; b", "&eacute;&#233;&#xE9;&#X1F600;", "&nbsp;&copy;&middot;&quot;&apos;&#39;", "&hellip;&euro;&alpha;", "x & y &;",
])
def test_decode_entities(value, text):
    assert value(decode_entities(F.lit(text))) == stdlib_html.unescape(text)


def test_unknown_entities_stay(value):
    assert value(decode_entities(F.lit("&nosuch; &#0; &#99999999;"))) == "&nosuch; &#0; &#99999999;"


# --- links -------------------------------------------------------------------------------------

def urls_of(df):
    return {(r.url, r.discovery_method) for r in df.collect()}


def test_anchor_links(page):
    hrefs = "".join(f'<a href="{h}">x</a>' for h in ["#x", "mailto:a@b", "tel:1", " ", "/ok", "https://y.com/e"])
    assert urls_of(links.links_by_method(page(hrefs), "anchor")) == {("https://www.x.com/ok", "anchor")}


def test_external_links_when_asked_for(page):
    profile = links.with_options(links.PROFILES["default"], follow_external=True)
    found = links.links_by_method(page('<a href="https://y.com/e">'), "anchor", profile).collect()
    assert [(r.url, r.link_type) for r in found] == [("https://y.com/e", "external")]


def test_first_method_wins(page):
    df = page('<link rel="canonical" href="/same"><a href="/same">x</a><area href="/same">')
    assert urls_of(links.extract_links(df)) == {("https://www.x.com/same", "anchor")}


def test_json_ld_links(page):
    body = '{"url":"/a","sameAs":["/b"],"x":{"logo":"https:\\/\\/www.x.com\\/c"},"t":"\\"url\\":\\"/d\\"","image":"rel"}'
    df = page(f'<script type="application/ld+json">{body}</script>', '<script type="application/ld+json">{"url":"/z"</script>')
    assert urls_of(links.links_by_method(df, "json_ld")) == {
        ("https://www.x.com/a", "json_ld"), ("https://www.x.com/c", "json_ld")}


def test_json_ld_links_of_repeated_keys_and_nan(page):
    df = page(
        '<script type="application/ld+json">{"url":"/old","x":{"logo":"/l1","logo":"/l2"},"image":"/i","url":"/new"}</script>',
        '<script type="application/ld+json">{"price":NaN,"url":"/n"}</script>')
    assert urls_of(links.links_by_method(df, "json_ld")) == {
        (f"https://www.x.com/{x}", "json_ld") for x in ("l2", "i", "new", "n")}


def test_script_links_ignore_the_script_tag(page):
    df = page('<script src="/lib/main">location.assign( "/go/1" ); fetch("/api/x"); x = "/a/b/a"</script>'
              "<button onclick=\"open('sub/e.html?x=1')\">")
    assert urls_of(links.links_by_method(df, "javascript")) == {
        ("https://www.x.com/go/1", "javascript"), ("https://www.x.com/api/x", "javascript"),
        ("https://www.x.com/p/sub/e.html?x=1", "javascript")}


def test_comment_links(page):
    assert urls_of(links.links_by_method(page("<!-- see /old and https://www.x.com/older -->"), "comment")) == {
        ("https://www.x.com/old", "comment"), ("https://www.x.com/older", "comment")}


def test_header_links(page):
    df = page("<p>", response_headers={"Link": '</n>; rel="next", </s>; rel=stylesheet, <https://www.x.com/c>; rel=canonical'})
    assert urls_of(links.links_by_method(df, "http_header")) == {
        ("https://www.x.com/n", "http_header"), ("https://www.x.com/c", "http_header")}


def test_profiles(page):
    html = "<style>a{background:url(/css/)}</style><a href='/a/?b=1&a=2#f'>"
    default = urls_of(links.extract_links(page(html)))
    conservative = urls_of(links.extract_links(page(html), links.PROFILES["conservative"]))
    assert default == {("https://www.x.com/css/", "css"), ("https://www.x.com/a/?b=1&a=2#f", "anchor")}
    assert conservative == {("https://www.x.com/a?a=2&b=1", "anchor")}


def test_profiles_together(page):
    html = ("<a href='/a?x=1&a=2#f'>1</a><a href='/a?a=2&x=1'>2</a><a href='/pic.png'>3</a><a href='/clip.mp4'>4</a>"
            "<a href='https://other.com/e'>5</a><style>.x{background:url('/bg/1/')}</style><script>fetch('/api/v1/list.php')</script>"
            "<div itemscope itemid='/md/1'></div><!-- see /cmt/9 -->")
    profiles = links.PROFILES | {
        "abroad": links.with_options(links.PROFILES["site"], follow_external=True, normalize=True, blocked_extensions=(".php",))}
    pages = page(html, html, "", None, response_headers={"Link": '</h/1>; rel="next"'})
    together = links.extract_links_by_profile(pages, profiles)
    for name, profile in profiles.items():
        alone = sorted(links.extract_links(pages, profile).collect())
        assert alone and sorted(together.filter(F.col("profile") == name).drop("profile").collect()) == alone


def test_links_by_profile_reads_pages_once(spark, tmp_path):
    spark.createDataFrame(
        [(k, f"part {k}", "Brand#1", "TYPE", 900.5 + k) for k in range(1, 9)],
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_retailprice double",
    ).write.parquet(str(tmp_path / "part.parquet"))
    plan = product_queries.QUERIES["links_by_profile"](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1

def test_unique_links_and_stats(spark, page):
    df = page("<title>one</title><a href='/same'><a href='/b'>", "<a href='/same'>", "").withColumn(
        "url", F.concat(F.lit("https://www.x.com/"), F.col("page_id")))
    found = links.extract_links(df)
    assert found.groupBy("page_id", "url").count().filter("count > 1").count() == 0
    assert {(r.url, r.page_id) for r in links.unique_links(found).collect()} == {
        ("https://www.x.com/same", 0), ("https://www.x.com/b", 0)}
    stats = {r.page_id: r for r in links.source_page_stats(df, found).collect()}
    assert (stats[0].links_found, stats[0].title, stats[0].discovery_methods) == (2, "one", ["anchor"])
    assert (stats[2].links_found, stats[2].title, stats[2].fetch_status) == (0, "Failed to fetch", "failed")


# --- text --------------------------------------------------------------------------------------

def test_clean_text(page):
    df = page("<nav>n</nav><p>a</p><p>b  c</p><footer>f</footer>", "<p> x\n\n y\t\tz </p>")
    assert [r[1] for r in rows(content.clean_text(df).orderBy("page_id"))] == ["ab c", "x y\t\tz"]


def test_full_text_keeps_navigation(page):
    assert rows(content.full_text(page("<nav>n</nav><style>s</style><p>a&nbsp;b</p>"))) == [(0, "na b")]


def test_title(page):
    df = page("<!-- <title>old</title> --><title> A &amp; B </title><title>2</title>", "<p>none</p>")
    assert [r[1] for r in rows(content.titles(df).orderBy("page_id"))] == ["A & B", ""]


def test_extraction_text_is_cut(page):
    df = page("<meta name=description content='short one'><p>" + "x" * 60000 + "</p>", "<p>small</p>")
    long, small = [r[1] for r in rows(content.extraction_text(df).orderBy("page_id"))]
    assert long.startswith("META DESCRIPTION: short one\n\nFULL PAGE CONTENT:\nxxx")
    assert long.endswith("x...") and len(long) <= 50000
    assert small == "\n\nFULL PAGE CONTENT:\nsmall"


def test_extraction_text_without_room(page):
    text = "coffee " * 9000
    out = content.extraction_text(page(f"<div class='description'>{text}</div>")).first().text
    assert out == "PRODUCT DESCRIPTION: " + text.strip() + "..."


def test_description_repeats_per_selector(page):
    text = "A coffee with notes of cocoa, cherry and a long finish."
    df = page(f"<div class='product-description' id='description'>{text}</div><div class='prose'><p>{text}</p></div>")
    assert [r[1:3] for r in rows(content.description_sections(df))] == [
        (0, "PRODUCT DESCRIPTION"), (1, "PRODUCT DESCRIPTION"), (2, "PRODUCT DESCRIPTION"), (3, "PRODUCT DESCRIPTION")]


def test_keywords(page):
    df = page("<p>Fresh COFFEE</p>", "<title>Coffee</title>", "<nav>coffee</nav>")
    assert {r.page_id for r in content.pages_with_keywords(df, ["coffee"]).collect()} == {0, 1}


# --- JavaScript --------------------------------------------------------------------------------

def score(df, **options):
    return jsdep.js_scores(jsdep.js_features(df), **options).first()


def test_noscript_and_empty_root(page):
    r = score(page("<body><noscript>Please enable JavaScript</noscript><div id='root'></div></body>"))
    assert (r.noscript, r.minimal_content, r.spa_root, r.score, r.confidence, r.js_dependent) == (True, True, True, 95, "high", True)


def test_root_pattern_is_matched_on_id(page):
    words = "word " * 120
    assert score(page(f"<body><div class='root'></div><p>{words}</p></body>")).spa_root is False
    assert score(page(f"<body><div id='root'></div><p>{words}</p></body>")).spa_root is True


def test_static_page(page):
    r = score(page("<meta name='description' content='" + "d" * 60 + "'><body><article>" + "word " * 150
                   + "</article><ul>" + "<a href='/x'>x</a>" * 5 + "</ul><form></form></body>"))
    assert (r.score, r.confidence, r.js_dependent) == (-35, "low", False)


def test_thresholds(page):
    html = "<body><p>few</p><script src='/_next/x.js'></script></body>"  # 35 + 25
    assert score(page(html)).confidence == "high"
    assert score(page(html), strict=True).confidence == "medium"
    assert score(page("<body><p>few</p></body>")).confidence == "medium"  # 35 with minimal content


def test_heavy_scripts(page):
    words = "<p>" + "word " * 120 + "</p>"
    assert score(page("<body>" + words + "<script>" + "x" * 50001 + "</script></body>")).heavy_js
    assert score(page("<body>" + words + "<script>" + "x" * 2000 + "</script>" * 1 + ("<script>" + "y" * 2000 + "</script>") * 5 + "</body>")).heavy_js
    assert score(page("<body>" + words + "<script src='a'></script>" * 11 + "</body>")).heavy_js
    assert not score(page("<body>" + words + "<script src='a'></script>" * 10 + "</body>")).heavy_js


# --- structured data ---------------------------------------------------------------------------

def ld(body):
    return f'<script type="application/ld+json"> {body} </script>'


def test_json_ld_items(page):
    df = page(ld('{"@type":"A"}'), ld('[{"@type":"B"},{"@type":"C"}]'), ld("42"), ld("{broken"))
    found = structured.json_ld_items(df).groupBy("page_id").count().collect()
    assert {(r.page_id, r["count"]) for r in found} == {(0, 1), (1, 2)}


def test_json_ld_items_of_repeated_keys_and_nan(page):
    df = page(ld('{"@type":"A","@type":"B","x":{"y":1,"y":2}}'), ld('[{"@type":"C","p":NaN},{"n":-Infinity,"n":3}]'), ld('{"p":NaN'),
              ld("NaN"), ld("{'@type':'D'}"))
    found = {(r.page_id, r.item_no): (r.type, r.item) for r in structured.json_ld_items(df).collect()}
    assert found == {(0, 0): ("B", '{"@type":"B","x":{"y":2}}'), (1, 0): ("C", '{"@type":"C","p":"NaN"}'), (1, 1): (None, '{"n":3}')}
    rows = {r.page_id: r for r in structured.structured_data(df).collect()}
    assert [len(rows[i].json_ld) for i in range(5)] == [1, 2, 0, 0, 0]


def test_microdata(page):
    df = page("<div itemscope itemtype='T'><span itemprop=n>a <b>b</b></span><meta itemprop=n content=c><time itemprop=d>x</time>"
              "<div itemscope><i itemprop=in>i</i></div></div><div itemscope></div>")
    got = {(r.item_no, r.prop, tuple(r["values"])) for r in structured.microdata_items(df).collect()}
    assert got == {(0, "n", ("ab", "c")), (0, "d", ("x",)), (0, "in", ("i",)), (1, "in", ("i",))}


def test_meta_and_opengraph(page):
    df = page("<meta name=description content=''><meta name=description content=late><meta name=keywords content=k>"
              "<meta property=og:title content=a><meta property='og:title' content=b><meta property=og:x content=''>")
    assert rows(structured.meta_tags(df)) == [(0, "keywords", "k")]
    assert rows(structured.opengraph(df)) == [(0, "title", "b")]


@pytest.mark.parametrize("text,expected", [
    ("$23.00", 23.0), ("from 5", 5.0), ("$1,200.50", 1200.5), ("n/a", None), ("1,2345", 1.0), ("$1,234,567", 1234567.0),
])
def test_parse_price(value, text, expected):
    assert value(structured.parse_price(F.lit(text))) == expected


def test_fallback_products(page):
    df = page("<div class='menu-item'><h2>Latte</h2><span>was $4.50</span><p>Short</p></div>"
              "<div class='product'><h1> </h1></div><div class='product'><p>no name</p></div>")
    got = [(r.selector, r.name, r.price, r.currency, r.description) for r in structured.fallback_products(df).collect()]
    assert sorted(got) == [(1, "Latte", 4.5, "USD", None), (2, "Latte", 4.5, "USD", None)]


def test_only_the_first_matching_price_element_counts(page):
    df = page("<div class='product'><h2>A</h2><span class='price'>ask us</span><span>$9</span></div>")
    assert structured.fallback_products(df).first().price is None


def test_organization(page):
    df = page("<title>Shop</title><div class='contact'>555-123-4567</div><div class='address'>Short</div>"
              "<div class='address'>1 Market Street</div><div class='phone'>call</div>", "<p>nothing</p>")
    assert rows(structured.organization_info(df)) == [(0, "Shop", "call", "1 Market Street")]


def test_structured_data_methods(page):
    df = page("<p>nothing</p>", intercepted_json_ld=['{"a":1}'])
    r = structured.structured_data(df).first()
    assert (r.json_ld, r.extraction_methods, r.organization) == (['{"a":1}'], ["intercepted_json_ld"], None)


def test_entities_are_decoded_once(value):
    from pyspark.sql import functions as F

    from webcat.functions.text import decode_entities

    cases = {"&#38;amp;": "&amp;", "&#38;#60; &#60;": "&#60; <", "&#146;&#x80;": "\u2019\u20ac", "&amp;lt;": "&lt;",
             "&eacute;&nope; & x;": "\u00e9&nope; & x;", "&#0;&#1114112;": "&#0;&#1114112;", "a&b": "a&b"}
    for text, want in cases.items():
        assert value(decode_entities(F.col("t")), t=text) == want


def test_structured_data_takes_a_page_apart_once(page):
    df = structured.structured_data(page("<meta name='keywords' content='k'><script type='application/ld+json'>{\"a\":1}</script>"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(html") == 1
    assert (df.first().json_ld, df.first().meta_tags) == (['{"a":1}'], {"keywords": "k"})


# --- work that follows the page, not the file it is in ------------------------------------------

def test_pages_of_a_small_file_are_dealt_over_the_tasks(spark):
    from webcat.plans.inputs import product_pages

    before = spark.conf.get("webcat.input.partitions")
    spark.conf.unset("webcat.input.partitions")
    try:
        pages = product_pages(spark, "/root/testdata/sf0.001")
        assert pages.rdd.getNumPartitions() >= int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert pages.groupBy(F.spark_partition_id()).count().count() > 1
    finally:
        spark.conf.set("webcat.input.partitions", before)


@pytest.mark.parametrize("method, kept", [("css", 2), ("comment", 1), ("meta", 1), ("json_ld", 1), ("area", 0)])
def test_a_method_takes_only_its_own_tokens_apart(page, method, kept):
    html = "<style>a{}</style><p style='b:c'>x</p><!-- /d --><link rel=next href=e><script>f()</script><a href=g>h</a>"
    found = page(html).select(F.size(links._tokens_of_interest(F.col("html"), [method])).alias("n"))
    assert found.first()["n"] == kept


@pytest.mark.parametrize("html, walked", [
    ("<div><p>a</p><p>b<i>c</i></p><br></div>", 0), ("<ul><li>a<li>b</ul><p>c</p>", 4), ("<a><b></a></b><i></i>", 4),
    ("<a><b><c><d><e></e></d></c></b></a>", 4), ("</a><b>", 2),
])
def test_only_what_the_leaves_leave_is_walked(page, monkeypatch, html, walked):
    monkeypatch.setattr(H, "_walk", lambda left, n: F.transform(left, lambda e: F.struct(
        F.lit(-1).alias("pos"), e["pos"].alias("end_pos"), e["tag"].alias("tag"))))
    spans = H.element_spans(F.col("toks"))
    df = page(html).select(H.classified(H.tokens(F.col("html"))).alias("toks"))
    assert sum(s["pos"] == -1 for s in df.select(spans.alias("s")).first()["s"]) == walked


def test_classified_tokens_are_those_of_each_token(spark):
    odd = ["a > b", "<", "<>", "< a>", "<!-- x -->", "<!doctype html>", "<?x?>", "</>", "</ a>", "</A b>", "<A/>", "<p", "</p", "<scripty>",
           "<script>x</script>", "<SCRIPT src=a>", "<style-x>", "<style", "<\u212a x>", "<\u0130>", "<a\nb='>'>", "", "<!-->", "<1>"]
    df = spark.createDataFrame([(odd,)], "t array<string>").select(F.explode(H.classified(F.col("t"))).alias("c")).select("c.*")
    kind = H.token_kind(F.col("token"))
    rows = df.select("kind", "tag", kind.alias("k"), H.token_tag(F.col("token"), kind).alias("g"), "token").collect()
    assert [r.token for r in rows] == odd
    assert [(r.kind, r.tag) for r in rows] == [(r.k, r.g) for r in rows]


def test_attributes_of_odd_tags(spark):
    body = r"""[^\s"'<>/=]+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+))?"""
    odd = [" a=b", " a = \"x'y\" c", " a='x\"y'd=e", " a=\"\" b=''", " a=\"open b=c", " a=b\"c\" d", " a= b=c=d", " =x y", " a/b=c/d", " A=1 a=2 B",
           " a='&amp;x' b=&lt;", " a=\n'b\nc'", "/", " a=\"b\"\"c\"", " a='b\"c", " a=/x/y?z=1"]
    def plain(text):
        found = {}
        for part in re.findall(body, text):
            name, _, value = part.partition("=")
            value = value.strip() if _ else ""
            found.pop(name.strip().lower(), None)
            found[name.strip().lower()] = value[1:-1] if value[:1] in ("'", '"') else value
        return [(n, v.replace("&amp;", "&").replace("&lt;", "<")) for n, v in found.items()]
    df = spark.createDataFrame([(t,) for t in odd], "t string").coalesce(1)
    got = df.select(H.attributes(F.concat(F.lit("<x"), "t", F.lit(">"))).alias("a")).collect()
    cut = [t for t in odd if t.count('"') % 2 or t.count("'") % 2]
    for text, row in zip(odd, got):
        if text not in cut:
            assert [(a["name"], a["value"]) for a in row["a"]] == plain(text), text
    assert [len(r["a"]) for r in df.select(H.attributes(F.lit("<x>")).alias("a")).collect()] == [0] * len(odd)


def test_only_tags_with_a_wanted_name_are_taken_apart(page):
    html = '<div CLASS="a"><p id="b" title="c"></p><i data-class="d">x</i></div>'
    found = H.with_page(F.col("html"), lambda p: p["elements"], attrs=True, names=["class"])
    elements = page(html).select(found.alias("e")).first()["e"]
    assert [[(a.name, a.value) for a in e.attrs] for e in elements] == [[("class", "a")], [], [("data-class", "d")]]


def test_squeezed_text_cuts_at_every_break_without_translating(value):
    text = "a\x0bb   c  d \r\n    e  f\x85\x85g h\x1e "
    assert value(squeeze_text(F.col("t")), t=text) == "a b c d e f g h"
    assert "translate" not in str(squeeze_text(F.col("t")))


def test_empty_containers_are_looked_for_on_pages_of_few_words_only(page):
    few, many = "word " * 40, "word " * 120
    hollow = '<div class="content"><i></i></div>'
    full = '<div class="content"><i>x</i></div>'
    shells = [f"<html><body>{words}{part}</body></html>" for words in (few, many) for part in (hollow, full)]
    markup = "<html><body>" + "word " * 20 + '<p class="' + "x" * 3000 + '"></p></body></html>'
    rows = jsdep.js_features(page(*shells, markup, "<p>no body")).orderBy("page_id").collect()
    assert [r["minimal_content"] for r in rows] == [True, False, False, False, True, True]


def test_size_and_ranks_are_worked_out_below_a_bound_of_words(page):
    plan = jsdep.js_features(page("<body></body>"))._jdf.queryExecution().analyzed().toString()
    assert "body_size, CASE WHEN" in plan and "empty_container, CASE WHEN" in plan
