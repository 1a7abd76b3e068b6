"""Inputs of the registered queries: the given tables, and what Spark derives from them.

The given pages hold anchors, text and little else. Richer inputs are written out row by row from the
``part`` table: one product page and one payload per part, so they grow with it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webcat.schemas import conform


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Deal the rows anew if the session asks for it with ``webcat.input.partitions``; else as they are read.

    A file of one row group is read by one task however many cores there are, so benchmarks on small files set it.
    """
    wanted = df.sparkSession.conf.get("webcat.input.partitions", None)
    return df.repartition(int(wanted), key) if wanted else df


def dealt(df: DataFrame, key: str) -> DataFrame:
    """Narrow rows from which much is made, dealt anew in any session.

    A small file of many rows is read by one task or two, which would do all the work on them. The number is given, as
    adaptive execution would join small partitions again, and no key is, as it may repeat.
    """
    spark = df.sparkSession
    if spark.conf.get("webcat.input.partitions", None):
        return spread(df, key)
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism))


def given_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "pages"), "page_id")


def _fill(template: str, values: dict[str, Column]) -> Column:
    """Template with [name] slots -> one concatenated string column."""
    pieces = re.split(r"\[([a-z]+)\]", template)
    return F.concat(*[values[p] if i % 2 else F.lit(p) for i, p in enumerate(pieces)])


def _when(condition: Column, text: Column) -> Column:
    return F.when(condition, text).otherwise("")


FILLER = " ".join(f"word{i}" for i in range(40))


def product_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One product page per part: (page_id, url, html, response_headers, content_type, rendering_method).

    Every seventh page is an empty shell that needs JavaScript; the others show the product.
    """
    part = dealt(
        table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_retailprice"), "p_partkey"
    )
    k = F.col("p_partkey")
    cents = F.round(F.col("p_retailprice") * 100).cast("long")
    whole, fraction = (cents / 100).cast("long"), F.lpad((cents % 100).cast("string"), 2, "0")
    with_commas = F.when(
        whole >= 1000,
        F.concat((whole / 1000).cast("long").cast("string"), F.lit(","), F.lpad((whole % 1000).cast("string"), 3, "0")),
    ).otherwise(whole.cast("string"))
    v: dict[str, Column] = {
        "k": k.cast("string"),
        "nm": F.col("p_name"),
        "br": F.col("p_brand"),
        "ty": F.col("p_type"),
        "host": F.concat(F.lit("www.shop"), (k % 7).cast("string"), F.lit(".example.com")),
        "price": F.concat(F.lit("$"), with_commas, F.lit("."), fraction),
        "tel": F.lpad((k % 10000).cast("string"), 4, "0"),
        "filler": F.lit(FILLER),
    }
    v["desc"] = F.when(k % 3 == 0, _fill("Plain [nm].", v)).otherwise(
        _fill("A [nm] of brand [br], with notes of cocoa and a clean finish.", v)
    )

    def t(template: str) -> Column:
        return _fill(template, v)

    json_ld = (
        F.when(k % 11 == 0, t('{"url": "/ld/[k]"'))
        .when(k % 11 == 1, F.lit("42"))
        .when(k % 9 == 0, t('[{"@type":"Product","url":"/ld/[k]"},{"@type":"Offer","sameAs":["/no/[k]"]}]'))
        .otherwise(t(
            '{"@type":"Product","name":"say \\"url\\": \\"/fake\\"","url":"/ld/[k]",'
            '"brand":{"logo":"https:\\/\\/[host]\\/logo\\/[k]"}}'
        ))
    )
    variant = [
        '/cat/[k]', 'item[k].html', '../up/[k]', '//cdn.example.com/[k]', '[host]/w/[k]', '?ref=[k]',
        'https://[host]/abs/[k]?b=2&amp;a=1#f', '/x/[host]/dup/[k]',
    ]
    href = F.element_at(F.array(*[t(h) for h in variant]), (k % 8).cast("int") + 1)
    head = F.concat(
        t("<!DOCTYPE html><html><head><title>[nm] &amp; more [k]</title>"),
        _when(k % 2 == 0, t('<meta name="description" content="[desc]">')),
        t('<meta name="keywords" content="[br],[ty]"><meta name="author" content="">'
          '<meta property="og:title" content="[nm]">'),
        _when(k % 5 == 0, t('<meta property="og:title" content="[nm] again">')),
        _when(k % 3 == 1, t('<meta property="og:description" content="og [nm] text">'
                            "<meta name='twitter:description' content='tw [k]'>")),
        t('<link rel="canonical" href="/p/[k]"><link rel=next href="../n/[k]/"><link rel="stylesheet" href="/s.css">'),
        _when(k % 6 == 0, t('<meta http-equiv="refresh" content="5; url=/r/[k]">')),
        t("<style>.a{background:url('/bg/[k]/')} .b{background:url(/img/x.png)}</style>"
          "<script>window.location = \"/js/[k]/go\"; var A=\"MAX_SIZE\"; load(\"/a/b/a\");"
          " fetch('/api/[k]/list.php')</script>"),
        F.lit('<script type="application/ld+json">'), json_ld, F.lit("</script></head>"),
    )
    shell = t(
        '<body><noscript>Please enable JavaScript</noscript><div id="root"></div>'
        '<script src="/static/react.min.js"></script></body></html>'
    )
    product = F.concat(
        F.lit('<main><div class="product card" itemscope itemtype="http://schema.org/Product"'),
        _when(k % 2 == 1, t(' data-product="[k]"')),
        t('><h2 class="name" itemprop="name">[nm] [k]</h2><span class="price" itemprop="price">[price]</span>'
          '<p class="description" itemprop="description">[desc]</p><meta itemprop="sku" content="S[k]">'
          '<a itemprop="url" href="/md/[k]">more</a><img itemprop="image" src="/im/[k].png">'
          '<time itemprop="releaseDate" datetime="2024-01-01">Jan</time>'
          '<span itemprop="tag">t1</span><span itemprop="tag">t2</span></div></main>'),
    )
    shown = F.concat(
        F.lit('<body><nav><a href="'), href,
        t('">go</a><a href="#x">x</a><a href="mailto:a@b.c">m</a><a href="tel:1">t</a><a href=" ">b</a>'
          '<a href="/doc/[k].pdf">d</a></nav>'),
        product,
        t('<map><area href="/area/[k]"></map><form action="/search?q=[k]"></form>'
          '<div data-url="/data/[k]" data-target="#no" style="background: url(/sa/[k]/)"></div>'
          '<button onclick="go(\'/evt/[k].html\')" aria-label="see https://[host]/aria/[k] now">b</button>'
          "<!-- old: /cmt/[k] --><p>[filler]</p>"),
        _when(k % 4 == 1, t("<article>[desc] [desc] [desc] [desc] [desc] [filler]</article>")),
        _when(k % 4 == 2, t('<div class="prose"><p>[desc]</p></div>')),
        _when(k % 10 == 3, F.lit('<div class="big Spinner"></div>')),
        _when(k % 10 == 4, F.lit('<a href="#/route">r</a>')),
        _when(k % 10 == 5, F.lit('<section class="content"></section>')),
        t('<div class="contact">Call 555-123-[tel]</div><div class="address">[k] Market Street, Town</div></body></html>'),
    )
    return part.select(
        k.alias("page_id"),
        t("https://[host]/p/[k]").alias("url"),
        F.concat(head, F.when(k % 7 == 0, shell).otherwise(shown)).alias("html"),
        F.create_map(F.lit("Link"), t('</h/[k]>; rel="next", </skip/[k]>; rel="preload"')).alias("response_headers"),
        F.when(k % 13 == 0, "application/pdf").otherwise("Text/HTML; charset=utf-8").alias("content_type"),
        F.when(k % 7 == 0, "dynamic").when(k % 5 != 0, "static").alias("rendering_method"),
    )


ROASTS = ["Light", "CITY+", " Vienna ", "medium-light", "Omni", "", "EXTRA_DARK", "full city"]
GRINDS = ["Whole Bean", "pre-ground", "FINE", "beans", "Moka"]
PROCESSES = ["Washed", "sun-dried", "Giling Basah", "Anaerobic", "semi-washed", "pulped natural"]
BEAN_TYPES = ["Coffea Arabica", "ROBUSTA", "excelsa", "Hybrid"]
BREWS = ["V60", "Siphon", "drip", "French-Press", "Aero Press", "OTHER"]


def pick(values: list[str], index: Column) -> Column:
    """Value number ``index`` modulo the length of the list."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values)).cast("int") + 1)


def bean_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One extraction result per part: (source_file, payload); some broken, some not a list, some of two beans."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size", "p_retailprice")
    k = F.col("p_partkey")

    def bean(n: int) -> Column:
        text = F.concat(F.lit("Tasting notes for "), F.col("p_name"), F.lit(" of "), F.col("p_brand"))
        return F.struct(
            F.concat(F.col("p_name"), F.lit(f" {n}")).alias("name"),
            F.lit("250g").alias("weight"),
            F.when(k % 19 != 0, F.col("p_retailprice")).alias("price"),
            F.when(k % 4 == 0, "XYZ").otherwise("USD").alias("currency"),
            F.when(k % 13 == 0, F.lit(None)).when(k % 13 == 1, "short").when(k % 13 == 2, " ").otherwise(text)
            .alias("description"),
            F.col("p_brand").alias("producer"),
            F.lit("Huila").alias("region"),
            pick(ROASTS, k + n).alias("roast_level"),
            F.array(F.lit("floral"), F.lit("citrus")).alias("flavor_notes"),
            pick(GRINDS, k + n).alias("grind_type"),
            F.lit("La Pelota").alias("farm"),
            (F.col("p_size") * 50).alias("altitude"),
            pick(PROCESSES, k + n).alias("process"),
            F.when(k % 3 == 0, pick(BREWS, k).isNull().cast("int")).alias("agtron_roast_level"),
            F.when(k % 5 == 0, F.array().cast("array<string>"))
            .otherwise(F.array(pick(BREWS, k), F.lit(None), pick(BREWS, k + 1))).alias("suitable_brew_types"),
            pick(BEAN_TYPES, k + n).alias("bean_type"),
            F.lit("Geisha").alias("variety"),
        )

    beans = F.when(k % 2 == 0, F.array(bean(0), bean(1))).otherwise(F.array(bean(0)))
    payload = (
        F.when(k % 11 == 0, "[{\"name\": \"cut off")
        .when(k % 17 == 0, F.to_json(bean(0)))
        .otherwise(F.to_json(beans, {"ignoreNullFields": "false"}))
    )
    return part.select(F.concat(F.lit("part_"), k.cast("string"), F.lit(".html")).alias("source_file"), payload.alias("payload"))


CATEGORIES = ["COFFEE", "TEA", "FOOD", "brunch"]


def menu_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One menu result per supplier: (source_file, payload)."""
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    k = F.col("s_suppkey")
    entry = F.struct(
        F.col("s_name").alias("name"), F.lit("$4.50").alias("price"), F.lit("").alias("description"),
        F.when(k % 6 != 0, pick(CATEGORIES, k)).alias("category"),
        F.array(F.lit("8oz"), F.lit("12oz")).alias("size_options"), F.array(F.lit("milk")).alias("dietary_notes"),
    )
    payload = F.when(k % 7 == 0, F.to_json(entry)).otherwise(F.to_json(F.array(entry), {"ignoreNullFields": "false"}))
    return supplier.select(F.concat(F.lit("menu_"), k.cast("string")).alias("source_file"), payload.alias("payload"))


ROAST_LEVELS = ["light", "medium_light", "medium", "medium_dark", "dark", "extra_dark", "no_preference"]
PROCESS_NAMES = ["natural", "washed", "honey"]
FLAVORS = ["chocolate_nutty", "fruity_bright", "caramel_sweet", "earthy_spicy"]


def catalog(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The star schema read as the twelve catalog tables."""
    def t(name: str) -> DataFrame:
        return table(spark, sf_dir, name)

    c = F.col
    part, supplier, customer = t("part"), t("supplier"), t("customer")
    lineitem = t("lineitem")
    shops = supplier.agg(F.count("*").alias("n"))  # one number, used as a scalar subquery
    likes = t("orders").select("o_orderkey", "o_custkey", "o_orderdate").join(
        lineitem.select("l_orderkey", "l_partkey", "l_suppkey"), c("o_orderkey") == c("l_orderkey")
    )

    def liked(key: str, name: str) -> DataFrame:
        return likes.groupBy(c("o_custkey").alias("user_id"), c(key).alias(name)).agg(
            F.min("o_orderdate").alias("liked_at")
        )

    tables = {
        "cafes": t("nation").select(c("n_nationkey").alias("id"), c("n_name").alias("name")),
        "cafe_locations": supplier.select(
            c("s_suppkey").alias("id"), c("s_nationkey").alias("cafe_id"), c("s_name").alias("address")
        ),
        "beans": part.select(
            c("p_partkey").alias("id"), c("p_name").alias("name"), c("p_retailprice").alias("price"),
            F.lit("USD").alias("currency"), c("p_brand").alias("proprietor"),
            pick(ROAST_LEVELS, c("p_size")).alias("roast_level"),
        ),
        "bean_specialties": part.filter(c("p_partkey") % 3 == 0).select(
            c("p_partkey").alias("bean_id"), pick(PROCESS_NAMES, c("p_size")).alias("process"),
            (c("p_size") * 50).alias("altitude_masl"),
        ),
        "menu_items": part.select(
            c("p_partkey").alias("id"), c("p_name").alias("name"), c("p_retailprice").alias("price"),
            (c("p_partkey") % shops.scalar()).alias("location_id"),
            F.lit("USD").alias("currency"), F.lit("other").alias("drink_type"),
        ),
        "cafe_location_beans": lineitem.select(
            c("l_suppkey").alias("location_id"), c("l_partkey").alias("bean_id")
        ).distinct(),
        "users": customer.select(
            c("c_custkey").alias("id"), c("c_name").alias("first_name"), c("c_name").alias("last_name"),
            c("c_name").alias("username"), F.concat("c_name", F.lit("@example.com")).alias("email"),
            F.when(c("c_acctbal") < 0, "low").when(c("c_acctbal") < 5000, "medium").otherwise("high").alias("budget_range"),
        ),
        "user_preferences": customer.filter(c("c_custkey") % 2 == 0).select(
            c("c_custkey").alias("user_id"), pick(ROAST_LEVELS, c("c_custkey")).alias("roast_level_pref"),
        ),
        "user_flavor_preferences": customer.select(
            c("c_custkey").alias("user_id"),
            F.explode(F.slice(F.array(*[F.lit(f) for f in FLAVORS]), 1, (c("c_custkey") % 3).cast("int"))).alias("flavor"),
        ),
        "user_liked_beans": liked("l_partkey", "bean_id"),
        "user_liked_locations": liked("l_suppkey", "location_id"),
        "user_interactions": t("events").select(
            c("event_id").alias("id"), c("user_id"),
            F.when(c("event_type").isin("view", "click", "purchase"), c("event_type")).otherwise("other").alias("interaction"),
            pick(["bean", "location", "menu_item"], c("event_id")).alias("object_type"),
            c("event_id").alias("object_id"), c("props").alias("metadata"), c("ts").alias("occurred_at"),
        ),
    }
    return {name: conform(df, name) for name, df in tables.items()}


def broken_catalog(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The catalog with added rows that break each kind of constraint, again made from the tables."""
    good = catalog(spark, sf_dir)
    c = F.col
    bad = dict(good)
    bad["cafe_locations"] = good["cafe_locations"].unionByName(conform(
        good["cafe_locations"].filter(c("id") % 5 == 0).select(
            (-2 * c("id") - 1).alias("id"), F.when(c("id") % 2 == 0, c("cafe_id") + 5000).alias("cafe_id"), c("address")
        ), "cafe_locations"))
    bad["users"] = good["users"].unionByName(conform(
        good["users"].filter(c("id") % 50 == 0).select(
            (-2 * c("id") - 1).alias("id"), c("first_name"), c("last_name"), c("username"),
            F.concat(F.lit("second."), "email").alias("email"),
        ), "users"))
    bad["beans"] = good["beans"].unionByName(conform(
        good["beans"].filter(c("id") % 40 == 0).select((-2 * c("id") - 1).alias("id"), c("price")), "beans"))
    bad["user_liked_beans"] = good["user_liked_beans"].unionByName(conform(
        good["user_liked_beans"].filter(c("bean_id") % 100 == 0).select(
            (-2 * c("user_id") - 2).alias("user_id"), c("bean_id")
        ).distinct(), "user_liked_beans"))
    return bad
