"""Does a page need JavaScript to show its content? Weighted rule features, one row per page, no shuffle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webcat.functions import html as H
from webcat.functions.text import WORD_BREAK, contains_any, let, strip
from webcat.functions.vocab import (
    EMPTY_CONTAINER_CLASS,
    FRAMEWORK_CODE_MARKS,
    FRAMEWORK_GENERATOR,
    FRAMEWORK_META_NAMES,
    FRAMEWORK_SCRIPT_NAMES,
    JS_CONSERVATIVE_SCORE,
    JS_MIN_SCORE,
    JS_STRICT_EXTRA,
    JS_WEIGHTS,
    LOADING_CLASS_WORDS,
    LOADING_TEXTS,
    MAIN_ROOT_ID,
    NOSCRIPT_PHRASES,
    STATIC_WEIGHTS,
    ROOT_CLASS,
    ROOT_ID,
)

FEATURES = [*JS_WEIGHTS, *STATIC_WEIGHTS]


def _attr(e: Column, name: str) -> Column:
    return F.coalesce(H.attribute(e["attrs"], name), F.lit(""))


def _inside(e: Column, pos: Column) -> Column:
    return (e["pos"] < pos) & (pos < e["end_pos"])


def _places(elements: Column, wanted) -> Column:
    return F.transform(F.filter(elements, wanted), lambda e: e["pos"])


def _children(elements: Column, e: Column) -> Column:
    return F.size(F.filter(elements, lambda c: _inside(e, c["pos"])))


def js_features(pages: DataFrame) -> DataFrame:
    """(page_id, one boolean per feature). The static signs are the last four."""
    found = H.with_page(F.col("html"), lambda p: _page_facts(p, _features), attrs=True)
    return pages.select("page_id", F.explode(F.array(found)).alias("f")).select("page_id", "f.*")


def _page_facts(p: Column, use) -> Column:
    """``use`` of what several features read, worked out once per page."""
    scripts = F.transform(
        F.filter(p["toks"], lambda t: t["kind"] == "script"),
        lambda t: F.struct(
            F.lower(F.coalesce(H.attribute(H.attributes(t["token"]), "src"), F.lit(""))).alias("src"),
            H.script_body(t["token"]).alias("body"),
        ),
    )
    n_tokens = F.size(p["toks"])
    spans = F.filter(p["spans"], lambda s: s["tag"].isin("title", "noscript"))
    hidden = let(spans, lambda h: F.struct(
        H.ranks(F.transform(h, lambda s: s["pos"]), n_tokens).alias("begun"),
        H.ranks(F.array_sort(F.transform(h, lambda s: s["end_pos"])), n_tokens).alias("ended"),
    ))

    def with_body(q: Column) -> Column:
        body = q["body"]

        def is_hidden(i: Column) -> Column:
            # more of these elements have begun, up to this token, than have ended before it
            return F.get(q["hidden"]["begun"], i + 1) > F.get(q["hidden"]["ended"], i)

        # text and markup of the body without the elements that show nothing
        seen = F.transform(p["pieces"], lambda x, i: F.when(is_hidden(i), "").otherwise(x))
        markup = F.filter(
            F.transform(
                F.slice(p["toks"], body["pos"] + 1, F.greatest(body["end_pos"] - body["pos"] + 1, F.lit(0))),
                lambda t, i: F.struct((i + body["pos"]).alias("pos"), t["kind"].alias("kind"), t["tag"].alias("tag"),
                                      F.length(t["token"]).alias("n")),
            ),
            lambda t: ~t["kind"].isin("script", "style")
            & ~F.coalesce(t["tag"].isin("meta", "link"), F.lit(False))
            & ~is_hidden(t["pos"]),
        )

        def emptiness(s: Column, containers: Column) -> Column:
            """Does any of the containers hold no text and fewer than three elements? Texts are ranked only where there are some."""
            shown = _places(p["elements"], lambda e: ~e["tag"].isin("meta", "link", "title", "noscript"))
            telling = F.filter(F.transform(s, lambda x, i: F.when(x != "", i)), lambda i: i.isNotNull())
            ranked = F.struct(H.ranks(shown, n_tokens).alias("shown"), H.ranks(telling, n_tokens).alias("telling"))
            return F.when(F.size(containers) > 0, let(ranked, lambda r: F.exists(
                containers,
                lambda e: (H.between(r["telling"], e["pos"], e["end_pos"]) == 0)
                & (H.between(r["shown"], e["pos"], e["end_pos"]) < 3),
            ))).otherwise(False)

        containers = F.filter(
            p["elements"],
            lambda e: e["tag"].isin("div", "main", "section")
            & _inside(body, e["pos"])
            & F.regexp_like(_attr(e, "class"), F.lit(EMPTY_CONTAINER_CLASS)),
        )

        def with_words(s: Column, b: Column) -> Column:
            # the size and the containers matter on pages of few words
            return let(F.struct(
                p["elements"].alias("elements"), p["texts"].alias("texts"), p["pieces"].alias("pieces"),
                body.alias("body"), q["scripts"].alias("scripts"),
                H.ranks(_places(p["elements"], lambda e: e["tag"] == "a"), n_tokens).alias("anchors"),
                b["text"].alias("body_text"), b["words"].alias("words"),
                F.when(b["words"] < 30, F.reduce(markup, F.lit(0), lambda n, t: n + t["n"])).alias("body_size"),
                F.when(b["words"] < 100, let(containers, lambda c: emptiness(s, c))).alias("empty_container"),
                F.array_join(F.transform(q["scripts"], lambda c: c["body"]), " ").alias("code"),
                F.flatten(p["elements"]["attrs"]).alias("attrs"),
            ), use)

        return let(seen, lambda s: let(H.text_between(s, body["pos"], body["end_pos"]), lambda text: let(F.struct(
            text.alias("text"), F.size(F.array_remove(F.split(text, WORD_BREAK), "")).alias("words")
        ), lambda b: with_words(s, b))))

    first_body = F.get(F.filter(p["spans"], lambda e: e["tag"] == "body"), F.lit(0))
    return let(
        F.struct(scripts.alias("scripts"), hidden.alias("hidden"), first_body.alias("body")), with_body
    )


def _features(q: Column) -> Column:
    elements, texts, body, code, scripts = q["elements"], q["texts"], q["body"], q["code"], q["scripts"]

    def text_of(e: Column) -> Column:
        return H.text_between(q["pieces"], e["pos"], e["end_pos"])

    noscript = F.exists(
        elements,
        lambda e: (e["tag"] == "noscript")
        & contains_any(F.lower(H.text_between(texts, e["pos"], e["end_pos"])), NOSCRIPT_PHRASES),
    )
    minimal = (
        body.isNull()
        | (q["words"] < 10)
        | ((q["words"] < 30) & (F.length(q["body_text"]) / F.greatest(q["body_size"], F.lit(1)) < 0.05))
        | ((q["words"] < 100) & q["empty_container"])
    )
    framework = (
        F.exists(scripts, lambda s: contains_any(s["src"], FRAMEWORK_SCRIPT_NAMES))
        | F.exists(
            elements,
            lambda e: (e["tag"] == "meta")
            & (
                _attr(e, "name").isin(FRAMEWORK_META_NAMES)
                | ((_attr(e, "name") == "generator") & F.contains(F.lower(_attr(e, "content")), F.lit(FRAMEWORK_GENERATOR)))
            ),
        )
        | contains_any(code, FRAMEWORK_CODE_MARKS)
    )

    def hollow(e: Column) -> Column:
        few = (_children(elements, e) < 5) | (_attr(e, "data-reactroot") != "")
        return (F.length(text_of(e)) < 50) & few

    def first_is_hollow(tag: str, wanted) -> Column:
        first = F.get(F.filter(elements, lambda e: (e["tag"] == tag) & wanted(e)), F.lit(0))
        return F.coalesce(let(first, hollow), F.lit(False))

    root = (
        first_is_hollow("div", lambda e: F.regexp_like(_attr(e, "id"), F.lit(ROOT_ID)))
        | first_is_hollow(
            "div", lambda e: F.regexp_like(_attr(e, "class"), F.lit(ROOT_CLASS))
        )
        | first_is_hollow("main", lambda e: F.regexp_like(_attr(e, "id"), F.lit(MAIN_ROOT_ID)))
    )
    loading = F.exists(
        q["attrs"], lambda a: (a["name"] == "class") & contains_any(F.lower(a["value"]), LOADING_CLASS_WORDS)
    ) | contains_any(F.lower(F.array_join(texts, "")), LOADING_TEXTS)
    routing = (
        F.exists(elements, lambda e: (e["tag"] == "a") & F.startswith(_attr(e, "href"), F.lit("#/")))
        | F.exists(q["attrs"], lambda a: a["name"].isin("data-router", "data-route"))
        | F.contains(code, F.lit("pushState"))
    )
    inline = F.filter(scripts, lambda s: (s["src"] == "") & (s["body"] != ""))
    inline_size = F.reduce(inline, F.lit(0), lambda n, s: n + F.length(s["body"]))
    heavy = (
        (F.size(F.filter(scripts, lambda s: s["src"] != "")) > 10)
        | (inline_size > 50000)
        | ((F.size(inline) > 5) & (inline_size > 10000))
    )
    rich = F.exists(elements, lambda e: e["tag"].isin("article", "main", "section") & (F.length(text_of(e)) > 200))
    navigation = F.exists(
        elements,
        lambda e: e["tag"].isin("nav", "ul", "ol") & (H.between(q["anchors"], e["pos"], e["end_pos"]) > 3),
    )
    form = F.exists(elements, lambda e: e["tag"] == "form")
    first_description = F.get(
        F.filter(elements, lambda e: (e["tag"] == "meta") & (_attr(e, "name") == "description")), F.lit(0)
    )
    described = F.length(_attr(first_description, "content")) > 50

    values = [noscript, minimal, framework, root, loading, routing, heavy, rich, navigation, form, described]
    return F.struct(*[F.coalesce(v, F.lit(False)).alias(n) for n, v in zip(FEATURES, values, strict=True)])


def js_scores(features: DataFrame, *, strict: bool = False, min_score: int = JS_MIN_SCORE,
              conservative_score: int = JS_CONSERVATIVE_SCORE) -> DataFrame:
    """Score, confidence and verdict of every page: (page_id, features.., score, confidence, js_dependent)."""
    weights = {**JS_WEIGHTS, **{name: -w for name, w in STATIC_WEIGHTS.items()}}
    score = reduce(
        lambda a, b: a + b, [F.when(F.col(name), F.lit(w)).otherwise(F.lit(0)) for name, w in weights.items()]
    )
    threshold = min_score + (JS_STRICT_EXTRA if strict else 0)
    scored = features.withColumn("score", score)
    sure = F.col("score") >= threshold
    likely = (F.col("score") >= conservative_score) & (F.col("noscript") | F.col("minimal_content"))
    return scored.select(
        "*",
        F.when(sure & (F.col("score") >= threshold + 15), "high")
        .when(sure | likely, "medium")
        .otherwise("low")
        .alias("confidence"),
        (sure | likely).alias("js_dependent"),
    )


def rendering_breakdown(pages: DataFrame) -> DataFrame:
    """Pages per rendering method with their share; a missing method counts as unknown.

    The share is taken over the counted groups, a handful of rows, not over the pages.
    """
    method = F.coalesce(F.nullif(strip(F.col("rendering_method")), F.lit("")), F.lit("unknown"))
    counts = pages.groupBy(method.alias("rendering_method")).agg(F.count("*").alias("n_pages"))
    total = F.sum("n_pages").over(Window.partitionBy())
    return counts.select("rendering_method", "n_pages", (F.col("n_pages") * 100.0 / total).alias("percent"))
