"""Link discovery: pages -> links.

All methods read one token stream. A token yields its candidate references as an array; they are resolved, checked,
sorted by (url, method, position) and reduced to the first of each URL within the page's row, and only then exploded. Nothing
is shuffled, and the same expression serves the stream.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webcat.functions import html as H
from webcat.functions import urls as U
from webcat.functions.text import let, parsed_json, strip
from webcat.functions.vocab import (
    ABSOLUTE_URL_PATTERN,
    BLOCKED_EXTENSIONS,
    BLOCKED_EXTENSIONS_WITH_MEDIA,
    COMMENT_URL_PATTERN,
    CSS_URL_PATTERN,
    DATA_LINK_ATTRIBUTES,
    DISCOVERY_METHODS,
    EVENT_ATTRIBUTES,
    EVENT_URL_PATTERN,
    HEADER_LINK_PATTERN,
    HEADER_RELATIONS,
    JS_URL_PATTERNS,
    LINK_TAG_RELATIONS,
    META_REFRESH_PATTERN,
    URL_PROPERTIES,
)
from webcat.operators.content import page_title
from webcat.session import allow_repeated_keys

LINK_COLUMNS = ["page_id", "source_page", "url", "discovery_method", "link_type", "status", "notes"]
_POS_BITS = 32


@dataclass(frozen=True)
class LinkProfile:
    """Which methods run and how their URLs are treated."""

    javascript: bool = True
    css: bool = True
    meta: bool = True
    json_ld: bool = True
    microdata: bool = True
    normalize: bool = False
    follow_external: bool = False
    blocked_extensions: tuple[str, ...] = tuple(BLOCKED_EXTENSIONS)

    def methods(self) -> list[str]:
        return [m for m in DISCOVERY_METHODS if getattr(self, m, True)]


PROFILES = {
    "default": LinkProfile(),
    "aggressive": LinkProfile(normalize=True),
    "conservative": LinkProfile(css=False, json_ld=False, microdata=False, normalize=True),
    "site": LinkProfile(css=False, microdata=False, blocked_extensions=tuple(BLOCKED_EXTENSIONS_WITH_MEDIA)),
}


# --- candidates of one token -------------------------------------------------------------------

def _no_strings() -> Column:
    return F.array().cast("array<string>")


def _present(values: Column) -> Column:
    return F.filter(values, lambda v: v.isNotNull() & (v != ""))


def _unless_prefixed(value: Column, *prefixes: str) -> Column:
    """One-item array with the stripped value, empty when blank or starting with a prefix."""
    v = strip(value)
    return F.filter(
        F.array(v),
        lambda x: x.isNotNull() & (x != "") & ~F.regexp_like(x, F.lit("^(?:" + "|".join(prefixes) + ")")),
    )


def _rooted(values: Column) -> Column:
    return F.filter(values, lambda v: F.regexp_like(v, F.lit("^(?:https?://|/)")))


def _find_all(text: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def _of_attribute(tag: Column, a: Column, methods: list[str]) -> Column:
    """References one attribute holds by itself: array<struct<rank, raw>>."""
    name, value = a["name"], a["value"]
    href = _unless_prefixed(value, "#", "mailto:", "tel:")
    cases = [
        ("anchor", (name == "href") & (tag == "a"), href),
        ("area", (name == "href") & (tag == "area"), href),
        ("form", (name == "action") & (tag == "form"), _unless_prefixed(value, "#", "mailto:")),
        ("anchor", (name == "aria-label") & tag.isin("a", "button", "div"), _find_all(value, ABSOLUTE_URL_PATTERN, 0)),
        ("data_attribute", name.isin(DATA_LINK_ATTRIBUTES), _unless_prefixed(value, "#", "javascript:")),
        ("javascript", name.isin(EVENT_ATTRIBUTES), _find_all(value, EVENT_URL_PATTERN, 1)),
        ("css", name == "style", _css_text(value)),
        ("microdata", name.isin("itemid", "itemtype"), _rooted(F.array(value))),
    ]
    chosen = _no_refs()
    for method, condition, values in reversed([c for c in cases if c[0] in methods]):
        chosen = F.when(condition, _ranked(method, values)).otherwise(chosen)
    return chosen


def _js_script(token: Column, base_host: Column) -> Column:
    # the body sits in a one-item array so that it is cut out of its tag once, not once per pattern
    found = F.flatten(F.transform(
        F.array(H.script_body(token)), lambda b: F.concat(*[_find_all(b, "(?i)" + p, 1) for p in JS_URL_PATTERNS])
    ))
    return F.filter(F.array_distinct(found), lambda u: U.is_valid_js_url(u, base_host))


def _css_text(text: Column) -> Column:
    return F.filter(_find_all(text, CSS_URL_PATTERN, 1), U.is_valid_css_url)


def _meta(tag: Column, attrs: Column) -> Column:
    """Refresh target of a meta tag or address of a link tag with a followed relation."""
    refresh = F.when(
        F.lower(H.attribute(attrs, "http-equiv")) == "refresh",
        F.btrim(F.regexp_extract(H.attribute(attrs, "content"), META_REFRESH_PATTERN, 1), F.lit("'\"")),
    )
    relations = F.split(F.coalesce(H.attribute(attrs, "rel"), F.lit("")), r"\s+")
    linked = F.when(
        F.arrays_overlap(relations, F.array(*[F.lit(r) for r in LINK_TAG_RELATIONS])), H.attribute(attrs, "href")
    )
    return _present(F.array(F.when(tag == "meta", refresh).when(tag == "link", linked)))


def _url_properties(attrs: Column) -> Column:
    """Addresses of an element whose itemprop names an address."""
    holders = F.filter(attrs, lambda a: a["name"].isin("href", "src", "content"))
    return F.when(
        H.attribute(attrs, "itemprop").isin(URL_PROPERTIES), _rooted(F.transform(holders, lambda a: a["value"]))
    ).otherwise(_no_strings())


def _json_ld(token: Column, attrs: Column) -> Column:
    body = strip(H.script_body(token))
    # inside valid JSON a quoted key followed by a colon is always a key: inner quotes are escaped
    pattern = r'"(?:' + "|".join(URL_PROPERTIES) + r')"\s*:\s*"([^"\\]*(?:\\.[^"\\]*)*)"'

    def values(text: Column) -> Column:
        return F.transform(
            _find_all(text, pattern, 1),
            lambda s: F.get(F.from_json(F.concat(F.lit('["'), s, F.lit('"]')), "array<string>"), F.lit(0)),
        )

    # the parsed object holds no overridden values of repeated keys, the text holds the order
    counting = let(F.to_json(parsed_json(body)), lambda text: F.when(text.isNotNull(), let(
        values(text), lambda last: F.filter(values(body), lambda v: F.array_contains(last, v)))))
    is_json_ld = H.attribute(attrs, "type") == "application/ld+json"
    found = F.coalesce(counting, _no_strings())
    return F.when(is_json_ld, _rooted(_present(found))).otherwise(_no_strings())


# only tokens that can hold a reference are looked at: comments, scripts, styles, these tags, these attributes
_TOKEN_OF_INTEREST = r"(?i)^<(?:!--|(?:script|style|a|area|form|meta|link|button)[\s/>])"
_ATTRIBUTE_OF_INTEREST = (
    r"(?i)[\s\"'](?:data-|style\s*=|item(?:id|type|prop)|aria-label|" + "|".join(EVENT_ATTRIBUTES) + ")"
)


#: A token without these holds nothing for the method. Names are compared after lower-casing, hence the Unicode flag.
_HINTS = {
    "anchor": r"^<a[\s/>]|aria-label", "area": r"^<area[\s/>]", "form": r"^<form[\s/>]",
    "data_attribute": "|".join(DATA_LINK_ATTRIBUTES), "javascript": r"^<script\b|" + "|".join(EVENT_ATTRIBUTES),
    "css": "style", "microdata": "item(?:id|type|prop)", "meta": r"^<(?:meta|link)[\s/>]", "json_ld": r"^<script\b",
    "comment": "^<!--",
}


def _no_refs() -> Column:
    return F.array().cast("array<struct<rank:int,raw:string>>")


def _ranked(method: str, values: Column) -> Column:
    rank = DISCOVERY_METHODS.index(method)
    return F.transform(values, lambda v: F.struct(F.lit(rank).alias("rank"), v.alias("raw")))


def _candidates(t: Column, host: Column, methods: list[str]) -> Column:
    """array<struct<rank, raw>> of one token (kind, tag, token, attrs) of a page on ``host``."""
    kind, tag, token, attrs = t["kind"], t["tag"], t["token"], t["attrs"]

    def together(parts: dict[str, Column]) -> Column:
        chosen = [_ranked(m, v) for m, v in parts.items() if m in methods]
        return F.concat(*chosen) if chosen else _no_refs()

    of_tag = F.flatten(F.transform(attrs, lambda a: _of_attribute(tag, a, methods)))
    if "meta" in methods:
        of_tag = F.concat(of_tag, F.when(tag.isin("meta", "link"), _ranked("meta", _meta(tag, attrs))).otherwise(_no_refs()))
    if "microdata" in methods:
        of_tag = F.concat(of_tag, _ranked("microdata", _url_properties(attrs)))
    of_script = together({
        "javascript": _js_script(token, host),
        "json_ld": _json_ld(token, attrs),
    })
    of_style = together({"css": _css_text(H.script_body(token))})
    comment_text = F.regexp_replace(token, r"(?s)^<!--|-->$", "")
    of_comment = together({"comment": _find_all(comment_text, COMMENT_URL_PATTERN, 0)})
    return (
        F.when(kind == "open", of_tag)
        .when(kind == "script", of_script)
        .when(kind == "style", of_style)
        .when(kind == "comment", of_comment)
        .otherwise(_no_refs())
    )


def _header_refs(headers: Column) -> Column:
    """array<struct<rank, raw>> of the HTTP ``Link`` header."""
    header = F.coalesce(headers["Link"], headers["link"], F.lit(""))
    wanted = F.filter(
        _find_all(header, HEADER_LINK_PATTERN, 0),
        lambda m: F.regexp_extract(m, HEADER_LINK_PATTERN, 2).isin(HEADER_RELATIONS),
    )
    return _ranked("http_header", F.transform(wanted, lambda m: F.regexp_extract(m, HEADER_LINK_PATTERN, 1)))


def _tokens_of_interest(html: Column, methods: list[str]) -> Column:
    """array<struct<pos, kind, tag, token, attrs>> of the tokens that can hold a reference for one of the methods."""
    numbered = F.transform(H.tokens(html), lambda t, i: F.struct(i.alias("pos"), t.alias("token")))
    hints = [h for m, h in _HINTS.items() if m in methods]
    read = ["open", "script"] if "json_ld" in methods else ["open"]

    def telling(t: Column) -> Column:
        some = F.startswith(t, F.lit("<")) & (F.substring(t, 2, 1) != "/")
        if len(hints) < len(_HINTS):
            some = some & F.regexp_like(t, F.lit("(?iu)" + "|".join(hints)))
        return some & (F.regexp_like(t, F.lit(_TOKEN_OF_INTEREST)) | F.regexp_like(t, F.lit(_ATTRIBUTE_OF_INTEREST)))

    some = F.filter(numbered, lambda t: telling(t["token"]))
    kinds = F.transform(
        some, lambda t: F.struct(t["pos"].alias("pos"), H.token_kind(t["token"]).alias("kind"), t["token"].alias("token"))
    )
    return F.transform(kinds, lambda t: F.struct(
        t["pos"].alias("pos"), t["kind"].alias("kind"), H.token_tag(t["token"], t["kind"]).alias("tag"), t["token"].alias("token"),
        F.when(t["kind"].isin(read), H.attributes(t["token"])).alias("attrs"),
    ))


def page_links(html: Column, url: Column, headers: Column | None, profile: LinkProfile, methods: list[str]) -> Column:
    """array<struct<url, first_seen, host>>: the valid links of a page, each URL once, in URL order.

    ``first_seen`` packs (method rank, token position) into one long: the smallest is the method and place that
    find the URL first.
    """
    def of_base(base: Column) -> Column:
        def found(pos: Column, refs: Column) -> Column:
            resolved = F.transform(
                refs, lambda r: F.struct(r["rank"].alias("rank"), U.resolve_url(r["raw"], base).alias("url"))
            )
            valid = F.filter(
                resolved,
                lambda r: U.is_valid_url(
                    r["url"], base["host"],
                    follow_external=profile.follow_external, blocked_extensions=list(profile.blocked_extensions),
                ),
            )
            return F.transform(valid, lambda r: F.struct(
                (U.normalize_url(r["url"]) if profile.normalize else r["url"]).alias("url"),
                (F.shiftleft(r["rank"].cast("long"), _POS_BITS) + pos).alias("first_seen"),
                base["host"].alias("host"),
            ))

        if any(m in _HINTS for m in methods):
            seen = F.flatten(F.transform(
                _tokens_of_interest(html, methods), lambda t: found(t["pos"], _candidates(t, base["host"], methods))
            ))
        else:
            seen = found(F.lit(0), _no_refs())  # none of the methods reads the page
        if headers is not None and "http_header" in methods:
            seen = F.concat(F.coalesce(seen, found(F.lit(0), _no_refs())), found(F.lit(0), _header_refs(headers)))
        return let(F.sort_array(seen), lambda s: F.filter(
            s, lambda x, i: (i == 0) | (x["url"] != F.get(s, i - 1)["url"])
        ))

    return let(U.base_parts(url), of_base)


def page_links_by_profile(html: Column, url: Column, headers: Column | None, profiles: list[LinkProfile]) -> Column:
    """array<struct<profile, url, first_seen, host>>: what ``page_links`` gives for each profile, by its place in the list.

    The page is taken apart once for all of them, and a reference is resolved, tested and normalised once.
    """
    methods = [m for m in DISCOVERY_METHODS if any(m in p.methods() for p in profiles)]
    blocked = [x for x in profiles[0].blocked_extensions if all(x in p.blocked_extensions for p in profiles)]
    nothing = ["\0"]  # an ending that no path has: an empty list would match every path
    external = any(p.follow_external for p in profiles)

    def of_base(base: Column) -> Column:
        def found(pos: Column, refs: Column) -> Column:
            resolved = F.transform(refs, lambda r: F.struct(
                r["rank"].alias("rank"), U.resolve_url(r["raw"], base).alias("url")
            ))
            valid = F.filter(resolved, lambda r: U.is_valid_url(
                r["url"], base["host"], follow_external=external, blocked_extensions=blocked or nothing
            ))
            return F.transform(valid, lambda r: F.struct(
                r["rank"].alias("rank"), r["url"].alias("url"),
                (F.shiftleft(r["rank"].cast("long"), _POS_BITS) + pos).alias("first_seen"),
                (U.normalize_url(r["url"]) if any(p.normalize for p in profiles) else r["url"]).alias("normal"),
            ))

        def own(number: int, profile: LinkProfile, ordered: Column) -> Column:
            ranks = [DISCOVERY_METHODS.index(m) for m in profile.methods()]
            more = [x for x in profile.blocked_extensions if x not in blocked]
            tests = []
            if len(ranks) < len(methods):
                tests.append(lambda r: r["rank"].isin(ranks))
            if more:
                tests.append(lambda r: ~U.ends_with_any(F.lower(U.path(r["url"])), more))
            if external and not profile.follow_external:
                tests.append(lambda r: U.host(r["url"]) == base["host"])
            for test in tests:
                ordered = F.filter(ordered, test)
            return let(ordered, lambda s: F.transform(
                F.filter(s, lambda x, i: (i == 0) | (x["key"] != F.get(s, i - 1)["key"])),
                lambda x: F.struct(F.lit(number).alias("profile"), x["key"].alias("url"),
                                   x["first_seen"].alias("first_seen"), base["host"].alias("host")),
            ))

        def in_order(seen: Column, normal: bool) -> Column:
            return F.sort_array(F.transform(seen, lambda r: F.struct(
                r["normal" if normal else "url"].alias("key"), r["first_seen"].alias("first_seen"),
                r["rank"].alias("rank"), r["url"].alias("url"),
            )))

        def of_some(seen: Column, normal: bool) -> list[Column]:
            some = [(i, p) for i, p in enumerate(profiles) if p.normalize == normal]
            return [let(in_order(seen, normal), lambda s: F.concat(*[own(i, p, s) for i, p in some]))] if some else []

        def of_profiles(seen: Column) -> Column:
            return F.concat(*of_some(seen, False), *of_some(seen, True))

        seen = F.flatten(F.transform(
            _tokens_of_interest(html, methods), lambda t: found(t["pos"], _candidates(t, base["host"], methods))
        ))
        if headers is not None and "http_header" in methods:
            seen = F.concat(F.coalesce(seen, found(F.lit(0), _no_refs())), found(F.lit(0), _header_refs(headers)))
        return let(seen, of_profiles)

    return let(U.base_parts(url), of_base)


def resolved_candidates(pages: DataFrame, profile: LinkProfile, methods: list[str] | None = None) -> DataFrame:
    """The links of every row of ``pages``, each URL once: (page_id, source_page, host, url, first_seen).

    Stateless and without a shuffle, so it serves batch and stream alike.
    """
    headers = F.col("response_headers") if "response_headers" in pages.columns else None
    found = page_links(F.col("html"), F.col("url"), headers, profile, profile.methods() if methods is None else methods)
    rows = allow_repeated_keys(pages).select("page_id", F.col("url").alias("source_page"), F.explode(found).alias("link"))
    return rows.select("page_id", "source_page", "link.host", "link.url", "link.first_seen")


def method_of(first_seen: Column) -> Column:
    rank = F.shiftright(first_seen, _POS_BITS).cast("int")
    return F.element_at(F.array(*[F.lit(m) for m in DISCOVERY_METHODS]), rank + 1)


def extract_links(
    pages: DataFrame, profile: LinkProfile = PROFILES["default"], methods: list[str] | None = None
) -> DataFrame:
    """Links of every row of ``pages``, each URL once; the first method that finds it keeps it."""
    return resolved_candidates(pages, profile, methods).select(
        "page_id", "source_page", "url",
        method_of(F.col("first_seen")).alias("discovery_method"),
        U.link_type(F.col("url"), F.col("host")).alias("link_type"),
        F.lit("pending").alias("status"),
        F.lit("").alias("notes"),
    )


def extract_links_by_profile(pages: DataFrame, profiles: dict[str, LinkProfile] = PROFILES) -> DataFrame:
    """The rows of ``extract_links`` for each profile, after its name in ``profile``; pages are read once for all."""
    headers = F.col("response_headers") if "response_headers" in pages.columns else None
    found = page_links_by_profile(F.col("html"), F.col("url"), headers, list(profiles.values()))
    rows = allow_repeated_keys(pages).select("page_id", F.col("url").alias("source_page"), F.explode(found).alias("link"))
    return rows.select(
        F.element_at(F.array(*[F.lit(name) for name in profiles]), F.col("link.profile") + 1).alias("profile"),
        "page_id", "source_page", "link.url",
        method_of(F.col("link.first_seen")).alias("discovery_method"),
        U.link_type(F.col("link.url"), F.col("link.host")).alias("link_type"),
        F.lit("pending").alias("status"),
        F.lit("").alias("notes"),
    )


def links_by_method(pages: DataFrame, method: str, profile: LinkProfile = PROFILES["default"]) -> DataFrame:
    """Links found by a single discovery method."""
    return extract_links(pages, profile, [method])


def unique_links(links: DataFrame) -> DataFrame:
    """First occurrence of every URL within its site, by (page_id, method, position).

    A navigation link sits on every page of its site, so this is an aggregation with map-side combine:
    a ranking window would bring all copies of such a link into one task. The inputs are rows of
    ``extract_links``, which hold one position-free row per page and url, so (page_id, method) decides.
    """
    rank = F.array_position(F.array(*[F.lit(m) for m in DISCOVERY_METHODS]), F.col("discovery_method"))
    best = links.groupBy(U.site_name(F.col("source_page")).alias("site_name"), "url").agg(
        F.min(
            F.struct("page_id", rank.alias("rank"), *[c for c in LINK_COLUMNS if c not in ("page_id", "url")])
        ).alias("first")
    )
    return best.select(
        "site_name", "first.page_id", "first.source_page", "url",
        "first.discovery_method", "first.link_type", "first.status", "first.notes",
    )


def source_page_stats(pages: DataFrame, links: DataFrame) -> DataFrame:
    """Per page: links_found, discovery_methods, title, fetch_status (failed when there is no body)."""
    per_page = links.groupBy("page_id").agg(
        F.count("*").alias("links_found"), F.sort_array(F.collect_set("discovery_method")).alias("discovery_methods")
    )
    fetched = F.coalesce(F.length("html") > 0, F.lit(False))
    titles = pages.select(
        "page_id", "url",
        F.when(fetched, page_title(F.col("html"))).otherwise("Failed to fetch").alias("title"),
        F.when(fetched, "success").otherwise("failed").alias("fetch_status"),
    )
    return titles.join(per_page, "page_id", "left").select(
        "page_id", "url", "title", "fetch_status",
        F.coalesce("links_found", F.lit(0)).cast("long").alias("links_found"),
        F.coalesce("discovery_methods", F.array().cast("array<string>")).alias("discovery_methods"),
    )


def with_options(profile: LinkProfile, **options) -> LinkProfile:
    """A copy of a profile with some options changed."""
    return replace(profile, **options)
