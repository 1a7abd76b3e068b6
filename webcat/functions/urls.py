"""URL expressions (Column -> Column).

URLs are split with the RFC 3986 pattern instead of ``parse_url``, which raises or gives NULL on the
broken URLs a crawl meets every day.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from webcat.functions.text import contains_any, ends_with_any, let, occurrences, starts_with_any, strip
from webcat.functions.vocab import (
    BLOCKED_EXTENSIONS,
    CSS_ASSET_EXTENSIONS,
    CSS_BAD_PREFIXES,
    CSS_PAGE_EXTENSIONS,
    JS_ALLOWED_SHAPE,
    JS_BAD_PATTERNS,
    JS_BAD_PREFIXES,
    MALFORMED_CHARACTERS,
    MAX_URL_LENGTH,
    NOT_A_DOMAIN_CHARACTERS,
    PAGE_EXTENSIONS,
)

_SCHEME = r"(?s)^([a-zA-Z][a-zA-Z0-9+.\-]*):"
_HOST = r"(?s)^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//([^/?#]*)"
_PATH = r"(?s)^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)"
_QUERY = r"(?s)^[^?#]*\?([^#]*)"
_NO_FRAGMENT = r"(?s)^([^#]*)"
_NO_QUERY = r"(?s)^([^?#]*)"


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, _SCHEME, 1))


def host(url: Column) -> Column:
    return F.regexp_extract(url, _HOST, 1)


def path(url: Column) -> Column:
    return F.regexp_extract(url, _PATH, 1)


def query(url: Column) -> Column:
    return F.regexp_extract(url, _QUERY, 1)


def site_name(url: Column) -> Column:
    """Folder-like name of a site: the host without ``www.`` and with ``_`` for every dot."""
    return F.replace(F.replace(host(url), F.lit("www."), F.lit("")), F.lit("."), F.lit("_"))


def safe_filename(url: Column, index: Column) -> Column:
    """``007_domain_path_parts``: file-system safe, at most 200 characters."""
    domain = F.replace(host(url), F.lit("www."), F.lit(""))
    parts = F.filter(F.split(path(url), "/"), lambda p: p != "")
    name = F.when(F.size(parts) > 0, F.array_join(F.concat(F.array(domain), parts), "_")).otherwise(
        F.concat(domain, F.lit("_home"))
    )
    name = F.regexp_replace(F.regexp_replace(name, r"[^\p{L}\p{N}_.\-]", "_"), "_+", "_")
    name = F.btrim(name, F.lit("_"))
    return F.substring(F.concat(F.format_string("%03d", index), F.lit("_"), name), 1, 200)


def _decoded(part: Column) -> Column:
    return F.coalesce(F.try_url_decode(part), F.replace(part, F.lit("+"), F.lit(" ")))


def sorted_query(q: Column) -> Column:
    """Query sorted by key; of a repeated key the first value stays; values come back decoded."""
    pairs = F.transform(
        F.filter(F.split(q, "&"), lambda p: p != ""),
        lambda p, i: F.struct(
            _decoded(F.regexp_extract(p, r"(?s)^([^=]*)", 1)).alias("key"),
            i.alias("seq"),
            _decoded(F.regexp_extract(p, r"(?s)^[^=]*=(.*)$", 1)).alias("value"),
        ),
    )
    def firsts(ordered: Column) -> Column:
        marked = F.filter(
            ordered, lambda p, i: (i == 0) | (F.get(ordered, i - 1)["key"] != p["key"])
        )
        return F.array_join(F.transform(marked, lambda p: F.concat(p["key"], F.lit("="), p["value"])), "&")

    return let(F.array_sort(pairs), firsts)


def normalize_url(url: Column) -> Column:
    """Drop the fragment, sort the query, cut trailing slashes of a path that is not just ``/``."""
    whole = F.regexp_extract(url, _NO_FRAGMENT, 1)
    before_query = F.regexp_extract(whole, _NO_QUERY, 1)
    p = path(before_query)
    front = F.substr(before_query, F.lit(1), F.length(before_query) - F.length(p))
    front = F.concat(F.lower(F.regexp_extract(front, r"^[^:/]*:?", 0)), F.regexp_replace(front, r"^[^:/]*:?", ""))
    cut = F.when(p == "/", p).otherwise(F.rtrim(p, F.lit("/")))
    q = query(whole)
    return F.concat(front, cut, F.when(q != "", F.concat(F.lit("?"), sorted_query(q))).otherwise(""))


def base_parts(url: Column) -> Column:
    """What link resolution needs from the page address, worked out once per page."""
    plain = F.regexp_extract(url, _NO_QUERY, 1)
    folder = F.regexp_extract(path(plain), r"(?s)^(.*/)?", 0)
    return F.struct(
        scheme(url).alias("scheme"),
        host(url).alias("host"),
        F.when(folder == "", "/").otherwise(folder).alias("folder"),
        plain.alias("plain"),
        F.regexp_extract(url, _NO_FRAGMENT, 1).alias("no_fragment"),
    )


def looks_like_domain(href: Column, base_host: Column) -> Column:
    """True for ``www.x``, the base host itself, or a first segment shaped like ``name.tld``.

    A first segment that ends in a page extension (``index.html``) is a relative file, not a domain.
    """
    first = F.regexp_extract(href, r"(?s)^([^/]*)", 1)
    file_part = F.lower(F.regexp_extract(first, r"(?s)^([^?#]*)", 1))
    shaped = (
        F.contains(first, F.lit("."))
        & ~F.contains(first, F.lit(" "))
        & (F.length(first) > 3)
        & ~contains_any(first, NOT_A_DOMAIN_CHARACTERS)
        & ~ends_with_any(file_part, PAGE_EXTENSIONS)
    )
    starts_with_base = (base_host != "") & F.startswith(href, base_host)
    return F.startswith(href, F.lit("www.")) | starts_with_base | shaped


def _without_dots(p: Column) -> Column:
    """Remove ``.`` and ``..`` segments; a path that ends in one of them keeps its final slash."""
    segments = F.split(p, "/")
    kept = F.reduce(
        segments,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
        .when(s == ".", acc)
        .otherwise(F.array_append(acc, s)),
    )
    joined = F.concat(
        F.array_join(kept, "/"), F.when(F.regexp_like(p, F.lit(r"(?:^|/)\.\.?$")), "/").otherwise("")
    )
    rooted = F.when(F.startswith(joined, F.lit("/")), joined).otherwise(F.concat(F.lit("/"), joined))
    return F.when(F.regexp_like(p, F.lit(r"(?:^|/)\.\.?(?:/|$)")), rooted).otherwise(p)


def resolve_url(href: Column, base: Column) -> Column:
    """Absolute form of a found reference; ``base`` is ``base_parts(page url)``. Blank gives NULL.

    Cases in order: absolute; ``//x``; domain without scheme; base domain repeated or embedded (kept from
    its last occurrence); fragment or query only (they replace the base's own); relative.
    """
    return let(strip(href), lambda u: _resolve(u, base))


def _resolve(u: Column, base: Column) -> Column:
    origin = F.concat(base["scheme"], F.lit("://"), base["host"])
    has_base = (base["host"] != "") & F.contains(u, base["host"])
    from_last_base = F.concat(origin, F.call_function("substring_index", u, base["host"], F.lit(-1)))

    tail = F.regexp_extract(u, r"(?s)^[^?#]*(.*)$", 1)
    front = F.regexp_extract(u, _NO_QUERY, 1)
    # empty segments are dropped when a relative path is merged with the folder of the page
    merged = F.regexp_replace(F.concat(base["folder"], front), r"/{2,}", "/")
    joined = F.concat(origin, _without_dots(F.when(F.startswith(front, F.lit("/")), front).otherwise(merged)), tail)
    return (
        F.when(u == "", F.lit(None).cast("string"))
        .when(starts_with_any(u, ["http://", "https://"]), u)
        .when(F.startswith(u, F.lit("//")), F.concat(base["scheme"], F.lit(":"), u))
        # the common case ahead of the rare ones, none of which applies to it
        .when(F.startswith(u, F.lit("/")) & ~has_base & ~F.contains(u, F.lit("/.")), F.concat(origin, u))
        .when(
            looks_like_domain(u, base["host"])
            & (occurrences(u, base["host"]) <= 1)
            & ~((base["host"] != "") & F.startswith(u, base["host"])),
            F.concat(F.lit("https://"), u),
        )
        .when(has_base, from_last_base)
        .when(F.startswith(u, F.lit("#")), F.concat(base["no_fragment"], u))
        .when(F.startswith(u, F.lit("?")), F.concat(base["plain"], u))
        .when(F.regexp_like(u, F.lit(_SCHEME)), u)
        .otherwise(joined)
    )


def is_malformed_url(url: Column) -> Column:
    def broken_path(p: Column) -> Column:
        domain = host(url)
        repeated = (domain != "") & F.contains(p, domain) & (occurrences(url, domain) > 2)
        return (F.contains(p, F.lit("//")) & (p != "//")) | repeated

    return (
        F.regexp_like(url, F.lit(MALFORMED_CHARACTERS))
        | (F.length(url) > MAX_URL_LENGTH)
        | F.regexp_like(url, F.lit("(?s)://.*://"))
        | let(path(url), broken_path)
    )


def is_valid_url(
    url: Column,
    base_host: Column,
    *,
    follow_external: bool = False,
    blocked_extensions: list[str] = BLOCKED_EXTENSIONS,
) -> Column:
    """May the URL be crawled? Never NULL.

    There is no list of allowed extensions: such a list that holds the empty ending accepts everything,
    so only the blocked one decides.
    """
    ok = scheme(url).isin("http", "https") & ~is_malformed_url(url) & ~ends_with_any(
        F.lower(path(url)), blocked_extensions
    )
    if not follow_external:
        ok = (host(url) == base_host) & ok
    return F.coalesce(ok, F.lit(False))


def is_valid_js_url(found: Column, base_host: Column) -> Column:
    """Does a string found in a script look like an address and not like code?"""
    return let(F.btrim(found, F.lit("'\"")), lambda u: _looks_like_address(u, base_host))


def _looks_like_address(u: Column, base_host: Column) -> Column:
    parts = F.filter(F.split(u, "/"), lambda p: p != "")
    short_word = F.regexp_like(F.translate(u, "/-_.", ""), F.lit("^[a-zA-Z0-9]+$")) & (F.length(u) < 5)
    structured = F.contains(u, F.lit("/")) | F.contains(u, F.lit("."))
    return F.coalesce(
        F.regexp_like(u, F.lit(JS_ALLOWED_SHAPE))
        & ~starts_with_any(u, JS_BAD_PREFIXES)
        & ~F.regexp_like(u, F.lit("|".join(JS_BAD_PATTERNS)))
        & (occurrences(u, base_host) <= 1)
        & (F.size(F.array_distinct(parts)) == F.size(parts))
        & (F.length(u) >= 2)
        & ~short_word
        & structured,
        F.lit(False),
    )


def is_valid_css_url(found: Column) -> Column:
    """Is a ``url(...)`` of a style sheet an address a reader could visit?"""
    return let(F.btrim(found, F.lit("'\"")), _is_page_in_style)


def _is_page_in_style(u: Column) -> Column:
    lowered = F.lower(u)
    last = F.substring_index(u, "/", -1)
    other_file = (
        F.startswith(u, F.lit("/")) & ~ends_with_any(lowered, CSS_PAGE_EXTENSIONS) & F.contains(last, F.lit("."))
    )
    return F.coalesce(
        (strip(u) != "")
        & ~starts_with_any(u, CSS_BAD_PREFIXES)
        & ~ends_with_any(lowered, CSS_ASSET_EXTENSIONS)
        & ~other_file,
        F.lit(False),
    )


def validate_final_url(url: Column) -> Column:
    """The URL itself when it has a scheme and a host and is not malformed, else NULL."""
    return F.when((scheme(url) != "") & (host(url) != "") & ~is_malformed_url(url), url)


def link_type(url: Column, base_host: Column) -> Column:
    return F.when(host(url) == base_host, "internal").otherwise("external")
