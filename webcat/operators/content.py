"""Text of pages. One row in, one row out: none of these operators shuffles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webcat.functions import html as H
from webcat.functions.text import contains_any, decode_entities, let, squeeze_text, strip
from webcat.functions.vocab import (
    CLEAN_TEXT_DROPPED,
    DESCRIPTION_WORDS,
    EXTRACTION_TEXT_LIMIT,
    FULL_PAGE_HEADING,
)


def page_title(html: Column) -> Column:
    """Text of the first ``<title>`` outside comments and scripts, '' when there is none."""
    visible = F.regexp_replace(html, r"(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>", "")
    inner = F.regexp_extract(visible, r"(?is)<title\b[^>]*>(.*?)</title", 1)
    return strip(decode_entities(F.regexp_replace(inner, r"</?[a-zA-Z][^>]*>", "")))


def titles(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", page_title(F.col("html")).alias("title"))


def text_outside(texts: Column, spans: Column, tags: list[str]) -> Column:
    """Page text without the given elements, fragments glued without a separator; ``texts`` must be bound."""
    dropped = F.flatten(
        F.transform(F.filter(spans, lambda s: s["tag"].isin(tags)), lambda s: F.sequence(s["pos"], s["end_pos"]))
    )
    kept = F.array_except(F.sequence(F.lit(0), F.size(texts) - 1), dropped)
    return F.when(F.size(texts) > 0, F.array_join(F.transform(kept, lambda i: F.get(texts, i)), "")).otherwise("")


def clean_text_of(html: Column) -> Column:
    """Readable text without script, style, nav, footer and header parts."""
    return H.with_page(html, lambda p: squeeze_text(text_outside(p["texts"], p["spans"], CLEAN_TEXT_DROPPED)))


def full_text_of(html: Column) -> Column:
    """Text of the whole page, navigation included. Needs no element spans."""
    return squeeze_text(F.array_join(H.text_pieces(H.classified(H.tokens(html))), ""))


def clean_text(pages: DataFrame) -> DataFrame:
    """(page_id, clean_text)."""
    return pages.select("page_id", clean_text_of(F.col("html")).alias("clean_text"))


def full_text(pages: DataFrame) -> DataFrame:
    """(page_id, full_text)."""
    return pages.select("page_id", full_text_of(F.col("html")).alias("full_text"))


def has_class_part(e: Column, part: str) -> Column:
    return F.coalesce(F.contains(H.attribute(e["attrs"], "class"), F.lit(part)), F.lit(False))


def _described_elements(elements: Column) -> Column:
    """Elements that usually hold a product description, selector by selector, each in document order."""
    def has_class(e: Column, name: str) -> Column:
        return F.array_contains(F.split(F.coalesce(H.attribute(e["attrs"], "class"), F.lit("")), r"\s+"), name)

    def has_id_part(e: Column, part: str) -> Column:
        return F.coalesce(F.contains(H.attribute(e["attrs"], "id"), F.lit(part)), F.lit(False))

    def paragraphs(prose: Column) -> Column:
        return F.filter(
            elements,
            lambda e: (e["tag"] == "p") & F.exists(prose, lambda p: (p["pos"] < e["pos"]) & (e["pos"] < p["end_pos"])),
        )

    return F.concat(
        F.filter(elements, lambda e: has_class_part(e, "description")),
        F.filter(elements, lambda e: has_class_part(e, "product-description")),
        F.filter(elements, lambda e: has_class_part(e, "product-details")),
        F.filter(elements, lambda e: has_class_part(e, "product-info")),
        F.filter(elements, lambda e: has_id_part(e, "description")),
        let(F.filter(elements, lambda e: has_class(e, "prose")), paragraphs),
        F.filter(elements, lambda e: H.has_attribute(e["attrs"], "data-product-description")),
    )


def first_meta_content(elements: Column, key: str, name: str) -> Column:
    """Content of the first ``<meta key=name>``; NULL when that tag has none."""
    metas = F.filter(elements, lambda e: (e["tag"] == "meta") & (H.attribute(e["attrs"], key) == name))
    return F.nullif(H.attribute(F.get(metas, F.lit(0))["attrs"], "content"), F.lit(""))


# only tags that hold these parts of names can have an attribute that the sections ask for
_SECTION_NAMES = ["class", "id", "name", "property", "data-product-description"]


def _sections(elements: Column, pieces: Column) -> Column:
    """array<struct<kind, text>> in reading priority."""
    def line(label: str, key: str, name: str) -> Column:
        return F.struct(F.lit(label).alias("kind"), first_meta_content(elements, key, name).alias("text"))

    metas = F.filter(
        F.array(
            line("META DESCRIPTION", "name", "description"),
            line("OG DESCRIPTION", "property", "og:description"),
            line("TWITTER DESCRIPTION", "name", "twitter:description"),
        ),
        lambda s: s["text"].isNotNull(),
    )
    blocks = F.transform(
        _described_elements(elements),
        lambda e: F.struct(
            F.lit("PRODUCT DESCRIPTION").alias("kind"), H.text_between(pieces, e["pos"], e["end_pos"]).alias("text")
        ),
    )
    described = F.filter(
        blocks, lambda s: (F.length(s["text"]) > 50) & contains_any(F.lower(s["text"]), DESCRIPTION_WORDS)
    )
    return F.concat(metas, described)


def description_sections(pages: DataFrame) -> DataFrame:
    """Description lines of every page in priority order: (page_id, section, kind, text).

    An element matched by several selectors appears once per selector.
    """
    sections = H.with_page(
        F.col("html"), lambda p: _sections(p["elements"], p["pieces"]), attrs=True, names=_SECTION_NAMES
    )
    return pages.select("page_id", F.posexplode(sections).alias("section", "s")).select(
        "page_id", "section", "s.kind", "s.text"
    )


def extraction_text_of(html: Column, limit: int = EXTRACTION_TEXT_LIMIT) -> Column:
    """What an extractor reads: description sections, a heading, then the page text.

    Over the limit the sections stay whole and the page text is cut, with ``...`` as the mark of the cut.
    """
    heading = F.lit(FULL_PAGE_HEADING)

    def parts(p: Column) -> Column:
        lines = F.transform(
            _sections(p["elements"], p["pieces"]), lambda s: F.concat(s["kind"], F.lit(": "), s["text"])
        )
        return F.struct(
            F.array_join(lines, "\n\n").alias("sections"), squeeze_text(F.array_join(p["texts"], "")).alias("body")
        )

    def whole(p: Column) -> Column:
        room = F.lit(limit) - F.length(p["sections"]) - 100
        size = F.length(p["sections"]) + len(FULL_PAGE_HEADING) + F.length(p["body"])
        return (
            F.when(size <= limit, F.concat(p["sections"], heading, p["body"]))
            .when(room > 0, F.concat(p["sections"], heading, F.substr(p["body"], F.lit(1), room), F.lit("...")))
            .otherwise(F.concat(p["sections"], F.lit("...")))
        )

    return let(H.with_page(html, parts, attrs=True, names=_SECTION_NAMES), whole)


def extraction_text(pages: DataFrame) -> DataFrame:
    """(page_id, text)."""
    return pages.select("page_id", extraction_text_of(F.col("html")).alias("text"))


def is_empty_text(text: Column) -> Column:
    """Blank text leads to an error record instead of an extraction."""
    return F.coalesce(strip(text) == "", F.lit(True))


def empty_text_pages(pages: DataFrame) -> DataFrame:
    """Pages without any text: (page_id, error)."""
    empty = F.when(is_empty_text(full_text_of(F.col("html"))), F.array(F.lit("No text content extracted")))
    return pages.select("page_id", F.explode(empty).alias("error"))


def pages_with_keywords(pages: DataFrame, keywords: list[str]) -> DataFrame:
    """Pages whose clean text or title holds any keyword, whatever its case: (page_id, url, title).

    Rows are kept by a generator: a filter would be pushed below a shuffle of its input and run there.
    """
    words = [k.lower() for k in keywords]

    def kept(title: Column) -> Column:
        searched = F.lower(F.concat(clean_text_of(F.col("html")), F.lit("\n"), title))
        return F.when(contains_any(searched, words), F.array(title))

    return pages.select("page_id", "url", F.explode(let(page_title(F.col("html")), kept)).alias("title"))


def content_ratio(pages: DataFrame) -> DataFrame:
    """Text length over markup length, both without script, style, meta and link: (page_id, ratio)."""
    def ratio(toks: Column) -> Column:
        kept = F.filter(
            toks, lambda t: ~t["kind"].isin("script", "style") & ~F.coalesce(t["tag"].isin("meta", "link"), F.lit(False))
        )
        size = F.reduce(kept, F.lit(0).cast("long"), lambda n, t: n + F.length(t["token"]))
        text = F.length(strip(F.array_join(H.text_pieces(toks), "")))
        return let(size, lambda n: F.when(n > 0, text / n).otherwise(0.0))

    return pages.select("page_id", let(H.classified(H.tokens(F.col("html"))), ratio).alias("ratio"))
