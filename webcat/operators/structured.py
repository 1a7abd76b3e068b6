"""Structured data of pages: JSON-LD, microdata, meta tags, product blocks, contact details.

Span containment (a property inside an item, a price inside a product block) is tested inside the
page's own row, so there is no span join and no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webcat.functions import html as H
from webcat.functions.text import let, parsed_json, strip
from webcat.operators.content import has_class_part, page_title
from webcat.session import allow_repeated_keys

META_NAMES = ["description", "keywords", "author", "title"]
_PRODUCT = "struct<name:string,price:double,currency:string,description:string>"


def _attr(e: Column, name: str) -> Column:
    return H.attribute(e["attrs"], name)


def _attr_is(e: Column, name: str, value: str) -> Column:
    return F.coalesce(_attr(e, name) == value, F.lit(False))


# --- JSON-LD -----------------------------------------------------------------------------------

def _json_ld_array(tokens: Column) -> Column:
    """Tokens of a page -> array<struct<pos, item (JSON text)>> of its JSON-LD items, invalid scripts skipped.

    A repeated key (the last value counts) or a NaN (a text then) does not make a script invalid.
    """
    numbered = F.transform(tokens, lambda t, i: F.struct(i.alias("pos"), t.alias("token")))
    scripts = F.filter(
        numbered,
        lambda t: F.regexp_like(t["token"], F.lit(r"(?i)^<script\b"))
        & F.coalesce(H.attribute(H.attributes(t["token"]), "type") == "application/ld+json", F.lit(False)),
    )
    parsed = F.transform(
        scripts,
        lambda t: F.struct(t["pos"].alias("pos"), parsed_json(strip(H.script_body(t["token"]))).alias("value")),
    )

    def items(s: Column) -> Column:
        shape = F.schema_of_variant(s["value"])
        listed = F.try_variant_get(s["value"], "$", "array<variant>")
        values = F.when(F.startswith(shape, F.lit("ARRAY")), listed).when(
            F.startswith(shape, F.lit("OBJECT")), F.array(s["value"])
        )
        return F.transform(
            F.coalesce(values, F.array().cast("array<variant>")),
            lambda v: F.struct(s["pos"].alias("pos"), F.to_json(v).alias("item")),
        )

    return F.flatten(F.transform(F.filter(parsed, lambda s: s["value"].isNotNull()), items))


def json_ld_items(pages: DataFrame) -> DataFrame:
    """One row per JSON-LD item: (page_id, item_no, pos, type, item)."""
    return allow_repeated_keys(pages).select("page_id", F.posexplode(_json_ld_array(H.tokens(F.col("html")))).alias("item_no", "i")).select(
        "page_id", "item_no", "i.pos", F.get_json_object("i.item", "$.@type").alias("type"), "i.item"
    )


# --- microdata ---------------------------------------------------------------------------------

def _microdata_array(elements: Column, pieces: Column) -> Column:
    """array<struct<pos, type, properties array<struct<name, values>>>>; items without properties dropped."""
    def text_of(e: Column) -> Column:
        return H.text_between(pieces, e["pos"], e["end_pos"])

    def value_of(e: Column) -> Column:
        return (
            F.when(e["tag"] == "meta", _attr(e, "content"))
            .when(e["tag"] == "img", _attr(e, "src"))
            .when(e["tag"].isin("a", "link"), _attr(e, "href"))
            .when(e["tag"] == "time", F.coalesce(F.nullif(_attr(e, "datetime"), F.lit("")), text_of(e)))
            .otherwise(text_of(e))
        )

    marked = F.filter(
        F.transform(
            F.filter(elements, lambda e: H.has_attribute(e["attrs"], "itemprop")),
            lambda e: F.struct(
                e["pos"].alias("pos"), _attr(e, "itemprop").alias("name"), value_of(e).alias("value")
            ),
        ),
        lambda p: F.coalesce(p["value"] != "", F.lit(False)),
    )

    def scopes(properties: Column) -> Column:
        # properties are in page order, so those inside an item are a slice
        def sliced(rank: Column) -> Column:
            return F.transform(
                F.filter(elements, lambda e: H.has_attribute(e["attrs"], "itemscope")),
                lambda e: F.struct(
                    e["pos"].alias("pos"),
                    F.coalesce(_attr(e, "itemtype"), F.lit("")).alias("type"),
                    F.slice(properties, F.get(rank, e["pos"] + 1) + 1, H.between(rank, e["pos"], e["end_pos"])).alias("found"),
                ),
            )

        return let(H.ranks(F.transform(properties, lambda p: p["pos"]), F.size(pieces)), sliced)

    def grouped(s: Column) -> Column:
        names = F.array_distinct(F.transform(s["found"], lambda p: p["name"]))
        return F.struct(
            s["pos"].alias("pos"),
            s["type"].alias("type"),
            F.transform(
                names,
                lambda n: F.struct(
                    n.alias("name"),
                    F.transform(F.filter(s["found"], lambda p: p["name"] == n), lambda p: p["value"]).alias("values"),
                ),
            ).alias("properties"),
        )

    return F.filter(F.transform(let(marked, scopes), grouped), lambda s: F.size(s["properties"]) > 0)


# Only tags that hold these parts of names can have an attribute that the operators ask for.
_MICRODATA_NAMES = ["itemprop", "itemscope"]
_ORGANIZATION_NAMES = ["class", "itemprop"]
_PRODUCT_NAMES = ["class", "data-", "item"]


def _from_elements(html: Column, pick, names: list[str]) -> Column:
    """``pick(elements, pieces)`` on a page that is taken apart once, tags without any of the names left whole."""
    return H.with_page(html, lambda p: pick(p["elements"], p["pieces"]), attrs=True, names=names)


def microdata_items(pages: DataFrame) -> DataFrame:
    """One row per item property: (page_id, item_no, type, prop, values in document order)."""
    items = pages.select(
        "page_id", F.posexplode(_from_elements(F.col("html"), _microdata_array, _MICRODATA_NAMES)).alias("item_no", "i")
    )
    return items.select("page_id", "item_no", "i.type", F.explode("i.properties").alias("p")).select(
        "page_id", "item_no", "type", F.col("p.name").alias("prop"), F.col("p.values").alias("values")
    )


# --- meta tags ---------------------------------------------------------------------------------

def _open_tags(tokens: Column, tag: str) -> Column:
    """Attributes of every open tag of one name among a page's tokens: array<array<struct<name, value>>>. Needs no spans."""
    found = F.filter(tokens, lambda t: F.regexp_like(t, F.lit(rf"(?i)^<{tag}[\s/>]")))
    return F.transform(found, H.attributes)


def _meta_array(metas: Column) -> Column:
    """array<struct<name, content>>: the first meta of each name, if it has content."""
    rows = F.array(*[
        F.struct(
            F.lit(name).alias("name"),
            F.nullif(
                H.attribute(
                    F.get(F.filter(metas, lambda m: F.coalesce(H.attribute(m, "name") == name, F.lit(False))), F.lit(0)),
                    "content",
                ),
                F.lit(""),
            ).alias("content"),
        )
        for name in META_NAMES
    ])
    return F.filter(rows, lambda r: r["content"].isNotNull())


def _opengraph_array(metas: Column) -> Column:
    """array<struct<name, content>>: every ``og:*`` with content, the last one of a name wins."""
    og = F.filter(
        F.transform(
            metas,
            lambda m: F.struct(
                H.attribute(m, "property").alias("property"),
                F.coalesce(H.attribute(m, "content"), F.lit("")).alias("content"),
            ),
        ),
        lambda m: F.coalesce(F.startswith(m["property"], F.lit("og:")), F.lit(False)) & (m["content"] != ""),
    )

    def last_of_each(found: Column) -> Column:
        names = F.array_distinct(F.transform(found, lambda m: m["property"]))
        return F.transform(
            names,
            lambda n: F.struct(
                F.substr(n, F.lit(4)).alias("name"),
                F.element_at(F.filter(found, lambda m: m["property"] == n), -1)["content"].alias("content"),
            ),
        )

    return let(og, last_of_each)


def _meta_rows(pages: DataFrame, pick) -> DataFrame:
    rows = let(_open_tags(H.tokens(F.col("html")), "meta"), pick)
    return pages.select("page_id", F.explode(rows).alias("m")).select("page_id", "m.name", "m.content")


def meta_tags(pages: DataFrame) -> DataFrame:
    """description, keywords, author and title metas: (page_id, name, content)."""
    return _meta_rows(pages, _meta_array)


def opengraph(pages: DataFrame) -> DataFrame:
    """OpenGraph values, names without their prefix: (page_id, name, content)."""
    return _meta_rows(pages, _opengraph_array)


# --- product blocks ----------------------------------------------------------------------------

def parse_price(text: Column) -> Column:
    """First number of a price text; commas between thousands are dropped."""
    plain = F.regexp_replace(text, r"(?<=[0-9]),(?=[0-9]{3}(?:[^0-9]|$))", "")
    return F.regexp_extract(plain, r"\$?([0-9]+\.?[0-9]*)", 1).try_cast("double")


def _matching(rows: Column, condition) -> Column:
    return F.filter(rows, lambda r: condition(r["e"]))


def _first(elements: Column, condition) -> Column:
    return F.get(F.filter(elements, condition), F.lit(0))


def _product_array(elements: Column, pieces: Column) -> Column:
    """array<struct<pos, selector, product>> of every element a product selector matches."""
    def text_of(e: Column) -> Column:
        return H.text_between(pieces, e["pos"], e["end_pos"])

    def has_dollar(e: Column, tag: str) -> Column:
        return (e["tag"] == tag) & F.contains(text_of(e), F.lit("$"))

    selectors = [
        lambda e: has_class_part(e, "product"),
        lambda e: has_class_part(e, "item"),
        lambda e: has_class_part(e, "menu-item"),
        lambda e: H.has_attribute(e["attrs"], "data-product"),
        lambda e: F.coalesce(F.contains(_attr(e, "itemtype"), F.lit("Product")), F.lit(False)),
    ]
    names = [
        lambda e: has_class_part(e, "name"), lambda e: has_class_part(e, "title"),
        lambda e: e["tag"] == "h1", lambda e: e["tag"] == "h2", lambda e: e["tag"] == "h3",
        lambda e: H.has_attribute(e["attrs"], "data-name"), lambda e: _attr_is(e, "itemprop", "name"),
    ]
    prices = [
        lambda e: has_class_part(e, "price"), lambda e: H.has_attribute(e["attrs"], "data-price"),
        lambda e: _attr_is(e, "itemprop", "price"),
        lambda e: has_dollar(e, "span"), lambda e: has_dollar(e, "div"),
    ]
    descriptions = [
        lambda e: has_class_part(e, "description"), lambda e: has_class_part(e, "desc"), lambda e: e["tag"] == "p",
        lambda e: H.has_attribute(e["attrs"], "data-description"), lambda e: _attr_is(e, "itemprop", "description"),
    ]

    def product(s: Column) -> Column:
        inside = s["inside"]
        # coalesce stops at the first selector that matches anything
        name = let(F.coalesce(*[_first(inside, c) for c in names]), text_of)
        price = parse_price(let(F.coalesce(*[_first(inside, c) for c in prices]), text_of))
        description = F.coalesce(*[
            let(let(_first(inside, c), text_of), lambda text: F.when(F.length(text) > 20, text)) for c in descriptions
        ])
        return let(price, lambda p: F.struct(
            s["pos"].alias("pos"),
            s["selector"].alias("selector"),
            F.struct(
                name.alias("name"),
                p.alias("price"),
                F.when(p.isNotNull(), "USD").alias("currency"),
                description.alias("description"),
            ).cast(_PRODUCT).alias("product"),
        ))

    numbered = F.transform(elements, lambda e, i: F.struct(i.alias("i"), e.alias("e")))

    def candidates(rows: Column) -> Column:
        # elements are in document order: those inside one follow it, at most one per token position
        return F.concat(*[
            F.transform(
                _matching(rows, condition),
                lambda r: F.struct(
                    r["e"]["pos"].alias("pos"),
                    F.lit(rank).alias("selector"),
                    F.filter(
                        F.slice(elements, r["i"] + 2, r["e"]["end_pos"] - r["e"]["pos"]),
                        lambda c: c["pos"] < r["e"]["end_pos"],
                    ).alias("inside"),
                ),
            )
            for rank, condition in enumerate(selectors)
        ])

    return F.filter(
        F.transform(let(numbered, candidates), product), lambda p: F.coalesce(p["product"]["name"] != "", F.lit(False))
    )


def fallback_products(pages: DataFrame) -> DataFrame:
    """Products found by class names: (page_id, selector, pos, name, price, currency, description).

    An element that several selectors match gives one row per selector; blocks without a name give none.
    """
    rows = pages.select("page_id", F.explode(_from_elements(F.col("html"), _product_array, _PRODUCT_NAMES)).alias("p"))
    return rows.select("page_id", "p.selector", "p.pos", "p.product.*")


# --- organization ------------------------------------------------------------------------------

def _organization(title: Column, elements: Column, pieces: Column) -> Column:
    def texts_of(condition) -> Column:
        return F.transform(
            F.filter(elements, condition), lambda e: H.text_between(pieces, e["pos"], e["end_pos"])
        )

    def tagged(role: str, texts: Column) -> Column:
        has_number = lambda t: F.regexp_like(t, F.lit(r"[0-9]{3}[-.]?[0-9]{3}[-.]?[0-9]{4}"))
        field = {
            "phone": lambda t: F.lit("telephone"),
            "address": lambda t: F.when(has_number(t), "telephone").when(F.length(t) > 10, "address"),
            "contact": lambda t: F.when(has_number(t), "telephone"),
        }[role]
        return F.transform(texts, lambda t: F.struct(field(t).alias("field"), t.alias("text")))

    # in selector order, then document order; the last value of a field wins
    found = F.concat(
        tagged("contact", texts_of(lambda e: has_class_part(e, "contact"))),
        tagged("address", texts_of(lambda e: has_class_part(e, "address"))),
        tagged("phone", texts_of(lambda e: has_class_part(e, "phone"))),
        tagged("address", texts_of(lambda e: _attr_is(e, "itemprop", "address"))),
        tagged("phone", texts_of(lambda e: _attr_is(e, "itemprop", "telephone"))),
    )

    def last(values: Column, field: str) -> Column:
        return F.try_element_at(
            F.filter(values, lambda f: F.coalesce(f["field"] == field, F.lit(False))), F.lit(-1)
        )["text"]

    return let(found, lambda v: F.struct(
        title.alias("name"), last(v, "telephone").alias("telephone"), last(v, "address").alias("address")
    ))


def organization_info(pages: DataFrame) -> DataFrame:
    """(page_id, name, telephone, address) of every page that shows any of them."""
    title = F.nullif(page_title(F.col("html")), F.lit(""))
    found = _from_elements(
        F.col("html"), lambda elements, pieces: _organization(title, elements, pieces), _ORGANIZATION_NAMES
    )
    shown = let(found, lambda o: F.when(F.coalesce(o["name"], o["telephone"], o["address"]).isNotNull(), F.array(o)))
    return pages.select("page_id", F.explode(shown).alias("o")).select("page_id", "o.*")


# --- all of it ---------------------------------------------------------------------------------

def structured_data(pages: DataFrame) -> DataFrame:
    """Everything structured on a page, one row per page.

    ``intercepted_json_ld`` (array of JSON text caught while a page was rendered) is taken first where the
    column exists. ``extraction_methods`` names only the methods that found something.
    """
    intercepted = (
        F.coalesce(F.col("intercepted_json_ld"), F.array().cast("array<string>"))
        if "intercepted_json_ld" in pages.columns
        else F.array().cast("array<string>")
    )
    title = F.nullif(page_title(F.col("html")), F.lit(""))

    def parts(p: Column) -> Column:
        return F.struct(
            intercepted.alias("intercepted"),
            F.transform(_json_ld_array(p["toks"]["token"]), lambda i: i["item"]).alias("own"),
            _microdata_array(p["elements"], p["pieces"]).alias("microdata"),
            let(_open_tags(p["toks"]["token"], "meta"), lambda m: F.struct(
                F.map_from_entries(_meta_array(m)).alias("meta"), F.map_from_entries(_opengraph_array(m)).alias("og")
            )).alias("tags"),
            F.transform(_product_array(p["elements"], p["pieces"]), lambda x: x["product"]).alias("products"),
            _organization(title, p["elements"], p["pieces"]).alias("org"),
        )

    def assembled(x: Column) -> Column:
        has_org = F.coalesce(x["org"]["name"], x["org"]["telephone"], x["org"]["address"]).isNotNull()
        methods = F.array(
            F.when(F.size(x["intercepted"]) > 0, "intercepted_json_ld"),
            F.when(F.size(x["own"]) > 0, "page_json_ld"),
            F.when(F.size(x["microdata"]) > 0, "microdata"),
            F.when((F.size(x["tags"]["meta"]) > 0) | (F.size(x["tags"]["og"]) > 0), "meta_tags"),
            F.when((F.size(x["products"]) > 0) | has_org, "intelligent_fallback"),
        )
        return F.struct(
            F.concat(x["intercepted"], x["own"]).alias("json_ld"),
            x["microdata"].alias("microdata"),
            x["tags"]["meta"].alias("meta_tags"),
            x["tags"]["og"].alias("opengraph"),
            x["products"].alias("products"),
            F.when(has_org, x["org"]).alias("organization"),
            F.filter(methods, lambda m: m.isNotNull()).alias("extraction_methods"),
        )

    names = sorted({*_MICRODATA_NAMES, *_ORGANIZATION_NAMES, *_PRODUCT_NAMES})
    found = let(H.with_page(F.col("html"), parts, attrs=True, names=names), assembled)
    return allow_repeated_keys(pages).select("page_id", F.explode(F.array(found)).alias("s")).select("page_id", "s.*")
