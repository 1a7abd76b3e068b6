"""Page tokens, attributes and element spans as column expressions.

Everything about one page stays in that page's row, so none of it needs a shuffle and all of it also
works on a stream. Only tag and text tokens are produced here; meaning is given by the operators.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from webcat.functions.text import decode_entities, let, strip
from webcat.functions.vocab import VOID_TAGS

# One match per token. Scripts, styles and comments are one token each; a tag may hold '>' inside
# quotes; '<' before anything but a letter, '/', '!' or '?' is text. The loops are unrolled and possessive:
# linear, and without the recursion that overflows the stack on thousands of repetitions.
TOKEN = (
    r"""(?is)<!--.*?-->"""
    r"""|<script\b[^>]*>.*?(?:</script\s*>|\z)"""
    r"""|<style\b[^>]*>.*?(?:</style\s*>|\z)"""
    r"""|</?[a-z][^'">]*(?:"[^"]*"[^'">]*|'[^']*'[^'">]*)*+>"""
    r"""|<[a-z/!?][^>]*>"""
    r"""|<?[^<]+(?:<[^a-z/!?<][^<]*)*+"""
)
# Group 1 is the name, group 2 the value without its quotes; a quote before it without one behind leaves the name alone.
ATTRIBUTE = r"""([^\s"'<>/=]+)(?:\s*=\s*["']?((?<=")[^"]*(?=")|(?<=')[^']*(?=')|(?<!["'])[^\s"'>]+)["']?)?"""
# '<' or '</' with the tag name; a bare '<' where no name follows
_HEAD = r"(?i)^(?:</?[a-z][^\s/>]*|<)"
# html.parser never treats these as containers here: their content is a single token
RAW_TAGS = ["script", "style"]


def tokens(html: Column) -> Column:
    """All tokens of a page in document order: array<string>."""
    return F.regexp_extract_all(html, F.lit(TOKEN), F.lit(0))


def token_kind(token: Column) -> Column:
    """comment, script, style, open, close, decl (doctype and the like) or text."""
    second = F.lower(F.substring(token, 2, 1))
    head = F.lower(F.substring(token, 1, 8))
    tagged = F.when(second == "/", F.when(F.lower(F.substring(token, 3, 1)).between("a", "z"), "close").otherwise("decl"))
    return (
        F.when(~F.startswith(token, F.lit("<")), "text")
        .when(F.startswith(token, F.lit("<!--")), "comment")
        .when((second == "s") & F.regexp_like(head, F.lit(r"^<script\b")), "script")
        .when((second == "s") & F.regexp_like(head, F.lit(r"^<style\b")), "style")
        .when(~F.endswith(token, F.lit(">")), "text")
        .when(second.between("a", "z"), "open")
        .when(second == "/", tagged)
        .when(second.isin("!", "?"), "decl")
        .otherwise("text")
    )


def token_tag(token: Column, kind: Column) -> Column:
    """Lower-case tag name, NULL for comments, declarations and text."""
    return F.when(
        kind.isin("open", "close", "script", "style"),
        F.lower(F.regexp_extract(token, r"^</?([a-zA-Z][^\s/>]*)", 1)),
    )


def classified(token_array: Column) -> Column:
    """array<string> -> array<struct<kind, tag, token>>."""
    return let(token_array, _with_kinds)


def _with_kinds(toks: Column) -> Column:
    heads = F.transform(
        toks, lambda t: F.when(F.startswith(t, F.lit("<")), F.lower(F.regexp_extract(t, _HEAD, 0))).otherwise("")
    )
    return F.zip_with(heads, toks, _classified)


def _classified(head: Column, token: Column) -> Column:
    """The kind and tag of a token. Text and ordinary tags show them by their heads; the others are looked at closely."""
    def found(kind: Column, tag: Column) -> Column:
        return F.struct(kind.alias("kind"), tag.alias("tag"), token.alias("token"))

    whole = F.endswith(token, F.lit(">"))
    raw = F.startswith(head, F.lit("<script")) | F.startswith(head, F.lit("<style"))
    size = F.length(head)
    closing = F.startswith(head, F.lit("</"))
    return (
        F.when(size == 0, found(F.lit("text"), F.lit(None).cast("string")))
        .when((size > 1) & closing & whole, found(F.lit("close"), F.substr(head, F.lit(3))))
        .when((size > 1) & ~closing & whole & ~raw, found(F.lit("open"), F.substr(head, F.lit(2))))
        .otherwise(found(token_kind(token), token_tag(token, token_kind(token))))
    )


def attributes(token: Column) -> Column:
    """Attributes of an open or script token: array<struct<name, value>>, names in lower case.

    Of a repeated attribute only the last one stays.
    """
    body = F.regexp_replace(F.regexp_extract(token, r"""^(<[a-zA-Z][^'">]*(?:"[^"]*"[^'">]*|'[^']*'[^'">]*)*+)""", 1),
                            r"^<[a-zA-Z][^\s/>]*", "")
    pairs = let(body, lambda b: F.zip_with(
        F.regexp_extract_all(b, F.lit(ATTRIBUTE), F.lit(1)), F.regexp_extract_all(b, F.lit(ATTRIBUTE), F.lit(2)),
        lambda name, value: F.struct(F.lower(name).alias("name"), decode_entities(value).alias("value")),
    ))
    # nothing follows the name of a tag without any of these
    return F.when(~F.regexp_like(token, F.lit(r"""[\s/"']""")), _no_attributes()).otherwise(let(pairs, _last_of_each_name))


def _no_attributes() -> Column:
    return F.array().cast("array<struct<name:string,value:string>>")


def _last_of_each_name(attrs: Column) -> Column:
    def kept(names: Column) -> Column:
        last = F.filter(
            attrs, lambda a, i: i == F.size(names) - F.array_position(F.reverse(names), a["name"])
        )
        return F.when(F.size(F.array_distinct(names)) < F.size(names), last).otherwise(attrs)

    return F.when(F.size(attrs) < 2, attrs).otherwise(let(attrs["name"], kept))


def attribute(attrs: Column, name: str) -> Column:
    """Value of an attribute, NULL when absent."""
    return F.get(F.filter(attrs, lambda a: a["name"] == name), F.lit(0))["value"]


def has_attribute(attrs: Column, name: str) -> Column:
    return F.exists(attrs, lambda a: a["name"] == name)


def attribute_map(attrs: Column) -> Column:
    """attrs -> map<string,string>."""
    return F.map_from_entries(attrs)


def text_pieces(toks: Column) -> Column:
    """Decoded text per token position, '' for every token that is not text: array<string>."""
    return F.transform(toks, lambda t: F.when(t["kind"] == "text", decode_entities(t["token"])).otherwise(""))


def stripped_pieces(pieces: Column) -> Column:
    return F.transform(pieces, strip)


def text_between(pieces: Column, pos: Column, end_pos: Column) -> Column:
    """Text of the tokens strictly between two positions, glued without separator."""
    return F.array_join(F.slice(pieces, pos + 2, F.greatest(end_pos - pos - 1, F.lit(0))), "")


def script_body(token: Column) -> Column:
    """Content of a script or style token."""
    return F.regexp_replace(token, r"(?is)^<(?:script|style)\b[^>]*>|</(?:script|style)\s*>$", "")


def element_spans(toks: Column) -> Column:
    """Element spans of a page: array<struct<pos, end_pos, tag>> ordered by pos; ``toks`` must be bound.

    A fold over the tag tokens that keeps the open elements on a stack: a closing tag ends the innermost
    open element of its name and everything opened inside it, a closing tag without an open element is
    ignored, and what is still open at the end of the page ends after the last token. Void and
    self-closed tags end where they start. Scripts and styles are single tokens and not elements.
    """
    events = F.transform(
        toks,
        lambda t, i: F.when(t["kind"].isin("open", "close"), F.struct(
            i.alias("pos"),
            t["tag"].alias("tag"),
            F.when(t["kind"] == "close", "close")
            .when(t["tag"].isin(VOID_TAGS) | F.endswith(t["token"], F.lit("/>")), "single")
            .otherwise("open")
            .alias("event"),
        )),
    )
    return let(F.filter(events, lambda e: e.isNotNull()), lambda bound: _spans_of_events(bound, F.size(toks)))


def _spans_of_events(events: Column, n_tokens: Column) -> Column:
    singles = F.transform(
        F.filter(events, lambda e: e["event"] == "single"),
        lambda e: F.struct(e["pos"].alias("pos"), e["pos"].alias("end_pos"), e["tag"].alias("tag")),
    )
    # a closing void tag never finds an open one on the stack
    walked = let(
        F.filter(events, lambda e: e["event"] != "single"), lambda paired: _leaves_first(paired, n_tokens, _LEAF_ROUNDS)
    )
    return F.sort_array(F.concat(walked, singles))


# Most elements hold no others, or only such: these rounds take them off, and the fold walks what is left.
_LEAF_ROUNDS = 3


def _leaves_first(paired: Column, n_tokens: Column, rounds: int) -> Column:
    """Spans of the opening and closing tags of a page, those of elements without open or closed ones inside first.

    An opening tag is ended by the closing tag of its name that comes next, whatever is open around it; without both
    the stack is the same for all others.
    """
    if rounds == 0:
        return _walk(paired, n_tokens)

    def ended(a: Column, b: Column) -> Column:
        return F.coalesce((a["event"] == "open") & (b["event"] == "close") & (a["tag"] == b["tag"]), F.lit(False))

    leaves = F.transform(paired, lambda e, i: F.when(ended(e, F.get(paired, i + 1)), F.struct(
        e["pos"].alias("pos"), F.get(paired, i + 1)["pos"].alias("end_pos"), e["tag"].alias("tag"))))
    rest = F.filter(paired, lambda e, i: ~ended(e, F.get(paired, i + 1)) & ~ended(F.get(paired, i - 1), e))
    return F.concat(
        F.filter(leaves, lambda s: s.isNotNull()), let(rest, lambda left: _leaves_first(left, n_tokens, rounds - 1))
    )


# A fold copies its state with every event. So events are walked in blocks: within a block the state holds the top of the
# stack and what the block adds to it; the chunks below are only looked at, and change from block to block.
_BLOCK = 256
_CHUNK = 64
_CHUNKS = "array<struct<names:array<string>,tag:array<string>,pos:array<int>>>"
_SPANS = "array<struct<pos:int,end_pos:int,tag:string>>"


def _walk(paired: Column, n_tokens: Column) -> Column:
    """Spans of the opening and closing tags of a page, in closing order.

    The stack is a list of chunks and a top. A chunk also knows the names that it holds, so a closing tag without an open
    element looks at each chunk once, and one that ends many elements takes their chunks off whole.
    """
    no_text, no_pos = F.array().cast("array<string>"), F.array().cast("array<int>")
    blocks = F.when(
        F.size(paired) > 0,
        F.transform(
            F.sequence(F.lit(0), F.size(paired) - 1, F.lit(_BLOCK)), lambda i: F.slice(paired, i + 1, F.lit(_BLOCK))
        ),
    ).otherwise(F.array().cast("array<array<struct<pos:int,tag:string,event:string>>>"))
    start = F.struct(
        F.array().cast(_CHUNKS).alias("full"), no_text.alias("open_tag"), no_pos.alias("open_pos"),
        F.array().cast(f"array<{_SPANS}>").alias("done"),
    )

    def next_block(acc: Column, block: Column) -> Column:
        fresh = F.struct(
            F.size(acc["full"]).alias("alive"), F.array().cast(_CHUNKS).alias("fresh"),
            acc["open_tag"].alias("open_tag"), acc["open_pos"].alias("open_pos"),
            no_text.alias("tag"), no_pos.alias("pos"), no_pos.alias("end_pos"),
            F.array().cast("array<struct<low:int,high:int,end_pos:int>>").alias("whole"),
        )
        return F.reduce(block, fresh, lambda state, e: _next_event(acc["full"], state, e), lambda r: F.struct(
            F.concat(F.slice(acc["full"], F.lit(1), r["alive"]), r["fresh"]).alias("full"),
            r["open_tag"].alias("open_tag"), r["open_pos"].alias("open_pos"),
            F.array_append(acc["done"], F.concat(
                _zipped(r["pos"], r["end_pos"], r["tag"]),
                F.flatten(F.transform(r["whole"], lambda w: _ended_chunks(
                    F.slice(acc["full"], w["low"] + 1, w["high"] - w["low"]), w["end_pos"]))),
            )).alias("done"),
        ))

    def finish(acc: Column) -> Column:
        top = F.struct(F.array_distinct(acc["open_tag"]).alias("names"), acc["open_tag"].alias("tag"), acc["open_pos"].alias("pos"))
        return F.concat(F.flatten(acc["done"]), _ended_chunks(F.array_append(acc["full"], top), n_tokens))

    return F.reduce(blocks, start, next_block, finish)


def _zipped(pos: Column, end_pos: Column, tag: Column) -> Column:
    return F.transform(
        F.arrays_zip(pos.alias("pos"), end_pos.alias("end_pos"), tag.alias("tag")),
        lambda z: F.struct(z["pos"].alias("pos"), z["end_pos"].alias("end_pos"), z["tag"].alias("tag")),
    )


def _ended_chunks(chunks: Column, end: Column) -> Column:
    """Spans of all elements of some chunks, ended at one position."""
    return F.flatten(F.transform(chunks, lambda c: F.transform(
        F.arrays_zip(c["pos"].alias("pos"), c["tag"].alias("tag")),
        lambda o: F.struct(o["pos"].alias("pos"), end.alias("end_pos"), o["tag"].alias("tag")),
    )))


def _from_end(values: Column, value) -> Column:
    """Place of the last such value, 1 for the last item, 0 if there is none."""
    return F.array_position(F.reverse(values), value).cast("int")


def _state(alive: Column, fresh: Column, tags: Column, places: Column) -> list[Column]:
    return [alive.alias("alive"), fresh.alias("fresh"), tags.alias("open_tag"), places.alias("open_pos")]


def _with_ended(acc: Column, tags: Column, places: Column, end: Column) -> list[Column]:
    """The spans finished within the block, with these as well."""
    return [
        F.concat(acc["tag"], tags).alias("tag"), F.concat(acc["pos"], places).alias("pos"),
        F.concat(acc["end_pos"], F.array_repeat(end, F.size(places))).alias("end_pos"),
    ]


def _changed(acc: Column, value: Column, body) -> Column:
    """``body(value)``, a state like ``acc``, with ``value`` worked out once."""
    return F.reduce(F.array(value), acc, lambda _, bound: body(bound))


def _next_event(full: Column, acc: Column, e: Column) -> Column:
    """One opening or closing tag against the stack: the first ``alive`` chunks of ``full``, the block's own, the top."""
    own, places, fresh, alive = acc["open_tag"], acc["open_pos"], acc["fresh"], acc["alive"]
    finished = [acc[c].alias(c) for c in ("tag", "pos", "end_pos", "whole")]
    none = F.slice(fresh, F.lit(1), F.lit(0))
    one_tag, one_pos = F.array(e["tag"]), F.array(e["pos"])
    chunk = F.struct(F.array_distinct(own).alias("names"), own.alias("tag"), places.alias("pos"))
    opened = F.when(
        F.size(own) < _CHUNK, F.struct(*_state(alive, fresh, F.concat(own, one_tag), F.concat(places, one_pos)), *finished)
    ).otherwise(F.struct(*_state(alive, F.array_append(fresh, chunk), one_tag, one_pos), *finished))

    def holding(chunks: Column) -> Column:
        return _from_end(F.transform(chunks, lambda c: F.array_contains(c["names"], e["tag"])), True)

    def within_top(n: Column) -> Column:
        keep = F.size(own) - n
        ended = F.struct(
            *_state(alive, fresh, F.slice(own, F.lit(1), keep), F.slice(places, F.lit(1), keep)),
            *_with_ended(acc, F.slice(own, keep + 1, n), F.slice(places, keep + 1, n), e["pos"]), acc["whole"].alias("whole"),
        )
        return (
            F.when(n > 0, ended)
            .when(F.size(fresh) + alive > 0, _changed(acc, holding(fresh), within_fresh))
            .otherwise(acc)
        )

    def cut(c: Column, above: Column, left_alive: Column, left_fresh: Column, whole: Column) -> Column:
        """The element is in chunk ``c``: what lies above it there, in the chunks ``above`` and in the top ends here."""
        n = _from_end(c["tag"], e["tag"])
        keep = F.size(c["tag"]) - n
        return F.struct(
            *_state(left_alive, left_fresh, F.slice(c["tag"], F.lit(1), keep), F.slice(c["pos"], F.lit(1), keep)),
            *_with_ended(acc, F.concat(F.slice(c["tag"], keep + 1, n), F.flatten(above["tag"]), own),
                         F.concat(F.slice(c["pos"], keep + 1, n), F.flatten(above["pos"]), places), e["pos"]),
            whole.alias("whole"),
        )

    def within_fresh(k: Column) -> Column:
        at = F.size(fresh) - k
        here = _changed(acc, F.get(fresh, at), lambda c: cut(
            c, F.slice(fresh, at + 2, F.greatest(k - 1, F.lit(0))), alive, F.slice(fresh, F.lit(1), at), acc["whole"]))
        return F.when(k > 0, here).when(
            alive > 0, _changed(acc, holding(F.slice(full, F.lit(1), alive)), within_full)).otherwise(acc)

    def within_full(k: Column) -> Column:
        at = alive - k
        ended = F.array_append(acc["whole"], F.struct((at + 1).alias("low"), alive.alias("high"), e["pos"].alias("end_pos")))
        here = _changed(acc, F.get(full, at), lambda c: cut(c, fresh, at, none, ended))
        return F.when(k > 0, here).otherwise(acc)

    return F.when(e["event"] == "open", opened).otherwise(_changed(acc, _from_end(own, e["tag"]), within_top))


def ranks(positions: Column, n: Column) -> Column:
    """For each t from 0 to ``n`` how many of the ascending ``positions`` (not above ``n``) are below t: array<int>.

    The number of positions strictly between a and b is ``ranks[b] - ranks[a + 1]``: containment without a loop over pairs.
    """
    def spread(bounds: Column) -> Column:
        return F.flatten(F.transform(
            bounds, lambda p, i: F.array_repeat(i, p - F.coalesce(F.get(bounds, i - 1), F.lit(-1)))
        ))

    return let(F.concat(positions, F.array(n)), spread)


def between(rank: Column, pos: Column, end_pos: Column) -> Column:
    """How many of the ranked positions lie strictly between two token positions."""
    return F.greatest(F.get(rank, end_pos) - F.get(rank, pos + 1), F.lit(0))


def page(html: Column, *, attrs: bool = False) -> Column:
    """A page taken apart, as ``with_page`` binds it. An expression that reads parts of it is better given to that."""
    return with_page(html, lambda p: p, attrs=attrs)


def with_page(
    html: Column, body: Callable[[Column], Column], *, attrs: bool = False, names: list[str] | None = None
) -> Column:
    """``body(p)`` of a page taken apart once, p being struct<toks, spans, texts, pieces[, elements]>.

    ``toks`` are its tokens, ``spans`` its elements, ``texts`` the decoded text per token position and
    ``pieces`` the same stripped; with ``attrs`` the ``elements`` are the spans with their attributes. They are bound here
    and not given back, as the result of a binding is copied with all its arrays. With ``names``, parts of attribute names,
    only tags that hold one of them are taken apart; the elements of others come without attributes.
    """
    def with_spans(toks: Column) -> Column:
        return let(
            F.struct(element_spans(toks).alias("spans"), text_pieces(toks).alias("texts")),
            lambda p: let(F.struct(
                toks.alias("toks"), p["spans"].alias("spans"), p["texts"].alias("texts"),
                stripped_pieces(p["texts"]).alias("pieces"),
                *([_with_attributes(p["spans"], toks, names).alias("elements")] if attrs else []),
            ), body),
        )

    return let(tokens(html), lambda raw: let(_with_kinds(raw), with_spans))


def _with_attributes(spans: Column, toks: Column, names: list[str] | None) -> Column:
    def of(token: Column) -> Column:
        if names is None:
            return attributes(token)
        # names are compared after lower-casing, hence the Unicode flag
        return F.when(F.regexp_like(token, F.lit("(?iu)" + "|".join(names))), attributes(token)).otherwise(_no_attributes())

    return F.transform(
        spans,
        lambda s: F.struct(
            s["pos"].alias("pos"), s["end_pos"].alias("end_pos"), s["tag"].alias("tag"),
            of(F.get(toks, s["pos"])["token"]).alias("attrs"),
        ),
    )
