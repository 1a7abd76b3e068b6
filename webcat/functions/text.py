"""Small text helpers shared by every operator (Column -> Column)."""

from __future__ import annotations

import json
import re
from functools import reduce
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space, as Python's str.strip() removes it; Spark's trim() removes only U+0020.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
LINE_BREAKS = "\n\x0b\x0c\r\x1c\x1d\x1e\x85\u2028\u2029"

# the same white space as a pattern that Java and RE2 read alike
WORD_BREAK = (
    r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)


def strip(col: Column) -> Column:
    """Remove Unicode white space at both ends."""
    return F.btrim(col, F.lit(WHITESPACE))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once, as a lambda variable over a one-item array.

    A column that is used inside a lambda, or several times below a filter, is otherwise substituted at
    every use by the optimizer and worked out again each time, per element of the array in the worst case.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def parsed_json(text: Column) -> Column:
    """The variant of a JSON text, NULL for broken text. NaN and the infinities become texts.

    Of a repeated key the last value counts, in a session that went through ``session.allow_repeated_keys``.
    """
    def read(t: Column) -> Column:
        # the reader of lists knows NaN; it is asked only where the strict one fails
        plain = F.from_json(F.concat(F.lit("["), t, F.lit("]")), "array<string>", {"allowSingleQuotes": "false"})
        return F.coalesce(F.try_parse_json(t), let(plain, lambda p: F.when(F.size(p) == 1, F.try_parse_json(F.get(p, F.lit(0))))))

    return let(text, read)


def _alternatives(words: list[str]) -> str:
    return "(?:" + "|".join(re.escape(w) for w in words) + ")"


def contains_any(col: Column, words: list[str]) -> Column:
    return F.regexp_like(col, F.lit(_alternatives(words)))


def starts_with_any(col: Column, prefixes: list[str]) -> Column:
    return F.regexp_like(col, F.lit("^" + _alternatives(prefixes)))


def ends_with_any(col: Column, suffixes: list[str]) -> Column:
    return F.regexp_like(col, F.lit(_alternatives(suffixes) + r"\z"))


def occurrences(col: Column, needle: Column) -> Column:
    """How often ``needle`` occurs in ``col`` without overlap; 0 for an empty needle."""
    removed = F.length(col) - F.length(F.replace(col, needle, F.lit("")))
    return F.when(F.length(needle) > 0, (removed / F.length(needle)).cast("int")).otherwise(F.lit(0))


def squeeze_text(col: Column) -> Column:
    """Trim every line, cut lines at double spaces, drop blank pieces, join with one space."""
    # spaces are replaced by bytes: a pattern of two branches is slow on long texts
    pieces = F.transform(F.split(F.replace(col, F.lit("  "), F.lit("\n")), f"[{LINE_BREAKS}]"), strip)
    return F.array_join(F.filter(pieces, lambda p: p != ""), " ")


def _named_entities() -> Column:
    """The HTML5 entity names that end in a semicolon, folded into one map literal."""
    table = {name[:-1]: char for name, char in html5.items() if name.endswith(";") and name != "amp;"}
    return F.from_json(F.lit(json.dumps(table)), "map<string,string>")


def _code_point(number: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")


#: Numbers 128 to 159 stand for the characters of this code page, as in every HTML reader.
_LATIN = {i: bytes([i]).decode("cp1252", "ignore") for i in range(128, 160)}
_PIECE = r"&[^;&\s]{1,40};|[^&]+|&"


def decode_entities(col: Column) -> Column:
    """Decode named, decimal and hexadecimal character references in one pass.

    The text is cut into references and what lies between them, and each reference is replaced once, so ``&amp;lt;`` becomes
    ``&lt;`` and ``&#38;amp;`` becomes ``&amp;``. Unknown names and numbers stay as they are.
    """
    pieces = F.regexp_extract_all(col, F.lit(_PIECE), F.lit(0))
    decoded = F.array_join(F.transform(pieces, _decode_piece), "")
    return F.when(F.contains(col, F.lit("&")), decoded).otherwise(col)


def _decode_piece(piece: Column) -> Column:
    name = F.substring(piece, F.lit(2), F.length(piece) - 2)
    decimal = F.regexp_extract(name, "^#([0-9]{1,7})$", 1)
    hexadecimal = F.regexp_extract(name, "^#[xX]([0-9a-fA-F]{1,6})$", 1)
    number = F.when(decimal != "", decimal).when(hexadecimal != "", F.conv(hexadecimal, 16, 10)).cast("long")

    def character(n: Column) -> Column:
        mapped = F.element_at(F.array(*[F.lit(_LATIN[i] or chr(i)) for i in sorted(_LATIN)]), (n - 127).cast("int"))
        valid = n.between(1, 0x10FFFF) & ~n.between(0xD800, 0xDFFF)
        return F.when(n.between(128, 159), mapped).when(valid, _code_point(n)).otherwise(piece)

    common = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": "\u00a0", "copy": "\u00a9", "middot": "\u00b7", "amp": "&"}
    named = reduce(lambda c, pair: c.when(name == pair[0], F.lit(pair[1])), list(common.items())[1:], F.when(name == "lt", F.lit("<")))
    named = named.otherwise(F.coalesce(F.element_at(_named_entities(), name), piece))
    reference = F.startswith(piece, F.lit("&")) & F.endswith(piece, F.lit(";"))
    return F.when(~reference, piece).when(F.startswith(name, F.lit("#")), F.coalesce(let(number, character), piece)).otherwise(named)
