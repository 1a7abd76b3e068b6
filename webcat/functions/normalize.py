"""Spelling of product attributes (Column -> Column)."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from webcat.functions.text import strip
from webcat.functions.vocab import (
    BEAN_TYPE_VARIANTS,
    BREW_VARIANTS,
    ENUMS,
    GRIND_VARIANTS,
    PROCESS_VARIANTS,
    ROAST_VARIANTS,
)


def _spelled(value: Column, variants: dict[str, str]) -> Column:
    """Lower-case and trim, then the catalog spelling if the variant is known; blank gives NULL."""
    key = F.nullif(strip(F.lower(value)), F.lit(""))
    table = F.from_json(F.lit(json.dumps(variants)), "map<string,string>")  # folded into one literal
    return F.coalesce(F.try_element_at(table, key), key)


def normalize_roast(value: Column) -> Column:
    return _spelled(value, ROAST_VARIANTS)


def normalize_grind(value: Column) -> Column:
    return _spelled(value, GRIND_VARIANTS)


def normalize_process(value: Column) -> Column:
    return _spelled(value, PROCESS_VARIANTS)


def normalize_bean_type(value: Column) -> Column:
    return _spelled(value, BEAN_TYPE_VARIANTS)


def normalize_brew(value: Column) -> Column:
    return _spelled(value, BREW_VARIANTS)


def normalize_brew_list(values: Column) -> Column:
    """Each entry normalised, NULL entries dropped; nothing left gives NULL."""
    spelled = F.transform(F.filter(values, lambda v: v.isNotNull()), normalize_brew)
    return F.when(F.size(spelled) > 0, spelled)


def conforms(value: Column, enum: str) -> Column:
    """Is the value in the domain? NULL stays NULL; a value outside is kept elsewhere as free text."""
    return value.isin(ENUMS[enum])
