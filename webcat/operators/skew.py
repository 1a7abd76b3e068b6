"""Joins of rows on a key that may be hot, with a table that holds each key once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is heavy if it has more than one in so many of all rows; there are fewer heavy keys than this number.
HEAVY_ONE_IN = 2000


def _known(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def heavy_keys(rows: DataFrame, key: str | list[str], one_in: int = HEAVY_ONE_IN) -> DataFrame:
    """The keys of more than one in ``one_in`` of the rows without a null key: fewer than ``one_in`` rows."""
    keys = [key] if isinstance(key, str) else key
    counts = rows.filter(_known(keys)).groupBy(*keys).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n").alias("total"))
    return counts.filter(F.col("_n") * one_in > total.scalar()).select(*keys)


def join_unique(rows: DataFrame, lookup: DataFrame, key: str | list[str], how: str = "inner", one_in: int = HEAVY_ONE_IN) -> DataFrame:
    """``rows`` with the columns of ``lookup``, in which no ``key`` occurs twice; ``how`` is inner or left.

    Rows with a heavy key stay where they are and meet the few entries of heavy keys by broadcast; the others are
    shuffled, and no key among them is hot. Null keys match nothing; a left join leaves them where they are too.
    """
    if how not in ("inner", "left"):
        raise ValueError(how)
    keys = [key] if isinstance(key, str) else key
    hot = heavy_keys(rows, keys, one_in)
    flags = hot.select(*[F.col(k).alias(f"_hot_{i}") for i, k in enumerate(keys)])
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_hot_{i}") for i, k in enumerate(keys)])
    marked = rows.join(F.broadcast(flags), same, "left")
    few = F.broadcast(lookup.join(F.broadcast(hot), keys, "left_semi"))
    is_hot = F.col("_hot_0").isNotNull()
    stay = is_hot if how == "inner" else is_hot | ~_known(keys)
    there = marked.filter(stay).drop(*flags.columns).join(few, keys, how)
    moved = marked.filter(~is_hot & _known(keys)).drop(*flags.columns).join(lookup, keys, how)
    return moved.unionByName(there)
