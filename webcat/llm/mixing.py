"""Mixing sources to target weights by Poisson replication.

Each source gets a rate, its share of the wanted characters over the characters it has. A document's number of copies is
the inverse of the Poisson distribution with that mean at a number in (0, 1) that the hash of seed and id fixes, so a
run can be repeated and rows need no order. Copies are exploded and shuffled globally by a hash of id and copy.

Cases: a null source is a source of its own; one without weight gets rate 0. A null or empty text has no
characters, its document is copied like the others of its source; a source without any characters keeps rate 1. Without an
id the text's hash stands in for it. Repeated rows get equally many copies. An empty table gives an empty result. Columns
may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webcat.llm.common import checked_broadcast, parallelism, saved, whole_row

#: A larger mean is drawn as a sum of independent parts, as exp(-mean) would vanish.
PART = 256.0


def _uniform(*parts: Column | str) -> Column:
    """In (0, 1): 52 bits of an MD5 digest."""
    digits = F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)


def source_rates(
    docs: DataFrame, weights: dict[str | None, float] | None = None, epochs: float = 1.0,
    source_col: str = "source", text_col: str = "text",
) -> DataFrame:
    """(source, n_docs, chars, rate). ``weights`` by source, or None for the square root of each source's characters;
    ``epochs`` times all characters are wanted in total."""
    sizes = docs.groupBy(F.col(source_col).cast("string").alias("source")).agg(
        F.count("*").alias("n_docs"), F.sum(F.coalesce(F.length(text_col), F.lit(0)).cast("long")).alias("chars")
    )
    if weights is None:
        weight = F.sqrt("chars")
    else:
        weight = F.coalesce(*[F.when(F.col("source").eqNullSafe(F.lit(s)), F.lit(float(w))) for s, w in weights.items()], F.lit(0.0))
    sizes = saved(sizes.withColumn("weight", weight), "sources")
    total = sizes.agg(F.sum("chars").alias("chars"), F.sum(F.when(F.col("chars") > 0, F.col("weight"))).alias("weight")).first()
    wanted, weighed = float(total["chars"] or 0) * epochs, float(total["weight"] or 0.0)
    share = F.col("weight") / weighed if weighed else F.lit(0.0)
    rate = F.when(F.col("chars") == 0, F.lit(1.0)).otherwise(share * wanted / F.col("chars"))
    return sizes.select("source", "n_docs", "chars", rate.alias("rate"))


def _table(rate: Column) -> Column:
    """Cumulative probabilities of 0, 1, 2 ... with the mean ``rate``, so far that the rest is below 2**-53."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 30).cast("int")
    start = F.struct(F.exp(-rate).alias("p"), F.array(F.exp(-rate)).alias("cdf"))
    return F.aggregate(
        F.sequence(F.lit(1), last), start,
        lambda s, k: F.struct(
            (s["p"] * rate / k).alias("p"),
            F.concat(s["cdf"], F.array(F.element_at(s["cdf"], -1) + s["p"] * rate / k)).alias("cdf"),
        ),
    )["cdf"]


def mix(
    docs: DataFrame, weights: dict[str | None, float] | None = None, epochs: float = 1.0, seed: str = "mix",
    id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", copy_cols: tuple[str, str] | None = None,
) -> DataFrame:
    """The input's columns, a row for each copy, in global random order; ``copy_cols`` adds copy number and shuffle key."""
    rates = source_rates(docs, weights, epochs, source_col, text_col)
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / PART)).cast("int")
    tables = rates.withColumn("parts", parts).select(F.col("source").alias("rated"), "parts", _table(F.col("rate") / F.col("parts")).alias("cdf"))
    tables = checked_broadcast(saved(tables, "rates"), 500, array="cdf")
    text = F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    rows = docs.select(
        whole_row(docs), F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("text "), text)).alias("ident"),
        F.col(source_col).cast("string").alias("source"),
    ).join(tables, F.col("source").eqNullSafe(F.col("rated")))
    # the numbers are drawn before they are looked up, each once
    numbers = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda part: _uniform(F.lit(seed), part.cast("string"), F.col("ident")))
    draws = F.transform(numbers, lambda u: F.size(F.filter("cdf", lambda c: u > c)))
    copies = F.aggregate(draws, F.lit(0), lambda total, n: total + n)
    rows = rows.withColumn("copies", copies).filter("copies > 0")
    rows = rows.select("row", "ident", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    rows = rows.withColumn("order", F.md5(F.concat_ws(":", F.lit(seed), F.lit("order"), "ident", F.col("copy").cast("string"))))
    mixed = rows.repartition(parallelism(docs), "order").sortWithinPartitions("order")
    extra = [F.col("copy").alias(copy_cols[0]), F.col("order").alias(copy_cols[1])] if copy_cols else []
    return mixed.select("row.*", *extra)
