"""Token and element tables of stored pages. A page is taken apart inside its own row: no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webcat.functions import html as H


def page_tokens(pages: DataFrame) -> DataFrame:
    """One row per token: (page_id, pos, kind, tag, token)."""
    raw = pages.select("page_id", F.posexplode(H.tokens(F.col("html"))).alias("pos", "token"))
    kinds = raw.withColumn("kind", H.token_kind(F.col("token")))
    return kinds.select("page_id", "pos", "kind", H.token_tag(F.col("token"), F.col("kind")).alias("tag"), "token")


def page_elements(pages: DataFrame) -> DataFrame:
    """One row per element: (page_id, pos, end_pos, tag, attrs map)."""
    elements = H.with_page(F.col("html"), lambda p: p["elements"], attrs=True)
    rows = pages.select("page_id", F.explode(elements).alias("e"))
    return rows.select("page_id", "e.pos", "e.end_pos", "e.tag", H.attribute_map(F.col("e.attrs")).alias("attrs"))


def element_text(pages: DataFrame, tags: list[str] | None = None) -> DataFrame:
    """Text of every element, or of those with the given tags: (page_id, pos, tag, text).

    Stripped text fragments glued without a separator. The text of an element is a slice of the page's
    text array, so nested elements cost their own length and no span join is needed.
    """
    def texts(p):
        wanted = p["spans"] if tags is None else F.filter(p["spans"], lambda s: s["tag"].isin(tags))
        return F.transform(
            wanted,
            lambda s: F.struct(
                s["pos"].alias("pos"), s["tag"].alias("tag"),
                H.text_between(p["pieces"], s["pos"], s["end_pos"]).alias("text"),
            ),
        )

    return pages.select("page_id", F.explode(H.with_page(F.col("html"), texts)).alias("e")).select("page_id", "e.*")
