"""Extracted-product payloads: JSON text -> checked, normalised rows -> catalog tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webcat.functions import normalize as N
from webcat.functions.text import strip
from webcat.functions.vocab import ENUMS, MISSING_DESCRIPTION, SHORT_DESCRIPTION
from webcat.schemas import BEAN, MENU_ENTRY, conform


def _entries(payload: Column) -> Column:
    """The texts of a list's items; NULL for broken JSON and for anything that is not a list."""
    return F.when(F.json_array_length(payload).isNotNull(), F.from_json(payload, "array<string>"))


def _as_number(text: Column, kind: T.DataType) -> Column:
    """Numbers given as numbers or as text, with a currency sign or thousands separators."""
    plain = F.regexp_extract(F.replace(text, F.lit(","), F.lit("")), r"-?[0-9]+(?:\.[0-9]+)?(?:[eE][-+]?[0-9]+)?", 0)
    return F.coalesce(text.try_cast("double"), plain.try_cast("double")).try_cast(kind)


def _parse(payloads: DataFrame, entry: T.StructType) -> DataFrame:
    """Items are parsed one by one, numbers as text first: an odd item or value does not void the others.

    Of a repeated key the last value counts; an item that is no object is a row without values.
    """
    numbers = {f.name: f.dataType for f in entry.fields if isinstance(f.dataType, T.NumericType)}
    texts = T.StructType([T.StructField(f.name, T.StringType() if f.name in numbers else f.dataType) for f in entry.fields])
    rows = payloads.select("source_file", F.posexplode_outer(_entries(F.col("payload"))).alias("idx", "item"))
    rows = rows.select("source_file", "idx", F.from_json("item", texts).alias("e"))
    return rows.select("source_file", "idx", *[
        (_as_number(F.col("e")[f.name], numbers[f.name]) if f.name in numbers else F.col("e")[f.name]).alias(f.name) for f in entry.fields
    ])


def parse_bean_payload(payloads: DataFrame) -> DataFrame:
    """(source_file, payload) -> one row per bean; a file without beans keeps one row with idx NULL."""
    return _parse(payloads, BEAN)


def parse_menu_payload(payloads: DataFrame) -> DataFrame:
    """(source_file, payload) -> one row per menu entry; a file without entries keeps one row with idx NULL."""
    return _parse(payloads, MENU_ENTRY)


def normalize_beans(beans: DataFrame) -> DataFrame:
    """Catalog spelling for every enum-like column of bean rows."""
    return beans.withColumns({
        "roast_level": N.normalize_roast(F.col("roast_level")),
        "grind_type": N.normalize_grind(F.col("grind_type")),
        "process": N.normalize_process(F.col("process")),
        "bean_type": N.normalize_bean_type(F.col("bean_type")),
        "suitable_brew_types": N.normalize_brew_list(F.col("suitable_brew_types")),
    })


BEAN_DOMAINS = {
    "currency": "currency", "roast_level": "roast_level", "grind_type": "grind_type", "bean_type": "bean_type",
    "suitable_brew_types": "brewing_method",
}
MENU_DOMAINS = {"category": "menu_category"}
BEAN_REQUIRED = ["name", "price", "description"]
MENU_REQUIRED = ["name", "category"]


def check_domain(rows: DataFrame, domains: dict[str, str], keys: list[str]) -> DataFrame:
    """One row per value outside its enum: (keys.., column, value). Arrays are checked per item."""
    types = {f.name: f.dataType for f in rows.schema.fields}

    def outside(column: str, enum: str) -> Column:
        values = F.col(column) if isinstance(types[column], T.ArrayType) else F.array(F.col(column))
        bad = F.filter(
            F.coalesce(values, F.array().cast("array<string>")), lambda v: v.isNotNull() & ~v.isin(ENUMS[enum])
        )
        return F.transform(bad, lambda v: F.struct(F.lit(column).alias("column"), v.alias("value")))

    found = F.concat(*[outside(column, enum) for column, enum in domains.items()])
    return rows.select(*keys, F.explode(found).alias("v")).select(*keys, "v.column", "v.value")


def check_required(rows: DataFrame, required: list[str], keys: list[str]) -> DataFrame:
    """One row per missing required value: (keys.., column)."""
    missing = F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required])
    return rows.select(*keys, F.explode(F.filter(missing, lambda c: c.isNotNull())).alias("column"))


def validate_description(beans: DataFrame) -> DataFrame:
    """Adds description_check (missing, short, ok) and fills a missing description; keeps every row."""
    text = F.coalesce(strip(F.col("description")), F.lit(""))
    return beans.withColumns({
        "description_check": F.when(text == "", "missing")
        .when(F.length(text) < SHORT_DESCRIPTION, "short")
        .otherwise("ok"),
        "description": F.when(text == "", MISSING_DESCRIPTION).otherwise(F.col("description")),
    })


def to_catalog(beans: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bean rows -> (beans, bean_specialties). Ids come from the natural key, never from a counter."""
    found = beans.filter(F.col("idx").isNotNull()).withColumn("id", F.xxhash64("source_file", "idx"))
    catalog_beans = conform(found.withColumnsRenamed({"producer": "proprietor", "region": "region_area"}), "beans")
    specialties = conform(found.withColumnsRenamed({"id": "bean_id", "altitude": "altitude_masl"}), "bean_specialties")
    return catalog_beans, specialties


def processing_results(beans: DataFrame) -> DataFrame:
    """Per file: beans_found; ``error`` is carried where the rows have it."""
    error = F.max("error") if "error" in beans.columns else F.lit(None).cast("string")
    return beans.groupBy("source_file").agg(F.count("idx").alias("beans_found"), error.alias("error"))


def processing_summary(results: DataFrame) -> DataFrame:
    """One row: files_processed, total_beans_found, average_beans."""
    totals = results.agg(
        F.count("*").alias("files_processed"),
        F.coalesce(F.sum("beans_found"), F.lit(0)).alias("total_beans_found"),
    )
    return totals.withColumn(
        "average_beans", F.col("total_beans_found") / F.greatest("files_processed", F.lit(1))
    )


def top_files(results: DataFrame, n: int = 10) -> DataFrame:
    """The n files with most beans; files without any are left out."""
    return (
        results.filter(F.col("beans_found") > 0)
        .select("source_file", "beans_found")
        .orderBy(F.desc("beans_found"), "source_file")
        .limit(n)
    )
