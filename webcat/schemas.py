"""Schemas of pages, links, payloads and the twelve catalog tables, with their keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

S, L, I, D, TS = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.TimestampType()


def _struct(*fields: tuple) -> T.StructType:
    """(name, type) is nullable, (name, type, False) is not."""
    return T.StructType([T.StructField(f[0], f[1], f[2] if len(f) > 2 else True) for f in fields])


BEAN = _struct(
    ("name", S), ("weight", S), ("price", D), ("currency", S), ("description", S), ("producer", S),
    ("region", S), ("roast_level", S), ("flavor_notes", T.ArrayType(S)), ("grind_type", S), ("farm", S),
    ("altitude", I), ("process", S), ("agtron_roast_level", I), ("suitable_brew_types", T.ArrayType(S)),
    ("bean_type", S), ("variety", S),
)
MENU_ENTRY = _struct(
    ("name", S), ("price", S), ("description", S), ("category", S),
    ("size_options", T.ArrayType(S)), ("dietary_notes", T.ArrayType(S)),
)
LINK = _struct(
    ("url", S), ("source_page", S), ("discovery_method", S), ("link_type", S), ("status", S), ("notes", S)
)
LINKS_DOCUMENT = _struct(
    ("discovery_metadata", _struct(
        ("base_url", S), ("base_domain", S), ("site_name", S), ("timestamp", S), ("total_pages_scanned", L),
        ("total_links_found", L), ("failed_urls_count", L), ("crawler_config", T.MapType(S, S)),
        # of a site written as several documents: which one, and the place of its first entry in the site's lists
        ("part", L), ("first_entry", L),
    )),
    ("discovered_links", T.ArrayType(LINK)),
    ("source_pages", T.ArrayType(_struct(
        ("url", S), ("original_url", S), ("title", S), ("links_found", L), ("fetch_status", S),
        ("discovery_methods", T.ArrayType(S)),
    ))),
    ("failed_urls", T.ArrayType(S)),
)
PROCESSED_DOCUMENT = _struct(
    ("source_file", S), ("processed_at", S), ("coffee_beans", T.ArrayType(BEAN)), ("beans_found", I), ("error", S)
)
# both shapes of a site's summary; every field may be missing
SITE_SUMMARY = _struct(
    ("phase", S), ("timestamp", S), ("links_file_used", S), ("status_filter_used", S), ("total_links_in_file", L),
    ("filtered_links_count", L), ("successfully_scraped", L), ("failed_urls", T.ArrayType(S)),
    ("output_directory", S), ("base_url", S), ("base_domain", S), ("total_pages", L),
    ("visited_urls", T.ArrayType(S)), ("all_links", T.ArrayType(S)), ("saved_files", L),
    ("crawler_config", T.MapType(S, S)), ("part", L),
)

CATALOG = {
    "cafes": _struct(
        ("id", L, False), ("name", S, False), ("description", S), ("website", S), ("url", S), ("created_at", TS)
    ),
    "cafe_locations": _struct(
        ("id", L, False), ("cafe_id", L), ("address", S, False), ("city", S), ("state", S), ("country", S),
        ("postal_code", S), ("lat", T.DecimalType(9, 6)), ("lon", T.DecimalType(9, 6)), ("created_at", TS),
    ),
    "beans": _struct(
        ("id", L, False), ("name", S, False), ("description", S), ("weight", S), ("price", D), ("currency", S),
        ("proprietor", S), ("region_area", S), ("roast_level", S), ("flavor_notes", T.ArrayType(S)),
        ("grind_type", S), ("url", S), ("created_at", TS),
    ),
    "bean_specialties": _struct(
        ("bean_id", L, False), ("farm", S), ("altitude_masl", I), ("process", S), ("agtron_roast_level", I),
        ("suitable_brew_types", T.ArrayType(S)), ("bean_type", S), ("variety", S),
    ),
    "menu_items": _struct(
        ("id", L, False), ("location_id", L), ("name", S, False), ("description", S), ("price", D),
        ("currency", S), ("drink_type", S), ("url", S), ("created_at", TS),
    ),
    "cafe_location_beans": _struct(("location_id", L, False), ("bean_id", L, False)),
    "users": _struct(
        ("id", L, False), ("first_name", S, False), ("last_name", S, False), ("username", S, False),
        ("email", S, False), ("dob", T.DateType()), ("country", S), ("state", S), ("city", S),
        ("budget_range", S), ("created_at", TS),
    ),
    "user_preferences": _struct(
        ("user_id", L, False), ("brewing_method", S), ("roast_level_pref", S), ("consumption_frequency", S),
        ("flavor_or_caffeine_pref", S),
    ),
    "user_flavor_preferences": _struct(("user_id", L, False), ("flavor", S, False)),
    "user_liked_beans": _struct(("user_id", L, False), ("bean_id", L, False), ("liked_at", TS)),
    "user_liked_locations": _struct(("user_id", L, False), ("location_id", L, False), ("liked_at", TS)),
    "user_interactions": _struct(
        ("id", L, False), ("user_id", L), ("interaction", S, False), ("object_type", S, False),
        ("object_id", L, False), ("metadata", S), ("occurred_at", TS),
    ),
}
# child table, column, parent table; a deleted parent row takes its child rows with it
FOREIGN_KEYS = [
    ("cafe_locations", "cafe_id", "cafes"),
    ("bean_specialties", "bean_id", "beans"),
    ("menu_items", "location_id", "cafe_locations"),
    ("cafe_location_beans", "location_id", "cafe_locations"),
    ("cafe_location_beans", "bean_id", "beans"),
    ("user_preferences", "user_id", "users"),
    ("user_flavor_preferences", "user_id", "users"),
    ("user_liked_beans", "user_id", "users"),
    ("user_liked_beans", "bean_id", "beans"),
    ("user_liked_locations", "user_id", "users"),
    ("user_liked_locations", "location_id", "cafe_locations"),
    ("user_interactions", "user_id", "users"),
]
UNIQUE_KEYS = [
    ("cafes", ["id"]), ("cafe_locations", ["id"]), ("beans", ["id"]), ("bean_specialties", ["bean_id"]),
    ("menu_items", ["id"]), ("cafe_location_beans", ["location_id", "bean_id"]), ("users", ["id"]),
    ("users", ["username"]), ("users", ["email"]), ("user_preferences", ["user_id"]),
    ("user_flavor_preferences", ["user_id", "flavor"]), ("user_liked_beans", ["user_id", "bean_id"]),
    ("user_liked_locations", ["user_id", "location_id"]), ("user_interactions", ["id"]),
]
ENUM_COLUMNS = [
    ("beans", "currency", "currency"), ("beans", "roast_level", "roast_level"),
    ("beans", "grind_type", "grind_type"), ("bean_specialties", "bean_type", "bean_type"),
    ("bean_specialties", "suitable_brew_types", "brewing_method"), ("menu_items", "currency", "currency"),
    ("menu_items", "drink_type", "drink_type"), ("users", "budget_range", "budget_range"),
    ("user_preferences", "brewing_method", "brewing_method"),
    ("user_preferences", "roast_level_pref", "roast_level"),
    ("user_preferences", "consumption_frequency", "consumption_frequency"),
    ("user_preferences", "flavor_or_caffeine_pref", "flavor_or_caffeine_pref"),
    ("user_flavor_preferences", "flavor", "flavor_note"),
    ("user_interactions", "interaction", "interaction_type"),
]
# column filled with the load time when it is missing
TIMESTAMP_DEFAULTS = {
    "cafes": "created_at", "cafe_locations": "created_at", "beans": "created_at", "menu_items": "created_at",
    "users": "created_at", "user_liked_beans": "liked_at", "user_liked_locations": "liked_at",
    "user_interactions": "occurred_at",
}


def not_null_columns(table: str) -> list[str]:
    return [f.name for f in CATALOG[table].fields if not f.nullable]


def empty_catalog(spark: SparkSession) -> dict[str, DataFrame]:
    """The twelve tables without rows."""
    return {name: spark.createDataFrame([], schema) for name, schema in CATALOG.items()}


def conform(df: DataFrame, table: str) -> DataFrame:
    """The table's columns in order and type; missing ones become NULL. Constraints are checked, not cast."""
    from pyspark.sql import functions as F

    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in CATALOG[table].fields
    ])
