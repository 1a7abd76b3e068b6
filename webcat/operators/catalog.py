"""Catalog lookups, summaries and integrity: joins and aggregations over the twelve tables.

``catalog`` is a dict of table name -> DataFrame. Counts are reduced per key before they meet a join, so
a bean or user that holds a large part of all rows never lands in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webcat.operators.skew import join_unique
from webcat.schemas import CATALOG, FOREIGN_KEYS, TIMESTAMP_DEFAULTS, UNIQUE_KEYS, not_null_columns

Catalog = dict[str, DataFrame]


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def bean_with_specialty(catalog: Catalog) -> DataFrame:
    """Every bean with its specialty record, if any."""
    specialty = catalog["bean_specialties"].withColumnRenamed("bean_id", "id")
    return catalog["beans"].join(specialty, "id", "left")


def bean_locations(catalog: Catalog) -> DataFrame:
    """Where each bean is sold: (bean_id, bean_name, location_id, cafe_id, address)."""
    beans = catalog["beans"].select(F.col("id").alias("bean_id"), F.col("name").alias("bean_name"))
    places = catalog["cafe_locations"].select(F.col("id").alias("location_id"), "cafe_id", "address")
    return (
        join_unique(join_unique(catalog["cafe_location_beans"], beans, "bean_id"), places, "location_id")
        .select("bean_id", "bean_name", "location_id", "cafe_id", "address")
    )


def cafe_menu(catalog: Catalog) -> DataFrame:
    """Menu of every cafe: (cafe_id, cafe_name, location_id, address, item_id, item_name, price)."""
    cafes = catalog["cafes"].select(F.col("id").alias("cafe_id"), F.col("name").alias("cafe_name"))
    places = catalog["cafe_locations"].select(F.col("id").alias("location_id"), "cafe_id", "address")
    items = catalog["menu_items"].select(
        F.col("id").alias("item_id"), "location_id", F.col("name").alias("item_name"), "price"
    )
    return (
        items.join(places, "location_id")
        .join(cafes, "cafe_id")
        .select("cafe_id", "cafe_name", "location_id", "address", "item_id", "item_name", "price")
    )


def user_profiles(catalog: Catalog) -> DataFrame:
    """Users with their preferences and the sorted array of their flavours (at most one per enum value)."""
    flavours = catalog["user_flavor_preferences"].groupBy("user_id").agg(
        F.sort_array(F.collect_set("flavor")).alias("flavors")
    )
    users = catalog["users"].withColumnRenamed("id", "user_id")
    joined = users.join(catalog["user_preferences"], "user_id", "left").join(flavours, "user_id", "left")
    return joined.withColumn("flavors", F.coalesce("flavors", F.array().cast("array<string>")))


def like_counts(catalog: Catalog) -> DataFrame:
    """Likes per bean and per location: (object_type, object_id, n_likes, last_liked_at)."""
    def counted(table: str, key: str, label: str) -> DataFrame:
        return catalog[table].groupBy(F.col(key).alias("object_id")).agg(
            F.count("*").alias("n_likes"), F.max("liked_at").alias("last_liked_at")
        ).select(F.lit(label).alias("object_type"), "object_id", "n_likes", "last_liked_at")

    return counted("user_liked_beans", "bean_id", "bean").unionByName(
        counted("user_liked_locations", "location_id", "location")
    )


def interactions_with_context(
    interactions: DataFrame, fields: tuple[str, ...] = ("session_id", "referrer", "duration_s")
) -> DataFrame:
    """Interactions with fields of their JSON metadata as columns, NULL where absent or unreadable."""
    return interactions.withColumns({f: F.get_json_object("metadata", f"$.{f}") for f in fields})


def interaction_counts(interactions: DataFrame, number_field: str = "duration_s") -> DataFrame:
    """Per interaction and object type: n, n_users, and the sum of a numeric metadata field."""
    value = F.get_json_object("metadata", f"$.{number_field}").try_cast("long")
    return interactions.groupBy("interaction", "object_type").agg(
        F.count("*").alias("n"), F.count_distinct("user_id").alias("n_users"), F.sum(value).alias(f"sum_{number_field}")
    )


def catalog_objects(catalog: Catalog) -> DataFrame:
    """Everything an interaction may point to: (object_type, object_id, object_name)."""
    def named(table: str, name: str, label: str) -> DataFrame:
        return catalog[table].select(
            F.lit(label).alias("object_type"), F.col("id").alias("object_id"), F.col(name).alias("object_name")
        )

    return _union([
        named("beans", "name", "bean"), named("cafe_locations", "address", "location"),
        named("menu_items", "name", "menu_item"),
    ])


def object_lookup(catalog: Catalog) -> DataFrame:
    """Interactions with the name of what they point to; a dangling reference keeps a NULL name.

    A left join on (object_type, object_id). Interactions with a very popular object are not shuffled to one place: they
    meet the few objects of that kind by broadcast where they are.
    """
    return join_unique(catalog["user_interactions"], catalog_objects(catalog), ["object_type", "object_id"], "left")


# --- integrity ---------------------------------------------------------------------------------

def fk_violations(catalog: Catalog) -> DataFrame:
    """Values without a parent row: (table, column, value, n_rows). A NULL reference is allowed."""
    def dangling(child: str, column: str, parent: str) -> DataFrame:
        used = catalog[child].filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(
            F.count("*").alias("n_rows")
        )
        known = catalog[parent].select(F.col("id").alias("value"))
        return used.join(known, "value", "left_anti").select(
            F.lit(child).alias("table"), F.lit(column).alias("column"), "value", "n_rows"
        )

    return _union([dangling(*fk) for fk in FOREIGN_KEYS if fk[0] in catalog and fk[2] in catalog])


def unique_violations(catalog: Catalog) -> DataFrame:
    """Keys that occur more than once: (table, columns, key, n_rows). NULLs are no duplicates."""
    def repeated(table: str, columns: list[str]) -> DataFrame:
        rows = catalog[table].dropna(subset=columns)
        counts = rows.groupBy(*columns).agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") > 1)
        return counts.select(
            F.lit(table).alias("table"), F.lit(",".join(columns)).alias("columns"),
            F.concat_ws(",", *[F.col(c).cast("string") for c in columns]).alias("key"), "n_rows",
        )

    return _union([repeated(t, c) for t, c in UNIQUE_KEYS if t in catalog and set(c) <= set(catalog[t].columns)])


def not_null_violations(catalog: Catalog) -> DataFrame:
    """Missing required values: (table, column, n_rows). One scan per table."""
    def missing(table: str) -> DataFrame:
        columns = [c for c in not_null_columns(table) if c in catalog[table].columns]
        empty = F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns])
        found = catalog[table].select(F.explode(F.filter(empty, lambda c: c.isNotNull())).alias("column"))
        return found.groupBy("column").agg(F.count("*").alias("n_rows")).select(
            F.lit(table).alias("table"), "column", "n_rows"
        )

    return _union([missing(t) for t in CATALOG if t in catalog])


def cascade_delete(catalog: Catalog, table: str, ids: DataFrame) -> Catalog:
    """The catalog after deleting rows of ``table`` by id, with everything that depends on them.

    ``ids`` is (id). Tables are visited from parents to children; a child loses the rows whose parent is
    deleted and passes its own deleted ids on. New DataFrames are returned, nothing is written.
    """
    deleted = {table: ids.select("id").distinct()}
    result = dict(catalog)
    result[table] = catalog[table].join(deleted[table], "id", "left_anti")
    for child in [t for t in CATALOG if t in catalog and t != table]:
        hits = [(column, parent) for c, column, parent in FOREIGN_KEYS if c == child and parent in deleted]
        if not hits:
            continue
        for column, parent in hits:
            result[child] = result[child].join(
                deleted[parent].withColumnRenamed("id", column), column, "left_anti"
            ).select(*catalog[child].columns)
        if "id" in catalog[child].columns and any(parent == child for _, _, parent in FOREIGN_KEYS):
            deleted[child] = _union([
                catalog[child].join(deleted[parent].withColumnRenamed("id", column), column, "left_semi").select("id")
                for column, parent in hits
            ]).distinct()
    return result


def with_defaults(df: DataFrame, table: str, loaded_at: str) -> DataFrame:
    """Fill the table's time column where it is missing, with one timestamp for the whole load."""
    column = TIMESTAMP_DEFAULTS[table]
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(loaded_at).cast("timestamp")))
