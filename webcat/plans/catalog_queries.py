"""Registered queries: payloads, normalisation, catalog, integrity."""

from __future__ import annotations

from pyspark.sql import functions as F

from webcat.functions import normalize as N
from webcat.operators import catalog as C
from webcat.operators import payload as P
from webcat.plans import sqltext as Q
from webcat.plans.inputs import (
    BEAN_TYPES,
    BREWS,
    CATEGORIES,
    FLAVORS,
    GRINDS,
    PROCESS_NAMES,
    PROCESSES,
    ROAST_LEVELS,
    ROASTS,
    bean_payloads,
    broken_catalog,
    catalog,
    menu_payloads,
    pick,
    table,
)

# --- payloads ----------------------------------------------------------------------------------


def _beans(spark, sf_dir):
    return P.parse_bean_payload(bean_payloads(spark, sf_dir))


def bean_rows(spark, sf_dir):
    return _beans(spark, sf_dir).select(
        "source_file", "idx", "name", "price", "currency", "description", "producer", "roast_level", "grind_type",
        "altitude", "suitable_brew_types",
    )


def menu_rows(spark, sf_dir):
    return P.parse_menu_payload(menu_payloads(spark, sf_dir)).select(
        "source_file", "idx", "name", "price", "category", "size_options"
    )


def domain_checks(spark, sf_dir):
    beans = P.normalize_beans(_beans(spark, sf_dir))
    found = P.check_domain(beans, P.BEAN_DOMAINS, ["source_file", "idx"])
    menu = P.parse_menu_payload(menu_payloads(spark, sf_dir)).withColumn("category", F.lower("category"))
    return found.unionByName(P.check_domain(menu, P.MENU_DOMAINS, ["source_file", "idx"]))


def required_checks(spark, sf_dir):
    beans = _beans(spark, sf_dir).filter(F.col("idx").isNotNull())
    menu = P.parse_menu_payload(menu_payloads(spark, sf_dir)).filter(F.col("idx").isNotNull())
    keys = ["source_file", "idx"]
    return P.check_required(beans, P.BEAN_REQUIRED, keys).unionByName(P.check_required(menu, P.MENU_REQUIRED, keys))


def description_checks(spark, sf_dir):
    return P.validate_description(_beans(spark, sf_dir).filter(F.col("idx").isNotNull())).select(
        "source_file", "idx", "description_check", "description"
    )


def catalog_beans(spark, sf_dir):
    beans, _ = P.to_catalog(P.validate_description(P.normalize_beans(_beans(spark, sf_dir))))
    return beans.drop("id", "created_at", "flavor_notes")


def catalog_specialties(spark, sf_dir):
    # joined back to the beans: both halves must carry the same id
    beans, specialties = P.to_catalog(P.normalize_beans(_beans(spark, sf_dir)))
    return specialties.join(beans.select("id", "name", "proprietor"), F.col("bean_id") == F.col("id")).select(
        "name", "proprietor", "altitude_masl", "process", "bean_type", "suitable_brew_types", "variety"
    )


def _spelled(name: str, values: list[str], normalize, enum: str):
    """Every variant by part, its normal form and whether that is in the domain."""
    def query(spark, sf_dir):
        raw = pick(values, F.col("p_partkey"))
        rows = table(spark, sf_dir, "part").select("p_partkey", raw.alias("raw"), normalize(raw).alias("normal"))
        return rows.select("*", N.conforms(F.col("normal"), enum).alias("conforms"))

    query.__name__ = name
    return query


# raw spelling -> (normal form, in domain)
_ROAST = {"Light": ("light", True), "CITY+": ("medium", True), " Vienna ": ("medium_dark", True),
          "medium-light": ("medium_light", True), "Omni": ("omni", False), "": (None, None),
          "EXTRA_DARK": ("extra_dark", True), "full city": ("medium", True)}
_GRIND = {"Whole Bean": ("whole", True), "pre-ground": ("ground", False), "FINE": ("fine", True),
          "beans": ("whole", True), "Moka": ("moka", False)}
_PROCESS = {"Washed": ("washed", True), "sun-dried": ("natural", True), "Giling Basah": ("wet_hulled", True),
            "Anaerobic": ("anaerobic", False), "semi-washed": ("honey", True), "pulped natural": ("pulped_natural", True)}
_BEAN_TYPE = {"Coffea Arabica": ("arabica", True), "ROBUSTA": ("robusta", True), "excelsa": ("excelsa", True),
              "Hybrid": ("hybrid", False)}
_BREW = {"V60": ("pour_over", True), "Siphon": ("siphon", True), "drip": ("drip_filter", True),
         "French-Press": ("french_press", True), "Aero Press": ("aeropress", True), "OTHER": ("other", True)}


def norm_brew_lists(spark, sf_dir):
    k = F.col("p_partkey")
    raw = F.when(k % 5 == 0, F.array().cast("array<string>")).otherwise(
        F.array(pick(BREWS, k), F.lit(None), pick(BREWS, k + 1))
    )
    return table(spark, sf_dir, "part").select("p_partkey", N.normalize_brew_list(raw).alias("brew_types"))


def enum_conformance(spark, sf_dir):
    """Values in and out of the domain per column, after normalising."""
    b = P.normalize_beans(_beans(spark, sf_dir)).filter(F.col("idx").isNotNull())
    rows = b.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), N.conforms(F.col(c), e).alias("ok"))
        for c, e in [("roast_level", "roast_level"), ("grind_type", "grind_type"), ("process", "process"), ("bean_type", "bean_type")]
    ])).alias("r"))
    return rows.groupBy("r.column").agg(
        F.count_if(F.col("r.ok")).alias("n_conforming"), F.count_if(~F.col("r.ok")).alias("n_free_text"),
        F.count_if(F.col("r.ok").isNull()).alias("n_missing"),
    )


def file_results(spark, sf_dir):
    return P.processing_results(_beans(spark, sf_dir)).select("source_file", "beans_found")


def processing_summary(spark, sf_dir):
    return P.processing_summary(P.processing_results(_beans(spark, sf_dir)))


def top_files(spark, sf_dir):
    return P.top_files(P.processing_results(_beans(spark, sf_dir)))


# --- catalog -----------------------------------------------------------------------------------

def bean_with_specialty(spark, sf_dir):
    return C.bean_with_specialty(catalog(spark, sf_dir)).select("id", "name", "price", "roast_level", "process", "altitude_masl")


def bean_locations(spark, sf_dir):
    return C.bean_locations(catalog(spark, sf_dir))


def cafe_menu(spark, sf_dir):
    return C.cafe_menu(catalog(spark, sf_dir))


def user_profiles(spark, sf_dir):
    return C.user_profiles(catalog(spark, sf_dir)).select("user_id", "username", "budget_range", "roast_level_pref", "flavors")


def like_counts(spark, sf_dir):
    return C.like_counts(catalog(spark, sf_dir))


def interaction_counts(spark, sf_dir):
    return C.interaction_counts(catalog(spark, sf_dir)["user_interactions"], "k")


def interaction_context(spark, sf_dir):
    rows = catalog(spark, sf_dir)["user_interactions"]
    return C.interactions_with_context(rows, ("k", "session_id")).select("id", "interaction", "k", "session_id")


def object_lookup(spark, sf_dir):
    return C.object_lookup(catalog(spark, sf_dir)).select("id", "object_type", "object_id", "object_name")


def fk_violations(spark, sf_dir):
    return C.fk_violations(broken_catalog(spark, sf_dir))


def unique_violations(spark, sf_dir):
    return C.unique_violations(broken_catalog(spark, sf_dir))


def null_violations(spark, sf_dir):
    return C.not_null_violations(broken_catalog(spark, sf_dir))


def cascade_delete(spark, sf_dir):
    """Rows left in every table after cafes of one region are deleted, and after the users of one segment are."""
    whole = catalog(spark, sf_dir)
    cafes = table(spark, sf_dir, "nation").filter(F.col("n_regionkey") == 1).select(F.col("n_nationkey").cast("long").alias("id"))
    users = table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == "MACHINERY").select(F.col("c_custkey").alias("id"))
    left = C.cascade_delete(C.cascade_delete(whole, "cafes", cafes), "users", users)
    counts = None
    for name, rows in left.items():
        n = rows.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table"), "n_rows")
        counts = n if counts is None else counts.unionByName(n)
    return counts


LOADED_AT = "2024-06-01 00:00:00"


def defaults(spark, sf_dir):
    tables = catalog(spark, sf_dir)
    filled = C.with_defaults(tables["beans"], "beans", LOADED_AT).select("id", F.col("created_at").alias("at"), F.lit("beans").alias("table"))
    kept = C.with_defaults(tables["user_interactions"], "user_interactions", LOADED_AT).select(
        "id", F.col("occurred_at").alias("at"), F.lit("user_interactions").alias("table"))
    return filled.unionByName(kept)


QUERIES = {f.__name__: f for f in [
    bean_rows, menu_rows, domain_checks, required_checks, description_checks, catalog_beans, catalog_specialties,
    _spelled("norm_roast", ROASTS, N.normalize_roast, "roast_level"),
    _spelled("norm_grind", GRINDS, N.normalize_grind, "grind_type"),
    _spelled("norm_process", PROCESSES, N.normalize_process, "process"),
    _spelled("norm_bean_type", BEAN_TYPES, N.normalize_bean_type, "bean_type"),
    _spelled("norm_brew", BREWS, N.normalize_brew, "brewing_method"),
    norm_brew_lists, enum_conformance, file_results, processing_summary, top_files, bean_with_specialty,
    bean_locations, cafe_menu, user_profiles, like_counts, interaction_counts, interaction_context, object_lookup, fk_violations,
    unique_violations, null_violations, cascade_delete, defaults,
]}


# --- check SQL ---------------------------------------------------------------------------------

def _list(values) -> str:
    return "[" + ", ".join("NULL" if v is None else str(v).lower() if isinstance(v, bool) else Q.quoted(v) for v in values) + "]"


def _pick(values, index: str) -> str:
    return f"({_list(values)})[({index}) % {len(values)} + 1]"


def _mapped(values, table_, index: str, part: int) -> str:
    return _pick([table_[v][part] for v in values], index)


# bean payloads as rows, straight from part: bean(k, source_file, idx, ..)
_BEANS = f"""
WITH good AS (SELECT *, p_partkey AS k, 'part_' || p_partkey || '.html' AS source_file FROM part),
bean AS (
  SELECT k, source_file, CAST(n AS INTEGER) AS idx, p_name || ' ' || n AS name,
    CASE WHEN k % 19 <> 0 THEN p_retailprice END AS price, CASE WHEN k % 4 = 0 THEN 'XYZ' ELSE 'USD' END AS currency,
    CASE WHEN k % 13 = 0 THEN NULL WHEN k % 13 = 1 THEN 'short' WHEN k % 13 = 2 THEN ' '
         ELSE 'Tasting notes for ' || p_name || ' of ' || p_brand END AS description,
    p_brand AS producer, {_pick(ROASTS, 'k + n')} AS roast_level, {_pick(GRINDS, 'k + n')} AS grind_type,
    CAST(p_size * 50 AS INTEGER) AS altitude,
    CASE WHEN k % 5 = 0 THEN CAST([] AS VARCHAR[]) ELSE [{_pick(BREWS, 'k')}, NULL, {_pick(BREWS, 'k + 1')}] END AS suitable_brew_types,
    {_mapped(ROASTS, _ROAST, 'k + n', 0)} AS roast, {_mapped(ROASTS, _ROAST, 'k + n', 1)} AS roast_ok,
    {_mapped(GRINDS, _GRIND, 'k + n', 0)} AS grind, {_mapped(GRINDS, _GRIND, 'k + n', 1)} AS grind_ok,
    {_mapped(PROCESSES, _PROCESS, 'k + n', 0)} AS process, {_mapped(PROCESSES, _PROCESS, 'k + n', 1)} AS process_ok,
    {_mapped(BEAN_TYPES, _BEAN_TYPE, 'k + n', 0)} AS bean_type, {_mapped(BEAN_TYPES, _BEAN_TYPE, 'k + n', 1)} AS bean_type_ok,
    CASE WHEN k % 5 <> 0 THEN [{_mapped(BREWS, _BREW, 'k', 0)}, {_mapped(BREWS, _BREW, 'k + 1', 0)}] END AS brews
  FROM good, (SELECT unnest([0, 1]) AS n)
  WHERE k % 11 <> 0 AND k % 17 <> 0 AND (n = 0 OR k % 2 = 0)
),
barren AS (SELECT source_file FROM good WHERE k % 11 = 0 OR k % 17 = 0)"""
_MENU = f"""
WITH menu AS (
  SELECT 'menu_' || s_suppkey AS source_file, 0 AS idx, s_name AS name,
    CASE WHEN s_suppkey % 6 <> 0 THEN {_pick(CATEGORIES, 's_suppkey')} END AS category
  FROM supplier WHERE s_suppkey % 7 <> 0
)"""


def _norm_sql(values, table_) -> str:
    return f"""
SELECT p_partkey, {_pick(values, 'p_partkey')} AS raw, {_mapped(values, table_, 'p_partkey', 0)} AS normal,
  {_mapped(values, table_, 'p_partkey', 1)} AS conforms FROM part"""


_CHECK = "CASE WHEN description IS NULL OR description = ' ' THEN 'missing' WHEN length(description) < 20 THEN 'short' ELSE 'ok' END"
_FILLED = "CASE WHEN description IS NULL OR description = ' ' THEN 'Description not available in source content' ELSE description END"
_LIKES = "likes AS (SELECT o_custkey, l_partkey, l_suppkey, o_orderdate FROM orders JOIN lineitem ON o_orderkey = l_orderkey)"
_INTER = """
inter AS (
  SELECT event_id AS id, user_id, CASE WHEN event_type IN ('view', 'click', 'purchase') THEN event_type ELSE 'other' END AS interaction,
    (['bean', 'location', 'menu_item'])[event_id % 3 + 1] AS object_type, event_id AS object_id, props, ts FROM events
)"""
_N_SHOPS = "(SELECT count(*) FROM supplier)"

ORACLE = {
    "bean_rows": _BEANS + """
SELECT source_file, idx, name, price, currency, description, producer, roast_level, grind_type, altitude, suitable_brew_types FROM bean
UNION ALL SELECT source_file, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM barren""",
    "menu_rows": _MENU + """
SELECT source_file, idx, name, '$4.50' AS price, category, ['8oz', '12oz'] AS size_options FROM menu
UNION ALL SELECT 'menu_' || s_suppkey, NULL, NULL, NULL, NULL, NULL FROM supplier WHERE s_suppkey % 7 = 0""",
    "domain_checks": _BEANS + "," + _MENU.strip()[5:] + """
SELECT source_file, idx, 'currency' AS "column", currency AS value FROM bean WHERE currency = 'XYZ'
UNION ALL SELECT source_file, idx, 'roast_level', roast FROM bean WHERE NOT roast_ok
UNION ALL SELECT source_file, idx, 'grind_type', grind FROM bean WHERE NOT grind_ok
UNION ALL SELECT source_file, idx, 'bean_type', bean_type FROM bean WHERE NOT bean_type_ok
UNION ALL SELECT source_file, idx, 'category', 'brunch' FROM menu WHERE category = 'brunch'""",
    "required_checks": _BEANS + "," + _MENU.strip()[5:] + """
SELECT source_file, idx, 'price' AS "column" FROM bean WHERE price IS NULL
UNION ALL SELECT source_file, idx, 'description' FROM bean WHERE description IS NULL
UNION ALL SELECT source_file, idx, 'category' FROM menu WHERE category IS NULL""",
    "description_checks": _BEANS + f"""
SELECT source_file, idx, {_CHECK} AS description_check, {_FILLED} AS description FROM bean""",
    "catalog_beans": _BEANS + f"""
SELECT name, {_FILLED} AS description, '250g' AS weight, price, currency, producer AS proprietor, 'Huila' AS region_area,
  roast AS roast_level, grind AS grind_type, CAST(NULL AS VARCHAR) AS url FROM bean""",
    "catalog_specialties": _BEANS + """
SELECT name, producer AS proprietor, altitude AS altitude_masl, process, bean_type, brews AS suitable_brew_types, 'Geisha' AS variety
FROM bean""",
    "norm_roast": _norm_sql(ROASTS, _ROAST), "norm_grind": _norm_sql(GRINDS, _GRIND),
    "norm_process": _norm_sql(PROCESSES, _PROCESS), "norm_bean_type": _norm_sql(BEAN_TYPES, _BEAN_TYPE),
    "norm_brew": _norm_sql(BREWS, _BREW),
    "norm_brew_lists": f"""
SELECT p_partkey, CASE WHEN p_partkey % 5 <> 0
  THEN [{_mapped(BREWS, _BREW, 'p_partkey', 0)}, {_mapped(BREWS, _BREW, 'p_partkey + 1', 0)}] END AS brew_types FROM part""",
    "enum_conformance": _BEANS + """
SELECT "column", count(*) FILTER (ok) AS n_conforming, count(*) FILTER (NOT ok) AS n_free_text, count(*) FILTER (ok IS NULL) AS n_missing
FROM (SELECT 'roast_level' AS "column", roast_ok AS ok FROM bean UNION ALL SELECT 'grind_type', grind_ok FROM bean
  UNION ALL SELECT 'process', process_ok FROM bean UNION ALL SELECT 'bean_type', bean_type_ok FROM bean) GROUP BY 1""",
    "file_results": _BEANS + """
SELECT source_file, count(*) AS beans_found FROM bean GROUP BY source_file UNION ALL SELECT source_file, 0 FROM barren""",
    "processing_summary": _BEANS + """
SELECT (SELECT count(*) FROM good) AS files_processed, (SELECT count(*) FROM bean) AS total_beans_found,
  CAST((SELECT count(*) FROM bean) AS DOUBLE) / (SELECT count(*) FROM good) AS average_beans""",
    "top_files": _BEANS + """
SELECT source_file, count(*) AS beans_found FROM bean GROUP BY source_file ORDER BY beans_found DESC, source_file LIMIT 10""",
    "bean_with_specialty": f"""
SELECT p_partkey AS id, p_name AS name, p_retailprice AS price, {_pick(ROAST_LEVELS, 'p_size')} AS roast_level,
  CASE WHEN p_partkey % 3 = 0 THEN {_pick(PROCESS_NAMES, 'p_size')} END AS process,
  CAST(CASE WHEN p_partkey % 3 = 0 THEN p_size * 50 END AS INTEGER) AS altitude_masl FROM part""",
    "bean_locations": """
SELECT DISTINCT l_partkey AS bean_id, p_name AS bean_name, l_suppkey AS location_id, CAST(s_nationkey AS BIGINT) AS cafe_id, s_name AS address
FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey""",
    "cafe_menu": f"""
SELECT CAST(n_nationkey AS BIGINT) AS cafe_id, n_name AS cafe_name, s_suppkey AS location_id, s_name AS address, p_partkey AS item_id,
  p_name AS item_name, p_retailprice AS price
FROM part JOIN supplier ON s_suppkey = p_partkey % {_N_SHOPS} JOIN nation ON n_nationkey = s_nationkey""",
    "user_profiles": f"""
SELECT c_custkey AS user_id, c_name AS username,
  CASE WHEN c_acctbal < 0 THEN 'low' WHEN c_acctbal < 5000 THEN 'medium' ELSE 'high' END AS budget_range,
  CASE WHEN c_custkey % 2 = 0 THEN {_pick(ROAST_LEVELS, 'c_custkey')} END AS roast_level_pref,
  list_sort(({_list(FLAVORS)})[1:c_custkey % 3]) AS flavors FROM customer""",
    "like_counts": f"""
WITH {_LIKES}
SELECT 'bean' AS object_type, l_partkey AS object_id, count(*) AS n_likes, max(liked_at) AS last_liked_at
FROM (SELECT o_custkey, l_partkey, min(o_orderdate) AS liked_at FROM likes GROUP BY 1, 2) GROUP BY 2
UNION ALL SELECT 'location', l_suppkey, count(*), max(liked_at)
FROM (SELECT o_custkey, l_suppkey, min(o_orderdate) AS liked_at FROM likes GROUP BY 1, 2) GROUP BY 2""",
    "interaction_counts": f"""
WITH {_INTER}
SELECT interaction, object_type, count(*) AS n, count(DISTINCT user_id) AS n_users,
  CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS sum_k FROM inter GROUP BY 1, 2""",
    "interaction_context": f"""
WITH {_INTER}
SELECT id, interaction, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.session_id') AS session_id FROM inter""",
    "object_lookup": f"""
WITH {_INTER}, named AS (
  SELECT 'bean' AS object_type, p_partkey AS object_id, p_name AS object_name FROM part
  UNION ALL SELECT 'location', s_suppkey, s_name FROM supplier UNION ALL SELECT 'menu_item', p_partkey, p_name FROM part)
SELECT id, object_type, object_id, object_name FROM inter LEFT JOIN named USING (object_type, object_id)""",
    "fk_violations": f"""
WITH {_LIKES}
SELECT 'cafe_locations' AS "table", 'cafe_id' AS "column", CAST(s_nationkey + 5000 AS BIGINT) AS value, count(*) AS n_rows
FROM supplier WHERE s_suppkey % 10 = 0 GROUP BY 3
UNION ALL SELECT 'user_liked_beans', 'user_id', -2 * o_custkey - 2, count(DISTINCT l_partkey) FROM likes WHERE l_partkey % 100 = 0 GROUP BY 3""",
    "unique_violations": """
SELECT 'users' AS "table", 'username' AS columns, c_name AS key, CAST(2 AS BIGINT) AS n_rows FROM customer WHERE c_custkey % 50 = 0""",
    "null_violations": """
SELECT 'beans' AS "table", 'name' AS "column", count(*) AS n_rows FROM part WHERE p_partkey % 40 = 0""",
    "cascade_delete": f"""
WITH {_LIKES},
shop AS (SELECT s_suppkey FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE n_regionkey <> 1),
person AS (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'MACHINERY')
SELECT 'cafes' AS "table", count(*) AS n_rows FROM nation WHERE n_regionkey <> 1
UNION ALL SELECT 'cafe_locations', count(*) FROM shop
UNION ALL SELECT 'beans', count(*) FROM part
UNION ALL SELECT 'bean_specialties', count(*) FROM part WHERE p_partkey % 3 = 0
UNION ALL SELECT 'menu_items', count(*) FROM part WHERE p_partkey % {_N_SHOPS} IN (SELECT s_suppkey FROM shop)
UNION ALL SELECT 'cafe_location_beans', count(DISTINCT (l_suppkey, l_partkey)) FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM shop)
UNION ALL SELECT 'users', count(*) FROM person
UNION ALL SELECT 'user_preferences', count(*) FROM person WHERE c_custkey % 2 = 0
UNION ALL SELECT 'user_flavor_preferences', CAST(sum(c_custkey % 3) AS BIGINT) FROM person
UNION ALL SELECT 'user_liked_beans', count(DISTINCT (o_custkey, l_partkey)) FROM likes WHERE o_custkey IN (SELECT c_custkey FROM person)
UNION ALL SELECT 'user_liked_locations', count(DISTINCT (o_custkey, l_suppkey)) FROM likes
  WHERE o_custkey IN (SELECT c_custkey FROM person) AND l_suppkey IN (SELECT s_suppkey FROM shop)
UNION ALL SELECT 'user_interactions', count(*) FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')""",
    "defaults": f"""
SELECT p_partkey AS id, TIMESTAMP '{LOADED_AT}' AS at, 'beans' AS "table" FROM part
UNION ALL SELECT event_id, ts, 'user_interactions' FROM events""",
}
