"""Adapter from the driver's star-schema test tables onto the recipe model.

Mapping (documented in README):

* foods: ``orders`` -> food_id = o_orderkey, food_name = o_orderpriority,
  food_code = the integer part of o_totalprice as text (so code prefixes vary),
  serving_size_g = max(o_totalprice / 1000, 1), serving label = o_orderstatus,
  group_key = o_custkey (recipe group for leakage-free splits).
* ingredients: ``lineitem`` join ``part`` on l_partkey = p_partkey -> food_id = l_orderkey,
  code = l_partkey, description = p_name, weight_g = l_quantity,
  sequence_number = l_linenumber, tie-break (pos, pos2) = (l_partkey, l_suppkey);
  fortificant = p_type in the given list (default PROMO).
* nutrients: ``lineitem`` aggregated per order and unpivoted into survey nutrient names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

FORTIFICANT_TYPES = ["PROMO"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def foods(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("food_id"),
        F.col("o_totalprice").cast("long").cast("string").alias("food_code"),
        F.col("o_orderpriority").alias("food_name"),
        F.greatest(F.col("o_totalprice") / 1000.0, F.lit(1.0)).alias("serving_size_g"),
        F.col("o_orderstatus").alias("serving_size_label"),
        F.concat(F.lit("1 "), F.col("o_orderstatus")).alias("household_serving"),
        F.col("o_custkey").alias("group_key"),
    )


def ingredients(spark: SparkSession, sf_dir: str,
                fortificant_types: list[str] | None = None) -> DataFrame:
    """Raw ingredient rows (before fractions)."""
    types = FORTIFICANT_TYPES if fortificant_types is None else fortificant_types
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    return li.join(p, li.l_partkey == p.p_partkey).select(
        F.col("l_orderkey").alias("food_id"),
        F.col("l_linenumber").cast("int").alias("sequence_number"),
        F.col("l_partkey").alias("pos"),
        F.col("l_suppkey").alias("pos2"),
        F.col("l_partkey").alias("code"),
        F.col("p_name").alias("description"),
        F.col("l_quantity").alias("weight_g"),
        F.lit(0).alias("retention_code"),
        F.col("p_type").isin(*types).alias("is_fortificant"),
    )


# (position, nutrient id, survey name, unit, aggregate over the order's lines)
NUTRIENT_MAP = [
    (0, 1003, "Protein", "g", "avg(l_quantity) / 2"),
    (1, 1004, "Total lipid (fat)", "g", "avg(l_discount) * 50"),
    (2, 1005, "Carbohydrate, by difference", "g", "max(l_quantity)"),
    (3, 1008, "Energy", "kcal", "sum(l_quantity)"),
    (4, 1093, "Sodium, Na", "mg", "CASE WHEN max(l_tax) >= 0.02 THEN sum(l_tax) * 500 END"),
    (5, 1258, "Fatty acids, total saturated", "g", "min(l_discount) * 20"),
    (6, 1079, "Fiber, total dietary", "g", "count(*) * 0.5"),
    (7, 2000, "Total Sugars", "g", "min(l_quantity) / 4"),
    (8, 1087, "Calcium, Ca", "mg", "avg(l_extendedprice) / 100"),
    (9, 1092, "Potassium, K", "mg", "max(l_extendedprice) / 50"),
]


def nutrients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(food_id, pos, nutrient_id, name, amount, unit): per-100 g amounts per order."""
    li = table(spark, sf_dir, "lineitem")
    agg = li.groupBy(F.col("l_orderkey").alias("food_id")).agg(
        *[F.expr(expr).cast("double").alias(f"n{pos}") for pos, _, _, _, expr in NUTRIENT_MAP])
    entries = F.array(*[
        F.struct(F.lit(pos).alias("pos"), F.lit(nid).alias("nutrient_id"), F.lit(name).alias("name"),
                 F.col(f"n{pos}").alias("amount"), F.lit(unit).alias("unit"))
        for pos, nid, name, unit, _ in NUTRIENT_MAP])
    return (agg.select("food_id", F.inline(entries))
            .where(F.col("amount").isNotNull()))


# SQL text of the same mapping, for the DuckDB oracle --------------------------------------
def sql_foods() -> str:
    return ("SELECT o_orderkey AS food_id, CAST(CAST(trunc(o_totalprice) AS BIGINT) AS VARCHAR) AS food_code, "
            "o_orderpriority AS food_name, greatest(o_totalprice / 1000.0, 1.0) AS serving_size_g, "
            "o_custkey AS group_key FROM orders")


def sql_ingredients(types: list[str] | None = None) -> str:
    types = FORTIFICANT_TYPES if types is None else types
    lst = ", ".join(f"'{t}'" for t in types)
    return ("SELECT l_orderkey AS food_id, CAST(l_linenumber AS INTEGER) AS sequence_number, "
            "l_partkey AS pos, l_suppkey AS pos2, l_partkey AS code, p_name AS description, "
            f"l_quantity AS weight_g, p_type IN ({lst}) AS is_fortificant "
            "FROM lineitem JOIN part ON l_partkey = p_partkey")


def sql_nutrients() -> str:
    cols = ", ".join(f"CAST({expr} AS DOUBLE) AS n{pos}" for pos, _, _, _, expr in NUTRIENT_MAP)
    agg = f"SELECT l_orderkey AS food_id, {cols} FROM lineitem GROUP BY l_orderkey"
    parts = [f"SELECT food_id, {pos} AS pos, '{name}' AS name, n{pos} AS amount FROM a "
             f"WHERE n{pos} IS NOT NULL" for pos, _, name, _, _ in NUTRIENT_MAP]
    return f"(WITH a AS ({agg}) " + " UNION ALL ".join(parts) + ")"
