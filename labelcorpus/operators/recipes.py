"""Recipe-level operators: fractions, size filter, statistics, label order, 2% group.

Ingredient tables carry ``food_id, sequence_number, pos, pos2, code, description, weight_g,
is_fortificant``; ``(pos, pos2)`` is the input position used to keep sorts stable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelcorpus.operators import ranks

LARGE = 100_000


def label_order():
    """Label order: fraction desc, then sequence number, then input position."""
    return [F.col("fraction").desc(), F.col("sequence_number"), F.col("pos"), F.col("pos2")]


# S3 / A3 / P2 ------------------------------------------------------------------------------
def food_totals(ingredients: DataFrame) -> DataFrame:
    """(food_id, n_ingredients, total_weight): one pre-aggregated row per food.

    A partial (map-side) aggregate, so a food holding a large share of all rows never has to
    sit in one task.
    """
    return ingredients.groupBy("food_id").agg(
        F.count(F.lit(1)).alias("n_ingredients"),
        F.sum("weight_g").alias("total_weight"))


def with_fractions(ingredients: DataFrame, totals: DataFrame | None = None, any_size: bool = False) -> DataFrame:
    """Add ``fraction = weight / total`` (0.0 when the total is <= 0) and ``n_ingredients``.

    The denominator counts every ingredient, fortificants included. ``any_size`` deals the rows of a food of more than
    ``LARGE`` ingredients out over several join keys, so that no task holds a whole food; at most one food in ``LARGE`` rows
    is so large, and only these are broadcast.
    """
    totals = food_totals(ingredients) if totals is None else totals
    if any_size:
        last = F.floor((F.col("n_ingredients") - 1) / LARGE)
        large = F.broadcast(totals.where(F.col("n_ingredients") > LARGE).select("food_id", last.alias("_last")))
        part = F.coalesce(F.pmod(F.xxhash64(*ingredients.columns), F.col("_last") + 1), F.lit(0).cast("bigint"))
        dealt = ingredients.join(large, "food_id", "left").withColumn("_part", part).drop("_last")
        parts = totals.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
        out = dealt.join(parts, ["food_id", "_part"]).drop("_part")
    else:
        out = ingredients.join(totals, "food_id")
    return out.withColumn(
        "fraction",
        F.when(F.col("total_weight") > 0, F.col("weight_g") / F.col("total_weight"))
        .otherwise(F.lit(0.0)))


def fortificant_flag(code_col: str, codes: list[str]):
    """``str(code) in codes``."""
    return F.col(code_col).cast("string").isin(*codes)


def drop_fortificants(ingredients: DataFrame) -> DataFrame:
    """Applied after the fractions so fortificants still count in the denominator."""
    return ingredients.where(~F.col("is_fortificant"))


# P1 ----------------------------------------------------------------------------------------
def recipe_ids(ingredients: DataFrame, min_ingredients: int = 2,
               max_ingredients: int = 50) -> DataFrame:
    """Food ids whose ingredient count lies in [min, max] (both inclusive)."""
    return (food_totals(ingredients)
            .where(F.col("n_ingredients").between(min_ingredients, max_ingredients))
            .select("food_id", "n_ingredients"))


def select_recipes(ingredients: DataFrame, min_ingredients: int = 2,
                   max_ingredients: int = 50) -> DataFrame:
    """Fractions for foods passing the size filter (one aggregate, one join)."""
    totals = food_totals(ingredients).where(
        F.col("n_ingredients").between(min_ingredients, max_ingredients))
    return with_fractions(ingredients, totals)


# A1 / A2 -----------------------------------------------------------------------------------
def recipe_statistics(foods: DataFrame, ingredients: DataFrame,
                      thresholds=(2, 3, 5, 10, 15), max_ingredients: int = 50) -> DataFrame:
    """One row: total foods, recipes with >=1 ingredient and with >=k (each capped at max)."""
    counts = food_totals(ingredients)
    aggs = [F.count_if(F.col("n_ingredients").between(1, max_ingredients))
            .alias("recipes_with_ingredients")]
    aggs += [F.count_if(F.col("n_ingredients").between(k, max_ingredients))
             .alias(f"recipes_ge_{k}_ingredients") for k in thresholds]
    total = foods.agg(F.count(F.lit(1))).scalar()  # scalar subquery
    return counts.agg(*aggs).select(total.alias("total_foods"), "*")


# P4 / W1 -----------------------------------------------------------------------------------
def initial_declared(ingredients_with_fractions: DataFrame, order=None, any_size: bool = False) -> DataFrame:
    """Label rows: non-fortificant ingredients in label order (fraction desc, sequence, input).

    The window is per food; callers apply the size filter first, which bounds a food to at
    most ``max_ingredients`` rows. Without that filter ``any_size`` numbers the rows by ranges.
    """
    order, kept = order or label_order(), drop_fortificants(ingredients_with_fractions)
    if any_size:
        kept, position = ranks.row_numbers(kept, ["food_id"], order, "label_pos"), F.col("label_pos").cast("int")
    else:
        position = F.row_number().over(Window.partitionBy("food_id").orderBy(*order))
    return (kept
            .select(
                "food_id",
                position.alias("label_pos"),
                F.col("description").alias("original_description"),
                F.upper("description").alias("declared_name"),
                F.lit("main").alias("declaration_group"),
                F.col("code").alias("original_code"),
                F.col("fraction").alias("original_fraction"),
                F.lit(False).alias("is_compound"),
                F.array().cast("array<string>").alias("sub_ingredients"),
            ))


# L4 ----------------------------------------------------------------------------------------
def less_than_2_pct(declared: DataFrame, threshold: float = 0.02) -> DataFrame:
    """Move rows with fraction <= threshold (inclusive) to the 2% group; <=0 disables."""
    if threshold <= 0:
        return declared.withColumn("lt2_affected", F.lit(False))
    low = F.col("original_fraction") <= F.lit(threshold)
    return (declared
            .withColumn("declaration_group",
                        F.when(low, F.lit("two_percent_or_less")).otherwise(F.col("declaration_group")))
            .withColumn("lt2_affected", low))
