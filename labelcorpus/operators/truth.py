"""Ground truth, operator records and difficulty."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelcorpus.knowledge import values as V
from labelcorpus.operators import ranks

LEVELS = dict(V.OPERATORS)


# L8 ----------------------------------------------------------------------------------------
def operator_records(foods: DataFrame, declared: DataFrame, allergens: DataFrame | None,
                     claims: DataFrame | None, nutrient_names: DataFrame | None,
                     operators: list[str], lt2_threshold: float = 0.02, any_size: bool = False) -> DataFrame:
    """One row per (food, applied operator): name, version, affected items, config.

    ``any_size`` builds the lists from runs, for foods that no size filter bounds.

    ``claims``: (food_id, claims); ``nutrient_names``: (food_id, names) in first-position
    order. ``less_than_2_pct`` leaves no record when its threshold is <= 0.
    """
    served = F.col("serving_g") if "serving_g" in foods.columns else F.lit(None).cast("double")
    ids = foods.select("food_id", served.alias("_serving"))

    def affected(flag: str):
        hit = F.col(flag)
        return F.transform(F.array_sort(F.collect_list(
            F.when(hit, F.struct("label_pos", "original_description")))),
            lambda s: s["original_description"])

    names_in_order = F.transform(F.array_sort(F.collect_list(F.struct(
        F.when(F.col("declaration_group") == "main", 0).otherwise(1).alias("g"),
        "label_pos", "original_description"))), lambda s: s["original_description"])
    lists = [affected("rename_affected").alias("rename"),
             affected("generic_name_affected").alias("generic_name"),
             affected("compound_affected").alias("compound"),
             affected("lt2_affected").alias("less_than_2_pct")]
    if any_size:
        def in_group(main: bool):
            hit = (F.col("declaration_group") == "main") == F.lit(main)
            return F.transform(F.array_sort(F.collect_list(F.when(hit, F.struct("label_pos", "original_description")))),
                               lambda s: s["original_description"])
        runs = declared.groupBy("food_id", ranks.run_of("label_pos").alias("_run")).agg(
            *lists, in_group(True).alias("_main"), in_group(False).alias("_low"))
        per_food = runs.groupBy("food_id").agg(
            *[ranks.joined_runs("_run", op).alias(op) for op in ("rename", "generic_name", "compound", "less_than_2_pct")],
            F.concat(ranks.joined_runs("_run", "_main"), ranks.joined_runs("_run", "_low")).alias("_all_names"))
    else:
        per_food = declared.groupBy("food_id").agg(*lists, names_in_order.alias("_all_names"))
    base = ids.join(per_food, "food_id", "left")
    if allergens is not None:
        base = base.join(allergens.select("food_id", "allergens"), "food_id", "left")
    else:
        base = base.withColumn("allergens", F.lit(None).cast("array<string>"))
    if claims is not None:
        base = base.join(claims.select("food_id", "claims"), "food_id", "left")
    else:
        base = base.withColumn("claims", F.lit(None).cast("array<string>"))
    if nutrient_names is not None:
        base = base.join(nutrient_names.select("food_id", "nutrient_names"), "food_id", "left")
    else:
        base = base.withColumn("nutrient_names", F.lit(None).cast("array<string>"))

    empty = F.array().cast("array<string>")
    recs = []
    for pos, op in enumerate(operators):
        op = getattr(op, "__name__", op)  # an own operator is a function
        if op == "less_than_2_pct" and lt2_threshold <= 0:
            continue
        if op in ("rename", "generic_name", "compound", "less_than_2_pct"):
            aff = F.coalesce(F.col(op), empty)
        elif op == "allergen":
            aff = F.when(F.size(F.coalesce("allergens", empty)) > 0,
                         F.coalesce("_all_names", empty)).otherwise(empty)
        elif op == "claim":
            aff = F.coalesce("nutrient_names", empty)
        else:
            aff = empty
        config = {
            "less_than_2_pct": F.create_map(F.lit("threshold"), F.lit(str(lt2_threshold))),
            "claim": F.create_map(F.lit("n_claims"),
                                  F.size(F.coalesce("claims", empty)).cast("string")),
            "nutrition_facts": F.create_map(F.lit("serving_size_g"), F.col("_serving").cast("string")),
        }.get(op, F.create_map().cast("map<string,string>"))
        recs.append(F.struct(F.lit(pos).alias("op_pos"), F.lit(op).alias("operator_name"),
                             F.lit(V.OPERATOR_VERSION).alias("version"), aff.alias("affected"),
                             config.alias("config"),
                             F.size(F.coalesce("claims", empty)).alias("n_claims")))
    return base.select("food_id", F.inline(F.array(*recs)))


# A8 ----------------------------------------------------------------------------------------
def difficulty(records: DataFrame) -> DataFrame:
    """Max level over operators that took effect (claim: affected or claims; panel: always)."""
    level = F.create_map(*[x for op, lv in V.OPERATORS for x in (F.lit(op), F.lit(lv))])
    effect = ((F.size("affected") > 0)
              | ((F.col("operator_name") == "claim") & (F.col("n_claims") > 0))
              | (F.col("operator_name") == "nutrition_facts"))
    lv = F.when(effect, F.coalesce(F.try_element_at(level, F.col("operator_name")), F.lit(1)))
    return records.groupBy("food_id").agg(
        F.greatest(F.coalesce(F.max(lv), F.lit(1)), F.lit(1)).alias("difficulty"),
        F.count(F.lit(1)).alias("total_applied_operators"))


# J17 ---------------------------------------------------------------------------------------
def canonical_mappings(ingredients_with_fractions: DataFrame) -> DataFrame:
    """description -> ingredient code, for non-fortificant ingredients (input order)."""
    return (ingredients_with_fractions.where(~F.col("is_fortificant"))
            .select("food_id", "pos", "pos2", F.col("description").alias("source_text"),
                    F.col("code").cast("string").alias("target_id"),
                    F.lit(V.CODE_NAMESPACE).alias("target_namespace"),
                    F.lit(1.0).alias("confidence")))


def target_mappings(declared: DataFrame) -> DataFrame:
    """declared name -> original description; main list first, then the 2% group."""
    g = F.when(F.col("declaration_group") == "main", 0).otherwise(1)
    return declared.select(
        "food_id", g.alias("group_pos"), "label_pos",
        F.col("declared_name").alias("source_text"),
        F.col("original_description").alias("target_id"),
        F.lit(V.DESCRIPTION_NAMESPACE).alias("target_namespace"),
        F.lit(1.0).alias("confidence"))


# A4 ----------------------------------------------------------------------------------------
def ingredient_maps(ingredients_with_fractions: DataFrame) -> DataFrame:
    """Per food: code -> weight and code -> fraction; a repeated code keeps its last row.

    Duplicates are resolved before the map is built (duplicate map keys raise in Spark).
    """
    # a food whose ingredients are all fortificants keeps a row with empty maps: its only group
    # has a null code, and null entries are not collected
    code = F.when(~F.col("is_fortificant"), F.col("code").cast("string"))
    last = (ingredients_with_fractions.groupBy("food_id", code.alias("code"))
            .agg(F.max_by(F.struct("weight_g", "fraction"), F.struct("pos", "pos2")).alias("v")))
    entry = lambda c: F.when(F.col("code").isNotNull(), F.struct("code", F.col(f"v.{c}")))
    return last.groupBy("food_id").agg(
        F.map_from_entries(F.collect_list(entry("weight_g"))).alias("ingredient_amounts"),
        F.map_from_entries(F.collect_list(entry("fraction"))).alias("ingredient_fractions"))


# W4 ----------------------------------------------------------------------------------------
def truth_keys(declared: DataFrame, sample_col: str = "food_id", any_size: bool = False) -> DataFrame:
    """Mapping truth rows: the n-th repeat of a declared name is keyed ``name#n`` (n > 1).

    ``any_size`` numbers the repeats by ranges, for foods that no size filter bounds.
    """
    g = F.when(F.col("declaration_group") == "main", 0).otherwise(1)
    if any_size:
        declared, n = ranks.row_numbers(declared, [sample_col, "declared_name"], [g, F.col("label_pos")], "_repeat"), F.col("_repeat")
    else:
        n = F.row_number().over(Window.partitionBy(sample_col, "declared_name").orderBy(g, "label_pos"))
    return declared.select(
        sample_col, g.alias("group_pos"), "label_pos", "declared_name", "original_description",
        F.when(n == 1, F.col("declared_name"))
        .otherwise(F.concat(F.col("declared_name"), F.lit("#"), n.cast("string"))).alias("key"))


# L10 ---------------------------------------------------------------------------------------
def compound_fraction_audit(compound_dim: DataFrame, tolerance: float = 0.08) -> DataFrame:
    """Compounds whose sub-ingredient fractions do not sum to 1 within the tolerance."""
    return (compound_dim.groupBy("key").agg(F.sum("fraction").alias("total"))
            .where(F.abs(F.col("total") - 1.0) > tolerance))
