"""Label building: the operator chain from canonical foods to declared rows, label text,
panel and claims (section 3.2 of the blueprint), as one lazy DataFrame plan.

Only the naming steps depend on each other; allergens read original descriptions and the
nutrition steps read only the food, so they are independent branches joined on food_id.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelcorpus.knowledge import dims as D
from labelcorpus.knowledge import values as V
from labelcorpus.operators import naming, nutrition, ranks, recipes, tags

DEFAULT_OPERATORS = [name for name, _ in V.OPERATORS]
_DEFAULTS: dict = {}


@dataclass
class Knowledge:
    """All knowledge tables an operator chain needs (any of them can be replaced)."""

    lexicon: DataFrame
    commercial: DataFrame
    generic: DataFrame
    compounds: DataFrame
    categories: DataFrame
    food_keywords: DataFrame
    allergen_keywords: DataFrame
    allergen_exclusions: DataFrame
    allergen_order: DataFrame
    racc: DataFrame
    prefixes: DataFrame
    daily_values: DataFrame
    content_claims: DataFrame
    source_nutrients: DataFrame
    health_claims: DataFrame
    rounding: DataFrame
    prohibited: DataFrame
    extra: dict = field(default_factory=dict)

    @classmethod
    def default(cls, spark: SparkSession, **overrides: DataFrame) -> "Knowledge":
        """The built-in knowledge tables (created once per session), with optional overrides."""
        key = id(spark)
        cached = _DEFAULTS.get(key)
        if cached is None or cached[0] is not spark:
            cached = (spark, cls._build_default(spark))
            _DEFAULTS[key] = cached
        base = dict(cached[1])
        base.update(overrides)
        return cls(**base)

    @staticmethod
    def _build_default(spark: SparkSession) -> dict:
        return dict(
            lexicon=D.label_lexicon(spark), commercial=D.commercial_names(spark),
            generic=D.generic_names(spark), compounds=D.compounds(spark),
            categories=D.ingredient_categories(spark), food_keywords=D.food_name_keywords(spark),
            allergen_keywords=D.allergen_keywords(spark),
            allergen_exclusions=D.allergen_exclusions(spark),
            allergen_order=D.allergen_order(spark), racc=D.racc(spark),
            prefixes=D.code_prefixes(spark), daily_values=D.daily_values(spark),
            content_claims=D.content_claims(spark), source_nutrients=D.source_nutrients(spark),
            health_claims=D.health_claims(spark), rounding=D.rounding(spark),
            prohibited=D.prohibited_terms(spark))

    def nutrient_context(self) -> nutrition.NutrientContext:
        return nutrition.NutrientContext(self.daily_values, self.rounding)


def check_operators(operators: list | None) -> list:
    """P10: None -> all seven in fixed order; [] -> none; unknown names raise.

    An own operator is a function from the declared rows to the declared rows; it runs at its place in the list.
    """
    ops = DEFAULT_OPERATORS if operators is None else list(operators)
    unknown = [o for o in ops if not callable(o) and o not in DEFAULT_OPERATORS]
    if unknown:
        raise ValueError(f"Unknown operator: '{unknown[0]}'. Registered: {DEFAULT_OPERATORS}")
    return ops


def declared_rows(ingredients_with_fractions: DataFrame, k: Knowledge,
                  operators: list[str] | None = None, lt2_threshold: float = 0.02,
                  any_size: bool = False) -> DataFrame:
    """Declared ingredient rows after the naming operators and the 2% grouping."""
    ops = check_operators(operators)
    df = recipes.initial_declared(ingredients_with_fractions, any_size=any_size)
    for op in ops:
        if callable(op):
            df = op(df)
        elif op == "rename":
            df = naming.rename(df, k.lexicon, k.commercial)
        elif op == "generic_name":
            df = naming.generic_name(df, k.generic)
        elif op == "compound":
            df = naming.compound(df, k.compounds)
        elif op == "less_than_2_pct":
            df = recipes.less_than_2_pct(df, lt2_threshold)
    for op in ("rename", "generic_name", "compound", "less_than_2_pct"):
        col = "lt2_affected" if op == "less_than_2_pct" else f"{op}_affected"
        if col not in df.columns:
            df = df.withColumn(col, F.lit(False))
    return df


def _names_in_order(group: str) -> F.Column:
    hit = F.col("declaration_group") == F.lit(group)
    return F.transform(
        F.array_sort(F.collect_list(F.when(hit, F.struct("label_pos", "declared_name")))),
        lambda s: s["declared_name"])


def label_lists(declared: DataFrame, found: F.Column | None = None, any_size: bool = False) -> DataFrame:
    """Per food: main names and 2% names in label order, and the distinct entries of ``found`` (an array) as ``found``.

    One aggregate while a food has at most max_ingredients rows; ``any_size`` builds the lists from runs.
    """
    aggs = [_names_in_order("main").alias("main_names"), _names_in_order("two_percent_or_less").alias("two_percent_names")]
    if found is not None:
        aggs.append(F.array_sort(F.array_distinct(F.flatten(F.collect_list(found)))).alias("found"))
    if not any_size:
        return declared.groupBy("food_id").agg(*aggs)
    runs = declared.groupBy("food_id", ranks.run_of("label_pos").alias("_run")).agg(*aggs)
    whole = [ranks.joined_runs("_run", c).alias(c) for c in ("main_names", "two_percent_names")]
    if found is not None:
        whole.append(F.array_sort(F.array_distinct(F.flatten(F.collect_list("found")))).alias("found"))
    return runs.groupBy("food_id").agg(*whole)


def ingredient_text(main: F.Column, two_pct: F.Column, allergen_text: F.Column,
                    claims: F.Column) -> F.Column:
    """X9 + X10: INGREDIENTS line, 2% group, allergen statement; claims above, one per line."""
    main_s = F.when(F.size(main) > 0, F.array_join(main, ", "))
    lt_s = F.when(F.size(two_pct) > 0,
                  F.concat(F.lit("CONTAINS 2% OR LESS OF: "), F.array_join(two_pct, ", ")))
    full = F.concat_ws(", ", main_s, lt_s)
    full = F.when(full.startswith("INGREDIENTS"), full).otherwise(
        F.concat(F.lit("INGREDIENTS: "), full, F.lit(".")))
    full = F.when(allergen_text.isNotNull(),
                  F.concat(full, F.lit(" "), allergen_text, F.lit("."))).otherwise(full)
    return F.when(F.size(claims) > 0,
                  F.array_join(F.concat(claims, F.array(full)), "\n")).otherwise(full)


def build_labels(foods: DataFrame, ingredients_with_fractions: DataFrame, nutrients: DataFrame,
                 k: Knowledge, operators: list[str] | None = None,
                 lt2_threshold: float = 0.02, materialize: str = "table",
                 cut_points: tuple[str, ...] = ("declared", "profile", "label"),
                 any_size: bool = False, profile: DataFrame | None = None) -> dict[str, DataFrame]:
    """The whole label for each food, as a dict of DataFrames keyed by food_id.

    ``foods`` must hold one row per food to label (already restricted to selected ids).
    The declared rows, the nutrient profile and the label feed several branches (text,
    allergens, records, validation); ``materialize`` ('table', 'checkpoint', 'persist' or
    'none') says how they are cut (see ``session.materialize``). ``any_size``: the foods went
    through no size filter. ``profile``: the nutrients' ``nutrient_profile``, where it was made before.
    """
    from labelcorpus.session import materialize as cut
    ops = check_operators(operators)
    declared = declared_rows(ingredients_with_fractions, k, ops, lt2_threshold, any_size)
    declared = cut(declared, materialize if "declared" in cut_points else "none")

    ctx = k.nutrient_context()
    served = tags.serving_size(foods, k.prefixes, k.food_keywords, k.racc)
    profile = nutrition.nutrient_profile(nutrients, ctx.names) if profile is None else profile
    prof = served.join(profile, "food_id", "left").withColumn("n_nutrients", F.coalesce("n_nutrients", F.lit(0)))
    # the amounts per serving are cheap, so they are not written
    prof = ctx.add_serving_columns(cut(prof, materialize if "profile" in cut_points else "none"))

    out: dict[str, DataFrame] = {"declared": declared, "servings": served}
    empty = F.array().cast("array<string>")

    # One pass over the declared rows: label lists and, when asked, the allergen set.
    found = tags.allergen_column(F.col("original_description"), k.allergen_keywords,
                                 k.allergen_exclusions) if "allergen" in ops else None
    dagg = label_lists(declared, found, any_size).withColumnRenamed("found", "_alg")
    if "allergen" in ops:
        has = F.size("_alg") > 0
        dagg = dagg.select(
            "food_id", "main_names", "two_percent_names",
            F.when(has, F.col("_alg")).alias("allergens"),
            F.when(has, allergen_text_col(F.col("_alg"), k.allergen_order)).alias("allergen_text"))
    else:
        dagg = dagg.select("food_id", "main_names", "two_percent_names",
                           F.lit(None).cast("array<string>").alias("allergens"),
                           F.lit(None).cast("string").alias("allergen_text"))

    # One projection of the profile (one row per food): claims, panel and panel text.
    if "claim" in ops:
        parts = nutrition.claim_arrays(ctx, k.content_claims, k.source_nutrients, k.health_claims)
        claims = F.array_distinct(F.concat(parts["content"], parts["source"], parts["health"]))
    else:
        claims = empty
    p = prof.withColumn("claims", claims)
    if "nutrition_facts" in ops:
        panel = nutrition.nutrition_panel(p, ctx, keep=["food_name", "serving_g", "claims"])
        out["panel"] = panel
        base = panel.select("food_id", "food_name", "serving_g", "claims", "serving_size",
                            "calories", "total_fat", "sodium", "total_carbohydrate", "protein",
                            nutrition.panel_text(panel).alias("panel_text"))
    else:
        base = p.select("food_id", "food_name", "serving_g", "claims", *[
            F.lit(None).cast(t).alias(c) for c, t in (
                ("serving_size", "string"), ("calories", "double"), ("total_fat", "double"),
                ("sodium", "double"), ("total_carbohydrate", "double"), ("protein", "double"),
                ("panel_text", "string"))])
    label = base.join(dagg, "food_id", "left")
    label = (label.withColumn("main_names", F.coalesce("main_names", empty))
             .withColumn("two_percent_names", F.coalesce("two_percent_names", empty)))

    label = label.withColumn("product_name", F.upper("food_name")).withColumn(
        "ingredient_text",
        ingredient_text(F.col("main_names"), F.col("two_percent_names"), F.col("allergen_text"),
                        F.col("claims")))
    out["label"] = cut(label, materialize if "label" in cut_points else "none", wide=True)
    if "allergen" in ops:
        # Read back from the (materialised) label rather than re-aggregating declared rows.
        out["allergens"] = (out["label"].where(F.col("allergens").isNotNull())
                            .select("food_id", "allergens"))
    out["profile"] = prof
    return out


def allergen_text_col(allergens: F.Column, order_dim: DataFrame) -> F.Column:
    """X6 on an alphabetical allergen list: declaration order, then the text."""
    from labelcorpus.functions.columns import allergen_text
    return allergen_text(tags.order_allergens(allergens, order_dim))


def nutrient_name_lists(nutrients: DataFrame) -> DataFrame:
    """Per food: distinct nutrient names in first-position order (the claim's affected list)."""
    firsts = nutrients.groupBy("food_id", "name").agg(F.min("pos").alias("p"))
    return firsts.groupBy("food_id").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("p", "name"))), lambda s: s["name"])
        .alias("nutrient_names"))


def label_records(foods: DataFrame, nutrients: DataFrame, built: dict[str, DataFrame],
                  operators: list[str] | None = None, lt2_threshold: float = 0.02, any_size: bool = False,
                  nutrient_names: DataFrame | None = None) -> DataFrame:
    """L8 operator records for a ``build_labels`` result. ``nutrient_names``: ``nutrient_name_lists``, where they were made before."""
    from labelcorpus.operators import truth
    ops = check_operators(operators)
    label = built["label"]
    return truth.operator_records(
        foods.select("food_id").join(label.select("food_id", "serving_g"), "food_id", "left"), built["declared"],
        label.select("food_id", "allergens") if "allergen" in ops else None,
        label.select("food_id", "claims") if "claim" in ops else None,
        (nutrient_name_lists(nutrients) if nutrient_names is None else nutrient_names) if "claim" in ops else None,
        ops, lt2_threshold, any_size)
