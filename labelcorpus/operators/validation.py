"""Validation rules (V1-V8) and the per-sample report."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from labelcorpus.functions.columns import guarded_rlike, may_match, present


def prohibited_hits(text: Column, patterns: list[str]) -> Column:
    """The patterns (in order) found in the text, case-insensitively."""
    low = F.lower(text)
    return present(*[(guarded_rlike(text, p, low), F.lit(p)) for p in patterns])


# Rule results share one schema: (food_id, rule, passed, issues ARRAY<STRING>) ---------------
def _result(df, rule: str, issues) -> "DataFrame":
    return df.select("food_id", F.lit(rule).alias("rule"), (F.size(issues) == 0).alias("passed"),
                     issues.alias("issues"))


# One aggregate for the rules that look at ingredients --------------------------------------
def ingredient_facts(ingredients_with_fractions, declared, found=None, records=None, threshold: float = 0.02,
                     tol: float = 1e-9, any_size: bool = False):
    """Per food, from one shuffle of its ingredient rows, its declared rows and its 2% operator record:

    ``canon`` and ``lab`` (distinct descriptions of the recipe without fortificants, and of the label), ``n_bad`` (main rows
    heavier than the least before them), ``max_lt`` and ``min_main`` (heaviest 2% row, lightest main row), ``lt2_threshold``
    (of the food's own record of ``less_than_2_pct``, else ``threshold``) and ``detected`` (allergens, sorted): ``found`` is
    an array column of allergens over the declared rows.

    ``any_size`` is for foods that passed no size filter: names are compared by (food, name), so that ``canon`` and ``lab`` hold
    only the names that the other side lacks, and the least before a row comes from ranges (``ranks.earlier_min``).
    """
    from pyspark.sql import Window

    from labelcorpus.operators import ranks
    none = lambda t: F.lit(None).cast(t)
    lab = declared.select("food_id", none("string").alias("canon"), F.col("original_description").alias("lab"),
                          "declaration_group", F.col("label_pos").cast("long").alias("label_pos"),
                          F.col("original_fraction").alias("f"), none("double").alias("threshold"),
                          (none("array<string>") if found is None else F.when(F.size(found) > 0, found)).alias("found"))
    blank = [none(lab.schema[c].dataType.simpleString()).alias(c) for c in ("lab", "declaration_group", "label_pos", "f")]
    canon = ingredients_with_fractions.where(~F.col("is_fortificant")).select(
        "food_id", F.col("description").alias("canon"), *blank, none("double").alias("threshold"), none("array<string>").alias("found"))
    rows = lab.unionByName(canon)
    if records is not None:
        own = records.where(F.col("operator_name") == "less_than_2_pct").select(
            "food_id", none("string").alias("canon"), *blank,
            F.col("config")["threshold"].try_cast("double").alias("threshold"), none("array<string>").alias("found"))
        rows = rows.unionByName(own)
    main = F.col("declaration_group") == "main"
    before = (Window.partitionBy("food_id", "declaration_group").orderBy("label_pos")
              .rowsBetween(Window.unboundedPreceding, -1))
    names = [F.collect_set("canon").alias("canon"), F.collect_set("lab").alias("lab")]
    if any_size:
        rows = ranks.earlier_min(rows, ["food_id", "declaration_group"], [F.col("label_pos")], "f", "least")
        # a name of a food is one row here, and only those of one side are collected
        sides = (rows.withColumn("_name", F.coalesce("canon", "lab")).groupBy("food_id", "_name")
                 .agg(F.max("canon").alias("canon"), F.max("lab").alias("lab"))
                 .where(F.col("canon").isNull() | F.col("lab").isNull()))
        diff = sides.groupBy(F.col("food_id").alias("_food")).agg(*names)
        names = []
    else:
        rows = rows.repartition("food_id").withColumn("least", F.min("f").over(before))
    per = rows.groupBy("food_id").agg(
        *names, F.count_if(main & (F.col("f") > F.col("least") + tol)).alias("n_bad"),
        F.max(F.when(~main, F.col("f"))).alias("max_lt"), F.min(F.when(main, F.col("f"))).alias("min_main"),
        F.coalesce(F.max("threshold"), F.lit(threshold)).alias("lt2_threshold"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("found")))).alias("detected"))
    return per.join(diff, F.col("food_id") == F.col("_food"), "left").drop("_food") if any_size else per


# V1 ----------------------------------------------------------------------------------------
def preservation_issues(canon: Column, lab: Column) -> Column:
    empty = F.array().cast("array<string>")
    canon, lab = F.coalesce(canon, empty), F.coalesce(lab, empty)
    missing, extra = F.array_except(canon, lab), F.array_except(lab, canon)
    return present(
        (F.size(missing) > 0, F.concat(F.lit("Missing: "), F.array_join(F.sort_array(missing), ", "))),
        (F.size(extra) > 0, F.concat(F.lit("Extra: "), F.array_join(F.sort_array(extra), ", "))))


def ingredient_preservation(ingredients_with_fractions, declared, ids=None):
    """Every non-fortificant description appears on the label and nothing else does.

    ``ids`` (food_id) lists every sample to report, including ones with no label rows."""
    canon = (ingredients_with_fractions.where(~F.col("is_fortificant"))
             .groupBy("food_id").agg(F.collect_set("description").alias("canon")))
    lab = declared.groupBy("food_id").agg(F.collect_set("original_description").alias("lab"))
    j = canon.join(lab, "food_id", "full")
    if ids is not None:
        j = ids.select("food_id").join(j, "food_id", "left")
    return _result(j, "ingredient_preservation", preservation_issues(F.col("canon"), F.col("lab")))


# V2 ----------------------------------------------------------------------------------------
def order_violations(declared, threshold: float = 0.02, tol: float = 1e-9):
    """Per food: main-list order violations, oversized 2% rows, group extremes."""
    from pyspark.sql import Window
    main = F.col("declaration_group") == "main"
    w = (Window.partitionBy("food_id", "declaration_group").orderBy("label_pos")
         .rowsBetween(Window.unboundedPreceding, -1))
    d = declared.withColumn("_prev_min", F.min("original_fraction").over(w))
    per = d.groupBy("food_id").agg(
        F.count_if(main & (F.col("original_fraction") > F.col("_prev_min") + tol)).alias("n_bad"),
        F.count_if(~main & (F.col("original_fraction") > threshold + tol)).alias("n_over"),
        F.max(F.when(~main, F.col("original_fraction"))).alias("max_lt"),
        F.min(F.when(main, F.col("original_fraction"))).alias("min_main"))
    return per


def order_issues(n_bad: Column, too_heavy: Column, max_lt: Column, min_main: Column, tol: float = 1e-9) -> Column:
    return present(
        (n_bad > 0, F.concat(n_bad.cast("string"), F.lit(" main-list order violations"))),
        (too_heavy, F.lit("2% group has ingredients above threshold")),
        (max_lt > min_main + tol, F.lit("2% group heavier than main group minimum")))


def ingredient_order(declared, threshold: float = 0.02, tol: float = 1e-9, ids=None):
    """Main list non-increasing (against the running minimum); 2% group within threshold and
    not heavier than the lightest main ingredient. ``label_pos`` orders the label."""
    per = order_violations(declared, threshold, tol)
    if ids is not None:
        per = ids.select("food_id").join(per, "food_id", "left").fillna(0, ["n_bad", "n_over"])
    return _result(per, "ingredient_order", order_issues(F.col("n_bad"), F.col("n_over") > 0, F.col("max_lt"),
                                                         F.col("min_main"), tol))


# V3 ----------------------------------------------------------------------------------------
def syntax_issues(patterns: list[str], maybe: Column | None = None) -> Column:
    """``maybe`` is false where no pattern can match (see ``may_match``)."""
    text = F.coalesce("ingredient_text", F.lit(""))
    panel_text = F.coalesce("panel_text", F.lit(""))
    low, panel_low = F.lower(text), F.lower(panel_text)
    hits = present(*[(guarded_rlike(text, p, low) | guarded_rlike(panel_text, p, panel_low),
                      F.lit(f"Potentially prohibited term: '{p}'")) for p in patterns])
    if maybe is not None:
        hits = F.when(maybe, hits).otherwise(F.array().cast("array<string>"))
    has_panel = F.col("serving_size").isNotNull() | F.col("calories").isNotNull()
    fields = present(
        (~has_panel, F.lit("No Nutrition Facts panel")),
        (has_panel & (F.coalesce("serving_size", F.lit("")) == ""), F.lit("Serving size not set")),
        (has_panel & F.col("total_fat").isNull(), F.lit("Total Fat not set")),
        (has_panel & F.col("sodium").isNull(), F.lit("Sodium not set")),
        (has_panel & F.col("total_carbohydrate").isNull(), F.lit("Total Carbohydrate not set")),
        (has_panel & F.col("protein").isNull(), F.lit("Protein not set")))
    return F.concat(hits, fields)


def fda_syntax(labels, patterns: list[str]):
    """Prohibited terms in label or panel text; panel must exist with its required fields."""
    return _result(labels, "fda_syntax", syntax_issues(patterns))


# V4 ----------------------------------------------------------------------------------------
DECLARABLE = ["crustacean shellfish", "tree nuts", "soybeans", "peanuts", "sesame", "milk",
              "eggs", "wheat", "fish"]


def declared_allergens() -> Column:
    """The stored list with what a word-bounded scan of the declaration text finds; empty without a text."""
    empty = F.array().cast("array<string>")
    text = F.lower(F.col("allergen_text"))
    scanned = present(*[(text.rlike(rf"(?<![a-z0-9]){a}(?![a-z0-9])"), F.lit(a)) for a in DECLARABLE])
    return F.when(text.isNotNull(), F.array_distinct(F.concat(F.coalesce("allergens", empty), scanned))).otherwise(empty)


def without_fish(declared: Column) -> Column:
    """'fish' goes when only crustacean shellfish is declared."""
    empty = F.array().cast("array<string>")
    return F.when(~F.array_contains(F.coalesce("allergens", empty), "fish") & F.array_contains(declared, "crustacean shellfish"),
                  F.array_remove(declared, "fish")).otherwise(declared)


def allergen_issues(detected: Column, declared: Column) -> Column:
    det = F.coalesce(detected, F.array().cast("array<string>"))
    missing, false = F.array_except(det, declared), F.array_except(declared, det)
    return present(
        (F.size(missing) > 0, F.concat(F.lit("Missing allergen declarations: "),
                                       F.array_join(F.sort_array(missing), ", "))),
        (F.size(false) > 0, F.concat(F.lit("Unexpected allergen declarations: "),
                                     F.array_join(F.sort_array(false), ", "))))


def allergen_declaration(labels, detected):
    """Detected allergens (from descriptions) must equal the declared ones (stored list plus
    a word-bounded scan of the declaration text; 'fish' is dropped when only crustacean
    shellfish is declared)."""
    j = labels.join(detected.select("food_id", F.col("allergens").alias("_det")), "food_id", "left")
    j = j.withColumn("_shown", declared_allergens()).withColumn("_shown", without_fish(F.col("_shown")))
    return _result(j, "allergen_declaration", allergen_issues(F.col("_det"), F.col("_shown")))


# V5 ----------------------------------------------------------------------------------------
SOURCE_DISPLAY = [("CALCIUM", "Calcium, Ca"), ("FIBER", "Fiber, total dietary"),
                  ("IRON", "Iron, Fe"), ("POTASSIUM", "Potassium, K"),
                  ("VITAMIN D", "Vitamin D (D2 + D3)"), ("PROTEIN", "Protein")]


def claim_facts(ctx) -> dict[str, Column]:
    """What ``claim_issues`` asks of a food, once for all its claims: amounts too high for 'free', daily values too low for a source."""
    facts = {
        "_sat": F.coalesce(ctx.per_serving("Fatty acids, total saturated"), F.lit(1.0)) >= 0.5,
        "_fat": F.coalesce(ctx.per_serving("Total lipid (fat)"), F.lit(1.0)) >= 0.5,
        "_sodium": F.coalesce(ctx.per_serving("Sodium, Na"), F.lit(1000.0)) >= 5}
    for i, (_, usda) in enumerate(SOURCE_DISPLAY):
        dv = ctx.dv_percent(usda, ctx.per_serving(usda))
        shown = ctx.col(usda, "pos").isNotNull() & dv.isNotNull()
        facts |= {f"_under20_{i}": shown & (dv < 20), f"_under10_{i}": shown & (dv < 10)}
    return facts


def claim_issues() -> Column:
    """On rows that hold ``claims`` and ``claim_facts``."""
    def per_claim(pair):
        c, low = pair["c"], pair["low"]
        checks = [
            (F.col("_sat") & low.contains("saturated fat free"),
             F.lit("'Saturated Fat Free' claim but saturated fat >= 0.5")),
            (F.col("_fat") & low.contains("fat free") & ~low.contains("saturated fat free"),
             F.lit("'Fat Free' claim but fat >= 0.5")),
            (F.col("_sodium") & low.contains("sodium free"), F.lit("'Sodium Free' claim but sodium >= 5")),
        ]
        source = low.contains("good source") | low.contains("excellent source")
        for i, (disp, _) in enumerate(SOURCE_DISPLAY):
            hit, under_10 = F.col(f"_under20_{i}") & low.contains(disp.lower()) & source, F.col(f"_under10_{i}")
            checks.append((hit & under_10 & low.contains("good"),
                           F.concat(F.lit("'"), c, F.lit("' but DV < 10%"))))
            checks.append((hit & ~(under_10 & low.contains("good")) & low.contains("excellent"),
                           F.concat(F.lit("'"), c, F.lit("' but DV < 20%"))))
        return F.array(*[F.when(cond, msg) for cond, msg in checks])

    # lower-cased once a claim; a food's amounts are looked at before the claim's words
    pairs = F.transform(F.coalesce("claims", F.array().cast("array<string>")), lambda c: F.struct(c.alias("c"), F.lower(c).alias("low")))
    return F.filter(F.flatten(F.transform(pairs, per_claim)), lambda x: x.isNotNull())


def claim_eligibility(labels_with_profile, ctx):
    """Each claim must hold for the food's per-serving amounts."""
    return _result(labels_with_profile.withColumns(claim_facts(ctx)), "claim_eligibility", claim_issues())


# V6 ----------------------------------------------------------------------------------------
def facts_issues(ctx, tol: float = 2.0) -> Column:
    has_panel = F.col("calories").isNotNull()
    energy = ctx.rounded("Energy")
    checks = [
        (~has_panel, F.lit("No Nutrition Facts JSON to validate")),
        (has_panel & energy.isNull(), F.lit("Energy nutrient missing from canonical food")),
        (has_panel & (F.abs(energy - F.col("calories")) > tol), F.lit("Calories mismatch")),
    ]
    for col, nutrient, t in (("total_fat", "Total lipid (fat)", tol), ("sodium", "Sodium, Na", tol * 10),
                             ("protein", "Protein", tol)):
        exp = ctx.rounded(nutrient)
        checks.append((has_panel & F.col(col).isNotNull() & exp.isNotNull()
                       & (F.abs(exp - F.col(col)) > t), F.lit(f"{col} mismatch")))
    return present(*checks)


def nutrition_facts_consistency(labels_with_profile, ctx, tol: float = 2.0):
    """Recompute calories, fat, sodium (x10 tolerance) and protein from the nutrients."""
    return _result(labels_with_profile, "nutrition_facts_consistency", facts_issues(ctx, tol))


# V7 ----------------------------------------------------------------------------------------
def all_text() -> Column:
    return F.lower(F.concat(F.coalesce("ingredient_text", F.lit("")), F.lit(" "),
                            F.coalesce("panel_text", F.lit(""))))


def terminology_issues(patterns: list[str], maybe: Column | None = None) -> Column:
    """``maybe`` is false where no pattern can match (see ``may_match``)."""
    text = all_text()
    found = present(*[(guarded_rlike(text, p, text), F.lit(f"Found: '{p}'")) for p in patterns])
    return found if maybe is None else F.when(maybe, found).otherwise(F.array().cast("array<string>"))


def prohibited_terminology(labels, patterns: list[str]):
    return _result(labels, "prohibited_terminology", terminology_issues(patterns))


RULES = ["ingredient_preservation", "ingredient_order", "fda_syntax", "allergen_declaration",
         "claim_eligibility", "nutrition_facts_consistency", "prohibited_terminology"]


# V8 / A9 -----------------------------------------------------------------------------------
def label_issues(labels, patterns: list[str], *keep: str):
    """What the rules find in a label by itself, with the columns of ``keep``: ``_syntax`` and ``_terms`` (issues of V3 and V7) and
    ``_shown`` (declared allergens), so that the label's texts need not be shuffled to the other facts."""
    # what several rules ask for is computed once a food
    labels = labels.withColumns({"_shown": declared_allergens(), "_text": all_text()})
    labels = labels.withColumns({"_shown": without_fish(F.col("_shown")), "_maybe": may_match(F.col("_text"), patterns)})
    return labels.select("food_id", *keep, "_shown", syntax_issues(patterns, F.col("_maybe")).alias("_syntax"),
                         terminology_issues(patterns, F.col("_maybe")).alias("_terms"))


def all_rules(facts, ctx, tol: float = 1e-9):
    """The seven rules on rows that hold ``label_issues``, the label's claims and amounts, the nutrient profile and
    ``ingredient_facts``: (food_id, rules), an array of (rule, passed, issues) in the rules' order."""
    issues = dict(zip(RULES, (
        preservation_issues(F.col("canon"), F.col("lab")),
        order_issues(F.coalesce("n_bad", F.lit(0)), F.col("max_lt") > F.col("lt2_threshold") + tol,
                     F.col("max_lt"), F.col("min_main"), tol),
        F.col("_syntax"), allergen_issues(F.col("detected"), F.col("_shown")), claim_issues(), facts_issues(ctx), F.col("_terms"))))
    # what several claims ask for is computed once a food
    facts = facts.withColumns(claim_facts(ctx))
    found = facts.select("food_id", *[c.alias(rule) for rule, c in issues.items()])
    return found.select("food_id", F.array(*[F.struct(
        F.lit(rule).alias("rule"), (F.size(rule) == 0).alias("passed"), F.col(rule).alias("issues")) for rule in RULES])
        .alias("rules"))


def rule_results(checked):
    """(food_id, rule, passed, issues), one row per rule."""
    # outer: no filter on the array's size is inferred and pushed down, where all rules would be evaluated again for it
    return checked.select("food_id", F.inline_outer("rules"))


def rule_report(checked):
    """Per sample: all_passed, counts, needs_regeneration; no rule repairs, so n_repaired is 0."""
    passed = F.size(F.filter("rules", lambda r: r["passed"]))
    return checked.select(
        "food_id", (passed == F.size("rules")).alias("all_passed"), passed.cast("long").alias("n_passed"),
        (F.size("rules") - passed).cast("long").alias("n_failed"), F.lit(0).alias("n_repaired"),
        (passed < F.size("rules")).alias("needs_regeneration"))
