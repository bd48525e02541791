"""Nutrition operators: per-serving amounts, rounding, panel, daily values and claims
(X4, X5, J10, J13-J15, A5-A7, W5, X8, L6, L7).

All per-food work happens in a single conditional aggregate over the long nutrient table
(partial aggregation, so a food with very many nutrient rows is combined map-side), joined
once to the foods' serving sizes. Claims and the panel are then column expressions on that
one row per food; the threshold tables become literal expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelcorpus.functions.columns import (
    claim_type, contains_any, fda_round, fda_round_sql, fmt0, fmt1, half_even)
from labelcorpus.knowledge import values as V
from labelcorpus.knowledge.dims import rule_rows


def _slot(i: int) -> str:
    return f"n{i}"


def nutrient_names() -> list[str]:
    names: list[str] = []
    for group in (
        [n for _, n in V.PANEL_COLUMNS], [n for _, n in V.CLAIM_GROUPS],
        [n for n, _ in V.SOURCE_NUTRIENTS], [h[0] for h in V.HEALTH_CLAIMS],
        V.PANEL_DV_NUTRIENTS,
    ):
        for n in group:
            if n not in names:
                names.append(n)
    return names


def nutrient_profile(nutrients: DataFrame, names: list[str] | None = None) -> DataFrame:
    """One row per food: for each named nutrient, its last amount (a repeated name keeps the
    last value, A5), first amount (the panel keeps the first, A6) and first position.

    Columns ``n{i}_last``, ``n{i}_first``, ``n{i}_pos`` follow the order of ``names``;
    ``n_nutrients`` counts every nutrient row.
    """
    names = nutrient_names() if names is None else names
    # numbers of fixed width in one hash aggregate: nothing is sorted, no lists are kept, and it is combined before any shuffle
    aggs = [F.count(F.lit(1)).alias("n_nutrients")]
    for i, name in enumerate(names):
        amount, pos = (F.when(F.col("name") == name, F.col(c)) for c in ("amount", "pos"))
        aggs += [F.max_by(amount, pos).alias(f"{_slot(i)}_last"), F.min_by(amount, pos).alias(f"{_slot(i)}_first"),
                 F.min(pos).alias(f"{_slot(i)}_pos")]
    return nutrients.groupBy("food_id").agg(*aggs)


class NutrientContext:
    """Driver-side view of the knowledge tables used to build expressions."""

    def __init__(self, dv_dim: DataFrame, rounding_dim: DataFrame,
                 names: list[str] | None = None):
        self.names = nutrient_names() if names is None else names
        self.index = {n: i for i, n in enumerate(self.names)}
        self.dv = {r["nutrient_name"]: r["dv_amount"] for r in rule_rows(dv_dim)
                   if r["dv_amount"] is not None and r["dv_amount"] > 0}
        self.rounding = {r["nutrient"]: r for r in rule_rows(rounding_dim)}

    def col(self, name: str, kind: str) -> Column:
        if name not in self.index:
            return F.lit(None).cast("double")
        return F.col(f"{_slot(self.index[name])}_{kind}")

    def _per_serving_expr(self, name: str, kind: str) -> Column:
        """Amount per 100 g * serving / 100."""
        return self.col(name, kind) * F.col("serving_g") / F.lit(100.0)

    def _rounded_expr(self, name: str) -> Column:
        """X5 on the first occurrence (panel value)."""
        r = self.rounding.get(name)
        if name not in self.index:
            return F.lit(None).cast("double")
        value = f"(`{_slot(self.index[name])}_first` * serving_g / 100.0D)"
        if r is None:
            return F.expr(value)
        return fda_round_sql(value, r["zero_below"], r["fine_step"], r["fine_upto"],
                             r["coarse_step"])

    def add_serving_columns(self, profile_with_serving: DataFrame) -> DataFrame:
        """Materialise, once per food, each nutrient's per-serving amount (last occurrence,
        ``n{i}_ps``) and rounded panel value (first occurrence, ``n{i}_pv``); the panel,
        claims and validation rules reference these columns."""
        cols = []
        for i, name in enumerate(self.names):
            cols.append(self._per_serving_expr(name, "last").alias(f"{_slot(i)}_ps"))
            cols.append(self._rounded_expr(name).alias(f"{_slot(i)}_pv"))
        return profile_with_serving.select("*", *cols)

    def per_serving(self, name: str) -> Column:
        """Per-serving amount of the last occurrence (needs ``add_serving_columns``)."""
        return self.col(name, "ps")

    def rounded(self, name: str) -> Column:
        """Rounded per-serving panel value (needs ``add_serving_columns``)."""
        return self.col(name, "pv")

    def dv_percent(self, name: str, amount: Column) -> Column:
        """Amount / DV * 100; null when the DV is unknown."""
        dv = self.dv.get(name)
        return F.lit(None).cast("double") if dv is None else amount / F.lit(float(dv)) * 100.0


# L7 / A6 / A7 ------------------------------------------------------------------------------
def nutrition_panel(profile_with_serving: DataFrame, ctx: NutrientContext,
                    keep: list[str] | None = None) -> DataFrame:
    """Panel columns per food: serving text, calories, 14 rounded amounts, daily values
    (plus any ``keep`` columns carried through)."""
    cols = [F.col("food_id"), *[F.col(c) for c in (keep or [])],
            F.concat(fmt0(F.col("serving_g")), F.lit("g")).alias("serving_size")]
    energy = ctx.rounded("Energy")
    cols.append(F.coalesce(half_even(energy), F.lit(0.0)).alias("calories"))
    for col_name, nutrient in V.PANEL_COLUMNS[1:]:
        cols.append(ctx.rounded(nutrient).alias(col_name))
    entries = [F.struct(F.lit(n).alias("key"),
                        half_even(ctx.dv_percent(n, ctx.rounded(n))).alias("value"))
               for n in V.PANEL_DV_NUTRIENTS]
    dv = F.map_from_entries(F.filter(F.array(*entries), lambda e: e["value"].isNotNull()))
    cols.append(dv.alias("daily_values"))
    return profile_with_serving.select(*cols)


def panel_text(panel: DataFrame, servings_per_container: Column | None = None) -> Column:
    """X11: the rendered Nutrition Facts block of one panel row."""
    lines = [F.lit("Nutrition Facts"), F.concat(F.lit("Serving Size "), F.col("serving_size"))]
    if servings_per_container is not None:
        lines.append(F.when(servings_per_container.isNotNull() & (servings_per_container != ""),
                            F.concat(F.lit("Servings Per Container "), servings_per_container)))
    lines += [F.lit(""), F.concat(F.lit("Calories "), F.col("calories").cast("string"))]
    by_name = {n: c for c, n in V.PANEL_COLUMNS}
    for display, nutrient, unit in V.PANEL_ROWS:
        value = F.col(by_name[nutrient])
        dv = F.try_element_at(F.col("daily_values"), F.lit(nutrient))
        amount = fmt1(value) if unit == "g" else fmt0(value)
        lines.append(F.when(value.isNotNull(), F.concat(
            F.lit(display + " "), amount, F.lit(unit),
            F.coalesce(F.concat(F.lit("  "), fmt0(dv), F.lit("%")), F.lit("")))))
    for display, nutrient in V.PANEL_VITAMINS:
        dv = F.try_element_at(F.col("daily_values"), F.lit(nutrient))
        lines.append(F.when(dv.isNotNull(), F.concat(F.lit(display + "  "), fmt0(dv), F.lit("%"))))
    lines += [F.lit(""), F.lit(V.PANEL_FOOTER)]
    return F.concat_ws("\n", *lines)


# L6 / J13-J15 / W5 / X8 --------------------------------------------------------------------
def claim_arrays(ctx: NutrientContext, content_dim: DataFrame, source_dim: DataFrame,
                 health_dim: DataFrame, liquid_words=V.LIQUID_WORDS,
                 food_name: str = "food_name") -> dict[str, Column]:
    """Column expressions for content, source and health claim texts of one food row."""
    liquid = contains_any(F.col(food_name), liquid_words)

    content = []
    rows = sorted(rule_rows(content_dim),
                  key=lambda r: (r["group_pos"], r["claim_pos"], r["kind_pos"]))
    for r in rows:
        ps, p100 = ctx.per_serving(r["nutrient"]), ctx.col(r["nutrient"], "last")
        present = ctx.col(r["nutrient"], "pos").isNotNull()
        th = F.lit(float(r["threshold"]))
        cond = {"per_serving": ps < th, "per_100g": p100 < th,
                "per_100g_solid": ~liquid & (p100 < th),
                "per_100g_liquid": liquid & (p100 < th)}[r["kind"]]
        content.append(F.when(present & cond, F.lit(r["text"])))
    content_col = F.filter(F.array(*content), lambda x: x.isNotNull()) if content else \
        F.array().cast("array<string>")

    source = []
    for r in rule_rows(source_dim):
        n = r["nutrient"]
        dv = ctx.dv_percent(n, ctx.per_serving(n))
        text = (F.when(dv >= 20, F.lit(f"EXCELLENT SOURCE OF {r['display']}"))
                .when(dv >= 10, F.lit(f"GOOD SOURCE OF {r['display']}")))
        source.append(F.struct(ctx.col(n, "pos").alias("p"), text.alias("t")))
    source_col = F.transform(
        F.array_sort(F.filter(F.array(*source), lambda s: s["p"].isNotNull() & s["t"].isNotNull())),
        lambda s: s["t"]) if source else F.array().cast("array<string>")

    health = []
    for r in sorted(rule_rows(health_dim), key=lambda r: r["pos"]):
        ps = ctx.per_serving(r["nutrient"])
        th = F.lit(float(r["threshold"]))
        cond = ps < th if r["cmp"] == "below" else ps > th
        health.append(F.when(ctx.col(r["nutrient"], "pos").isNotNull() & cond, F.lit(r["text"])))
    health_col = F.filter(F.array(*health), lambda x: x.isNotNull()) if health else \
        F.array().cast("array<string>")
    return {"content": content_col, "source": source_col, "health": health_col}


def food_claims(profile_with_serving: DataFrame, ctx: NutrientContext, content_dim: DataFrame,
                source_dim: DataFrame, health_dim: DataFrame) -> DataFrame:
    """Per food: ``claims`` (deduplicated, first occurrence kept), types and counts."""
    parts = claim_arrays(ctx, content_dim, source_dim, health_dim)
    claims = F.array_distinct(F.concat(parts["content"], parts["source"], parts["health"]))
    return profile_with_serving.select(
        "food_id", claims.alias("claims"),
        F.col("n_nutrients"))


def claim_rows(food_claims_df: DataFrame) -> DataFrame:
    """Long table (food_id, claim_pos, claim_text, claim_type)."""
    return (food_claims_df.select("food_id", F.posexplode("claims").alias("claim_pos", "claim_text"))
            .withColumn("claim_type", claim_type(F.col("claim_text"), V.CONTENT_CLAIM_WORDS)))


# Long-form helpers (X4, X5, J10 on one row per food and nutrient) --------------------------
def per_serving_rows(nutrients: DataFrame, servings: DataFrame) -> DataFrame:
    """X4 on the long table: nutrients joined to their food's serving size."""
    return (nutrients.join(servings.select("food_id", "serving_g"), "food_id")
            .withColumn("per_serving", F.col("amount") * F.col("serving_g") / F.lit(100.0)))


def round_rows(rows: DataFrame, rounding_dim: DataFrame) -> DataFrame:
    """X5 on the long table: join with the rounding steps (unknown names unrounded)."""
    r = rounding_dim.withColumnRenamed("nutrient", "_rname")
    out = rows.join(r, rows["name"] == r["_rname"], "left")
    return out.withColumn("rounded", fda_round(
        F.col("per_serving"), F.col("zero_below"), F.col("fine_step"), F.col("fine_upto"),
        F.col("coarse_step"))).drop("_rname", "zero_below", "fine_step", "fine_upto",
                                    "coarse_step")


def daily_value_rows(rows: DataFrame, dv_dim: DataFrame, amount_col: str = "per_serving") -> DataFrame:
    """J10 on the long table: amount / DV * 100 (null when the DV is unknown)."""
    d = dv_dim.select(F.col("nutrient_name").alias("_dname"), "dv_amount")
    out = rows.join(d, rows["name"] == d["_dname"], "left")
    return out.withColumn(
        "dv_percent", F.when(F.col("dv_amount") > 0,
                             F.col(amount_col) / F.col("dv_amount") * 100.0)).drop("_dname")


# X7 ----------------------------------------------------------------------------------------
def claim_text(claim_id: Column, texts_dim: DataFrame, percent: Column | None = None) -> Column:
    """Template for a claim id; an unknown id passes through; {percent} filled only if given."""
    rows = rule_rows(texts_dim)
    tmap = F.create_map(*[x for r in rows for x in (F.lit(r["claim"]), F.lit(r["text"]))])
    t = F.coalesce(F.try_element_at(tmap, claim_id), claim_id)
    if percent is None:
        return t
    return F.when(percent.isNotNull() & (F.instr(t, "{percent}") > 0),
                  F.replace(t, F.lit("{percent}"), percent.cast("string"))).otherwise(t)


# X14 ---------------------------------------------------------------------------------------
def generic_panel_text(serving_text: Column, calories: Column, lines: Column) -> Column:
    """Header, serving, calories, the given lines, blank line, footer."""
    return F.concat_ws("\n", F.lit("Nutrition Facts"), F.concat(F.lit("Serving Size "), serving_text),
                       F.lit(""), F.concat(F.lit("Calories "), calories.cast("string")),
                       F.array_join(lines, "\n"), F.lit(""), F.lit(V.PANEL_FOOTER))
