"""Registered queries over dictionaries of any size and over panel texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from labelcorpus.knowledge import values as V
from labelcorpus.operators import phrases
from labelcorpus.plans import queries as Q
from labelcorpus.sources import testdata as T

register = Q.register


# J2-J4 with every part as a dictionary entry ------------------------------------------------
def _part_names(spark, sf_dir):
    """One declared row per line item: the part's name, on even lines between its type and its brand."""
    li = T.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    p = T.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand")
    longer = F.concat_ws(" ", "p_type", "p_name", "p_brand")
    return li.join(p, li.l_partkey == p.p_partkey).select(
        F.col("l_orderkey").alias("food_id"), F.col("l_linenumber").cast("int").alias("line"), F.col("l_suppkey").alias("supp_key"),
        F.upper(F.when(F.col("l_linenumber") % 2 == 0, longer).otherwise(F.col("p_name"))).alias("declared_name"),
        F.lit(False).alias("is_compound"), F.array().cast("array<string>").alias("sub_ingredients"))


NAMES_SQL = ("nm AS (SELECT l_orderkey AS food_id, CAST(l_linenumber AS INTEGER) AS line, l_suppkey AS supp_key, upper(CASE WHEN l_linenumber % 2 = 0 "
             "THEN concat_ws(' ', p_type, p_name, p_brand) ELSE p_name END) AS name FROM lineitem JOIN part ON l_partkey = p_partkey)")


def _part_dictionary(spark, sf_dir):
    """Part names with their brand, part names in title form, and their first words: (pos, key, generic)."""
    p = T.table(spark, sf_dir, "part")
    words = F.split("p_name", " ")
    names = p.select(F.col("p_partkey").cast("bigint").alias("pos"),
                     F.when(F.col("p_size") % 2 == 0, F.concat_ws(" ", "p_name", "p_brand")).otherwise(F.initcap("p_name")).alias("key"),
                     F.concat_ws(" ", "p_type", F.col("p_size").cast("string")).alias("generic"))
    firsts = p.where(F.col("p_size") % 5 == 0).select(
        (F.col("p_partkey") + 1_000_000_000).cast("bigint").alias("pos"), F.initcap(words[0]).alias("key"),
        F.concat(words[1], F.lit("s")).alias("generic"))
    return names.unionByName(firsts)


def _index_sql() -> str:
    title = "upper(p_name[1]) || split_part(p_name, ' ', 1)[2:] || ' ' || upper(split_part(p_name, ' ', 2)[1]) || split_part(p_name, ' ', 2)[2:]"
    return (
        f"WITH {NAMES_SQL}, raw AS (SELECT p_partkey AS pos, CASE WHEN p_size % 2 = 0 THEN p_name || ' ' || p_brand ELSE {title} END AS key, "
        "p_type || ' ' || p_size AS generic FROM part UNION ALL SELECT p_partkey + 1000000000, upper(p_name[1]) || split_part(p_name, ' ', 1)[2:], "
        "split_part(p_name, ' ', 2) || 's' FROM part WHERE p_size % 5 = 0), "
        "dict AS (SELECT lower(key) AS k, min(pos) AS pos, arg_max(generic, pos) AS g, NOT regexp_matches(key, '(^|[^A-Za-z])[a-z]|[A-Za-z][A-Z]') AS title, "
        "contains(key, ' ') AS many FROM raw GROUP BY key), "
        "d AS (SELECT DISTINCT name, lower(name) AS low, string_split(lower(name), ' ') AS toks FROM nm), "
        "tok AS (SELECT name, toks, unnest(toks) AS t, generate_subscripts(toks, 1) AS ix FROM d), "
        "hit AS (SELECT name, 0 AS kind, 0 AS r, pos, g FROM d JOIN dict ON k = low AND title "
        "UNION ALL SELECT name, 1, -length(k), pos, g FROM d JOIN dict ON many AND contains(low, k) "
        "UNION ALL SELECT name, 2, ix, pos, g FROM tok JOIN dict ON k = t AND title AND NOT many "
        "WHERE list_contains(list_transform(list_filter(toks, lambda x: x <> t), lambda x: regexp_replace(x, 's$', '')), regexp_replace(g, 's$', ''))), "
        "best AS (SELECT name, arg_min(g, (kind, r, pos)) AS g FROM hit GROUP BY name) "
        "SELECT food_id, line, supp_key, coalesce(upper(g), name) AS declared_name, g IS NOT NULL AS generic_name_affected FROM nm LEFT JOIN best USING (name)")


@register("generic_name_index", _index_sql())
def q_generic_name_index(spark, sf_dir):
    """Generic names for every line item with all parts as the dictionary, through joins."""
    out = phrases.generic_name(_part_names(spark, sf_dir), _part_dictionary(spark, sf_dir))
    return out.select("food_id", "line", "supp_key", "declared_name", "generic_name_affected")


@register("compound_index", f"WITH {NAMES_SQL}, s AS (SELECT lower(p_name) AS k, p_type, min(p_partkey) AS pos FROM part GROUP BY 1, 2), "
          "c AS (SELECT k, string_agg(upper(p_type), ', ' ORDER BY pos) AS subs FROM s GROUP BY k) "
          "SELECT food_id, line, supp_key, CASE WHEN subs IS NULL THEN name ELSE name || ' (' || subs || ')' END AS declared_name, "
          "subs IS NOT NULL AS is_compound FROM nm LEFT JOIN c ON k = lower(name)")
def q_compound_index(spark, sf_dir):
    """Compounds for every line item with all part names as keys; the part's types stand for its sub-ingredients."""
    p = T.table(spark, sf_dir, "part")
    dim = p.groupBy(F.initcap("p_name").alias("key"), F.col("p_type").alias("sub_name")).agg(F.min("p_partkey").alias("pos"))
    return phrases.compound(_part_names(spark, sf_dir), dim).select("food_id", "line", "supp_key", "declared_name", "is_compound")


# J12 by joins ---------------------------------------------------------------------------------
@register("keyword_index", "WITH kw AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+ [a-z0-9]+')) AS kw FROM benchmark), "
          "p AS (SELECT 'item ' || item_id AS label, '(^|[^a-z0-9])(' || string_agg(kw, '|') || ')s?([^a-z0-9]|$)' AS pattern FROM kw GROUP BY item_id) "
          "SELECT doc_id, string_agg(label, ',' ORDER BY label) AS labels FROM documents JOIN p ON regexp_matches(lower(text), pattern) GROUP BY doc_id")
def q_keyword_index(spark, sf_dir):
    """Word pairs of all benchmark items as keywords, found in whole documents through joins; an item's label is its number."""
    pairs = F.regexp_extract_all(F.lower("text"), F.lit("[a-z0-9]+ [a-z0-9]+"), F.lit(0))
    keywords = T.table(spark, sf_dir, "benchmark").select(
        F.explode(pairs).alias("keyword"), F.concat(F.lit("item "), F.col("item_id").cast("string")).alias("label"))
    docs = T.table(spark, sf_dir, "documents").select("doc_id", "text")
    return phrases.keyword_labels(docs, "doc_id", "text", keywords).select("doc_id", F.array_join("labels", ",").alias("labels"))


# X11 ------------------------------------------------------------------------------------------
def _panel_text_sql() -> str:
    dv = Q._dv_amounts()
    n0 = "replace(format('{{:.0f}}', {}), ',', '')".format
    n1 = "replace(format('{{:.1f}}', {}), ',', '')".format

    def percent(n):
        return (f"CASE WHEN {Q._ncol(n, 'pos')} IS NOT NULL THEN round_even({Q._sql_round(Q._ps_sql(n, 'first'), n)} / {dv[n]!r} * 100.0, 0) END"
                if n in dv and n in V.PANEL_DV_NUTRIENTS else "CAST(NULL AS DOUBLE)")
    lines = ["'Nutrition Facts'", f"'Serving Size ' || {n0('serving_g')} || 'g'", "''",
             f"'Calories ' || CAST(coalesce(round_even({Q._sql_round(Q._ps_sql('Energy', 'first'), 'Energy')}, 0), 0.0) AS VARCHAR)"]
    for display, n, unit in V.PANEL_ROWS:
        value = Q._sql_round(Q._ps_sql(n, "first"), n)
        amount = n1(value) if unit == "g" else n0(value)
        lines.append(f"CASE WHEN {value} IS NOT NULL THEN {Q._sql_str(display + ' ')} || {amount} || '{unit}' || "
                     f"coalesce('  ' || {n0(percent(n))} || '%', '') END")
    for display, n in V.PANEL_VITAMINS:
        lines.append(f"CASE WHEN {percent(n)} IS NOT NULL THEN {Q._sql_str(display + '  ')} || {n0(percent(n))} || '%' END")
    lines += ["''", Q._sql_str(V.PANEL_FOOTER)]
    return f"WITH {Q._prof_sql()} SELECT food_id, concat_ws(chr(10), {', '.join(lines)}) AS panel_text FROM prof"


@register("panel_text", _panel_text_sql())
def q_panel_text(spark, sf_dir):
    """The rendered Nutrition Facts block of every food."""
    from labelcorpus.operators import nutrition as N
    _, ctx, _, prof = Q._nutrition_frames(spark, sf_dir)
    panel = N.nutrition_panel(prof, ctx)
    return panel.select("food_id", N.panel_text(panel).alias("panel_text"))


# X13 ------------------------------------------------------------------------------------------
def _dv_text_sql() -> str:
    case = "CASE name " + " ".join(f"WHEN {Q._sql_str(n)} THEN {a!r}" for n, a in Q._dv_amounts().items()) + " END"
    return (f"WITH nut AS {T.sql_nutrients()}, serv AS ({Q._serving_sql(rounded=False)}), d AS (SELECT n.food_id, n.pos, n.name, "
            f"n.amount * s.serving_g / 100.0 / ({case}) * 100.0 AS dv FROM nut n JOIN serv s USING (food_id)) "
            "SELECT food_id, pos, name, CAST(CAST(round_even(dv, 0) AS BIGINT) AS VARCHAR) || '%' AS dv_text FROM d")


@register("daily_value_text", _dv_text_sql())
def q_daily_value_text(spark, sf_dir):
    """Daily values as whole percent; null where a nutrient has none."""
    from labelcorpus.functions.columns import dv_text
    from labelcorpus.operators import nutrition as N
    k, _, served, _ = Q._nutrition_frames(spark, sf_dir)
    rows = N.daily_value_rows(N.per_serving_rows(T.nutrients(spark, sf_dir), served), k.daily_values)
    return rows.select("food_id", "pos", "name", dv_text(F.col("dv_percent")).alias("dv_text"))


# X14 ------------------------------------------------------------------------------------------
def _generic_panel_sql() -> str:
    n0 = "replace(format('{{:.0f}}', {}), ',', '')".format
    amount = "n.amount * s.serving_g / 100.0"
    unit = "CASE n.name " + " ".join(f"WHEN {Q._sql_str(name)} THEN '{u}'" for _, _, name, u, _ in T.NUTRIENT_MAP) + " END"
    return (f"WITH nut AS {T.sql_nutrients()}, serv AS ({Q._serving_sql(rounded=False)}), g AS (SELECT n.food_id, s.serving_g, "
            f"string_agg(n.name || ' ' || {n0(amount)} || {unit}, chr(10) ORDER BY n.pos) FILTER (WHERE n.name <> 'Energy') AS body, "
            f"max({n0(amount)}) FILTER (WHERE n.name = 'Energy') AS kcal FROM nut n JOIN serv s USING (food_id) GROUP BY 1, 2) "
            f"SELECT food_id, concat_ws(chr(10), 'Nutrition Facts', 'Serving Size ' || {n0('serving_g')} || 'g', '', 'Calories ' || kcal, "
            f"coalesce(body, ''), '', {Q._sql_str(V.PANEL_FOOTER)}) AS panel_text FROM g")


@register("generic_panel_text", _generic_panel_sql())
def q_generic_panel_text(spark, sf_dir):
    """The generic block: serving, calories and one line for each further nutrient of the food, unrounded by rule."""
    from labelcorpus.functions.columns import fmt0
    from labelcorpus.operators import nutrition as N
    _, _, served, _ = Q._nutrition_frames(spark, sf_dir)
    rows = N.per_serving_rows(T.nutrients(spark, sf_dir), served)
    energy = F.col("name") == "Energy"
    line = F.concat("name", F.lit(" "), fmt0(F.col("per_serving")), "unit")
    foods = rows.groupBy("food_id").agg(
        F.first("serving_g").alias("serving_g"), F.max(F.when(energy, fmt0(F.col("per_serving")))).alias("kcal"),
        F.array_sort(F.collect_list(F.when(~energy, F.struct("pos", line.alias("line"))))).alias("lines"))
    return foods.select("food_id", N.generic_panel_text(
        F.concat(fmt0(F.col("serving_g")), F.lit("g")), F.col("kcal"), F.transform("lines", lambda x: x["line"])).alias("panel_text"))
