"""Registered queries over the driver's test tables, each paired with DuckDB oracle SQL.

Every query reads the given tables (through the adapter in ``sources.testdata``) and runs
the library's operators on all of their rows. Column names match between the Spark result
and the SQL; doubles are rounded identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelcorpus.plans import labels as L
from labelcorpus.operators import recipes as R
from labelcorpus.sources import testdata as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# Shared SQL building blocks -----------------------------------------------------------------
ING = T.sql_ingredients()
FR = (f"ing AS ({ING}), "
      "tot AS (SELECT food_id, count(*) AS n, sum(weight_g) AS total FROM ing GROUP BY food_id), "
      "fr AS (SELECT ing.*, tot.n, CASE WHEN tot.total > 0 THEN ing.weight_g / tot.total "
      "ELSE 0.0 END AS f FROM ing JOIN tot USING (food_id))")
SEL = ("sel AS (SELECT * FROM fr WHERE n BETWEEN 2 AND 50), "
       "lab AS (SELECT sel.*, CAST(row_number() OVER (PARTITION BY food_id ORDER BY f DESC, "
       "sequence_number, pos, pos2) AS INTEGER) AS label_pos FROM sel WHERE NOT is_fortificant)")


def q(col, digits: int = 6):
    """Round for comparison: floor(x * 10^k + 0.5) / 10^k, the same IEEE steps as ``sq``."""
    scale = float(10 ** digits)
    c = F.col(col) if isinstance(col, str) else col
    return F.floor(c * scale + 0.5) / scale


def sq(expr: str, digits: int = 6) -> str:
    return f"(floor(({expr}) * {float(10 ** digits)!r} + 0.5) / {float(10 ** digits)!r})"


def _selected(spark: SparkSession, sf_dir: str, min_n: int = 2, max_n: int = 50) -> DataFrame:
    return R.select_recipes(T.ingredients(spark, sf_dir), min_n, max_n)


# S3 / P2 / P3 -------------------------------------------------------------------------------
@register("fractions", f"WITH {FR} SELECT food_id, sequence_number, code, pos2 AS supp_key, "
          "description, " + sq("f", 9) + " AS fraction FROM fr WHERE NOT is_fortificant")
def q_fractions(spark, sf_dir):
    fr = R.drop_fortificants(R.with_fractions(T.ingredients(spark, sf_dir)))
    return fr.select("food_id", "sequence_number", "code", F.col("pos2").alias("supp_key"),
                     "description", q("fraction", 9).alias("fraction"))


# P1 -----------------------------------------------------------------------------------------
@register("recipe_size_filter", f"WITH {FR} SELECT DISTINCT food_id, n AS n_ingredients FROM fr "
          "WHERE n BETWEEN 2 AND 50")
def q_recipe_size_filter(spark, sf_dir):
    return R.recipe_ids(T.ingredients(spark, sf_dir), 2, 50)


# A1 / A2 ------------------------------------------------------------------------------------
@register("recipe_statistics",
          f"WITH {FR}, c AS (SELECT DISTINCT food_id, n FROM fr) SELECT "
          "(SELECT count(*) FROM orders) AS total_foods, "
          "count(*) FILTER (WHERE n BETWEEN 1 AND 50) AS recipes_with_ingredients, "
          + ", ".join(f"count(*) FILTER (WHERE n BETWEEN {k} AND 50) AS recipes_ge_{k}_ingredients"
                      for k in (2, 3, 5, 10, 15)) + " FROM c")
def q_recipe_statistics(spark, sf_dir):
    return R.recipe_statistics(T.foods(spark, sf_dir), T.ingredients(spark, sf_dir))


# W1 / P4 ------------------------------------------------------------------------------------
@register("label_order", f"WITH {FR}, {SEL} SELECT food_id, label_pos, description AS "
          "original_description, upper(description) AS declared_name, " + sq("f", 9) + " AS fraction "
          "FROM lab")
def q_label_order(spark, sf_dir):
    d = R.initial_declared(_selected(spark, sf_dir))
    return d.select("food_id", "label_pos", "original_description", "declared_name",
                    q("original_fraction", 9).alias("fraction"))


# L4 -----------------------------------------------------------------------------------------
@register("two_percent_group", f"WITH {FR}, {SEL} SELECT food_id, label_pos, CASE WHEN f <= 0.02 "
          "THEN 'two_percent_or_less' ELSE 'main' END AS declaration_group FROM lab")
def q_two_percent_group(spark, sf_dir):
    d = R.less_than_2_pct(R.initial_declared(_selected(spark, sf_dir)), 0.02)
    return d.select("food_id", "label_pos", "declaration_group")


# X9 with the naming chain (minimum slice) ------------------------------------------------------
RENDERED_SQL = (
    f"WITH {FR}, {SEL}, g AS (SELECT food_id, "
    "string_agg(upper(description), ', ' ORDER BY label_pos) FILTER (WHERE f > 0.02) AS m, "
    "string_agg(upper(description), ', ' ORDER BY label_pos) FILTER (WHERE f <= 0.02) AS t "
    "FROM lab GROUP BY food_id), ids AS (SELECT DISTINCT food_id FROM sel) "
    "SELECT ids.food_id, 'INGREDIENTS: ' || concat_ws(', ', m, "
    "'CONTAINS 2% OR LESS OF: ' || t) || '.' AS ingredient_text FROM ids LEFT JOIN g USING (food_id)")


@register("rendered_label", RENDERED_SQL)
def q_rendered_label(spark, sf_dir):
    k = L.Knowledge.default(spark)
    fr = _selected(spark, sf_dir)
    declared = L.declared_rows(fr, k, ["rename", "generic_name", "compound", "less_than_2_pct"])
    ids = fr.select("food_id").distinct()
    lists = ids.join(L.label_lists(declared), "food_id", "left")
    empty = F.array().cast("array<string>")
    text = L.ingredient_text(F.coalesce("main_names", empty), F.coalesce("two_percent_names", empty),
                             F.lit(None).cast("string"), empty)
    return lists.select("food_id", text.alias("ingredient_text"))


# ---------------------------------------------------------------------------------------------
# Knowledge over the part vocabulary (8 adjectives x 8 nouns), used where the food tables'
# own words never occur in the test tables. They are query parameters, not library data.
PART_LEXICON = [("small bolt", "SMALL ZINC BOLT"), ("red gear", "GEAR")]
PART_COMMERCIAL = [("small bolt", "BOLT"), ("blue plate", "BLUE PLATE"), ("old anvil", "ANVIL"),
                   ("cold rod", "COLD, ROLLED ROD")]
PART_GENERIC = [("Blue Plate", "DISHES"), ("cold ring", "RINGS"), ("large widget", "WIDGETS"),
                ("Hot", "HOT RODS"), ("Old", "OLD GEARS"), ("Anvil", "ANVILS"), ("New", "NEW")]
PART_COMPOUNDS = [("Old Bolt", [("iron", 0.6), ("rust", 0.4)]),
                  ("Hot Gizmo", [("copper", 0.5), ("wire", 0.3), ("solder", 0.2)]),
                  ("blue ring", [("steel", 1.0)])]


def _dim(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def _values_sql(rows, cols) -> str:
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return repr(v)
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS v({', '.join(cols)})"


# J1 / X1 ------------------------------------------------------------------------------------
RENAME_SQL = (
    f"WITH {FR}, {SEL} SELECT food_id, label_pos, coalesce(lx.n, cm.n, upper(regexp_replace("
    "regexp_replace(trim(regexp_replace(description, '\\s+', ' ', 'g')), '\\s*,\\s*', ' ', 'g'), "
    "'\\s+', ' ', 'g'))) AS declared_name, "
    "coalesce(lx.n, cm.n, upper(regexp_replace(regexp_replace(trim(regexp_replace(description, "
    "'\\s+', ' ', 'g')), '\\s*,\\s*', ' ', 'g'), '\\s+', ' ', 'g'))) <> upper(description) "
    "AS rename_affected FROM lab "
    f"LEFT JOIN {_values_sql(PART_LEXICON, ['d', 'n'])[:-len(' AS v(d, n)')]} AS lx(d, n) "
    "ON lx.d = description "
    f"LEFT JOIN {_values_sql(PART_COMMERCIAL, ['d', 'n'])[:-len(' AS v(d, n)')]} AS cm(d, n) "
    "ON cm.d = description")


@register("rename_lookup", RENAME_SQL)
def q_rename_lookup(spark, sf_dir):
    from labelcorpus.operators import naming
    schema = "description string, name string, pos int"
    lex = _dim(spark, [(d, n, i) for i, (d, n) in enumerate(PART_LEXICON)], schema)
    com = _dim(spark, [(d, n, i) for i, (d, n) in enumerate(PART_COMMERCIAL)], schema)
    d = naming.rename(R.initial_declared(_selected(spark, sf_dir)), lex, com)
    return d.select("food_id", "label_pos", "declared_name", "rename_affected")


def _sql_str(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def re2_bounds(pattern: str) -> str:
    """DuckDB (RE2) form of a Java/Python pattern: word boundaries made Unicode-aware."""
    p = pattern
    if p.startswith(r"\b"):
        p = r"(?:^|[^\pL\pN_])" + p[2:]
    if p.endswith(r"\b"):
        p = p[:-2] + r"(?:[^\pL\pN_]|$)"
    return "(?i)" + p


# J2-J4 / L2 ---------------------------------------------------------------------------------
def _generic_sql(name: str) -> str:
    keys = PART_GENERIC
    whole = [(k.lower(), g) for k, g in keys if k == k.title()]
    whole_sql = "CASE lower(" + name + ") " + " ".join(
        f"WHEN {_sql_str(k)} THEN {_sql_str(g)}" for k, g in whole) + " END"
    phrases = sorted([(k, g) for k, g in keys if len(k.split()) >= 2], key=lambda kv: -len(kv[0]))
    phrase_sql = "CASE " + " ".join(
        f"WHEN instr(lower({name}), {_sql_str(k.lower())}) > 0 THEN {_sql_str(g)}"
        for k, g in phrases) + " END"
    words = [(k.lower(), g) for k, g in keys if k == k.title() and len(k.split()) == 1]
    toks = f"list_filter(string_split(trim({name}), ' '), lambda t: t <> '')"
    stripped = (f"list_filter(list_transform({toks}, lambda t: lower(regexp_replace(t, "
                "'^[ ,()]+|[ ,()]+$', '', 'g'))), lambda t: t <> '')")

    def targets(g):
        ws = [w.strip(" ,()").lower().removesuffix("s") for w in g.split() if w.strip(" ,()")]
        return "[" + ", ".join(_sql_str(w) for w in ws) + "]"
    guard = "CASE x " + " ".join(
        f"WHEN {_sql_str(k)} THEN list_has_any(list_transform(list_filter({stripped}, "
        f"lambda w: w <> x), lambda w: regexp_replace(w, 's$', '')), {targets(g)})"
        for k, g in words) + " ELSE false END"
    hit = f"list_filter(list_transform({toks}, lambda t: lower(t)), lambda x: {guard})[1]"
    word_sql = "CASE " + hit + " " + " ".join(
        f"WHEN {_sql_str(k)} THEN {_sql_str(g)}" for k, g in words) + " END"
    return f"coalesce({whole_sql}, {phrase_sql}, {word_sql})"


GENERIC_SQL = (f"WITH {FR}, {SEL}, x AS (SELECT food_id, label_pos, upper(description) AS nm "
               f"FROM lab) SELECT food_id, label_pos, coalesce(upper({_generic_sql('nm')}), nm) "
               f"AS declared_name, {_generic_sql('nm')} IS NOT NULL AS generic_name_affected FROM x")


@register("generic_names", GENERIC_SQL)
def q_generic_names(spark, sf_dir):
    from labelcorpus.operators import naming
    dim = _dim(spark, [(i, k, g) for i, (k, g) in enumerate(PART_GENERIC)],
               "pos int, key string, generic string")
    d = naming.generic_name(R.initial_declared(_selected(spark, sf_dir)), dim)
    return d.select("food_id", "label_pos", "declared_name", "generic_name_affected")


# J5 / L3 ------------------------------------------------------------------------------------
COMPOUND_SQL = (
    f"WITH {FR}, {SEL}, x AS (SELECT food_id, label_pos, upper(description) AS nm FROM lab), "
    "y AS (SELECT *, CASE lower(nm) " + " ".join(
        f"WHEN {_sql_str(k.lower())} THEN {_sql_str(', '.join(s.upper() for s, _ in subs))}"
        for k, subs in PART_COMPOUNDS if k == k.title()) + " END AS subs FROM x) "
    "SELECT food_id, label_pos, CASE WHEN subs IS NULL THEN nm ELSE nm || ' (' || subs || ')' END "
    "AS declared_name, subs IS NOT NULL AS is_compound, coalesce(subs, '') AS sub_ingredients FROM y")


@register("compound_expand", COMPOUND_SQL)
def q_compound_expand(spark, sf_dir):
    from labelcorpus.operators import naming
    rows = [(k, i, s, f) for k, subs in PART_COMPOUNDS for i, (s, f) in enumerate(subs)]
    dim = _dim(spark, rows, "key string, pos int, sub_name string, fraction double")
    d = naming.compound(R.initial_declared(_selected(spark, sf_dir)), dim)
    return d.select("food_id", "label_pos", "declared_name", "is_compound",
                    F.array_join("sub_ingredients", ", ").alias("sub_ingredients"))


# J12 over whole documents -------------------------------------------------------------------
def _allergen_sql(text: str) -> str:
    from labelcorpus.knowledge import values as V
    by_label: dict[str, list[str]] = {}
    for kw, label in V.ALLERGEN_KEYWORDS:
        by_label.setdefault(label, []).append(kw)
    parts = []
    for label, kws in sorted(by_label.items()):
        alts = "|".join(sorted(kws, key=len, reverse=True))
        pat = f"(^|[^a-z0-9])({alts})s?([^a-z0-9]|$)"
        parts.append(f"CASE WHEN regexp_matches(lower({text}), {_sql_str(pat)}) "
                     f"THEN {_sql_str(label)} END")
    excl = " OR ".join(f"regexp_matches({text}, {_sql_str(re2_bounds(p))})"
                       for p in V.ALLERGEN_EXCLUSIONS)
    return f"CASE WHEN {excl} THEN '' ELSE concat_ws(',', {', '.join(parts)}) END"


@register("keyword_tags", f"SELECT doc_id, {_allergen_sql('text')} AS allergens FROM documents")
def q_keyword_tags(spark, sf_dir):
    from labelcorpus.operators import tags
    k = L.Knowledge.default(spark)
    from labelcorpus.functions.columns import ascii_word_tokens
    docs = (T.table(spark, sf_dir, "documents").select("doc_id", "text")
            .withColumn("_tok", ascii_word_tokens("text")))
    found = tags.allergen_column(F.col("text"), k.allergen_keywords, k.allergen_exclusions,
                                 F.col("_tok"))
    return docs.select("doc_id", F.array_join(found, ",").alias("allergens"))


# J11 / J7 over whole documents --------------------------------------------------------------
def _first_match_sql(text: str, pairs: list[tuple[str, str]]) -> str:
    return "CASE " + " ".join(
        f"WHEN regexp_matches({text}, {_sql_str(re2_bounds(p))}) THEN {_sql_str(label)}"
        for p, label in pairs) + " END"


def _class_sql() -> str:
    from labelcorpus.knowledge import values as V
    cats = [(p, l) for l, p in V.INGREDIENT_CATEGORIES]
    foods = list(V.FOOD_NAME_KEYWORDS)
    return (f"SELECT doc_id, {_first_match_sql('text', cats)} AS ingredient_class, "
            f"{_first_match_sql('text', foods)} AS food_class FROM documents")


@register("first_match_class", _class_sql())
def q_first_match_class(spark, sf_dir):
    from labelcorpus.operators import tags
    k = L.Knowledge.default(spark)
    from labelcorpus.functions.columns import word_tokens
    docs = (T.table(spark, sf_dir, "documents").select("doc_id", "text")
            .withColumn("_low", F.lower("text")).withColumn("_tok", word_tokens("_low"))
            .withColumn("_hc", tags.word_hits(F.col("_tok"), k.categories))
            .withColumn("_hf", tags.word_hits(F.col("_tok"), k.food_keywords)))
    low = F.col("_low")
    return docs.select(
        "doc_id",
        tags.first_match_class(F.col("text"), k.categories, F.col("_hc"), low)
        .alias("ingredient_class"),
        tags.first_match_class(F.col("text"), k.food_keywords, F.col("_hf"), low)
        .alias("food_class"))


# J6 / J8 / J9 -------------------------------------------------------------------------------
def _serving_sql(rounded: bool = True) -> str:
    from labelcorpus.knowledge import values as V
    prefix = "CASE substr(food_code, 1, 2) " + " ".join(
        f"WHEN {_sql_str(p)} THEN {_sql_str(c)}" for p, c in V.CODE_PREFIXES) + " END"
    racc_amt = {c: (g if g > 0 else ml) for c, g, ml, _, _ in V.RACC if g > 0 or ml > 0}

    def racc(col):
        return "CASE " + col + " " + " ".join(
            f"WHEN {_sql_str(c)} THEN {float(a)!r}" for c, a in racc_amt.items()) + " END"
    name_cls = _first_match_sql("food_name", list(V.FOOD_NAME_KEYWORDS))
    serving = ("coalesce(CASE WHEN serving_size_g BETWEEN 5 AND 500 THEN serving_size_g END, "
               f"CASE WHEN length(food_code) > 0 THEN {racc('code_category')} END, "
               f"CASE WHEN length(food_name) > 0 THEN {racc('name_category')} END, 100.0)")
    return (f"WITH f AS ({T.sql_foods()}), c AS (SELECT *, CASE WHEN length(food_code) >= 2 THEN "
            f"coalesce({prefix}, 'uncategorized') ELSE 'uncategorized' END AS code_category, "
            f"{name_cls} AS name_category FROM f) SELECT food_id, code_category, name_category, "
            + (sq(serving) if rounded else serving) + " AS serving_g FROM c")


@register("serving_fallback", _serving_sql())
def q_serving_fallback(spark, sf_dir):
    from labelcorpus.operators import tags
    k = L.Knowledge.default(spark)
    s = tags.serving_size(T.foods(spark, sf_dir), k.prefixes, k.food_keywords, k.racc)
    return s.select("food_id", "code_category", "name_category",
                    q("serving_g").alias("serving_g"))


# P8 / V7 over whole documents ---------------------------------------------------------------


def _doc_terms():
    from labelcorpus.knowledge import values as V
    return list(V.PROHIBITED_TERMS) + [r"\blicense\b"]


def _prohibited_sql() -> str:
    hits = ", ".join(f"CASE WHEN regexp_matches(lower(text), {_sql_str(re2_bounds(p))}) THEN "
                     f"{_sql_str(p)} END" for p in _doc_terms())
    return (f"SELECT doc_id, concat_ws(' | ', {hits}) AS violations, "
            f"concat_ws(' | ', {hits}) = '' AS passed FROM documents")


@register("prohibited_terms", _prohibited_sql())
def q_prohibited_terms(spark, sf_dir):
    from labelcorpus.operators import validation as VR
    docs = T.table(spark, sf_dir, "documents").select("doc_id", "text")
    hits = VR.prohibited_hits(F.lower(F.col("text")), _doc_terms())
    return docs.select("doc_id", F.array_join(hits, " | ").alias("violations"),
                       (F.size(hits) == 0).alias("passed"))


# P5 -----------------------------------------------------------------------------------------
CONSTRAINT_SQL = (
    f"WITH {FR}, a AS (SELECT 'ingredient' AS source, food_id AS id, concat_ws('; ', "
    "CASE WHEN NOT (weight_g >= 0) THEN 'weight_g must be >= 0' END, "
    "CASE WHEN NOT (f BETWEEN 0 AND 1) THEN 'fraction must be in [0, 1]' END, "
    "CASE WHEN NOT (sequence_number >= 0) THEN 'sequence_number must be >= 0' END) AS errors "
    "FROM fr), b AS (SELECT 'mapping' AS source, event_id AS id, concat_ws('; ', "
    "CASE WHEN NOT coalesce(value / 100.0 BETWEEN 0 AND 1, false) THEN "
    "'confidence must be in [0, 1]' END) AS errors FROM events) "
    "SELECT source, id, errors FROM a WHERE errors <> '' UNION ALL "
    "SELECT source, id, errors FROM b WHERE errors <> ''")


@register("constraint_quarantine", CONSTRAINT_SQL)
def q_constraint_quarantine(spark, sf_dir):
    from labelcorpus.operators import constraints as C
    fr = R.with_fractions(T.ingredients(spark, sf_dir))
    _, bad_i = C.quarantine(C.with_errors(fr, C.ingredient_checks()))
    ev = T.table(spark, sf_dir, "events").withColumn("confidence", F.col("value") / 100.0)
    _, bad_e = C.quarantine(C.with_errors(ev, C.mapping_checks()))
    return (bad_i.select(F.lit("ingredient").alias("source"), F.col("food_id").alias("id"),
                         F.array_join("errors", "; ").alias("errors"))
            .unionByName(bad_e.select(F.lit("mapping").alias("source"),
                                      F.col("event_id").alias("id"),
                                      F.array_join("errors", "; ").alias("errors"))))


# ---------------------------------------------------------------------------------------------
# Nutrition: X4, X5, J10, A5-A7, J13-J15, L6, L7
def _nutrition_frames(spark, sf_dir):
    from labelcorpus.operators import nutrition as N
    from labelcorpus.operators import tags
    k = L.Knowledge.default(spark)
    ctx = k.nutrient_context()
    served = tags.serving_size(T.foods(spark, sf_dir), k.prefixes, k.food_keywords, k.racc)
    prof = ctx.add_serving_columns(
        served.join(N.nutrient_profile(T.nutrients(spark, sf_dir), ctx.names), "food_id", "left"))
    return k, ctx, served, prof


def _sql_round(v: str, nutrient: str) -> str:
    from labelcorpus.knowledge import values as V
    rows = {r[0]: r for r in V.ROUNDING}
    if nutrient not in rows:
        return v
    _, zero, fine, upto, coarse = rows[nutrient]

    def step(s):
        if s >= 1:
            return f"round_even(({v}) / {float(s)!r}, 0) * {float(s)!r}"
        inv = float(round(1 / s))
        return f"round_even(({v}) * {inv!r}, 0) / {inv!r}"
    parts = []
    if zero is not None:
        parts.append(f"WHEN ({v}) < {float(zero)!r} THEN 0.0")
    if upto is not None:
        parts.append(f"WHEN ({v}) <= {float(upto)!r} THEN {step(fine)}")
        parts.append(f"ELSE {step(coarse)}")
    else:
        if not parts:
            return step(fine)
        parts.append(f"ELSE {step(fine)}")
    return "CASE " + " ".join(parts) + " END"


def _prof_sql() -> str:
    from labelcorpus.operators.nutrition import nutrient_names
    cols = []
    for i, n in enumerate(nutrient_names()):
        f = f"FILTER (WHERE name = {_sql_str(n)})"
        cols += [f"arg_max(amount, pos) {f} AS n{i}_last", f"arg_min(amount, pos) {f} AS n{i}_first",
                 f"min(pos) {f} AS n{i}_pos"]
    serv = _serving_sql(rounded=False)
    return (f"nut AS {T.sql_nutrients()}, serv AS ({serv}), "
            f"np AS (SELECT food_id, count(*) AS n_nutrients, {', '.join(cols)} FROM nut "
            "GROUP BY food_id), prof AS (SELECT s.food_id, s.serving_g, f.food_name, np.* EXCLUDE "
            f"(food_id) FROM serv s LEFT JOIN np USING (food_id) JOIN ({T.sql_foods()}) f USING (food_id))")


def _ncol(name: str, kind: str) -> str:
    from labelcorpus.operators.nutrition import nutrient_names
    return f"n{nutrient_names().index(name)}_{kind}"


def _ps_sql(name: str, kind: str = "last") -> str:
    return f"({_ncol(name, kind)} * serving_g / 100.0)"


def _dv_amounts() -> dict:
    from labelcorpus.knowledge import values as V
    amounts = dict(V.DAILY_VALUES)
    out = {}
    for n, key in V.NUTRIENT_DV_KEYS:
        if key in amounts:
            out[n] = float(amounts[key])
    for key, a in V.DAILY_VALUES:
        out.setdefault(key, float(a))
    return out


# X5 -----------------------------------------------------------------------------------------
def _fda_round_sql() -> str:
    from labelcorpus.knowledge import values as V
    case = "CASE name " + " ".join(
        f"WHEN {_sql_str(r[0])} THEN {_sql_round('ps', r[0])}" for r in V.ROUNDING) + " ELSE ps END"
    serv = _serving_sql(rounded=False)
    return (f"WITH nut AS {T.sql_nutrients()}, serv AS ({serv}), x AS (SELECT n.food_id, n.pos, "
            "n.name, n.amount * s.serving_g / 100.0 AS ps FROM nut n JOIN serv s USING (food_id)) "
            f"SELECT food_id, pos, name, {sq('ps')} AS per_serving, {sq(case)} AS rounded "
            "FROM x")


@register("fda_round", _fda_round_sql())
def q_fda_round(spark, sf_dir):
    from labelcorpus.operators import nutrition as N
    k, ctx, served, _ = _nutrition_frames(spark, sf_dir)
    rows = N.per_serving_rows(T.nutrients(spark, sf_dir), served)
    return N.round_rows(rows, k.rounding).select(
        "food_id", "pos", "name", q("per_serving").alias("per_serving"),
        q("rounded").alias("rounded"))


# J10 ----------------------------------------------------------------------------------------
def _daily_value_sql() -> str:
    dv = _dv_amounts()
    case = "CASE name " + " ".join(f"WHEN {_sql_str(n)} THEN {a!r}" for n, a in dv.items()) + " END"
    serv = _serving_sql(rounded=False)
    return (f"WITH nut AS {T.sql_nutrients()}, serv AS ({serv}) SELECT n.food_id, n.pos, n.name, "
            f"{sq(f'n.amount * s.serving_g / 100.0 / ({case}) * 100.0')} AS dv_percent "
            "FROM nut n JOIN serv s USING (food_id)")


@register("daily_value", _daily_value_sql())
def q_daily_value(spark, sf_dir):
    from labelcorpus.operators import nutrition as N
    k, ctx, served, _ = _nutrition_frames(spark, sf_dir)
    rows = N.per_serving_rows(T.nutrients(spark, sf_dir), served)
    return N.daily_value_rows(rows, k.daily_values).select(
        "food_id", "pos", "name", q("dv_percent").alias("dv_percent"))


# L7 / A6 / A7 -------------------------------------------------------------------------------
def _panel_sql() -> str:
    from labelcorpus.knowledge import values as V
    dv = _dv_amounts()
    cols = ["food_id",
            "replace(format('{:.0f}', serving_g), ',', '') || 'g' AS serving_size",
            f"coalesce(round_even({_sql_round(_ps_sql('Energy', 'first'), 'Energy')}, 0), 0.0) "
            "AS calories"]
    for col, n in V.PANEL_COLUMNS[1:]:
        cols.append(f"{sq(_sql_round(_ps_sql(n, 'first'), n))} AS {col}")
    entries = []
    for n in V.PANEL_DV_NUTRIENTS:
        if n in dv:
            val = f"round_even({_sql_round(_ps_sql(n, 'first'), n)} / {dv[n]!r} * 100.0, 0)"
            entries.append(f"CASE WHEN {_ncol(n, 'pos')} IS NOT NULL THEN {_sql_str(n)} || '=' || "
                           f"CAST(CAST({val} AS BIGINT) AS VARCHAR) END")
    cols.append(f"concat_ws(';', {', '.join(entries)}) AS daily_values")
    return f"WITH {_prof_sql()} SELECT {', '.join(cols)} FROM prof"


@register("panel", _panel_sql())
def q_panel(spark, sf_dir):
    from labelcorpus.knowledge import values as V
    from labelcorpus.operators import nutrition as N
    k, ctx, served, prof = _nutrition_frames(spark, sf_dir)
    panel = N.nutrition_panel(prof, ctx)
    dv = F.array_join(F.transform(
        F.filter(F.array(*[F.struct(F.lit(n).alias("k"),
                                    F.try_element_at("daily_values", F.lit(n)).alias("v"))
                           for n in V.PANEL_DV_NUTRIENTS]), lambda e: e["v"].isNotNull()),
        lambda e: F.concat(e["k"], F.lit("="), e["v"].cast("long").cast("string"))), ";")
    return panel.select("food_id", "serving_size", "calories",
                        *[q(c).alias(c) for c, _ in V.PANEL_COLUMNS[1:]],
                        dv.alias("daily_values"))


# J13-J15 ------------------------------------------------------------------------------------
def _claim_sql_parts() -> dict[str, str]:
    from labelcorpus.knowledge import values as V
    dv = _dv_amounts()
    liquid = "(" + " OR ".join(f"instr(lower(food_name), {_sql_str(w)}) > 0"
                               for w in V.LIQUID_WORDS) + ")"
    texts = dict(V.CLAIM_TEXTS)
    groups = dict(V.CLAIM_GROUPS)
    content = []
    for group, claim, ps_th, p100_th, solid_th, liq_th in V.CONTENT_CLAIMS:
        n = groups[group]
        present = f"{_ncol(n, 'pos')} IS NOT NULL"
        p100 = _ncol(n, "last")
        t = _sql_str(texts.get(claim, claim))
        for th, cond in ((ps_th, f"{_ps_sql(n)} < {float(ps_th or 0)!r}"),
                         (p100_th, f"{p100} < {float(p100_th or 0)!r}"),
                         (solid_th, f"NOT {liquid} AND {p100} < {float(solid_th or 0)!r}"),
                         (liq_th, f"{liquid} AND {p100} < {float(liq_th or 0)!r}")):
            if th is not None:
                content.append(f"CASE WHEN {present} AND {cond} THEN {t} END")
    source = []
    for n, disp in V.SOURCE_NUTRIENTS:
        d = f"({_ps_sql(n)} / {dv[n]!r} * 100.0)"
        source.append(f"CASE WHEN {_ncol(n, 'pos')} IS NOT NULL THEN {{'p': {_ncol(n, 'pos')}, "
                      f"'t': CASE WHEN {d} >= 20 THEN {_sql_str('EXCELLENT SOURCE OF ' + disp)} "
                      f"WHEN {d} >= 10 THEN {_sql_str('GOOD SOURCE OF ' + disp)} END}} END")
    health = []
    for n, cmp, th, text in V.HEALTH_CLAIMS:
        op = "<" if cmp == "below" else ">"
        health.append(f"CASE WHEN {_ncol(n, 'pos')} IS NOT NULL AND {_ps_sql(n)} {op} "
                      f"{float(th)!r} THEN {_sql_str(text)} END")
    content_l = f"list_filter([{', '.join(content)}], lambda x: x IS NOT NULL)"
    source_l = (f"list_transform(list_sort(list_filter([{', '.join(source)}], lambda s: s IS NOT NULL "
                "AND s.t IS NOT NULL)), lambda s: s.t)")
    health_l = f"list_filter([{', '.join(health)}], lambda x: x IS NOT NULL)"
    return {"content": content_l, "source": source_l, "health": health_l}


def _claims_sql(kind: str) -> str:
    return (f"WITH {_prof_sql()} SELECT food_id, array_to_string({_claim_sql_parts()[kind]}, ' | ') "
            f"AS claims FROM prof")


def _claims_query(kind: str):
    def q(spark, sf_dir):
        from labelcorpus.operators import nutrition as N
        k, ctx, served, prof = _nutrition_frames(spark, sf_dir)
        parts = N.claim_arrays(ctx, k.content_claims, k.source_nutrients, k.health_claims)
        return prof.select("food_id", F.array_join(parts[kind], " | ").alias("claims"))
    return q


for _kind in ("content", "source", "health"):
    register(f"{_kind}_claims", _claims_sql(_kind))(_claims_query(_kind))


# ---------------------------------------------------------------------------------------------
# Flagship: the full label (all seven operators) for every selected recipe
def _full(spark, sf_dir, operators=None, how: str = "none"):
    """Labels for every selected recipe. ``how`` cuts the plan at its fan-out points
    ('table' -- Parquet in the checkpoint folder -- for queries that feed several rules from
    one label plan, 'none' for a single output, where Spark's exchange reuse is cheaper than
    materialising)."""
    from labelcorpus.session import materialize
    k = L.Knowledge.default(spark)
    # The selected rows feed the ids, the declared rows and one rule.
    fr = materialize(_selected(spark, sf_dir), how)
    ids = fr.select("food_id").distinct()
    foods = T.foods(spark, sf_dir).join(ids, "food_id", "left_semi")
    nutrients = T.nutrients(spark, sf_dir)
    built = L.build_labels(foods, fr, nutrients, k, operators, materialize=how)
    built["selected"] = fr
    return k, foods, nutrients, built


def _full_label_sql() -> str:
    parts = _claim_sql_parts()
    claims = f"list_concat({parts['content']}, {parts['source']}, {parts['health']})"
    return (
        f"WITH {FR}, {SEL}, g AS (SELECT food_id, "
        "string_agg(upper(description), ', ' ORDER BY label_pos) FILTER (WHERE f > 0.02) AS m, "
        "string_agg(upper(description), ', ' ORDER BY label_pos) FILTER (WHERE f <= 0.02) AS t "
        "FROM lab GROUP BY food_id), ids AS (SELECT DISTINCT food_id FROM sel), "
        "base AS (SELECT ids.food_id, 'INGREDIENTS: ' || concat_ws(', ', m, "
        "'CONTAINS 2% OR LESS OF: ' || t) || '.' AS txt FROM ids LEFT JOIN g USING (food_id)), "
        f"{_prof_sql()}, cl AS (SELECT food_id, {claims} AS c0 FROM prof), "
        "cd AS (SELECT food_id, list_filter(c0, lambda x, i: list_position(c0, x) = i) AS c "
        "FROM cl) SELECT base.food_id, CASE WHEN len(coalesce(c, [])) > 0 THEN "
        "array_to_string(c, chr(10)) || chr(10) || txt ELSE txt END AS ingredient_text, "
        "CAST(len(coalesce(c, [])) AS INTEGER) AS n_claims FROM base LEFT JOIN cd USING (food_id)")


@register("full_label", _full_label_sql())
def q_full_label(spark, sf_dir):
    _, _, _, built = _full(spark, sf_dir)
    return built["label"].select("food_id", "ingredient_text",
                                 F.size("claims").alias("n_claims"))


# L8 / A8 ------------------------------------------------------------------------------------
DIFFICULTY_SQL = (
    f"WITH {FR}, {SEL}, ids AS (SELECT DISTINCT food_id FROM sel), "
    "lt AS (SELECT DISTINCT food_id FROM lab WHERE f <= 0.02), "
    "nn AS (SELECT DISTINCT l_orderkey AS food_id FROM lineitem) "
    "SELECT ids.food_id, CASE WHEN lt.food_id IS NOT NULL OR nn.food_id IS NOT NULL THEN 2 "
    "ELSE 1 END AS difficulty, CAST(7 AS BIGINT) AS total_applied_operators FROM ids "
    "LEFT JOIN lt USING (food_id) LEFT JOIN nn USING (food_id)")


@register("difficulty", DIFFICULTY_SQL)
def q_difficulty(spark, sf_dir):
    from labelcorpus.operators import truth
    _, foods, nutrients, built = _full(spark, sf_dir)
    recs = L.label_records(foods, nutrients, built)
    return truth.difficulty(recs).select("food_id", "difficulty", "total_applied_operators")


# K1 / W3 / W6 -------------------------------------------------------------------------------
SAMPLE_N, SEED = 200, 42
SAMPLE_SQL = (
    f"WITH {FR}, ids AS (SELECT DISTINCT food_id FROM fr WHERE n BETWEEN 2 AND 50), "
    f"r AS (SELECT food_id, row_number() OVER (ORDER BY md5('{SEED}:' || CAST(food_id AS VARCHAR)), "
    f"food_id) AS rk FROM ids), s AS (SELECT food_id FROM r WHERE rk <= {SAMPLE_N}) "
    "SELECT food_id, 'sample_' || lpad(CAST(row_number() OVER (ORDER BY food_id) AS VARCHAR), 6, "
    f"'0') AS sample_id, CAST({SEED} - 1 + row_number() OVER (ORDER BY food_id) AS BIGINT) "
    "AS sample_seed FROM s")


@register("seeded_sample", SAMPLE_SQL)
def q_seeded_sample(spark, sf_dir):
    from labelcorpus.operators import split as S
    ids = R.recipe_ids(T.ingredients(spark, sf_dir), 2, 50).select("food_id")
    picked = S.seeded_sample(ids, SAMPLE_N, SEED)
    return S.sample_ids(picked, SEED).select("food_id", "sample_id",
                                             F.col("sample_seed").cast("long").alias("sample_seed"))


GROUP_SPLIT_SQL = (
    f"WITH {FR}, ids AS (SELECT DISTINCT food_id FROM fr WHERE n BETWEEN 2 AND 50), "
    f"s AS (SELECT ids.food_id, f.group_key FROM ids JOIN ({T.sql_foods()}) f USING (food_id)), "
    "gr AS (SELECT DISTINCT group_key FROM s), cnt AS (SELECT count(*) AS n FROM gr), "
    "k AS (SELECT CAST(round_even(n * 0.7, 0) AS BIGINT) AS n_train, "
    "CAST(round_even(n * 0.15, 0) AS BIGINT) AS n_val FROM cnt), "
    f"r AS (SELECT group_key, row_number() OVER (ORDER BY md5('{SEED}:' || "
    "CAST(group_key AS VARCHAR)), group_key) AS group_rank FROM gr) "
    "SELECT s.food_id, s.group_key, CASE WHEN group_rank <= n_train THEN 'train' "
    "WHEN group_rank <= n_train + n_val THEN 'val' ELSE 'test' END AS split "
    "FROM s JOIN r USING (group_key) CROSS JOIN k")


@register("group_split", GROUP_SPLIT_SQL)
def q_group_split(spark, sf_dir):
    from labelcorpus.operators import split as S
    ids = R.recipe_ids(T.ingredients(spark, sf_dir), 2, 50).select("food_id")
    samples = ids.join(T.foods(spark, sf_dir).select("food_id", "group_key"), "food_id")
    return S.group_split(samples, "group_key", 0.7, 0.15, 0.15, SEED).select(
        "food_id", "group_key", "split")


# ---------------------------------------------------------------------------------------------
# Validation: V2 on labels declared in line order (a natural source of order violations)
ORDER_SQL = (
    f"WITH {FR}, {SEL}, lo AS (SELECT food_id, f, CASE WHEN f <= 0.02 THEN 'lt' ELSE 'main' END "
    "AS grp, row_number() OVER (PARTITION BY food_id ORDER BY sequence_number, pos, pos2) AS lp "
    "FROM sel WHERE NOT is_fortificant), pm AS (SELECT *, min(f) OVER (PARTITION BY food_id, grp "
    "ORDER BY lp ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_min FROM lo) "
    "SELECT food_id, count(*) FILTER (WHERE grp = 'main' AND f > prev_min + 1e-9) = 0 AS passed, "
    "CAST(count(*) FILTER (WHERE grp = 'main' AND f > prev_min + 1e-9) AS BIGINT) AS n_violations "
    "FROM (SELECT DISTINCT food_id FROM sel) LEFT JOIN pm USING (food_id) GROUP BY food_id")


@register("validation_order", ORDER_SQL)
def q_validation_order(spark, sf_dir):
    from labelcorpus.operators import validation as VR
    line_order = [F.col("sequence_number"), F.col("pos"), F.col("pos2")]
    d = R.less_than_2_pct(R.initial_declared(_selected(spark, sf_dir), line_order), 0.02)
    ids = _selected(spark, sf_dir).select("food_id").distinct()
    v = ids.join(VR.order_violations(d), "food_id", "left").fillna(0, ["n_bad"])
    return v.select("food_id", (F.col("n_bad") == 0).alias("passed"),
                    F.col("n_bad").cast("long").alias("n_violations"))


REPORT_SQL = (
    f"WITH {_prof_sql()}, {FR}, ids AS (SELECT DISTINCT food_id FROM fr WHERE n BETWEEN 2 AND 50) "
    "SELECT ids.food_id, prof.n{sod}_pos IS NOT NULL AS all_passed, "
    "CAST(CASE WHEN prof.n{sod}_pos IS NOT NULL THEN 7 ELSE 6 END AS BIGINT) AS n_passed, "
    "CAST(CASE WHEN prof.n{sod}_pos IS NOT NULL THEN 0 ELSE 1 END AS BIGINT) AS n_failed "
    "FROM ids JOIN prof USING (food_id)")


def _report_sql():
    from labelcorpus.operators.nutrition import nutrient_names
    return REPORT_SQL.replace("{sod}", str(nutrient_names().index("Sodium, Na")))


@register("validation_report", _report_sql())
def q_validation_report(spark, sf_dir):
    from labelcorpus.plans.validate import validate
    k, foods, nutrients, built = _full(spark, sf_dir, how="table")
    _, report = validate(built, built["selected"], k)
    return report.select("food_id", "all_passed", "n_passed", "n_failed")


# ---------------------------------------------------------------------------------------------
# Evaluation: X15, A15, A16, E1, E3 on the rendered full labels
def _parse_sql(t: str) -> str:
    x = f"regexp_replace({t}, '(?i)^INGREDIENTS:\\s*', '')"
    x = f"regexp_replace({x}, '\\.\\s+', ', ', 'g')"
    x = f"regexp_replace({x}, '(?i)CONTAINS 2%\\s*OR\\s*LESS\\s*OF:\\s*', '', 'g')"
    x = f"regexp_replace({x}, '(?i)CONTAINS:?\\s*.*?$', '', 'g')"
    x = f"regexp_replace(regexp_replace({x}, '^\\s+|\\s+$', '', 'g'), '\\.+$', '')"
    clean = ("lambda s: CASE WHEN instr(regexp_replace(regexp_replace(s, '^\\s+|\\s+$', '', 'g'), "
             "'\\.+$', ''), '(') > 1 THEN regexp_replace(left(regexp_replace(regexp_replace(s, "
             "'^\\s+|\\s+$', '', 'g'), '\\.+$', ''), instr(regexp_replace(regexp_replace(s, "
             "'^\\s+|\\s+$', '', 'g'), '\\.+$', ''), '(') - 1), '^\\s+|\\s+$', '', 'g') ELSE "
             "regexp_replace(regexp_replace(s, '^\\s+|\\s+$', '', 'g'), '\\.+$', '') END")
    return (f"CASE WHEN coalesce({t}, '') = '' OR {x} = '' THEN []::VARCHAR[] ELSE "
            f"list_filter(list_transform(string_split({x}, ','), {clean}), lambda s: s <> '') END")


def _full_cte() -> str:
    sql = _full_label_sql()
    return sql.replace("WITH ", "", 1).replace(
        "SELECT base.food_id, CASE WHEN", ", full_lab AS (SELECT base.food_id, CASE WHEN", 1) + ")"


@register("parse_ingredients", f"WITH {_full_cte()} SELECT food_id, array_to_string("
          f"{_parse_sql('ingredient_text')}, ' | ') AS parsed FROM full_lab")
def q_parse_ingredients(spark, sf_dir):
    from labelcorpus.operators import evaluate as E
    _, _, _, built = _full(spark, sf_dir)
    parsed = E.parse_column(built["label"].select("food_id", "ingredient_text"), "ingredient_text",
                            "p")
    return parsed.select("food_id", F.array_join("p", " | ").alias("parsed"))


def _parsing_metrics_sql() -> str:
    norm = "lambda s: lower(trim(regexp_replace(s, '\\s+', ' ', 'g')))"
    gt_l = f"list_filter(list_transform(truth, {norm}), lambda s: s <> '')"
    pr_l = f"list_filter(list_transform(pred, {norm}), lambda s: s <> '')"
    return (
        f"WITH {_full_cte()}, tr AS (SELECT food_id, list(upper(description) ORDER BY "
        "CASE WHEN f <= 0.02 THEN 1 ELSE 0 END, label_pos) AS truth FROM lab GROUP BY food_id), "
        f"x AS (SELECT full_lab.food_id, coalesce(truth, []::VARCHAR[]) AS truth, "
        f"{_parse_sql('ingredient_text')} AS pred FROM full_lab LEFT JOIN tr USING (food_id)), "
        f"y AS (SELECT food_id, {gt_l} AS gl, {pr_l} AS pl FROM x), "
        "z AS (SELECT food_id, gl, pl, list_distinct(gl) AS gs, list_distinct(pl) AS ps FROM y), "
        "w AS (SELECT *, len(gs) AS ng, len(ps) AS np, len(list_intersect(gs, ps)) AS nc, "
        "len(list_distinct(list_concat(gs, ps))) AS nu, least(len(gl), len(pl)) AS nmin, "
        "greatest(len(gl), len(pl)) AS nmax FROM z), "
        "v AS (SELECT *, CASE WHEN np > 0 THEN nc / np ELSE 0.0 END AS p, CASE WHEN ng > 0 THEN "
        "nc / ng ELSE 0.0 END AS r, len(list_filter(range(1, nmin + 1), lambda i: gl[i] = pl[i])) "
        "AS pm FROM w) "
        "SELECT food_id, CASE WHEN ng = 0 AND np = 0 THEN 1.0 ELSE round_even(p, 4) END AS precision, "
        "CASE WHEN ng = 0 AND np = 0 THEN 1.0 ELSE round_even(r, 4) END AS recall, "
        "CASE WHEN ng = 0 AND np = 0 THEN 1.0 ELSE round_even(CASE WHEN p + r > 0 THEN 2.0 * p * r "
        "/ (p + r) ELSE 0.0 END, 4) END AS f1, CAST(CASE WHEN ng = 0 AND np = 0 THEN 1.0 WHEN nc = ng "
        "AND nc = np THEN 1.0 ELSE 0.0 END AS DOUBLE) AS exact_match, CASE WHEN ng = 0 AND np = 0 THEN 1.0 "
        "ELSE round_even(CASE WHEN nu > 0 THEN nc / nu ELSE 1.0 END, 4) END AS iou, CASE WHEN "
        "nmax > 0 THEN round_even(pm / nmax, 4) ELSE 1.0 END AS order_accuracy FROM v")


PARSING_COLS = ["precision", "recall", "f1", "exact_match", "iou", "order_accuracy"]


def _parsing_per_sample(spark, sf_dir, how: str = "none"):
    from labelcorpus.operators import evaluate as E
    _, foods, nutrients, built = _full(spark, sf_dir, how=how)
    truth = built["declared"].groupBy("food_id").agg(F.transform(F.array_sort(F.collect_list(
        F.struct(F.when(F.col("declaration_group") == "main", 0).otherwise(1).alias("g"),
                 "label_pos", "declared_name"))), lambda s: s["declared_name"]).alias("truth_names"))
    samples = built["label"].select("food_id", "ingredient_text").join(truth, "food_id", "left") \
        .withColumn("truth_names", F.coalesce("truth_names", F.array().cast("array<string>")))
    return E.evaluate_parsing(samples), foods, nutrients, built


@register("parsing_metrics", _parsing_metrics_sql())
def q_parsing_metrics(spark, sf_dir):
    m, _, _, _ = _parsing_per_sample(spark, sf_dir)
    return m.select("food_id", *PARSING_COLS)


# A10 / A11 / A12 ------------------------------------------------------------------------------
def _by_group_sql() -> str:
    cols = ", ".join(f"round_even(avg({c}), 4) AS {c}" for c in PARSING_COLS)
    return (f"WITH pm AS ({_parsing_metrics_sql()}), d AS ({DIFFICULTY_SQL}) SELECT "
            "CASE difficulty WHEN 1 THEN 'EASY' WHEN 2 THEN 'MEDIUM' ELSE 'HARD' END AS difficulty, "
            f"{cols}, count(*) AS n_samples FROM pm JOIN d USING (food_id) GROUP BY 1")


@register("metrics_by_group", _by_group_sql())
def q_metrics_by_group(spark, sf_dir):
    from labelcorpus.operators import evaluate as E
    from labelcorpus.operators import truth
    from labelcorpus.session import materialize
    m, foods, nutrients, built = _parsing_per_sample(spark, sf_dir, how="table")
    m = materialize(m.select("food_id", *PARSING_COLS), wide=True)
    diff = truth.difficulty(L.label_records(foods, nutrients, built))
    names = F.create_map(F.lit(1), F.lit("EASY"), F.lit(2), F.lit("MEDIUM"), F.lit(3), F.lit("HARD"))
    j = m.join(diff, "food_id").withColumn("difficulty", F.try_element_at(names, F.col("difficulty")))
    return E.average_metrics(j, PARSING_COLS, ["difficulty"])


# J18 / J19 / A14 / W4 / E2 / E4 -------------------------------------------------------------
def _mapping_frames(spark, sf_dir, selected=None):
    """``selected``: the selected rows, where they were cut before."""
    from labelcorpus.operators import evaluate as E
    from labelcorpus.operators import naming
    from labelcorpus.operators import truth
    schema = "description string, name string, pos int"
    lex = _dim(spark, [(d, n, i) for i, (d, n) in enumerate(PART_LEXICON)], schema)
    com = _dim(spark, [(d, n, i) for i, (d, n) in enumerate(PART_COMMERCIAL)], schema)
    declared = naming.rename(R.initial_declared(_selected(spark, sf_dir) if selected is None else selected), lex, com)
    part = T.table(spark, sf_dir, "part")
    pairs = part.select(F.col("p_partkey").alias("pos"), F.col("p_name").alias("standard"),
                        F.concat_ws(" ", "p_name", F.lower("p_type")).alias("commercial"))
    dictionary = E.build_dictionary(pairs)
    keys = truth.truth_keys(declared).select(
        F.col("food_id").alias("sample_id"), "key", F.col("declared_name").alias("name"),
        F.col("original_description").alias("target"))
    preds = E.dictionary_mapper(keys.select("name"), dictionary)
    return keys, preds


DICT_SQL_BASE = (
    "pr AS (SELECT p_partkey AS pos, p_name AS standard, p_name || ' ' || lower(p_type) AS commercial "
    "FROM part), wr AS (SELECT pos * 2 AS w, lower(commercial) AS key, standard AS value FROM pr "
    "UNION ALL SELECT pos * 2 + 1, lower(standard), standard FROM pr), "
    "dict AS (SELECT key, min(w) AS pos, arg_max(value, w) AS value FROM wr GROUP BY key)")


def _mapping_names_sql() -> str:
    x1 = ("upper(regexp_replace(regexp_replace(trim(regexp_replace(description, '\\s+', ' ', 'g')), "
          "'\\s*,\\s*', ' ', 'g'), '\\s+', ' ', 'g'))")
    lx = _values_sql(PART_LEXICON, ['d', 'n'])[:-len(' AS v(d, n)')]
    cm = _values_sql(PART_COMMERCIAL, ['d', 'n'])[:-len(' AS v(d, n)')]
    return (f"names AS (SELECT lab.food_id, label_pos, description, coalesce(lx.n, cm.n, {x1}) AS nm "
            f"FROM lab LEFT JOIN {lx} AS lx(d, n) ON lx.d = description LEFT JOIN {cm} AS cm(d, n) "
            "ON cm.d = description), "
            "dn AS (SELECT DISTINCT nm FROM names), "
            "ex AS (SELECT nm, 1 AS rank, value AS candidate FROM dn JOIN dict ON dict.key = lower(nm)), "
            "dt AS (SELECT DISTINCT dict.pos, dict.value, unnest(string_split(key, ' ')) AS tok FROM dict), "
            "qt AS (SELECT DISTINCT nm, unnest(string_split(lower(nm), ' ')) AS tok FROM dn "
            "WHERE lower(nm) NOT IN (SELECT key FROM dict)), "
            "cand AS (SELECT DISTINCT nm, dt.pos, dt.value FROM qt JOIN dt USING (tok)), "
            "rk AS (SELECT nm, row_number() OVER (PARTITION BY nm ORDER BY pos) AS rank, "
            "value AS candidate FROM cand), "
            "preds AS (SELECT * FROM ex UNION ALL SELECT * FROM rk WHERE rank <= 5)")


@register("dictionary_mapper", f"WITH {FR}, {SEL}, {DICT_SQL_BASE}, {_mapping_names_sql()} "
          "SELECT nm AS name, CAST(rank AS INTEGER) AS rank, candidate FROM preds")
def q_dictionary_mapper(spark, sf_dir):
    _, preds = _mapping_frames(spark, sf_dir)
    return preds.select("name", F.col("rank").cast("int").alias("rank"), "candidate")


def _mapping_metrics_sql() -> str:
    norm = "lower(trim(regexp_replace({x}, '\\s+', ' ', 'g')))"
    return (
        f"WITH {FR}, {SEL}, {DICT_SQL_BASE}, {_mapping_names_sql()}, "
        f"pl AS (SELECT nm, list({norm.format(x='candidate')} ORDER BY rank) AS c FROM preds GROUP BY nm), "
        f"t AS (SELECT food_id, {norm.format(x='description')} AS tgt, coalesce(c, []::VARCHAR[]) AS c "
        "FROM names LEFT JOIN pl USING (nm)), "
        "u AS (SELECT food_id, CASE WHEN c[1] = tgt THEN 1.0 ELSE 0.0 END AS ex, "
        "CASE WHEN list_position(c[1:5], tgt) > 0 THEN 1.0 ELSE 0.0 END AS hit, "
        "CASE WHEN list_position(c, tgt) > 0 THEN 1.0 / list_position(c, tgt) ELSE 0.0 END AS rr "
        "FROM t), ids AS (SELECT DISTINCT food_id FROM sel) "
        "SELECT food_id AS sample_id, coalesce(round_even(avg(hit), 4), 0.0) AS recall_at_5, "
        "coalesce(round_even(avg(rr), 4), 0.0) AS mrr, "
        "coalesce(round_even(avg(ex), 4), 0.0) AS exact_match_rate, "
        "count(ex) AS n_ingredients FROM ids LEFT JOIN u USING (food_id) GROUP BY food_id")


@register("mapping_metrics", _mapping_metrics_sql())
def q_mapping_metrics(spark, sf_dir):
    from labelcorpus.operators import evaluate as E
    keys, preds = _mapping_frames(spark, sf_dir)
    ids = _selected(spark, sf_dir).select(F.col("food_id").alias("sample_id")).distinct()
    return E.evaluate_mapping(ids, keys, preds, 5, "sample_id")


# S10 / S11 ----------------------------------------------------------------------------------
@register("manifest", f"WITH r AS ({_report_sql()}) SELECT count(*) AS total_samples, "
          "count(*) FILTER (WHERE all_passed) AS successful, count(*) FILTER (WHERE NOT all_passed) "
          "AS failed, CASE WHEN count(*) > 0 THEN round_even(100.0 * count(*) FILTER (WHERE all_passed) "
          "/ count(*), 1) ELSE 0 END AS success_rate_pct FROM r")
def q_manifest(spark, sf_dir):
    from labelcorpus.plans import sinks
    from labelcorpus.plans.validate import validate
    k, foods, nutrients, built = _full(spark, sf_dir, how="table")
    _, report = validate(built, built["selected"], k)
    return sinks.manifest_summary(report.withColumn("success", F.col("all_passed")))


# J20 ----------------------------------------------------------------------------------------
@register("overlap_mapper", f"WITH {FR}, {SEL}, {DICT_SQL_BASE}, {_mapping_names_sql()}, "
          "qt2 AS (SELECT nm, len(list_distinct(string_split(lower(nm), ' '))) AS nq, "
          "unnest(list_distinct(string_split(lower(nm), ' '))) AS tok FROM dn), "
          "dt2 AS (SELECT pos, value, len(list_distinct(string_split(key, ' '))) AS nd, "
          "unnest(list_distinct(string_split(key, ' '))) AS tok FROM dict), "
          "pairs AS (SELECT nm, nq, pos, value, nd, count(*) AS ov FROM qt2 JOIN dt2 USING (tok) "
          "GROUP BY nm, nq, pos, value, nd), "
          "sc AS (SELECT nm, value, pos, ov / (nq + nd - ov) AS score FROM pairs), "
          "rk2 AS (SELECT nm, value, row_number() OVER (PARTITION BY nm ORDER BY score DESC, pos) "
          "AS rank FROM sc) SELECT nm AS name, CAST(rank AS INTEGER) AS rank, value AS candidate "
          "FROM rk2 WHERE rank <= 5")
def q_overlap_mapper(spark, sf_dir):
    from labelcorpus.operators import evaluate as E
    keys, _ = _mapping_frames(spark, sf_dir)
    part = T.table(spark, sf_dir, "part")
    pairs = part.select(F.col("p_partkey").alias("pos"), F.col("p_name").alias("standard"),
                        F.concat_ws(" ", "p_name", F.lower("p_type")).alias("commercial"))
    preds = E.overlap_mapper(keys.select("name"), E.build_dictionary(pairs))
    return preds.select("name", F.col("rank").cast("int").alias("rank"), "candidate")


# V1-V7 per rule -----------------------------------------------------------------------------
def _rules_sql() -> str:
    from labelcorpus.operators.nutrition import nutrient_names
    from labelcorpus.operators.validation import RULES
    sod = nutrient_names().index("Sodium, Na")
    rules = ", ".join(f"('{r}')" for r in RULES)
    return (f"WITH {_prof_sql()}, {FR}, ids AS (SELECT DISTINCT food_id FROM fr WHERE n BETWEEN 2 "
            f"AND 50), r(rule) AS (VALUES {rules}) SELECT ids.food_id, r.rule, CASE WHEN r.rule = "
            f"'fda_syntax' THEN prof.n{sod}_pos IS NOT NULL ELSE true END AS passed, "
            f"CASE WHEN r.rule = 'fda_syntax' AND prof.n{sod}_pos IS NULL THEN 'Sodium not set' "
            "ELSE '' END AS issues FROM ids JOIN prof USING (food_id) CROSS JOIN r")


@register("validation_rules", _rules_sql())
def q_validation_rules(spark, sf_dir):
    from labelcorpus.plans.validate import validate
    k, foods, nutrients, built = _full(spark, sf_dir, how="table")
    results, _ = validate(built, built["selected"], k, how="table")
    return results.select("food_id", "rule", "passed", F.array_join("issues", "; ").alias("issues"))


# J17 / A4 -----------------------------------------------------------------------------------
@register("truth_mappings", f"WITH {FR}, {SEL} SELECT food_id, CASE WHEN f <= 0.02 THEN 1 ELSE 0 "
          "END AS group_pos, label_pos, upper(description) AS source_text, description AS target_id "
          "FROM lab")
def q_truth_mappings(spark, sf_dir):
    from labelcorpus.operators import truth
    _, _, _, built = _full(spark, sf_dir)
    t = truth.target_mappings(built["declared"])
    return t.select("food_id", "group_pos", "label_pos", "source_text", "target_id")


@register("ingredient_maps", f"WITH {FR}, {SEL}, c AS (SELECT food_id, CAST(code AS VARCHAR) AS code, "
          "arg_max(weight_g, pos2) AS w FROM sel WHERE NOT is_fortificant GROUP BY food_id, code) "
          "SELECT food_id, coalesce(string_agg(code || '=' || CAST(w AS VARCHAR), ';' ORDER BY "
          "code || '=' || CAST(w AS VARCHAR)), '') AS ingredient_amounts "
          "FROM (SELECT DISTINCT food_id FROM sel) LEFT JOIN c USING (food_id) GROUP BY food_id")
def q_ingredient_maps(spark, sf_dir):
    from labelcorpus.operators import truth
    _, _, _, built = _full(spark, sf_dir)
    m = truth.ingredient_maps(built["selected"])
    entries = F.transform(F.map_entries("ingredient_amounts"),
                          lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return m.select("food_id", F.array_join(F.array_sort(entries), ";").alias("ingredient_amounts"))


# E5 / S8 / W3 -------------------------------------------------------------------------------
SAMPLE_INDEX_SQL = (
    f"WITH d AS ({DIFFICULTY_SQL}), {FR}, nn AS (SELECT DISTINCT food_id, n FROM fr "
    "WHERE n BETWEEN 2 AND 50), f AS (SELECT o_orderkey AS food_id, o_orderpriority AS food_name "
    "FROM orders) SELECT 'sample_' || lpad(CAST(row_number() OVER (ORDER BY nn.food_id) AS VARCHAR), "
    "6, '0') AS sample_id, nn.food_id AS fdc_id, f.food_name, nn.n AS n_ingredients, "
    "d.difficulty, true AS success FROM nn JOIN d USING (food_id) JOIN f USING (food_id)")


@register("sample_index", SAMPLE_INDEX_SQL)
def q_sample_index(spark, sf_dir):
    from labelcorpus.plans.generate import GenerateConfig, generate
    out = generate(spark, T.foods(spark, sf_dir), T.ingredients(spark, sf_dir),
                   T.nutrients(spark, sf_dir), GenerateConfig(), group_col="group_key")
    return out["sample_index"].select("sample_id", "fdc_id", "food_name", "n_ingredients",
                                      "difficulty", "success")


# E5 / K2 / S5 -------------------------------------------------------------------------------
@register("generate_explicit_ids", f"WITH {FR}, f AS (SELECT o_orderkey AS food_id, o_orderpriority AS "
          "food_name FROM orders), nn AS (SELECT food_id, max(n) AS n FROM fr GROUP BY food_id), "
          "ids AS (SELECT food_id, food_id * 2 AS pos FROM f UNION ALL SELECT food_id, food_id * 2 + 1 FROM nn "
          "WHERE n = 1 UNION ALL SELECT -1 - n_nationkey, -1 - n_nationkey FROM nation) "
          "SELECT 'sample_' || lpad(CAST(row_number() OVER (ORDER BY pos) AS VARCHAR), 6, '0') AS sample_id, "
          "ids.food_id AS fdc_id, f.food_name, CASE WHEN f.food_id IS NOT NULL THEN coalesce(nn.n, 0) END "
          "AS n_ingredients, f.food_id IS NOT NULL AS success, CASE WHEN f.food_id IS NULL THEN 'food id ' || "
          "CAST(ids.food_id AS VARCHAR) || ' not found' END AS error FROM ids LEFT JOIN f ON f.food_id = "
          "ids.food_id LEFT JOIN nn ON nn.food_id = ids.food_id")
def q_generate_explicit_ids(spark, sf_dir):
    """Every food by id, foods of one ingredient twice, and unknown ids: no size filter applies."""
    from labelcorpus.plans.generate import GenerateConfig, generate
    foods, ing = T.foods(spark, sf_dir), T.ingredients(spark, sf_dir)
    single = R.food_totals(ing).where(F.col("n_ingredients") == 1)
    unknown = T.table(spark, sf_dir, "nation").select((-1 - F.col("n_nationkey")).cast("bigint").alias("food_id"))
    ids = (foods.select("food_id", (F.col("food_id") * 2).alias("pos"))
           .unionByName(single.select("food_id", (F.col("food_id") * 2 + 1).alias("pos")))
           .unionByName(unknown.select("food_id", F.col("food_id").alias("pos"))))
    out = generate(spark, foods, ing, T.nutrients(spark, sf_dir), GenerateConfig(enable_validation=False),
                   fdc_ids=ids, group_col="group_key")
    return out["sample_index"].select("sample_id", "fdc_id", "food_name", "n_ingredients", "success", "error")


# E5 / P5 / P6 / S8 --------------------------------------------------------------------------
def _failures_sql() -> str:
    return (f"WITH r AS ({_report_sql()}), {FR}, nn AS (SELECT food_id, max(n) AS n, bool_or(sequence_number = 7) "
            "AS broken FROM fr WHERE n BETWEEN 2 AND 50 GROUP BY food_id) SELECT food_id AS fdc_id, "
            "CASE WHEN all_passed AND NOT broken THEN n END AS n_ingredients, all_passed AND NOT broken AS success, "
            "CASE WHEN broken THEN 'constraint' WHEN NOT all_passed THEN 'Validation failed: ' || "
            "CAST(n_failed AS VARCHAR) || ' rule(s) failed' END AS error FROM nn JOIN r USING (food_id)")


@register("generate_failures", _failures_sql())
def q_generate_failures(spark, sf_dir):
    """Foods with a seventh line get a negative weight there; failures of any kind leave the dataset."""
    from labelcorpus.plans.generate import GenerateConfig, generate
    ing = T.ingredients(spark, sf_dir)
    ing = ing.withColumn("weight_g", F.when(F.col("sequence_number") == 7, -F.col("weight_g")).otherwise(F.col("weight_g")))
    out = generate(spark, T.foods(spark, sf_dir), ing, T.nutrients(spark, sf_dir),
                   GenerateConfig(include_validation_failures=False), group_col="group_key")
    error = F.when(F.col("error").contains("must be"), "constraint").otherwise(F.col("error"))
    return out["sample_index"].select("fdc_id", "n_ingredients", "success", error.alias("error"))


@register("generate_tables", f"WITH {FR}, {SEL}, s AS (SELECT count(DISTINCT food_id) AS n FROM sel), "
          "l AS (SELECT count(*) AS n FROM lab) SELECT t AS table_name, CASE WHEN t IN ('declared', "
          "'canonical_mappings', 'target_mappings') THEN l.n WHEN t IN ('operator_records', 'validation_results') "
          "THEN 7 * s.n WHEN t = 'failures' THEN 0 ELSE s.n END AS n_rows FROM s, l, (SELECT unnest(["
          "'samples', 'declared', 'panel', 'operator_records', 'canonical_mappings', 'target_mappings', "
          "'ingredient_maps', 'splits', 'sample_index', 'failures', 'validation_results', "
          "'validation_report']) AS t)")
def q_generate_tables(spark, sf_dir):
    """Row counts of every output table."""
    from labelcorpus.plans.generate import GenerateConfig, generate
    out = generate(spark, T.foods(spark, sf_dir), T.ingredients(spark, sf_dir),
                   T.nutrients(spark, sf_dir), GenerateConfig(), group_col="group_key")
    counts = None
    for name, df in out.items():
        if name not in ("manifest", "summary"):
            one = df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"))
            counts = one if counts is None else counts.unionByName(one)
    return counts


# J6 -----------------------------------------------------------------------------------------
def _prefix_sql() -> str:
    from labelcorpus.knowledge import values as V
    prefix = "CASE substr(food_code, 1, 2) " + " ".join(
        f"WHEN {_sql_str(p)} THEN {_sql_str(c)}" for p, c in V.CODE_PREFIXES) + " END"
    return (f"WITH f AS ({T.sql_foods()}) SELECT food_id, food_code, CASE WHEN length(food_code) "
            f">= 2 THEN coalesce({prefix}, 'uncategorized') ELSE 'uncategorized' END AS category "
            "FROM f")


@register("prefix_class", _prefix_sql())
def q_prefix_class(spark, sf_dir):
    from labelcorpus.operators import tags
    k = L.Knowledge.default(spark)
    f = T.foods(spark, sf_dir)
    return f.select("food_id", "food_code",
                    tags.food_code_class(F.col("food_code"), k.prefixes).alias("category"))


# V4 with labels declared from one keyword table and checked against a larger one ------------
PART_ALLERGENS_DECLARED = [("bolt", "metal"), ("anvil", "metal"), ("ring", "jewelry")]
PART_ALLERGENS_CHECKED = PART_ALLERGENS_DECLARED + [("gear", "metal"), ("plate", "ceramic")]


def _detect_sql(rows, desc) -> str:
    """List of the labels (null: not found) whose keywords occur in ``desc``."""
    by = {}
    for kw, label in rows:
        by.setdefault(label, []).append(kw)
    parts = [f"CASE WHEN regexp_matches(lower({desc}), "
             f"{_sql_str('(^|[^a-z0-9])(' + '|'.join(sorted(k, key=len, reverse=True)) + ')s?([^a-z0-9]|$)')}) "
             f"THEN {_sql_str(l)} END" for l, k in sorted(by.items())]
    return f"[{', '.join(parts)}]"


def _part_allergen_sql() -> str:
    detect = _detect_sql
    return (
        f"WITH {FR}, {SEL}, det AS (SELECT food_id, list_sort(list_distinct(flatten(list("
        f"list_filter({detect(PART_ALLERGENS_DECLARED, 'description')}, lambda x: x IS NOT NULL))))) "
        f"AS declared, list_sort(list_distinct(flatten(list(list_filter("
        f"{detect(PART_ALLERGENS_CHECKED, 'description')}, lambda x: x IS NOT NULL))))) AS detected "
        "FROM lab GROUP BY food_id), ids AS (SELECT DISTINCT food_id FROM sel) "
        "SELECT ids.food_id, len(list_filter(coalesce(detected, []), lambda x: NOT list_contains("
        "coalesce(declared, []), x))) = 0 AS passed, array_to_string(list_filter(coalesce(detected, "
        "[]), lambda x: NOT list_contains(coalesce(declared, []), x)), ', ') AS missing "
        "FROM ids LEFT JOIN det USING (food_id)")


@register("validation_allergen", _part_allergen_sql())
def q_validation_allergen(spark, sf_dir):
    from labelcorpus.operators import tags
    from labelcorpus.operators import validation as VR
    schema = "pos int, keyword string, label string"
    decl_kw = _dim(spark, [(i, kw, l) for i, (kw, l) in enumerate(PART_ALLERGENS_DECLARED)], schema)
    check_kw = _dim(spark, [(i, kw, l) for i, (kw, l) in enumerate(PART_ALLERGENS_CHECKED)], schema)
    k = L.Knowledge.default(spark)
    fr = _selected(spark, sf_dir)
    declared = R.initial_declared(fr)
    order = _dim(spark, [("metal", 0), ("jewelry", 1), ("ceramic", 2)], "label string, rank int")
    labels = fr.select("food_id").distinct().join(
        tags.allergen_declarations(declared, decl_kw, k.allergen_exclusions, order), "food_id", "left")
    detected = tags.allergen_declarations(declared, check_kw, k.allergen_exclusions, order)
    res = VR.allergen_declaration(labels, detected)
    missing = F.regexp_extract(F.array_join("issues", "; "), r"Missing allergen declarations: ([^;]*)", 1)
    return res.select("food_id", "passed", missing.alias("missing"))


from labelcorpus.plans import report_queries, text_queries  # noqa: E402,F401  (register their queries)
