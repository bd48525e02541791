"""Registered queries over validation outcomes: labels with damage of every kind, all rules, both outcomes."""

from __future__ import annotations

from pyspark.sql import functions as F

from labelcorpus.knowledge import values as V
from labelcorpus.plans import labels as L
from labelcorpus.plans import queries as Q
from labelcorpus.sources import testdata as T

register, FR, SEL = Q.register, Q.FR, Q.SEL


# V1-V8 on damaged labels --------------------------------------------------------------------
def _part_knowledge(spark) -> L.Knowledge:
    """The built-in knowledge with allergens over part words, so that the test tables have some."""
    keywords = [(i, kw, label) for i, (kw, label) in enumerate(Q.PART_ALLERGENS_DECLARED)]
    return L.Knowledge.default(
        spark, allergen_keywords=Q._dim(spark, keywords, "pos int, keyword string, label string"),
        allergen_order=Q._dim(spark, [("metal", 0), ("jewelry", 1)], "label string, rank int"))


def _damaged(built: dict) -> dict:
    """The built tables after edits that break one rule or another, by food id."""
    def hit(n: int, r: int):
        return F.col("food_id") % n == r
    first = F.col("label_pos") == 1
    declared = built["declared"].where(~(hit(11, 0) & first))
    declared = (declared
                .withColumn("original_description", F.when(hit(11, 1) & first, "UNLISTED ITEM").otherwise(F.col("original_description")))
                .withColumn("declaration_group", F.when(hit(13, 1) & first, "two_percent_or_less").otherwise(F.col("declaration_group")))
                .withColumn("label_pos", F.when(hit(13, 0), -F.col("label_pos")).otherwise(F.col("label_pos"))))
    gone = hit(17, 0)
    label = (built["label"]
             .withColumn("serving_size", F.when(~gone, F.col("serving_size")))
             .withColumn("calories", F.when(~gone, F.col("calories") + F.when(hit(29, 0), 10.0).otherwise(0.0)))
             .withColumn("total_fat", F.when(~hit(17, 1), F.col("total_fat")))
             .withColumn("claims", F.when(hit(23, 0), F.array_append("claims", F.lit("FAT FREE"))).otherwise(F.col("claims")))
             .withColumn("ingredient_text", F.when(hit(31, 0), F.concat(F.lit("100% NATURAL "), "ingredient_text"))
                         .otherwise(F.col("ingredient_text")))
             .withColumn("allergen_text", F.when(hit(19, 1), F.lit("CONTAINS: MILK")).when(~hit(19, 0), F.col("allergen_text")))
             .withColumn("allergens", F.when(hit(19, 1), F.array(F.lit("milk"))).when(~hit(19, 0), F.col("allergens"))))
    return dict(built, declared=declared, label=label)


def _damaged_sql() -> str:
    from labelcorpus.operators.nutrition import nutrient_names
    sod = nutrient_names().index("Sodium, Na")
    detect = Q._detect_sql(Q.PART_ALLERGENS_DECLARED, "description")
    some = f"list_sort(list_distinct(flatten(list(list_filter({detect}, lambda x: x IS NOT NULL)))))"
    minus = "list_filter({a}, lambda x: NOT list_contains({b}, x))"
    terms = [V.PROHIBITED_TERMS[0], V.PROHIBITED_TERMS[-1]]

    def each(template: str) -> str:
        return "; ".join(template.format(p=p) for p in terms)

    def issues(*conds: tuple[str, str]) -> str:
        return "concat_ws('; ', " + ", ".join(f"CASE WHEN {c} THEN {m} END" for c, m in conds) + ")"
    prohibited = Q._sql_str(each("Potentially prohibited term: '{p}'"))
    found = Q._sql_str(each("Found: '{p}'"))
    v1 = issues(("len(mis) > 0", "'Missing: ' || array_to_string(mis, ', ')"), ("len(ext) > 0", "'Extra: ' || array_to_string(ext, ', ')"))
    v2 = issues(("n_bad > 0", "CAST(n_bad AS VARCHAR) || ' main-list order violations'"),
                ("max_lt > 0.02 + 1e-9", "'2% group has ingredients above threshold'"),
                ("max_lt > min_main + 1e-9", "'2% group heavier than main group minimum'"))
    v3 = issues(("food_id % 31 = 0", prohibited), ("food_id % 17 = 0", "'No Nutrition Facts panel'"),
                ("food_id % 17 = 1", "'Total Fat not set'"), (f"food_id % 17 <> 0 AND n{sod}_pos IS NULL", "'Sodium not set'"))
    v4 = issues(("len(amis) > 0", "'Missing allergen declarations: ' || array_to_string(amis, ', ')"),
                ("len(aext) > 0", "'Unexpected allergen declarations: ' || array_to_string(aext, ', ')"))
    v5 = issues((f"food_id % 23 = 0 AND coalesce({Q._ps_sql('Total lipid (fat)')}, 1.0) >= 0.5",
                 Q._sql_str("'Fat Free' claim but fat >= 0.5")))
    v6 = issues(("food_id % 17 = 0", "'No Nutrition Facts JSON to validate'"), ("food_id % 17 <> 0 AND food_id % 29 = 0", "'Calories mismatch'"))
    v7 = issues(("food_id % 31 = 0", found))
    rules = "[" + ", ".join(f"{{'rule': '{r}', 'issues': {x}}}" for r, x in zip(
        ("ingredient_preservation", "ingredient_order", "fda_syntax", "allergen_declaration", "claim_eligibility",
         "nutrition_facts_consistency", "prohibited_terminology"), (v1, v2, v3, v4, v5, v6, v7))) + "]"
    return (
        f"WITH {Q._prof_sql()}, {FR}, {SEL}, "
        "dam AS (SELECT food_id, f, CASE WHEN food_id % 11 = 1 AND label_pos = 1 THEN 'UNLISTED ITEM' ELSE description END AS description, "
        "CASE WHEN f <= 0.02 OR (food_id % 13 = 1 AND label_pos = 1) THEN 'lt' ELSE 'main' END AS grp, "
        "CASE WHEN food_id % 13 = 0 THEN -label_pos ELSE label_pos END AS lp FROM lab WHERE NOT (food_id % 11 = 0 AND label_pos = 1)), "
        "pm AS (SELECT *, min(f) OVER (PARTITION BY food_id, grp ORDER BY lp ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) "
        "AS least FROM dam), "
        f"d1 AS (SELECT food_id, list_sort(list_distinct(list(description))) AS have, {some} AS det, count(*) FILTER (WHERE grp = 'main' "
        "AND f > least + 1e-9) AS n_bad, max(f) FILTER (WHERE grp = 'lt') AS max_lt, min(f) FILTER (WHERE grp = 'main') AS min_main "
        "FROM pm GROUP BY food_id), "
        f"d0 AS (SELECT food_id, list_sort(list_distinct(list(description))) AS want, {some} AS decl0 FROM lab GROUP BY food_id), "
        "ids AS (SELECT DISTINCT food_id FROM sel), "
        "j AS (SELECT prof.*, n_bad, max_lt, min_main, coalesce(want, []) AS want, coalesce(have, []) AS have, coalesce(det, []) AS det, "
        "CASE WHEN ids.food_id % 19 = 0 THEN [] WHEN ids.food_id % 19 = 1 THEN ['milk'] ELSE coalesce(decl0, []) END AS decl "
        "FROM ids JOIN prof USING (food_id) LEFT JOIN d0 USING (food_id) LEFT JOIN d1 USING (food_id)), "
        f"k AS (SELECT *, {minus.format(a='want', b='have')} AS mis, {minus.format(a='have', b='want')} AS ext, "
        f"{minus.format(a='det', b='decl')} AS amis, {minus.format(a='decl', b='det')} AS aext FROM j), "
        f"r AS (SELECT food_id, unnest({rules}) AS x FROM k) "
        "SELECT food_id, x.rule AS rule, x.issues = '' AS passed, x.issues AS issues FROM r")


def _damaged_results(spark, sf_dir):
    from labelcorpus.plans.validate import validate
    from labelcorpus.session import materialize
    k = _part_knowledge(spark)
    fr = materialize(Q._selected(spark, sf_dir))
    foods = T.foods(spark, sf_dir).join(fr.select("food_id").distinct(), "food_id", "left_semi")
    built = L.build_labels(foods, fr, T.nutrients(spark, sf_dir), k, materialize="table")
    return validate(_damaged(built), fr, k, how="table")


@register("validation_damaged", _damaged_sql())
def q_validation_damaged(spark, sf_dir):
    """Every rule with both outcomes and its messages, on labels that were edited after they were built."""
    results, _ = _damaged_results(spark, sf_dir)
    return results.select("food_id", "rule", "passed", F.array_join("issues", "; ").alias("issues"))


@register("validation_damaged_report", f"WITH r AS ({_damaged_sql()}) SELECT food_id, bool_and(passed) AS all_passed, "
          "count(*) FILTER (WHERE passed) AS n_passed, count(*) FILTER (WHERE NOT passed) AS n_failed FROM r GROUP BY food_id")
def q_validation_damaged_report(spark, sf_dir):
    _, report = _damaged_results(spark, sf_dir)
    return report.select("food_id", "all_passed", "n_passed", "n_failed")


# Write, read back, damage, assemble ------------------------------------------------
def _assembled_sql() -> str:
    return (
        f"WITH {FR}, {SEL}, ids AS (SELECT DISTINCT food_id FROM sel), "
        "s AS (SELECT food_id, 'sample_' || lpad(CAST(row_number() OVER (ORDER BY food_id) AS VARCHAR), 6, '0') AS sample_id FROM ids), "
        "c AS (SELECT food_id, count(*) AS n FROM lab GROUP BY food_id), "
        "r AS (SELECT sample_id, food_id, coalesce(n, 0) AS n, concat_ws('; ', CASE WHEN food_id % 11 = 0 THEN 'samples missing' END, "
        "CASE WHEN food_id % 7 = 0 AND food_id % 11 <> 0 AND n > 0 THEN 'declared incomplete' END, "
        "CASE WHEN food_id % 13 = 0 THEN 'operator_records damaged' END) AS reason FROM s LEFT JOIN c USING (food_id)) "
        "SELECT sample_id, reason, CASE WHEN reason = '' THEN n END AS n_declared, CASE WHEN reason = '' THEN CAST(7 AS BIGINT) END "
        "AS n_records, CASE WHEN reason = '' THEN food_id END AS food_id FROM r")


@register("assembled_samples", _assembled_sql())
def q_assembled_samples(spark, sf_dir):
    """A dataset is generated, published and read back; parts of it are damaged; whole samples and quarantine come back."""
    import uuid

    from labelcorpus.plans.generate import GenerateConfig, generate, write_dataset
    from labelcorpus.session import ensure_checkpoint_dir
    from labelcorpus.sources import dataset
    cfg = GenerateConfig(enable_validation=False)
    out = generate(spark, T.foods(spark, sf_dir), T.ingredients(spark, sf_dir), T.nutrients(spark, sf_dir), cfg, group_col="group_key")
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/dataset-{uuid.uuid4().hex}"
    write_dataset(spark, out, root, cfg)
    tables = dataset.read_dataset(spark, root)
    fid = F.col("food_id")
    damaged = dict(
        tables, samples=tables["samples"].where(fid % 11 != 0),
        declared=tables["declared"].where(~((fid % 7 == 0) & (F.col("label_pos") == 1))),
        operator_records=tables["operator_records"].withColumn("operator_name", F.when(
            ~((fid % 13 == 0) & (F.col("op_pos") == 0)), F.col("operator_name"))))
    whole, quarantine = dataset.assemble_samples(damaged)
    none = F.lit(None).cast("bigint")
    return whole.select(
        "sample_id", F.lit("").alias("reason"), F.size("declared").cast("bigint").alias("n_declared"),
        F.size("operator_records").cast("bigint").alias("n_records"), F.col("label.food_id").alias("food_id")).unionByName(
        quarantine.select("sample_id", "reason", none.alias("n_declared"), none.alias("n_records"), none.alias("food_id")))


# A10-A13 --------------------------------------------------------------------------------------
MAPPING_COLS = ["recall_at_5", "mrr", "exact_match_rate"]


def _evaluation_sql() -> str:
    parts = []
    for task, frame, cols in (("parsing", "pm", Q.PARSING_COLS), ("mapping", "mm", MAPPING_COLS)):
        avgs = ", ".join(f"round_even(avg({c}), 4) AS {c}" if c in cols else f"CAST(NULL AS DOUBLE) AS {c}"
                         for c in Q.PARSING_COLS + MAPPING_COLS)
        for grouping, key in (("all", "''"), ("difficulty", "difficulty"), ("operators", "operator_set")):
            parts.append(f"SELECT '{task}' AS task, '{grouping}' AS grouping, {key} AS key, count(*) AS n_samples, {avgs} "
                         f"FROM {frame} JOIN k ON k.food_id = {frame}.{'food_id' if frame == 'pm' else 'sample_id'} GROUP BY 3")
    return (f"WITH pm AS ({Q._parsing_metrics_sql()}), mm AS ({Q._mapping_metrics_sql()}), {FR}, {SEL}, "
            "lt AS (SELECT DISTINCT food_id FROM lab WHERE f <= 0.02), "
            "k AS (SELECT food_id, CASE WHEN food_id % 2 = 0 AND lt.food_id IS NOT NULL THEN 'MEDIUM' ELSE 'EASY' END AS difficulty, "
            "CASE WHEN food_id % 2 = 0 THEN 'less_than_2_pct,rename' ELSE 'rename' END AS operator_set "
            "FROM (SELECT DISTINCT food_id FROM sel) LEFT JOIN lt USING (food_id)) " + " UNION ALL ".join(parts))


@register("evaluation_report", _evaluation_sql())
def q_evaluation_report(spark, sf_dir):
    """Parsing and mapping averages of a dataset of two configurations: foods of even id have the 2% operator, the others not."""
    from labelcorpus.operators import evaluate as E
    from labelcorpus.operators import recipes as R
    from labelcorpus.operators import truth
    from labelcorpus.session import materialize
    parsing, _, _, built = Q._parsing_per_sample(spark, sf_dir, how="table")
    parsing = materialize(parsing.select("food_id", *Q.PARSING_COLS), wide=True)
    ids = built["label"].select("food_id")
    keys, preds = Q._mapping_frames(spark, sf_dir, built["selected"])
    mapping = E.evaluate_mapping(ids.withColumnRenamed("food_id", "sample_id"), keys, preds, 5, "sample_id")
    even = F.col("food_id") % 2 == 0
    rows = R.less_than_2_pct(R.initial_declared(built["selected"]))
    for flag in ("rename_affected", "generic_name_affected", "compound_affected"):
        rows = rows.withColumn(flag, F.lit(False))
    records = truth.operator_records(ids.where(even), rows.where(even), None, None, None, ["rename", "less_than_2_pct"]).unionByName(
        truth.operator_records(ids.where(~even), rows.where(~even), None, None, None, ["rename"]))
    names = F.create_map(*[x for n, name in V.DIFFICULTY_NAMES for x in (F.lit(n), F.lit(name))])
    groups = truth.difficulty(records).join(E.operator_set_key(records), "food_id").select(
        F.col("food_id").alias("sample_id"), F.try_element_at(names, F.col("difficulty")).alias("difficulty"), "operator_set")
    return E.grouped_report({"parsing": (parsing.withColumnRenamed("food_id", "sample_id"), Q.PARSING_COLS),
                             "mapping": (mapping, MAPPING_COLS)}, groups)


# W4, X8, X13, L8, K5, A17, L10 ---------------------------------------------------------------
@register("truth_keys", f"WITH {FR}, {SEL}, t AS (SELECT food_id, CASE WHEN f <= 0.02 THEN 1 ELSE 0 END AS group_pos, label_pos, "
          "upper(description) AS declared_name, description AS original_description FROM lab), "
          "n AS (SELECT *, row_number() OVER (PARTITION BY food_id, declared_name ORDER BY group_pos, label_pos) AS k FROM t) "
          "SELECT food_id, group_pos, label_pos, original_description, CASE WHEN k = 1 THEN declared_name ELSE declared_name || '#' "
          "|| CAST(k AS VARCHAR) END AS key FROM n")
def q_truth_keys(spark, sf_dir):
    from labelcorpus.operators import recipes as R
    from labelcorpus.operators import truth
    keys = truth.truth_keys(R.less_than_2_pct(R.initial_declared(Q._selected(spark, sf_dir))))
    return keys.select("food_id", "group_pos", "label_pos", "original_description", "key")


def _records_sql() -> str:
    name = "list({c} ORDER BY {o}) FILTER (WHERE {w})"
    renamed = name.format(c="description", o="label_pos", w="renamed")
    low = name.format(c="description", o="label_pos", w="f <= 0.02")
    return (f"WITH {FR}, {SEL}, ids AS (SELECT DISTINCT food_id FROM sel), "
            "l AS (SELECT *, upper(description) <> description AS renamed FROM lab), "
            f"a AS (SELECT food_id, {low} AS low FROM l GROUP BY food_id), "
            "r AS (SELECT ids.food_id, unnest([{'op_pos': 0, 'operator_name': 'less_than_2_pct', 'config': 'threshold=0.02', "
            "'affected': coalesce(array_to_string(low, ' | '), '')}, {'op_pos': 1, 'operator_name': 'compound', 'config': '', "
            "'affected': ''}]) AS x FROM ids LEFT JOIN a USING (food_id)) "
            "SELECT food_id, CAST(x.op_pos AS INTEGER) AS op_pos, x.operator_name AS operator_name, '1.0' AS version, x.affected AS affected, "
            "x.config AS config FROM r")


@register("operator_records", _records_sql())
def q_operator_records(spark, sf_dir):
    """Name, version, affected ingredients in label order and configuration of each applied operator."""
    k = L.Knowledge.default(spark)
    fr = Q._selected(spark, sf_dir)
    from labelcorpus.operators import truth
    ops = ["less_than_2_pct", "compound"]
    records = truth.operator_records(fr.select("food_id").distinct(), L.declared_rows(fr, k, ops), None, None, None, ops)
    config = F.array_join(F.transform(F.map_entries("config"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return records.select("food_id", "op_pos", "operator_name", "version", F.array_join("affected", " | ").alias("affected"),
                          config.alias("config"))


@register("split_members", f"WITH g AS ({Q.GROUP_SPLIT_SQL}) SELECT DISTINCT split, group_key FROM g")
def q_split_members(spark, sf_dir):
    from labelcorpus.operators import split as S
    return S.split_members(Q.QUERIES["group_split"](spark, sf_dir), "group_key")


@register("pilot_audit", f"WITH {FR}, {SEL}, c AS (SELECT food_id, count(*) AS n FROM lab GROUP BY food_id), "
          f"g AS ({Q.GROUP_SPLIT_SQL}), leak AS (SELECT count(*) AS k FROM (SELECT group_key FROM g GROUP BY group_key HAVING "
          "count(DISTINCT split) > 1)) SELECT (SELECT count(DISTINCT food_id) FROM sel) AS n_samples, min(n) AS min_ingredients, "
          "max(n) AS max_ingredients, round_even(avg(n), 2) AS mean_ingredients, (SELECT count(*) FROM lab WHERE length(description) > 10) "
          "AS long_names, (SELECT count(*) FROM lab WHERE contains(description, ',')) AS names_with_commas, (SELECT k FROM leak) AS ids_in_several_splits "
          "FROM c")
def q_pilot_audit(spark, sf_dir):
    from labelcorpus.operators import evaluate as E
    from labelcorpus.operators import recipes as R
    fr = Q._selected(spark, sf_dir)
    declared = R.initial_declared(fr)
    splits = Q.QUERIES["group_split"](spark, sf_dir)
    owner = splits.select("food_id", "group_key").withColumnRenamed("food_id", "_f")
    counts = E.pilot_audit(fr.select("food_id").distinct(), declared, splits, long_name=10)
    leaks = E.pilot_audit(owner, owner.withColumn("declared_name", F.lit("")), splits, "group_key").select("ids_in_several_splits")
    return counts.drop("ids_in_several_splits").select("*", leaks.scalar().alias("ids_in_several_splits"))


@register("claim_rows", f"WITH {Q._prof_sql()}, c AS (SELECT food_id, {Q._claim_sql_parts()['content']} AS a, "
          f"{Q._claim_sql_parts()['source']} AS b, {Q._claim_sql_parts()['health']} AS h FROM prof), "
          "d AS (SELECT food_id, list_concat(a, b, h) AS x FROM c), u AS (SELECT food_id, list_filter(x, lambda y, i: list_position(x, y) = i) "
          "AS x FROM d), e AS (SELECT food_id, unnest(x) AS claim_text, generate_subscripts(x, 1) - 1 AS claim_pos FROM u) "
          "SELECT food_id, CAST(claim_pos AS INTEGER) AS claim_pos, claim_text, CASE WHEN "
          + " OR ".join(f"contains(lower(claim_text), '{w}')" for w in V.CONTENT_CLAIM_WORDS)
          + " THEN 'nutrient_content' ELSE 'health' END AS claim_type FROM e")
def q_claim_rows(spark, sf_dir):
    from labelcorpus.operators import nutrition as N
    k, ctx, _, prof = Q._nutrition_frames(spark, sf_dir)
    return N.claim_rows(N.food_claims(prof, ctx, k.content_claims, k.source_nutrients, k.health_claims))


# One large document by many tasks ---------------------------------------------------
@register("survey_split_scan", f"WITH ing AS ({Q.ING}), w AS (SELECT food_id, count(*) AS n, sum(weight_g) AS t FROM ing GROUP BY food_id) "
          "SELECT o_orderkey AS food_id, o_orderpriority AS description, CAST(coalesce(n, 0) AS BIGINT) AS n_inputs, "
          + Q.sq("coalesce(t, 0.0)") + " AS total_weight FROM orders LEFT JOIN w ON w.food_id = o_orderkey")
def q_survey_split_scan(spark, sf_dir):
    """All foods as one JSON document, read back in byte ranges of 1 MB."""
    import uuid

    from labelcorpus.session import ensure_checkpoint_dir
    from labelcorpus.sources import survey as S
    from labelcorpus.sources.survey_scan import read_split, write_document
    foods, ing = T.foods(spark, sf_dir), T.ingredients(spark, sf_dir)
    inputs = ing.groupBy("food_id").agg(F.collect_list(F.struct(
        F.col("code").alias("ingredientCode"), F.col("description").alias("ingredientDescription"),
        F.col("weight_g").alias("ingredientWeight"), F.col("sequence_number").alias("sequenceNumber"))).alias("inputFoods"))
    rows = foods.join(inputs, "food_id", "left").select("food_id", F.to_json(F.struct(
        F.col("food_id").alias("fdcId"), F.col("food_code").alias("foodCode"), F.col("food_name").alias("description"), "inputFoods")).alias("r"))
    first = foods.agg(F.min("food_id")).scalar()
    lines = rows.select(F.lit(1).alias("part"), "food_id", F.concat(F.when(F.col("food_id") == first, "").otherwise(","), "r").alias("value"))
    ends = spark.createDataFrame([(0, None, '{"SurveyFoods": ['), (2, None, "]}")], "part int, food_id bigint, value string")
    document = f"{ensure_checkpoint_dir(spark).rstrip('/')}/survey-{uuid.uuid4().hex}.json"
    write_document(lines.unionByName(ends), ["part", "food_id"], document)
    raw = read_split(spark, document, "SurveyFoods", S.FOOD, 1 << 20)
    total = F.aggregate(F.coalesce("inputFoods", F.array()), F.lit(0.0), lambda a, x: a + x["ingredientWeight"])
    return raw.select(F.col("fdcId").alias("food_id"), "description", F.coalesce(F.size("inputFoods"), F.lit(0)).cast("bigint").alias("n_inputs"),
                      Q.q(total).alias("total_weight"))


# Foreign code ---------------------------------------------------------------
@register("foreign_parser", f"WITH {FR}, {SEL}, g AS (SELECT food_id, count(*) FILTER (WHERE f <= 0.02) AS low, count(DISTINCT description) AS n "
          "FROM lab GROUP BY food_id) SELECT food_id, CASE WHEN low > 0 THEN 'ValueError: 2% group' END AS parser_error, CASE WHEN low = 0 THEN CAST(1.0 AS DOUBLE) END "
          "AS f1, CASE WHEN low = 0 THEN CAST(n AS INTEGER) END AS n_correct FROM g")
def q_foreign_parser(spark, sf_dir):
    """A foreign parser over every label: it fails on labels with a 2% group, the others are scored."""
    from labelcorpus.operators import foreign
    from labelcorpus.operators import recipes as R

    def split_at_commas(text: str) -> list[str]:  # as a user might bring it
        if "CONTAINS 2%" in text:
            raise ValueError("2% group")
        return [x for x in text.removeprefix("INGREDIENTS: ").removesuffix(".").split(", ") if x]
    declared = R.less_than_2_pct(R.initial_declared(Q._selected(spark, sf_dir)))
    lists = L.label_lists(declared)
    none = F.lit(None).cast("string")
    samples = lists.select("food_id", F.concat("main_names", "two_percent_names").alias("truth_names"), L.ingredient_text(
        F.col("main_names"), F.col("two_percent_names"), none, F.array().cast("array<string>")).alias("ingredient_text"))
    return foreign.evaluate_parser(samples, split_at_commas).select("food_id", "parser_error", "f1", "n_correct")


# W1, X9, W4, L8 for foods of any size --------------------------------------------------------
HOT = ("hot AS (SELECT * REPLACE (CASE WHEN food_id % 3 = 0 THEN 0 ELSE food_id END AS food_id) FROM (" + Q.ING + ")), "
       "tot AS (SELECT food_id, sum(weight_g) AS total FROM hot GROUP BY food_id), "
       "lab AS (SELECT hot.*, weight_g / total AS f, row_number() OVER (PARTITION BY food_id ORDER BY weight_g / total DESC, "
       "sequence_number, pos, pos2) AS label_pos FROM hot JOIN tot USING (food_id) WHERE NOT is_fortificant)")


def _hot_declared(spark, sf_dir):
    """Declared rows of foods of which one has a third of all ingredients."""
    from labelcorpus.operators import recipes as R
    rows = T.ingredients(spark, sf_dir).withColumn("food_id", F.when(F.col("food_id") % 3 == 0, 0).otherwise(F.col("food_id")))
    return R.less_than_2_pct(R.initial_declared(R.with_fractions(rows, any_size=True), any_size=True))


@register("hot_food_order", f"WITH {HOT} SELECT food_id, CAST(label_pos AS INTEGER) AS label_pos, description AS original_description, "
          "CASE WHEN f <= 0.02 THEN 'two_percent_or_less' ELSE 'main' END AS declaration_group FROM lab")
def q_hot_food_order(spark, sf_dir):
    return _hot_declared(spark, sf_dir).select("food_id", "label_pos", "original_description", "declaration_group")


@register("hot_food_text", f"WITH {HOT}, t AS (SELECT food_id, string_agg(upper(description), ', ' ORDER BY label_pos) FILTER (WHERE f > 0.02) AS m, "
          "string_agg(upper(description), ', ' ORDER BY label_pos) FILTER (WHERE f <= 0.02) AS l FROM lab GROUP BY food_id) "
          "SELECT food_id, 'INGREDIENTS: ' || concat_ws(', ', m, CASE WHEN l IS NOT NULL THEN 'CONTAINS 2% OR LESS OF: ' || l END) "
          "|| '.' AS ingredient_text FROM t")
def q_hot_food_text(spark, sf_dir):
    lists = L.label_lists(_hot_declared(spark, sf_dir), any_size=True)
    none = F.array().cast("array<string>")
    return lists.select("food_id", L.ingredient_text(
        F.col("main_names"), F.col("two_percent_names"), F.lit(None).cast("string"), none).alias("ingredient_text"))


@register("hot_food_keys", f"WITH {HOT}, n AS (SELECT food_id, CASE WHEN f <= 0.02 THEN 1 ELSE 0 END AS group_pos, label_pos, upper(description) AS name, "
          "row_number() OVER (PARTITION BY food_id, upper(description) ORDER BY CASE WHEN f <= 0.02 THEN 1 ELSE 0 END, label_pos) AS k FROM lab) "
          "SELECT food_id, group_pos, CAST(label_pos AS INTEGER) AS label_pos, CASE WHEN k = 1 THEN name ELSE name || '#' || CAST(k AS VARCHAR) END "
          "AS key FROM n")
def q_hot_food_keys(spark, sf_dir):
    from labelcorpus.operators import truth
    return truth.truth_keys(_hot_declared(spark, sf_dir), any_size=True).select("food_id", "group_pos", "label_pos", "key")


@register("hot_food_rules", f"WITH {HOT}, dam AS (SELECT food_id, CASE WHEN label_pos = 1 AND food_id % 4 = 0 THEN 'UNLISTED ITEM' ELSE description END AS d, f, "
          "f <= 0.02 AS low, CASE WHEN food_id % 13 = 0 THEN -label_pos ELSE label_pos END AS lp FROM lab WHERE NOT (food_id % 2 = 0 AND "
          "description IN ('red bolt', 'small ring'))), "
          "pm AS (SELECT *, min(f) OVER (PARTITION BY food_id, low ORDER BY lp ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS least FROM dam), "
          "o AS (SELECT food_id, count(*) FILTER (WHERE NOT low AND f > least + 1e-9) AS n_bad, list(DISTINCT d) AS have FROM pm GROUP BY food_id), "
          "w AS (SELECT food_id, list(DISTINCT description) AS want FROM lab GROUP BY food_id), "
          "j AS (SELECT food_id, coalesce(n_bad, 0) AS n_bad, coalesce(want, []) AS want, coalesce(have, []) AS have FROM w FULL JOIN o USING (food_id)) "
          "SELECT food_id, CAST(n_bad AS BIGINT) AS n_bad, array_to_string(list_sort(list_filter(want, lambda x: NOT list_contains(have, x))), ', ') AS missing, "
          "array_to_string(list_sort(list_filter(have, lambda x: NOT list_contains(want, x))), ', ') AS extra FROM j")
def q_hot_food_rules(spark, sf_dir):
    """V1 and V2 on foods of which one has a third of all ingredients: names left out, an unlisted one, labels in reverse."""
    from labelcorpus.operators import recipes as R
    from labelcorpus.operators import validation as VR
    rows = T.ingredients(spark, sf_dir).withColumn("food_id", F.when(F.col("food_id") % 3 == 0, 0).otherwise(F.col("food_id")))
    fr, name = R.with_fractions(rows, any_size=True), F.col("original_description")
    declared = _hot_declared(spark, sf_dir).where(~((F.col("food_id") % 2 == 0) & name.isin("red bolt", "small ring")))
    declared = (declared.withColumn("original_description", F.when((F.col("label_pos") == 1) & (F.col("food_id") % 4 == 0), "UNLISTED ITEM").otherwise(name))
                .withColumn("label_pos", F.when(F.col("food_id") % 13 == 0, -F.col("label_pos")).otherwise(F.col("label_pos"))))
    facts = VR.ingredient_facts(fr, declared, any_size=True)
    lists = [F.coalesce(c, F.array().cast("array<string>")) for c in ("canon", "lab")]
    joined = [F.array_join(F.array_sort(F.array_except(a, b)), ", ") for a, b in (lists, lists[::-1])]
    return facts.select("food_id", "n_bad", joined[0].alias("missing"), joined[1].alias("extra"))
