"""Rules are evaluated once a food; keyword scans and nutrient profiles keep their odd cases."""

from pyspark.sql import functions as F

from labelcorpus.operators import nutrition as N
from labelcorpus.operators import tags
from labelcorpus.operators import validation as VR


def test_rule_rows_do_not_evaluate_the_rules_twice(spark):
    text = F.col("id").cast("string")
    facts = spark.range(3).select(F.col("id").alias("food_id"), F.array(text).alias("rules_of"))
    issues = VR.present((F.col("food_id") > 0, F.concat(F.lit("odd marker "), F.array_join("rules_of", ","))))
    checked = facts.select("food_id", issues.alias("one")).select(
        "food_id", F.array(F.struct(F.lit("r").alias("rule"), (F.size("one") == 0).alias("passed"), F.col("one").alias("issues"))).alias("rules"))
    rows = VR.rule_results(checked)
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("odd marker") == 1
    assert sorted((r.food_id, r.rule, r.passed, r.issues) for r in rows.collect()) == [
        (0, "r", True, []), (1, "r", False, ["odd marker 1"]), (2, "r", False, ["odd marker 2"])]


def test_allergens_of_odd_texts(spark):
    keywords = spark.createDataFrame([(0, "milk", "milk"), (1, "egg", "eggs"), (2, "soy-bean", "soybeans")], "pos int, keyword string, label string")
    exclusions = spark.createDataFrame([(0, r"\begg substitute\b")], "pos int, pattern string")
    texts = ["MILK, Eggs", "egg substitute with milk", "buttermilk", "\u212amilk", "Soy-Beans", "", None, "soybean"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    found = {r.i: r.a for r in df.select("i", tags.allergen_column(F.col("t"), keywords, exclusions).alias("a")).collect()}
    assert found == {0: ["eggs", "milk"], 1: [], 2: [], 3: ["milk"], 4: ["soybeans"], 5: [], 6: [], 7: []}


def test_nutrient_profile_of_repeated_and_null_rows(spark):
    rows = [(1, "A", 0, 1.0), (1, "A", 5, 2.0), (1, "B", None, 3.0), (1, None, 1, 4.0), (1, "C", 2, 5.0), (2, "B", 1, None), (None, "A", 7, 6.0)]
    df = spark.createDataFrame(rows, "food_id int, name string, pos int, amount double")
    got = {r.food_id: tuple(r)[1:] for r in N.nutrient_profile(df, ["A", "B"]).collect()}
    assert got == {1: (5, 2.0, 1.0, 0, None, None, None), 2: (1, None, None, None, None, None, 1),
                   None: (1, 6.0, 6.0, 7, None, None, None)}
