"""What is written on the way: shuffle files go with their job, texts and long nutrient rows are neither shuffled nor written again."""

import time

from pyspark.sql import functions as F

from labelcorpus.functions import columns as C
from labelcorpus.operators import nutrition as N
from labelcorpus.operators import validation as VR
from labelcorpus.session import materialize


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _shuffle_files(spark) -> set[str]:
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = disk.getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def test_a_written_table_leaves_no_shuffle_files(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting, before = spark.conf.get(key, None), _shuffle_files(spark)
    out = materialize(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    for _ in range(50):  # files are removed in the background
        if not (left := _shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    assert not left and out.count() == 7 and spark.conf.get(key, None) == setting


def test_rules_do_not_shuffle_the_texts(spark, survey_labels, knowledge):
    from labelcorpus.plans.validate import validate
    empty = survey_labels["declared"].limit(0).select(
        "food_id", F.lit("x").alias("description"), F.lit(False).alias("is_fortificant"))
    results, _ = validate(survey_labels, empty, knowledge)
    exchanges = [x for x in results._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in x or "Aggregate" in x]
    assert exchanges
    label = VR.label_issues(survey_labels["label"], [r"\bnatural\b"], "claims")
    assert label.columns == ["food_id", "claims", "_shown", "_syntax", "_terms"]
    join = _plan(label.join(survey_labels["profile"].select("food_id", "n0_pos"), "food_id", "left"))
    assert not [x for x in join.splitlines() if "Exchange" in x and ("panel_text" in x or "ingredient_text" in x)]


def test_nutrient_profile_is_one_hash_aggregate_a_stage(spark):
    df = spark.createDataFrame([(1, "A", 0, 1.0), (1, "A", 3, 2.0), (2, None, 1, 4.0), (None, "A", 1, -0.0)],
                               "food_id int, name string, pos int, amount double")
    profile = N.nutrient_profile(df, ["A"])
    plan = _plan(profile)
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan
    assert {tuple(r) for r in profile.collect()} == {(1, 2, 2.0, 1.0, 0), (2, 1, None, None, None), (None, 1, -0.0, -0.0, 1)}


def test_cheap_formats_and_names_equal_the_slow_ones(spark):
    odd = [0.0, -0.0, 0.04, 0.05, 0.15, 0.25, 0.35, 0.5, 0.95, 1.5, 2.5, 99.95, -0.3, -2.5, 999999.95, 1e6, 1e15, 1e300, None,
           float("nan"), float("inf"), float("-inf")] + [i / 20 for i in range(400)]
    x = F.col("x")
    slow = [F.call_function("format_number", x, F.lit(p)) for p in ("0", "0.0")] + [F.bround(x, 0).cast("string")]
    fast = [C.fmt0(x), C.fmt1(x), C.half_even(x).cast("string")]
    df = spark.createDataFrame([(v,) for v in odd], "x double")
    differ = df.where(~(slow[0].eqNullSafe(fast[0]) & slow[1].eqNullSafe(fast[1]) & slow[2].eqNullSafe(fast[2])))
    assert differ.collect() == []
    names = [("a ,b", "A B"), (" a", "A"), ("a  b", "A B"), ("a\tb", "A B"), ("a,\nb ", "A B"), ("\x0ba", "A"), ("a b", "A B"), ("", ""), (None, None)]
    got = spark.createDataFrame(names, "n string, want string").select("want", C.label_safe_name("n").alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_first_match_needs_one_scan_where_nothing_matches(spark):
    patterns = [(r"\b(soup|broth)\b", "soup"), ("cake", "cake")]
    df = spark.createDataFrame([("Soup",), ("pancake",), ("soupy",), ("", ), (None,)], "t string")
    assert [r[0] for r in df.select(C.first_match("t", patterns, "none")).collect()] == ["soup", "cake", "none", "none", "none"]
    assert "RLIKE" in str(C.first_match("t", patterns)).upper().split("THEN")[0]
