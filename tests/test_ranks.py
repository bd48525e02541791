"""Row numbers and lists of groups of any size against the plain window and aggregate."""

from __future__ import annotations

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from labelcorpus.operators import ranks, recipes, truth
from labelcorpus.plans import labels as L


def _rows(spark, n=6000):
    rng = random.Random(5)
    data = [(rng.choice([0, 0, 0, 1, 2, None]) if i % 3 else i, i % 7, i, rng.random()) for i in range(n)]
    return spark.createDataFrame(data, "k bigint, s int, i bigint, w double").repartition(5)


def test_row_numbers_equal_the_window(spark):
    df = _rows(spark)
    order = [F.col("s").desc(), F.col("i")]
    got = ranks.row_numbers(df, ["k"], order, "n", ranges=16)
    want = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy(*order)).cast("bigint"))
    assert got.columns == want.columns and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert ranks.row_numbers(df.limit(0), ["k"], order, "n").count() == 0


def test_a_hot_group_lies_in_many_tasks(spark):
    """The largest group of the window's own key is a range of the hot group, not the group."""
    df = _rows(spark).withColumn("k", F.coalesce(F.col("k"), F.lit(0)))
    cut = df.repartitionByRange(16, "k", F.col("s").desc(), "i").withColumn("p", F.spark_partition_id())
    largest = cut.groupBy("k", "p").count().agg(F.max("count")).first()[0]
    hot = df.groupBy("k").count().agg(F.max("count")).first()[0]
    assert hot > 6000 / 3 and largest < 6000 / 16 * 2
    plan = ranks.row_numbers(df, ["k"], [F.col("i")], "n", ranges=16)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_lists_from_runs_equal_whole_lists(spark, knowledge, monkeypatch):
    monkeypatch.setattr(ranks.run_of, "__defaults__", (7,))
    rows = [(f, i, i, i, f"PART {i % 11} of milk", float(i % 5) / 50, i % 9 == 0) for f, n in ((1, 100), (2, 7), (3, 1)) for i in range(n)]
    ing = spark.createDataFrame(rows, "food_id bigint, sequence_number int, pos bigint, code bigint, description string, fraction double, is_fortificant boolean") \
        .withColumn("pos2", F.lit(0))
    plain = L.declared_rows(ing, knowledge)
    ranged = L.declared_rows(ing, knowledge, any_size=True)
    assert plain.exceptAll(ranged.select(plain.columns)).isEmpty() and ranged.count() == plain.count()
    found = F.array(F.col("original_description"))
    for a, b in ((L.label_lists(plain, found), L.label_lists(ranged, found, any_size=True)),
                 (truth.truth_keys(plain), truth.truth_keys(ranged, any_size=True))):
        assert a.exceptAll(b.select(a.columns)).isEmpty() and a.count() == b.count()
    ops, foods = L.check_operators(None), ing.select("food_id").distinct()
    allergens = foods.withColumn("allergens", F.array(F.lit("milk")))
    text = lambda r: sorted(map(str, r.withColumn("config", F.to_json("config")).collect()))
    a = truth.operator_records(foods, plain, allergens, None, None, ops)
    b = truth.operator_records(foods, ranged, allergens, None, None, ops, any_size=True)
    assert text(a) == text(b) and a.count() > 0


def test_initial_declared_any_size_keeps_all_rows(spark):
    rows = [(9, 1, i, 0, i, f"x{i}", 1.0, False) for i in range(500)] + [(8, 1, 0, 0, 0, "y", 0.0, False)]
    ing = spark.createDataFrame(rows, "food_id bigint, sequence_number int, pos bigint, pos2 int, code bigint, description string, weight_g double, is_fortificant boolean")
    got = recipes.initial_declared(recipes.with_fractions(ing), any_size=True).where("food_id = 9")
    assert [r[0] for r in got.orderBy("label_pos").select("original_description").collect()] == [f"x{i}" for i in range(500)]


def test_earlier_min_equals_the_window(spark):
    df = _rows(spark)
    order = [F.col("s").desc(), F.col("i")]
    got = ranks.earlier_min(df, ["k"], order, "w", "least", ranges=16)
    w = Window.partitionBy("k").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumn("least", F.min("w").over(w))
    assert got.columns == want.columns and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert ranks.earlier_min(df.limit(0), ["k"], order, "w", "least").count() == 0


def test_ingredient_facts_of_any_size_find_the_same(spark):
    from labelcorpus.operators import validation as VR
    rows = [(f, f"name {i % 9}", (i * 7 % 11) / 20, i, "main" if i % 4 else "two_percent_or_less") for f in (1, 1, 1, 2, 3) for i in range(30)]
    lab = spark.createDataFrame(rows, "food_id int, original_description string, original_fraction double, label_pos int, declaration_group string")
    lab = lab.dropDuplicates(["food_id", "label_pos"])
    canon = lab.select("food_id", F.when(F.col("label_pos") == 3, "other").otherwise(F.col("original_description")).alias("description"),
                       F.lit(False).alias("is_fortificant"))
    lab = lab.where("not (food_id = 2 and original_description in ('name 1', 'name 5'))")
    issues = [VR.preservation_issues(F.col("canon"), F.col("lab")).alias("issues"), "food_id", "n_bad", "max_lt", "min_main", "lt2_threshold", "detected"]
    a, b = (VR.ingredient_facts(canon, lab, any_size=x).select(*issues) for x in (True, False))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty() and a.where("size(issues) > 0").count() == 3


def test_fractions_of_large_foods_are_dealt_out(spark, monkeypatch):
    """No join key holds a whole large food, and the rows are those of the plain join."""
    monkeypatch.setattr(recipes, "LARGE", 50)
    rows = [(0 if i % 3 == 0 else None if i % 50 == 1 else i % 200, i, i % 5, float(i % 11)) for i in range(3000)] + [(7, 1, 1, 2.0)] * 60
    df = spark.createDataFrame(rows, "food_id bigint, pos int, pos2 int, weight_g double").repartition(4)
    got, want = recipes.with_fractions(df, any_size=True), recipes.with_fractions(df)
    assert got.columns == want.columns and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_part" in plan and "_last" in plan


def test_ranges_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(ranks, "RANGE_ROWS", 100)
    df = _rows(spark)
    cut = ranks._cut(df, ["k"], [F.col("i")], None, "table")
    assert cut.groupBy("_range").count().agg(F.max("count")).first()[0] < 300
    got = ranks.row_numbers(df, ["k"], [F.col("i")], "n")
    want = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("i")).cast("bigint"))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
