"""Split counts, ranks, sampling, constraints, operator subsets and lexicon checks."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL


def test_split_counts_rules():
    from labelcorpus.operators.split import split_counts
    assert split_counts(5, 0.7, 0.15, 0.15) == (4, 1, 0)
    assert split_counts(0, 0.7, 0.15, 0.15) == (0, 0, 0)
    assert split_counts(200, 0.7, 0.15, 0.15) == (140, 30, 30)
    assert split_counts(1, 0.7, 0.15, 0.15) == (1, 0, 0)
    with pytest.raises(ValueError):
        split_counts(10, 0.5, 0.5, 0.5)


def test_lexicon_validation():
    from labelcorpus.knowledge.dims import parse_lexicon
    assert parse_lexicon('version: "0.1"\nmappings:\n  A: B\n') == [("A", "B")]
    with pytest.raises(ValueError):
        parse_lexicon('version: "0.2"\nmappings:\n  A: B\n')
    with pytest.raises(ValueError):
        parse_lexicon('version: "0.1"\nmappings: [1, 2]\n')
    with pytest.raises(ValueError):
        parse_lexicon("- just\n- a list\n")


def test_operator_subsets():
    from labelcorpus.plans.labels import DEFAULT_OPERATORS, check_operators
    assert check_operators(None) == DEFAULT_OPERATORS
    assert check_operators([]) == []
    with pytest.raises(ValueError):
        check_operators(["rename", "nope"])


def test_seeded_rank_is_exact_and_layout_independent(spark):
    from labelcorpus.operators.split import ascending_rank, seeded_key, seeded_rank
    ids = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select(
        F.col("o_custkey").alias("g")).distinct()
    want = [r["g"] for r in ids.withColumn("k", seeded_key("g", 42)).orderBy("k", "g").collect()]
    for parts in (1, 2, 8):
        got = seeded_rank(ids.repartition(parts), "g", 42).orderBy("rank").collect()
        assert [r["g"] for r in got] == want
        assert [r["rank"] for r in got] == list(range(1, len(want) + 1))
    asc = ascending_rank(ids.repartition(3), "g", buckets=16).orderBy("rank").collect()
    assert [r["g"] for r in asc] == sorted(want)


def test_seeded_sample_errors_when_too_few(spark):
    from labelcorpus.operators.split import seeded_sample
    ids = spark.range(5).withColumnRenamed("id", "food_id")
    assert seeded_sample(ids, 3).count() == 3
    with pytest.raises(ValueError, match="Only 5 recipes"):
        seeded_sample(ids, 6)


def test_group_split_has_no_leaks(spark):
    from labelcorpus.operators.split import group_split, split_leaks
    samples = spark.createDataFrame([(i, i % 5) for i in range(10)], "sample_id long, g long")
    out = group_split(samples, "g")
    assert split_leaks(out.select("g", "split"), "g").count() == 0
    sizes = {r["split"]: r["n"] for r in out.groupBy("split").agg(
        F.countDistinct("g").alias("n")).collect()}
    assert sizes == {"train": 4, "val": 1}


def test_constraints_quarantine(spark):
    from labelcorpus.operators import constraints as C
    df = spark.createDataFrame([(1, 5.0, 0.5, 1), (2, -1.0, 1.5, -2)],
                               "id int, weight_g double, fraction double, sequence_number int")
    good, bad = C.quarantine(C.with_errors(df, C.ingredient_checks()))
    assert [r["id"] for r in good.collect()] == [1]
    row = bad.first()
    assert row["id"] == 2 and len(row["errors"]) == 3


def test_refinement_guard(spark):
    from labelcorpus.operators import constraints as C
    s = spark.createDataFrame([("a", "INGREDIENTS: X."), ("b", "INGREDIENTS: Y."),
                               ("c", "INGREDIENTS: Z.")], "sample_id string, ingredient_text string")
    r = spark.createDataFrame([("a", "Ingredients: x, refined."), ("b", "NUTRITION FACTS ...")],
                              "sample_id string, refined_text string")
    out = {x["sample_id"]: x["ingredient_text"] for x in C.apply_refinements(s, r).collect()}
    assert out == {"a": "Ingredients: x, refined.", "b": "INGREDIENTS: Y.", "c": "INGREDIENTS: Z."}


def test_generic_and_compound_rules(spark):
    from labelcorpus.knowledge import dims as D
    from labelcorpus.operators import naming
    names = ["CHEDDAR CHEESE", "GRANNY SMITH APPLES", "RUSSET POTATOES", "RUSSET POTATO",
             "CHERRY", "BUTTER OIL", "COTTAGE CHEESE", "SWEET POTATOES", "CHOCOLATE",
             "BBQ SAUCE"]
    df = spark.createDataFrame([(n,) for n in names], "declared_name string").select(
        "declared_name", F.lit(False).alias("is_compound"),
        F.array().cast("array<string>").alias("sub_ingredients"))
    out = naming.compound(naming.generic_name(
        df.withColumn("orig", F.col("declared_name")), D.generic_names(spark)), D.compounds(spark))
    got = {r["orig"]: (r["declared_name"], r["generic_name_affected"]) for r in out.collect()}
    assert got["CHEDDAR CHEESE"] == ("CHEESE", True)
    assert got["GRANNY SMITH APPLES"] == ("APPLES", True)
    assert got["RUSSET POTATOES"] == ("POTATOES", True)
    assert got["RUSSET POTATO"] == ("RUSSET POTATO", False)
    assert got["CHERRY"] == ("TOMATOES", True)
    assert got["BUTTER OIL"] == ("BUTTER OIL", False)
    assert got["COTTAGE CHEESE"] == ("COTTAGE CHEESE", True)
    assert got["SWEET POTATOES"] == ("SWEET POTATOES", True)
    assert got["CHOCOLATE"][0] == ("CHOCOLATE (COCOA MASS, SUGAR, COCOA BUTTER, SOY LECITHIN, "
                                   "VANILLA EXTRACT)")
    assert got["BBQ SAUCE"] == ("BBQ SAUCE", False)


def test_allergen_edge_cases(spark):
    from labelcorpus.knowledge import dims as D
    from labelcorpus.operators import tags
    texts = ["Cream of tartar", "Almond flour", "Coconut water", "Eggplant", "Egg, whole",
             "Shrimp, cooked", "Peanut butter"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    col = tags.allergen_column(F.col("t"), D.allergen_keywords(spark), D.allergen_exclusions(spark))
    got = {r["t"]: r["a"] for r in df.select("t", col.alias("a")).collect()}
    assert got["Cream of tartar"] == []
    assert got["Almond flour"] == ["tree nuts"]
    assert got["Coconut water"] == []
    assert got["Eggplant"] == []
    assert got["Egg, whole"] == ["eggs"]
    assert got["Shrimp, cooked"] == ["crustacean shellfish"]
    assert got["Peanut butter"] == ["milk", "peanuts"]


def test_config_precedence():
    from labelcorpus.plans.generate import load_config
    cfg, snap = load_config("dataset_version: '0.1'\nn_samples: 200\n"
                            "include_validation_failures: false\nnote: x\n", n_samples=50)
    assert cfg.n_samples == 50 and cfg.include_validation_failures is False
    assert cfg.extra == {"note": "x"} and snap["source"]["n_samples"] == 200
    assert load_config()[0].n_samples is None


def test_word_matching_equals_regex(spark):
    from labelcorpus.functions.columns import word_tokens
    from labelcorpus.knowledge import dims as D
    from labelcorpus.operators import tags
    texts = ["Rice cake with honey.", "ICE CREAM, frozen yogurt", "éhoney bread", "breads and rolls",
             "a protein bar!", "protein, bar", "the cod_fish", "Soy sauce; hot sauce", "nothing",
             "", "Milk-based drink", "pie\ncroissant", "tortilla chips", "orange juice nectar"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for dim in (D.food_name_keywords(spark), D.ingredient_categories(spark)):
        d = (df.withColumn("_low", F.lower("t")).withColumn("_tok", word_tokens("_low"))
             .withColumn("_hits", tags.word_hits(F.col("_tok"), dim)))
        got = d.select("i", tags.first_match_class(F.col("t"), dim).alias("a"),
                       tags.first_match_class(F.col("t"), dim, F.col("_tok")).alias("b"),
                       tags.first_match_class(F.col("t"), dim, F.col("_hits"), F.col("_low"))
                       .alias("c")).collect()
        for r in got:
            assert r["a"] == r["b"] == r["c"], (texts[r["i"]], r["a"], r["b"], r["c"])
