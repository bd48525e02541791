"""Dictionary matching by joins against the rule expressions, and dictionaries that no expression could hold."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from labelcorpus.knowledge import dims
from labelcorpus.operators import naming, phrases, tags

GENERIC = [("Apple", "APPLES"), ("granny smith", "APPLES, GREEN"), ("Granny Smith", "GREEN APPLES"), ("Corn Syrup", "SYRUP"),
           ("corn syrup solids", "SOLIDS"), ("Salt", "SALTS, SEA"), ("Sea", "SEA"), ("7Up", "SODA"), ("half-and-Half", "CREAM"),
           ("Half-And-Half", "MILK CREAM"), ("Apple", "APPLE"), ("crème fraîche", "CREAM"), ("Ünder", "ÜNDER COOKED")]
NAMES = ["APPLE", "apple pie", "GRANNY SMITH", "peeled granny smith, raw", "popcorn syrups", "Corn syrup solids", "corn syrup", "sea salt", "Salt, sea",
         "salt", "7up", "half-and-half", "CRÈME FRAÎCHE light", "ünder cooked", "", " ", "salt salt", "(salt), sea", None, "nothing here"]
DECLARED = "food_id int, declared_name string, is_compound boolean, sub_ingredients array<string>"


def _declared(spark, names=NAMES):
    return spark.createDataFrame([(i, n, False, None) for i, n in enumerate(names)], DECLARED)


def _same(got, want):
    cols = sorted(want.columns)
    a, b = got.select(cols), want.select(cols)
    assert sorted(got.columns) == cols and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def _generic(spark, pairs):
    return spark.createDataFrame([(i, k, g) for i, (k, g) in enumerate(pairs)], "pos int, key string, generic string")


def test_title_form_is_that_of_the_plain_version(spark):
    keys = [k for k, _ in GENERIC] + ["A B", "a", "AB", "3rd Way", "3Rd Way", "O'Neil", "O'neil", "", "123"]
    got = spark.createDataFrame([(k,) for k in keys], "key string").select("key", phrases.title_form(F.col("key")).alias("t")).collect()
    assert {r["key"]: r["t"] for r in got} == {k: k == k.title() for k in keys}


def test_generic_names_equal_the_expressions(spark):
    dim = _generic(spark, GENERIC)
    _same(phrases.generic_name(_declared(spark), dim), naming.generic_name(_declared(spark), dim))


def test_generic_names_of_random_words(spark):
    rng = random.Random(3)
    words = ["salt", "sea", "corn", "syrup", "Syrup", "Salt", "greens", "green", "cornflour"]
    keys = list({" ".join(rng.choice(words) for _ in range(rng.choice([1, 1, 2, 3]))) for _ in range(40)})
    keys = [k.title() if i % 2 else k for i, k in enumerate(keys)]
    dim = _generic(spark, [(k, " ".join(rng.choice(words) for _ in range(2)).upper()) for k in keys])
    names = [" ".join(rng.choice(words) for _ in range(rng.choice([1, 2, 4]))).upper() for _ in range(300)]
    _same(phrases.generic_name(_declared(spark, names), dim), naming.generic_name(_declared(spark, names), dim))


def test_empty_tables(spark):
    none = _generic(spark, [("x", "y")]).limit(0)
    out = phrases.generic_name(_declared(spark), none)
    assert out.where("generic_name_affected").isEmpty() and out.count() == len(NAMES)
    assert phrases.generic_name(_declared(spark).limit(0), _generic(spark, GENERIC)).count() == 0
    texts = spark.createDataFrame([(1, "salt")], "id int, text string")
    assert phrases.keyword_labels(texts, "id", "text", spark.createDataFrame([], "keyword string, label string")).count() == 0


def test_a_dictionary_of_a_hundred_thousand_names(spark):
    dim = spark.range(100_000).select(
        F.col("id").cast("int").alias("pos"), F.format_string("item %06d raw", "id").alias("key"), F.format_string("KIND %d", "id").alias("generic"))
    names = ["ITEM 000017 RAW", "some item 099999 raw, peeled", "item 100000 raw", "item 000017 ra"]
    got = {r["food_id"]: r["declared_name"] for r in phrases.generic_name(_declared(spark, names), dim).collect()}
    assert got == {0: "KIND 17", 1: "KIND 99999", 2: "item 100000 raw", 3: "item 000017 ra"}


def test_compounds_equal_the_expressions(spark):
    rows = [("Ketchup", 1, "sugar", 0.2), ("Ketchup", 0, "tomato", 0.8), ("mayo", 0, "egg", 1.0), ("Soy Sauce", 0, "soy", 1.0)]
    dim = spark.createDataFrame(rows, "key string, pos int, sub_name string, fraction double")
    d = _declared(spark, ["KETCHUP", "ketchup", "MAYO", "soy sauce", "SOY SAUCE, DARK", None])
    _same(phrases.compound(d, dim), naming.compound(d, dim))


def test_keywords_equal_the_regex(spark):
    k = dims.allergen_keywords(spark)
    none = spark.createDataFrame([], "pattern string")
    none._lc_rows = []
    texts = ["Milk and eggs", "coconutmilk", "coconut milks.", "TREE NUTS, peanut-butter", "soy-sauce soys", "wheat" * 3, "", None, "éggs egg’s", "fish\nshell",
             "shrimps; crab cake", "almond/walnut(s)", "x" * 5000 + " milk"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    want = {r["id"]: r["a"] for r in df.select("id", tags.allergen_column(F.col("text"), k, none).alias("a")).collect() if r["a"]}
    got = {r["id"]: r["labels"] for r in phrases.keyword_labels(df, "id", "text", k).collect()}
    assert got == want and len(got) > 4
