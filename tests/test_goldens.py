"""End-to-end label goldens for the two own foods of conftest (worked out by hand)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SOUP, TOAST


def _by_food(df):
    return {r["food_id"]: r for r in df.collect()}


def test_loader_counts_and_serving(survey_tables):
    foods = _by_food(survey_tables["foods"])
    # an empty portion is at least 1 g and, with a zero amount, no household serving
    assert (foods[SOUP]["serving_size_g"], foods[SOUP]["household_serving"]) == (1.0, None)
    assert (foods[TOAST]["serving_size_g"], foods[TOAST]["household_serving"]) == (40.0, "2 SLICE")
    assert survey_tables["nutrients"].where(F.col("food_id") == SOUP).count() == 6


def test_fractions(survey_tables):
    from labelcorpus.operators import recipes as R
    fr = R.with_fractions(survey_tables["ingredients"])
    rows = fr.where(F.col("food_id") == TOAST).orderBy("pos").collect()
    assert [r["fraction"] for r in rows] == pytest.approx([0.55, 0.2, 0.24, 0.01])
    assert fr.where("is_fortificant").select("description").collect()[0][0] == "Vitamin C"


def test_recipe_filter_counts(survey_tables):
    from labelcorpus.operators import recipes as R
    ing = survey_tables["ingredients"]
    assert [R.recipe_ids(ing, n, 50).count() for n in (1, 4, 5, 6, 7)] == [2, 2, 1, 1, 0]


def test_declared_names_and_groups(survey_labels):
    label = _by_food(survey_labels["label"])
    # the fortificant is gone, the compound is expanded, salt (0.5 %) is in the last group
    assert label[SOUP]["main_names"] == [
        "TOMATO PULP", "WATER", "NOODLES WHEAT",
        "KETCHUP (TOMATO CONCENTRATE, SUGAR, VINEGAR, SALT, SPICES, WATER)"]
    assert label[SOUP]["two_percent_names"] == ["SALT"]
    # by fraction, the variety under its generic name
    assert label[TOAST]["main_names"] == ["FLOUR OF WHEAT", "BUTTER PLAIN", "APPLES"]
    assert label[TOAST]["two_percent_names"] == ["CINNAMON"]


def test_serving_sizes(survey_labels):
    served = _by_food(survey_labels["servings"])
    assert served[SOUP]["serving_g"] == 245.0  # 1 g is out of range: the soup category
    assert served[TOAST]["serving_g"] == 40.0


def test_allergens(survey_labels):
    label = _by_food(survey_labels["label"])
    assert (label[SOUP]["allergens"], label[SOUP]["allergen_text"]) == (["wheat"], "CONTAINS: WHEAT")
    assert (label[TOAST]["allergens"], label[TOAST]["allergen_text"]) == (
        ["milk", "wheat"], "CONTAINS: MILK and WHEAT")


def test_panel_values(survey_labels):
    panel = _by_food(survey_labels["panel"])
    cols = ("calories", "total_fat", "total_carbohydrate", "protein", "sodium")
    # 245 g: 110.25 kcal, 0.98 g, 22.05 g, 4.9 g (the first protein), 735 mg
    assert [panel[SOUP][c] for c in cols] == [110.0, 1.0, 22.0, 5.0, 740.0]
    # 40 g: 120 kcal, 4.8 g, 16 g, 2.8 g
    assert [panel[TOAST][c] for c in cols] == [120.0, 5.0, 16.0, 3.0, None]
    assert panel[SOUP]["daily_values"] == {"Total lipid (fat)": 1.0, "Carbohydrate, by difference": 8.0,
                                           "Protein": 10.0, "Sodium, Na": 32.0}


def test_claims(survey_labels):
    label = _by_food(survey_labels["label"])
    cancer = "Diets low in total fat may reduce the risk of some cancers."
    # the last protein (2.5 g) counts for claims: 6.125 g a serving are 12 % of the daily value
    assert label[SOUP]["claims"] == ["LOW FAT", "GOOD SOURCE OF PROTEIN", cancer]
    assert label[TOAST]["claims"] == [cancer]


def test_rendered_text(survey_labels):
    lines = _by_food(survey_labels["label"])[TOAST]["ingredient_text"].split("\n")
    assert lines[-1] == ("INGREDIENTS: FLOUR OF WHEAT, BUTTER PLAIN, APPLES, CONTAINS 2% OR LESS OF: "
                         "CINNAMON. CONTAINS: MILK and WHEAT.")
    assert len(lines) == 2
