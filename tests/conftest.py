"""Shared fixtures: one local session and a survey document of two own foods."""

from __future__ import annotations

import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from labelcorpus.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"

SOUP, TOAST = 91001, 91002


def _nutrients(**amounts):
    names = {"protein": ("Protein", "g"), "protein_again": ("Protein", "g"), "fat": ("Total lipid (fat)", "g"),
             "carbohydrate": ("Carbohydrate, by difference", "g"), "energy": ("Energy", "kcal"),
             "sodium": ("Sodium, Na", "mg")}
    return [{"nutrient": {"id": i, "number": str(i), "name": names[k][0], "unitName": names[k][1]}, "amount": v}
            for i, (k, v) in enumerate(amounts.items(), 1)]


def _inputs(*rows):
    return [{"ingredientCode": code, "ingredientDescription": text, "ingredientWeight": weight,
             "sequenceNumber": i, "retentionCode": 0} for i, (code, text, weight) in enumerate(rows, 1)]


# Own foods. The soup is liquid by name, has a fortificant, a compound, a nutrient given twice and an empty
# portion; the toast has a variety with a generic name, a 2% ingredient and no sodium.
SURVEY = {"SurveyFoods": [
    {"fdcId": SOUP, "foodCode": "58403010", "description": "Tomato soup with noodles",
     "foodNutrients": _nutrients(protein=2.0, fat=0.4, carbohydrate=9.0, energy=45.0, sodium=300.0, protein_again=2.5),
     "inputFoods": _inputs((501, "Tomato pulp", 50.0), (502, "Water, tap", 30.0), (503, "Noodles, wheat", 15.0),
                           (504, "Ketchup", 4.0), (999401, "Vitamin C", 0.5), (505, "Salt, table", 0.5)),
     "foodPortions": [{"gramWeight": 0.0, "modifier": "CUP", "amount": "0.0"}]},
    {"fdcId": TOAST, "foodCode": "51300110", "description": "Toast with apple",
     "foodNutrients": _nutrients(protein=7.0, fat=12.0, carbohydrate=40.0, energy=300.0),
     "inputFoods": _inputs((601, "Flour of wheat", 55.0), (602, "Granny Smith", 20.0), (603, "Butter, plain", 24.0),
                           (604, "Cinnamon", 1.0)),
     "foodPortions": [{"gramWeight": 40.0, "modifier": "SLICE", "amount": "2"}]},
]}


@pytest.fixture(scope="session")
def spark():
    return local_session("local[4]", **{"spark.sql.shuffle.partitions": "8"})


@pytest.fixture(scope="session")
def survey_path(tmp_path_factory):
    path = tmp_path_factory.mktemp("survey") / "survey.json"
    path.write_text(json.dumps(SURVEY))
    return str(path)


@pytest.fixture(scope="session")
def survey_tables(spark, survey_path):
    from labelcorpus.knowledge import values as V
    from labelcorpus.sources import survey as S
    raw = S.read_survey(spark, survey_path).cache()
    return {"raw": raw, "foods": S.foods(raw),
            "ingredients": S.ingredients(raw, V.FORTIFICANT_CODES),
            "nutrients": S.nutrients(raw)}


@pytest.fixture(scope="session")
def knowledge(spark):
    from labelcorpus.plans.labels import Knowledge
    return Knowledge.default(spark)


@pytest.fixture(scope="session")
def survey_labels(spark, survey_tables, knowledge):
    from labelcorpus.operators import recipes as R
    from labelcorpus.plans.labels import build_labels
    fr = R.select_recipes(survey_tables["ingredients"], 1, 50)
    return build_labels(survey_tables["foods"], fr, survey_tables["nutrients"], knowledge)
