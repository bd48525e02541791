"""Knowledge tables as DataFrames.

Every operator takes its knowledge as a DataFrame argument, so the same code runs on food
rows or on any other vocabulary. The defaults below are built from the fixed values in
``values.py``. Rules (patterns, thresholds, ordered categories) become column expressions and are read
with ``rule_rows``; lookups by key are joins, and Spark picks the join by the table's size.
"""

from __future__ import annotations

from importlib import resources

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelcorpus.knowledge import values as V

LEXICON_VERSION = "0.1"


def rule_rows(dim: DataFrame) -> list:
    """The rows of a rule table, which an operator turns into one expression per rule.

    Read once per DataFrame object; the rows live and go with it.
    """
    if getattr(dim, "_lc_rows", None) is None:
        dim._lc_rows = dim.collect()
    return dim._lc_rows


def _df(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """A knowledge table built on the driver; it keeps its rows so expression builders need
    no Spark job to read it back."""
    from pyspark.sql import Row
    df = spark.createDataFrame(rows, schema)
    names = df.columns
    df._lc_rows = [Row(**dict(zip(names, r))) for r in rows]
    return df


# ---------------------------------------------------------------------------------- names


def commercial_names(spark: SparkSession) -> DataFrame:
    """(description, name, pos): survey description -> commercial label name."""
    text = resources.files("labelcorpus.knowledge").joinpath("data/commercial_names.tsv")
    rows = []
    for pos, line in enumerate(text.read_text(encoding="utf-8").splitlines()):
        if line.strip():
            desc, name = line.split("\t")
            rows.append((desc, name, pos))
    return _df(spark, rows, "description string, name string, pos int")


def parse_lexicon(raw_text: str) -> list[tuple[str, str]]:
    """Validate a lexicon document (S6) and return its (description, name) pairs in order."""
    raw = yaml.safe_load(raw_text)
    if not isinstance(raw, dict):
        raise ValueError("Invalid label-name lexicon: not a mapping")
    version = raw.get("version")
    if version != LEXICON_VERSION:
        raise ValueError(f"Expected label-name lexicon version {LEXICON_VERSION}, got {version}")
    mappings = raw.get("mappings")
    if not isinstance(mappings, dict):
        raise ValueError("Missing mappings in label-name lexicon")
    return [(str(k), str(v)) for k, v in mappings.items()]


def label_lexicon(spark: SparkSession, path: str | None = None) -> DataFrame:
    """(description, name, pos) from the reviewed lexicon (checked version)."""
    if path is None:
        text = resources.files("labelcorpus.knowledge").joinpath("data/label_lexicon_v0.1.yaml")
        raw_text = text.read_text(encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            raw_text = fh.read()
    rows = [(d, n, i) for i, (d, n) in enumerate(parse_lexicon(raw_text))]
    return _df(spark, rows, "description string, name string, pos int")


def generic_names(spark: SparkSession) -> DataFrame:
    """(pos, key, generic): variety -> generic category."""
    rows = [(i, k, g) for i, (k, g) in enumerate(V.GENERIC_NAMES)]
    return _df(spark, rows, "pos int, key string, generic string")


def compounds(spark: SparkSession) -> DataFrame:
    """(key, pos, sub_name, fraction): compound recipes, one row per sub-ingredient."""
    rows = [(k, i, s, float(f)) for k, subs in V.COMPOUNDS for i, (s, f) in enumerate(subs)]
    return _df(spark, rows, "key string, pos int, sub_name string, fraction double")


# ------------------------------------------------------------------------------- patterns


def ingredient_categories(spark: SparkSession) -> DataFrame:
    rows = [(i, label, pat) for i, (label, pat) in enumerate(V.INGREDIENT_CATEGORIES)]
    return _df(spark, rows, "priority int, label string, pattern string")


def food_name_keywords(spark: SparkSession) -> DataFrame:
    rows = [(i, cat, pat) for i, (pat, cat) in enumerate(V.FOOD_NAME_KEYWORDS)]
    return _df(spark, rows, "priority int, label string, pattern string")


def allergen_keywords(spark: SparkSession) -> DataFrame:
    rows = [(i, k, label) for i, (k, label) in enumerate(V.ALLERGEN_KEYWORDS)]
    return _df(spark, rows, "pos int, keyword string, label string")


def allergen_exclusions(spark: SparkSession) -> DataFrame:
    return _df(spark, [(p,) for p in V.ALLERGEN_EXCLUSIONS], "pattern string")


def allergen_order(spark: SparkSession) -> DataFrame:
    return _df(spark, [(a, i) for i, a in enumerate(V.ALLERGEN_ORDER)], "label string, rank int")


def prohibited_terms(spark: SparkSession) -> DataFrame:
    return _df(spark, [(i, p) for i, p in enumerate(V.PROHIBITED_TERMS)], "pos int, pattern string")


# ------------------------------------------------------------------------------ servings


def racc(spark: SparkSession) -> DataFrame:
    rows = [(c, float(g), float(ml), s, h) for c, g, ml, s, h in V.RACC]
    return _df(spark, rows, "category string, racc_g double, racc_ml double, "
                            "label_statement string, household_measure string")


def code_prefixes(spark: SparkSession) -> DataFrame:
    return _df(spark, list(V.CODE_PREFIXES), "prefix string, category string")


# ----------------------------------------------------------------------------- nutrients


def daily_values(spark: SparkSession) -> DataFrame:
    """(nutrient_name, dv_key, dv_amount): the DV key is the identity when unmapped."""
    keys = dict(V.NUTRIENT_DV_KEYS)
    amounts = dict(V.DAILY_VALUES)
    rows = [(n, k, float(amounts[k]) if k in amounts else None) for n, k in keys.items()]
    mapped = set(keys.values()) | set(keys)
    rows += [(k, k, float(a)) for k, a in V.DAILY_VALUES if k not in mapped]
    return _df(spark, rows, "nutrient_name string, dv_key string, dv_amount double")


def content_claims(spark: SparkSession) -> DataFrame:
    """Unpivoted thresholds: (group_pos, claim_pos, nutrient, claim, kind, threshold, text).

    ``kind`` is one of per_serving, per_100g, per_100g_solid, per_100g_liquid; claims with
    no threshold (reduced fat, no added sugar) have no rows and so can never fire.
    """
    groups = {g: (i, n) for i, (g, n) in enumerate(V.CLAIM_GROUPS)}
    texts = dict(V.CLAIM_TEXTS)
    kinds = ["per_serving", "per_100g", "per_100g_solid", "per_100g_liquid"]
    rows = []
    claim_pos: dict[str, int] = {}
    for group, claim, *ths in V.CONTENT_CLAIMS:
        gpos, nutrient = groups[group]
        cpos = claim_pos.setdefault(group, 0)
        claim_pos[group] = cpos + 1
        for kpos, (kind, th) in enumerate(zip(kinds, ths)):
            if th is not None:
                rows.append((gpos, cpos, kpos, nutrient, claim, kind, float(th),
                             texts.get(claim, claim)))
    return _df(spark, rows, "group_pos int, claim_pos int, kind_pos int, nutrient string, "
                            "claim string, kind string, threshold double, text string")


def source_nutrients(spark: SparkSession) -> DataFrame:
    return _df(spark, list(V.SOURCE_NUTRIENTS), "nutrient string, display string")


def health_claims(spark: SparkSession) -> DataFrame:
    rows = [(i, n, c, float(t), txt) for i, (n, c, t, txt) in enumerate(V.HEALTH_CLAIMS)]
    return _df(spark, rows, "pos int, nutrient string, cmp string, threshold double, text string")


def rounding(spark: SparkSession) -> DataFrame:
    rows = [(n, None if z is None else float(z), float(f), None if u is None else float(u),
             float(c)) for n, z, f, u, c in V.ROUNDING]
    return _df(spark, rows, "nutrient string, zero_below double, fine_step double, "
                            "fine_upto double, coarse_step double")
