"""Classification and tagging: food-code / food-name class, RACC serving size, ingredient
class and allergens (J6-J9, J11, J12, X6, L5).

Pattern tables become literal ``rlike`` expressions (cached, compiled once per task, inside
codegen), so the cost is rows x patterns with no join and no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelcorpus.functions.columns import (
    allergen_text, any_keyword, ci, first_match, first_match_words, guarded_rlike, keyword_alternation,
    keyword_match, present)
from labelcorpus.knowledge import values as V
from labelcorpus.knowledge.dims import rule_rows

UNCATEGORIZED = V.UNCATEGORIZED


def _patterns(dim: DataFrame) -> list[tuple[str, str]]:
    rows = sorted(rule_rows(dim), key=lambda r: r["priority"])
    return [(r["pattern"], r["label"]) for r in rows]


# J6 ----------------------------------------------------------------------------------------
def food_code_class(code: Column, prefix_dim: DataFrame) -> Column:
    """Category of the first two characters of the code; 'uncategorized' otherwise."""
    pairs = [(r["prefix"], r["category"]) for r in rule_rows(prefix_dim)]
    pmap = F.create_map(*[F.lit(x) for kv in pairs for x in kv])
    cat = F.when(F.length(code) >= 2, F.try_element_at(pmap, F.substring(code, 1, 2)))
    return F.coalesce(cat, F.lit(UNCATEGORIZED))


# J7 / J11 ----------------------------------------------------------------------------------
def first_match_class(text: Column, pattern_dim: DataFrame, tokens: Column | None = None,
                      low: Column | None = None) -> Column:
    """Label of the first pattern (by priority) found in the text; null when none.

    With ``tokens`` (a ``word_tokens`` column computed once per row) word-group patterns are
    answered by set lookups instead of regex scans, which matters for long texts.
    """
    if tokens is None:
        return first_match(text, _patterns(pattern_dim))
    return first_match_words(text, _patterns(pattern_dim), tokens, low=low)


def word_hits(tokens: Column, pattern_dim: DataFrame) -> Column:
    """The document's words that occur as a single-word alternative in any word-group pattern
    of the table: one hash pass over the tokens. Passing this (instead of all tokens) to
    ``first_match_class`` gives the same result, since each pattern's words are a subset."""
    from labelcorpus.functions.columns import _WORD_GROUP
    words = sorted({a for p, _ in _patterns(pattern_dim) if (m := _WORD_GROUP.match(p))
                    for a in m.group(1).split("|") if " " not in a})
    return F.array_intersect(tokens, F.array(*[F.lit(w) for w in words]).cast("array<string>"))


# J8 ----------------------------------------------------------------------------------------
def racc_amount(category: Column, racc_dim: DataFrame) -> Column:
    """RACC grams, else millilitres, for a category; null for unknown / uncategorized."""
    rows = rule_rows(racc_dim)
    pairs = []
    for r in rows:
        amount = r["racc_g"] if r["racc_g"] and r["racc_g"] > 0 else (
            r["racc_ml"] if r["racc_ml"] and r["racc_ml"] > 0 else None)
        if amount is not None:
            pairs.append((r["category"], float(amount)))
    rmap = F.create_map(*[x for c, a in pairs for x in (F.lit(c), F.lit(a))])
    return F.try_element_at(rmap, category)


# J9 ----------------------------------------------------------------------------------------
def serving_size(foods: DataFrame, prefix_dim: DataFrame, name_dim: DataFrame,
                 racc_dim: DataFrame, low: float = 5.0, high: float = 500.0) -> DataFrame:
    """Add code_category, name_category and serving_g (own size if in [low, high], else RACC
    by code, else RACC by name, else 100)."""
    code_cat = food_code_class(F.coalesce(F.col("food_code"), F.lit("")), prefix_dim)
    name_cat = first_match_class(F.col("food_name"), name_dim)
    own = F.col("serving_size_g")
    return (foods.withColumn("code_category", code_cat)
            .withColumn("name_category", name_cat)
            .withColumn("serving_g", F.coalesce(
                F.when(own.between(low, high), own),
                F.when(F.length(F.coalesce("food_code", F.lit(""))) > 0,
                       racc_amount(F.col("code_category"), racc_dim)),
                F.when(F.length(F.coalesce("food_name", F.lit(""))) > 0,
                       racc_amount(F.col("name_category"), racc_dim)),
                F.lit(100.0))))


# J12 ---------------------------------------------------------------------------------------
def allergen_column(text: Column, keyword_dim: DataFrame, exclusion_dim: DataFrame,
                    tokens: Column | None = None) -> Column:
    """Sorted distinct allergen labels found in one ingredient text (empty when excluded).

    ``tokens`` (an ``ascii_word_tokens`` column) switches one-word keywords to set lookups,
    for long texts."""
    by_label: dict[str, list[str]] = {}
    for r in sorted(rule_rows(keyword_dim), key=lambda r: r["pos"]):
        by_label.setdefault(r["label"], []).append(r["keyword"])
    excl = [r["pattern"] for r in rule_rows(exclusion_dim)]
    low = F.lower(text)
    if tokens is None:
        # one scan tells whether a text has any keyword at all; only then the labels and exclusions are looked at
        empty, excluded = F.array().cast("array<string>"), F.lit(False)
        for p in excl:
            excluded = excluded | guarded_rlike(text, p, low)
        found = present(*[(text.rlike(ci(keyword_alternation(kws))), F.lit(label)) for label, kws in sorted(by_label.items())])
        some = low.rlike(any_keyword([k for kws in by_label.values() for k in kws])) if by_label else F.lit(False)
        return F.when(some, F.when(excluded, empty).otherwise(found)).otherwise(empty)
    found = F.filter(F.array(*[F.when(keyword_match(text, kws, tokens), F.lit(label))
                               for label, kws in sorted(by_label.items())]),
                     lambda x: x.isNotNull())
    excluded = F.lit(False)
    for p in excl:
        excluded = excluded | guarded_rlike(text, p, low)
    return F.when(F.coalesce(excluded, F.lit(False)), F.array().cast("array<string>")).otherwise(
        F.coalesce(found, F.array().cast("array<string>")))


def order_allergens(allergens: Column, order_dim: DataFrame) -> Column:
    """Allergens in declaration order; labels outside the order come last, alphabetically."""
    ranks = {r["label"]: r["rank"] for r in rule_rows(order_dim)}
    rmap = F.create_map(*[x for k, v in ranks.items() for x in (F.lit(k), F.lit(v))])
    keyed = F.transform(allergens, lambda a: F.struct(
        F.coalesce(F.try_element_at(rmap, a), F.lit(1 << 30)).alias("r"), a.alias("a")))
    return F.transform(F.array_sort(keyed), lambda s: s["a"])


# L5 ----------------------------------------------------------------------------------------
def allergen_declarations(declared: DataFrame, keyword_dim: DataFrame, exclusion_dim: DataFrame,
                          order_dim: DataFrame) -> DataFrame:
    """Foods with at least one allergen: allergens (alphabetical) and declaration text.

    Detection reads the original descriptions, not the declared names.
    """
    # explode + collect_set: the partial aggregate keeps at most one entry per label, so even a
    # food holding a large share of all rows is reduced map-side before the shuffle.
    per_row = declared.select(
        "food_id", F.explode(allergen_column(F.col("original_description"), keyword_dim,
                                             exclusion_dim)).alias("_a"))
    per_food = per_row.groupBy("food_id").agg(F.array_sort(F.collect_set("_a")).alias("allergens"))
    return per_food.select(
        "food_id", "allergens",
        allergen_text(order_allergens(F.col("allergens"), order_dim)).alias("allergen_text"))
