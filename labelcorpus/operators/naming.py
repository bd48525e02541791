"""Naming operators over the declared table: rename (L1), generic names (L2), compounds (L3).

Each adds ``<operator>_affected`` so operator records (L8) and difficulty (A8) can be derived
without re-running anything. Dictionary lookups are equi joins against small knowledge
tables (broadcast by Spark's size check); pattern lists are turned into literal expressions,
so matching runs inside whole-stage codegen with no join at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelcorpus.functions.columns import label_safe_name
from labelcorpus.knowledge.dims import rule_rows


def _title_form(key: str) -> bool:
    # Python's str.title() is the reference's matching rule; keys are small driver-side data.
    return key == key.title()


# J1 / L1 -----------------------------------------------------------------------------------
def rename(declared: DataFrame, lexicon: DataFrame, commercial: DataFrame) -> DataFrame:
    """declared_name = lexicon name, else commercial name, else the label-safe description."""
    lex = (lexicon.groupBy(F.col("description").alias("_lex_desc"))
           .agg(F.max_by("name", "pos").alias("_lex_name")))
    com = (commercial.groupBy(F.col("description").alias("_com_desc"))
           .agg(F.max_by("name", "pos").alias("_com_name")))
    out = (declared
           .join(lex, declared.original_description == F.col("_lex_desc"), "left")
           .join(com, declared.original_description == F.col("_com_desc"), "left"))
    new = F.coalesce("_lex_name", "_com_name", label_safe_name("original_description"))
    return (out.withColumn("rename_affected", new != F.col("declared_name"))
            .withColumn("declared_name", new)
            .drop("_lex_desc", "_lex_name", "_com_desc", "_com_name"))


# J2-J4 / L2 --------------------------------------------------------------------------------
def generic_name_column(name: F.Column, generic_dim: DataFrame) -> F.Column:
    """Generic replacement for a declared name, or null when none applies.

    Order: whole name (title-form keys, case-insensitive), then the longest multi-word phrase
    contained in the name, then the first single word whose generic shares a word with the
    rest of the name (one trailing 's' ignored).
    """
    rows = sorted(rule_rows(generic_dim), key=lambda r: r["pos"])
    latest: dict[str, str] = {}
    for r in rows:  # a repeated key keeps its first position and its last value
        latest[r["key"]] = r["generic"]
    keys = list(latest.items())
    low = F.lower(name)

    whole_pairs = [(k.lower(), g) for k, g in keys if _title_form(k)]
    whole = (F.try_element_at(F.create_map(*[F.lit(x) for kv in whole_pairs for x in kv]), low)
             if whole_pairs else F.lit(None).cast("string"))

    phrases = sorted([(k, g) for k, g in keys if len(k.split()) >= 2], key=lambda kv: -len(kv[0]))
    phrase = None
    for k, g in phrases:
        cond = low.contains(k.lower())
        phrase = F.when(cond, F.lit(g)) if phrase is None else phrase.when(cond, F.lit(g))
    phrase = F.lit(None).cast("string") if phrase is None else phrase

    words = [(k.lower(), g) for k, g in keys if _title_form(k) and len(k.split()) == 1]
    if words:
        gmap = F.create_map(*[F.lit(x) for kv in words for x in kv])
        tmap = F.create_map(*[x for k, g in words for x in (
            F.lit(k), F.array(*[F.lit(t.strip(" ,()").lower().removesuffix("s"))
                                for t in g.split() if t.strip(" ,()")]).cast("array<string>"))])
        tokens = F.filter(F.split(F.trim(name), r"\s+"), lambda t: t != "")
        low_tokens = F.transform(tokens, lambda t: F.lower(t))
        stripped = F.filter(
            F.transform(tokens, lambda t: F.lower(F.regexp_replace(t, r"^[ ,()]+|[ ,()]+$", ""))),
            lambda t: t != "")

        def guard(tok):
            others = F.transform(F.array_remove(stripped, tok),
                                 lambda w: F.regexp_replace(w, "s$", ""))
            return F.arrays_overlap(others, F.try_element_at(tmap, tok))

        hits = F.filter(low_tokens,
                        lambda t: F.try_element_at(gmap, t).isNotNull() & F.coalesce(guard(t), F.lit(False)))
        word = F.try_element_at(gmap, F.try_element_at(hits, F.lit(1)))
    else:
        word = F.lit(None).cast("string")
    return F.coalesce(whole, phrase, word)


def generic_name(declared: DataFrame, generic_dim: DataFrame) -> DataFrame:
    g = generic_name_column(F.col("declared_name"), generic_dim)
    return (declared.withColumn("_generic", g)
            .withColumn("generic_name_affected", F.col("_generic").isNotNull())
            .withColumn("declared_name", F.coalesce(F.upper("_generic"), F.col("declared_name")))
            .drop("_generic"))


# J5 / L3 -----------------------------------------------------------------------------------
def compound(declared: DataFrame, compound_dim: DataFrame) -> DataFrame:
    """Expand names equal (title-form, case-insensitive) to a compound key: NAME (SUB1, SUB2)."""
    rows = rule_rows(compound_dim)
    recipes: dict[str, list[tuple[int, str]]] = {}
    for r in rows:
        if _title_form(r["key"]):
            recipes.setdefault(r["key"].lower(), []).append((r["pos"], r["sub_name"]))
    if recipes:
        cmap = F.create_map(*[x for k, subs in recipes.items() for x in (
            F.lit(k), F.array(*[F.lit(s.upper()) for _, s in sorted(subs)]))])
        subs = F.try_element_at(cmap, F.lower("declared_name"))
    else:
        subs = F.lit(None).cast("array<string>")
    hit = subs.isNotNull()
    return (declared.withColumn("_subs", subs)
            .withColumn("compound_affected", hit)
            .withColumn("is_compound", F.col("is_compound") | hit)
            .withColumn("sub_ingredients",
                        F.when(hit, F.col("_subs")).otherwise(F.col("sub_ingredients")))
            .withColumn("declared_name",
                        F.when(hit, F.concat(F.col("declared_name"), F.lit(" ("),
                                             F.array_join("_subs", ", "), F.lit(")")))
                        .otherwise(F.col("declared_name")))
            .drop("_subs"))
