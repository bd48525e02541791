"""Dictionary matching for dictionaries of any size (J2-J5, J12): lookups by equality instead of one literal per rule.

``naming`` and ``tags`` turn a rule table into expressions, which suits tables of some thousand rules. Here the dictionary
stays a DataFrame: each distinct name or text gives out the strings that a rule could match (itself, its substrings of the
lengths that occur in the dictionary, its words), one equi join finds the rules, and one aggregate picks the first by rank.
Both give the same results; nothing of the dictionary is collected but the set of its key lengths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CASED = r"\p{Lu}\p{Ll}\p{Lt}"
WHOLE, PHRASE, WORD = 0, 1, 2


def title_form(key: Column) -> Column:
    """Upper case at the start of every run of letters with case, lower case inside it."""
    return ~key.rlike(rf"(?<![{CASED}])\p{{Ll}}|(?<=[{CASED}])[\p{{Lu}}\p{{Lt}}]")


def _words(text: Column) -> Column:
    return F.filter(F.split(F.trim(text), r"\s+"), lambda t: t != "")


def _stripped(text: Column) -> Column:
    """Lower-cased words without blanks, commas and brackets around them; empty ones go."""
    bare = F.transform(_words(text), lambda t: F.lower(F.regexp_replace(t, r"^[ ,()]+|[ ,()]+$", "")))
    return F.filter(bare, lambda t: t != "")


def _singular(words: Column) -> Column:
    return F.transform(words, lambda w: F.regexp_replace(w, "s$", ""))


def _key_lengths(rules: DataFrame, condition: Column) -> list[int]:
    """Distinct key lengths: at most as many as the longest key has characters, whatever the dictionary's size."""
    return sorted(r["n"] for r in rules.where(condition).select(F.length("key").alias("n")).distinct().collect())


def generic_rules(generic_dim: DataFrame) -> DataFrame:
    """(kind, key, rank, generic, targets): the dictionary (pos, key, generic) as rules by kind.

    A repeated key keeps its first position and its last value; keys that differ in case only are one phrase, the earlier
    wins. Rows with a null key or generic are no rules.
    """
    once = (generic_dim.where(F.col("key").isNotNull() & F.col("generic").isNotNull()).groupBy("key")
            .agg(F.min("pos").alias("pos"), F.max_by("generic", F.struct("pos", "generic")).alias("generic")))
    low, n_words = F.lower("key"), F.size(_words(F.col("key")))
    title = title_form(F.col("key"))
    kinds = F.array_compact(F.array(F.when(title, WHOLE), F.when(n_words >= 2, PHRASE), F.when(title & (n_words == 1), WORD)))
    each = once.select(F.explode(kinds).alias("kind"), low.alias("key"), "pos", "generic")
    first = F.min_by("generic", F.struct("pos", "generic"))
    return (each.groupBy("kind", "key").agg(F.min("pos").alias("rank"), first.alias("generic"))
            .withColumn("targets", F.when(F.col("kind") == WORD, _singular(_stripped(F.col("generic"))))))


def generic_matches(names: DataFrame, rules: DataFrame) -> DataFrame:
    """(declared_name, generic) of the distinct names that a rule applies to; see ``naming.generic_name_column`` for the order.

    A name of n characters gives out at most n substrings for each key length that is no longer than it.
    """
    name = F.col("declared_name")
    low = F.lower(name)
    lengths = _key_lengths(rules, F.col("kind") == PHRASE)
    entry = lambda kind, key, at: F.struct(F.lit(kind).alias("kind"), key.alias("key"), at.cast("int").alias("at"))
    fitting = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length(low))
    pieces = F.flatten(F.transform(fitting, lambda n: F.transform(
        F.sequence(F.lit(1), F.length(low) - n + 1), lambda p: entry(PHRASE, F.substr(low, p, n), F.lit(0)))))
    words = F.transform(_words(name), lambda t, i: entry(WORD, F.lower(t), i))
    given = F.concat(F.array(entry(WHOLE, low, F.lit(0))), F.array_distinct(pieces), words)
    asked = (names.select("declared_name").where(name.isNotNull()).distinct()
             .withColumn("_rest", _stripped(name)).select("declared_name", "_rest", F.inline(given)))
    hits = asked.join(rules, ["kind", "key"])
    # a word's generic must share a word with the rest of the name
    shares = F.arrays_overlap(_singular(F.array_remove("_rest", F.col("key"))), F.col("targets"))
    hits = hits.where((F.col("kind") != WORD) | F.coalesce(shares, F.lit(False)))
    order = F.struct("kind", "at", F.when(F.col("kind") == PHRASE, -F.length("key")).otherwise(0), "rank", "generic")
    return hits.groupBy("declared_name").agg(F.min_by("generic", order).alias("generic"))


def generic_name(declared: DataFrame, generic_dim: DataFrame) -> DataFrame:
    """``naming.generic_name`` for a dictionary of any size: whole name, longest phrase, first guarded word.

    Each distinct name is matched once, however many rows hold it; null names stay null and unaffected.
    """
    found = generic_matches(declared, generic_rules(generic_dim)).select(
        F.col("declared_name").alias("_name"), F.col("generic").alias("_generic"))
    return (declared.join(found, F.col("declared_name") == F.col("_name"), "left")
            .withColumn("generic_name_affected", F.col("_generic").isNotNull())
            .withColumn("declared_name", F.coalesce(F.upper("_generic"), F.col("declared_name")))
            .drop("_name", "_generic"))


def compound(declared: DataFrame, compound_dim: DataFrame) -> DataFrame:
    """``naming.compound`` for a dictionary of any size; a key's sub-ingredients are one array, as they are on the label."""
    subs = (compound_dim.where(title_form(F.col("key"))).groupBy(F.lower("key").alias("_key"))
            .agg(F.array_sort(F.collect_list(F.struct("pos", "sub_name"))).alias("_s"))
            .select("_key", F.transform("_s", lambda s: F.upper(s["sub_name"])).alias("_subs")))
    hit = F.col("_subs").isNotNull()
    return (declared.join(subs, F.lower("declared_name") == F.col("_key"), "left")
            .withColumn("compound_affected", hit)
            .withColumn("is_compound", F.col("is_compound") | hit)
            .withColumn("sub_ingredients", F.when(hit, F.col("_subs")).otherwise(F.col("sub_ingredients")))
            .withColumn("declared_name", F.when(hit, F.concat("declared_name", F.lit(" ("), F.array_join("_subs", ", "), F.lit(")")))
                        .otherwise(F.col("declared_name")))
            .drop("_key", "_subs"))


# J12 -------------------------------------------------------------------------------------------
EDGE = r"(?<=[a-z0-9])(?=[^a-z0-9])|(?<=[^a-z0-9])(?=[a-z0-9])"


def _runs(text: Column) -> Column:
    """Lower-cased text as alternating runs of [a-z0-9] and of all else."""
    return F.filter(F.split(F.lower(text), EDGE), lambda r: r != "")


def keyword_labels(texts: DataFrame, key: str, text: str, keyword_dim: DataFrame) -> DataFrame:
    """(key, labels): the sorted distinct labels whose keyword stands in the text as whole words, a plural s allowed.

    A keyword is in lower case and begins and ends with a letter or digit of ASCII; others match nothing. Texts without a
    hit have no row. A text of n words gives out at most n strings for each number of words that occurs in a keyword.
    """
    rules = (keyword_dim.where(F.col("keyword").rlike(r"^[a-z0-9](.*[a-z0-9])?$"))
             .select(F.col("keyword").alias("_kw"), "label").distinct())
    sizes = sorted(r["n"] for r in rules.select(F.size(_runs(F.col("_kw"))).alias("n")).distinct().collect())
    runs = F.col("_runs")
    starts = F.filter(F.transform(runs, lambda r, i: F.when(r.rlike("^[a-z0-9]"), i)), lambda i: i.isNotNull())

    def grams_of(n: int) -> Column:
        fitting = F.filter(starts, lambda i: i + n <= F.size(runs))
        return F.transform(fitting, lambda i: F.array_join(F.slice(runs, i + 1, F.lit(n)), ""))
    grams = F.flatten(F.array(*[grams_of(n) for n in sizes])) if sizes else F.array().cast("array<string>")
    both = F.concat(F.col("_g"), F.transform(F.filter("_g", lambda g: g.endswith("s")), lambda g: g.substr(F.lit(1), F.length(g) - 1)))
    asked = (texts.select(key, _runs(F.col(text)).alias("_runs")).select(key, F.array_distinct(grams).alias("_g"))
             .select(key, F.explode(F.array_distinct(both)).alias("_kw")))
    return asked.join(rules, "_kw").groupBy(key).agg(F.array_sort(F.collect_set("label")).alias("labels"))
