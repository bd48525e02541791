"""Line-first quality rules, as column expressions only (no Python on the data path).

Each line is judged by its own punctuation, navigation and boilerplate rules; failing lines are
removed; a document that loses too large a share of its words with them is rejected. Document
counts (words, symbols, repeated lines, words in repeated three-word windows) are computed on the
whole original text in the same projection: no shuffle, one pass, any text length.

Defined cases: null or empty text has no words, all counts 0, ``base_failed`` true, ``kept`` false,
and a cleaned text that is null or empty like the input. Null in another column passes through.
Repeated rows are judged one by one. Extra columns pass through; an input column with the name of an output
column is replaced. An empty table gives an empty result with the same schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CLASS, WORD_RE, words_of

#: Characters counted as symbols, and lines that are boilerplate wherever they stand.
SYMBOLS = "#*$%&|<>"
BOILERPLATE = (
    "licensed under the",
    "is licensed under",
    "all rights reserved",
    "spdx-license-identifier",
    "copyright (c)",
    "terms of service",
    "terms of use",
    "privacy policy",
    "cookie policy",
    "accept cookies",
    "subscribe to our newsletter",
    "enable javascript",
    "lorem ipsum",
)
OUTPUTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
           "n_failed_lines", "n_failed_words", "base_failed", "kept", "clean_text")


def _count(text: Column, unwanted: str) -> Column:
    """Characters left when the regex class ``unwanted`` is removed."""
    return F.length(F.regexp_replace(text, unwanted, ""))


def line_facts(line: Column) -> Column:
    """What the rules look at, as a struct, so that each fact is computed once per line."""
    return F.struct(
        line.alias("line"),
        F.regexp_count(line, F.lit(WORD_RE)).alias("n"),
        _count(line, f"[^{SYMBOLS}]+").alias("symbols"),
        F.regexp_count(line, F.lit("[!?]{2,}")).alias("shouts"),
        F.regexp_count(line, F.lit(f"(?<![^{SPACE_CLASS}])[|»·>](?![^{SPACE_CLASS}])")).alias("bars"),
        F.regexp_count(line, F.lit(r"\p{Lu}{2,}")).alias("caps"),
        F.lower(line).alias("low"))


def line_fails(f: Column, max_symbols_pct: int = 30, max_shouts_pct: int = 30,
               max_bars_pct: int = 30, max_caps_pct: int = 60) -> Column:
    """True if a rule removes the line with the facts ``f``.

    Punctuation: symbols over ``max_symbols_pct`` of the line's words, or doubled marks (``!!``,
    ``??``) over ``max_shouts_pct``. Navigation: stand-alone separators over ``max_bars_pct``.
    Capitals: runs of capitals over ``max_caps_pct``, from five words on. Boilerplate: a known
    phrase. One- and two-word lines are judged by boilerplate only, so short headings stay.
    """
    n, phrase = f["n"], F.lit(False)
    for p in BOILERPLATE:
        phrase = phrase | F.contains(f["low"], F.lit(p))
    noisy = (n > 2) & ((f["symbols"] * 100 > n * max_symbols_pct) | (f["shouts"] * 100 > n * max_shouts_pct)
                       | (f["bars"] * 100 > n * max_bars_pct))
    return noisy | ((n > 4) & (f["caps"] * 100 > n * max_caps_pct)) | ((n > 0) & phrase)


def quality_rules(docs: DataFrame, text: str = "text", min_words: int = 50,
                  max_repeat_pct: int = 50, max_lost_pct: int = 30) -> DataFrame:
    """Add counts, verdicts and the cleaned text (see the module docstring) to every row.

    Write the result before filtering on its columns: Spark would push such a filter down into the word
    expressions and evaluate them again for each use.
    """
    d = docs.select(*[c for c in docs.columns if c not in OUTPUTS])
    t = F.coalesce(F.col(text), F.lit(""))
    d = d.withColumns({"_words": words_of(F.col(text)),
                       "_facts": F.transform(F.split(t, "\n"), line_facts)})
    d = d.withColumn("_judged", F.transform("_facts", lambda f: F.struct(
        f["line"].alias("line"), f["n"].alias("n"), f["symbols"].alias("symbols"),
        line_fails(f).alias("bad"))))
    w = F.col("_words")
    d = d.withColumns({
        "_lines": F.transform(F.filter("_judged", lambda x: x["n"] > 0), lambda x: x["line"]),
        "_bad": F.filter("_judged", lambda x: x["bad"]),
        "n_words": F.size(w).cast("bigint"),
        "word_chars": F.aggregate(w, F.lit(0).cast("bigint"), lambda a, x: a + F.length(x)),
        "n_symbols": F.aggregate("_judged", F.lit(0).cast("bigint"), lambda a, x: a + x["symbols"]),
        # windows as (hash, position), sorted: equal windows become neighbours. A 64-bit hash
        # stands for the window inside one text only.
        "_windows": F.sort_array(F.when(F.size(w) >= 3, F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"),
                               i.alias("p")))).otherwise(
            F.array().cast("array<struct<h:bigint,p:int>>"))),
    })
    s = F.col("_windows")
    d = d.withColumn("_pos", F.sort_array(F.transform(
        F.filter(s, lambda x, k: F.coalesce(x["h"] == F.get(s, k + 1)["h"], F.lit(False))
                 | F.coalesce((k > 0) & (x["h"] == F.get(s, F.greatest(k - 1, F.lit(0)))["h"]), F.lit(False))),
        lambda x: x["p"])))
    p = F.col("_pos")
    d = d.withColumns({
        "n_lines": F.size("_lines").cast("bigint"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
        # words covered by the repeated windows: each window adds up to the next one's start
        "n_repeat_words": F.aggregate(
            F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1), x + 3) - x)),
            F.lit(0).cast("bigint"), lambda a, x: a + x),
        "n_failed_lines": F.size("_bad").cast("bigint"),
        "n_failed_words": F.aggregate("_bad", F.lit(0).cast("bigint"), lambda a, x: a + x["n"]),
        "clean_text": F.when(F.size("_bad") == 0, F.col(text)).otherwise(F.array_join(
            F.transform(F.filter("_judged", lambda x: ~x["bad"]), lambda x: x["line"]), "\n")),
    })
    d = d.withColumn("base_failed", (F.col("n_words") < min_words)
                     | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeat_pct))
    d = d.withColumn("kept", ~F.col("base_failed")
                     & (F.col("n_failed_words") * 100 <= F.col("n_words") * max_lost_pct))
    return d.drop("_words", "_facts", "_lines", "_judged", "_bad", "_windows", "_pos")
