"""Mixing sources to target weights by Pareto order sampling, as DataFrame operations only.

Targets. Sources in code point order (null last) get weights from a repeating list and share
``total_pct`` percent of all words; a source stops at ``max_copies`` times its own words and the
excess goes to the others by weight. With the sources sorted by ratio of limit to weight, the common
level is found in closed form from prefix sums (one row per source).

Sampling. A source whose target is ``m`` times its words takes ``floor(m)`` whole copies of every
document and a Pareto sample for the rest. A document's expected copies are ``m`` (times its
``weight``, relative to its source's mean, if a weight column is named), at most ``max_copies``;
the whole part is certain, the fraction ``p`` is its inclusion probability. Documents are ranked
by random odds over inclusion odds, ``(u / (1 - u)) / (p / (1 - p))``, and taken in that order
while the source's target holds them; one more, of those next in order, closes the gap as well as a
whole document can. So the sample's size is fixed in words. ``u`` is a hash of seed and row key, so
reruns agree.

Scale. No window or group holds a source's documents. Ranks are cut into bins of about ``bin_docs``
documents, bins are summed with map-side aggregation, a running sum over the bins finds the bin
in which the target is met, and only that bin's documents are put in order.

Defined cases: null text has size 0; null source is a source of its own, last in order; documents
of size 0 are never taken; equal ranks are ordered by the row key, and wholly equal rows are
interchangeable. Extra columns pass through; an input column with the name of an output column is
replaced. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, word_count

OUTPUTS = ("size", "source_size", "target", "copies", "taken")


def source_targets(sizes: DataFrame, weights: Sequence[int], total_pct: float, max_copies: int) -> DataFrame:
    """One row per source: source, source_size, n_docs, target.

    The windows here run over one row per source, after the documents were summed map-side.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    per = per.withColumn("_w", w).withColumn("_cap", F.col("source_size") * float(max_copies))
    by_ratio = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").isNull(), F.col("source"))
    everything = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onwards = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    per = per.withColumn("_level", (F.sum("source_size").over(everything) * (total_pct / 100.0)
                                    - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
                         / F.sum("_w").over(onwards))
    # the first source whose limit is not met at its own level sets the level of all later ones
    fits = F.col("_level") * F.col("_w") <= F.col("_cap")
    level = F.first(F.when(fits, F.col("_level")), ignorenulls=True).over(everything)
    return per.withColumn("target", F.least(F.col("_cap"), F.coalesce(level, F.lit(float("inf"))) * F.col("_w"))) \
        .select("source", "source_size", "n_docs", "target")


def unit(seed: int, *key: Column) -> Column:
    """A number strictly between 0 and 1 from a hash of the seed and the key."""
    h = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *key), 12)
    return (h + F.lit(0.5)) / F.lit(float(2**52))


def size_facts(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
               weight: str | None = None, keep: bool = False) -> DataFrame:
    """The few values per document that targets and ranks need (``keep``: and the row as _row)."""
    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")] if keep else []
    return docs.select(*row, F.col(key).alias("_key"), F.col(source).alias("source"),
                       word_count(F.col(text)).alias("size"), F.xxhash64(F.col(text)).alias("_h"),
                       (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("_weight"))


def _ranked(d: DataFrame, max_copies: int, seed: int) -> DataFrame:
    """Certain copies and Pareto rank, from columns _key, _h, _weight, size and the source's row."""
    ratio = F.try_divide("target", "source_size") * F.coalesce(F.try_divide("_weight", "_mean"), F.lit(0.0))
    d = d.withColumn("_want", F.when(F.col("size") > 0, F.least(F.lit(float(max_copies)), ratio)).otherwise(0.0))
    d = d.withColumn("_sure", F.floor("_want").cast("bigint"))
    p, u = F.col("_want") - F.col("_sure"), unit(seed, F.col("_key"), F.col("_h"))
    odds = (u / (1 - u)) / (p / (1 - p))
    # rank = odds / (1 + odds): the same order, within (0, 1); null: nothing left to draw
    return d.withColumn("_rank", F.when(p > 0, odds / (1 + odds)))


def source_cuts(facts: DataFrame, weights: Sequence[int], total_pct: float, max_copies: int,
                seed: int, bin_docs: int) -> DataFrame:
    """One row per source: its target, the last (rank, key, hash) drawn in order, and the closing one."""
    per = source_targets(facts, weights, total_pct, max_copies)
    mean = facts.groupBy(F.col("source").alias("_s")).agg(
        F.try_divide(F.sum(F.col("_weight") * F.col("size")), F.sum("size")).alias("_mean"))
    per = stored(per.join(mean, F.col("source").eqNullSafe(F.col("_s"))).drop("_s"), "mix-sources")
    d = _ranked(with_source(facts, per), max_copies, seed)
    d = d.withColumn("_bin", F.floor(F.col("_rank") * F.ceil(F.col("n_docs") / bin_docs)).cast("bigint"))
    drawn = F.when(F.col("_rank").isNotNull(), F.col("size")).otherwise(0)
    bins = d.groupBy("source", "_bin").agg(F.sum(F.col("_sure") * F.col("size")).alias("_sure_words"),
                                           F.sum(drawn).alias("_words"), F.max("target").alias("target"))
    whole = Window.partitionBy("source")
    before = whole.orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.withColumn("_rest", F.col("target") - F.sum("_sure_words").over(whole)) \
        .withColumn("_before", F.coalesce(F.sum("_words").over(before), F.lit(0)))
    # the bin in which the target is met: one per source, or none if all can be drawn
    edge = bins.filter((F.col("_before") < F.col("_rest")) & (F.col("_before") + F.col("_words") >= F.col("_rest"))) \
        .select(F.col("source").alias("_s"), F.col("_bin").alias("_b"), "_rest", "_before")
    docs = d.filter("_rank is not null").join(
        edge, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_bin") == F.col("_b")))
    mine = Window.partitionBy("source")
    upto = mine.orderBy("_rank", "_key", "_h").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    docs = docs.withColumn("_sum", F.col("_before") + F.sum("size").over(upto))
    fits = F.col("_sum") <= F.col("_rest")
    gap = F.col("_rest") - F.coalesce(F.max(F.when(fits, F.col("_sum"))).over(mine), F.col("_before"))
    docs = docs.withColumn("_gap", gap).withColumn("_off", F.abs(F.col("_gap") - F.col("size")))
    # drawn in order while they fit; then the one document of this bin that closes the gap best
    last = F.when(~fits & (F.col("_off") < F.col("_gap")), F.struct("_off", "_rank", "_key", "_h"))
    cut = docs.groupBy(F.col("source").alias("_s")).agg(
        F.max(F.when(fits, F.struct("_rank", "_key", "_h"))).alias("_cut"),
        F.min(last).alias("_last"), F.max("_b").alias("_cut_bin"))
    return per.join(cut, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")


def with_source(d: DataFrame, per: DataFrame) -> DataFrame:
    """Join rows with their source's row (Spark picks the join by the size of the source table)."""
    p = per.withColumnRenamed("source", "_s")
    return d.join(p, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")


def apply_cuts(d: DataFrame, cuts: DataFrame, max_copies: int, seed: int, bin_docs: int) -> DataFrame:
    """Add source_size, target, copies and taken to rows that have the columns of ``size_facts``."""
    d = _ranked(with_source(d, cuts), max_copies, seed)
    bin_ = F.floor(F.col("_rank") * F.ceil(F.col("n_docs") / bin_docs))
    drawn = F.when(F.col("_cut_bin").isNull(), F.col("_rank").isNotNull()) \
        .otherwise((bin_ < F.col("_cut_bin")) | ((bin_ == F.col("_cut_bin"))
                                                 & (F.coalesce(F.struct("_rank", "_key", "_h") <= F.col("_cut"), F.lit(False))
                                                    | F.coalesce(F.struct("_rank", "_key", "_h") == F.struct(
                                                        "_last._rank", "_last._key", "_last._h"), F.lit(False)))))
    d = d.withColumn("copies", F.col("_sure") + F.coalesce(drawn, F.lit(False)).cast("bigint"))
    return d.withColumn("taken", F.col("copies") * F.col("size")).drop(
        "_mean", "n_docs", "_cut", "_last", "_cut_bin", "_want", "_sure", "_rank")


def mix_sources(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), total_pct: float = 150.0,
                max_copies: int = 2, key: str = "doc_id", text: str = "text", source: str = "source",
                weight: str | None = None, seed: int = 42, bin_docs: int = 1000) -> DataFrame:
    """Every row with size, its source's size and target, and how many copies and words are taken.

    The texts are never shuffled for the ranking: targets and cuts come from small facts, and
    the rows meet one row per source.
    """
    d = docs.select(*[c for c in docs.columns if c not in OUTPUTS])
    facts = stored(size_facts(d, key, text, source, weight), "mix-sizes")
    cuts = stored(source_cuts(facts, weights, total_pct, max_copies, seed, bin_docs), "mix-cuts")
    rows = size_facts(d, key, text, source, weight, keep=True)
    out = apply_cuts(rows, cuts, max_copies, seed, bin_docs)
    return out.select("_row.*", *OUTPUTS)


def mix_sizes(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), total_pct: float = 150.0,
              max_copies: int = 2, seed: int = 42, bin_docs: int = 1000) -> DataFrame:
    """The mix's digest without texts: doc_id, size, source_size, target, copies, taken."""
    facts = stored(size_facts(docs), "mix-sizes")
    cuts = stored(source_cuts(facts, weights, total_pct, max_copies, seed, bin_docs), "mix-cuts")
    return apply_cuts(facts, cuts, max_copies, seed, bin_docs).select(F.col("_key").alias("doc_id"), *OUTPUTS)
