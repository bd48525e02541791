"""Row numbers and ordered lists within groups of any size.

A window over a group puts the whole group into one task. Here rows are cut by ranges of (group, order), so that a group
of a third of all rows lies in a third of the ranges; each range is numbered on its own and starts after the counts of
the group's earlier ranges. Lists are built from sorted runs, so no task sorts a whole group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RUN = 10_000
RANGE_ROWS = 500_000


def _cut(df: DataFrame, keys: list[str], order: list[Column], ranges: int | None, how: str) -> DataFrame:
    """``df`` with ``_range``: ranges of (keys, order), written because a row must lie in the same range at every reading.

    The rows are written before, too: they are read three times (count, borders, cut). Ranges hold about ``RANGE_ROWS`` rows
    however many rows there are, and so do the partitions of the result, each range lying in one of them.
    """
    from labelcorpus.session import materialize
    held = materialize(df, how)
    if not ranges:
        ranges = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-held.count() // RANGE_ROWS))
    cut = held.repartitionByRange(ranges, *[F.col(k) for k in keys], *order).withColumn("_range", F.spark_partition_id())
    return materialize(cut, how).repartition(ranges, *keys, "_range")


def _join_earlier(cut: DataFrame, keys: list[str], per_range: Column, over_earlier: Column) -> DataFrame:
    """``cut`` with ``_before``: ``over_earlier`` (an aggregate of ``_n``) over the group's earlier ranges, ``_n`` being
    ``per_range`` of each. At most one row per group and range, so its window is as short as there are ranges. A range begins
    inside one group at most, so no more rows than ranges have earlier ones: only these are broadcast, and the rest is null."""
    counts = cut.groupBy(*keys, "_range").agg(per_range.alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*[F.col(k).alias(f"_{i}") for i, k in enumerate(keys)], F.col("_range").alias("_of"),
                           over_earlier.over(earlier).alias("_before")).where(F.col("_before").isNotNull())
    same = F.col("_range") == F.col("_of")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_{i}"))
    return cut.join(F.broadcast(starts), same, "left").drop("_of", *[f"_{i}" for i in range(len(keys))])


def row_numbers(df: DataFrame, keys: list[str], order: list[Column], out: str, ranges: int | None = None,
                how: str = "table") -> DataFrame:
    """``row_number()`` over (keys, order) as ``out`` (bigint); null keys are a group like any other.

    One range shuffle, written (``session.materialize``) because a range's number must not change between its two
    readings, and one shuffle by (keys, range). Rows that tie in the whole order share a range, so the order should
    tell rows of a large group apart. ``ranges`` defaults to the session's shuffle partitions, or one for ``RANGE_ROWS`` rows if that is more.
    """
    cut = _join_earlier(_cut(df, keys, order, ranges, how), keys, F.count(F.lit(1)), F.sum("_n"))
    within = Window.partitionBy(*keys, "_range").orderBy(*order)
    return (cut.withColumn(out, F.row_number().over(within).cast("bigint") + F.coalesce("_before", F.lit(0)))
            .drop("_range", "_before"))


def earlier_min(df: DataFrame, keys: list[str], order: list[Column], value: str, out: str, ranges: int | None = None,
                how: str = "table") -> DataFrame:
    """Least ``value`` among a group's earlier rows as ``out`` (null at its first row), for groups of any size; see ``row_numbers``."""
    cut = _join_earlier(_cut(df, keys, order, ranges, how), keys, F.min(value), F.min("_n"))
    within = Window.partitionBy(*keys, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return cut.withColumn(out, F.least("_before", F.min(value).over(within))).drop("_range", "_before")


def run_of(position: Column | str, run: int = RUN) -> Column:
    """The run that a 1-based position lies in."""
    position = F.col(position) if isinstance(position, str) else position
    return F.floor((position - 1) / run)


def joined_runs(run: Column | str, part: Column | str) -> Column:
    """Aggregate over a group's runs: their lists one after the other (one entry per run is collected, not one per row)."""
    run, part = (F.col(c) if isinstance(c, str) else c for c in (run, part))
    return F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(run.alias("r"), part.alias("p")))), lambda s: s["p"]))
