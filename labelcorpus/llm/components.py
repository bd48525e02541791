"""Connected components of an edge table, by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame) -> DataFrame:
    """(cls, comp) for every vertex of the edges (a, b); comp is the smallest vertex reached.

    Each round takes the least label among a vertex, its neighbours and its label's label, and is written as a
    table; it stops when no label changes. A vertex with very many edges is summed map-side.
    """
    both = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
                  .distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("cls")).agg(F.least(F.min("b"), F.col("a")).alias("comp"))
                    .select("cls", "comp"), "labels")
    while True:
        near = both.join(labels.select(F.col("cls").alias("b"), F.col("comp").alias("l")), "b") \
            .groupBy(F.col("a").alias("cls")).agg(F.min("l").alias("near"))
        up = labels.select(F.col("cls").alias("comp"), F.col("comp").alias("jump"))
        new = labels.join(near, "cls").join(up, "comp", "left").select(
            "cls", F.least("comp", "near", F.coalesce("jump", "comp")).alias("new"), "comp")
        new = stored(new, "labels")
        moved = new.filter("new <> comp").limit(1).count()
        labels = new.select("cls", F.col("new").alias("comp"))
        if not moved:
            return labels
