"""Per-row label operators on a stream.

The reference generates in one batch and has no streaming state, windows or late data. The
per-row steps (label-safe names, allergen tags, ingredient classes, prohibited-term flags)
are projections over literal expressions, so they run unchanged on a streaming DataFrame;
this module wires them to ``readStream`` / ``writeStream`` for incremental ingredient feeds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from labelcorpus.functions.columns import label_safe_name
from labelcorpus.operators import tags


def tag_ingredients(ingredients: DataFrame, keyword_dim: DataFrame, exclusion_dim: DataFrame,
                    category_dim: DataFrame) -> DataFrame:
    """Stateless per-row tagging; works on batch and streaming DataFrames alike."""
    d = F.col("description")
    return ingredients.select(
        "*",
        label_safe_name(d).alias("label_name"),
        tags.allergen_column(d, keyword_dim, exclusion_dim).alias("allergens"),
        tags.first_match_class(d, category_dim).alias("ingredient_class"))


def start_tagging(spark: SparkSession, source_dir: str, schema: str, sink_dir: str,
                  checkpoint_dir: str, keyword_dim: DataFrame, exclusion_dim: DataFrame,
                  category_dim: DataFrame, trigger_seconds: int | None = 60) -> StreamingQuery:
    """Tag new ingredient files as they land (Parquet in, Parquet out, exactly-once sink).

    ``checkpoint_dir`` must be on shared storage on a cluster.
    """
    stream = spark.readStream.schema(schema).parquet(source_dir)
    tagged = tag_ingredients(stream, keyword_dim, exclusion_dim, category_dim)
    w = (tagged.writeStream.format("parquet").option("path", sink_dir)
         .option("checkpointLocation", checkpoint_dir))
    # ``trigger_seconds=None`` processes what is there now and stops (batch-like backfill).
    w = w.trigger(availableNow=True) if trigger_seconds is None else \
        w.trigger(processingTime=f"{trigger_seconds} seconds")
    return w.start()
