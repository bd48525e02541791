"""Per-row tagging on a file stream gives the same rows as the batch operators."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL


def test_stream_tagging_matches_batch(spark):
    from labelcorpus.knowledge import dims as D
    from labelcorpus.sources import testdata as T
    from labelcorpus.streaming.labels import start_tagging, tag_ingredients
    root = tempfile.mkdtemp(prefix="lc-stream-")
    src, sink, ckpt = (os.path.join(root, x) for x in ("src", "sink", "ckpt"))
    ing = T.ingredients(spark, SF_SMALL).select("food_id", "pos", "pos2", "description")
    ing.write.parquet(src)
    kw, ex, cat = D.allergen_keywords(spark), D.allergen_exclusions(spark), \
        D.ingredient_categories(spark)
    q = start_tagging(spark, src, ing.schema.simpleString().replace("struct<", "").rstrip(">")
                      .replace(":", " "), sink, ckpt, kw, ex, cat, trigger_seconds=None)
    q.awaitTermination(120)
    streamed = spark.read.parquet(sink)
    batch = tag_ingredients(spark.read.parquet(src), kw, ex, cat)
    cols = ["food_id", "pos", "pos2", "label_name", "ingredient_class"]
    assert streamed.count() == batch.count() > 0
    assert streamed.select(*cols).exceptAll(batch.select(*cols)).count() == 0
    assert streamed.where(F.col("label_name") != F.upper("description")).count() == 0
