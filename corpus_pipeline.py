"""Training-data pipeline over ``documents``: quality, near duplicates, secrets, mixing, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; each is written as Parquet and read again as the
next one's input. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelcorpus.llm.common import read, stored, tokenizer_path
from labelcorpus.llm.jaccard import HOT_BITS, bit_of, bitset, jaccard_components
from labelcorpus.llm.mixing import mix_sources
from labelcorpus.llm.packing import best_fit_packing, pieces
from labelcorpus.llm.quality import quality_rules
from labelcorpus.llm.secrets import secret_scan


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines are removed; rejected documents go."""
    # the row number keeps Spark from pushing the filter down into the word expressions, which would repeat them
    judged = quality_rules(docs).withColumn("_row", F.monotonically_increasing_id()).filter("kept and _row >= 0")
    text = F.when(F.col("n_failed_lines") > 0, F.col("clean_text")).otherwise(F.col("text"))
    return judged.withColumns({"text": text, "n_chars": F.length(text).cast("bigint")}).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest doc_id.

    Rows are told apart by doc_id and text. Of several rows that share the smallest doc_id in one group, the one with
    the smallest text hash stays, and repeated rows stay once. Without any doc_id in a group its rows stay.
    """
    rows = stored(jaccard_components(docs, row_hash=True), "components")
    lead = rows.filter("component_id = doc_id and n_shingles > 0").groupBy("doc_id").agg(F.min("h").alias("h"))
    keys = rows.groupBy("doc_id", "h").agg(F.count("*").alias("copies"), F.first("component_id").alias("c"),
                                           F.min("n_shingles").alias("n"))
    lead = lead.withColumn("lead", F.lit(True))
    # only these keys are joined with the texts: rows that go, and rows that stay once
    odd = keys.join(lead, ["doc_id", "h"], "left").filter("c is not null and n > 0").filter("lead is null or copies > 1")
    odd = stored(odd.select(F.col("doc_id").alias("_d"), F.col("h").alias("_h"), F.col("lead").alias("_lead"),
                            F.xxhash64("doc_id", "h").alias("_k")), "copies")
    # a bitset of fixed size tells which rows cannot be among those keys: their texts are not shuffled
    bits = spark.sparkContext.broadcast(bitset(odd.select(F.shiftrightunsigned("_k", 64 - HOT_BITS).alias("i")), HOT_BITS))

    @F.pandas_udf("boolean")
    def may_be_odd(k: pd.Series) -> pd.Series:
        return pd.Series(bit_of(bits.value, HOT_BITS, k.to_numpy(np.int64).view(np.uint64)))
    told = docs.withColumn("_t", F.xxhash64("text")).withColumn("_odd", may_be_odd(F.xxhash64("doc_id", "_t")))
    clear, few = told.filter("not _odd"), told.filter("_odd")
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_t") == F.col("_h"))
    single = clear.select(*docs.columns).unionByName(few.join(odd, same, "left_anti").select(*docs.columns))
    repeated = few.join(odd.filter("_lead"), same, "left_semi").dropDuplicates(["doc_id", "text"])
    return single.unionByName(repeated.select(*docs.columns))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in place; every document stays."""
    found = secret_scan(docs)
    text = F.when(F.col("n_secrets") > 0, F.col("safe_text")).otherwise(F.col("text"))
    return found.withColumns({"text": text, "n_chars": F.length(text).cast("bigint")}).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document appears as often as the mix takes it: not at all, once or twice."""
    mixed = mix_sources(docs).filter("copies > 0")
    repeated = mixed.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return repeated.select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequence and place."""
    return best_fit_packing(pieces(docs, tokenizer_path(), capacity=2048), capacity=2048)


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("secret scans", secrets),
    ("mixing sources to target weights", mixing),
    ("best-fit packing", packing),
]

#: SQL cannot express the byte-level tokens, the ranks by hash and the packing; the tests use brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
