"""Survey food source (S1-S5): nested food JSON -> foods, ingredients, nutrients tables.

A multi-line JSON document is one task for Spark's reader; ``survey_scan`` cuts it into byte ranges. ``land_survey``
writes it once as Parquet (repartitioned by food id); every later job reads the Parquet copy in parallel.
JSON Lines (one food object per line) and Parquet inputs are read directly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUTRIENT = T.StructType([
    T.StructField("nutrient", T.StructType([
        T.StructField("id", T.IntegerType()), T.StructField("number", T.StringType()),
        T.StructField("name", T.StringType()), T.StructField("unitName", T.StringType())])),
    T.StructField("amount", T.DoubleType())])
INPUT_FOOD = T.StructType([
    T.StructField("ingredientCode", T.LongType()),
    T.StructField("ingredientDescription", T.StringType()),
    T.StructField("ingredientWeight", T.DoubleType()),
    T.StructField("sequenceNumber", T.IntegerType()),
    T.StructField("retentionCode", T.IntegerType())])
PORTION = T.StructType([
    T.StructField("gramWeight", T.DoubleType()), T.StructField("modifier", T.StringType()),
    T.StructField("amount", T.StringType())])
FOOD = T.StructType([
    T.StructField("fdcId", T.LongType()), T.StructField("foodCode", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("foodNutrients", T.ArrayType(NUTRIENT)),
    T.StructField("inputFoods", T.ArrayType(INPUT_FOOD)),
    T.StructField("foodPortions", T.ArrayType(PORTION))])
DOCUMENT = T.StructType([T.StructField("SurveyFoods", T.ArrayType(FOOD))])


def read_survey(spark: SparkSession, path: str, fmt: str = "document") -> DataFrame:
    """Raw food rows. ``fmt``: 'document' (one object with SurveyFoods), 'split' (the same, read by many tasks), 'jsonl', 'parquet'."""
    if fmt == "split":
        from labelcorpus.sources.survey_scan import read_split
        return read_split(spark, path, "SurveyFoods", FOOD)
    if fmt == "document":
        doc = spark.read.schema(DOCUMENT).option("multiLine", True).json(path)
        return doc.select(F.explode("SurveyFoods").alias("f")).select("f.*")
    if fmt == "jsonl":
        return spark.read.schema(FOOD).json(path)
    if fmt == "parquet":
        return spark.read.parquet(path)
    raise ValueError(f"unknown survey format {fmt!r}")


def land_survey(spark: SparkSession, path: str, out_path: str, partitions: int = 0) -> DataFrame:
    """Read a survey document once and store it as Parquet partitioned across tasks."""
    raw = read_survey(spark, path, "split")
    raw = raw.repartition(partitions, "fdcId") if partitions else raw.repartition("fdcId")
    raw.write.mode("overwrite").parquet(out_path)
    return spark.read.parquet(out_path)


# S2 / X16 ----------------------------------------------------------------------------------
def foods(raw: DataFrame) -> DataFrame:
    """One row per food with the first portion as serving (default 100 g, at least 1 g)."""
    first = F.get(F.col("foodPortions"), 0)
    has = first.isNotNull()
    gram = F.when(has, F.coalesce(first["gramWeight"], F.lit(100.0))).otherwise(F.lit(100.0))
    label = F.when(has, F.coalesce(first["modifier"], F.lit(""))).otherwise(F.lit(""))
    amount = first["amount"]
    # an amount that reads as zero, however it is written, gives no household serving
    household = F.when(has & (amount != "") & (F.coalesce(F.expr(
        "try_cast(get(foodPortions, 0).amount AS double)"), F.lit(1.0)) != 0),
                       F.trim(F.concat_ws(" ", amount, label)))
    return raw.select(
        F.col("fdcId").alias("food_id"),
        F.coalesce(F.col("foodCode"), F.lit("")).alias("food_code"),
        F.coalesce(F.col("description"), F.lit("")).alias("food_name"),
        F.greatest(gram, F.lit(1.0)).alias("serving_size_g"),
        label.alias("serving_size_label"),
        F.when(household != "", household).alias("household_serving"),
    )


# S3 / P2 -----------------------------------------------------------------------------------
def ingredients(raw: DataFrame, fortificant_codes: list[str]) -> DataFrame:
    """Raw ingredient rows; a missing code is 0; (pos, pos2) keep the input order."""
    ex = raw.select(F.col("fdcId").alias("food_id"),
                    F.posexplode("inputFoods").alias("pos", "i"))
    code = F.coalesce(F.col("i.ingredientCode"), F.lit(0))
    return ex.select(
        "food_id",
        F.coalesce(F.col("i.sequenceNumber"), F.lit(0)).alias("sequence_number"),
        F.col("pos").cast("long").alias("pos"),
        F.lit(0).cast("long").alias("pos2"),
        code.alias("code"),
        F.coalesce(F.col("i.ingredientDescription"), F.lit("")).alias("description"),
        F.coalesce(F.col("i.ingredientWeight"), F.lit(0.0)).alias("weight_g"),
        F.coalesce(F.col("i.retentionCode"), F.lit(0)).alias("retention_code"),
        code.cast("string").isin(*fortificant_codes).alias("is_fortificant"),
    )


# S4 ----------------------------------------------------------------------------------------
def nutrients(raw: DataFrame) -> DataFrame:
    ex = raw.select(F.col("fdcId").alias("food_id"),
                    F.posexplode("foodNutrients").alias("pos", "n"))
    return ex.select(
        "food_id", "pos",
        F.col("n.nutrient.id").alias("nutrient_id"),
        F.col("n.nutrient.name").alias("name"),
        F.col("n.amount").alias("amount"),
        F.col("n.nutrient.unitName").alias("unit"),
    )


# S5 ----------------------------------------------------------------------------------------
def foods_by_ids(foods_df: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(found foods, unknown ids): unknown ids are returned, not raised."""
    return (foods_df.join(ids, "food_id", "left_semi"),
            ids.join(foods_df.select("food_id"), "food_id", "left_anti"))
