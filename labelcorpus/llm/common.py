"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelcorpus.session import ensure_checkpoint_dir

#: The white space that separates words, as characters and as a regex class body.
SPACES = " \t\n\x0b\f\r"
SPACE_CLASS = r"\x20\x09-\x0D"
SPLIT_RE = f"[{SPACE_CLASS}]+"
WORD_RE = f"[^{SPACE_CLASS}]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, name: str = "llm") -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    The lineage is cut at a file that every executor sees; a lost executor costs a re-read.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words_of(text: Column) -> Column:
    """The text's words (maximal runs without white space) as an array; null text has none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPLIT_RE))


def word_count(text: Column) -> Column:
    """Number of words in the text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RE)), F.lit(0)).cast("bigint")


def under_hash(key: Column, total: int, want: int) -> Column:
    """True for about ``1.5 * want`` of ``total`` rows by a uniform 64-bit hash: all, if there are fewer.

    Taken before a bounded sort, so that what reaches its last task does not grow with the number of tasks.
    """
    share = min(1.0, 1.5 * want / max(1, total))
    return key <= F.lit(min(2**63 - 1, int(-2**63 + share * 2**64)))


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """The installed vocabulary file of that name; every executor has the package."""
    import public_tokenizers
    return str(public_tokenizers.path(name))
