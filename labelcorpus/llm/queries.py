"""Registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe
from .common import read, tokenizer_path, words_of
from .conversations import digests, repair
from .html_text import extract
from .jaccard import jaccard_components
from .knn import top_k
from .language import fit, held_out, predict
from .mixing import mix_sizes
from .packing import best_fit_packing, pieces
from .periodic import periodic_runs
from .pii import pseudonymise
from .quality import quality_rules
from .secrets import secret_spans
from .urls import url_filter


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules(d).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                   "n_repeat_words", "base_failed", "kept", "n_failed_lines", "n_failed_words")


#: A real run passes its own secret; equal keys give equal pseudonyms.
PSEUDONYM_KEY = "demonstration key"


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages"))


def op8_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = pseudonymise(read(spark, sf_dir, "documents").select("doc_id", "text"), PSEUDONYM_KEY)
    return d.drop("text").withColumnRenamed("safe_text", "text")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(pieces(read(spark, sf_dir, "documents"), tokenizer_path(), capacity=2048), capacity=2048)


def op3_voronoi_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read(spark, sf_dir, "embeddings"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents")
    model = fit(d.filter(~held_out("doc_id")).select("text", "lang"))
    return predict(d, model).withColumn("held_out", F.coalesce(held_out("doc_id"), F.lit(False)))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(read(spark, sf_dir, "pages").select("page_id", "url")).drop("url")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_spans(read(spark, sf_dir, "documents").select("doc_id", "text", "source"))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sizes(read(spark, sf_dir, "documents")).drop("copies")


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read(spark, sf_dir, "documents"))


def damaged_conversations(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, present: the rows after damage; a row that is dropped stays without ``present``."""
    def or_space(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    d = conversations.select("conv_id", "turn", or_space("role").alias("role"), or_space("text").alias("text"),
                             (F.crc32(F.concat(or_space("conv_id"), F.lit(":"), or_space("turn"))) % 20).alias("k"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("k") == 3, 2).otherwise(1))).alias("copy")
    return d.select("conv_id", "turn", F.when(F.col("k") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                    F.when(F.col("k") == 1, F.lit("")).when(F.col("k") == 2, F.translate("text", ".!?", ""))
                    .otherwise(F.col("text")).alias("text"), (F.col("k") != 0).alias("present"), copies).drop("copy")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(repair(damaged_conversations(read(spark, sf_dir, "conversations")), F.col("present")))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id, text: in one document of ten (by crc32 of its id) the words from a place on repeat a period; a null id has none."""
    h = F.crc32(F.col("doc_id").cast("string"))
    d = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g"))
    some = (F.col("h") % 10 == 0) & F.col("text").rlike("[^\\x20\\x09-\\x0D]")
    w = d.withColumn("w", F.when(some, words_of(F.col("text")))).withColumn("n", F.size("w").cast("bigint"))
    w = w.withColumn("a", F.when(F.col("n") > 0, F.pmod(F.col("g"), F.col("n"))))
    w = w.withColumn("p", F.floor((F.col("n") - F.col("a")) / (F.lit(3) + F.col("g") % 8)) + 1)
    at = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1), lambda i: F.get(
        F.col("w"), F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))
    return w.select("doc_id", F.when(F.col("a").isNotNull(), F.concat_ws(" ", at)).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = periodic_runs(with_planted_runs(read(spark, sf_dir, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("finer"))))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
                                                   r["period"].cast("string"), F.lit("\n")))
    d = d.withColumn("top", longest)
    length, period = F.col("top.length"), -F.col("top.finer")
    return d.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("top.before")).alias("start"),
                    length.alias("length"), period.alias("period"), F.floor(1000 * length / period).alias("exponent_milli"),
                    F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    ranks = tokenizer_path("byte_bpe_50k.tiktoken")
    ids = bpe.encode(read(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    facts = ids.select("doc_id", "ids", (F.length("ids") / 4).cast("bigint").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"))
    out = bpe.decode(facts, ranks, text="decoded", carry=("n_tokens", "ids_sha256"))
    return out.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extraction": op1_html_extraction,
    "op8_pii_pseudonyms": op8_pii_pseudonyms,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_voronoi_top_k": op3_voronoi_top_k,
    "op6_language_id": op6_language_id,
    "op4_secret_scan": op4_secret_scan,
    "op5_mix_sources": op5_mix_sources,
    "op7_url_filter": op7_url_filter,
    "op9_quality_rules": op9_quality_rules,
    "op10_ngram_jaccard": op10_ngram_jaccard,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_byte_bpe": op13_byte_bpe,
}
