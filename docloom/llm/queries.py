"""Registered queries of this subpackage: each operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.block_search import nearest
from docloom.llm.bottom_k import near_duplicates
from docloom.llm.common import fresh_folder
from docloom.llm.contamination import contamination
from docloom.llm.digest_cache import token_counts
from docloom.llm.hard_negatives import hard_negatives
from docloom.llm.interleave import interleave
from docloom.llm.oracles import ORACLES  # noqa: F401
from docloom.llm.packing import pack
from docloom.llm.quality_rules import COUNTS, quality_rules
from docloom.llm.repair import encode_to_files
from docloom.llm.templates import main_texts
from docloom.llm.toxicity import held_out, toxicity
from docloom.llm.url_rules import judge_urls
from docloom.llm.whitening import whitening
from docloom.session import ship

WORD_BPE, BYTE_BPE = "word_bpe_49k.json", "byte_bpe_50k.json"
#: The rules of the contract.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def tasks(df: DataFrame) -> int:
    """Partitions for a shuffle of whole texts: as many as the scan has, and as the session asks for."""
    return max(df.rdd.getNumPartitions(), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def op1_convolutional_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op2_repair_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return encode_to_files(docs, WORD_BPE, tasks(docs))


def op3_positional_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_hash")


def op4_stratified_interleaving(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = interleave(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge_urls(table(spark, sf_dir, "pages"), rules)


def op6_template_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(table(spark, sf_dir, "pages"))


def op7_block_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op8_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), WORD_BPE)


def op9_digest_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts(table(spark, sf_dir, "documents"), fresh_folder(spark, "token-cache"), BYTE_BPE)
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)


def op10_bottom_k_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("text_hash")


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).select("doc_id", *COUNTS, "base_failed", "kept")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening(table(spark, sf_dir, "embeddings")).drop("deviation_exact")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


QUERIES = {f.__name__: f for f in (op1_convolutional_toxicity, op2_repair_ids, op3_positional_contamination, op4_stratified_interleaving, op5_url_rules, op6_template_removal,
                                   op7_block_search, op8_sum_of_squares_packing, op9_digest_token_counts,
                                   op10_bottom_k_near_duplicates, op11_quality_rules, op12_whitening, op13_hard_negatives)}
