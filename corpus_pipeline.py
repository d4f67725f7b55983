"""A training corpus from raw documents: four stages, each over all rows that the one before kept."""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from docloom.llm import toxicity  # noqa: E402
from docloom.llm.bottom_k import near_duplicates  # noqa: E402
from docloom.llm.common import fresh_folder, text_key, written  # noqa: E402
from docloom.llm.contamination import contamination  # noqa: E402
from docloom.llm.packing import pack  # noqa: E402
from docloom.llm.queries import WORD_BPE  # noqa: E402
from docloom.session import ship  # noqa: E402

#: Word pieces whose ids a Python worker of the packing stage keeps.
TABLE_PIECES = 250_000


def _texts(found: DataFrame) -> DataFrame:
    """The texts found, as a table: Spark knows its size when it plans the join with all documents."""
    return written(found.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct(), "gone")


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on ``labels``, doesn't call toxic. Empty and null texts are scored like others; repeated rows go or stay together."""
    labels = ship(spark).read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, toxicity.fit(docs, labels))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one of smallest doc_id. Rows without words stay; so do repeated rows of the one."""
    gone = _texts(near_duplicates(docs).filter("not kept"))
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["_id"]) & (text_key("text") == gone["_hash"]), "left_anti")


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words are benchmark passages. Texts without words stay; without items all do."""
    benchmark = ship(spark).read.parquet(f"{sf_dir}/benchmark.parquet")
    gone = _texts(contamination(docs, benchmark).filter("contaminated"))
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["_id"]) & (text_key("text") == gone["_hash"]), "left_anti")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 4096 ids; a null or empty text is its end id alone.

    The executors still hold what the stages before left in the JVM, so the workers keep smaller tables.
    """
    ship(spark)
    return pack(docs, WORD_BPE, table_pieces=TABLE_PIECES)


STAGES = [("toxicity", without_toxic), ("near_duplicates", without_near_duplicates), ("decontamination", without_benchmark), ("packing", packed)]

#: The stages hold a trained model and a tokenizer, which SQL can't express; tests/llm compares with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read as the next one's rows."""
    docs = ship(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
