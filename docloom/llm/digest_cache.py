"""Token counts through a cache keyed by content digest and tokenizer version.

``token_counts`` looks up every text under SHA-256 of its content and of the tokenizer file; only distinct texts that
the cache lacks are encoded, and their counts are appended to it. Byte-level vocabularies count every byte, so the
normal form of a content is the text itself, with null as the empty text.

Defined cases: a null or empty text has 0 bytes and 0 tokens. Repeated rows stay as often as given. An empty table gives
no rows. Other columns of the input are ignored unless named in ``keep``. Any length is encoded whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.common import text_bytes, written
from docloom.llm.tokens import text_groups, tokenizer_digest, word_table

CACHE = "tokenizer string, digest binary, n_bytes long, n_tokens long"


def read_cache(spark: SparkSession, path: str, version: str) -> DataFrame:
    """Stored counts of one tokenizer version, one row per digest; none where nothing was stored."""
    try:
        stored = spark.read.schema(CACHE).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = spark.createDataFrame([], CACHE)
    # Two writers may have appended the same digest; their counts agree.
    return stored.filter(F.col("tokenizer") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def append_misses(docs: DataFrame, path: str, tokenizer: str, column: str = "text") -> None:
    """Encode the distinct texts that the cache lacks, and append their counts.

    Copies are put together inside each task first, so a text is shuffled once per task that holds it, however often it is
    repeated; the digests that are left are then held against the cache, without moving a text again.
    """
    spark, version = docs.sparkSession, tokenizer_digest(tokenizer)
    texts = docs.select(text_bytes(column).alias("content"), F.unhex(F.sha2(text_bytes(column), 256)).alias("digest"))
    known = read_cache(spark, path, version).select("digest")
    misses = texts.groupBy("digest").agg(F.first("content").alias("content")).join(known, "digest", "left_anti")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = word_table(tokenizer)
        for batch in batches:
            digests, contents = batch.column(0), batch.column(1).to_pylist()
            for first, group in text_groups(contents):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([version] * len(group)), digests.slice(first, len(group)).cast(pa.binary()),
                     pa.array([len(t) for t in group], pa.int64()), pa.array(table.count(group), pa.int64())],
                    names=["tokenizer", "digest", "n_bytes", "n_tokens"])

    misses.mapInArrow(encode, CACHE).write.mode("append").parquet(path)


def token_counts(docs: DataFrame, path: str, tokenizer: str, column: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, n_bytes and n_tokens of every row; the cache at ``path`` is completed first."""
    append_misses(docs, path, tokenizer, column)
    # One row per digest as a table: both sides of the join are then plain exchanges, and Spark splits a frequent text's.
    counts = written(read_cache(docs.sparkSession, path, tokenizer_digest(tokenizer)).withColumnRenamed("digest", "_digest"), "token-counts")
    rows = docs.select(*keep, F.octet_length(text_bytes(column)).cast("long").alias("n_bytes"), F.unhex(F.sha2(text_bytes(column), 256)).alias("_digest"))
    return rows.join(counts, "_digest", "left").select(*keep, "n_bytes", "n_tokens")
