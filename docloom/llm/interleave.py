"""Proportional stratified interleaving of documents into shards.

Rows are ranked in seeded-shuffled order within their source, placed by fractional rank (2 * rank - 1) / (2 * rows of
the source), and the common order is cut into shards whose row counts differ by one at most, so every shard has the
mixture of all sources. Both orders are numbered by buckets: a bucket's rows are counted (combined before the shuffle),
counts are added up, and rows are numbered inside their bucket; no source and no order ever meets in one task. The
number of buckets follows the number of rows. Buckets of the common order are ranges of rank and source, so a rank that
many sources share (every odd one has a row at one half) is cut as well.

Defined cases: a null source is a stratum of its own; a null text has 0 bytes and the checksum of the empty text. Equal
doc_ids are ordered by size and checksum; wholly equal rows are interchangeable. An empty table gives no rows. Other
columns are ignored unless named in ``keep``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.common import text_bytes, written

#: Rows of a bucket, about, and buckets at least.
BUCKET_ROWS, BUCKETS = 50_000, 256
SEED = "docloom-1"


def shuffle_key(seed: str, column: str = "doc_id") -> Column:
    """Seeded hash of a key, as hex."""
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(column).cast("string"), F.lit("null"))))


def _numbered(df: DataFrame, keys: list[str], order: list[str], name: str, total: str | None = None) -> DataFrame:
    """1-based position per ``keys`` in the order of (_bucket, *order)."""
    counts = df.groupBy(*keys, "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    if total:
        counts = counts.withColumn(total, F.sum("_n").over(Window.partitionBy(*keys)))
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    return (df.join(counts.drop("_n"), [*keys, "_bucket"])
            .withColumn(name, F.col("_before") + F.row_number().over(inside)).drop("_before", "_bucket"))


def _dealt(placed: DataFrame, parts: int) -> DataFrame:
    """The rows with their _bucket: about equal ranges of (_at, stratum); each source has one row of a rank."""
    return written(placed.repartitionByRange(parts, "_at", "stratum").withColumn("_bucket", F.spark_partition_id()), "interleave-placed")


def interleave(docs: DataFrame, shards: int = 16, seed: str = SEED, strata: str = "source", keep: tuple[str, ...] = ("doc_id",),
               column: str = "text", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``keep``, size, text_crc32, stratum, shard and slot of every row."""
    rows = written(docs.select(
        *keep, F.col("doc_id").alias("_id"), F.coalesce(F.concat(F.lit("="), F.col(strata).cast("string")), F.lit("")).alias("stratum"),
        (F.octet_length(text_bytes(column)) + 1).cast("long").alias("size"), F.crc32(text_bytes(column)).alias("text_crc32"),
        shuffle_key(seed).alias("_h")), "interleave-rows")
    n = rows.count()
    buckets, order = max(BUCKETS, -(-n // bucket_rows)), ["_h", "_id", "size", "text_crc32"]
    first = F.conv(F.substring("_h", 1, 8), 16, 10).cast("long")
    ranked = _numbered(rows.withColumn("_bucket", F.floor(first * buckets / F.lit(float(1 << 32)))), ["stratum"], order, "_rank", "_of")
    placed = ranked.withColumn("_at", (F.col("_rank") * 2 - 1).cast("double") / (F.col("_of") * 2).cast("double"))
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // bucket_rows))
    spot = _numbered(_dealt(placed, parts).withColumn("_all", F.lit(0)), ["_all"], ["_at", "stratum", *order], "_spot")
    each, more = divmod(n, shards)
    pos, large = F.col("_spot") - 1, more * (each + 1)
    shard = F.when(pos < large, F.floor(pos / F.lit(each + 1))).otherwise(more + F.floor((pos - large) / F.lit(max(each, 1)))).cast("int")
    start = F.when(F.col("shard") < more, F.col("shard").cast("long") * (each + 1)).otherwise(large + (F.col("shard").cast("long") - more) * each)
    return spot.withColumn("shard", shard).withColumn("slot", pos - start).select(*keep, "size", "text_crc32", "stratum", "shard", "slot")


def write_shards(docs: DataFrame, path: str, **how) -> None:
    """Documents as one folder of files per shard; ``docs`` needs unique doc_ids."""
    places = interleave(docs, **how).select("doc_id", "shard", "slot")
    docs.join(places, "doc_id").repartition("shard", F.floor(F.col("slot") / F.lit(BUCKET_ROWS))).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
