"""Order-dependent primitives that do not depend on a key's rows fitting one task.

A plain ``Window.partitionBy(doc_id)`` puts a whole document into one task. Here a
key's rows are cut into blocks of consecutive positions, each block is summarized
(partial aggregation), the summaries are scanned per key, and the window runs over
``(key, block)``. The rows themselves are shuffled once.
"""

from __future__ import annotations

import gc
from functools import reduce
from tempfile import mkdtemp
from time import monotonic
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 1 << 16


def _block(order: str, block_rows: int) -> Column:
    return F.floor(F.col(order) / F.lit(block_rows)).cast("bigint")


def with_position(df: DataFrame, keys: list[str], order: list[str], out: str, *,
                  block_rows: int = BLOCK_ROWS) -> DataFrame:
    """1-based position of each row inside its key, by ``order``.

    ``order[0]`` must be a non-null integer; rows with equal ``order[0]`` stay in one block.
    """
    df = df.withColumn("_blk", _block(order[0], block_rows))
    before = Window.partitionBy(*keys).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (df.groupBy(*keys, "_blk").agg(F.count(F.lit(1)).alias("_n"))
               .select(*keys, "_blk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")))
    inside = Window.partitionBy(*keys, "_blk").orderBy(*order)
    return (df.join(offsets, [*keys, "_blk"])
            .withColumn(out, F.row_number().over(inside) + F.col("_off"))
            .drop("_blk", "_off"))


def with_running(df: DataFrame, keys: list[str], order: list[str], columns: dict[str, tuple[str, Column]], *,
                 block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Running ``sum`` or ``max`` (current row included) per key; ``columns`` maps name -> (kind, value)."""
    agg = {"sum": F.sum, "max": F.max}
    df = df.withColumn("_blk", _block(order[0], block_rows))
    for name, (_, value) in columns.items():
        df = df.withColumn(f"_v_{name}", value)
    summary = df.groupBy(*keys, "_blk").agg(
        *[agg[kind](f"_v_{name}").alias(f"_s_{name}") for name, (kind, _) in columns.items()])
    before = Window.partitionBy(*keys).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.select(*keys, "_blk", *[
        agg[kind](f"_s_{name}").over(before).alias(f"_p_{name}") for name, (kind, _) in columns.items()])
    df = df.join(summary, [*keys, "_blk"])
    inside = (Window.partitionBy(*keys, "_blk").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    for name, (kind, _) in columns.items():
        here = agg[kind](f"_v_{name}").over(inside)
        carried = F.col(f"_p_{name}")
        if kind == "sum":
            value = F.coalesce(here, F.lit(0)) + F.coalesce(carried, F.lit(0))
        else:
            value = F.greatest(here, carried)
        df = df.withColumn(name, value)
    return df.drop("_blk", *[f"{p}{n}" for n in columns for p in ("_v_", "_p_")])


def first_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row per key. ``min_by`` is combined before the shuffle, so a hot key costs one row per task."""
    rest = [c for c in df.columns if c not in keys]
    position = F.struct(*order) if len(order) > 1 else F.col(order[0])
    return (df.groupBy(*keys).agg(F.min_by(F.struct(*rest), position).alias("_r"))
            .select(*keys, "_r.*").select(*df.columns))


def top_by(df: DataFrame, keys: list[str], order: list, limit: int, rank: str = "rank") -> DataFrame:
    """At most ``limit`` rows per key; Spark prunes to ``limit`` before the shuffle as well."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= limit)


def dealt(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """All rows of a key in one task, sorted by ``keys`` and ``order``, for Python functions over whole partitions.

    Dealt by a digest of the keys: Spark drops a repartition by columns that a join below already deals by, and may afterwards
    merge or split that join's partitions, so that a key's rows reach several tasks.
    """
    return df.repartition(F.xxhash64(*keys)).sortWithinPartitions(*keys, *order)


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``. Only a local session may go without it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = mkdtemp(prefix="spark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


#: Seconds between two calls for the driver's garbage, so that rounds over few rows don't wait for it.
SETTLE_S = 3.0
_settled = [0.0]


def settle(spark: SparkSession) -> None:
    """Spark deletes the shuffle files of a finished plan once the driver's garbage collection finds it gone; ask for one."""
    if monotonic() - _settled[0] >= SETTLE_S:
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        _settled[0] = monotonic()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Written to the shared folder and read back, so a lost executor never replays a long iteration.

    A compressed table takes a fraction of the disk of ``checkpoint()``, whose files hold plain rows, and only its columns in need are read.
    """
    spark, schema = df.sparkSession, df.schema
    path = f"{own_folder(spark)}/cut/{uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    del df
    settle(spark)
    return spark.read.schema(schema).parquet(path)


def staged(df: DataFrame, name: str) -> str:
    """Written as a table in the shared folder; phases read it back with known sizes and prunable columns."""
    spark = df.sparkSession
    path = f"{own_folder(spark)}/{name}"
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    del df
    settle(spark)
    return path


def own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/docloom-{spark.sparkContext.applicationId}"
