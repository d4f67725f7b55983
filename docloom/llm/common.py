"""Tables between the phases of an operator, and small column helpers."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions.ordering import shared_folder

#: A-Z and a-z, for lower-casing that leaves all other letters alone.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: What the operators keep in a Python worker between tasks, as functions that let go of it.
KEPT: dict[str, Callable[[], None]] = {}


_owner = [""]


def claim(name: str) -> None:
    """Called by a task of one operator: what others keep in this worker is let go."""
    if _owner[0] == name:
        return
    _owner[0] = name
    for other, release in KEPT.items():
        if other != name:
            release()
    give_back()


def give_back() -> None:
    """Pages that freed objects and record batches leave behind in this worker go back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new folder that all executors share."""
    return f"{shared_folder(spark)}/docloom-llm/{name}-{uuid4().hex}"


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """The rows as a table in the shared folder, read back: a lost executor never repeats what led to it."""
    path = fresh_folder(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """A folder that no later phase reads goes."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def settled(spark: SparkSession) -> None:
    """Spark deletes the shuffle files of finished phases when the driver collects their plans; ask for that now."""
    gc.collect()
    spark._jvm.System.gc()


def text_bytes(column: str = "text") -> Column:
    """UTF-8 bytes of a text, empty for null."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def text_key(text: str = "text") -> Column:
    """Hash that tells apart rows of one doc_id."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))
