"""Answers that arrive over time, applied incrementally and exactly once.

The state is a folder: ``batch=<id>`` holds the latest answers of one micro-batch, ``snapshot=<id>`` those of all batches up
to that id. Every ``compact_every`` batches a snapshot takes up the one before and the batches since, so a reader opens one
snapshot and a bounded number of batches however long the stream runs. Folders are complete when Spark's committer has
marked them; a replayed batch overwrites its own folder, and a snapshot written again holds the same rows.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from docloom.operators.overlay import latest_answers

COMPACT_EVERY = 16


def _folders(spark: SparkSession, path: str) -> dict[str, list[int]]:
    """Ids of the complete ``batch`` and ``snapshot`` folders, in order."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    system, found = root.getFileSystem(conf), {"batch": [], "snapshot": []}
    for status in system.listStatus(root) if system.exists(root) else ():
        match = re.fullmatch(r"(batch|snapshot)=(\d+)", status.getPath().getName())
        if match and system.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
            found[match[1]].append(int(match[2]))
    return {kind: sorted(ids) for kind, ids in found.items()}


def _drop(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def state_folders(spark: SparkSession, path: str, upto: int | None = None) -> list[str]:
    """What has to be read: the newest snapshot and the batches behind it."""
    found = _folders(spark, path)
    known = lambda ids: [i for i in ids if upto is None or i <= upto]
    last = max(known(found["snapshot"]), default=None)
    start = [] if last is None else [f"{path}/snapshot={last}"]
    return start + [f"{path}/batch={i}" for i in known(found["batch"]) if last is None or i > last]


def compact(spark: SparkSession, path: str, upto: int) -> None:
    """A snapshot of all batches up to ``upto``. What the snapshot before it stands for is then deleted; the one before stays for its readers."""
    before = [i for i in _folders(spark, path)["snapshot"] if i < upto]
    folders = [f for f in state_folders(spark, path, upto) if not f.endswith(f"/snapshot={upto}")]
    if folders:
        latest_answers(reduce(DataFrame.unionByName, [spark.read.parquet(f) for f in folders])).write.mode("overwrite").parquet(f"{path}/snapshot={upto}")
    found = _folders(spark, path)
    if before and upto in found["snapshot"]:
        for i in found["snapshot"]:
            if i < before[-1]:
                _drop(spark, f"{path}/snapshot={i}")
        for i in found["batch"]:
            if i <= before[-1]:
                _drop(spark, f"{path}/batch={i}")


def start_answer_stream(stream: DataFrame, path: str, checkpoint: str, delay: str = "60 days", *, available_now: bool = True, compact_every: int = COMPACT_EVERY) -> StreamingQuery:
    """``stream(gap_key, answer, ts, answer_id)`` to the latest answer per key under ``path``.

    Resent answers are dropped by id within the watermark. Each micro-batch writes at most one row per key into its own
    folder, which it overwrites when replayed, so a failed batch leaves no duplicates.
    """
    clean = stream.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["answer_id"])

    def merge(batch: DataFrame, batch_id: int) -> None:
        latest_answers(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        if (batch_id + 1) % compact_every == 0:
            compact(batch.sparkSession, path, batch_id)
    writer = clean.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_answers(spark: SparkSession, path: str) -> DataFrame:
    """Latest answer per key over all batches applied so far; a late older answer loses."""
    folders = state_folders(spark, path)
    if not folders:
        raise ValueError(f"no answers under {path}")
    return latest_answers(reduce(DataFrame.unionByName, [spark.read.parquet(f) for f in folders]))
