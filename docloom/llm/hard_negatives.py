"""Hard negatives: per anchor and positive the highest-scoring rows of other labels inside a window of scores.

Components become integers ``floor(scale * x)``, so scores (inner products) are exact. All rows are packed into tiles of
some hundred vectors, a third of the bytes of an array of doubles; anchors are the rows that ``is_anchor`` names. Anchor
blocks meet candidate parts in one task each; both are bounded in bytes, so their number follows the table, and a task
holds a part, a block and the lists of the anchors at hand. Two rounds:

*Positives.* The first rows of the anchor's own label, kept per task and merged by a window with a group limit.

*Slots.* A positive of score s takes negatives of ``low`` to ``high`` percent of s. The positives' upper limits, sorted,
cut an anchor's scores into disjoint slots: slot j lies above limit j + 1 and not above limit j. A row falls into one slot
however many windows overlap there. Tasks keep the first ``k`` rows of a slot, a window merges them over the parts, and
a positive reads its own slot and those below in falling order: the first ``k`` of that suffix, as far as its lower
limit. No window is searched twice, and no list is longer than slots times k.

Defined cases: rows with a null vec_id, a null label, an empty or null vector or any null or non-finite component take no
part; vectors of different lengths are never compared. Rows of one vec_id are one row (the smallest label, then vector).
Ties go to the smaller vec_id. An anchor without positives gives no rows, nor does a positive of negative score, whose
window is empty. Components so large that a score leaves the range of a long raise ``ValueError``. An empty table gives
no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.common import written

#: Scale of components, positives of an anchor, negatives of a positive, and the window in percent of the positive's score.
SCALE, POSITIVES, NEGATIVES, LOW, HIGH = 256, 5, 10, 30, 90
#: Vectors of a tile, bytes of a task's candidates and of its anchors, anchors compared at a time.
TILE, PART_BYTES, BLOCK_BYTES, STEP = 1024, 32 << 20, 8 << 20, 1024
TILES = "dim int, n int, bytes long, ids binary, labels binary, codes binary"
FOUND = "anchor_id long, slot int, vec_id long, score long"


def labelled_vectors(table: DataFrame, label: Column, vector: str = "embedding") -> DataFrame:
    """vec_id, label and vector (doubles) of the rows that take part, one per vec_id."""
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.filter("vec_id is not null and label is not null and size(vector) > 0").filter(finite)
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("r")).select("vec_id", "r.label", "r.vector")


def packed(rows: DataFrame, scale: int = SCALE, tile: int = TILE) -> DataFrame:
    """The rows as tiles: ids and labels as 64-bit, codes as 32- or 64-bit integers, of one length each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, labels = (batch.column(i).to_numpy() for i in range(2))
            dims, flat = batch.column(2).value_lengths().to_numpy(), batch.column(2).flatten().to_numpy()
            starts = np.concatenate(([0], np.cumsum(dims)[:-1]))
            for dim in np.unique(dims):
                own = np.flatnonzero(dims == dim)
                for first in range(0, len(own), tile):
                    at = own[first:first + tile]
                    code = np.floor(scale * flat[starts[at][:, None] + np.arange(dim)])
                    if not (np.abs(code) < 2.0 ** 62).all():
                        raise ValueError("a component is too large for integer scores")
                    code = code.astype(np.int32 if (np.abs(code) < 2 ** 31).all() else np.int64)
                    yield pa.RecordBatch.from_pydict({
                        "dim": pa.array([int(dim)], pa.int32()), "n": pa.array([len(at)], pa.int32()), "bytes": pa.array([code.nbytes + 16 * len(at)], pa.int64()),
                        "ids": [ids[at].astype(np.int64).tobytes()], "labels": [labels[at].astype(np.int64).tobytes()], "codes": [code.tobytes()]})

    return rows.select("vec_id", "label", "vector").mapInArrow(run, TILES)


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, dim = row["n"], row["dim"]
    kind = np.int32 if len(row["codes"]) == 4 * n * dim else np.int64
    return np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64), np.frombuffer(row["codes"], kind).reshape(n, dim)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows."""
    most = a.shape[1] * int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0))
    if most >= 1 << 62:
        raise ValueError("a component is too large for integer scores")
    if most >= 1 << 53:
        return a.astype(np.int64) @ b.T.astype(np.int64)
    kind = np.float32 if most < 1 << 24 else np.float64
    return (a.astype(kind) @ b.T.astype(kind)).astype(np.int64)


class SlotLists:
    """The first k rows of every (anchor, slot) of some anchors."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, codes: np.ndarray, limits: np.ndarray, lowest: np.ndarray, k: int, same: bool):
        self.ids, self.labels, self.codes, self.limits, self.lowest, self.k, self.same = ids, labels, codes, limits, lowest, k, same
        slots = limits.shape[1] + 1
        self.floor = np.repeat(lowest[:, None], slots, 1)
        self.row, self.slot, self.score, self.id = (np.zeros(0, np.int64) for _ in range(4))

    def meet(self, ids: np.ndarray, labels: np.ndarray, codes: np.ndarray) -> None:
        score = products(self.codes, codes)
        slot = np.zeros(score.shape, np.int64)  # limits not below the score: 0 is above all of them
        for j in range(self.limits.shape[1]):
            slot += score <= self.limits[:, j, None]
        good = (score >= np.take_along_axis(self.floor, slot, 1)) & (slot > 0) & (ids != self.ids[:, None])
        good &= (labels == self.labels[:, None]) == self.same
        r, c = np.nonzero(good)
        if not len(r):
            return
        row, slot, value, vec = (np.concatenate(x) for x in ((self.row, r), (self.slot, slot[r, c]), (self.score, score[r, c]), (self.id, ids[c])))
        order = np.lexsort((vec, -value, slot, row))
        row, slot, value, vec = row[order], slot[order], value[order], vec[order]
        first = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (slot[1:] != slot[:-1]))))
        place = np.arange(len(row)) - np.repeat(first, np.diff(np.append(first, len(row))))
        stay = place < self.k
        self.row, self.slot, self.score, self.id = row[stay], slot[stay], value[stay], vec[stay]
        last = place == self.k - 1
        self.floor[row[last], slot[last]] = value[last]  # ties may still win by their id

    def rows(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(self.ids[self.row]), pa.array(self.slot.astype(np.int32)), pa.array(self.id), pa.array(self.score)],
                                          names=["anchor_id", "slot", "vec_id", "score"])


def _meet(anchors: pa.Table, tiles: pa.Table, k: int, same: bool) -> pa.Table:
    """First k rows of every slot of a block's anchors among the candidates of a part."""
    out, most = [], np.iinfo(np.int64)
    rows = anchors.to_pylist()
    for first in range(0, len(rows), STEP):
        part = rows[first:first + STEP]
        limits = [r["limits"] if not same else [most.max] for r in part]
        wide = max(map(len, limits))
        padded = np.array([x + [most.min] * (wide - len(x)) for x in limits], np.int64)
        codes = np.stack([np.frombuffer(r["code"], np.int64) for r in part])
        lists = SlotLists(np.array([r["anchor_id"] for r in part]), np.array([r["label"] for r in part]), codes, padded,
                          np.array([most.min if same else r["lowest"] for r in part]), k, same)
        for i in range(len(tiles)):
            lists.meet(*_unpacked(tiles.slice(i, 1).to_pylist()[0]))
        out.append(lists.rows())
    return pa.Table.from_batches(out) if out else pa.schema([("anchor_id", pa.int64()), ("slot", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())]).empty_table()


def best_of_slots(anchors: DataFrame, tiles: DataFrame, parts: int, blocks: int, k: int, same: bool) -> DataFrame:
    """anchor_id, slot, vec_id and score: the first k of every slot over all candidates."""
    every = lambda n, name: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)
    own = lambda c, n, name: F.pmod(F.xxhash64(c), F.lit(n)).cast("int").alias(name)
    left = anchors.select("dim", own("anchor_id", blocks, "q"), every(parts, "c"), *[c for c in anchors.columns if c != "dim"])
    right = tiles.select("dim", every(blocks, "q"), own("ids", parts, "c"), "n", "ids", "labels", "codes")
    met = left.groupBy("dim", "q", "c").cogroup(right.groupBy("dim", "q", "c")).applyInArrow(lambda a, t: _meet(a, t, k, same), FOUND)
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id")
    return met.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def anchor_rows(tiles: DataFrame, condition: Column) -> DataFrame:
    """dim, anchor_id, label and code (64-bit integers) of the anchors in the tiles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, labels, codes = _unpacked(row)
                wide = codes.astype(np.int64)
                yield pa.RecordBatch.from_pydict({"dim": pa.array([row["dim"]] * len(ids), pa.int32()), "vec_id": ids, "label": labels, "code": [c.tobytes() for c in wide]})

    rows = tiles.mapInArrow(run, "dim int, vec_id long, label long, code binary")
    return rows.filter(condition).withColumnRenamed("vec_id", "anchor_id")


def hard_negatives(table: DataFrame, is_anchor: Column, label: Column, vector: str = "embedding", scale: int = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH, part_bytes: int = PART_BYTES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    ``is_anchor`` is a condition on vec_id and label, ``label`` an expression of the table's columns.
    """
    spark = table.sparkSession
    tiles = written(packed(labelled_vectors(table, label, vector), scale), "tiles")
    anchors = written(anchor_rows(tiles, is_anchor), "anchors")
    size = tiles.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("b")).first()["b"]
    anchor_size = anchors.agg(F.coalesce(F.sum(F.length("code")), F.lit(0)).alias("b")).first()["b"]
    blocks = max(1, -(-anchor_size // block_bytes))
    parts = max(1, -(-size // part_bytes), -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // blocks))

    first = best_of_slots(anchors, tiles, parts, blocks, positives, True)
    found = first.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
                         F.expr(f"(score * {high} - pmod(score * {high}, 100L)) div 100").alias("upper"), F.expr(f"-((-score * {low} - pmod(-score * {low}, 100L)) div 100)").alias("lower"))
    found = written(found.filter("lower <= upper"), "positives")
    of_anchor = found.groupBy("anchor_id").agg(F.sort_array(F.collect_set("upper"), asc=False).alias("limits"), F.min("lower").alias("lowest"))
    second = best_of_slots(anchors.join(of_anchor, "anchor_id"), tiles, parts, blocks, negatives, False)
    lists = second.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("slot", (-F.col("score")).alias("minus"), "vec_id"))).alias("slots"))
    met = found.join(of_anchor.select("anchor_id", "limits"), "anchor_id").join(lists, "anchor_id")
    suffix = F.filter("slots", lambda x: (x["slot"] >= F.array_position(F.col("limits"), F.col("upper"))) & (-x["minus"] >= F.col("lower")))
    out = met.select("anchor_id", "positive_id", "positive_score", F.posexplode(F.slice(suffix, 1, negatives)).alias("p", "x"))
    return out.select("anchor_id", "positive_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("negative_id"), "positive_score", (-F.col("x.minus")).alias("negative_score"))
