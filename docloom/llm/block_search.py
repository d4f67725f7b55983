"""Exact nearest neighbours by a block matrix join.

Queries are dealt into blocks of bounded size and candidates into ``PARTS`` parts; a task streams a part past a query
block in tiles, and holds the block, one tile and the queries' heaps. In a tile vectors are quantised to int8 with a scale each; the int8 product (exact: small integers in
float32) gives every inner product up to a bound that follows from the norms of vectors and of quantisation errors:
|x.y - x'.y'| <= |x| |y - y'| + |x - x'| |y'|. Pairs whose upper bound reaches the k-th lower bound, and the k-th score
found so far, are recomputed from the original vectors in double precision, dimension by dimension, and merged into the
queries' heaps. Each part gives k rows a query at most, which Spark merges. No candidate is left out, so recall is 1.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components take no part, nor do rows
without vec_id. Only vectors of one length are compared. Rows of one vec_id are one vector (the smallest of them). Ties
go to the smaller vec_id. A query with fewer candidates gets them all. An empty table gives no rows. Other columns are
ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.common import written

#: Rows of a query block, parts of the candidates, candidates of one product.
QUERY_ROWS, PARTS, TILE = 1024, 8, 512


def valid_vectors(table: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id, dim and vector (doubles) of the rows that take part."""
    v = F.col("vector")
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector")).filter("vec_id is not null and size(vector) > 0")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    return rows.filter(finite).groupBy("vec_id").agg(F.min("vector").alias("vector")).select("vec_id", F.size("vector").alias("dim"), "vector")


def quantised(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales, and the norms of vectors, quantised vectors and errors."""
    scale = np.abs(vectors).max(1) / 127
    scale = np.where(scale > 0, scale, 1.0)
    codes = np.rint(vectors / scale[:, None]).astype(np.int8)
    near = codes * scale[:, None]
    return codes, scale, *(np.sqrt((m * m).sum(1)) for m in (vectors, near, vectors - near))


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows in double precision, added dimension by dimension."""
    total = np.zeros(len(a))
    for d in range(a.shape[1]):
        total += a[:, d] * b[:, d]
    return total


class QueryBlock:
    """A block of queries with their k best so far as (-score, id), best first."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.code, self.scale, self.norm, _, self.error = quantised(vectors)
        self.best: list[list[tuple[float, int]]] = [[] for _ in ids]

    def meet(self, ids: np.ndarray, candidates: np.ndarray) -> None:
        for first in range(0, len(ids), TILE):
            self._tile(ids[first:first + TILE], candidates[first:first + TILE])

    def _tile(self, own_ids: np.ndarray, own: np.ndarray) -> None:
        query_ids, queries, best, k = self.ids, self.vectors, self.best, self.k
        wide = np.float32 if queries.shape[1] * 127 * 127 < 1 << 24 else np.float64
        code, scale, _, near_norm, error = quantised(own)
        product = (self.code.astype(wide) @ code.astype(wide).T).astype(float) * self.scale[:, None] * scale
        bound = self.norm[:, None] * error + self.error[:, None] * near_norm
        bound += 1e-12 * (self.norm[:, None] * near_norm + bound) + 1e-300
        itself = query_ids[:, None] == own_ids
        lower, upper = np.where(itself, -np.inf, product - bound), np.where(itself, -np.inf, product + bound)
        floor = np.partition(lower, len(own_ids) - k, axis=1)[:, len(own_ids) - k] if len(own_ids) > k else np.full(len(query_ids), -np.inf)
        floor = np.maximum(floor, [-b[-1][0] if len(b) == k else -np.inf for b in best])
        row, column = np.nonzero((upper >= floor[:, None]) & ~itself)
        for part in range(0, len(row), 1 << 18):
            r, c = row[part:part + (1 << 18)], column[part:part + (1 << 18)]
            score = exact_products(queries[r], own[c])
            order = np.lexsort((own_ids[c], -score, r))
            r, c, score = r[order], c[order], score[order]
            starts = np.flatnonzero(np.concatenate(([True], r[1:] != r[:-1])))
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(r)]):
                b = min(b, a + k)
                new = zip((-score[a:b]).tolist(), own_ids[c[a:b]].tolist())
                best[r[a]] = list(islice(heapq.merge(best[r[a]], new), k))


def search_stream(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rows (dim, q, c, query, vec_id, vector) in that order, queries of a key first: results of every key."""
    key, ids, vectors, block = None, [], [], None

    def found() -> pa.RecordBatch:
        flat = [(q, n, -x) for q, b in zip(block.ids.tolist(), block.best) for x, n in b] if block else []
        return pa.RecordBatch.from_arrays([pa.array([f[i] for f in flat], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.float64()))], names=["query_id", "vec_id", "score"])

    for batch in batches:
        dims, q, c, query = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        edges = np.flatnonzero((np.diff(dims) != 0) | (np.diff(q) != 0) | (np.diff(c) != 0) | (query[1:] != query[:-1])) + 1
        for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(dims)]):
            if a == b:
                continue
            if key != (dims[a], q[a], c[a]):
                if block:
                    yield found()
                key, ids, vectors, block = (dims[a], q[a], c[a]), [], [], None
            part = batch.slice(a, b - a)
            own_ids = part.column(4).to_numpy()
            own = part.column(5).flatten().to_numpy(zero_copy_only=False).reshape(len(own_ids), int(dims[a]))
            if query[a]:
                ids.append(own_ids)
                vectors.append(own)
            elif ids:
                block = block or QueryBlock(np.concatenate(ids), np.concatenate(vectors), k)
                block.meet(own_ids, own)
    if block:
        yield found()


def nearest(table: DataFrame, is_query: Column, k: int = 20, vector: str = "embedding", query_rows: int = QUERY_ROWS, parts: int = PARTS) -> DataFrame:
    """query_id, rank, vec_id and score: the k nearest rows by inner product of every query row."""
    rows = written(valid_vectors(table, vector).withColumn("is_query", is_query), "vectors")
    q_blocks = max(1, -(-rows.filter("is_query").count() // query_rows))
    spread = F.xxhash64("vec_id")
    block = lambda n, name: F.pmod(spread, F.lit(n)).cast("int").alias(name)
    every = lambda n, name: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)
    candidates = rows.select("dim", every(q_blocks, "q"), block(parts, "c"), F.lit(False).alias("query"), "vec_id", "vector")
    queries = rows.filter("is_query").select("dim", block(q_blocks, "q"), every(parts, "c"), F.lit(True).alias("query"), "vec_id", "vector")
    tiles = candidates.unionByName(queries).repartition("dim", "q", "c").sortWithinPartitions("dim", "q", "c", F.desc("query"))
    found = tiles.mapInArrow(lambda batches: search_stream(batches, k), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
