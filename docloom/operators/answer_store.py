"""Extraction results kept by content, so an edited corpus asks only for chunks that changed.

A chunk's digest covers what an answer depends on: the kinds and texts of its units in order, the headings above it, and a
version of the instructions. It doesn't cover ids or line numbers, so a chunk that only moved, or that stands in several
documents, finds its result again; unit references are stored as positions inside the chunk and get the ids of the chunk
that takes them. A store is a folder of Parquet generations, one per run, which are only ever added.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.functions.ordering import cut_lineage
from docloom.operators.extraction import CHUNK

#: One result per digest: its rows by kind. A result is one answer, so its lists are bounded.
STORED = """digest string, generation long,
nodes array<struct<idx: bigint, kind: string, text: string, need: string, gap_type: string, origin: string, unit_positions: array<bigint>, defines: array<string>, requires: array<string>, mentions: array<string>, fills: array<string>>>,
edges array<struct<idx: bigint, src: bigint, dst: bigint, relation: string, reason: string>>,
frames array<struct<idx: bigint, claim: bigint, evidence: array<bigint>, warrant_gap: bigint, limitations: array<bigint>>>"""
ROWS = {"nodes": ["idx", "kind", "text", "need", "gap_type", "origin", "unit_positions", "defines", "requires", "mentions", "fills"],
        "edges": ["idx", "src", "dst", "relation", "reason"], "frames": ["idx", "claim", "evidence", "warrant_gap", "limitations"]}


def chunk_digests(chunk_units: DataFrame, version: str = "") -> DataFrame:
    """(doc_id, chunk_id, digest). ``chunk_units(doc_id, chunk_id, unit_ord, kind, text)``, and ``context`` where headings count."""
    context = F.coalesce("context", F.array().cast("array<string>")) if "context" in chunk_units.columns else F.array().cast("array<string>")
    own = chunk_units.select(*CHUNK, "unit_ord", F.struct("kind", F.sha2(F.coalesce("text", F.lit("")), 256).alias("hash"), context.alias("context")).alias("u"))
    # The path above the first unit belongs to the request; later paths follow from the headings inside.
    rows = own.groupBy(*CHUNK).agg(F.sort_array(F.collect_list(F.struct("unit_ord", "u"))).alias("rows"))
    body = F.to_json(F.struct(F.lit(version).alias("version"), F.col("rows")[0]["u"]["context"].alias("context"),
                              F.transform("rows", lambda x: F.struct(x["u"]["kind"].alias("kind"), x["u"]["hash"].alias("hash"))).alias("units")))
    return rows.select(*CHUNK, F.sha2(body, 256).alias("digest"))


def _positions(chunk_units: DataFrame) -> DataFrame:
    """(doc_id, chunk_id, unit_id, position) inside the chunk, from 1."""
    order = Window.partitionBy(*CHUNK).orderBy("unit_ord")  # a chunk is bounded
    return chunk_units.select(*CHUNK, "unit_id", F.row_number().over(order).cast("bigint").alias("position"))


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """One result per digest, the oldest; empty where nothing is stored yet."""
    try:
        rows = spark.read.schema(STORED).parquet(path)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], STORED)
    return rows.groupBy("digest").agg(F.min_by(F.struct(*[c for c in rows.columns if c != "digest"]), "generation").alias("r")).select("digest", "r.*")


def work_list(digests: DataFrame, store: DataFrame) -> DataFrame:
    """(doc_id, chunk_id, digest) to ask: one chunk for every digest without a stored result."""
    new = digests.join(store.select("digest"), "digest", "left_anti")
    return new.groupBy("digest").agg(F.min(F.struct(*CHUNK)).alias("c")).select("c.*", "digest")


def add_results(path: str, digests: DataFrame, chunk_units: DataFrame, nodes: DataFrame, edges: DataFrame, frames: DataFrame, generation: int) -> None:
    """Append the accepted rows of newly answered chunks as a generation.

    ``nodes`` carry ``unit_ids`` and the four concept lists. Digests that the store has already gain nothing.
    """
    spark = digests.sparkSession
    new = digests.join(read_store(spark, path).select("digest"), "digest", "left_anti")
    answered = new.join(nodes.select(*CHUNK).distinct(), CHUNK, "left_semi").groupBy("digest").agg(F.min(F.struct(*CHUNK)).alias("c")).select("digest", "c.*")
    refs = nodes.select(*CHUNK, "idx", F.posexplode("unit_ids").alias("p", "unit_id")).join(_positions(chunk_units), [*CHUNK, "unit_id"])
    places = refs.groupBy(*CHUNK, "idx").agg(F.transform(F.sort_array(F.collect_list(F.struct("p", "position"))), lambda x: x["position"]).alias("unit_positions"))
    rows = {"nodes": nodes.join(places, [*CHUNK, "idx"], "left").withColumn("unit_positions", F.coalesce("unit_positions", F.array().cast("array<bigint>"))), "edges": edges, "frames": frames}
    out = answered
    for name, columns in ROWS.items():
        lists = rows[name].groupBy(*CHUNK).agg(F.sort_array(F.collect_list(F.struct(*columns))).alias(name))
        out = out.join(lists, CHUNK, "left")
    kinds = {f.name: f.dataType for f in spark.createDataFrame([], STORED).schema}
    out = out.withColumn("generation", F.lit(generation)).select(*[F.coalesce(F.col(c), F.array()).cast(kinds[c]).alias(c) if c in ROWS else F.col(c).cast(kinds[c]).alias(c) for c in kinds])
    out.write.mode("append").parquet(path)


def recall(digests: DataFrame, chunk_units: DataFrame, store: DataFrame) -> dict[str, DataFrame]:
    """``nodes``, ``edges`` and ``frames`` of every chunk that has a stored result, with the unit ids of that chunk."""
    found = cut_lineage(digests.join(store, "digest"))
    out = {name: found.select(*CHUNK, F.explode(name).alias("x")).select(*CHUNK, "x.*") for name in ROWS}
    links = out["nodes"].select(*CHUNK, "idx", F.posexplode("unit_positions").alias("p", "position")).join(_positions(chunk_units), [*CHUNK, "position"])
    ids = links.groupBy(*CHUNK, "idx").agg(F.transform(F.sort_array(F.collect_list(F.struct("p", "unit_id"))), lambda x: x["unit_id"]).alias("unit_ids"))
    out["nodes"] = out["nodes"].drop("unit_positions").join(ids, [*CHUNK, "idx"], "left").withColumn("unit_ids", F.coalesce("unit_ids", F.array().cast("array<string>")))
    return out
