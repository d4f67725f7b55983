"""Corpus and graph sources and sinks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions.text import is_blank, normalize_newlines, sha256_hex

GRAPH_SCHEMA = """
metadata struct<sourceSha256: string, model: string>,
sourceUnits array<struct<id: string, kind: string, text: string, hash: string, startLine: bigint, endLine: bigint, context: array<string>>>,
nodes array<struct<id: string, kind: string, text: string, need: string, gapType: string, sourceUnitIds: array<string>,
  defines: array<string>, requires: array<string>, mentions: array<string>, fills: array<string>, origin: string,
  chunkId: string, annotations: array<string>, coverageFallback: boolean, densityScore: double, derivedFrom: string,
  resolvedBy: array<string>, resolutionStatus: string, densitySource: string, densityReasons: array<string>, decompositionRole: string,
  expansionType: string, injectionType: string, epistemicStatus: string, recoveryClass: string, confidence: string, generatedGap: boolean,
  resolutionReason: string>>,
edges array<struct<`from`: string, `to`: string, relation: string, reason: string, origin: string, concept: string>>,
evidenceFrames array<struct<id: string, claim: string, evidence: array<string>, warrantGap: string, limitations: array<string>, origin: string, chunkId: string>>
"""


#: Node fields that later phases add, outside and inside.
LATER_FIELDS = {"densitySource": "density_source", "densityReasons": "density_reasons", "decompositionRole": "decomposition_role", "expansionType": "expansion_type",
                "injectionType": "injection_type", "epistemicStatus": "epistemic_status", "recoveryClass": "recovery_class", "generatedGap": "generated_gap",
                "resolutionReason": "resolution_reason"}


def accept_documents(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Normalize line ends, hash, and split off blank inputs as issues."""
    docs = raw.withColumn("text", normalize_newlines(F.col("text")))
    blank = is_blank(F.col("text"))
    good = docs.filter(~blank).withColumn("sha256", sha256_hex(F.col("text")))
    issues = docs.filter(blank).select("doc_id", F.lit("empty_source").alias("category"))
    return good, issues


def read_corpus(spark: SparkSession, path: str, fmt: str = "parquet") -> tuple[DataFrame, DataFrame]:
    """``documents`` and ``issues`` from a table of texts or a folder of text files (one document each)."""
    if fmt == "text":
        raw = (spark.read.text(path, wholetext=True)
               .select(F.xxhash64(F.input_file_name()).alias("doc_id"), F.col("value").alias("text")))
    else:
        raw = spark.read.format(fmt).load(path).select("doc_id", "text")
    return accept_documents(raw)


def _children(raw: DataFrame, field: str, order: str) -> DataFrame:
    return (raw.select("doc_id", F.posexplode(field).alias("_p", "_x"))
            .select("doc_id", (F.col("_p") + 1).cast("bigint").alias(order), "_x.*"))


def graph_tables(raw: DataFrame) -> dict[str, DataFrame]:
    """Nested graph rows (``doc_id`` + GRAPH_SCHEMA) to flat tables and link tables."""
    nodes = (_children(raw, "nodes", "node_ord").withColumnRenamed("id", "node_id")
             .withColumnRenamed("gapType", "gap_type").withColumnRenamed("chunkId", "chunk_id")
             .withColumnRenamed("coverageFallback", "coverage_fallback").withColumnRenamed("densityScore", "density_score")
             .withColumnRenamed("derivedFrom", "derived_from").withColumnRenamed("resolvedBy", "resolved_by")
             .withColumnRenamed("resolutionStatus", "resolution_status"))
    for outside, inside in LATER_FIELDS.items():
        nodes = nodes.withColumnRenamed(outside, inside)
    links = nodes.select("doc_id", "node_ord", "node_id", F.posexplode("sourceUnitIds").alias("pos", "unit_id"))
    concepts = None
    for role in ("defines", "requires", "mentions", "fills"):
        part = nodes.select("doc_id", "node_ord", "node_id", F.lit(role).alias("role"),
                            F.posexplode(role).alias("pos", "concept"))
        concepts = part if concepts is None else concepts.unionByName(part)
    units = (_children(raw, "sourceUnits", "unit_ord").withColumnRenamed("id", "unit_id")
             .withColumnRenamed("startLine", "start_line").withColumnRenamed("endLine", "end_line"))
    edges = (_children(raw, "edges", "edge_ord").withColumnRenamed("from", "src").withColumnRenamed("to", "dst"))
    frames = (_children(raw, "evidenceFrames", "frame_ord").withColumnRenamed("id", "frame_id")
              .withColumnRenamed("warrantGap", "warrant_gap").withColumnRenamed("chunkId", "chunk_id"))
    plus_one = (F.col("pos") + 1).cast("bigint")
    return {"units": units, "nodes": nodes.drop("sourceUnitIds", "defines", "requires", "mentions", "fills"),
            "node_units": links.withColumn("pos", plus_one), "node_concepts": concepts.withColumn("pos", plus_one),
            "edges": edges, "frames": frames}


def read_graph(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Graph JSON files, one graph per file; the file path identifies the document."""
    raw = (spark.read.schema(GRAPH_SCHEMA).json(path, multiLine=True)
           .withColumn("doc_id", F.xxhash64(F.input_file_name())))
    return graph_tables(raw)


def read_export(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The nested export of ``write_graph``, back as flat tables."""
    return graph_tables(spark.read.schema(f"doc_id bigint, {GRAPH_SCHEMA}").json(f"{path}/graph"))


def _nest(df: DataFrame, order: str, fields: list[Column], out: str) -> DataFrame:
    rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("_o"), F.struct(*fields).alias("_x"))))
    return df.groupBy("doc_id").agg(F.transform(rows, lambda r: r["_x"]).alias(out))


LISTS = ("sourceUnitIds", "defines", "requires", "mentions", "fills")


def _node_lists(tables: dict[str, DataFrame]) -> DataFrame:
    """Per document the link lists of its nodes, in the order in which ``_nest`` has the nodes; a node without links has null lists."""
    keys = ["doc_id", "node_id"]
    links = tables["node_units"].select(*keys, F.lit(LISTS[0]).alias("role"), "pos", F.col("unit_id").alias("value")).unionByName(
        tables["node_concepts"].select(*keys, "role", "pos", F.col("concept").alias("value")))
    rows = {role: F.array_sort(F.collect_list(F.when(F.col("role") == role, F.struct("pos", "value")))) for role in LISTS}
    lists = links.groupBy(*keys).agg(*[F.transform(r, lambda x: x["value"]).alias(role) for role, r in rows.items()])
    lists = lists.select(*keys, *[F.when(F.size(role) > 0, F.col(role)).alias(role) for role in LISTS])
    placed = tables["nodes"].select("doc_id", "node_ord", "node_id").join(lists, keys, "left")
    return placed.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("node_ord", "node_id", *LISTS))).alias("_lists"))


def export_graph(tables: dict[str, DataFrame]) -> DataFrame:
    """One nested row per document; only fields that exist in the flat tables are written.

    Texts are shuffled once, to their documents; the lists of nodes are made beside them and joined inside the document row.
    """
    nodes = tables["nodes"]
    rename = {"node_id": "id", "unit_id": "id", "frame_id": "id", "src": "from", "dst": "to", "gap_type": "gapType",
              "start_line": "startLine", "end_line": "endLine", "warrant_gap": "warrantGap", "chunk_id": "chunkId",
              "coverage_fallback": "coverageFallback", "density_score": "densityScore", "derived_from": "derivedFrom",
              "resolved_by": "resolvedBy", "resolution_status": "resolutionStatus", **{inside: outside for outside, inside in LATER_FIELDS.items()}}

    def fields(df, order):
        return [F.col(c).alias(rename.get(c, c)) for c in df.columns if c not in ("doc_id", order)]
    units, edges, frames = tables["units"], tables["edges"], tables["frames"]
    parts = ((units, "unit_ord", "sourceUnits"), (nodes, "node_ord", "nodes"), (edges, "edge_ord", "edges"), (frames, "frame_ord", "evidenceFrames"))
    # Left joins to all documents: a chain of full joins would shuffle the nested rows again for each of them.
    out = reduce(DataFrame.unionByName, [df.select("doc_id") for df, _, _ in parts]).distinct()
    for df, order, name in parts:
        nested = _nest(df, order, fields(df, order), name)
        if df is nodes:
            names = [rename.get(c, c) for c in nodes.columns if c not in ("doc_id", order)]
            whole = F.zip_with(name, "_lists", lambda x, y: F.struct(*[x[c].alias(c) for c in names], *[y[c].alias(c) for c in LISTS]))
            nested = nested.join(_node_lists(tables), "doc_id").select("doc_id", whole.alias(name))
        out = out.join(nested, "doc_id", "left")
    return out


def write_graph(tables: dict[str, DataFrame], path: str, mode: str = "error") -> None:
    """Flat tables as parquet plus a nested JSON export, compressed; Spark's committer makes the write atomic."""
    for name, df in tables.items():
        df.write.mode(mode).parquet(f"{path}/{name}")
    export_graph(tables).write.mode(mode).json(f"{path}/graph", compression="gzip")
