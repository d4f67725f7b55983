"""From documents and answer texts to a checked graph: segmentation, answers, coverage, assembly, concepts, validation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions.ordering import cut_lineage, union_all
from docloom.functions.text import zero_pad
from docloom.operators import graph as gr
from docloom.operators import segment as sg
from docloom.operators.answers import extraction_items
from docloom.operators.extraction import CHUNK, PROTECTED, node_kind_for_unit, salvage_empty_answers, salvage_extraction, salvage_failed_chunk, validate_extraction

CHUNK_CHARS = 24_000


def chunked_units(documents: DataFrame, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """Units with heading paths and the chunk each belongs to: what extraction is asked about.

    Documents are segmented once; heading paths and chunks are found without the texts, which are shuffled once to meet them.
    """
    units = cut_lineage(sg.segment_units(documents))
    paths = sg.heading_context(units.select("doc_id", "unit_ord", "level", "title")).select("doc_id", "unit_ord", "context")
    places = paths.join(sg.pack_chunks(units, chunk_chars), ["doc_id", "unit_ord"])
    return cut_lineage(units.join(places, ["doc_id", "unit_ord"]).withColumn("chunk_id", sg.chunk_id(F.col("chunk_ord"))))


def taken_answers(chunk_units: DataFrame, answers: DataFrame, *, compose: bool = True) -> dict[str, DataFrame]:
    """Per chunk its answer as far as it holds: accepted whole, else salvaged item by item, else one gap for the chunk.

    ``answers(doc_id, chunk_id, response)``. Returns ``nodes`` (with ``unit_ids``, concept lists and annotations), ``edges``,
    ``frames``, ``issues(doc_id, chunk_id, category, item_index)`` and ``outcomes(doc_id, chunk_id, outcome, reason)``.
    """
    chunks = chunk_units.select(*CHUNK).distinct()
    items = extraction_items(answers.join(chunks, CHUNK, "left_semi"))
    raw = {t: cut_lineage(items[t]) for t in ("nodes", "edges", "frames")}
    good, rejected = validate_extraction(raw["nodes"], raw["edges"], raw["frames"], chunk_units, compose=compose)
    rejected = cut_lineage(union_all(items["broken"].withColumn("_p", F.lit(0)), rejected.withColumn("_p", F.lit(1))).groupBy(*CHUNK).agg(F.min_by("reason", "_p").alias("reason")))
    accepted = {t: df.join(rejected, CHUNK, "left_anti") for t, df in good.items()}
    again = {t: df.join(rejected, CHUNK, "left_semi") for t, df in raw.items()}
    saved = salvage_extraction(again["nodes"], again["edges"], again["frames"], chunk_units, compose=compose)
    readable = answers.select(*CHUNK).join(items["issues"].filter("category <> 'absent_list'"), CHUNK, "left_anti").select(*CHUNK)
    readable = cut_lineage(readable)
    lost = cut_lineage(chunks.join(readable, CHUNK, "left_anti").join(items["issues"].select(*CHUNK, "category"), CHUNK, "left")
                       .select(*CHUNK, F.coalesce("category", F.lit("no_answer")).alias("reason")))
    gone = salvage_failed_chunk(chunk_units, lost)
    empty = salvage_empty_answers(readable.join(rejected, CHUNK, "left_semi"), raw["nodes"], chunk_units)
    saved_nodes = saved["nodes"].withColumn("idx", F.col("new_idx")).drop("new_idx")
    whole = lambda s: s["nodes"].join(s["node_units"].groupBy(*CHUNK).agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "unit_id"))), lambda x: x["unit_id"]).alias("unit_ids")), CHUNK, "left")
    columns = [*CHUNK, "idx", "kind", "text", "need", "gap_type", "origin", "unit_ids", "defines", "requires", "mentions", "fills", "annotations"]
    nodes = union_all(accepted["nodes"], saved_nodes, whole(gone), whole(empty))
    nodes = nodes.select(*[F.coalesce(c, F.array().cast("array<string>")).alias(c) if c in columns[8:] else c for c in columns])
    item_issue = lambda df: df.select(*CHUNK, "category", (F.col("item_index") if "item_index" in df.columns else F.lit(None)).cast("bigint").alias("item_index"))
    salvaged = rejected.join(empty["nodes"].select(*CHUNK), CHUNK, "left_anti").select(*CHUNK, F.lit("salvaged").alias("outcome"), "reason")
    failed = union_all(lost, empty["nodes"].select(*CHUNK, F.lit("no_usable_node").alias("reason"))).select(*CHUNK, F.lit("failed").alias("outcome"), "reason")
    whole_ones = chunks.join(union_all(salvaged, failed), CHUNK, "left_anti").select(*CHUNK, F.lit("accepted").alias("outcome"), F.lit(None).cast("string").alias("reason"))
    return {"nodes": nodes, "edges": union_all(accepted["edges"], saved["edges"]).select(*CHUNK, "idx", "src", "dst", "relation", "reason"),
            "frames": union_all(accepted["frames"], saved["frames"]).select(*CHUNK, "idx", "claim", "evidence", "warrant_gap", "limitations"),
            "issues": union_all(item_issue(saved["issues"]), item_issue(gone["issues"]), item_issue(empty["issues"])), "outcomes": union_all(whole_ones, salvaged, failed)}


def covered(nodes: DataFrame, chunk_units: DataFrame) -> DataFrame:
    """The nodes of every chunk, followed by an exact-text node for each unit of the chunk that no knowledge node covers,
    or that is protected and stands verbatim in none of its nodes; in unit order."""
    links = nodes.select(*CHUNK, "kind", "text", F.explode("unit_ids").alias("unit_id"))
    texts = chunk_units.select(*CHUNK, "unit_id", F.col("text").alias("unit_text"))
    seen = links.join(texts, [*CHUNK, "unit_id"]).groupBy(*CHUNK, "unit_id").agg(
        F.bool_or(F.col("kind") != "gap").alias("covered"), F.bool_or(F.coalesce(F.col("text") == F.col("unit_text"), F.lit(False))).alias("verbatim"))
    protected = F.col("kind").isin(*PROTECTED)
    open_units = chunk_units.select(*CHUNK, "unit_ord", "unit_id", "kind", "text").join(seen, [*CHUNK, "unit_id"], "left").fillna(False, ["covered", "verbatim"])
    open_units = open_units.filter(~F.col("covered") | (protected & ~F.col("verbatim")))
    last = nodes.groupBy(*CHUNK).agg(F.max("idx").alias("_last"))
    none = F.array().cast("array<string>")
    # Their indexes lie behind those of the answer in the order of units; assembly closes the holes.
    extra = open_units.join(last, CHUNK, "left").select(
        *CHUNK, (F.coalesce("_last", F.lit(-1)) + F.col("unit_ord")).alias("idx"), node_kind_for_unit(F.col("kind")).alias("kind"), "text", F.lit("").alias("need"),
        F.lit(None).cast("string").alias("gap_type"), F.lit("source").alias("origin"), F.array("unit_id").alias("unit_ids"),
        *[none.alias(c) for c in ("defines", "requires", "mentions", "fills", "annotations")], F.lit(True).alias("coverage_fallback"), protected.alias("protected_fallback"))
    false = F.lit(False)
    return nodes.withColumn("coverage_fallback", false).withColumn("protected_fallback", false).unionByName(extra)


def build_graph(documents: DataFrame, answers: DataFrame, chunk_chars: int = CHUNK_CHARS, *, compose: bool = True, units: DataFrame | None = None) -> dict[str, DataFrame]:
    """Everything from ``documents(doc_id, text)`` and ``answers(doc_id, chunk_id, response)`` to the validated graph.

    Tables: ``units`` (with chunks), ``nodes``, ``node_units``, ``node_concepts``, ``edges``, ``frames``, ``concepts``, ``gaps``,
    ``unresolved``, ``issues``, ``outcomes``, ``violations``, ``status`` and ``counts`` (fallbacks per document). Each phase is
    handed over as a checkpoint; no table of a document is gathered. ``units``: the ``chunked_units`` the answers were asked
    about, if they are at hand; else the documents are segmented here.
    """
    units = chunked_units(documents, chunk_chars) if units is None else units
    taken = taken_answers(units.select(*CHUNK, "unit_ord", "unit_id", "kind", "text"), answers, compose=compose)
    nodes = covered(cut_lineage(taken["nodes"]), units)
    order = units.groupBy(*CHUNK).agg(F.min("chunk_ord").alias("chunk_ord"))
    in_order = lambda df: df.join(order, CHUNK)
    placed, edges, frames = gr.assemble_graph(cut_lineage(in_order(nodes)), in_order(taken["edges"]), in_order(taken["frames"]))
    placed, edges, frames = cut_lineage(placed), cut_lineage(edges), cut_lineage(frames)
    node_units = placed.select("doc_id", "node_ord", "node_id", F.posexplode("unit_ids").alias("_p", "unit_id")).select("doc_id", "node_ord", "node_id", (F.col("_p") + 1).cast("bigint").alias("pos"), "unit_id")
    roles = F.array(*[F.struct(F.lit(r).alias("role"), F.col(r).alias("list")) for r in gr.ROLES])
    concepts_of = placed.select("doc_id", "node_ord", "node_id", F.explode(roles).alias("r")).select("doc_id", "node_ord", "node_id", "r.role", F.posexplode("r.list").alias("_p", "concept"))
    node_concepts = concepts_of.select("doc_id", "node_ord", "node_id", "role", (F.col("_p") + 1).cast("bigint").alias("pos"), "concept")
    members = cut_lineage(gr.concept_members(node_concepts, compose=False))  # normalised when the answers were checked
    concepts = cut_lineage(gr.concept_index(members))
    kept = placed.select("doc_id", "node_ord", "node_id", "kind", "text", "need", "gap_type", "origin", "chunk_id", "annotations", "coverage_fallback", "protected_fallback")
    new = gr.materialize_gaps(kept, node_units, members, concepts)
    new = {k: cut_lineage(df) for k, df in new.items()}
    out_edges = cut_lineage(gr.reconcile_and_number(edges, gr.definer_edges(kept, members, concepts), new["edges"]))
    nodes = union_all(kept.withColumn("generated_gap", F.lit(False)), new["nodes"]).fillna(False, ["coverage_fallback", "protected_fallback"])
    links = union_all(node_units, new["node_units"])
    violations, status = gr.validate_graph(units, nodes, links, out_edges, frames)
    counts = placed.groupBy("doc_id").agg(F.count_if("coverage_fallback").alias("coverage_fallbacks"), F.count_if("protected_fallback").alias("protected_fallbacks"))
    return {"units": units, "nodes": nodes, "node_units": links, "node_concepts": union_all(node_concepts, new["node_concepts"]), "edges": out_edges, "frames": frames, "concepts": concepts,
            "gaps": new["gaps"], "unresolved": gr.unresolved_concepts(new["gaps"], members, kept), "issues": taken["issues"], "outcomes": taken["outcomes"],
            "violations": violations, "status": status, "counts": counts}
