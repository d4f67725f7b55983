"""Sections of a document, chapters of items, per-section graph partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions.ordering import with_running
from docloom.functions.text import WS, trim_ws

# Heading patterns that name a chapter.
CHAPTER = rf"(?i)\AChapter{WS}+\d+"
CHAPTER_OR_PART = rf"(?i)\AChapter{WS}+\d+|\AAppendix{WS}+|\APart{WS}+"
TOP_HEADING = rf"\A#{WS}+"


def sections_from_units(units: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``sections(doc_id, section, title, start_line, end_line)`` and ``unit_sections(doc_id, unit_id, section)``.

    A ``# `` heading opens a section; units before the first one belong to none.
    """
    top = (F.col("kind") == "heading") & F.col("text").rlike(TOP_HEADING)
    marked = with_running(units.withColumn("_top", top), ["doc_id"], ["start_line"],
                          {"section": ("sum", F.when(top, 1).otherwise(0))}).filter(F.col("section") > 0)
    name = trim_ws(F.regexp_replace("text", TOP_HEADING, ""))
    sections = marked.groupBy("doc_id", "section").agg(
        F.max(F.when(F.col("_top"), name)).alias("title"), F.min("start_line").alias("start_line"), F.max("end_line").alias("end_line"))
    return sections, marked.select("doc_id", "unit_id", "section", "start_line", "end_line")


def section_source(documents: DataFrame, sections: DataFrame) -> DataFrame:
    """(doc_id, section, text): the section's lines. The text is read once per document, not per section."""
    spans = sections.groupBy("doc_id").agg(F.collect_list(F.struct("section", "start_line", "end_line")).alias("_s"))
    df = documents.select("doc_id", "text").join(spans, "doc_id").withColumn("_lines", F.split("text", "\n", -1))
    cut = F.transform("_s", lambda s: F.struct(
        s["section"].alias("section"),
        F.concat(trim_ws(F.array_join(F.slice(F.col("_lines"), s["start_line"].cast("int"),
                                              (s["end_line"] - s["start_line"] + 1).cast("int")), "\n")), F.lit("\n")).alias("text")))
    return df.select("doc_id", F.explode(cut).alias("_x")).select("doc_id", "_x.*")


def _chapter_entry(context: Column, pattern: str, use_last: bool) -> Column:
    hit = F.try_element_at(F.filter(context, lambda c: c.rlike(pattern)), F.lit(1))
    return F.coalesce(hit, F.try_element_at(context, F.lit(-1))) if use_last else hit


def chapter_key() -> Column:
    """Stands for column ``chapter`` where equal chapters meet."""
    return F.substring(F.unhex(F.sha2("chapter", 256)), 1, 16)


def unit_chapter(units: DataFrame, pattern: str = CHAPTER, use_last: bool = False, default: str = "Unscoped") -> DataFrame:
    return units.withColumn("chapter", F.coalesce(_chapter_entry(F.col("context"), pattern, use_last), F.lit(default)))


def chapter_of(links: DataFrame, units: DataFrame, pattern: str = CHAPTER, use_last: bool = False,
               item: str = "node_id") -> DataFrame:
    """(doc_id, item, chapter): the first unit in order that yields a chapter decides; items without one are absent.

    Units meet items with a digest of the chapter; its name, a whole heading, is shuffled once per chapter.
    """
    first, names = chapter_digests(links, units, pattern, use_last, item)
    return first.join(names, ["doc_id", "_k"]).select("doc_id", item, "chapter")


def chapter_digests(links: DataFrame, units: DataFrame, pattern: str = CHAPTER, use_last: bool = False, item: str = "node_id") -> tuple[DataFrame, DataFrame]:
    """``chapter_of`` in two: (doc_id, item, _k), and the names behind the digests, (doc_id, _k, chapter)."""
    found = units.select("doc_id", "unit_id", _chapter_entry(F.col("context"), pattern, use_last).alias("chapter")).filter("chapter is not null")
    first = (links.select("doc_id", item, "pos", "unit_id").join(found.select("doc_id", "unit_id", chapter_key().alias("_k")), ["doc_id", "unit_id"])
             .groupBy("doc_id", item).agg(F.min_by("_k", "pos").alias("_k")))
    return first, found.select("doc_id", chapter_key().alias("_k"), "chapter").dropDuplicates(["doc_id", "_k"])


def section_nodes(nodes: DataFrame, node_units: DataFrame, unit_sections: DataFrame) -> DataFrame:
    """(doc_id, section, node_id, own_units): nodes with a unit in the section, plus non-gap nodes derived from one."""
    inside = (node_units.join(unit_sections.select("doc_id", "unit_id", "section"), ["doc_id", "unit_id"])
              .groupBy("doc_id", "section", "node_id").agg(F.count(F.lit(1)).alias("own_units")))
    derived = (nodes.filter((F.col("kind") != "gap") & F.col("derived_from").isNotNull())
               .select("doc_id", "node_id", F.col("derived_from").alias("_parent"))
               .join(inside.select("doc_id", "section", F.col("node_id").alias("_parent")), ["doc_id", "_parent"])
               .select("doc_id", "section", "node_id", F.lit(0).cast("bigint").alias("own_units")))
    return inside.unionByName(derived).groupBy("doc_id", "section", "node_id").agg(F.max("own_units").alias("own_units"))


def _ends(edges: DataFrame, members: DataFrame) -> DataFrame:
    """Edges paired with each section that holds at least one end; flags tell which."""
    m = members.select("doc_id", "section", F.col("node_id"))
    touched = edges.select("doc_id", "edge_ord", "src", "dst").withColumn(
        "_end", F.explode(F.array(F.struct(F.lit(True).alias("out"), F.col("src").alias("node_id")),
                                  F.struct(F.lit(False).alias("out"), F.col("dst").alias("node_id")))))
    touched = touched.select("doc_id", "edge_ord", "_end.*").join(m, ["doc_id", "node_id"])
    return touched.groupBy("doc_id", "section", "edge_ord").agg(F.bool_or("out").alias("has_src"), F.bool_or(~F.col("out")).alias("has_dst"))


def section_edges(edges: DataFrame, members: DataFrame) -> DataFrame:
    both = _ends(edges, members).filter("has_src and has_dst").select("doc_id", "section", "edge_ord")
    return edges.join(both, ["doc_id", "edge_ord"])


def cross_section_edges(edges: DataFrame, members: DataFrame) -> DataFrame:
    """Edges with exactly one end in the section, with the direction seen from it."""
    one = _ends(edges, members).filter("has_src <> has_dst").select(
        "doc_id", "section", "edge_ord", F.when(F.col("has_src"), "outgoing").otherwise("incoming").alias("direction"))
    return edges.join(one, ["doc_id", "edge_ord"])


def section_frames(frames: DataFrame, members: DataFrame) -> DataFrame:
    """Frames whose every node lies in the section."""
    refs = F.array_distinct(F.concat(F.array("claim"), "evidence", "limitations",
                                     F.when(F.col("warrant_gap").isNotNull(), F.array("warrant_gap")).otherwise(F.array().cast("array<string>"))))
    need = frames.select("doc_id", "frame_ord", F.size(refs).alias("_n"), F.explode(refs).alias("node_id"))
    full = (need.join(members.select("doc_id", "section", "node_id"), ["doc_id", "node_id"])
            .groupBy("doc_id", "section", "frame_ord").agg(F.count(F.lit(1)).alias("_k"), F.max("_n").alias("_n")).filter("_k = _n"))
    return frames.join(full.select("doc_id", "section", "frame_ord"), ["doc_id", "frame_ord"])


def section_concepts(members_of_concepts: DataFrame, members: DataFrame) -> DataFrame:
    """(doc_id, section, concept) for every concept with a node in the section."""
    return (members_of_concepts.select("doc_id", "concept", "node_id").join(members.select("doc_id", "section", "node_id"), ["doc_id", "node_id"])
            .select("doc_id", "section", "concept").distinct())


def section_overlay(records: DataFrame, members: DataFrame) -> DataFrame:
    return records.join(members.select("doc_id", "section", F.col("node_id").alias("gap_id")), ["doc_id", "gap_id"])


def section_tables(units: DataFrame, nodes: DataFrame, node_units: DataFrame, edges: DataFrame, frames: DataFrame, sections: DataFrame, unit_sections: DataFrame,
                   members: DataFrame) -> dict[str, DataFrame]:
    """The graph of every section, as tables whose ``doc_id`` is the struct (doc_id, section).

    Whatever works per document (validation, issues, coverage, annotation) then works per section. Lines count from the
    section's first; a node keeps its units inside the section only.
    """
    keyed = lambda df: df.withColumn("doc_id", F.struct("doc_id", "section")).drop("section")
    starts = sections.select("doc_id", "section", F.col("start_line").alias("_from"))
    place = unit_sections.select("doc_id", "unit_id", "section")
    own = units.join(place.join(starts, ["doc_id", "section"]), ["doc_id", "unit_id"])
    for line in ("start_line", "end_line"):
        own = own.withColumn(line, F.col(line) - F.col("_from") + 1)
    inside = members.select("doc_id", "section", "node_id")
    return {"units": keyed(own.drop("_from")), "nodes": keyed(nodes.join(inside, ["doc_id", "node_id"])), "node_units": keyed(node_units.join(place, ["doc_id", "unit_id"])),
            "edges": keyed(section_edges(edges, members)), "frames": keyed(section_frames(frames, members))}


def section_unresolved(unresolved: DataFrame, requirers: DataFrame, members: DataFrame) -> DataFrame:
    """(doc_id, section, concept, gap_id): unresolved concepts whose gap or one of whose requirers lies in the section.

    ``unresolved(doc_id, concept, gap_id)``, ``requirers(doc_id, concept, node_id)``.
    """
    nodes = unresolved.select("doc_id", "concept", "gap_id", F.col("gap_id").alias("node_id")).unionByName(
        unresolved.select("doc_id", "concept", "gap_id").join(requirers.select("doc_id", "concept", "node_id"), ["doc_id", "concept"]))
    return nodes.join(members.select("doc_id", "section", "node_id"), ["doc_id", "node_id"]).select("doc_id", "section", "concept", "gap_id").distinct()


def section_manifest(sections: DataFrame, members: DataFrame, edges: DataFrame, section_issues: DataFrame,
                     overlay: DataFrame, statuses: DataFrame | None = None) -> DataFrame:
    """Counts per section; inputs are the section-level tables."""
    keys = ["doc_id", "section"]
    out = sections.select(*keys, "title")
    for df, name in ((members, "node_count"), (edges, "edge_count"), (section_issues, "issue_count"), (overlay, "definition_count")):
        out = out.join(df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)), keys, "left")
    out = out.fillna(0, ["node_count", "edge_count", "issue_count", "definition_count"])
    return out.join(statuses, keys, "left") if statuses is not None else out
