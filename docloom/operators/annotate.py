"""Open issues beside the source, and graded coverage of source units."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions.ordering import union_all
from docloom.functions.text import NO_SPACE, trim_spaces, trim_ws

# Gap types that count as open issues.
ISSUE_TYPES = ("parsing_error", "truncated_source", "missing_context", "context_missing", "missing_evidence", "missing_derivation",
               "missing_parameters", "missing_measurement", "unresolved_context", "empty_source_unit")
# Markers of the machine-readable comments inside documents.
ISSUE_MARK, RESOLVED_MARK, COVERAGE_MARK, SOURCE_MARK = "docloom:issue", "docloom:resolved", "docloom:coverage", "docloom:source"
FALLBACK_NEED = "The source stands as it is, nothing was extracted from it."


def issue_annotations(nodes: DataFrame, node_units: DataFrame, units: DataFrame, types: tuple[str, ...] = ISSUE_TYPES) -> tuple[DataFrame, DataFrame]:
    """``issues(doc_id, issue_id, type, need, issue_ord)`` and ``issue_units(doc_id, issue_id, pos, unit_id, end_line)``.

    Open gaps of the listed types with at least one known unit, the first per type and unit list,
    plus one fallback issue per unit that only repair text covers and no issue mentions.
    """
    known = units.select("doc_id", "unit_id", "unit_ord", "end_line")
    if "annotations" not in nodes.columns:
        nodes = nodes.withColumn("annotations", F.array().cast("array<string>"))
    gaps = nodes.filter((F.col("kind") == "gap") & F.col("gap_type").isin(*types) & F.col("resolution_status").isNull() & ~F.col("resolved"))
    links = (node_units.select("doc_id", "node_id", "pos", "unit_id").join(gaps.select("doc_id", "node_id", "node_ord", "gap_type", "need", "annotations"), ["doc_id", "node_id"])
             .join(known, ["doc_id", "unit_id"]))
    # A gap's unit list comes from one answer, so it is short; its digest is the key.
    keyed = links.groupBy("doc_id", "node_id", "node_ord", "gap_type", "need", "annotations").agg(
        F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "unit_id"))), lambda x: x["unit_id"]), "\0"), 256).alias("_k"))
    first = keyed.groupBy("doc_id", "gap_type", "_k").agg(F.min_by(F.struct("node_id", "node_ord", "need", "annotations"), "node_ord").alias("_f"))
    open_issues = first.select("doc_id", F.col("_f.node_id").alias("issue_id"), F.col("gap_type").alias("type"), F.col("_f.need").alias("need"),
                               F.col("_f.node_ord").alias("issue_ord"), F.lit(0).alias("late"),
                               F.coalesce("_f.annotations", F.array().cast("array<string>")).alias("annotations"))
    open_units = links.select("doc_id", F.col("node_id").alias("issue_id"), "pos", "unit_id", "end_line").join(open_issues.select("doc_id", "issue_id"), ["doc_id", "issue_id"], "left_semi")
    repaired = (node_units.select("doc_id", "node_id", "unit_id").join(nodes.filter((F.col("kind") != "gap") & F.col("repair_fallback")).select("doc_id", "node_id", "node_ord"), ["doc_id", "node_id"])
                .groupBy("doc_id", "unit_id").agg(F.min("node_ord").alias("issue_ord")).join(known, ["doc_id", "unit_id"])
                .join(open_units.select("doc_id", "unit_id"), ["doc_id", "unit_id"], "left_anti"))
    name = F.concat(F.lit("fallback-"), "unit_id").alias("issue_id")
    fallback = repaired.select("doc_id", name, F.lit("source_fallback").alias("type"), F.lit(FALLBACK_NEED).alias("need"), "issue_ord", F.lit(1).alias("late"),
                               F.array(F.lit("repair_source_fallback")).alias("annotations"))
    fallback_units = repaired.select("doc_id", name, F.lit(1).cast("bigint").alias("pos"), "unit_id", "end_line")
    return open_issues.unionByName(fallback), open_units.unionByName(fallback_units)


def graded_coverage(nodes: DataFrame, node_units: DataFrame, units: DataFrame, issue_units: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``unit_status(doc_id, unit_id, status)`` and a summary per document."""
    key = ["doc_id", "unit_id"]
    seen = (node_units.select("doc_id", "node_id", "unit_id").join(nodes.filter("kind <> 'gap'").select("doc_id", "node_id", "repair_fallback"), ["doc_id", "node_id"])
            .groupBy(*key).agg(F.bool_or("repair_fallback").alias("_fallback")))
    marked = issue_units.select(*key).distinct().withColumn("_open", F.lit(True))
    status = (F.when(F.col("_open").isNotNull(), "unresolved").when(F.col("_fallback"), "source_fallback")
              .when(F.col("_fallback").isNotNull(), "extracted").otherwise("source_fallback"))
    rows = units.select(*key).join(marked, key, "left").join(seen, key, "left").select(*key, status.alias("status"))
    issues = issue_units.groupBy("doc_id").agg(F.count_distinct("issue_id").alias("issues"))
    summary = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("units"), *[F.count_if(F.col("status") == s).alias(s) for s in ("extracted", "source_fallback", "unresolved")])
    return rows, summary.join(issues, "doc_id", "left").fillna(0, ["issues"])


def safe_json(value: Column) -> Column:
    """JSON that cannot end a comment."""
    return F.regexp_replace(F.to_json(value), "--", "—")


def issue_comments(issues: DataFrame, issue_units: DataFrame) -> DataFrame:
    """(doc_id, end_line, late, issue_ord, comment): one comment per issue, placed after its last unit."""
    units = issue_units.groupBy("doc_id", "issue_id").agg(
        F.max("end_line").alias("end_line"), F.transform(F.array_sort(F.collect_list(F.struct("pos", "unit_id"))), lambda x: x["unit_id"]).alias("_u"))
    body = F.struct(F.col("issue_id").alias("id"), F.lit(1).alias("version"), "type", F.lit("open").alias("status"),
                    F.lit("enrich_or_preserve").alias("action"), "need", F.col("_u").alias("sourceUnitIds"), "annotations")
    return issues.join(units, ["doc_id", "issue_id"]).select("doc_id", "end_line", "late", "issue_ord", "issue_id",
                                                            F.concat(F.lit(f"<!-- {ISSUE_MARK} "), safe_json(body), F.lit(" -->")).alias("comment"))


def annotate_document(documents: DataFrame, issues: DataFrame, issue_units: DataFrame, summary: DataFrame, *, blank_lines: bool = True) -> DataFrame:
    """Coverage comment after the first line, issue comments after their units; the text is woven inside its own row.

    Without ``blank_lines`` these are left out, with documents that have no other, and only spaces are trimmed; line numbers stay those of the source.
    """
    order = F.struct(F.col("end_line").alias("line"), "late", "issue_ord", "issue_id", "comment")
    grouped = issue_comments(issues, issue_units).groupBy("doc_id").agg(F.array_sort(F.collect_list(order)).alias("_c"))
    cover = F.concat(F.lit(f"<!-- {COVERAGE_MARK} "), F.to_json(F.struct(
        F.lit(1).alias("version"), F.col("units").alias("sourceUnitCount"), F.col("issues").alias("issueCount"), "extracted", "source_fallback", "unresolved")), F.lit(" -->"))
    df = documents.select("doc_id", "text").join(summary.select("doc_id", cover.alias("_cover")), "doc_id", "left").join(grouped, "doc_id", "left")
    row = lambda line, part, seq, text: F.struct(line.cast("bigint").alias("line"), F.lit(part).alias("part"), seq.cast("bigint").alias("seq"), text.alias("text"))
    lines = F.transform(F.split("text", "\n", -1), lambda t, i: row(i + 1, 0, F.lit(0), t))
    if not blank_lines:
        lines = F.filter(lines, lambda x: x["text"].rlike(NO_SPACE))
        df = df.filter(F.size(lines) > 0)
    one = F.when(F.col("_cover").isNotNull(), F.array(row(F.lit(1), 1, F.lit(0), F.lit("")), row(F.lit(1), 1, F.lit(1), F.col("_cover"))))
    # The blank line before a group of comments belongs to the first comment of that line.
    comments = F.transform("_c", lambda c, i: row(c["line"], 2, i, F.concat(
        F.when((i == 0) | (F.try_element_at("_c", i)["line"] != c["line"]), "\n").otherwise(""), c["comment"])))
    empty = F.array().cast("array<struct<line:bigint,part:int,seq:bigint,text:string>>")
    woven = F.array_sort(F.concat(lines, F.coalesce(one, empty), F.coalesce(comments, empty)))
    text = F.array_join(F.transform(woven, lambda x: x["text"]), "\n")
    text = trim_ws(F.regexp_replace(text, r"\n{4,}", "\n\n\n")) if blank_lines else trim_spaces(text)
    return df.select("doc_id", F.concat(text, F.lit("\n")).alias("text"))


COMMENT_END = r"\}\s*-->"
ISSUE_OPENING = rf"<!--\s*(?:{ISSUE_MARK}|{RESOLVED_MARK})\s+\{{"
ISSUE_COMMENT = rf"<!--\s*(?:{ISSUE_MARK}|{RESOLVED_MARK})\s+(\{{[\s\S]*?\}})\s*-->"


def issue_ids(text: Column) -> Column:
    """Distinct string ids of issue and resolved comments; unreadable comments are skipped."""
    bodies = F.regexp_extract_all(text, F.lit(ISSUE_COMMENT), F.lit(1))
    values = F.transform(bodies, lambda b: F.try_variant_get(F.try_parse_json(b), "$.id", "variant"))
    ids = F.transform(F.filter(values, lambda v: F.coalesce(F.schema_of_variant(v) == "STRING", F.lit(False))), lambda v: F.try_variant_get(v, "$", "string"))
    return F.array_distinct(ids)


def extract_issue_ids(documents: DataFrame, key: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    return documents.select(*key, F.explode(issue_ids(F.col("text"))).alias("issue_id"))
