"""Queries for response validation, salvage, coverage and repair."""

from pyspark.sql import functions as F

from docloom.functions import text as tx
from docloom.operators import extraction as ex
from docloom.plans.fixtures import SPARK_BUILDERS, TABLES, Dialect, add_table, fixture, oracle, source, unstaged

QUERIES, ORACLES = {}, {}


def query(name, sql):
    def register(fn):
        QUERIES[name], ORACLES[name] = fn, oracle(sql)
        return fn
    return register


KINDS = ", ".join(f"'{k}'" for k in ex.NODE_KINDS)
RELS = ", ".join(f"'{r}'" for r in ex.EDGE_RELATIONS)

# Text with the markup the normalizers remove, derived from documents line by line.
add_table("fx_raw_terms", lambda d: """select doc_id, line, case when line % 3 = 0 then '**' || text || '** ' when line % 3 = 1
    then ' "' || text || '" ' else '`' || text || '`  _x_' end as term from fx_lines""")


@query("normalize_concept", r"""select doc_id, line, lower(regexp_replace(regexp_replace(regexp_replace(term, '[*_`]+', '', 'g'), '\s+', ' ', 'g'),
      '^[ "''“”‘’]+|[ "''“”‘’]+$', '', 'g')) as concept from fx_raw_terms""")
def normalize_concept(spark, sf):
    return fixture(spark, sf, "fx_raw_terms").select("doc_id", "line", tx.normalize_concept(F.col("term")).alias("concept"))


@query("normalize_gap_type", r"""select doc_id, line, nullif(regexp_replace(regexp_replace(lower(trim(term)), '[^\p{L}\p{N}]+', '_', 'g'), '^_+|_+$', '', 'g'), '') as gap_type
    from fx_raw_terms""")
def normalize_gap_type(spark, sf):
    return fixture(spark, sf, "fx_raw_terms").select("doc_id", "line", tx.normalize_gap_type(F.col("term")).alias("gap_type"))


@query("normalize_label", r"select doc_id, line, trim(regexp_replace(lower(term), '[^\p{L}\p{N}]+', ' ', 'g')) as label from fx_raw_terms")
def normalize_label(spark, sf):
    return fixture(spark, sf, "fx_raw_terms").select("doc_id", "line", tx.normalize_label(F.col("term")).alias("label"))


def chunk_units(spark, sf):
    return fixture(spark, sf, "fx_chunk_units")


add_table("fx_chunk_units", lambda d: "select c.doc_id, c.chunk_id, c.unit_ord, c.unit_id, u.kind, u.text from fx_chunks c join fx_units u using (doc_id, unit_ord)")


def _chunk_units(spark, sf):
    """``fx_chunks`` is a row-local projection of ``fx_units`` with the same key: unless a doc_id is repeated, both sides of the join
    are one row, and no text is shuffled."""
    units = unstaged(spark, sf, "fx_units").filter("doc_id is not null and unit_ord is not null")
    if source(spark, sf, "documents").groupBy("doc_id").count().filter("count > 1").isEmpty():
        chunks = TABLES["fx_chunks"](Dialect("spark", sf)).replace("unit_id from fx_units", "unit_id, kind, text from {units}")
        rows = spark.sql(chunks, units=units)
    else:
        rows = fixture(spark, sf, "fx_chunks").join(units.select("doc_id", "unit_ord", "kind", "text"), ["doc_id", "unit_ord"])
    return rows.select("doc_id", "chunk_id", "unit_ord", "unit_id", "kind", "text")


SPARK_BUILDERS["fx_chunk_units"] = _chunk_units

PREPARED = f"""select i.*, list_distinct(list_transform(source_unit_ids, lambda x: trim(x))) as ids, kind in ({KINDS}) as known_kind,
      case when kind in ({KINDS}) then kind else 'claim' end as k, nullif(trim(coalesce(text, '')), '') as t, trim(need) as nd from fx_node_items i"""
NODE_CHECK = f"""select p.*, m.unknown, m.unit_kind, m.unit_text, m.known from ({PREPARED}) p left join (
      select r.doc_id, r.chunk_id, r.idx, count(*) filter (where u.unit_id is null) as unknown, count(u.unit_id) as known,
        max(u.kind) filter (where u.kind in ('code', 'equation')) as unit_kind, max(u.text) filter (where u.kind in ('code', 'equation')) as unit_text
      from (select doc_id, chunk_id, idx, unnest(ids) as unit_id from ({PREPARED})) r left join fx_chunk_units u using (doc_id, chunk_id, unit_id)
      group by r.doc_id, r.chunk_id, r.idx) m using (doc_id, chunk_id, idx)"""
NODE_RULES = f"""select *, case when k = 'gap' and t is not null then 'gap_with_text' when k = 'gap' and (nd = '' or gap_type is null) then 'untyped_gap'
      when k <> 'gap' and len(ids) = 0 then 'no_source_units' when unknown > 0 then 'unknown_unit' when k <> 'gap' and final is null then 'no_text' end as why
    from (select *, case when len(ids) = 1 and unit_kind = k then unit_text else t end as final from ({NODE_CHECK}))"""
add_table("fx_node_rules", lambda d: NODE_RULES)


def validated_nodes(spark, sf):
    return ex.validate_nodes(fixture(spark, sf, "fx_node_items"), chunk_units(spark, sf))


@query("validate_nodes", """select doc_id, chunk_id, idx, k as kind, final as text, why as reason from fx_node_rules
    where not exists (select 1 from fx_node_rules b where b.doc_id = fx_node_rules.doc_id and b.chunk_id = fx_node_rules.chunk_id and b.why is not null)
    union all select doc_id, chunk_id, cast(-1 as bigint), null, null, min_by(why, idx) from fx_node_rules where why is not null group by doc_id, chunk_id""")
def validate_nodes(spark, sf):
    nodes, rejected = validated_nodes(spark, sf)
    return (nodes.select("doc_id", "chunk_id", "idx", "kind", "text", F.lit(None).cast("string").alias("reason"))
            .unionByName(rejected.select("doc_id", "chunk_id", F.lit(-1).cast("bigint").alias("idx"), F.lit(None).cast("string").alias("kind"),
                                         F.lit(None).cast("string").alias("text"), "reason")))


@query("restore_protected_text", "select doc_id, chunk_id, idx, final as text from fx_node_rules where k in ('code', 'equation')")
def restore_protected_text(spark, sf):
    prepared = ex._prepared(fixture(spark, sf, "fx_node_items"), chunk_units(spark, sf), False)
    return ex.restore_protected_text(prepared, "unit_ids").filter("kind in ('code', 'equation')").select("doc_id", "chunk_id", "idx", "text")


EDGE_CHECK = f"""select e.*, a.idx is not null and b.idx is not null and e.src <> e.dst and e.relation in ({RELS}) as ok from fx_edge_items e
    left join fx_node_items a on a.doc_id = e.doc_id and a.chunk_id = e.chunk_id and a.idx = e.src
    left join fx_node_items b on b.doc_id = e.doc_id and b.chunk_id = e.chunk_id and b.idx = e.dst"""


@query("validate_edges", f"""with checked as ({EDGE_CHECK}) select doc_id, chunk_id, idx, src, dst, relation, trim(reason) as reason from checked c
    where not exists (select 1 from checked b where b.doc_id = c.doc_id and b.chunk_id = c.chunk_id and not b.ok)""")
def validate_edges(spark, sf):
    good, _ = ex.validate_edges(fixture(spark, sf, "fx_edge_items"), fixture(spark, sf, "fx_node_items"))
    return good.select("doc_id", "chunk_id", "idx", "src", "dst", "relation", "reason")


FRAME_CHECK = """select f.*, exists (select 1 from fx_node_items n where n.doc_id = f.doc_id and n.chunk_id = f.chunk_id and n.idx = f.claim)
      and len(evidence) > 0
      and not exists (select 1 from (select unnest(list_concat(f.evidence, f.limitations)) as r) x where not exists (
        select 1 from fx_node_items n where n.doc_id = f.doc_id and n.chunk_id = f.chunk_id and n.idx = x.r))
      and (warrant_gap is null or exists (select 1 from fx_node_items n where n.doc_id = f.doc_id and n.chunk_id = f.chunk_id and n.idx = f.warrant_gap and n.kind = 'gap')) as ok
    from fx_frame_items f"""
# The reference lists exploded and joined, the same rules without correlated list access.
add_table("fx_frame_refs", lambda d: """select doc_id, chunk_id, idx, 'evidence' as role, unnest(range(1, len(evidence) + 1)) as pos, unnest(evidence) as ref from fx_frame_items
    union all select doc_id, chunk_id, idx, 'limitations', unnest(range(1, len(limitations) + 1)), unnest(limitations) from fx_frame_items
    union all select doc_id, chunk_id, idx, 'claim', 1, claim from fx_frame_items
    union all select doc_id, chunk_id, idx, 'warrant', 1, warrant_gap from fx_frame_items where warrant_gap is not null""")
add_table("fx_frame_found", lambda d: """select f.doc_id, f.chunk_id, f.idx, f.claim, f.warrant_gap,
      coalesce(bool_or(r.role = 'claim' and n.idx is null), false) as claim_bad,
      coalesce(bool_or(r.role in ('evidence', 'limitations') and n.idx is null), false) as list_bad,
      coalesce(bool_or(r.role = 'warrant' and (n.idx is null or n.kind <> 'gap')), false) as warrant_bad,
      count(*) filter (where r.role = 'evidence' and n.idx is not null) as evidence_n
    from fx_frame_items f join fx_frame_refs r using (doc_id, chunk_id, idx)
    left join fx_node_items n on n.doc_id = r.doc_id and n.chunk_id = r.chunk_id and n.idx = r.ref
    group by f.doc_id, f.chunk_id, f.idx, f.claim, f.warrant_gap""")


@query("validate_frames", """with checked as (select *, not claim_bad and not list_bad and not warrant_bad and evidence_n > 0 as ok from fx_frame_found)
    select c.doc_id, c.chunk_id, c.idx, c.claim, c.warrant_gap, e.evidence, coalesce(l.limitations, '') as limitations from checked c
    join (select doc_id, chunk_id, idx, string_agg(cast(ref as string), ',' order by pos) as evidence from (
        select doc_id, chunk_id, idx, ref, min(pos) as pos from fx_frame_refs where role = 'evidence' group by all) group by all) e using (doc_id, chunk_id, idx)
    left join (select doc_id, chunk_id, idx, string_agg(cast(ref as string), ',' order by pos) as limitations from (
        select doc_id, chunk_id, idx, ref, min(pos) as pos from fx_frame_refs where role = 'limitations' group by all) group by all) l using (doc_id, chunk_id, idx)
    where not exists (select 1 from checked b where b.doc_id = c.doc_id and b.chunk_id = c.chunk_id and not b.ok)""")
def validate_frames(spark, sf):
    good, _ = ex.validate_frames(fixture(spark, sf, "fx_frame_items"), fixture(spark, sf, "fx_node_items"))
    text = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(c)
    return good.select("doc_id", "chunk_id", "idx", "claim", "warrant_gap", text("evidence"), text("limitations"))


add_table("fx_bad_chunks", lambda d: f"""select doc_id, chunk_id, min_by(reason, place) as reason from (
      select doc_id, chunk_id, 0 as place, min_by(why, idx) as reason from fx_node_rules where why is not null group by doc_id, chunk_id
      union all select distinct doc_id, chunk_id, 1, 'bad_edge' from ({EDGE_CHECK}) where not ok
      union all select distinct doc_id, chunk_id, 2, 'bad_frame' from fx_frame_found where claim_bad or list_bad or warrant_bad or evidence_n = 0) group by doc_id, chunk_id""")


@query("validate_extraction", """select doc_id, chunk_id, 'node' as part, idx, final as content from fx_node_rules anti join fx_bad_chunks using (doc_id, chunk_id)
    union all select doc_id, chunk_id, 'edge', idx, relation from fx_edge_items anti join fx_bad_chunks using (doc_id, chunk_id)
    union all select doc_id, chunk_id, 'frame', idx, cast(claim as varchar) from fx_frame_items anti join fx_bad_chunks using (doc_id, chunk_id)
    union all select doc_id, chunk_id, 'rejected', cast(null as bigint), reason from fx_bad_chunks""")
def validate_extraction(spark, sf):
    good, rejected = ex.validate_extraction(fixture(spark, sf, "fx_node_items"), fixture(spark, sf, "fx_edge_items"), fixture(spark, sf, "fx_frame_items"), chunk_units(spark, sf))
    row = lambda df, part, idx, content: df.select("doc_id", "chunk_id", F.lit(part).alias("part"), idx.cast("bigint").alias("idx"), F.col(content).cast("string").alias("content"))
    return (row(good["nodes"], "node", F.col("idx"), "text").unionByName(row(good["edges"], "edge", F.col("idx"), "relation"))
            .unionByName(row(good["frames"], "frame", F.col("idx"), "claim")).unionByName(row(rejected, "rejected", F.lit(None), "reason")))


@query("salvage_empty_answers", """select doc_id, chunk_id, 'parsing_error' as gap_type, count(*) as units, min(unit_id) as first_unit
    from fx_chunk_units anti join fx_node_items using (doc_id, chunk_id) group by doc_id, chunk_id""")
def salvage_empty_answers(spark, sf):
    out = ex.salvage_empty_answers(chunk_units(spark, sf), fixture(spark, sf, "fx_node_items"), chunk_units(spark, sf))
    links = out["node_units"].groupBy("doc_id", "chunk_id").agg(F.count(F.lit(1)).alias("units"), F.min("unit_id").alias("first_unit"))
    return out["nodes"].select("doc_id", "chunk_id", "gap_type").join(links, ["doc_id", "chunk_id"])


def salvaged(spark, sf):
    return ex.salvage_extraction(fixture(spark, sf, "fx_node_items"), fixture(spark, sf, "fx_edge_items"), fixture(spark, sf, "fx_frame_items"),
                                 chunk_units(spark, sf))


@query("salvage_extraction", f"""with s as (select *, k <> 'gap' and len(ids) - coalesce(unknown, 0) = 1 and unit_kind = k as verbatim from ({NODE_CHECK})),
    v as (select *, case when verbatim then unit_text else t end as st from s),
    w as (select *, k = 'gap' and (st is not null or nd = '' or gap_type is null) as flawed, k <> 'gap' and st is null as textless from v),
    nodes as (select doc_id, chunk_id, 'node' as part, idx, case when textless then 'gap' else k end as a,
      case when k = 'gap' or textless then null else st end as b,
      case when textless then 'The answer gave this node no text.' when flawed and nd = '' then 'The answer left open what is missing here.' else nd end as c,
      array_to_string(list_filter([case when not known_kind then 'kind_normalized' end, case when coalesce(unknown, 0) > 0 or flawed or textless then 'parsing_error' end,
        case when k <> 'gap' and not textless and coalesce(known, 0) = 0 then 'ungrounded' end], lambda x: x is not null), ',') as d from w),
    edges as (select doc_id, chunk_id, case when ok then 'edge' else 'invalid_edge' end as part, idx, case when ok then relation end as a,
      case when ok then cast(src as string) end as b, case when ok then cast(dst as string) end as c, case when ok then trim(reason) end as d from ({EDGE_CHECK})),
    frames as (select doc_id, chunk_id, case when claim_bad or evidence_n = 0 then 'invalid_evidence_frame' else 'frame' end as part, idx,
      case when not (claim_bad or evidence_n = 0) then cast(claim as string) end as a,
      case when not (claim_bad or evidence_n = 0) and warrant_ok then cast(warrant_gap as string) end as b, null as c, null as d
      from (select f.*, n.a = 'gap' as warrant_ok from fx_frame_found f left join nodes n on n.doc_id = f.doc_id and n.chunk_id = f.chunk_id and n.idx = f.warrant_gap))
    select * from nodes union all select * from edges union all select * from frames""")
def salvage_extraction(spark, sf):
    s = salvaged(spark, sf)
    none = F.lit(None).cast("string")
    key = ["doc_id", "chunk_id"]
    nodes = s["nodes"].select(*key, F.lit("node").alias("part"), F.col("new_idx").alias("idx"), F.col("kind").alias("a"), F.col("text").alias("b"),
                              F.col("need").alias("c"), F.array_join("annotations", ",").alias("d"))
    edges = s["edges"].select(*key, F.lit("edge").alias("part"), "idx", F.col("relation").alias("a"), F.col("src").cast("string").alias("b"),
                              F.col("dst").cast("string").alias("c"), F.col("reason").alias("d"))
    frames = s["frames"].select(*key, F.lit("frame").alias("part"), "idx", F.col("claim").cast("string").alias("a"),
                                F.col("warrant_gap").cast("string").alias("b"), none.alias("c"), none.alias("d"))
    issues = s["issues"].select(*key, F.col("category").alias("part"), F.col("item_index").alias("idx"), none.alias("a"), none.alias("b"), none.alias("c"), none.alias("d"))
    return nodes.unionByName(edges).unionByName(frames).unionByName(issues)


def chunk_failures(spark, sf):
    return (fixture(spark, sf, "fx_chunks").filter("chunk_ord % 3 = 1").select("doc_id", "chunk_id").distinct()
            .withColumn("reason", F.concat(F.lit("failed "), "chunk_id")))


@query("salvage_failed_chunk", """select doc_id, chunk_id, 'failed ' || chunk_id as need, 'parsing_error' as gap_type, count(*) as units, min(unit_id) as first_unit
    from fx_failed_units group by doc_id, chunk_id""")
def salvage_failed_chunk(spark, sf):
    out = ex.salvage_failed_chunk(chunk_units(spark, sf), chunk_failures(spark, sf))
    links = out["node_units"].groupBy("doc_id", "chunk_id").agg(F.count(F.lit(1)).alias("units"), F.min("unit_id").alias("first_unit"))
    return out["nodes"].select("doc_id", "chunk_id", "need", "gap_type").join(links, ["doc_id", "chunk_id"])


FALLBACK = """select u.doc_id, u.unit_id, u.unit_ord, case u.kind when 'heading' then 'topic' when 'details' then 'example' when 'table' then 'evidence' when 'code' then 'code'
      when 'equation' then 'equation' else 'source' end as kind, u.text from fx_units u left join (
      select l.doc_id, l.unit_id, bool_or(n.kind <> 'gap') as covered, bool_or(coalesce(n.text = x.text, false)) as verbatim
      from fx_node_units l join fx_nodes n using (doc_id, node_id) join fx_units x on x.doc_id = l.doc_id and x.unit_id = l.unit_id group by l.doc_id, l.unit_id) s using (doc_id, unit_id)
    where not coalesce(covered, false) or (u.kind in ('code', 'equation') and not coalesce(verbatim, false))"""


@query("coverage_fallback", f"select doc_id, unit_id, kind, text from ({FALLBACK})")
def coverage_fallback(spark, sf):
    rows, _ = ex.coverage_fallback(fixture(spark, sf, "fx_nodes"), fixture(spark, sf, "fx_node_units"), fixture(spark, sf, "fx_units"))
    return rows.select("doc_id", "unit_id", "kind", "text")


# Parts of a chunk: the items of two halves, each with its own indexes.
add_table("fx_part_items", lambda d: "select doc_id, chunk_id, case when idx < 3 then 1 else 2 end as part_ord, idx % 3 as idx, kind from fx_node_items")
add_table("fx_part_edges", lambda d: """select a.doc_id, a.chunk_id, a.part_ord, a.idx as src, b.idx as dst from fx_part_items a
    join fx_part_items b on b.doc_id = a.doc_id and b.chunk_id = a.chunk_id and b.part_ord = a.part_ord and b.idx = a.idx + 1""")
add_table("fx_part_frames", lambda d: f"""select a.doc_id, a.chunk_id, a.part_ord, a.idx as claim, {d.arr('b.idx', 'a.idx')} as evidence,
    case when b.kind = 'gap' then b.idx end as warrant_gap, {d.no_longs()} as limitations from fx_part_items a
    join fx_part_items b on b.doc_id = a.doc_id and b.chunk_id = a.chunk_id and b.part_ord = a.part_ord and b.idx = a.idx + 1""")


@query("combine_extractions", """with n as (select doc_id, chunk_id, count(*) filter (where part_ord = 1) as k from fx_part_items group by all)
    select doc_id, chunk_id, 'edge' as part, src + case when part_ord = 2 then k else 0 end as a, dst + case when part_ord = 2 then k else 0 end as b from fx_part_edges join n using (doc_id, chunk_id)
    union all select doc_id, chunk_id, 'frame', claim + case when part_ord = 2 then k else 0 end, evidence[1] + case when part_ord = 2 then k else 0 end
    from fx_part_frames join n using (doc_id, chunk_id)
    union all select doc_id, chunk_id, 'node', idx + case when part_ord = 2 then k else 0 end, cast(null as bigint) from fx_part_items join n using (doc_id, chunk_id)""")
def combine_extractions(spark, sf):
    n, e, f = ex.combine_extractions(*[fixture(spark, sf, t) for t in ("fx_part_items", "fx_part_edges", "fx_part_frames")])
    key = ["doc_id", "chunk_id"]
    return (e.select(*key, F.lit("edge").alias("part"), F.col("src").alias("a"), F.col("dst").alias("b"))
            .unionByName(f.select(*key, F.lit("frame").alias("part"), F.col("claim").alias("a"), F.element_at("evidence", 1).alias("b")))
            .unionByName(n.select(*key, F.lit("node").alias("part"), F.col("idx").alias("a"), F.lit(None).cast("bigint").alias("b"))))


@query("repair_fallback", """select doc_id, chunk_id, row_number() over (partition by doc_id, chunk_id order by unit_ord) - 1 as idx,
      case kind when 'heading' then 'topic' when 'table' then 'evidence' when 'code' then 'code' when 'equation' then 'equation' else 'source' end as kind, text, '' as need from fx_failed_units
    union all select doc_id, chunk_id, count(*), 'gap', null, 'No usable answer for this part: failed ' || chunk_id from fx_failed_units group by doc_id, chunk_id""")
def repair_fallback(spark, sf):
    nodes, _ = ex.repair_fallback(chunk_units(spark, sf), chunk_failures(spark, sf))
    return nodes.select("doc_id", "chunk_id", "idx", "kind", "text", "need")


@query("select_shard_results", """select distinct doc_id, chunk_id, case when chunk_ord % 3 = 1 then 'repaired' when chunk_ord % 4 <> 2 then 'original' else 'to repair' end as taken from fx_chunks""")
def select_shard_results(spark, sf):
    chunks = fixture(spark, sf, "fx_chunks")
    results, work, _ = ex.select_shard_results(chunks, chunks.filter("chunk_ord % 3 = 1"), chunks.filter("chunk_ord % 4 <> 2"))
    return results.unionByName(work.withColumn("taken", F.lit("to repair")))
