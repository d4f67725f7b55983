"""Queries for graph assembly, concepts, validation and variant merge."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from docloom.functions.ordering import union_all
from docloom.operators import graph as g
from docloom.plans.fixtures import RELATIONS, add_table, fixture, oracle, pad, stage, unstaged

QUERIES, ORACLES = {}, {}


def query(name, sql):
    def register(fn):
        QUERIES[name], ORACLES[name] = fn, oracle(sql)
        return fn
    return register


def concept_tables(spark, sf):
    """Concept members and concepts, handed over as tables to the later phases."""
    members = stage(spark, sf, "concept_members", lambda: g.concept_members(fixture(spark, sf, "fx_node_concepts")))
    return members, stage(spark, sf, "concepts", lambda: g.concept_index(members))


add_table("fx_ids", lambda d: f"select *, {pad('n', 'node_no', 7)} as new_id from (select *, row_number() over (partition by doc_id order by chunk_ord, idx) as node_no from fx_node_items)")


@query("assemble_graph", f"""with e as (select i.doc_id, i.chunk_ord, i.idx, a.new_id as src, b.new_id as dst, i.relation from fx_edge_items i
      join fx_ids a on a.doc_id = i.doc_id and a.chunk_id = i.chunk_id and a.idx = i.src join fx_ids b on b.doc_id = i.doc_id and b.chunk_id = i.chunk_id and b.idx = i.dst
      where a.new_id <> b.new_id),
    f as (select i.doc_id, {pad('ef', 'row_number() over (partition by i.doc_id order by i.chunk_ord, i.idx)', 6)} as id, a.new_id as claim, b.new_id as warrant
      from fx_frame_items i left join fx_ids a on a.doc_id = i.doc_id and a.chunk_id = i.chunk_id and a.idx = i.claim
      left join fx_ids b on b.doc_id = i.doc_id and b.chunk_id = i.chunk_id and b.idx = i.warrant_gap)
    select doc_id, 'node' as part, new_id as a, chunk_id as b, kind as c from fx_ids
    union all select distinct doc_id, 'edge', src, dst, relation from e union all select doc_id, 'frame', id, claim, warrant from f""")
def assemble_graph(spark, sf):
    n, e, f = g.assemble_graph(*[fixture(spark, sf, t) for t in ("fx_node_items", "fx_edge_items", "fx_frame_items")])
    return (n.select("doc_id", F.lit("node").alias("part"), F.col("node_id").alias("a"), F.col("chunk_id").alias("b"), F.col("kind").alias("c"))
            .unionByName(e.select("doc_id", F.lit("edge").alias("part"), F.col("src").alias("a"), F.col("dst").alias("b"), F.col("relation").alias("c")))
            .unionByName(f.select("doc_id", F.lit("frame").alias("part"), F.col("frame_id").alias("a"), F.col("claim").alias("b"), F.col("warrant_gap").alias("c"))))


add_table("fx_clean_edges", lambda d: """select doc_id, min(edge_ord) as edge_ord, src, dst, relation, min_by(reason, edge_ord) as reason, 'model' as origin
    from fx_edges where src <> dst group by doc_id, src, dst, relation""")


@query("dedupe_edges", "select * from fx_clean_edges")
def dedupe_edges(spark, sf):
    return g.dedupe_edges(fixture(spark, sf, "fx_edges"))


add_table("fx_members", lambda d: """select distinct doc_id, concept, role, case role when 'defines' then 1 when 'requires' then 2 when 'mentions' then 3 else 4 end as role_no,
    node_ord, node_id, min(pos) over (partition by doc_id, concept, role, node_id) as pos from fx_node_concepts""")
add_table("fx_concepts", lambda d: """select doc_id, concept, count_if(role = 'defines') as defined_by, count_if(role = 'requires') as required_by,
    count_if(role = 'mentions') as mentioned_by, count_if(role = 'fills') as gap_nodes, min(node_ord * 100 + role_no * 10 + pos) as seen from fx_members group by doc_id, concept""")


@query("concept_index", """select doc_id, concept, concept as label, cast(floor(seen / 100) as bigint) as first_node, cast(defined_by as bigint) as defined_by,
    cast(required_by as bigint) as required_by, cast(mentioned_by as bigint) as mentioned_by, cast(gap_nodes as bigint) as gap_nodes from fx_concepts""")
def concept_index(spark, sf):
    members = g.concept_members(fixture(spark, sf, "fx_node_concepts"))
    return g.concept_index(members).drop("first_role", "first_pos")


add_table("fx_primary", lambda d: """select m.doc_id, m.concept, min_by(m.node_id, case when n.kind = 'definition' then 0 else 1000000000 end
    + case when n.origin = 'source' then 0 else 100000000 end + m.node_ord) as src from fx_members m join fx_nodes n using (doc_id, node_id) where role = 'defines' group by m.doc_id, m.concept""")
add_table("fx_new_gaps", lambda d: f"""select *, {pad('n', 'no', 7)} as gap_id from (
    select c.doc_id, c.concept, c.seen, x.last + row_number() over (partition by c.doc_id order by c.seen) as no from fx_concepts c
    join (select doc_id, max(node_ord) as last from fx_nodes group by doc_id) x using (doc_id) where defined_by = 0 and required_by > 0 and gap_nodes = 0)""")
add_table("fx_gap_of", lambda d: """select doc_id, concept, seen, gap_id, true as generated from fx_new_gaps
    union all select c.doc_id, c.concept, c.seen, min_by(m.node_id, m.node_ord), false from fx_concepts c join fx_members m on m.doc_id = c.doc_id and m.concept = c.concept and m.role = 'fills'
    where c.defined_by = 0 and c.required_by > 0 group by c.doc_id, c.concept, c.seen""")
add_table("fx_reconciled", lambda d: """select doc_id, src, dst, relation, min_by(origin, o) as origin, nullif(min_by(coalesce(concept, ''), o), '') as concept from (
      select doc_id, src, dst, relation, origin, cast(null as string) as concept, [0, edge_ord, 0] as o from fx_edges where origin = 'model'
      union all select m.doc_id, p.src, m.node_id, 'enables', 'concept-reconciliation', m.concept, [1, c.seen, m.node_ord] from fx_members m
        join fx_primary p using (doc_id, concept) join fx_concepts c using (doc_id, concept) where m.role = 'requires' and p.src <> m.node_id
      union all select m.doc_id, p.gap_id, m.node_id, 'enables', 'gap-reconciliation', m.concept, [1, p.seen, m.node_ord] from fx_members m
        join fx_gap_of p using (doc_id, concept) where m.role = 'requires' and p.gap_id <> m.node_id)
    group by doc_id, src, dst, relation""")


def gap_tables(spark, sf):
    members, concepts = concept_tables(spark, sf)
    return g.materialize_gaps(fixture(spark, sf, "fx_node_keys"), fixture(spark, sf, "fx_node_units"), members, concepts), members, concepts


def staged_gaps(spark, sf, *names):
    """The named tables of the gaps, all by default."""
    return {name: stage(spark, sf, f"gaps_{name}", lambda name=name: gap_tables(spark, sf)[0][name]) for name in names or ("gaps", "nodes", "node_units", "node_concepts", "edges")}


def reconciled_edges(spark, sf):
    gaps, members, concepts = gap_tables(spark, sf)
    return g.reconcile_concepts(fixture(spark, sf, "fx_edges"), g.definer_edges(fixture(spark, sf, "fx_node_keys"), members, concepts), gaps["edges"])


@query("reconcile_concepts", "select * from fx_reconciled")
def reconcile_concepts(spark, sf):
    return reconciled_edges(spark, sf).drop("reason")


@query("materialize_gaps", """select g.doc_id, g.concept, g.gap_id, g.generated, coalesce(u.units, '') as units from fx_gap_of g left join (
      select doc_id, gap_id, string_agg(unit_id, ',' order by node_ord, pos) as units from (
        select g.doc_id, g.gap_id, l.unit_id, min(l.node_ord) as node_ord, min_by(l.pos, l.node_ord * 10 + l.pos) as pos from fx_new_gaps g
        join fx_members m on m.doc_id = g.doc_id and m.concept = g.concept and m.role = 'requires' join fx_node_units l on l.doc_id = m.doc_id and l.node_id = m.node_id
        group by g.doc_id, g.gap_id, l.unit_id) group by doc_id, gap_id) u using (doc_id, gap_id)""")
def materialize_gaps(spark, sf):
    out, _, _ = gap_tables(spark, sf)
    units = (out["node_units"].groupBy("doc_id", F.col("node_id").alias("gap_id"))
             .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "unit_id"))), lambda x: x["unit_id"]), ",").alias("units")))
    return out["gaps"].select("doc_id", "concept", "gap_id", "generated").join(units, ["doc_id", "gap_id"], "left").fillna("", ["units"])


@query("unresolved_concepts", """select g.doc_id, g.concept, g.gap_id, c.required_by as required_by, coalesce(e.examples, '') as examples from fx_gap_of g
    join (select doc_id, concept, cast(required_by as bigint) as required_by from fx_concepts) c using (doc_id, concept)
    left join (select doc_id, concept, string_agg(text, '|' order by node_ord) as examples from (
      select m.doc_id, m.concept, m.node_ord, n.text, row_number() over (partition by m.doc_id, m.concept order by m.node_ord) as rn
      from fx_members m join fx_nodes n using (doc_id, node_id) where m.role = 'requires') where rn <= 3 and text <> '' group by doc_id, concept) e using (doc_id, concept)""")
def unresolved_concepts(spark, sf):
    out, members = staged_gaps(spark, sf, "gaps"), concept_tables(spark, sf)[0]
    rows = g.unresolved_concepts(out["gaps"], members, fixture(spark, sf, "fx_nodes"))
    return rows.withColumn("examples", F.array_join("examples", "|"))


add_table("fx_frame_nodes", lambda d: """select doc_id, frame_id, 'claim' as role, claim as node_id from fx_frames
    union all select doc_id, frame_id, 'evidence', unnest(evidence) from fx_frames union all select doc_id, frame_id, 'limitations', unnest(limitations) from fx_frames
    union all select doc_id, frame_id, 'warrant_gap', warrant_gap from fx_frames where warrant_gap is not null""")
RELS = ", ".join(f"'{r}'" for r in RELATIONS)
VIOLATIONS = f"""with seen as (select l.doc_id, l.unit_id, bool_or(n.kind <> 'gap') as covered, bool_or(coalesce(n.text = u.text, false)) as verbatim
      from fx_node_units l join fx_nodes n using (doc_id, node_id) join fx_units u on u.doc_id = l.doc_id and u.unit_id = l.unit_id group by l.doc_id, l.unit_id),
    checked as (select u.*, coalesce(covered, false) as covered, coalesce(verbatim, false) as verbatim from fx_units u left join seen using (doc_id, unit_id))
    select doc_id, 'uncovered_unit' as rule, unit_id as item from checked where not covered
    union all select doc_id, 'not_verbatim', unit_id from checked where kind in ('code', 'equation') and not verbatim
    union all select doc_id, 'dangling_edge', cast(edge_ord as string) from fx_edges e where not exists (select 1 from fx_nodes n where n.doc_id = e.doc_id and n.node_id = e.src)
      or not exists (select 1 from fx_nodes n where n.doc_id = e.doc_id and n.node_id = e.dst)
    union all select doc_id, 'bad_relation', cast(edge_ord as string) from fx_edges where relation not in ({RELS})
    union all select doc_id, 'duplicate_edge', src || '>' || dst || '>' || relation from fx_edges group by doc_id, src, dst, relation having count(*) > 1
    union all (select distinct f.doc_id, 'frame_' || f.role, f.frame_id from fx_frame_nodes f left join fx_nodes n using (doc_id, node_id)
      where n.node_id is null or (f.role = 'warrant_gap' and n.kind <> 'gap')
      union select doc_id, 'frame_evidence', frame_id from fx_frames where len(evidence) = 0)"""


@query("validate_graph", VIOLATIONS)
def validate_graph(spark, sf):
    return g.validate_graph(*[fixture(spark, sf, t) for t in ("fx_units", "fx_nodes", "fx_node_units", "fx_edges", "fx_frames")])[0]


@query("graph_stats", """select n.doc_id, n.node_count, n.gap_count, n.node_count - n.gap_count as knowledge_count, coalesce(e.c, 0) as edge_count, coalesce(f.c, 0) as frame_count,
      coalesce(k.c, 0) as concept_count, coalesce(k.u, 0) as unresolved_count, coalesce(v.c, 0) / u.c as coverage from
      (select doc_id, count(*) as node_count, cast(count_if(kind = 'gap') as bigint) as gap_count from fx_nodes group by doc_id) n
    left join (select doc_id, count(*) as c from fx_edges group by doc_id) e using (doc_id) left join (select doc_id, count(*) as c from fx_frames group by doc_id) f using (doc_id)
    left join (select doc_id, count(*) as c, cast(count_if(defined_by = 0 and required_by > 0) as bigint) as u from fx_concepts group by doc_id) k using (doc_id)
    join (select doc_id, count(*) as c from fx_units group by doc_id) u using (doc_id)
    left join (select doc_id, count(distinct fx_node_units.unit_id) as c from fx_node_units join fx_nodes using (doc_id, node_id) where kind <> 'gap' group by doc_id) v using (doc_id)""")
def graph_stats(spark, sf):
    _, concepts = concept_tables(spark, sf)
    return g.graph_stats(*[fixture(spark, sf, t) for t in ("fx_units", "fx_nodes", "fx_node_units", "fx_edges", "fx_frames")], concepts)


# Two variants of each document's graph that share a third of their nodes.
def _variant(table, order, columns):
    def build(d):
        parts = [f"select {columns}, cast({v} as bigint) as variant from {table} where {order} % 3 <> {v - 1}" for v in (1, 2)]
        return " union all ".join(parts)
    return build


add_table("fx_vnodes", _variant("fx_nodes", "node_ord", "doc_id, node_ord, node_id, kind, text, need, gap_type, origin, coverage_fallback"))
add_table("fx_vunits", _variant("fx_node_units", "node_ord", "doc_id, node_ord, node_id, pos, unit_id"))
add_table("fx_vconcepts", _variant("fx_node_concepts", "node_ord", "doc_id, node_ord, node_id, role, pos, concept"))
add_table("fx_vedges", _variant("fx_edges", "edge_ord", "doc_id, edge_ord, src, dst, relation, reason, origin"))
add_table("fx_vframes", _variant("fx_frames", "frame_ord", "doc_id, frame_ord, frame_id, claim, evidence, warrant_gap, limitations, origin"))
# Two nodes of a document are the same when kind, text (gaps: type, need) and units agree.
add_table("fx_vkeys", lambda d: """select v.*, v.variant * 1000000000 + v.node_ord as o, concat_ws('~', case when kind = 'gap' then 'gap' else 'k' end,
      case when kind = 'gap' then gap_type else kind end, case when kind = 'gap' then need else coalesce(text, '<null>') end, u.units) as key
    from fx_vnodes v join (select doc_id, variant, node_id, string_agg(unit_id, ',' order by unit_id) as units from fx_vunits group by doc_id, variant, node_id) u using (doc_id, variant, node_id)""")
add_table("fx_vmap", lambda d: f"""select k.*, {pad('n', 'merged_no', 7)} as merged_id from fx_vkeys k join (
      select doc_id, key, row_number() over (partition by doc_id order by min(o)) as merged_no from fx_vkeys group by doc_id, key) m using (doc_id, key)""")


def merged(spark, sf):
    return g.merge_variants(*[fixture(spark, sf, t) for t in ("fx_vnodes", "fx_vunits", "fx_vconcepts")])


def staged_id_map(spark, sf):
    return stage(spark, sf, "variant_ids", lambda: merged(spark, sf)["id_map"])


@query("merge_variants", """select m.doc_id, merged_id as node_id, min_by(kind, o) as kind, min_by(text, o) as text, bool_or(coverage_fallback) as coverage_fallback,
      coalesce(max(c.concepts), 0) as concepts from fx_vmap m left join (
        select doc_id, merged_id, count(distinct role || ':' || concept) as concepts from fx_vmap join fx_vconcepts using (doc_id, variant, node_id) group by doc_id, merged_id) c using (doc_id, merged_id)
    group by m.doc_id, merged_id""")
def merge_variants(spark, sf):
    out = merged(spark, sf)
    counts = out["node_concepts"].groupBy("doc_id", "node_id").agg(F.count(F.lit(1)).alias("concepts"))
    return (out["nodes"].select("doc_id", "node_id", "kind", "text", "coverage_fallback").join(counts, ["doc_id", "node_id"], "left").fillna(0, ["concepts"]))


@query("merge_edges", """select e.doc_id, a.merged_id as src, b.merged_id as dst, e.relation, min_by(e.reason, e.variant * 1000000000 + e.edge_ord) as reason from fx_vedges e
    join fx_vmap a on a.doc_id = e.doc_id and a.variant = e.variant and a.node_id = e.src join fx_vmap b on b.doc_id = e.doc_id and b.variant = e.variant and b.node_id = e.dst
    where a.merged_id <> b.merged_id group by e.doc_id, a.merged_id, b.merged_id, e.relation""")
def merge_edges(spark, sf):
    out = g.merge_edges(fixture(spark, sf, "fx_vedges"), staged_id_map(spark, sf))
    return out.select("doc_id", "src", "dst", "relation", "reason")


FRAMES_MERGED = f"""with r as (select f.doc_id, f.variant, f.frame_ord, x.role, x.pos, m.merged_id from fx_vframes f join (
        select doc_id, variant, frame_ord, 'c' as role, cast(0 as bigint) as pos, claim as node_id from fx_vframes union all
        select doc_id, variant, frame_ord, 'e', unnest(range(1, len(evidence) + 1)), unnest(evidence) from fx_vframes union all
        select doc_id, variant, frame_ord, 'l', unnest(range(1, len(limitations) + 1)), unnest(limitations) from fx_vframes union all
        select doc_id, variant, frame_ord, 'w', cast(0 as bigint), warrant_gap from fx_vframes) x using (doc_id, variant, frame_ord)
      left join fx_vmap m on m.doc_id = f.doc_id and m.variant = f.variant and m.node_id = x.node_id),
    s as (select doc_id, variant, frame_ord, max(merged_id) filter (where role = 'c') as claim, coalesce(string_agg(merged_id, ',' order by pos) filter (where role = 'e'), '') as evidence,
      max(merged_id) filter (where role = 'w') as warrant_gap, coalesce(string_agg(merged_id, ',' order by pos) filter (where role = 'l'), '') as limitations from r group by doc_id, variant, frame_ord)
    select doc_id, {pad('ef', 'row_number() over (partition by doc_id order by min(variant * 1000000000 + frame_ord))', 6)} as frame_id, claim, evidence, warrant_gap, limitations
    from s where claim is not null and evidence <> '' group by doc_id, claim, evidence, warrant_gap, limitations"""


@query("merge_frames", FRAMES_MERGED)
def merge_frames(spark, sf):
    out = g.merge_frames(fixture(spark, sf, "fx_vframes"), staged_id_map(spark, sf))
    return out.select("doc_id", "frame_id", "claim", F.array_join("evidence", ",").alias("evidence"), "warrant_gap", F.array_join("limitations", ",").alias("limitations"))


# The whole merge: documents with one remainder of nine have variants from different sources; nodes carry notes.
add_table("fx_vnotes", lambda d: """select doc_id, variant, node_ord, node_id, cast(1 as bigint) as pos, 'note ' || cast(node_ord % 3 as string) as annotation from fx_vnodes
    union all select doc_id, variant, node_ord, node_id, cast(2 as bigint), 'variant ' || cast(variant as string) from fx_vnodes where node_ord % 2 = 0""")


@query("merge_graphs", f"""with map as (select *, cast(substr(merged_id, 2) as bigint) as merged_no from fx_vmap where doc_id % 9 <> 4),
    nodes as (select doc_id, merged_no, merged_id, min_by(kind, o) as kind, min_by(text, o) as text, min_by(origin, o) as origin from map group by all),
    links as (select distinct m.doc_id, m.merged_id, u.unit_id from map m join fx_vunits u using (doc_id, variant, node_id)),
    lists as (select doc_id, merged_id, merged_no, role, concept, row_number() over (partition by doc_id, merged_id, role order by min(o * 10 + pos)) as pos from map join fx_vconcepts using (doc_id, variant, node_id) group by doc_id, merged_id, merged_no, role, concept),
    seen_at as (select doc_id, concept, min(merged_no * 100 + case role when 'defines' then 1 when 'requires' then 2 when 'mentions' then 3 else 4 end * 10 + pos) as seen, count_if(role = 'defines') as d, count_if(role = 'requires') as r, count_if(role = 'fills') as f
      from lists group by all),
    first_def as (select l.doc_id, l.concept, min_by(l.merged_id, case when n.kind = 'definition' then 0 else 1000000000 end + case when n.origin = 'source' then 0 else 100000000 end + l.merged_no) as src
      from lists l join nodes n using (doc_id, merged_id) where role = 'defines' group by all),
    fresh as (select s.doc_id, s.concept, s.seen, {pad('n', 'x.last + row_number() over (partition by s.doc_id order by s.seen)', 7)} as gap_id from seen_at s join (select doc_id, max(merged_no) as last from nodes group by doc_id) x using (doc_id) where d = 0 and r > 0 and f = 0),
    gap_of as (select doc_id, concept, seen, gap_id from fresh union all select s.doc_id, s.concept, s.seen, min_by(l.merged_id, l.merged_no) from seen_at s join lists l using (doc_id, concept) where s.d = 0 and s.r > 0 and l.role = 'fills' group by all),
    offered as (select e.doc_id, a.merged_id as src, b.merged_id as dst, e.relation, e.origin, [0, e.variant * 1000000000 + e.edge_ord, 0] as o from fx_vedges e join map a on a.doc_id = e.doc_id and a.variant = e.variant and a.node_id = e.src
        join map b on b.doc_id = e.doc_id and b.variant = e.variant and b.node_id = e.dst where a.merged_id <> b.merged_id
      union all select l.doc_id, p.src, l.merged_id, 'enables', 'concept-reconciliation', [1, s.seen, l.merged_no] from lists l join first_def p using (doc_id, concept) join seen_at s using (doc_id, concept) where l.role = 'requires' and p.src <> l.merged_id
      union all select l.doc_id, p.gap_id, l.merged_id, 'enables', 'gap-reconciliation', [1, p.seen, l.merged_no] from lists l join gap_of p using (doc_id, concept) where l.role = 'requires' and p.gap_id <> l.merged_id),
    edges as (select doc_id, src, dst, relation, min_by(origin, o) as origin from offered group by all),
    unit_state as (select u.doc_id, u.unit_id, u.kind, coalesce(bool_or(n.kind <> 'gap'), false) as covered, coalesce(bool_or(coalesce(n.text = u.text, false)), false) as verbatim
      from fx_units u left join links l using (doc_id, unit_id) left join nodes n on n.doc_id = l.doc_id and n.merged_id = l.merged_id where u.doc_id % 9 <> 4 group by all),
    frame_state as (select distinct doc_id, claim, evidence, warrant_gap, limitations from ({FRAMES_MERGED}) where doc_id % 9 <> 4),
    faults as (select doc_id from unit_state where not covered union all select doc_id from unit_state where kind in ('code', 'equation') and not verbatim union all select doc_id from edges where relation not in ({RELS})
      union all select f.doc_id from frame_state f join nodes n on n.doc_id = f.doc_id and n.merged_id = f.warrant_gap where n.kind <> 'gap'),
    state as (select n.doc_id, coalesce(max(f.n), 0) as errors, bool_or(n.kind = 'gap') or max(g.n) > 0 as gaps from nodes n left join (select doc_id, count(*) as n from faults group by all) f using (doc_id)
      left join (select doc_id, count(*) as n from fresh group by all) g using (doc_id) group by n.doc_id)
    select distinct doc_id, 'refused' as part, cast(null as string) as a, cast(null as string) as b, cast(null as string) as c, cast(null as bigint) as n from fx_vnodes where doc_id % 9 = 4
    union all select doc_id, 'status', case when errors > 0 then 'failed' when gaps then 'complete_with_gaps' else 'complete' end, null, null, errors from state
    union all select doc_id, 'edge', src, dst, relation || ' ' || origin, null from edges
    union all select doc_id, 'gap', gap_id, concept, null, null from fresh
    union all select doc_id, 'note', merged_id, string_agg(annotation, ',' order by first), null, null from (
      select m.doc_id, m.merged_id, v.annotation, min(m.o * 10 + v.pos) as first from map m join fx_vnotes v using (doc_id, variant, node_id) group by all) group by all""")
def merge_graphs(spark, sf):
    tables = {t: fixture(spark, sf, t) for t in ("fx_vnodes", "fx_vunits", "fx_vconcepts", "fx_vedges", "fx_vframes", "fx_vnotes")}
    strange = F.when((F.col("doc_id") % 9 == 4) & (F.col("variant") == 2), "other").otherwise("same")
    variants = tables["fx_vnodes"].select("doc_id", "variant").distinct().withColumn("sha256", strange)
    # A document of which one variant has no node still has that variant.
    variants = variants.unionByName(variants.select("doc_id").distinct().select("doc_id", F.explode(F.array(F.lit(1).cast("bigint"), F.lit(2).cast("bigint"))).alias("variant")).withColumn("sha256", strange)).distinct()
    out = g.merge_graphs(variants, unstaged(spark, sf, "fx_units"), tables["fx_vnodes"], tables["fx_vunits"], tables["fx_vconcepts"], tables["fx_vedges"], tables["fx_vframes"], tables["fx_vnotes"])
    part = lambda df, name, a=None, b=None, c=None, n=None: df.select("doc_id", F.lit(name).alias("part"), *[(F.lit(None) if x is None else x if isinstance(x, Column) else F.col(x)).cast(kind).alias(y)
                                                                   for x, y, kind in ((a, "a", "string"), (b, "b", "string"), (c, "c", "string"), (n, "n", "bigint"))])
    notes = out["node_annotations"].groupBy("doc_id", "node_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "annotation"))), lambda x: x["annotation"]), ",").alias("notes"))
    return union_all(part(out["refused"], "refused"), part(out["status"], "status", "status", n="errors"), part(out["edges"], "edge", "src", "dst", F.concat_ws(" ", "relation", "origin")),
                     part(out["gaps"].filter("generated"), "gap", "gap_id", "concept"), part(notes, "note", "node_id", "notes"))


@query("merge_provenance", """select doc_id, variant, 'model-' || cast(variant as string) as model, count(*) as nodes, coalesce(max(e.c), 0) as edges from fx_vnodes
    left join (select doc_id, variant, count(*) as c from fx_vedges group by doc_id, variant) e using (doc_id, variant) group by doc_id, variant""")
def merge_provenance(spark, sf):
    nodes = fixture(spark, sf, "fx_vnodes")
    variants = nodes.select("doc_id", "variant").distinct().withColumn("model", F.concat(F.lit("model-"), F.col("variant").cast("string")))
    issues = nodes.filter("kind = 'gap'").select("doc_id", "variant", F.col("gap_type").alias("category"))
    return g.merge_provenance(variants, nodes, fixture(spark, sf, "fx_vedges"), issues)[0]
