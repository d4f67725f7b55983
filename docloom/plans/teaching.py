"""Queries for section partitions and teaching records."""

from hashlib import sha256

from pyspark.sql import functions as F

from docloom.functions.ordering import cut_lineage
from docloom.functions.text import normalize_label
from docloom.operators import batching
from docloom.operators import ordering as od
from docloom.operators import sections as sec
from docloom.operators import teaching as te
from docloom.plans.corpus import sections_from_units, unit_contexts
from docloom.plans.fixtures import SPARK_BUILDERS, add_table, fixture, oracle, pad, source, stage
from docloom.plans.graph import RELS as RELATION_LIST
from docloom.plans.graph import concept_tables
from docloom.plans.overlay import TYPES as ISSUE_TYPES
from docloom.plans.overlay import label_sql, overlay, records as overlay_records, staged_issues

QUERIES, ORACLES = {}, {}


def query(name, sql=None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return fn
    return register


# --- section partitions ----------------------------------------------------------------

add_table("fx_all_nodes", lambda d: f"""select doc_id, node_ord, node_id, kind, cast(null as string) as derived_from from fx_nodes
    union all select doc_id, node_ord + 100000, {pad('split-', 'node_ord', 6)}, 'claim', node_id from fx_nodes where node_ord % 6 = 0 and kind <> 'gap'""")
add_table("fx_unit_sections", lambda d: "select doc_id, unit_id, section from fx_usec where section > 0")
add_table("fx_members_of", lambda d: """select doc_id, section, node_id, cast(max(n) as bigint) as own_units from (
      select l.doc_id, s.section, l.node_id, count(*) as n from fx_node_units l join fx_unit_sections s using (doc_id, unit_id) group by l.doc_id, s.section, l.node_id
      union all select n.doc_id, s.section, n.node_id, 0 from fx_all_nodes n join fx_node_units l on l.doc_id = n.doc_id and l.node_id = n.derived_from join fx_unit_sections s on s.doc_id = l.doc_id and s.unit_id = l.unit_id
        where n.kind <> 'gap') group by doc_id, section, node_id""")


def unit_sections(spark, sf):
    return stage(spark, sf, "unit_sections", lambda: sec.sections_from_units(fixture(spark, sf, "fx_units"))[1])


def fresh_members(spark, sf):
    return sec.section_nodes(fixture(spark, sf, "fx_all_nodes"), fixture(spark, sf, "fx_node_units"), unit_sections(spark, sf))


def members(spark, sf):
    return stage(spark, sf, "section_members", lambda: fresh_members(spark, sf))


@query("section_nodes", "select * from fx_members_of")
def section_nodes(spark, sf):
    return fresh_members(spark, sf)


add_table("fx_section_edges", lambda d: """select a.doc_id, a.section, e.edge_ord, e.src, e.dst from fx_clean_edges e join fx_members_of a on a.doc_id = e.doc_id and a.node_id = e.src
    join fx_members_of b on b.doc_id = e.doc_id and b.section = a.section and b.node_id = e.dst""")


def clean_edges(spark, sf):
    from docloom.operators.graph import dedupe_edges
    return stage(spark, sf, "clean_edges", lambda: dedupe_edges(fixture(spark, sf, "fx_edges")))


def edges_by_section(spark, sf):
    return sec.section_edges(clean_edges(spark, sf), members(spark, sf))


@query("section_edges", "select doc_id, section, edge_ord, src, dst from fx_section_edges")
def section_edges(spark, sf):
    return edges_by_section(spark, sf).select("doc_id", "section", "edge_ord", "src", "dst")


@query("section_frames", """select m.doc_id, m.section, f.frame_id from (select doc_id, frame_id, count(distinct node_id) as n from fx_frame_nodes group by doc_id, frame_id) f
    join (select x.doc_id, x.frame_id, s.section, count(distinct x.node_id) as n from fx_frame_nodes x join fx_members_of s using (doc_id, node_id) group by x.doc_id, x.frame_id, s.section) m
      on m.doc_id = f.doc_id and m.frame_id = f.frame_id and m.n = f.n""")
def section_frames(spark, sf):
    return sec.section_frames(fixture(spark, sf, "fx_frames"), members(spark, sf)).select("doc_id", "section", "frame_id")


@query("section_concepts", "select distinct m.doc_id, m.section, c.concept from fx_members_of m join fx_node_concepts c using (doc_id, node_id)")
def section_concepts(spark, sf):
    return sec.section_concepts(concept_tables(spark, sf)[0], members(spark, sf))


@query("section_overlay", "select m.doc_id, m.section, o.gap_id, o.label from fx_overlay o join fx_members_of m on m.doc_id = o.doc_id and m.node_id = o.gap_id")
def section_overlay(spark, sf):
    return sec.section_overlay(overlay(spark, sf), members(spark, sf)).select("doc_id", "section", "gap_id", "label")


@query("cross_section_edges", """select e.doc_id, m.section, e.edge_ord, case when e.src = m.node_id then 'outgoing' else 'incoming' end as direction from fx_clean_edges e
    join fx_members_of m on m.doc_id = e.doc_id and (m.node_id = e.src or m.node_id = e.dst)
    where not exists (select 1 from fx_section_edges s where s.doc_id = e.doc_id and s.section = m.section and s.edge_ord = e.edge_ord)""")
def cross_section_edges(spark, sf):
    return sec.cross_section_edges(clean_edges(spark, sf), members(spark, sf)).select("doc_id", "section", "edge_ord", "direction")


@query("section_manifest", """select s.doc_id, s.section, s.title, coalesce(n.c, 0) as node_count, coalesce(e.c, 0) as edge_count, coalesce(i.c, 0) as issue_count, coalesce(o.c, 0) as definition_count from fx_sections s
    left join (select doc_id, section, count(*) as c from fx_members_of group by all) n using (doc_id, section) left join (select doc_id, section, count(*) as c from fx_section_edges group by all) e using (doc_id, section)
    left join (select u.doc_id, s.section, count(distinct u.issue_id) as c from (select doc_id, issue_id, unit_id from fx_open_issue_units union all select doc_id, 'fallback-' || unit_id, unit_id from fx_fallback_issues) u
      join fx_unit_sections s using (doc_id, unit_id) group by all) i using (doc_id, section)
    left join (select m.doc_id, m.section, count(*) as c from fx_overlay o join fx_members_of m on m.doc_id = o.doc_id and m.node_id = o.gap_id group by all) o using (doc_id, section)""")
def section_manifest(spark, sf):
    issues = staged_issues(spark, sf)[1].join(unit_sections(spark, sf).select("doc_id", "unit_id", "section"), ["doc_id", "unit_id"]).select("doc_id", "section", "issue_id").distinct()
    return sec.section_manifest(sections_from_units(spark, sf), members(spark, sf), edges_by_section(spark, sf), issues, sec.section_overlay(overlay(spark, sf), members(spark, sf)))


# --- teaching records ------------------------------------------------------------------

add_table("fx_tnodes", lambda d: """select doc_id, node_ord, node_id, kind, text, need, gap_type, resolution_status, prior_resolver is not null as resolved, (doc_id + node_ord) % 10 = 3 and kind <> 'gap' as coverage_fallback,
    (doc_id + node_ord) % 6 = 1 and kind <> 'gap' as repair_fallback, cast(case when node_ord % 5 = 2 then null else density_score end as double) as density_score from fx_dscored""")
RAW = r"least(1.0, cast(len(regexp_extract_all({x}, '[\p{{L}}\p{{N}}][\p{{L}}\p{{N}}_''-]*')) as double) / 32)"
add_table("fx_teach", lambda d: f"""select *, kind not in ('code', 'equation') and density >= 0.75 as dense from (
    select n.doc_id, n.node_ord as record_ord, 'teach-' || n.node_id as record_id, n.node_id as source_node_id, c.chapter, n.kind, n.text as source_anchor,
      coalesce(n.density_score, {RAW.format(x='n.text')}) as density, case when n.density_score is null then 'word_count_fallback' else 'graph' end as density_source
    from fx_tnodes n join fx_chapters c using (doc_id, node_id) where n.kind <> 'gap')""")


def chapters(spark, sf):
    return stage(spark, sf, "teaching_chapters", lambda: sec.chapter_of(fixture(spark, sf, "fx_node_units"), unit_contexts(spark, sf), sec.CHAPTER_OR_PART, True))


def fresh_records(spark, sf):
    return te.build_teaching_records(fixture(spark, sf, "fx_tnodes"), fixture(spark, sf, "fx_node_units"), chapters(spark, sf))


def built(spark, sf):
    records = stage(spark, sf, "teaching_records", lambda: fresh_records(spark, sf)[0])
    return records, stage(spark, sf, "teaching_units", lambda: te.source_units(records))


UNSCOPED = sha256(b"Unscoped").hexdigest()[:32].upper()


def chapter_tables(spark, sf):
    """(doc_id, node_id, chapter) and (doc_id, chapter, name): a chapter goes by its digest, as names are as long as texts."""
    def build(i):
        table = sec.chapter_digests(fixture(spark, sf, "fx_node_units"), unit_contexts(spark, sf), sec.CHAPTER_OR_PART, True)[i]
        return table.withColumn("_k", F.when(F.hex("_k") == UNSCOPED, "Unscoped").otherwise(F.hex("_k")))
    return (stage(spark, sf, "chapter_digests", lambda: build(0)).withColumnRenamed("_k", "chapter"),
            stage(spark, sf, "chapter_names", lambda: build(1)).withColumnsRenamed({"chapter": "name", "_k": "chapter"}))


def chapter_name():
    return F.coalesce("name", F.lit("Unscoped")).alias("chapter")


def keyed_records(spark, sf):
    """The records with the digests of their chapters; they hold texts, which a reader that needs none prunes."""
    return te.build_teaching_records(fixture(spark, sf, "fx_tnodes"), fixture(spark, sf, "fx_node_units"), chapter_tables(spark, sf)[0])[0]


def record_keys(spark, sf):
    """All of the records but their texts and the names of their chapters."""
    return stage(spark, sf, "record_keys", lambda: keyed_records(spark, sf).drop("source_anchor"))


def plain_units(keys):
    """One unit of each record that is not dense; its text is the record's own and not repeated."""
    return te.source_units(keys.withColumn("source_anchor", F.lit(None).cast("string")))


def anchors(spark, sf):
    """(doc_id, record_id, source_anchor) of every node that may become a record."""
    return fixture(spark, sf, "fx_tnodes").filter("kind <> 'gap'").select("doc_id", F.concat(F.lit("teach-"), "node_id").alias("record_id"), F.col("text").alias("source_anchor"))


@query("build_teaching_records", f"""select t.doc_id, t.record_id, t.chapter, t.density as density_score, t.density_source, case when dense then 'expansion_required' else 'source_ready' end as status, u.unit_id
    from fx_teach t left join (select doc_id, record_id, {pad('teaching-unit-', 'row_number() over (partition by doc_id order by record_ord)', 7)} as unit_id from fx_teach where not dense) u using (doc_id, record_id)""")
def build_teaching_records(spark, sf):
    records, units = fresh_records(spark, sf)
    return (records.select("doc_id", "record_id", "chapter", "density_score", "density_source", "status")
            .join(units.select("doc_id", "record_id", "unit_id"), ["doc_id", "record_id"], "left"))


@query("teaching_dependencies", """select e.doc_id, 'teach-' || src as src, 'teach-' || dst as dst, relation from fx_edges e join fx_nodes a on a.doc_id = e.doc_id and a.node_id = e.src and a.kind <> 'gap'
    join fx_nodes b on b.doc_id = e.doc_id and b.node_id = e.dst and b.kind <> 'gap'""")
def teaching_dependencies(spark, sf):
    return te.teaching_dependencies(fixture(spark, sf, "fx_edges"), built(spark, sf)[0]).drop("reason")


# The dependents of a definition gap: the nodes next to it.
add_table("fx_dependents", lambda d: "select g.doc_id, g.node_id as gap_id, n.node_id from fx_nodes g join fx_nodes n on n.doc_id = g.doc_id and n.node_ord between g.node_ord + 1 and g.node_ord + 2 where g.kind = 'gap'")


@query("overlay_definition_records", f"""with d as (select r.*, row_number() over (partition by r.doc_id order by r.node_ord) as p from fx_records r where candidate_definition is not null),
    m as (select doc_id, max(record_ord) as last, count(*) filter (where not dense) as made from fx_teach group by doc_id)
    select d.doc_id, 'record' as part, 'teach-definition-' || gap_id as a, {pad('teaching-unit-', 'coalesce(made, 0) + p', 7)} as b,
      case when status = 'external_definition' then 'externally_verified' when status in ('source_recovery', 'already_defined') then 'source_grounded' else 'citation_needed' end as c, coalesce(last, 0) + p as n
    from d left join m using (doc_id)
    union all select d.doc_id, 'dependency', 'teach-definition-' || d.gap_id, 'teach-' || x.node_id, x.node_id || ' requires ' || d.label, cast(null as bigint) from d join fx_dependents x on x.doc_id = d.doc_id and x.gap_id = d.gap_id
      join fx_teach t on t.doc_id = x.doc_id and t.source_node_id = x.node_id""")
def overlay_definition_records(spark, sf):
    records, units = built(spark, sf)
    new, new_units, links = te.overlay_definition_records(overlay_records(spark, sf), fixture(spark, sf, "fx_dependents"), records, units)
    rows = new.select("doc_id", "record_id", "record_ord").join(new_units, ["doc_id", "record_id"]).select(
        "doc_id", F.lit("record").alias("part"), F.col("record_id").alias("a"), F.col("unit_id").alias("b"), F.col("epistemic_status").alias("c"), F.col("record_ord").alias("n"))
    return rows.unionByName(links.select("doc_id", F.lit("dependency").alias("part"), F.col("src").alias("a"), F.col("dst").alias("b"), F.col("reason").alias("c"), F.lit(None).cast("bigint").alias("n")))


@query("teaching_gaps", "select n.doc_id, n.node_id as gap_id, c.chapter, n.gap_type, n.resolution_status from fx_tnodes n join fx_chapters c using (doc_id, node_id) where n.kind = 'gap'")
def teaching_gaps(spark, sf):
    return te.teaching_gaps(fixture(spark, sf, "fx_tnodes"), chapters(spark, sf)).select("doc_id", "gap_id", "chapter", "gap_type", "resolution_status")


@query("teaching_summary", """select doc_id, count(*) as records, cast(count_if(dense) as bigint) as dense, cast(count_if(not dense) as bigint) as ready, cast(count_if(dense) as bigint) as pending,
      cast(count_if(not dense) as bigint) as units, coalesce(max(g.c), 0) as gaps from fx_teach left join (select doc_id, count(*) as c from fx_nodes where kind = 'gap' group by doc_id) g using (doc_id) group by doc_id""")
def teaching_summary(spark, sf):
    records, units = built(spark, sf)
    return te.teaching_summary(records, units, te.teaching_gaps(fixture(spark, sf, "fx_tnodes"), chapters(spark, sf)))


# Expansion answers for every pending record, some of them wrong.
add_table("fx_requests", lambda d: """select t.doc_id, t.record_ord, t.record_id, t.source_node_id, t.source_anchor as text, cast(2 as bigint) as minimum_units,
      cast(floor((row_number() over (partition by t.doc_id order by t.record_ord) - 1) / 8) + 1 as bigint) as batch_no from fx_teach t where t.dense""")
SPARK_BUILDERS["fx_requests"] = lambda spark, sf: batching.plan_batches(keyed_records(spark, sf).filter("dense").select(
    "doc_id", "record_ord", "record_id", "source_node_id", F.col("source_anchor").alias("text"), "minimum_units"), 8, ["doc_id"], ["record_ord"])


def _expansion_units(d):
    token = d.at(f"regexp_extract_all(lower(text), {d.rx('[' + chr(92) + 'p{L}]{4,}')}, 0)", "2 + record_ord % 3")
    # Kept apart: the third unit asks for concepts, two of them shared by many records of a document.
    rows = ((1, "'statement'", "'source'", d.arr("' Idea 1 '", "'Idea 1'")), (2, "case when record_ord % 43 = 0 then 'poem' else 'mechanism' end", "case when record_ord % 37 = 0 then 'common_knowledge' else 'source' end", d.no_strings()),
            (3, "'prerequisite'", "'common_knowledge'", d.arr("'Idea ' || cast(record_ord % 3 as string)", f"coalesce({token}, 'none')", "'idea  1'", "'fourth'", "'fifth'")))
    return " union all ".join(
        f"select doc_id, batch_no, record_ord as item_pos, record_id, cast({pos} as bigint) as pos, {role} as role, {basis} as basis, ' part {pos} of ' || record_id || ' ' as text, {requires} as requires, "
        f"record_ord % 4 = 0 as citation_required from fx_requests where (doc_id + record_ord) % 41 <> 0" for pos, role, basis, requires in rows)


add_table("fx_expansions", _expansion_units)
add_table("fx_expanded_batches", lambda d: """select r.doc_id, r.batch_no from (select doc_id, batch_no, count(*) as n from fx_requests group by all) r join (
      select doc_id, batch_no, count(distinct record_id) as n, bool_and(role <> 'poem') as ok, min(s) as s from (
        select *, count(*) filter (where basis = 'source') over (partition by doc_id, record_id) as s from fx_expansions) group by doc_id, batch_no) i using (doc_id, batch_no) where i.n = r.n and i.ok and i.s >= 2""")


def accepted_units(spark, sf):
    return te.validate_expansion(fixture(spark, sf, "fx_expansions"), fixture(spark, sf, "fx_requests"))


@query("validate_expansion", """select doc_id, batch_no, record_id, pos, trim(text) as text, 'accepted' as outcome from fx_expansions join fx_expanded_batches using (doc_id, batch_no)
    union all select distinct doc_id, batch_no, null, cast(null as bigint), null, 'failed' from fx_requests r where not exists (select 1 from fx_expanded_batches b where b.doc_id = r.doc_id and b.batch_no = r.batch_no)""")
def validate_expansion(spark, sf):
    good, failed = accepted_units(spark, sf)
    none = F.lit(None).cast("string")
    return good.select("doc_id", "batch_no", "record_id", "pos", "text", F.lit("accepted").alias("outcome")).unionByName(
        failed.select("doc_id", "batch_no", none.alias("record_id"), F.lit(None).cast("bigint").alias("pos"), none.alias("text"), F.lit("failed").alias("outcome")))


add_table("fx_placed", lambda d: """select u.*, row_number() over (partition by doc_id order by batch_no, item_pos, pos) as p from fx_expansions u join fx_expanded_batches using (doc_id, batch_no)""")
add_table("fx_wanted", lambda d: f"""select doc_id, key, min_by(record_id, p * 10 + q) as record_id, min_by(concept, p * 10 + q) as concept from (
      select *, {label_sql('concept')} as key from (
        select doc_id, record_id, p, unnest(range(1, len(r) + 1)) as q, unnest(r) as concept from (
          select doc_id, record_id, p, case when pos = 3 then [trim(requires[1]), trim(requires[2]), trim(requires[3])] when pos = 1 then [trim(requires[1])] else [] end as r from fx_placed))) w
    where key <> '' and not exists (select 1 from fx_node_concepts c where c.doc_id = w.doc_id and c.role = 'defines' and c.concept = w.key) group by doc_id, key""")
add_table("fx_generated", lambda d: """select w.*, t.chapter, 'teach-generated-' || substr(sha256(t.chapter || chr(0) || w.key), 1, 16) as new_id from fx_wanted w join fx_teach t on t.doc_id = w.doc_id and t.record_id = w.record_id""")


def known(spark, sf):
    defines = fixture(spark, sf, "fx_node_concepts").filter("role = 'defines'")
    return defines.select("doc_id", normalize_label(F.col("concept")).alias("concept")).distinct()


@query("expand_prerequisites", """select t.doc_id, 'record' as part, t.record_id as a, case when x.record_id is not null then 'expanded' when dense then 'expansion_required' else 'source_ready' end as b, t.chapter as c
      from fx_teach t left join (select distinct doc_id, record_id from fx_placed) x using (doc_id, record_id)
    union all select doc_id, 'record', new_id, 'expansion_required', chapter from fx_generated union all select doc_id, 'dependency', new_id, record_id, record_id || ' requires ' || concept from fx_generated
    union all select p.doc_id, 'unit', p.record_id, 'teaching-unit-' || lpad(cast(coalesce(m.made, 0) + p.p as string), 7, '0'), trim(p.text) from fx_placed p
      left join (select doc_id, count(*) as made from fx_teach where not dense group by doc_id) m using (doc_id)""")
def expand_prerequisites(spark, sf):
    records, units = built(spark, sf)
    out = te.expand_prerequisites(records.withColumn("expansion_depth", F.lit(0).cast("bigint")), known(spark, sf), units, accepted_units(spark, sf)[0], 0)
    row = lambda df, part, a, b, c: df.select("doc_id", F.lit(part).alias("part"), F.col(a).alias("a"), F.col(b).alias("b"), F.col(c).alias("c"))
    return row(out["records"], "record", "record_id", "status", "chapter").unionByName(row(out["dependencies"], "dependency", "src", "dst", "reason")).unionByName(
        row(out["units"], "unit", "record_id", "unit_id", "text"))


@query("expansion_frontier", """select doc_id, status, depth, count(*) as records from (
      select t.doc_id, case when x.record_id is not null then 'expanded' when dense then 'expansion_required' else 'source_ready' end as status, cast(0 as bigint) as depth
      from fx_teach t left join (select distinct doc_id, record_id from fx_placed) x using (doc_id, record_id)
      union all select doc_id, 'expansion_required', 1 from fx_generated) group by doc_id, status, depth""")
def expansion_frontier(spark, sf):
    records = record_keys(spark, sf)  # what is counted needs no texts
    responses = fixture(spark, sf, "fx_expansions").withColumn("depth", F.lit(0))
    out = te.expansion_frontier(records, known(spark, sf), plain_units(records).drop("text"), responses, 1)
    return out["records"].groupBy("doc_id", "status", F.col("expansion_depth").alias("depth")).agg(F.count(F.lit(1)).alias("records"))


# Units of which some only navigate.
add_table("fx_nav_units", lambda d: """select doc_id, unit_ord, unit_id, kind, start_line, case when unit_ord % 7 = 3 then '- [' || translate(text, '[]', '  ') || '](#part-' || cast(unit_ord as string) || ')'
    when unit_ord % 7 = 5 then '[About us](/about)' when unit_ord % 21 = 6 then ' Dark mode ' else text end as text from fx_units""")
# What the derived lines use to navigate; an anchor list entry, a link and a switch.
NAVIGATION = (r"(?m)^-\s*\[[^\]]+\]\(#[^)]+\)\s*$", r"(?i)\A\[about us\]\(", r"(?i)\Adark mode\z")
NAV = r"regexp_matches(trim(text), '(?m)^-\s*\[[^\]]+\]\(#[^)]+\)\s*$') or regexp_matches(trim(text), '(?i)^\[about us\]\(') or lower(trim(text)) = 'dark mode'"
add_table("fx_allowed", lambda d: f"""select u.doc_id, u.unit_id from fx_nav_units u left join (select doc_id, min(start_line) as first_line from fx_nav_units where kind = 'heading' and contains(lower(text), 'chapter 3') group by doc_id) s using (doc_id)
    where not ({NAV}) and start_line >= coalesce(first_line, 1)""")
add_table("fx_touched", lambda d: """select l.doc_id, l.node_id, l.unit_id from fx_node_units l join fx_allowed using (doc_id, unit_id) join fx_tnodes n on n.doc_id = l.doc_id and n.node_id = l.node_id
    where n.kind not in ('gap', 'source') and not n.coverage_fallback and not n.repair_fallback""")
add_table("fx_retained", lambda d: """select distinct doc_id, 'teach-' || node_id as record_id from fx_touched union
    select doc_id, 'teach-' || min_by(node_id, node_ord) from (select l.doc_id, l.unit_id, l.node_id, l.node_ord from fx_node_units l join fx_allowed using (doc_id, unit_id)
      join fx_tnodes n on n.doc_id = l.doc_id and n.node_id = l.node_id where n.kind = 'source' and not exists (select 1 from fx_touched t where t.doc_id = l.doc_id and t.unit_id = l.unit_id)) group by doc_id, unit_id""")


@query("navigation_units", f"select doc_id, unit_id from fx_nav_units where {NAV}")
def navigation_units(spark, sf):
    return te.navigation_units(fixture(spark, sf, "fx_nav_units"), NAVIGATION).select("doc_id", "unit_id")


def retained(spark, sf):
    return te.retained_records(fixture(spark, sf, "fx_nav_units"), fixture(spark, sf, "fx_tnodes"), fixture(spark, sf, "fx_node_units"), built(spark, sf)[0], NAVIGATION, "Chapter 3")


@query("retained_records", "select * from fx_retained")
def retained_records(spark, sf):
    return retained(spark, sf)


# Dependencies inside runs of eight lines, some of them backward, so that cycles and held records occur.
add_table("fx_deps", lambda d: """select a.doc_id, 'teach-' || a.node_id as src, 'teach-' || b.node_id as dst from fx_nodes a join fx_nodes b on b.doc_id = a.doc_id and b.node_ord - a.node_ord in (1, 3)
      and floor(a.node_ord / 8) = floor(b.node_ord / 8) where (a.node_ord + b.node_ord) % 5 <> 0 and a.kind <> 'gap' and b.kind <> 'gap'
    union all select a.doc_id, 'teach-' || b.node_id, 'teach-' || a.node_id from fx_nodes a join fx_nodes b on b.doc_id = a.doc_id and b.node_ord - a.node_ord in (2, 5)
      and floor(a.node_ord / 8) = floor(b.node_ord / 8) where a.node_ord % 3 = 0 and a.kind <> 'gap' and b.kind <> 'gap'""")


@query("dependency_levels")
def dependency_levels(spark, sf):
    return od.dependency_levels(built(spark, sf)[0], fixture(spark, sf, "fx_deps"))


# Runs hold at most eight records, so a walk of eight steps has met a cycle.
ORACLES["dependency_levels"] = "with recursive " + oracle("""with walks as (select doc_id, record_id, cast(0 as bigint) as level from fx_teach
    union select w.doc_id, d.dst, w.level + 1 from walks w join fx_deps d on d.doc_id = w.doc_id and d.src = w.record_id where w.level < 8)
    select doc_id, record_id, case when max(level) < 8 then max(level) end as level from walks group by doc_id, record_id""").lstrip()[5:]


@query("prune_reachable")
def prune_reachable(spark, sf):
    kept, inner = pruned(spark, sf, od.GROUP_LIMIT)
    return (kept.select("doc_id", F.lit("record").alias("part"), F.col("record_id").alias("a"), F.lit(None).cast("string").alias("b"))
            .unionByName(inner.select("doc_id", F.lit("dependency").alias("part"), F.col("src").alias("a"), F.col("dst").alias("b"))))


ORACLES["prune_reachable"] = "with recursive " + oracle("""with kept as (select doc_id, 'teach-' || node_id as record_id from fx_nodes where node_ord % 6 = 0 and kind <> 'gap'
    union select d.doc_id, d.src from kept k join fx_deps d on d.doc_id = k.doc_id and d.dst = k.record_id)
    select doc_id, 'record' as part, record_id as a, null as b from kept
    union all select d.doc_id, 'dependency', src, dst from fx_deps d join kept a on a.doc_id = d.doc_id and a.record_id = d.src join kept b on b.doc_id = d.doc_id and b.record_id = d.dst""").lstrip()[5:]


# The same, with groups so small a limit that every document takes the way of large ones.
@query("levels_by_doubling")
def levels_by_doubling(spark, sf):
    return od.dependency_levels(built(spark, sf)[0], fixture(spark, sf, "fx_deps"), group_limit=4)


ORACLES["levels_by_doubling"] = ORACLES["dependency_levels"]


def pruned(spark, sf, limit):
    seeds = fixture(spark, sf, "fx_nodes").filter("node_ord % 6 = 0 and kind <> 'gap'").select("doc_id", F.concat(F.lit("teach-"), "node_id").alias("record_id"))
    return od.prune_reachable(built(spark, sf)[0], fixture(spark, sf, "fx_deps"), seeds, limit)


@query("prune_summary")
def prune_summary(spark, sf):
    records, units = built(spark, sf)
    return od.prune_summary(records, pruned(spark, sf, 4)[0], units)


ORACLES["prune_summary"] = "with recursive " + oracle("""with kept as (select doc_id, 'teach-' || node_id as record_id from fx_nodes where node_ord % 6 = 0 and kind <> 'gap'
    union select d.doc_id, d.src from kept k join fx_deps d on d.doc_id = k.doc_id and d.dst = k.record_id)
    select doc_id, count(*) as before, count(k.record_id) as records, count(k.record_id) as source_records, cast(0 as bigint) as generated_prerequisites, count(k.record_id) filter (where dense) as pending,
      cast(0 as bigint) as unresolved_prerequisites, count(k.record_id) filter (where not dense) as units, count(*) - count(k.record_id) as pruned
    from fx_teach t left join kept k using (doc_id, record_id) group by doc_id""").lstrip()[5:]


@query("topological_order")
def topological_order(spark, sf):
    order = od.topological_order(record_keys(spark, sf), fixture(spark, sf, "fx_deps"))
    return order.join(chapter_tables(spark, sf)[1], ["doc_id", "chapter"], "left").select("doc_id", chapter_name(), "record_id", "pos")


# One record per step: the smallest index whose predecessors have all left; what never leaves follows in order.
ORACLES["topological_order"] = "with recursive " + oracle("""with p as (select t.doc_id, t.chapter, t.record_id, t.record_ord as idx, coalesce(list_distinct(list(s.record_ord) filter (where s.record_ord is not null)), []) as preds
      from fx_teach t left join fx_deps d on d.doc_id = t.doc_id and d.dst = t.record_id and d.src <> d.dst
      left join fx_teach s on s.doc_id = d.doc_id and s.record_id = d.src and s.chapter = t.chapter group by t.doc_id, t.chapter, t.record_id, t.record_ord),
    walk as (select distinct doc_id, chapter, cast([] as bigint[]) as gone, cast(0 as bigint) as n from p
      union all select w.doc_id, w.chapter, list_append(w.gone, min(p.idx)), w.n + 1 from walk w join p on p.doc_id = w.doc_id and p.chapter = w.chapter
      where not list_contains(w.gone, p.idx) and list_has_all(w.gone, p.preds) group by w.doc_id, w.chapter, w.gone, w.n)
    select p.doc_id, p.chapter, p.record_id, row_number() over (partition by p.doc_id, p.chapter order by case when list_contains(gone, idx) then list_position(gone, idx) else 1000000 + idx end) as pos
    from p join (select doc_id, chapter, max_by(gone, n) as gone from walk group by doc_id, chapter) w using (doc_id, chapter)""").lstrip()[5:]


add_table("fx_section_order", lambda d: "select doc_id, chapter, row_number() over (partition by doc_id order by min(record_ord)) as pos from fx_teach group by doc_id, chapter")


@query("section_order", "select * from fx_section_order")
def section_order(spark, sf):
    return te.section_order(built(spark, sf)[0])


# Forward dependencies only: their exact order is the original one, which SQL can state.
add_table("fx_forward", lambda d: "select * from fx_deps where src < dst")


def unit_lists(spark, sf, prefix):
    rows = F.transform(F.array_sort(F.collect_list(F.struct("pos", "unit_id"))), lambda x: x["unit_id"])
    return fixture(spark, sf, "fx_node_units").groupBy("doc_id", F.concat(F.lit(prefix), "node_id").alias("id")).agg(rows.alias("source_unit_ids"))


def document_parts(spark, sf):
    records, names = record_keys(spark, sf), chapter_tables(spark, sf)[1]
    order = od.topological_order(records.select("doc_id", "record_id", "record_ord", "chapter"), fixture(spark, sf, "fx_forward"))
    gaps = fixture(spark, sf, "fx_tnodes").filter("kind = 'gap'").withColumnRenamed("node_id", "gap_id")
    return te.document_parts(records, order, unit_lists(spark, sf, "teach-"), plain_units(records), gaps, unit_lists(spark, sf, ""), "Guide",
                             anchors=anchors(spark, sf), names=names.select("doc_id", "chapter", "name"))


JSON = "cast(to_json({x}) as varchar)"
ASSEMBLED = """select doc_id, string_agg(text, chr(10) || chr(10) order by a, b, c) || chr(10) as text from (
      select distinct doc_id, cast(0 as bigint) as a, cast(0 as bigint) as b, 0 as c, '# Guide' as text from fx_teach
      union all select doc_id, pos, 0, 0, '## ' || chapter from fx_section_order
      union all select doc_id, a, record_ord, 0, '<!-- docloom:source ' || replace(cast(to_json(struct_pack(id := record_id, sourceNodeId := source_node_id, sourceUnitIds := units, sourceAnchor := source_anchor,
        status := case when dense then 'expansion_required' else 'source_ready' end)) as varchar), '--', '—') || ' -->' from listed
      union all select doc_id, a, record_ord, 1, case when dense then '<!-- docloom:issue ' || replace(cast(to_json(struct_pack(id := 'issue-' || record_id, type := 'unexpanded_teaching_record', status := 'open',
        action := 'enrich_or_preserve', need := 'Expand ' || source_anchor, sourceUnitIds := units)) as varchar), '--', '—') || ' -->' else source_anchor end from listed
      union all select n.doc_id, 1125899906842624, n.node_ord, 0, '<!-- docloom:issue ' || replace(cast(to_json(struct_pack(id := n.node_id, type := gap_type, status := 'open', action := 'enrich_or_preserve', need := need, sourceUnitIds := u.units)) as varchar), '--', '—') || ' -->'
        from fx_tnodes n join unit_lists u using (doc_id, node_id) where kind = 'gap' and resolution_status is null and not resolved) group by doc_id having bool_or(a = 0)"""
ASSEMBLED = f"""with unit_lists as (select doc_id, node_id, list(unit_id order by pos) as units from fx_node_units group by doc_id, node_id),
    listed as (select t.*, s.pos as a, u.units from fx_teach t join fx_section_order s using (doc_id, chapter) join unit_lists u on u.doc_id = t.doc_id and u.node_id = t.source_node_id) {ASSEMBLED}"""


@query("assemble_document", ASSEMBLED)
def assemble_document(spark, sf):
    parts = document_parts(spark, sf)
    return te.assemble_document(parts.join(record_keys(spark, sf).select("doc_id").distinct(), "doc_id", "left_semi"))


@query("assembly_report", rf"""select t.doc_id, count(*) as records, count(*) as source_records, cast(count_if(not dense) as bigint) as mapped, cast(count_if(dense) as bigint) as dense_records, cast(0 as bigint) as expanded_dense,
      cast(0 as bigint) as generated, cast(count_if(dense) as bigint) as pending, cast(count_if(not dense) as bigint) as units, max(w.words) as source_words, max(a.words) as output_words, cast(0 as bigint) as missing_labels from fx_teach t
    join (select doc_id, cast({{count}} as bigint) as words from documents) w using (doc_id)
    join (select doc_id, cast({{count}} as bigint) as words from (select doc_id, regexp_replace(text, '<!--[\s\S]*?-->', '', 'g') as text from ({{assembled}}))) a using (doc_id) group by t.doc_id""".format(
        count=r"len(regexp_extract_all(text, '[\p{L}\p{N}][\p{L}\p{N}_''-]*'))", assembled=ASSEMBLED))
def assembly_report(spark, sf):
    records = record_keys(spark, sf)
    documents = te.assemble_split_document(document_parts(spark, sf))
    out = te.assembly_report(records, plain_units(records), documents, source(spark, sf, "documents"), anchors=anchors(spark, sf))
    return out.select("doc_id", "records", "source_records", "mapped", "dense_records", "expanded_dense", "generated", "pending", "units", "source_words", "output_words", "missing_labels")


# --- sections as graphs of their own -----------------------------------------------------

add_table("fx_section_links", lambda d: "select l.doc_id, s.section, l.node_id, l.node_ord, l.pos, l.unit_id from fx_node_units l join fx_unit_sections s using (doc_id, unit_id)")


@query("section_partitions", f"""with gaps as (select n.doc_id, l.section, n.node_id, n.node_ord, n.gap_type, string_agg(l.unit_id, ',' order by l.pos) as units from fx_issue_nodes n join fx_section_links l using (doc_id, node_id)
      where n.kind = 'gap' and n.gap_type in ({ISSUE_TYPES}) and n.resolution_status is null and not n.resolved group by all),
    open_issues as (select doc_id, section, gap_type, units, min_by(node_id, node_ord) as issue_id from gaps group by all),
    open_units as (select distinct i.doc_id, i.section, l.unit_id from open_issues i join fx_section_links l on l.doc_id = i.doc_id and l.section = i.section and l.node_id = i.issue_id),
    repaired as (select distinct l.doc_id, l.section, l.unit_id from fx_section_links l join fx_issue_nodes n using (doc_id, node_id) where n.repair_fallback and n.kind <> 'gap'),
    late as (select * from repaired anti join open_units using (doc_id, section, unit_id)),
    issue_n as (select doc_id, section, count(*) as n from (select doc_id, section from open_issues union all select doc_id, section from late) group by all),
    seen as (select l.doc_id, l.section, l.unit_id, bool_or(n.kind <> 'gap') as covered, bool_or(coalesce(n.text = u.text, false)) as verbatim from fx_section_links l join fx_nodes n using (doc_id, node_id)
      join fx_units u on u.doc_id = l.doc_id and u.unit_id = l.unit_id group by all),
    unit_state as (select u.doc_id, s.section, u.unit_id, u.kind, u.end_line, coalesce(x.covered, false) as covered, coalesce(x.verbatim, false) as verbatim,
        case when o.unit_id is not null or f.unit_id is not null then 'unresolved' when r.unit_id is not null then 'source_fallback' when x.covered then 'extracted' else 'source_fallback' end as status
      from fx_units u join fx_unit_sections s using (doc_id, unit_id) left join seen x using (doc_id, section, unit_id) left join open_units o using (doc_id, section, unit_id) left join late f using (doc_id, section, unit_id)
      left join repaired r using (doc_id, section, unit_id)),
    own_nodes as (select distinct doc_id, section, node_id from fx_section_links),
    own_edges as (select e.doc_id, a.section, e.relation from fx_clean_edges e join own_nodes a on a.doc_id = e.doc_id and a.node_id = e.src join own_nodes b on b.doc_id = e.doc_id and b.section = a.section and b.node_id = e.dst),
    own_frames as (select x.doc_id, s.section, x.frame_id from (select distinct doc_id, frame_id, node_id, n from (select *, count(distinct node_id) over (partition by doc_id, frame_id) as n from fx_frame_nodes)) x join own_nodes s using (doc_id, node_id)
      group by x.doc_id, s.section, x.frame_id having count(distinct x.node_id) = max(x.n)),
    faults as (select doc_id, section from unit_state where not covered union all select doc_id, section from unit_state where kind in ('code', 'equation') and not verbatim
      union all select doc_id, section from own_edges where relation not in ({RELATION_LIST})
      union all select o.doc_id, o.section from own_frames o join fx_frames f using (doc_id, frame_id) join fx_nodes n on n.doc_id = f.doc_id and n.node_id = f.warrant_gap where n.kind <> 'gap'
      union all select o.doc_id, o.section from own_frames o join fx_frames f using (doc_id, frame_id) where len(f.evidence) = 0)
    select s.doc_id, s.section, s.title, n.node_count, coalesce(e.n, 0) as edge_count, coalesce(i.n, 0) as issue_count, case when f.n > 0 then 'failed' when n.gap_count > 0 then 'complete_with_gaps' else 'complete' end as status, coalesce(f.n, 0) as errors,
      u.extracted, u.source_fallback, u.unresolved, u.last_line - s.start_line + 1 as last_line
    from fx_sections s join (select doc_id, section, count(*) as node_count, count(*) filter (where kind = 'gap') as gap_count from own_nodes join fx_nodes using (doc_id, node_id) group by all) n using (doc_id, section)
    left join (select doc_id, section, count(*) as n from own_edges group by all) e using (doc_id, section) left join issue_n i using (doc_id, section) left join (select doc_id, section, count(*) as n from faults group by all) f using (doc_id, section)
    join (select doc_id, section, count(*) filter (where status = 'extracted') as extracted, count(*) filter (where status = 'source_fallback') as source_fallback, count(*) filter (where status = 'unresolved') as unresolved,
      max(end_line) as last_line from unit_state group by all) u using (doc_id, section)""")
def section_partitions(spark, sf):
    from docloom.operators import annotate as ann
    from docloom.operators.graph import validate_graph
    sections, placed = sections_from_units(spark, sf), unit_sections(spark, sf)
    states = fixture(spark, sf, "fx_issue_nodes").select("doc_id", "node_id", "resolution_status", "resolved", "repair_fallback")
    nodes = fixture(spark, sf, "fx_nodes").drop("repair_fallback").join(states, ["doc_id", "node_id"])
    own = sec.section_nodes(nodes.withColumn("derived_from", F.lit(None).cast("string")), fixture(spark, sf, "fx_node_units"), placed)
    t = sec.section_tables(fixture(spark, sf, "fx_units"), nodes, fixture(spark, sf, "fx_node_units"), clean_edges(spark, sf), fixture(spark, sf, "fx_frames"), sections, placed, own)
    t = {name: cut_lineage(df) for name, df in t.items()}
    status = validate_graph(t["units"], t["nodes"], t["node_units"], t["edges"], t["frames"])[1]
    issues, issue_units = ann.issue_annotations(t["nodes"], t["node_units"], t["units"])
    summary = ann.graded_coverage(t["nodes"], t["node_units"], t["units"], cut_lineage(issue_units))[1]
    plain = lambda df, *columns: df.select("doc_id.doc_id", "doc_id.section", *columns)
    nothing = own.limit(0).select("doc_id", "section")
    manifest = sec.section_manifest(sections, own, plain(t["edges"], "edge_ord"), plain(issues, "issue_id"), nothing, plain(status, "status", "errors")).drop("definition_count")
    last = plain(t["units"], "end_line").groupBy("doc_id", "section").agg(F.max("end_line").alias("last_line"))
    return manifest.join(plain(summary, "extracted", "source_fallback", "unresolved"), ["doc_id", "section"]).join(last, ["doc_id", "section"]).filter("node_count > 0")
