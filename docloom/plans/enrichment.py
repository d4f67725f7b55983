"""Queries for density, decomposition, injection and gap resolution."""

from pyspark.sql import functions as F

from docloom.functions import text as tx
from docloom.operators import batching
from docloom.operators import enrichment as en
from docloom.plans.corpus import SCORE_ITEMS
from docloom.plans.fixtures import add_table, fixture, oracle, pad, stage, unstaged

QUERIES, ORACLES = {}, {}


def query(name, sql):
    def register(fn):
        QUERIES[name], ORACLES[name] = fn, oracle(sql)
        return fn
    return register


WORDS = r"len(regexp_extract_all({x}, '[\p{{L}}\p{{N}}][\p{{L}}\p{{N}}_''-]*'))"


def words(x):
    return WORDS.format(x=x)


def clamp(x):
    return f"case when {x} is not null then round(least(1.0, greatest(0.0, cast({x} as double))), 3) end"


def surface(x):
    return f"round(least(1.0, cast({words(x)} as double) / 32), 3)"


@query("word_count", f"select doc_id, line, cast({words('text')} as bigint) as words from fx_lines")
def word_count(spark, sf):
    return fixture(spark, sf, "fx_lines").select("doc_id", "line", tx.word_count(F.col("text")).cast("bigint").alias("words"))


@query("surface_density", f"select doc_id, line, {surface('text')} as density from fx_lines")
def surface_density(spark, sf):
    return fixture(spark, sf, "fx_lines").select("doc_id", "line", tx.surface_density(F.col("text")).alias("density"))


@query("clamp_score", f"""select event_id, {clamp("value / 50 - 0.5")} as score from events""")
def clamp_score(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    return events.select("event_id", tx.clamp_score(F.col("value") / 50 - 0.5).alias("score"))


@query("scorable_nodes", "select doc_id, node_id from fx_nodes where kind not in ('gap', 'code', 'equation') and trim(text) <> ''")
def scorable_nodes(spark, sf):
    return en.scorable_nodes(fixture(spark, sf, "fx_nodes")).select("doc_id", "node_id")


SCORES = f"""select doc_id, id as node_id, max_by(score, pos) as score, max_by(reason, pos) as reason from (
    select doc_id, pos, json_extract_string(item, '$.id') as id, json_extract_string(item, '$.reasons[0]') as reason,
      case when json_type(item, '$.score') in ('DOUBLE', 'BIGINT', 'UBIGINT') then {clamp("json_extract_string(item, '$.score')")} end as score from ({SCORE_ITEMS})) i
    where score is not null and exists (select 1 from fx_nodes n where n.doc_id = i.doc_id and n.node_id = i.id) group by doc_id, id"""
add_table("fx_oracle_scores", lambda d: SCORES)


def scores(spark, sf):
    items, _ = batching.ingest_responses(fixture(spark, sf, "fx_score_responses"), ["doc_id", "batch_no"], "scores", brace_slice=True)
    item = F.col("item")
    rows = items.select("doc_id", "pos", batching.item_string(item, "$.id").alias("node_id"), batching.item_number(item, "$.score").alias("score"),
                        batching.item_strings(item, "$.reasons").alias("reasons"))
    return en.validate_scores(rows, fixture(spark, sf, "fx_nodes"))


@query("validate_scores", "select * from fx_oracle_scores")
def validate_scores(spark, sf):
    return scores(spark, sf).select("doc_id", "node_id", "score", F.try_element_at("reasons", F.lit(1)).alias("reason"))


@query("apply_density_scores", f"""select n.doc_id, n.node_id, case when kind = 'gap' then 0.0::double when kind in ('code', 'equation') then 1.0::double when s.score is not null then s.score else {surface('text')} end as density_score,
      case when kind = 'gap' then 'structural' when kind in ('code', 'equation') then 'protected' when s.score is not null then 'model' else 'fallback' end as density_source
    from fx_nodes n left join fx_oracle_scores s using (doc_id, node_id)""")
def apply_density_scores(spark, sf):
    df, _ = en.apply_density_scores(fixture(spark, sf, "fx_nodes"), stage(spark, sf, "scores", lambda: scores(spark, sf)))
    return df.select("doc_id", "node_id", "density_score", "density_source")


PROSE = r"not regexp_matches(text, '^\s*\|') and not contains(text, '<!-- MathML:')"
DENSE = f"kind not in ('gap', 'code', 'equation') and {PROSE} and density_score >= 0.75"


def density_nodes(spark, sf):
    return (fixture(spark, sf, "fx_dscored").withColumn("resolved_by", F.when(F.col("prior_resolver").isNotNull(), F.array("prior_resolver")))
            .withColumn("resolved", F.col("prior_resolver").isNotNull()).withColumn("density_score", F.col("density_score").cast("double")))


@query("dense_candidates", f"select doc_id, node_id from fx_dscored where {DENSE}")
def dense_candidates(spark, sf):
    return en.dense_candidates(density_nodes(spark, sf)).select("doc_id", "node_id")


# Used ids: every fourth node carries an id of the prefix; every third node asks for a new one.
add_table("fx_used_ids", lambda d: f"select doc_id, case when node_ord % 4 = 1 then {pad('split-', 'node_ord', 6)} else node_id end as node_id from fx_nodes")


@query("derive_node_ids", f"""with used as (select doc_id, cast(substr(node_id, 7) as bigint) as u from fx_used_ids where node_id like 'split-%'),
    free as (select doc_id, n, row_number() over (partition by doc_id order by n) as k from (
      select doc_id, unnest(range(1, m + 200)) as n from (select doc_id, max(node_ord) as m from fx_nodes group by doc_id)) a
      where not exists (select 1 from used where used.doc_id = a.doc_id and used.u = a.n)),
    fresh as (select doc_id, node_ord, row_number() over (partition by doc_id order by node_ord) as k from fx_nodes where node_ord % 3 = 0)
    select doc_id, node_ord, {pad('split-', 'n', 6)} as node_id from fresh join free using (doc_id, k)""")
def derive_node_ids(spark, sf):
    fresh = fixture(spark, sf, "fx_nodes", "doc_id, node_ord").filter("node_ord % 3 = 0")
    return en.derive_node_ids(fresh, fixture(spark, sf, "fx_used_ids"), "split-", ["node_ord"])


SCORE = "case when node_ord % 5 = 0 then null when node_ord % 5 = 1 then 1.7 when node_ord % 5 = 2 then -0.4 else cast(node_ord % 8 as double) / 8 end"


def _plan_items(d):
    def part(name, pos, kind, text):
        return (f"select doc_id, node_ord as item_pos, case when node_ord % 17 = 0 then 'missing' else node_id end as parent_id, '{name}' as part, cast({pos} as bigint) as pos, "
                f"{kind} as type, {text} as text, cast({SCORE} as double) as score from fx_dscored where node_ord % 3 = 0 and kind <> 'gap'")
    types = d.at(d.arr(*[f"'{t}'" for t in (*en.EXPANSION_TYPES, "joke")]), "1 + node_ord % 6")
    return " union all ".join([part("split", 1, "''", "' ' || text || ' '"),
                               part("split", 2, "''", "case when node_ord % 7 = 0 then ' ' else 'Again: ' || text end"),
                               part("expansion", 1, types, "'More: ' || text")])


add_table("fx_decomposition_items", _plan_items)
TYPES = ", ".join(f"'{t}'" for t in en.EXPANSION_TYPES)
add_table("fx_decomposition", lambda d: f"""select doc_id, item_pos, parent_id, part, pos, type, trim(text) as text, {clamp('score')} as score from fx_decomposition_items i
    where trim(text) <> '' and (part = 'split' or type in ({TYPES}))
      and exists (select 1 from fx_dscored n where n.doc_id = i.doc_id and n.node_id = i.parent_id and {DENSE.replace('text', 'n.text').replace('kind', 'n.kind')})""")


def decomposition(spark, sf):
    return en.validate_decomposition(fixture(spark, sf, "fx_decomposition_items"), en.dense_candidates(density_nodes(spark, sf)))


@query("validate_decomposition", "select * from fx_decomposition")
def validate_decomposition(spark, sf):
    return decomposition(spark, sf)


@query("apply_decomposition", f"""select d.doc_id, case when part = 'split' then 'split-' else 'expand-' end || lpad(cast(row_number() over (partition by d.doc_id, part order by item_pos, pos) as string), 6, '0') as node_id,
      text, parent_id as derived_from, coalesce(score, {surface('text')}) as density_score, case when score is null then 'fallback' else 'model' end as density_source,
      case when part = 'split' then 'part of a dense node' else type || ' expansion' end as reason, case when part = 'split' then coalesce(u.n, 0) else 0 end as units
    from fx_decomposition d left join (select doc_id, node_id, count(*) as n from fx_node_units group by all) u on u.doc_id = d.doc_id and u.node_id = d.parent_id""")
def apply_decomposition(spark, sf):
    out = en.apply_decomposition(density_nodes(spark, sf), fixture(spark, sf, "fx_node_units"), decomposition(spark, sf))
    key = ["doc_id", "node_id"]
    units = out["node_units"].groupBy(*key).agg(F.count(F.lit(1)).alias("units"))
    return (out["nodes"].select(*key, "text", "derived_from", "density_score", "density_source")
            .join(out["edges"].select("doc_id", F.col("src").alias("node_id"), "reason"), key).join(units, key, "left").fillna(0, ["units"]))


TARGETS = f"""select doc_id, node_id, cast(1 as bigint) as rank, kind from fx_dscored where kind = 'gap' and prior_resolver is null
    union all select doc_id, node_id, cast(2 as bigint), kind from fx_dscored where kind not in ('gap', 'code', 'equation') and origin in ('source', 'decomposition')
      and density_score >= 0.5 and {PROSE}"""
add_table("fx_targets", lambda d: TARGETS)


@query("expansion_targets", "select doc_id, node_id, rank from fx_targets")
def expansion_targets(spark, sf):
    return en.expansion_targets(density_nodes(spark, sf)).select("doc_id", "node_id", "rank")


def _injections(d):
    types = d.at(d.arr(*[f"'{t}'" for t in (*en.INJECTION_TYPES, "rumor")]), "1 + node_ord % 10")
    relations = d.at(d.arr("'fills'", "'supports'", "'enables'", "'elaborates'"), "1 + (doc_id + node_ord) % 4")
    return " union all ".join(
        f"select doc_id, node_ord as item_pos, node_id as target_id, cast({pos} as bigint) as pos, {types} as type, {text} as text, cast({SCORE} as double) as score, "
        f"{relations} as relation, ' flow ' as reason from fx_dscored where node_ord % 2 = 0"
        for pos, text in ((1, "'idea ' || cast(node_ord as string) || ' about ' || substr(unit_id, 2, 3)"), (2, "case when node_ord % 6 = 0 then '  ' else coalesce(text, 'none') end")))


add_table("fx_injection_items", _injections)
INJ = ", ".join(f"'{t}'" for t in en.INJECTION_TYPES)
add_table("fx_injections", lambda d: f"""select i.doc_id, i.item_pos, i.target_id, i.pos, i.type, trim(i.text) as text, {clamp('i.score')} as score, i.relation, trim(i.reason) as reason, t.kind as target_kind
    from fx_injection_items i join fx_targets t on t.doc_id = i.doc_id and t.node_id = i.target_id where i.type in ({INJ}) and trim(i.text) <> ''
    and case when t.kind = 'gap' then i.relation in ('fills', 'supports', 'enables') else i.relation in ('elaborates', 'enables', 'supports') end""")


def injections(spark, sf):
    return en.validate_injections(fixture(spark, sf, "fx_injection_items"), en.expansion_targets(density_nodes(spark, sf)))


@query("validate_injections", "select * from fx_injections")
def validate_injections(spark, sf):
    return injections(spark, sf)


@query("apply_injections", f"""with placed as (select *, 'inject-' || lpad(cast(row_number() over (partition by doc_id order by item_pos, pos) as string), 6, '0') as id from fx_injections)
    select doc_id, 'new' as part, id as node_id, target_id as a, relation as b, coalesce(score, {surface('text')}) as score from placed
    union all select n.doc_id, 'gap', n.node_id, coalesce(case when p.ids is not null then 'model_injected' end, resolution_status), array_to_string(list_filter([prior_resolver, p.ids], lambda x: x is not null), ','), null
    from fx_dscored n left join (select doc_id, target_id, string_agg(id, ',' order by id) as ids from placed where target_kind = 'gap' group by all) p on p.doc_id = n.doc_id and p.target_id = n.node_id
    where n.kind = 'gap'""")
def apply_injections(spark, sf):
    out = en.apply_injections(density_nodes(spark, sf), injections(spark, sf))
    key = ["doc_id", "node_id"]
    new = (out["new_nodes"].select(*key, F.lit("new").alias("part"), F.col("derived_from").alias("a"), F.col("density_score").alias("score"))
           .join(out["edges"].select("doc_id", F.col("src").alias("node_id"), F.col("relation").alias("b")), key))
    gaps = out["nodes"].filter("kind = 'gap'").select(*key, F.lit("gap").alias("part"), F.col("resolution_status").alias("a"),
                                                      F.array_join("resolved_by", ",").alias("b"), F.lit(None).cast("double").alias("score"))
    return new.unionByName(gaps)


CLASS = "case when gap_type in ('parsing_error', 'missing_definition', 'missing_reference') then gap_type else 'metadata' end"


@query("gap_class", f"select doc_id, node_id, {CLASS} as gap_class from fx_nodes where kind = 'gap'")
def gap_class(spark, sf):
    return fixture(spark, sf, "fx_nodes").filter("kind = 'gap'").select("doc_id", "node_id", en.gap_class(F.col("gap_type")).alias("gap_class"))


add_table("fx_open_gaps", lambda d: f"""select doc_id, node_ord, node_id as gap_id, {CLASS} as gap_class, need, gap_type from fx_dscored
    where kind = 'gap' and resolution_status is null and prior_resolver is null""")


@query("unresolved_gaps", """select g.doc_id, g.gap_id, g.gap_class, coalesce(u.chars, 0) as chars from fx_open_gaps g left join (
      select l.doc_id, l.node_id as gap_id, cast(sum(length(substr(x.text, 1, 6000))) as bigint) as chars from fx_node_units l join fx_units x using (doc_id, unit_id) group by all) u using (doc_id, gap_id)""")
def unresolved_gaps(spark, sf):
    gaps, texts = en.unresolved_gaps(density_nodes(spark, sf), fixture(spark, sf, "fx_node_units"), unstaged(spark, sf, "fx_units"))
    chars = texts.groupBy("doc_id", "gap_id").agg(F.sum(F.length("text")).alias("chars"))
    return gaps.select("doc_id", "gap_id", "gap_class").join(chars, ["doc_id", "gap_id"], "left").fillna(0, ["chars"])


add_table("fx_resolution_items", lambda d: " union all ".join(
    f"select doc_id, node_ord as item_pos, node_id as gap_id, cast({pos} as bigint) as pos, {text} as text, cast({SCORE} as double) as score, "
    f"{d.at(d.arr(*[chr(39) + c + chr(39) for c in ('high', 'medium', 'low')]), '1 + node_ord % 3')} as confidence from fx_dscored where kind = 'gap' and node_ord % 4 <> 3"
    for pos, text in ((1, "' Answer for ' || need"), (2, "case when node_ord % 5 = 0 then '' else 'More on ' || need || ' and ' || unit_id end"))))
add_table("fx_resolution", lambda d: f"""select i.doc_id, i.item_pos, i.gap_id, i.pos, trim(i.text) as text, {clamp('i.score')} as score, i.confidence, g.gap_class
    from fx_resolution_items i join fx_open_gaps g using (doc_id, gap_id) where trim(i.text) <> ''""")


def resolution(spark, sf):
    nodes = density_nodes(spark, sf)
    gaps, _ = en.unresolved_gaps(nodes, fixture(spark, sf, "fx_node_units"), fixture(spark, sf, "fx_units"))
    return nodes, gaps, en.validate_resolution(fixture(spark, sf, "fx_resolution_items"), gaps)


@query("validate_resolution", "select * from fx_resolution")
def validate_resolution(spark, sf):
    return resolution(spark, sf)[2]


@query("apply_resolution", """with placed as (select *, gap_class in ('parsing_error', 'missing_reference') as grounded from fx_resolution),
    ids as (select *, case when grounded then 'recover-' else 'resolve-' end || lpad(cast(row_number() over (partition by doc_id, grounded order by item_pos, pos) as string), 6, '0') as id from placed)
    select doc_id, 'new' as part, id as node_id, gap_id as a, case when grounded then 'recovery' else 'injection' end as b, text as c from ids
    union all select n.doc_id, 'gap', n.node_id, coalesce(case when p.ids is not null then p.status end, n.resolution_status, case when g.gap_class = 'metadata' then 'not_knowledge' end),
      array_to_string(list_filter([prior_resolver, p.ids], lambda x: x is not null), ','), case when p.ids is null and n.resolution_status is null and g.gap_class = 'metadata' then 'Describes the document, not its subject.' end
    from fx_dscored n left join (select doc_id, gap_id, string_agg(id, ',' order by id) as ids, max(case when grounded then 'source_recovery' else 'model_injected' end) as status from ids group by all) p
      on p.doc_id = n.doc_id and p.gap_id = n.node_id left join fx_open_gaps g on g.doc_id = n.doc_id and g.gap_id = n.node_id where n.kind = 'gap'""")
def apply_resolution(spark, sf):
    nodes, gaps, plan = resolution(spark, sf)
    out = en.apply_resolution(nodes, fixture(spark, sf, "fx_node_units"), plan, gaps)
    new = out["new_nodes"].select("doc_id", F.lit("new").alias("part"), "node_id", F.col("derived_from").alias("a"), F.col("origin").alias("b"), F.col("text").alias("c"))
    old = out["nodes"].filter("kind = 'gap'").select("doc_id", F.lit("gap").alias("part"), "node_id", F.col("resolution_status").alias("a"),
                                                     F.array_join("resolved_by", ",").alias("b"), F.col("resolution_reason").alias("c"))
    return new.unionByName(old)
