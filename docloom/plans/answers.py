"""Queries over answer texts of every phase, the repair tree, the answer store, and graphs built from documents and answers.

The texts are rendered by Spark from the item tables, some fenced, some cut off; the checks read the item tables.
"""

from uuid import uuid4

from pyspark.sql import functions as F

from docloom.functions.ordering import shared_folder, union_all
from docloom.operators import answer_store as st
from docloom.operators import answers as an
from docloom.operators import build as bd
from docloom.operators import extraction as ex
from docloom.plans import enrichment, overlay, prose, teaching  # noqa: F401 (their item tables)
from docloom.plans.corpus import SCORE_ITEMS, SEGMENTED, _pack_sql, markdown, recursive_oracle
from docloom.plans.extraction import chunk_units
from docloom.plans.fixtures import SPARK_BUILDERS, TABLES, Dialect, add_table, fixture, oracle, pad, stage, unstaged

QUERIES, ORACLES = {}, {}
BATCH = ["doc_id", "batch_no"]
ROW = ["part", "id", "pos", "a", "b", "c", "score"]
CUT = "(doc_id + batch_no) % 7 = 3"


def query(name, sql=None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return fn
    return register


def listed(order, *fields):
    """The group's rows as an array of structs in that order."""
    rows = F.array_sort(F.collect_list(F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], F.struct(*fields).alias("_x"))))
    return F.transform(rows, lambda r: r["_x"])


def responses(items, name="items"):
    """(doc_id, batch_no, response) from (doc_id, batch_no, list): one object per batch; some are cut off, some fenced."""
    body = items.select(*BATCH, F.to_json(F.struct(F.col(name)), {"ignoreNullFields": "false"}).alias("body"))
    text = (F.when(F.expr(CUT), F.expr("substr(body, 1, length(body) - 2)")).when((F.col("doc_id") + F.col("batch_no")) % 5 == 1, F.concat(F.lit("```json\n"), "body", F.lit("\n```")))
            .otherwise(F.concat(F.lit(" "), "body", F.lit("\n"))))
    return body.select(*BATCH, text.alias("response"))


def row(df, part, id_, pos, a=None, b=None, c=None, score=None):
    col = lambda x, kind: (F.lit(None) if x is None else F.col(x) if isinstance(x, str) else x).cast(kind)
    return df.select(*BATCH, F.lit(part).alias("part"), col(id_, "string").alias("id"), col(pos, "bigint").alias("pos"), col(a, "string").alias("a"), col(b, "string").alias("b"),
                     col(c, "string").alias("c"), col(score, "double").alias("score"))


def with_issues(tables, *rows):
    faults = row(tables["issues"], "issue", None, None, "category", "detail")
    return union_all(*rows, faults)


def sql_rows(rows, batches):
    """``rows`` selects doc_id, batch_no and ROW; the batches that were cut off are issues instead."""
    return f"""select * from ({rows}) where not ({CUT}) union all
      select distinct doc_id, batch_no, 'issue', null, cast(null as bigint), 'bad_json', '', null, cast(null as double) from ({batches}) where {CUT}"""


BLANK = "cast(null as string)"
BY_ITEM = "cast(floor(item_pos / 20) as bigint) as batch_no"

# --- decomposition -----------------------------------------------------------------------


@query("answers_decomposition", sql_rows(f"""select doc_id, {BY_ITEM}, part, parent_id as id, row_number() over (partition by doc_id, item_pos, part order by pos, text) as pos,
      case when part = 'expansion' then type end as a, text as b, {BLANK} as c, score from fx_decomposition_items""", f"select doc_id, {BY_ITEM} from fx_decomposition_items"))
def answers_decomposition(spark, sf):
    items = fixture(spark, sf, "fx_decomposition_items").withColumn("batch_no", F.floor(F.col("item_pos") / 20).cast("bigint"))
    score = F.col("score").alias("densityScore")
    lists = lambda part, *fields: F.coalesce(F.filter(listed(["pos", "text"], F.col("part"), *fields, "text", score), lambda x: x["part"] == part), F.array())
    each = items.groupBy(*BATCH, "item_pos", "parent_id").agg(lists("split").alias("splits"), lists("expansion", "type").alias("expansions"))
    texts = responses(each.groupBy(*BATCH).agg(listed(["item_pos"], F.col("parent_id").alias("parentId"), "splits", "expansions").alias("items")))
    out = an.read_answers(texts, BATCH, an.DECOMPOSITION)
    return with_issues(out, row(out["splits"], "split", "parent_id", "pos", None, "text", None, "score"), row(out["expansions"], "expansion", "parent_id", "pos", "type", "text", None, "score"))


# --- injections, resolutions -------------------------------------------------------------

@query("answers_injection", sql_rows(f"""select doc_id, {BY_ITEM}, 'injection' as part, target_id as id, row_number() over (partition by doc_id, item_pos order by pos, text) as pos, type as a, text as b,
      relation || '|' || reason as c, score from fx_injection_items""", f"select doc_id, {BY_ITEM} from fx_injection_items"))
def answers_injection(spark, sf):
    items = fixture(spark, sf, "fx_injection_items").withColumn("batch_no", F.floor(F.col("item_pos") / 20).cast("bigint"))
    each = items.groupBy(*BATCH, "item_pos", "target_id").agg(listed(["pos", "text"], "type", "text", F.col("score").alias("densityScore"), "relation", "reason").alias("injections"))
    texts = responses(each.groupBy(*BATCH).agg(listed(["item_pos"], F.col("target_id").alias("targetId"), "injections").alias("items")))
    out = an.read_answers(texts, BATCH, an.INJECTION)
    return with_issues(out, row(out["injections"], "injection", "target_id", "pos", "type", "text", F.concat("relation", F.lit("|"), "reason"), "score"))


@query("answers_resolution", sql_rows(f"""select doc_id, {BY_ITEM}, 'node' as part, gap_id as id, row_number() over (partition by doc_id, item_pos order by pos, text) as pos, confidence as a, text as b, {BLANK} as c, score
      from fx_resolution_items""", f"select doc_id, {BY_ITEM} from fx_resolution_items"))
def answers_resolution(spark, sf):
    items = fixture(spark, sf, "fx_resolution_items").withColumn("batch_no", F.floor(F.col("item_pos") / 20).cast("bigint"))
    each = items.groupBy(*BATCH, "item_pos", "gap_id").agg(listed(["pos", "text"], "text", F.col("score").alias("densityScore"), "confidence").alias("nodes"))
    texts = responses(each.groupBy(*BATCH).agg(listed(["item_pos"], F.col("gap_id").alias("gapId"), "nodes").alias("items")))
    out = an.read_answers(texts, BATCH, an.RESOLUTION)
    return with_issues(out, row(out["nodes"], "node", "gap_id", "pos", "confidence", "text", None, "score"))


# --- proposals, research -----------------------------------------------------------------

@query("answers_proposal", sql_rows(f"""select doc_id, batch_no, 'item' as part, gap_id as id, row_number() over (partition by doc_id, batch_no order by pos, gap_id) as pos, confidence as a, definition as b, {BLANK} as c,
      cast(null as double) as score from fx_proposals""", "select doc_id, batch_no from fx_proposals"))
def answers_proposal(spark, sf):
    each = fixture(spark, sf, "fx_proposals").groupBy(*BATCH).agg(listed(["pos", "gap_id"], F.col("gap_id").alias("gapId"), "definition", "confidence").alias("items"))
    out = an.read_answers(responses(each), BATCH, an.PROPOSAL)
    return with_issues(out, row(out["items"], "item", "gap_id", "pos", "confidence", "definition"))


@query("answers_research", sql_rows(f"""select doc_id, batch_no, 'item' as part, gap_id as id, row_number() over (partition by doc_id, batch_no order by node_ord, gap_id) as pos, status as a, definition as b,
      confidence || '|' || reason as c, cast(null as double) as score from fx_research
    union all select doc_id, batch_no, 'evidence', gap_id, p, case p when 1 then url_a else url_b end, 'about ' || gap_id, {BLANK}, null from fx_research, (select unnest([1, 2]) as p)""",
                                    "select doc_id, batch_no from fx_research"))
def answers_research(spark, sf):
    source = lambda url: F.struct(F.col(url).alias("url"), F.concat(F.lit("about "), "gap_id").alias("title"), F.lit("quoted").alias("excerpt"), F.lit("claimed").alias("claim"))
    items = fixture(spark, sf, "fx_research").withColumn("evidence", F.array(source("url_a"), source("url_b")))
    each = items.groupBy(*BATCH).agg(listed(["node_ord", "gap_id"], F.col("gap_id").alias("gapId"), "status", "definition", "confidence", "reason", "evidence").alias("items"))
    out = an.read_answers(responses(each), BATCH, an.RESEARCH)
    return with_issues(out, row(out["items"], "item", "gap_id", "pos", "status", "definition", F.concat("confidence", F.lit("|"), "reason")), row(out["evidence"], "evidence", "gap_id", "pos", "url", "title"))


# --- teaching units, rewrites, scores ----------------------------------------------------

@query("answers_teaching", sql_rows("""select doc_id, batch_no, 'unit' as part, record_id as id, row_number() over (partition by doc_id, batch_no, item_pos order by pos, text) as pos, role as a, text as b,
      basis || '|' || array_to_string(requires, ',') || '|' || cast(citation_required as varchar) as c, cast(null as double) as score from fx_expansions""", "select doc_id, batch_no from fx_expansions"))
def answers_teaching(spark, sf):
    items = fixture(spark, sf, "fx_expansions")
    each = items.groupBy(*BATCH, "item_pos", "record_id").agg(listed(["pos", "text"], "role", "basis", "text", "requires", F.col("citation_required").alias("citationRequired")).alias("units"))
    out = an.read_answers(responses(each.groupBy(*BATCH).agg(listed(["item_pos"], F.col("record_id").alias("recordId"), "units").alias("items"))), BATCH, an.TEACHING)
    detail = F.concat("basis", F.lit("|"), F.array_join("requires", ","), F.lit("|"), F.col("citation_required").cast("string"))
    return with_issues(out, row(out["units"], "unit", "record_id", "pos", "role", "text", detail))


@query("answers_rewrite", sql_rows(f"""select doc_id, batch_no, 'paragraph' as part, cast(block as varchar) as id, unnest(range(1, len(paragraphs) + 1)) as pos, {BLANK} as a, unnest(paragraphs) as b, {BLANK} as c,
      cast(null as double) as score from (select *, cast(0 as bigint) as batch_no from fx_rewrites)""", "select doc_id, cast(0 as bigint) as batch_no from fx_rewrites"))
def answers_rewrite(spark, sf):
    items = prose.rewrite_items(spark, sf)[0].withColumn("batch_no", F.lit(0).cast("bigint"))
    out = an.read_answers(responses(items.groupBy(*BATCH).agg(listed(["block"], F.col("block").alias("index"), "paragraphs").alias("items"))), BATCH, an.REWRITE)
    each = out["items"].select(*BATCH, "block", F.posexplode("paragraphs").alias("p", "text"))
    return with_issues(out, row(each, "paragraph", F.col("block"), F.col("p") + 1, None, "text"))


@query("answers_scores", f"""select doc_id, batch_no, 'score' as part, json_extract_string(item, '$.id') as id, pos, json_extract_string(item, '$.reasons[0]') as a, {BLANK} as b,
      case when json_type(item, '$.score') = 'VARCHAR' then 'score' end as c,
      case when json_type(item, '$.score') in ('DOUBLE', 'BIGINT', 'UBIGINT') then cast(json_extract_string(item, '$.score') as double) end as score from ({SCORE_ITEMS})
    union all select doc_id, batch_no, 'issue', null, null, 'bad_json', '', null, null from fx_score_responses anti join ({SCORE_ITEMS}) i using (doc_id, batch_no)""")
def answers_scores(spark, sf):
    out = an.read_answers(fixture(spark, sf, "fx_score_responses"), BATCH, an.SCORES, brace_slice=True)
    return with_issues(out, row(out["scores"], "score", "node_id", "pos", F.get("reasons", F.lit(0)), None, F.get("wrong", F.lit(0)), "score"))


# --- extraction --------------------------------------------------------------------------

HASH = "(doc_id * 3 + chunk_ord) % 13"
add_table("fx_answered", lambda d: f"select distinct doc_id, chunk_ord, chunk_id, {HASH} as h from fx_node_items")


def extraction_texts(spark, sf):
    """One answer text per chunk: one in thirteen is cut off, one lacks its edges, others are fenced or framed by prose."""
    def build():
        keys = ["doc_id", "chunk_id"]
        nodes = fixture(spark, sf, "fx_node_items").groupBy(*keys, "chunk_ord").agg(listed(["idx"], "kind", "text", "need", F.col("gap_type").alias("gapType"), F.col("source_unit_ids").alias("sourceUnitIds")).alias("nodes"))
        edges = fixture(spark, sf, "fx_edge_items").groupBy(*keys).agg(listed(["idx"], F.col("src").alias("from"), F.col("dst").alias("to"), "relation", "reason").alias("edges"))
        frames = fixture(spark, sf, "fx_frame_items").groupBy(*keys).agg(listed(["idx"], "claim", "evidence", F.col("warrant_gap").alias("warrantGap"), "limitations").alias("evidenceFrames"))
        rows = nodes.join(edges, keys, "left").join(frames, keys, "left").withColumn("h", F.expr(HASH))
        rows = rows.withColumn("edges", F.when(F.col("h") != 7, F.coalesce("edges", F.array()))).withColumn("evidenceFrames", F.coalesce("evidenceFrames", F.array()))
        body = rows.withColumn("body", F.to_json(F.struct("nodes", "edges", "evidenceFrames"), {"ignoreNullFields": "false"}))
        text = (F.when(F.col("h") == 5, F.expr("substr(body, 1, length(body) - 4)")).when(F.col("h") % 5 == 0, F.concat(F.lit("```json\n"), "body", F.lit("\n```")))
                .when(F.col("h") % 5 == 1, F.concat(F.lit("Here it is: "), "body", F.lit(" as asked."))).otherwise(F.col("body")))
        return body.select(*keys, text.alias("response"))
    return stage(spark, sf, "extraction_texts", build)


@query("answers_extraction", """select n.doc_id, n.chunk_id, 'node' as part, idx, final as content from fx_node_rules n join fx_answered a using (doc_id, chunk_id) anti join fx_bad_chunks using (doc_id, chunk_id) where h not in (5, 7)
    union all select e.doc_id, e.chunk_id, 'edge', row_number() over (partition by doc_id, chunk_id order by idx) - 1, relation from fx_edge_items e join fx_answered a using (doc_id, chunk_id) anti join fx_bad_chunks using (doc_id, chunk_id) where h not in (5, 7)
    union all select f.doc_id, f.chunk_id, 'frame', row_number() over (partition by doc_id, chunk_id order by idx) - 1, cast(claim as varchar) from fx_frame_items f join fx_answered a using (doc_id, chunk_id) anti join fx_bad_chunks using (doc_id, chunk_id) where h not in (5, 7)
    union all select a.doc_id, a.chunk_id, 'rejected', null, case when h = 7 then 'absent_list' else reason end from fx_answered a left join fx_bad_chunks b using (doc_id, chunk_id) where h = 7 or (h <> 5 and reason is not null)
    union all select doc_id, chunk_id, 'issue', null, case when h = 5 then 'bad_json' else 'absent_list' end from fx_answered where h in (5, 7)""")
def answers_extraction(spark, sf):
    items = an.extraction_items(extraction_texts(spark, sf))
    good, rejected = ex.validate_extraction(items["nodes"], items["edges"], items["frames"], chunk_units(spark, sf))
    key, broken = ["doc_id", "chunk_id"], items["broken"]
    part = lambda df, name, idx, content: df.select(*key, F.lit(name).alias("part"), idx.cast("bigint").alias("idx"), F.col(content).cast("string").alias("content"))
    kept = {name: df.join(broken, key, "left_anti") for name, df in good.items()}
    rejected = broken.unionByName(rejected.join(broken, key, "left_anti"))
    return union_all(part(kept["nodes"], "node", F.col("idx"), "text"), part(kept["edges"], "edge", F.col("idx"), "relation"), part(kept["frames"], "frame", F.col("idx"), "claim"),
                     part(rejected, "rejected", F.lit(None), "reason"), part(items["issues"], "issue", F.lit(None), "category"))


# --- the repair tree ---------------------------------------------------------------------
# Every chunk is asked again. Whether an answer for a part holds is derived from its document and path; parts are halves,
# as every chunk is smaller than the smallest part size.
HALF = "cast(ceil((hi - lo + 1) / 2.0) as bigint)"
GOOD = "(doc_id * 5 + depth * 3 + last * 7 + chunk_ord) % 3 = 1"
add_table("fx_tree_0", lambda d: """select doc_id, chunk_ord, chunk_id, '' as path, 0 as depth, 0 as last, cast(1 as bigint) as lo, count(*) as hi from fx_chunks group by doc_id, chunk_ord, chunk_id""")
for _depth in (1, 2, 3):
    add_table(f"fx_tree_{_depth}", lambda d, k=_depth: " union all ".join(f"""select doc_id, chunk_ord, chunk_id, path || '.00000{n}' as path, {k} as depth, {n} as last, {lo} as lo, {hi} as hi from fx_tree_{k - 1} where not ({GOOD}) and hi > lo"""
                                                                          for n, lo, hi in ((1, "lo", f"lo + {HALF} - 1"), (2, f"lo + {HALF}", "hi"))))
add_table("fx_tree", lambda d: " union all ".join(f"select *, case when {GOOD} then 'answer' when hi > lo and depth < 3 then 'split' else 'fallback' end as outcome from fx_tree_{k}" for k in range(4)))


add_table("fx_leaf_units", lambda d: """select t.doc_id, t.chunk_id, t.path, t.outcome, u.rank - t.lo as at, t.hi - t.lo + 1 as units, u.unit_id, u.text from fx_tree t join (
      select *, row_number() over (partition by doc_id, chunk_id order by unit_ord) as rank from fx_chunk_units) u on u.doc_id = t.doc_id and u.chunk_id = t.chunk_id and u.rank between t.lo and t.hi
    where t.outcome <> 'split'""")


# Answers name units, they hold no text of them.
SPARK_BUILDERS["fx_leaf_units"] = lambda spark, sf: spark.sql(TABLES["fx_leaf_units"](Dialect("spark", sf)).replace(", u.text from fx_tree", " from {tree}").replace("fx_chunk_units", "{chunks}"),
                                                              tree=fixture(spark, sf, "fx_tree"), chunks=fixture(spark, sf, "fx_chunks"))


@query("repair_tree", """with leaves as (select *, coalesce(sum(size) over (partition by doc_id, chunk_id order by path rows between unbounded preceding and 1 preceding), 0) as base from (
      select doc_id, chunk_id, path, outcome, max(units) as units, max(units) + case when outcome = 'fallback' then 1 else 0 end as size from fx_leaf_units group by doc_id, chunk_id, path, outcome))
    select doc_id, chunk_id, 'part' as part, path as a, outcome as b, cast(null as bigint) as n from fx_tree
    union all select u.doc_id, u.chunk_id, 'node', case when u.outcome = 'answer' then 'claim' else 'exact' end, case when u.outcome = 'answer' then 'about ' || u.unit_id else u.text end, cast(l.base + u.at as bigint)
      from fx_leaf_units u join leaves l using (doc_id, chunk_id, path)
    union all select doc_id, chunk_id, 'node', 'gap', null, cast(base + units as bigint) from leaves where outcome = 'fallback'
    union all select u.doc_id, u.chunk_id, 'edge', cast(cast(l.base + u.at as bigint) as varchar), 'precedes', cast(l.base + u.at + 1 as bigint) from fx_leaf_units u join leaves l using (doc_id, chunk_id, path)
      where u.outcome = 'answer' and u.at + 1 < u.units
    union all select u.doc_id, u.chunk_id, 'link', u.unit_id, null, cast(l.base + u.at as bigint) from fx_leaf_units u join leaves l using (doc_id, chunk_id, path) where u.outcome = 'fallback'
    union all select u.doc_id, u.chunk_id, 'link', u.unit_id, null, cast(l.base + u.units as bigint) from fx_leaf_units u join leaves l using (doc_id, chunk_id, path) where u.outcome = 'fallback'""")
def repair_tree(spark, sf):
    key = ["doc_id", "chunk_id"]
    tree, units = fixture(spark, sf, "fx_tree"), unstaged(spark, sf, "fx_chunk_units")
    parts, members = ex.repair_tree(units, tree.select(*key, "path", F.expr(GOOD).alias("ok"), F.lit("late").alias("reason")), size=10 ** 9)
    leaves = fixture(spark, sf, "fx_leaf_units").filter("outcome = 'answer'").withColumn("at", F.col("at").cast("bigint"))
    nodes = leaves.select(*key, "path", F.col("at").alias("idx"), F.lit("claim").alias("kind"), F.concat(F.lit("about "), "unit_id").alias("text"))
    edges = leaves.filter("at + 1 < units").select(*key, "path", F.col("at").alias("src"), (F.col("at") + 1).alias("dst"))
    frames = leaves.limit(0).select(*key, "path", F.col("at").alias("claim"), F.array("at").alias("evidence"), F.col("at").alias("warrant_gap"), F.array("at").alias("limitations"))
    out = ex.combine_tree(parts, members, nodes, edges, frames)
    part = lambda df, name, a, b, n: df.select(*key, F.lit(name).alias("part"), a.cast("string").alias("a"), b.cast("string").alias("b"), n.cast("bigint").alias("n"))
    none = F.lit(None)
    kind = F.when(F.col("kind").isin("claim", "gap"), F.col("kind")).otherwise("exact")
    return union_all(part(parts, "part", F.col("path"), F.col("outcome"), none), part(out["nodes"], "node", kind, F.col("text"), F.col("idx")), part(out["edges"], "edge", F.col("src"), F.lit("precedes"), F.col("dst")),
                     part(out["node_units"], "link", F.col("unit_id"), none, F.col("idx")))


# --- the answer store --------------------------------------------------------------------
# The second run sees an edited corpus: one unit in forty has another text.
add_table("fx_edited_units", lambda d: """select c.doc_id, c.chunk_id, c.unit_ord, c.unit_id, u.kind, case when (c.doc_id * 11 + c.unit_ord) % 40 = 7 then u.text || ' (edited)' else u.text end as text
    from fx_chunks c join fx_units u using (doc_id, unit_ord)""")
CONTENT = "select doc_id, chunk_id, string_agg(kind || '~' || text, '~~' order by unit_ord) as content from {table} group by doc_id, chunk_id"


@query("answer_store", f"""with old as ({CONTENT.format(table='fx_chunk_units')}), new as ({CONTENT.format(table='fx_edited_units')}),
    asked as (select content, min({{'doc_id': doc_id, 'chunk_id': chunk_id}}) as c from new where content not in (select content from old) group by content)
    select doc_id, chunk_id, 'ask' as part, cast(null as bigint) as idx, null as text, null as unit_id from (select c.doc_id as doc_id, c.chunk_id as chunk_id from asked)
    union all select n.doc_id, n.chunk_id, 'kept', u.rank - 1, u.text, u.unit_id from new n join (select *, row_number() over (partition by doc_id, chunk_id order by unit_ord) as rank from fx_edited_units) u using (doc_id, chunk_id)
      where n.content in (select content from old)""")
def answer_store(spark, sf):
    key, path = ["doc_id", "chunk_id"], f"{shared_folder(spark)}/docloom-answer-store-{uuid4().hex}"
    first, second = chunk_units(spark, sf), fixture(spark, sf, "fx_edited_units")
    order = F.expr("row_number() over (partition by doc_id, chunk_id order by unit_ord) - 1").cast("bigint")
    none = F.array().cast("array<string>")
    nodes = first.select(*key, order.alias("idx"), F.lit("claim").alias("kind"), "text", F.lit("").alias("need"), F.lit(None).cast("string").alias("gap_type"), F.lit("source").alias("origin"), F.array("unit_id").alias("unit_ids"),
                         *[none.alias(c) for c in ("defines", "requires", "mentions", "fills")])
    edges = nodes.limit(0).select(*key, "idx", F.col("idx").alias("src"), F.col("idx").alias("dst"), F.col("kind").alias("relation"), F.col("text").alias("reason"))
    frames = nodes.limit(0).select(*key, "idx", F.col("idx").alias("claim"), F.array("idx").alias("evidence"), F.col("idx").alias("warrant_gap"), F.array("idx").alias("limitations"))
    st.add_results(path, st.chunk_digests(first), first, nodes, edges, frames, 1)
    digests, store = st.chunk_digests(second), st.read_store(spark, path)
    asked = st.work_list(digests, store).select(*key, F.lit("ask").alias("part"), F.lit(None).cast("bigint").alias("idx"), F.lit(None).cast("string").alias("text"), F.lit(None).cast("string").alias("unit_id"))
    kept = st.recall(digests, second, store)["nodes"]
    return asked.unionByName(kept.select(*key, F.lit("kept").alias("part"), "idx", "text", F.get("unit_ids", F.lit(0)).alias("unit_id")))


# --- documents and answers to a graph -----------------------------------------------------
# Per chunk: no answer, a broken one, one with an edge from a node to itself, or a good one. Answers leave out every fourth
# unit, define one of five terms in definitions and require one of seven in claims.
ASKED = "(doc_id * 3 + chunk_ord) % 11"


def graph_answers(units):
    keys = ["doc_id", "chunk_id"]
    own = units.filter("unit_ord % 4 <> 3").withColumn("definition", F.col("unit_ord") % 6 == 1)
    term = lambda when, n: F.when(when, F.array(F.format_string("**Term** %d", F.col("unit_ord") % n))).otherwise(F.array())
    node = [F.when(F.col("kind").isin("code", "equation"), F.col("kind")).when(F.col("definition"), "definition").otherwise("claim").alias("kind"), F.concat(F.lit(" about "), "unit_id").alias("text"),
            F.lit("").alias("need"), F.lit(None).cast("string").alias("gapType"), F.array("unit_id").alias("sourceUnitIds"),
            term(F.col("definition"), 5).alias("defines"), term(~F.col("definition") & (F.col("unit_ord") % 2 == 0), 7).alias("requires")]
    rows = own.groupBy(*keys, "chunk_ord").agg(listed(["unit_ord"], *node).alias("nodes")).withColumn("h", F.expr(ASKED))
    edge = lambda a, b: F.struct(a.alias("from"), b.alias("to"), F.lit("supports").alias("relation"), F.lit(" next ").alias("reason"))
    steps = F.transform(F.filter(F.sequence(F.lit(0), F.size("nodes")), lambda i: i < F.size("nodes") - 1), lambda i: edge(i, i + 1))
    rows = rows.withColumn("edges", F.when(F.col("h") == 2, F.concat(steps, F.array(edge(F.lit(0), F.lit(0))))).otherwise(steps)).withColumn("evidenceFrames", F.array())
    body = F.to_json(F.struct("nodes", "edges", "evidenceFrames"), {"ignoreNullFields": "false"})
    return rows.filter("h <> 4").withColumn("body", body).select(*keys, F.when(F.col("h") == 6, F.expr("substr(body, 1, length(body) - 4)")).otherwise(F.col("body")).alias("response"))


add_table("fx_md_units", lambda d: SEGMENTED)
BUILT = _pack_sql("fx_md_units", 2000) + f""",
    placed as (select u.*, c.chunk_ord, (u.doc_id * 3 + c.chunk_ord) % 11 as h, {pad('u', 'u.unit_ord', 6)} as unit_id from fx_md_units u join packed c using (doc_id, unit_ord)),
    answered as (select * from placed where h not in (4, 6) and unit_ord % 4 <> 3),
    silent as (select doc_id, chunk_ord, h from placed group by all having count(*) filter (where h not in (4, 6) and unit_ord % 4 <> 3) = 0),
    gone as (select * from silent),
    ordered as (
      select doc_id, chunk_ord, 0 as phase, unit_ord, case when unit_ord % 6 = 1 then 'definition' else 'claim' end as kind, 'about ' || unit_id as text, false as fallback,
        case when unit_ord % 6 = 1 then 'term ' || cast(unit_ord % 5 as varchar) end as defines, case when unit_ord % 6 <> 1 and unit_ord % 2 = 0 then 'term ' || cast(unit_ord % 7 as varchar) end as requires from answered
      union all select doc_id, chunk_ord, 0, 0, 'gap', null, false, null, null from gone
      union all select doc_id, chunk_ord, 1, unit_ord, case kind when 'heading' then 'topic' when 'table' then 'evidence' else 'source' end, text, true, null, null from placed where h in (4, 6) or unit_ord % 4 = 3),
    numbered as (select *, row_number() over (partition by doc_id order by chunk_ord, phase, unit_ord) as node_ord from ordered),
    primary_of as (select doc_id, defines as term, min(node_ord) as src from numbered where defines is not null group by all),
    wanted as (select doc_id, requires as term, min(node_ord) as seen from numbered n where requires is not null and not exists (select 1 from primary_of p where p.doc_id = n.doc_id and p.term = n.requires) group by all),
    new_gaps as (select w.*, m.last + row_number() over (partition by w.doc_id order by seen) as node_ord from wanted w join (select doc_id, max(node_ord) as last from numbered group by doc_id) m using (doc_id)),
    links as (
      select a.doc_id, a.node_ord as src, b.node_ord as dst, 'supports' as relation, 'model' as origin from numbered a join numbered b on a.doc_id = b.doc_id and a.chunk_ord = b.chunk_ord and a.phase = 0 and b.phase = 0 and b.node_ord = a.node_ord + 1
      union all select n.doc_id, p.src, n.node_ord, 'enables', 'concept-reconciliation' from numbered n join primary_of p on p.doc_id = n.doc_id and p.term = n.requires and p.src <> n.node_ord
      union all select n.doc_id, g.node_ord, n.node_ord, 'enables', 'gap-reconciliation' from numbered n join new_gaps g on g.doc_id = n.doc_id and g.term = n.requires)
    select doc_id, 'node' as part, {pad('n', 'node_ord', 7)} as a, kind as b, text as c, fallback as d from numbered
    union all select doc_id, 'node', {pad('n', 'node_ord', 7)}, 'gap', null, false from new_gaps
    union all select doc_id, 'edge', {pad('n', 'src', 7)}, {pad('n', 'dst', 7)}, relation || ' ' || origin, null from links
    union all select doc_id, 'outcome', {pad('c', 'chunk_ord', 4)}, case when exists (select 1 from silent s where s.doc_id = p.doc_id and s.chunk_ord = p.chunk_ord) then 'failed' when h = 2 then 'salvaged' else 'accepted' end, null, null
      from (select distinct doc_id, chunk_ord, h from placed) p
    union all select doc_id, 'status', case when bool_or(kind = 'gap') then 'complete_with_gaps' else 'complete' end, null, null, null
      from (select doc_id, kind from numbered union all select doc_id, 'gap' from new_gaps) group by doc_id"""
ORACLES["build_graph"] = recursive_oracle(BUILT)


@query("build_graph")
def build_graph(spark, sf):
    documents = markdown(spark, sf)
    units = bd.chunked_units(documents, 2_000)
    out = bd.build_graph(documents, graph_answers(units), 2_000, units=units)
    part = lambda df, name, a, b, c, d=None: df.select("doc_id", F.lit(name).alias("part"), F.col(a).alias("a"), (F.col(b) if b else F.lit(None)).cast("string").alias("b"),
                                                       (c if c is not None else F.lit(None)).cast("string").alias("c"), (F.col(d) if d else F.lit(None)).cast("boolean").alias("d"))
    return union_all(part(out["nodes"], "node", "node_id", "kind", F.col("text"), "coverage_fallback"), part(out["edges"], "edge", "src", "dst", F.concat_ws(" ", "relation", "origin")),
                     part(out["outcomes"], "outcome", "chunk_id", "outcome", None), part(out["status"], "status", "status", None, None))
