"""Queries over the raw corpus: sources, batches, responses, segmentation, sections."""

from uuid import uuid4

from pyspark.sql import functions as F

from docloom.functions import text as tx
from docloom.functions.ordering import shared_folder
from docloom.operators import batching, segment, sections
from docloom.plans.fixtures import SPARK_BUILDERS, Dialect, add_table, fixture, oracle, pad, source, stage, unstaged
from docloom.sources import corpus, html

QUERIES, ORACLES = {}, {}


def query(name, sql=None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return fn
    return register


D = Dialect("duckdb")


# Documents re-rendered as Markdown: the units of a document separated by blank lines.
add_table("fx_markdown", lambda d: f"""select doc_id, {d.join_rows('text', 'unit_ord', "chr(10) || chr(10)" if not d.spark else "'" + chr(92) + "n" + chr(92) + "n'")} as text
    from fx_units group by doc_id""")

CLEAN = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '<!--[\s\S]*?-->', '', 'g'),
  '(?i)<script[\s\S]*?</script>', '', 'g'), '(?i)<style[\s\S]*?</style>', '', 'g'), '(?i)<head[\s\S]*?</head>', '', 'g')"""


def _entities(x):
    for a, b in (("(?i)&nbsp;", " "), ("(?i)&amp;", "&"), ("(?i)&lt;", "<"), ("(?i)&gt;", ">"), ("(?i)&quot;", '"'), ("(?i)&#39;|&apos;", "''")):
        x = f"regexp_replace({x}, '{a}', '{b}', 'g')"
    return x


def _strip(x):
    collapsed = rf"trim(regexp_replace(regexp_replace({x}, '<[^>]*>', '', 'g'), '\s+', ' ', 'g'))"
    return _entities(collapsed)


@query("read_corpus", r"""select doc_id, sha256(regexp_replace(text, '\r\n?', chr(10), 'g')) as sha256,
    cast(length(text) as bigint) as chars from documents where length(trim(text)) > 0""")
def read_corpus(spark, sf):
    docs, _ = corpus.read_corpus(spark, f"{sf}/documents.parquet")
    return docs.select("doc_id", "sha256", tx.text_length(F.col("text")).alias("chars"))


def graph_tables_of(spark, sf, units=None):
    units = units_with_context(spark, sf) if units is None else units
    return {"units": units.select("doc_id", "unit_ord", "unit_id", "kind", "text", "start_line", "end_line", "context"),
            "nodes": fixture(spark, sf, "fx_nodes", "doc_id, node_ord, node_id, kind, text, need, gap_type, origin, coverage_fallback"),
            "node_units": fixture(spark, sf, "fx_node_units"), "node_concepts": fixture(spark, sf, "fx_node_concepts"),
            "edges": fixture(spark, sf, "fx_edges"), "frames": fixture(spark, sf, "fx_frames")}


def nested_graph(spark, sf):
    """The exported nested form parsed back from its JSON text."""
    nested = stage(spark, sf, "nested_graph", lambda: corpus.export_graph(graph_tables_of(spark, sf, fresh_context(spark, sf))))
    row = nested.select("doc_id", F.to_json(F.struct(*[c for c in nested.columns if c != "doc_id"])).alias("_j"))
    return row.select("doc_id", F.from_json("_j", corpus.GRAPH_SCHEMA).alias("_g")).select("doc_id", "_g.*")


@query("read_graph", """select doc_id, row_number() over (partition by doc_id order by node_ord) as node_ord, node_id, kind, text,
      coalesce(units, 0) as units, coalesce(concepts, 0) as concepts from fx_nodes
    left join (select doc_id, node_id, count(*) as units from fx_node_units group by all) using (doc_id, node_id)
    left join (select doc_id, node_id, count(*) as concepts from fx_node_concepts group by all) using (doc_id, node_id)""")
def read_graph(spark, sf):
    t = corpus.graph_tables(nested_graph(spark, sf))
    keys = ["doc_id", "node_id"]
    return (t["nodes"].select("doc_id", "node_ord", "node_id", "kind", "text")
            .join(t["node_units"].groupBy(*keys).agg(F.count(F.lit(1)).alias("units")), keys, "left")
            .join(t["node_concepts"].groupBy(*keys).agg(F.count(F.lit(1)).alias("concepts")), keys, "left")
            .fillna(0, ["units", "concepts"]))


@query("graph_files", """select n.doc_id, n.node_id, n.kind, n.text, n.need, n.gap_type, n.density_score, n.resolution_status, 'scored' as density_source, n.kind as density_reason,
      count(u.unit_id) as units from fx_dscored n left join fx_node_units u using (doc_id, node_id) group by all""")
def graph_files(spark, sf):
    tables = graph_tables_of(spark, sf)
    scored = fixture(spark, sf, "fx_dscored").drop("unit_id", "prior_resolver").withColumn("density_source", F.lit("scored")).withColumn("density_reasons", F.array("kind"))
    path = f"{shared_folder(spark)}/docloom-graph-files-{uuid4().hex}"
    corpus.write_graph({**tables, "nodes": scored}, path)
    read = corpus.read_export(spark, path)
    units = read["node_units"].groupBy("doc_id", "node_id").agg(F.count(F.lit(1)).alias("units"))
    return (read["nodes"].join(units, ["doc_id", "node_id"], "left").fillna(0, ["units"])
            .select("doc_id", "node_id", "kind", "text", "need", "gap_type", "density_score", "resolution_status", "density_source", F.get("density_reasons", F.lit(0)).alias("density_reason"), "units"))


@query("write_graph", """select n.doc_id, n.nodes, coalesce(e.edges, 0) as edges, coalesce(f.frames, 0) as frames, u.units from
      (select doc_id, count(*) as units from fx_units group by doc_id) u
    join (select doc_id, count(*) as nodes from fx_nodes group by doc_id) n using (doc_id)
    left join (select doc_id, count(*) as edges from fx_edges group by doc_id) e using (doc_id)
    left join (select doc_id, count(*) as frames from fx_frames group by doc_id) f using (doc_id)""")
def write_graph(spark, sf):
    nested = corpus.export_graph(graph_tables_of(spark, sf)).filter("nodes is not null")
    size = lambda c: F.coalesce(F.size(c), F.lit(0)).cast("bigint")
    return nested.select("doc_id", size("nodes").alias("nodes"), F.when(F.col("edges").isNull(), 0).otherwise(size("edges")).cast("bigint").alias("edges"),
                         F.when(F.col("evidenceFrames").isNull(), 0).otherwise(size("evidenceFrames")).cast("bigint").alias("frames"),
                         size("sourceUnits").alias("units"))


def _markdown_sql():
    h = CLEAN
    link = r"regexp_replace({x}, '(?i)<a\b[^>]*?\bhref\s*=\s*\"([^\"]*)\"[^>]*>\s*([^<]*?)\s*</a>', '[\2](\1)', 'g')".format(x=h)
    # The only heading in the pages is one h1, so its text is cut out and put back.
    head = r"regexp_extract(m, '(?i)<h1\b[^>]*>([\s\S]*?)</h1>', 1)"
    stripped = _strip(head)
    replaced = (r"case when regexp_matches(m, '(?i)<h1\b[^>]*>[\s\S]*?</h1>') then "
                r"substr(m, 1, instr(m, whole) - 1) || chr(10) || chr(10) || '# ' || " + stripped +
                r" || chr(10) || chr(10) || substr(m, instr(m, whole) + length(whole)) else m end")
    x = "h"
    for p, out in ((r"(?i)<(p|section|article|main|figure|figcaption|blockquote|div)\b[^>]*>", "chr(10) || chr(10)"),
                   (r"(?i)</(p|section|article|main|figure|figcaption|blockquote|div)>", "chr(10) || chr(10)"),
                   (r"(?i)<br\s*/?\s*>", "chr(10)"), (r"(?i)<li\b[^>]*>", "chr(10) || '- '"), (r"(?i)</?(ul|ol)\b[^>]*>", "chr(10)"),
                   ("<[^>]*>", "''")):
        x = f"regexp_replace({x}, '{p}', {out}, 'g')"
    x = _entities(x)
    for p, out in ((r"[ \t]+\n", "chr(10)"), (r"\n[ \t]+", "chr(10)"), (r"\n{3,}", "chr(10) || chr(10)"), (r"[ \t]{2,}", "' '")):
        x = f"regexp_replace({x}, '{p}', {out}, 'g')"
    return rf"""select page_id, regexp_replace({x}, '^\s+|\s+$', '', 'g') || chr(10) as text from (
        select page_id, {replaced} as h from (select page_id, m, regexp_extract(m, '(?i)<h1\b[^>]*>[\s\S]*?</h1>') as whole
        from (select page_id, {link} as m from pages)))"""


@query("html_to_markdown", _markdown_sql())
def html_to_markdown(spark, sf):
    return html.html_to_markdown(source(spark, sf, "pages").select("page_id", "html"))[0].select("page_id", "text")


@query("decode_entities", f"select page_id, md5({_entities('html')}) as digest from pages")
def decode_entities(spark, sf):
    return source(spark, sf, "pages").select("page_id", F.md5(tx.decode_entities(F.col("html"))).alias("digest"))


@query("page_links", rf"""select page_id, pos, {_strip("regexp_extract(tag, '(?i)<a[^>]*>([^<]*)</a>', 1)")} as text,
      regexp_extract(tag, '(?i)href\s*=\s*"([^"]*)"', 1) as href from (
    select page_id, unnest(range(1, len(t) + 1)) as pos, unnest(t) as tag from (
      select page_id, regexp_extract_all({CLEAN}, '(?i)<a\b[^>]*>[\s\S]*?</a>') as t from pages))""")
def page_links(spark, sf):
    return html.page_links(source(spark, sf, "pages").select("page_id", "html"))


@query("page_images", rf"""select page_id, cast(pos as bigint) as pos, regexp_extract(tag, '(?i)alt\s*=\s*"([^"]*)"', 1) as alt,
      regexp_extract(tag, '(?i)src\s*=\s*"([^"]*)"', 1) as src from (
    select page_id, unnest(range(1, len(t) + 1)) as pos, unnest(t) as tag from (
      select page_id, regexp_extract_all(h, '(?i)<img\b[^>]*>') as t from (
        select page_id, replace({CLEAN}, '<article>', '<article><img alt="page ' || cast(page_id as string) || '" src="/i/' || cast(page_id % 7 as string) || '.png">') as h from pages)))""")
def page_images(spark, sf):
    # The supplied pages hold no image; each gets one from its id, at the start of its article.
    tag = F.concat(F.lit('<article><img alt="page '), F.col("page_id").cast("string"), F.lit('" src="/i/'),
                   (F.col("page_id") % 7).cast("string"), F.lit('.png">'))
    pages = source(spark, sf, "pages").select("page_id", F.replace(F.col("html"), F.lit("<article>"), tag).alias("html"))
    return html.page_images(pages)


BATCHED = """select *, cast(floor((row_number() over (partition by doc_id order by node_ord) - 1) / 48) + 1 as bigint) as batch_no
    from fx_nodes where kind not in ('gap', 'code', 'equation')"""


def _batched(spark, sf):
    nodes = fixture(spark, sf, "fx_nodes").filter("kind not in ('gap', 'code', 'equation')")
    return batching.plan_batches(nodes.select("doc_id", "node_ord", "node_id", "kind", "text"), 48, ["doc_id"], ["node_ord"])


@query("plan_batches", f"select doc_id, node_id, batch_no from ({BATCHED})")
def plan_batches(spark, sf):
    return _batched(spark, sf).select("doc_id", "node_id", "batch_no")


@query("build_requests", f"""select doc_id, batch_no, count(*) as items,
      cast(to_json(list(struct_pack(id := node_id, kind := kind, text := text) order by node_ord)) as varchar) as payload
    from ({BATCHED}) group by doc_id, batch_no""")
def build_requests(spark, sf):
    return batching.build_requests(_batched(spark, sf), ["doc_id"], ["node_ord"], [
        F.col("node_id").alias("id"), F.col("kind"), F.col("text")])


SCORE_ITEMS = r"""select doc_id, batch_no, unnest(range(1, cast(n as bigint) + 1)) as pos, unnest(items) as item from (
    select doc_id, batch_no, json_array_length(body, '$.scores') as n, cast(json_extract(body, '$.scores') as json[]) as items from (
      select doc_id, batch_no, case when json_valid(b) then b when json_valid(regexp_extract(b, '(\{[\s\S]*\})', 1)) then regexp_extract(b, '(\{[\s\S]*\})', 1) end as body
      from (select doc_id, batch_no, case when response like '```json%' then trim(response, '`json' || chr(10)) else response end as b from fx_score_responses))
    where body is not null)"""


@query("ingest_responses", f"""select doc_id, batch_no, pos, json_extract_string(item, '$.id') as id,
      case when json_type(item, '$.score') in ('DOUBLE', 'BIGINT', 'UBIGINT') then cast(json_extract_string(item, '$.score') as double) end as score,
      json_extract_string(item, '$.reasons[0]') as reason from ({SCORE_ITEMS})""")
def ingest_responses(spark, sf):
    items, _ = batching.ingest_responses(fixture(spark, sf, "fx_score_responses"), ["doc_id", "batch_no"], "scores", brace_slice=True)
    item = F.col("item")
    return items.select("doc_id", "batch_no", "pos", batching.item_string(item, "$.id").alias("id"),
                        batching.item_number(item, "$.score").alias("score"),
                        F.try_element_at(batching.item_strings(item, "$.reasons"), F.lit(1)).alias("reason"))


# --- segmentation ----------------------------------------------------------------------

UNIT_LINES = r"""select doc_id, unnest(range(1, len(l) + 1)) as line, unnest(l) as text from (
    select doc_id, string_split(text, chr(10)) as l from fx_markdown)"""
SEGMENTED = rf"""select doc_id, row_number() over (partition by doc_id order by min(line)) as unit_ord, kind,
      rtrim(string_agg(text, chr(10) order by line)) as text, min(line) as start_line, max(line) as end_line from (
    select *, sum(starts) over (partition by doc_id order by line) as block from (
      select *, case when kind = 'heading' or kind <> coalesce(lag(kind) over (partition by doc_id order by line), 'blank') then 1 else 0 end as starts
      from (select *, case when trim(text) = '' then 'blank' when regexp_matches(text, '^\s{{0,3}}#{{1,6}}\s+\S') then 'heading'
                   when trim(text) like '|%' then 'table' else 'prose' end as kind from ({UNIT_LINES}))))
    where kind <> 'blank' group by doc_id, block, kind"""


def markdown(spark, sf):
    return fixture(spark, sf, "fx_markdown")


@query("segment_units", f"select doc_id, unit_ord, kind, text, start_line, end_line from ({SEGMENTED})")
def segment_units(spark, sf):
    return segment.segment_units(markdown(spark, sf)).select("doc_id", "unit_ord", "kind", "text", "start_line", "end_line")


@query("segment_lines", f"select doc_id, unit_ord, kind, text, start_line, end_line from ({SEGMENTED})")
def segment_lines(spark, sf):
    """Texts as tables of lines, scanned in blocks of seven."""
    lines = markdown(spark, sf).select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("p", "text")).select("doc_id", (F.col("p") + 1).alias("line_no"), "text")
    return segment.segment_lines(lines, block_lines=7).select("doc_id", "unit_ord", "kind", "text", "start_line", "end_line")


@query("unit_ids", f"select doc_id, unit_ord, {pad('u', 'unit_ord', 6)} as unit_id from ({SEGMENTED})")
def unit_ids(spark, sf):
    return segment.segment_units(markdown(spark, sf)).select("doc_id", "unit_ord", "unit_id")


@query("unit_hash", f"select doc_id, unit_ord, sha256(text) as hash from ({SEGMENTED})")
def unit_hash(spark, sf):
    return segment.segment_units(markdown(spark, sf)).select("doc_id", "unit_ord", "hash")


def _context_sql(units):
    levels = ", ".join(f"max(case when kind = 'heading' and lvl = {k} then unit_ord end) over w as a{k}" for k in range(1, 7))
    titles = ", ".join(f"max_by(title, unit_ord) filter (where kind = 'heading' and lvl = {k}) over w as t{k}" for k in range(1, 7))
    picks = []
    for k in range(1, 7):
        above = f"coalesce(greatest({', '.join(f'a{j}' for j in range(1, k))}), 0)" if k > 1 else "0"
        picks.append(f"case when a{k} > {above} then t{k} end")
    return f"""select *, list_filter([{', '.join(picks)}], lambda x: x is not null) as context from (
        select *, {levels}, {titles} from {units} window w as (partition by doc_id order by unit_ord rows unbounded preceding))"""


add_table("fx_uctx", lambda d: f"select * from ({_context_sql('fx_units')})")


def units_with_context(spark, sf):
    """Units with heading paths, handed over as a table to the later phases."""
    return stage(spark, sf, "units_with_context", lambda: fresh_context(spark, sf))


def unit_contexts(spark, sf):
    """Heading paths alone, for phases that need no text."""
    def build():
        heads = unstaged(spark, sf, "fx_units").select("doc_id", "unit_ord", "unit_id", "kind", "lvl", "title").withColumn("level", F.when(F.col("kind") == "heading", F.col("lvl")))
        return segment.heading_context(heads.drop("kind", "lvl")).select("doc_id", "unit_id", "context")
    return stage(spark, sf, "unit_contexts", build)


def unit_chapters(spark, sf):
    """Of every unit's heading path only the chapter, for phases that need neither texts nor other headings."""
    def build():
        heads = unstaged(spark, sf, "fx_units").select("doc_id", "unit_ord", "unit_id", F.when(F.col("kind") == "heading", F.col("lvl")).alias("level"),
                                                       F.when(F.col("title").rlike(sections.CHAPTER), F.col("title")).alias("title"))
        return segment.heading_context(heads).select("doc_id", "unit_id", F.slice("context", 1, 1).alias("context"))
    return stage(spark, sf, "unit_chapters", build)


def fresh_context(spark, sf):
    units = unstaged(spark, sf, "fx_units").withColumn("level", F.when(F.col("kind") == "heading", F.col("lvl")))
    return segment.heading_context(units)


@query("heading_context", "select doc_id, unit_id, array_to_string(context, ' / ') as context from fx_uctx")
def heading_context(spark, sf):
    return fresh_context(spark, sf).select("doc_id", "unit_id", F.array_join("context", " / ").alias("context"))


def _pack_sql(rows, limit, keys="doc_id"):
    on = " and ".join(f"r.{k} = p.{k}" for k in keys.split(", "))
    return f"""with recursive ranked as (select *, row_number() over (partition by {keys} order by unit_ord) as rn, length(text) + 180 as w from {rows}),
    packed as (
      select {keys}, unit_ord, rn, cast(1 as bigint) as chunk_ord, case when w > {limit} then 0 else w end as size, w > {limit} as closed from ranked where rn = 1
      union all
      select {', '.join('r.' + k for k in keys.split(', '))}, r.unit_ord, r.rn,
        case when p.closed or p.size + r.w > {limit} then p.chunk_ord + 1 else p.chunk_ord end,
        case when r.w > {limit} then 0 when p.closed or p.size + r.w > {limit} then r.w else p.size + r.w end, r.w > {limit}
      from packed p join ranked r on {on} and r.rn = p.rn + 1)"""


def recursive_oracle(sql):
    text = oracle(sql.replace("with recursive ", "with ", 1))
    return "with recursive " + text.lstrip()[5:]


@query("pack_chunks")
def pack_chunks(spark, sf):
    packed = segment.pack_chunks(fixture(spark, sf, "fx_units", "doc_id, unit_ord, text"), 2_000)
    return packed.select("doc_id", "unit_ord", "chunk_ord", segment.chunk_id(F.col("chunk_ord")).alias("chunk_id"))


ORACLES["pack_chunks"] = recursive_oracle(
    _pack_sql("fx_units", 2000) + f" select doc_id, unit_ord, chunk_ord, {pad('c', 'chunk_ord', 4)} as chunk_id from packed")

FAILED_CHUNKS = "select doc_id, chunk_id from fx_chunks where chunk_ord % 3 = 1 group by doc_id, chunk_id"
add_table("fx_failed_units", lambda d: f"""select c.doc_id, c.chunk_id, c.unit_ord, c.unit_id, u.text, u.kind from fx_chunks c
    join ({FAILED_CHUNKS}) using (doc_id, chunk_id) join fx_units u using (doc_id, unit_ord)""")


@query("resplit_failed_chunks")
def resplit_failed_chunks(spark, sf):
    chunks = fixture(spark, sf, "fx_chunks")
    parts = segment.resplit_failed_chunks(chunks, fixture(spark, sf, "fx_units"), chunks.filter("chunk_ord % 3 = 1"), 1_000)
    return parts.select("doc_id", "chunk_id", "unit_ord", "part_id")


ORACLES["resplit_failed_chunks"] = recursive_oracle(
    _pack_sql("fx_failed_units", 1000, "doc_id, chunk_id") +
    f" select doc_id, chunk_id, unit_ord, chunk_id || {pad('-flat-', 'chunk_ord', 2)} as part_id from packed")


SECTIONS_SQL = r"""select doc_id, section, title, start_line, end_line from (
    select doc_id, section, max(case when lvl = 1 and kind = 'heading' then title end) as title, min(start_line) as start_line, max(end_line) as end_line
    from fx_usec where section > 0 group by doc_id, section)"""
add_table("fx_usec", lambda d: """select *, cast(sum(case when kind = 'heading' and lvl = 1 then 1 else 0 end)
    over (partition by doc_id order by start_line) as bigint) as section from fx_units""")
add_table("fx_sections", lambda d: SECTIONS_SQL)
SPARK_BUILDERS["fx_usec"] = lambda spark, sf: unstaged(spark, sf, "fx_units").join(
    sections.sections_from_units(unstaged(spark, sf, "fx_units"))[1].select("doc_id", "unit_id", "section"), ["doc_id", "unit_id"])


@query("sections_from_units", "select * from fx_sections")
def sections_from_units(spark, sf):
    return sections.sections_from_units(fixture(spark, sf, "fx_units"))[0]


@query("section_slug", r"""select doc_id, section, coalesce(nullif(substr(regexp_replace(regexp_replace(lower(title), '[^\p{L}\p{N}]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 80), ''), 'section') as slug from fx_sections""")
def section_slug(spark, sf):
    return sections_from_units(spark, sf).select("doc_id", "section", tx.section_slug(F.col("title")).alias("slug"))


@query("section_source", """select s.doc_id, s.section, trim(string_agg(l.text, chr(10) order by l.line)) || chr(10) as text
    from fx_sections s join fx_lines l on l.doc_id = s.doc_id and l.line between s.start_line and s.end_line group by s.doc_id, s.section""")
def section_source(spark, sf):
    return sections.section_source(source(spark, sf, "documents"), sections_from_units(spark, sf))


CHAPTER_SQL = """select n.doc_id, n.node_id, coalesce(c.chapter, 'Unscoped') as chapter from fx_nodes n left join (
    select l.doc_id, l.node_id, min_by(chapter, pos) as chapter from fx_node_units l join (
      select doc_id, unit_id, list_filter(context, lambda x: regexp_matches(x, '(?i)^Chapter\\s+\\d+'))[1] as chapter from fx_uctx) u using (doc_id, unit_id)
    where chapter is not null group by l.doc_id, l.node_id) c using (doc_id, node_id)""".replace("\\\\", "\\")
add_table("fx_chapters", lambda d: CHAPTER_SQL)


def node_chapters(spark, sf):
    found = sections.chapter_of(fixture(spark, sf, "fx_node_units"), unit_contexts(spark, sf))
    return (fixture(spark, sf, "fx_nodes", "doc_id, node_id").join(found, ["doc_id", "node_id"], "left")
            .fillna("Unscoped", ["chapter"]))


@query("chapter_of", "select * from fx_chapters")
def chapter_of(spark, sf):
    return node_chapters(spark, sf)
