"""Graph-shaped tables derived from the supplied corpus.

Each table is one SQL text rendered for two dialects, so a query and its check read the
same rows. Every table is a row-local projection of ``documents`` lines or an equi-join on
``(doc_id, line)``: nothing is sampled and no whole document is gathered.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docloom.functions.ordering import staged
from docloom.functions.text import NO_SPACE


class Dialect:
    def __init__(self, name: str, sf_dir: str = ""):
        self.spark = name == "spark"
        self.sf_dir = sf_dir

    def table(self, name):
        return f"parquet.`{self.sf_dir}/{name}.parquet`" if self.spark else name

    def rx(self, pattern):
        return f"r'{pattern}'" if self.spark else f"'{pattern}'"

    def trim(self, text):
        """DuckDB's trim takes every Unicode space, Spark's only the ASCII one."""
        return f"regexp_replace({text}, r'\\A\\p{{Zs}}+|\\p{{Zs}}+\\z', '')" if self.spark else f"trim({text})"

    def arr(self, *items):
        return f"array({', '.join(items)})" if self.spark else f"[{', '.join(items)}]"

    def no_strings(self):
        return "cast(array() as array<string>)" if self.spark else "cast([] as varchar[])"

    def no_longs(self):
        return "cast(array() as array<bigint>)" if self.spark else "cast([] as bigint[])"

    def at(self, array, index):
        return f"try_element_at({array}, cast({index} as int))" if self.spark else f"({array})[{index}]"

    def join_rows(self, value, order, sep="''"):
        if self.spark:
            return f"listagg({value}, {sep}) within group (order by {order})"
        return f"string_agg({value}, {sep} order by {order})"


def pad(prefix, expr, width):
    text = f"cast({expr} as string)"
    return f"'{prefix}' || lpad({text}, cast(greatest({width}, length({text})) as int), '0')"


def _lines(d):
    if d.spark:
        return f"""select doc_id, cast(p + 1 as bigint) as line, t as text
            from (select doc_id, posexplode(split(text, '\\n')) as (p, t) from {d.table('documents')})
            where t rlike r'{NO_SPACE}'"""
    return """select doc_id, line, text from (
            select doc_id, unnest(range(1, len(l) + 1)) as line, unnest(l) as text
            from (select doc_id, string_split(text, chr(10)) as l from documents))
            where length(trim(text)) > 0"""


def _units(d):
    return f"""select doc_id, line as unit_ord, {pad('u', 'line', 6)} as unit_id, kind, lvl,
            case when kind = 'heading' then repeat('#', cast(lvl as int)) || ' '
                 || case when lvl = 1 then 'Chapter ' || cast(1 + line % 5 as string) || ' ' else '' end
                 || {d.trim('text')}
                 else text end as text,
            case when kind = 'heading' then case when lvl = 1 then 'Chapter ' || cast(1 + line % 5 as string) || ' ' else '' end
                 || {d.trim('text')} end as title,
            line as start_line, line as end_line
        from (select *, case when line = 1 or (doc_id * 7 + line) % 9 = 0 then 'heading'
                     when (doc_id + line) % 11 = 0 then 'code' when (doc_id + line) % 13 = 0 then 'equation'
                     when (doc_id + line) % 17 = 0 then 'table' else 'prose' end as kind,
                case when line = 1 or (doc_id + line) % 4 = 0 then 1 else 2 + (doc_id + line) % 3 end as lvl
              from fx_lines)"""


def _nodes(d):
    gap = "(doc_id * 5 + unit_ord) % 7 = 0"
    return f"""select doc_id, unit_ord as node_ord, {pad('n', 'unit_ord', 7)} as node_id, unit_id,
            kind, case when kind = 'gap' then null
                       when kind in ('code', 'equation') and unit_ord % 3 = 0 then src_text || ' (changed)'
                       else src_text end as text,
            case when kind = 'gap' then 'Explain item ' || cast(unit_ord % 4 as string) else '' end as need,
            case when kind = 'gap' then {d.at(d.arr("'definition'", "'missing_definition'", "'parsing_error'",
                                                    "'missing_reference'", "'context_missing'"), '1 + unit_ord % 5')} end as gap_type,
            case when kind = 'gap' then 'gap' else 'source' end as origin,
            (doc_id + unit_ord) % 10 = 3 and kind <> 'gap' as coverage_fallback,
            (doc_id + unit_ord) % 6 = 1 and kind <> 'gap' as repair_fallback,
            cast(floor((unit_ord - 1) / 6) as bigint) as chunk_ord, src_text
        from (select doc_id, unit_ord, unit_id, text as src_text,
                case when {gap} then 'gap' when kind in ('code', 'equation') then kind
                     when kind = 'heading' then 'topic' when (doc_id + unit_ord) % 4 = 0 then 'definition'
                     when (doc_id + unit_ord) % 9 < 2 then 'source' else 'claim' end as kind
              from fx_units where (doc_id + unit_ord) % 5 <> 0)"""


def _node_units(d):
    return """select doc_id, node_ord, node_id, cast(1 as bigint) as pos, unit_id from fx_nodes
        union all
        select n.doc_id, n.node_ord, n.node_id, cast(2 as bigint) as pos, u.unit_id
        from fx_nodes n join fx_units u on u.doc_id = n.doc_id and u.unit_ord = n.node_ord + 1
        where (n.doc_id + n.node_ord) % 8 = 0"""


# Role, position, which word, and of which nodes.
PICKS = (("defines", 1, "1 + node_ord % 3", "kind = 'definition'"), ("requires", 1, "3 + node_ord % 2", "kind <> 'gap'"),
         ("requires", 2, "5", "kind = 'claim'"), ("mentions", 1, "6", "kind <> 'gap'"),
         ("fills", 1, "2", "kind = 'gap' and node_ord % 2 = 0"))


def _node_concepts(d):
    base = f"""select doc_id, node_ord, node_id, kind,
            regexp_extract_all(lower(src_text), {d.rx('[' + chr(92) + 'p{L}]{4,}')}, 0) as t from fx_nodes"""
    parts = [f"""select doc_id, node_ord, node_id, '{role}' as role, cast({pos} as bigint) as pos,
        {d.at('t', index)} as concept from ({base}) where {rule}""" for role, pos, index, rule in PICKS]
    return "select * from (" + " union all ".join(parts) + ") where concept is not null"


# The nine edge relations.
RELATIONS = ("enables", "supports", "elaborates", "exemplifies", "contrasts", "part_of", "precedes", "defines", "fills")


def _edges(d):
    relation = d.at(d.arr(*[f"'{r}'" for r in RELATIONS]), "1 + a.node_ord % 9")
    pair = "from fx_nodes a join fx_nodes b on b.doc_id = a.doc_id and b.node_ord = a.node_ord +"

    def row(slot, src, dst, tail, rel=relation):
        return (f"select a.doc_id, a.node_ord * 8 + {slot} as edge_ord, {src} as src, {dst} as dst, {rel} as relation, "
                f"'reason ' || cast(a.node_ord as string) as reason, 'model' as origin {tail}")
    return " union all ".join([
        row(0, "a.node_id", "b.node_id", f"{pair} 1"),
        row(1, "a.node_id", "b.node_id", f"{pair} 3 where a.node_ord % 2 = 0"),
        row(2, "a.node_id", "b.node_id", f"{pair} 1 where a.node_ord % 10 = 0"),
        row(3, "a.node_id", "a.node_id", "from fx_nodes a where a.node_ord % 13 = 0"),
        row(4, "a.node_id", "'n999999' || cast(a.node_ord % 10 as string)", "from fx_nodes a where a.node_ord % 17 = 0"),
        row(5, "b.node_id", "a.node_id", f"{pair} 2 where a.node_ord % 11 = 0"),
        row(6, "a.node_id", "b.node_id", f"{pair} 4 where a.node_ord % 19 = 0", "'relates'"),
    ])


def _frames(d):
    def n(offset):
        return pad("n", f"(node_ord {offset})", 7)
    return f"""select doc_id, node_ord as frame_ord, {pad('ef', 'node_ord', 6)} as frame_id, node_id as claim,
            case when node_ord % 5 = 0 then {d.no_strings()} else {d.arr(n('- 1'), n('- 2'))} end as evidence,
            case when node_ord % 3 = 0 then {n('+ 1')} end as warrant_gap,
            case when node_ord % 4 = 0 then {d.arr(n('+ 2'))} else {d.no_strings()} end as limitations, 'model' as origin
        from fx_nodes where kind <> 'gap' and (doc_id + node_ord) % 2 = 0"""


def _chunks(d):
    return f"""select doc_id, cast(floor((unit_ord - 1) / 6) as bigint) as chunk_ord,
            {pad('c', 'cast(floor((unit_ord - 1) / 6) + 1 as bigint)', 4)} as chunk_id, unit_ord, unit_id from fx_units"""


def _node_items(d):
    return f"""select doc_id, chunk_ord, {pad('c', 'chunk_ord + 1', 4)} as chunk_id,
            cast(row_number() over (partition by doc_id, chunk_ord order by node_ord) - 1 as bigint) as idx, node_ord,
            case when (doc_id + node_ord) % 23 = 0 then 'weird' else kind end as kind,
            case when kind = 'gap' and (doc_id + node_ord) % 31 = 0 then 'stray text'
                 when (doc_id + node_ord) % 29 = 0 then ' ' else text end as text,
            case when (doc_id + node_ord) % 37 = 0 then '' else need end as need, gap_type,
            case when (doc_id + node_ord) % 41 = 0 then {d.arr('unit_id', "'u999999'")}
                 when (doc_id + node_ord) % 43 = 0 then {d.no_strings()}
                 else {d.arr('unit_id', "' ' || unit_id")} end as source_unit_ids
        from fx_nodes"""


def _edge_items(d):
    return f"""select doc_id, chunk_ord, chunk_id, idx, idx as src,
            case when (doc_id + node_ord) % 47 = 0 then idx when (doc_id + node_ord) % 53 = 0 then idx + 40 else idx_next end as dst,
            case when (doc_id + node_ord) % 59 = 0 then 'links'
                 else {d.at(d.arr(*[f"'{r}'" for r in RELATIONS]), '1 + node_ord % 9')} end as relation,
            ' because ' || cast(node_ord as string) as reason
        from (select a.*, b.idx as idx_next from fx_node_items a
              join fx_node_items b on b.doc_id = a.doc_id and b.chunk_id = a.chunk_id and b.idx = a.idx + 1)"""


def _frame_items(d):
    return f"""select doc_id, chunk_ord, chunk_id, idx, case when (doc_id + node_ord) % 61 = 0 then idx + 30 else idx end as claim,
            case when (doc_id + node_ord) % 19 = 0 then {d.no_longs()} when (doc_id + node_ord) % 67 = 0 then {d.arr('idx + 1', 'idx + 50')}
                 else {d.arr('idx + 1', 'idx + 1')} end as evidence,
            case when node_ord % 3 = 0 then idx + 1 end as warrant_gap,
            case when node_ord % 4 = 0 then {d.arr('idx', 'idx + 1', 'idx')} else {d.no_longs()} end as limitations
        from (select a.*, b.idx as idx_next from fx_node_items a
              join fx_node_items b on b.doc_id = a.doc_id and b.chunk_id = a.chunk_id and b.idx = a.idx + 1)
        where node_ord % 2 = 0"""


def _score_responses(d):
    value = "(doc_id * 31 + node_ord * 17) % 140 - 20"
    score = (f"case when {value} < 0 then '-' else '' end || cast(cast(floor(abs({value}) / 100) as bigint) as string) || '.' "
             f"|| lpad(cast(abs({value}) % 100 as string), 2, '0')")
    item = (f"'{{\"id\":\"' || case when node_ord % 12 = 0 then 'nx' else node_id end || '\",\"score\":' || "
            f"case when node_ord % 14 = 0 then '\"high\"' else {score} end || ',\"reasons\":[\"r' || cast(node_ord % 3 as string) || '\"]}}'")
    body = f"'{{\"scores\":[' || {d.join_rows(item, 'node_ord', chr(39) + ',' + chr(39))} || ']}}'"
    newline = "chr(10)"
    return f"""select doc_id, batch_no, case when (doc_id * 3 + batch_no) % 7 = 0 then substr(body, 1, length(body) - 3)
            when (doc_id + batch_no) % 5 = 0 then '```json' || {newline} || body || {newline} || '```'
            when (doc_id + batch_no) % 11 = 0 then 'Answer: ' || body || ' done' else body end as response
        from (select doc_id, cast(floor(node_ord / 16) as bigint) as batch_no, {body} as body
              from fx_nodes where kind <> 'gap' group by doc_id, cast(floor(node_ord / 16) as bigint))"""


def _dscored(d):
    """Nodes that already carry a density score, with resolution state on some gaps."""
    return f"""select doc_id, node_ord, node_id, unit_id, kind, text, need, gap_type, origin,
            case when kind = 'gap' then 0.0 when kind in ('code', 'equation') then 1.0
                 else cast((doc_id * 13 + node_ord * 29) % 101 as double) / 100 end as density_score,
            case when kind = 'gap' and node_ord % 6 = 0 then 'source_recovery' end as resolution_status,
            case when kind = 'gap' and (doc_id + node_ord) % 8 = 0 then 'inject-000900' end as prior_resolver
        from fx_nodes"""


NODE_KEYS = ("doc_id", "node_ord", "node_id", "unit_id", "kind", "need", "gap_type", "origin", "coverage_fallback", "repair_fallback", "chunk_ord")


def _node_keys(d):
    return f"select {', '.join(NODE_KEYS)} from fx_nodes"


TABLES = {
    "fx_lines": _lines, "fx_units": _units, "fx_nodes": _nodes, "fx_node_units": _node_units,
    "fx_node_concepts": _node_concepts, "fx_edges": _edges, "fx_frames": _frames, "fx_chunks": _chunks,
    "fx_node_items": _node_items, "fx_edge_items": _edge_items, "fx_frame_items": _frame_items,
    "fx_score_responses": _score_responses, "fx_dscored": _dscored, "fx_node_keys": _node_keys,
}


def add_table(name, build):
    TABLES[name] = build


def _needed(sql: str, d: Dialect, done: dict) -> None:
    for name in dict.fromkeys(re.findall(r"\bfx_\w+", sql)):
        if name in TABLES and name not in done:
            text = TABLES[name](d)
            _needed(text, d, done)
            done[name] = text


def with_tables(sql: str, d: Dialect) -> str:
    """``sql`` behind the CTEs of every fixture table it mentions, directly or not."""
    done: dict[str, str] = {}
    _needed(sql, d, done)
    if not done:
        return sql
    ctes = ",\n".join(f"{name} as ({text})" for name, text in done.items())
    if sql.lstrip().lower().startswith("with "):
        return f"with {ctes},\n{sql.lstrip()[5:]}"
    return f"with {ctes}\n{sql}"


def oracle(sql: str) -> str:
    return with_tables(sql, Dialect("duckdb"))


_STAGED: dict[tuple, str] = {}


def stage(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The table ``build`` yields, written once per session and corpus and read back by every later query."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STAGED:
        _STAGED[key] = staged(build(), f"{sf_dir.strip('/').replace('/', '-')}/{name}")
    return spark.read.parquet(_STAGED[key])


# Tables that need an order over a whole document: Spark builds them with the block-wise operators.
SPARK_BUILDERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


# Row-local steps over one other table: a table that builds on them computes them again rather than have their texts written.
INLINE = ("fx_lines", "fx_units")
# Of these not even a query that reads them has a copy written.
NEVER_STAGED = ("fx_dscored", "fx_section_docs", "fx_annotated_docs", "fx_written_docs", "fx_vnodes", "fx_vunits", "fx_vconcepts", "fx_vedges", "fx_vframes", "fx_vnotes")


# The nodes of teaching records and variants are lines of documents with marks: cheaper to compute again than to write.
ROW_LOCAL = ("fx_tnodes", "fx_vnodes", "fx_vnotes")


# These read no text of a node: they build on its keys, so no texts are written for them.
BY_KEYS = ("fx_node_units", "fx_frames", "fx_deps")


def unstaged(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived table, read if it is staged and computed in place if not; the tables it builds on are staged first, so its plan stays
    one step long (a few over ``INLINE`` ones)."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key in _STAGED:
        return spark.read.parquet(_STAGED[key])
    if name in SPARK_BUILDERS:
        return SPARK_BUILDERS[name](spark, sf_dir)
    dialect = Dialect("spark", sf_dir)
    text = TABLES[name](dialect)
    if name in BY_KEYS:
        text = text.replace("fx_nodes", "fx_node_keys")
    ctes: dict[str, str] = {}

    def add(sql):
        for other in dict.fromkeys(re.findall(r"\bfx_\w+", sql)):
            key = (spark.sparkContext.applicationId, sf_dir, other)
            if other not in TABLES or other in ctes:
                continue
            if other in NEVER_STAGED and other in SPARK_BUILDERS and key not in _STAGED:
                SPARK_BUILDERS[other](spark, sf_dir).createOrReplaceTempView(f"built_{other}")
                ctes[other] = f"select * from built_{other}"
            elif (other in INLINE + NEVER_STAGED or other == "fx_nodes" and name in ROW_LOCAL) and key not in _STAGED:
                add(TABLES[other](dialect))
                ctes[other] = TABLES[other](dialect)
            else:
                fixture(spark, sf_dir, other)
                ctes[other] = f"select * from parquet.`{_STAGED[key]}`"
    add(text)
    return spark.sql(f"with {', '.join(f'{other} as ({sql})' for other, sql in ctes.items())} {text}" if ctes else text)


def fixture(spark: SparkSession, sf_dir: str, name: str, columns: str = "*") -> DataFrame:
    """A derived table, staged unless it is one of ``NEVER_STAGED``."""
    build = lambda: unstaged(spark, sf_dir, name)
    df = build() if name in NEVER_STAGED + ROW_LOCAL else stage(spark, sf_dir, name, build)
    return df if columns == "*" else df.select(*[c.strip() for c in columns.split(",")])


SPARK_BUILDERS["fx_node_keys"] = lambda spark, sf_dir: unstaged(spark, sf_dir, "fx_nodes").select(*NODE_KEYS)


def _concepts_at_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five picks of ``fx_node_concepts`` in one pass over the nodes' texts, none of which is written."""
    words = r"""select doc_id, node_ord, node_id, kind, regexp_extract_all(lower(src_text), r'[\p{{L}}]{{4,}}', 0) as t from {nodes}"""
    picks = ", ".join(f"if({rule}, named_struct('role', '{role}', 'pos', cast({pos} as bigint), 'concept', try_element_at(t, cast({index} as int))), null)" for role, pos, index, rule in PICKS)
    picked = spark.sql(f"select doc_id, node_ord, node_id, inline(filter(array({picks}), x -> x.concept is not null)) from ({words})", nodes=unstaged(spark, sf_dir, "fx_nodes"))
    return picked.select("doc_id", "node_ord", "node_id", "role", "pos", "concept")


SPARK_BUILDERS["fx_node_concepts"] = _concepts_at_once


def _edges_at_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fx_edges`` with one join for the five kinds of edges that need a later node, by keys alone."""
    steps = ", ".join(f"if({rule}, named_struct('slot', {slot}, 'step', {step}), null)" for slot, step, rule in
                      ((0, 1, "true"), (1, 3, "node_ord % 2 = 0"), (2, 1, "node_ord % 10 = 0"), (5, 2, "node_ord % 11 = 0"), (6, 4, "node_ord % 19 = 0")))
    near = f"""select w.doc_id, w.node_ord, w.slot, w.node_id as a, b.node_id as b
        from (select doc_id, node_ord, node_id, inline(filter(array({steps}), x -> x is not null)) from {{nodes}}) w
        join {{nodes}} b on b.doc_id = w.doc_id and b.node_ord = w.node_ord + w.step"""
    alone = """select doc_id, node_ord, 3 as slot, node_id as a, node_id as b from {nodes} where node_ord % 13 = 0
        union all select doc_id, node_ord, 4 as slot, node_id as a, 'n999999' || cast(node_ord % 10 as string) as b from {nodes} where node_ord % 17 = 0"""
    relations = ", ".join(f"'{r}'" for r in RELATIONS)
    return spark.sql(f"""select doc_id, node_ord * 8 + slot as edge_ord, if(slot = 5, b, a) as src, if(slot = 5, a, b) as dst,
            if(slot = 6, 'relates', try_element_at(array({relations}), cast(1 + node_ord % 9 as int))) as relation, 'reason ' || cast(node_ord as string) as reason, 'model' as origin
        from ({near} union all {alone})""", nodes=fixture(spark, sf_dir, "fx_node_keys"))


SPARK_BUILDERS["fx_edges"] = _edges_at_once


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
