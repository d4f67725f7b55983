"""Dependency order and reachability over large dependency tables.

Groups up to ``group_limit`` records and dependencies are solved in one task each. Larger groups
are never held by a task: values travel along the relation "exactly 2 ** k steps", which is
squared every round, so a path of L records takes about log2(L) rounds. Where the square would
hold more than ``GROWTH`` times the dependencies, the rounds go on with the last relation, which
still skips 2 ** k steps at a time.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions.ordering import cut_lineage, dealt, union_all, with_position

GROUP = ["doc_id", "chapter"]
GROUP_LIMIT = 100_000
AFTER_ALL = 1 << 40
GROWTH = 4


def _inner_edges(nodes: DataFrame, dependencies: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct dependencies between two different records of ``nodes(keys, node)``."""
    edges = dependencies.select(*keys, "src", "dst").filter("src <> dst").distinct()
    for end in ("src", "dst"):
        edges = edges.join(nodes.select(*keys, F.col("node").alias(end)), [*keys, end], "left_semi")
    return edges


def _split_by_size(nodes: DataFrame, edges: DataFrame, keys: list[str], limit: int) -> DataFrame:
    """The keys whose records and dependencies are more than ``limit``."""
    rows = nodes.select(*keys).unionAll(edges.select(*keys))
    return cut_lineage(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > limit).select(*keys))


def _squared(relation: DataFrame, keys: list[str], bound: int) -> DataFrame | None:
    """Pairs that two steps of the relation join, or None if these may be more than ``bound``."""
    into = relation.groupBy(*keys, F.col("dst").alias("mid")).agg(F.count(F.lit(1)).alias("_i"))
    out = relation.groupBy(*keys, F.col("src").alias("mid")).agg(F.count(F.lit(1)).alias("_o"))
    pairs = into.join(out, [*keys, "mid"]).agg(F.sum(F.col("_i").cast("double") * F.col("_o"))).first()[0]
    if pairs and pairs > bound:
        return None
    first, second = relation.withColumnRenamed("dst", "mid"), relation.withColumnRenamed("src", "mid")
    return cut_lineage(first.join(second, [*keys, "mid"]).select(*keys, "src", "dst").distinct())


def _carried(relation: DataFrame, values: DataFrame, keys: list[str], name: str) -> DataFrame:
    """(keys, node, _in): the largest value one step of the relation before each node."""
    here = values.select(*keys, F.col("node").alias("src"), name)
    return relation.join(here, [*keys, "src"]).groupBy(*keys, F.col("dst").alias("node")).agg(F.max(name).alias("_in"))


def _spread(nodes: DataFrame, edges: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``name`` becomes its largest value among a node and everything that leads to it."""
    current, relation = cut_lineage(nodes), cut_lineage(edges)
    bound, doubling = GROWTH * relation.count(), True
    while True:
        offered = _carried(relation, current, keys, name)
        raised = cut_lineage(current.join(offered, [*keys, "node"], "left").withColumn("_new", F.greatest(name, "_in")))
        if raised.filter(F.col("_new") > F.col(name)).isEmpty():
            return current
        current = raised.withColumn(name, F.col("_new")).drop("_in", "_new")
        longer = _squared(relation, keys, bound) if doubling else None
        relation, doubling = (relation, False) if longer is None else (longer, True)


def _levels_of_large(nodes: DataFrame, edges: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, node, level) by doubling: ``level`` is first the longest walk of less than 2 * steps."""
    levels, relation, steps = cut_lineage(nodes.withColumn("level", F.lit(0).cast("bigint"))), cut_lineage(edges), 1
    most = levels.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0] or 0
    bound = GROWTH * relation.count()
    while True:
        offered = _carried(relation, levels, keys, "level")
        levels = cut_lineage(levels.join(offered, [*keys, "node"], "left").withColumn("level", F.greatest("level", F.col("_in") + steps)).drop("_in"))
        longer = _squared(relation, keys, bound) if 2 * steps <= most else None
        if longer is None:
            break
        if longer.isEmpty():
            return levels
        relation, steps = longer, 2 * steps
    # Shorter walks are final. The others wait for what lies ``steps`` before them; on cycles and behind them for ever.
    final = [levels.filter(F.col("level") < 2 * steps - 1)]
    open_ = cut_lineage(levels.filter(F.col("level") >= 2 * steps - 1))
    ready = final[0]
    entry = open_.withColumn("_best", F.col("level"))
    while True:
        offered = _carried(relation, ready, keys, "level")
        entry = cut_lineage(entry.join(offered, [*keys, "node"], "left").withColumn("_best", F.greatest("_best", F.col("_in") + steps)).drop("_in"))
        held = relation.join(entry.select(*keys, F.col("node").alias("src")), [*keys, "src"], "left_semi").select(*keys, F.col("dst").alias("node"))
        ready = cut_lineage(entry.join(held.distinct(), [*keys, "node"], "left_anti").select(*keys, "node", F.col("_best").alias("level")))
        if ready.isEmpty():
            return union_all(*final, entry.select(*keys, "node", F.lit(None).cast("bigint").alias("level")))
        final.append(ready)
        entry = entry.join(ready.select(*keys, "node"), [*keys, "node"], "left_anti")


def _longest_walks(nodes, edges):
    """Level of each node, in the order in which predecessors run out; nodes on cycles or behind them get none."""
    out, waiting = {}, dict.fromkeys(nodes, 0)
    for src, dst in edges:
        out.setdefault(src, []).append(dst)
        waiting[dst] += 1
    level, ready = dict.fromkeys(nodes, 0), [v for v, n in waiting.items() if n == 0]
    for v in ready:  # grows while it is read
        for dst in out.get(v, ()):
            level[dst] = max(level[dst], level[v] + 1)
            waiting[dst] -= 1
            if waiting[dst] == 0:
                ready.append(dst)
    done = set(ready)
    return [(v, level[v] if v in done else None) for v in nodes]


def _marked_before(nodes, edges):
    """1 for every node that leads to a marked one."""
    into, found = {}, [v for v, mark in nodes.items() if mark]
    for src, dst in edges:
        into.setdefault(dst, []).append(src)
    seen = set(found)
    for v in found:
        for src in into.get(v, ()):
            if src not in seen:
                seen.add(src)
                found.append(src)
    return [(v, 1 if v in seen else 0) for v in nodes]


def _each_group(keys, solve):
    """Rows arrive sorted by (keys, kind): a group's nodes, then its edges; one group is held at a time."""
    def run(batches):
        current, nodes, edges = None, {}, []
        for pdf in batches:
            out = []
            columns = [[tuple(v) if hasattr(v, "__iter__") and not isinstance(v, str) else v for v in pdf[k].tolist()] for k in keys]
            for *key, kind, a, b, mark in zip(*columns, pdf["kind"].tolist(), pdf["a"].tolist(), pdf["b"].tolist(), pdf["mark"].tolist()):
                if key != current:
                    if current is not None:
                        out += [(*current, *r) for r in solve(nodes, edges)]
                    current, nodes, edges = key, {}, []
                if kind == 0:
                    nodes[a] = mark
                else:
                    edges.append((a, b))
            yield pd.DataFrame(out, columns=[*keys, "node", "value"], dtype=object)
        if current is not None:
            yield pd.DataFrame([(*current, *r) for r in solve(nodes, edges)], columns=[*keys, "node", "value"], dtype=object)
    return run


def _solved(nodes: DataFrame, edges: DataFrame, keys: list[str], solve) -> DataFrame:
    """(keys, node, value) of groups known to be small; thousands of groups share one task and one Python call.

    ``nodes(keys, node, mark)``, ``edges(keys, src, dst)`` without loops, repeats or foreign ends.
    """
    types = dict(nodes.dtypes)
    ddl = ", ".join(f"{c} {types[c]}" for c in (*keys, "node"))
    none = F.lit(None).cast(types["node"])
    tagged = (nodes.select(*keys, F.lit(0).alias("kind"), F.col("node").alias("a"), none.alias("b"), F.col("mark").cast("int").alias("mark"))
              .unionByName(edges.select(*keys, F.lit(1).alias("kind"), F.col("src").alias("a"), F.col("dst").alias("b"), F.lit(0).alias("mark"))))
    return dealt(tagged, keys, ["kind"]).mapInPandas(_each_group(keys, solve), f"{ddl}, value bigint")


def dependency_levels(records: DataFrame, dependencies: DataFrame, keys: tuple[str, ...] = ("doc_id",), group_limit: int = GROUP_LIMIT) -> DataFrame:
    """(keys, record_id, level): length of the longest path into a record; null on cycles and behind them."""
    keys = list(keys)
    nodes = records.select(*keys, F.col("record_id").alias("node"))
    edges = cut_lineage(_inner_edges(nodes, dependencies, keys))
    large = _split_by_size(nodes, edges, keys, group_limit)
    few = lambda df: df.join(large, keys, "left_anti")
    out = _solved(few(nodes).withColumn("mark", F.lit(0)), few(edges), keys, _longest_walks).withColumnRenamed("value", "level")
    if not large.isEmpty():
        out = out.unionByName(_levels_of_large(nodes.join(large, keys, "left_semi"), edges.join(large, keys, "left_semi"), keys))
    return out.withColumnRenamed("node", "record_id")


def _smallest_first(indexes, edges):
    """Ready records taken smallest index first; whatever cycles hold back is left out."""
    waiting = {i: 0 for i in indexes}
    out: dict[int, list[int]] = {}
    for src, dst in edges:
        out.setdefault(src, []).append(dst)
        waiting[dst] += 1
    heap = [i for i, n in waiting.items() if n == 0]
    heapq.heapify(heap)
    order = []
    while heap:
        i = heapq.heappop(heap)
        order.append(i)
        for dst in out.get(i, ()):
            waiting[dst] -= 1
            if waiting[dst] == 0:
                heapq.heappush(heap, dst)
    return order


def _ranked(nodes, edges):
    """Positions of a group's indexes: the exact order, then what cycles hold back."""
    order = _smallest_first(nodes, edges)
    left = set(order)
    order += sorted(i for i in nodes if i not in left)
    return [(i, n) for n, i in enumerate(order)]


def _rank_small(rows: DataFrame, edges: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, idx, rank): exact ranks of groups known to be small."""
    nodes = rows.select(*keys, F.col("idx").alias("node"), F.lit(0).alias("mark"))
    links = edges.select(*keys, F.col("src_idx").alias("src"), F.col("dst_idx").alias("dst"))
    return _solved(nodes, links, keys, _ranked).withColumnsRenamed({"node": "idx", "value": "rank"})


def _largest_ancestor(rows: DataFrame, edges: DataFrame, keys: list[str]) -> DataFrame:
    """Adds ``key``: the largest index among a record and everything before it in its class."""
    nodes = rows.select(*keys, F.col("idx").alias("node"), F.col("idx").alias("key"))
    links = edges.select(*keys, F.col("src_idx").alias("src"), F.col("dst_idx").alias("dst"))
    return rows.join(_spread(nodes, links, keys, "key").withColumnRenamed("node", "idx"), [*keys, "idx"])


def topological_order(records: DataFrame, dependencies: DataFrame, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """(doc_id, chapter, record_id, pos): per chapter, the smallest ready original position first,
    records on or behind cycles last in their original order.

    A record held back by a later one leaves right after the largest position among its ancestors
    has left. So sorting by that position is exact between classes of equal value, and inside a
    class the holder goes first and the rule repeats for the others. Large groups are refined this
    way until every class fits ``group_limit``.
    """
    rows = records.select(*GROUP, "record_id", F.col("record_ord").cast("bigint").alias("idx"))
    named = rows.select(*GROUP, "record_id", "idx")
    edges = (dependencies.select("doc_id", "src", "dst").filter("src <> dst").distinct()
             .join(named.select("doc_id", "chapter", F.col("record_id").alias("src"), F.col("idx").alias("src_idx")), ["doc_id", "src"])
             .join(named.select("doc_id", "chapter", F.col("record_id").alias("dst"), F.col("idx").alias("dst_idx")), ["doc_id", "chapter", "dst"]))
    sizes = rows.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("_n"))
    large = sizes.filter(F.col("_n") > group_limit).select(*GROUP)
    small_ranks = _rank_small(rows.join(large, GROUP, "left_anti"), edges.join(large, GROUP, "left_anti"), GROUP)
    small = rows.join(small_ranks, [*GROUP, "idx"]).select(*GROUP, "record_id", (F.col("rank") + 1).alias("pos"))
    if large.isEmpty():
        return small
    return small.unionByName(_order_large(rows.join(large, GROUP, "left_semi"), edges.join(large, GROUP, "left_semi"), group_limit))


def _order_large(rows: DataFrame, edges: DataFrame, group_limit: int) -> DataFrame:
    as_text = lambda c: F.col(c).cast("string")
    levels = dependency_levels(rows.select(*GROUP, as_text("idx").alias("record_id")),
                               edges.select(*GROUP, as_text("src_idx").alias("src"), as_text("dst_idx").alias("dst")), tuple(GROUP), group_limit)
    free = levels.filter("level is not null").select(*GROUP, F.col("record_id").cast("bigint").alias("idx"))
    held = rows.join(free, [*GROUP, "idx"], "left_anti").withColumn("path", F.array(F.col("idx") + AFTER_ALL))
    # ``path`` is the sort key: the largest ancestor at each refinement, ending with a rank or the record itself.
    todo = cut_lineage(rows.join(free, [*GROUP, "idx"]).withColumn("path", F.array().cast("array<bigint>")))
    keys = [*GROUP, "path"]
    finished = [held]
    links = edges.select(*GROUP, "src_idx", "dst_idx").distinct()
    while not todo.isEmpty():
        at = lambda end: todo.select(*GROUP, F.col("idx").alias(f"{end}_idx"), F.col("path").alias(f"_{end}"))
        inside = links.join(at("src"), [*GROUP, "src_idx"]).join(at("dst"), [*GROUP, "dst_idx"]).filter("_src = _dst")
        inside = cut_lineage(inside.select(*GROUP, F.col("_src").alias("path"), "src_idx", "dst_idx"))
        keyed = _largest_ancestor(todo, inside, keys)
        leaders = keyed.filter("idx = key").withColumn("path", F.concat("path", F.array("key"))).drop("key")
        finished.append(leaders)
        rest = keyed.filter("idx <> key").withColumn("path", F.concat("path", F.array("key"))).drop("key")
        fits = rest.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).withColumn("_fits", F.col("_n") <= group_limit).drop("_n")
        rest = cut_lineage(rest.join(fits, keys))
        packed = rest.filter("_fits").drop("_fits")
        at_rest = lambda end: packed.select(*GROUP, F.col("idx").alias(f"{end}_idx"), F.col("path").alias(f"_{end}"))
        packed_edges = (links.join(at_rest("src"), [*GROUP, "src_idx"]).join(at_rest("dst"), [*GROUP, "dst_idx"]).filter("_src = _dst")
                        .select(*GROUP, F.col("_src").alias("path"), "src_idx", "dst_idx"))
        ranked = packed.join(_rank_small(packed, packed_edges, keys), [*keys, "idx"])
        finished.append(ranked.withColumn("path", F.concat("path", F.array("rank"))).drop("rank"))
        todo = cut_lineage(rest.filter("not _fits").drop("_fits"))
    out = cut_lineage(union_all(*finished)).withColumn("_first", F.col("path")[0])
    return with_position(out, GROUP, ["_first", "path"], "pos").select(*GROUP, "record_id", "pos")


def prune_reachable(records: DataFrame, dependencies: DataFrame, seeds: DataFrame, group_limit: int = GROUP_LIMIT) -> tuple[DataFrame, DataFrame]:
    """Records from which a seed can be reached, and the dependencies among them.

    A seed or a dependency's end that is no record still leads on; only records are returned.
    """
    keys = ["doc_id"]
    edges = cut_lineage(dependencies.select(*keys, "src", "dst").filter("src <> dst").distinct())
    marked = seeds.select(*keys, F.col("record_id").alias("node"), F.lit(1).alias("mark"))
    ends = [edges.select(*keys, F.col(end).alias("node"), F.lit(0).alias("mark")) for end in ("src", "dst")]
    nodes = cut_lineage(union_all(marked, *ends).groupBy(*keys, "node").agg(F.max("mark").alias("mark")))
    large = _split_by_size(nodes, edges, keys, group_limit)
    few = lambda df: df.join(large, keys, "left_anti")
    reached = _solved(few(nodes), few(edges), keys, _marked_before).filter("value = 1").select(*keys, "node")
    if not large.isEmpty():
        many = lambda df: df.join(large, keys, "left_semi")
        backward = many(edges).select(*keys, F.col("dst").alias("src"), F.col("src").alias("dst"))
        reached = reached.unionByName(_spread(many(nodes), backward, keys, "mark").filter("mark = 1").select(*keys, "node"))
    seen = cut_lineage(reached.withColumnRenamed("node", "record_id"))
    kept = records.join(seen, ["doc_id", "record_id"], "left_semi")
    ids = kept.select("doc_id", "record_id")
    inner = (dependencies.join(ids.withColumnRenamed("record_id", "src"), ["doc_id", "src"], "left_semi")
             .join(ids.withColumnRenamed("record_id", "dst"), ["doc_id", "dst"], "left_semi"))
    return kept, inner


def prune_summary(records: DataFrame, kept: DataFrame, units: DataFrame) -> DataFrame:
    """Counts per document of what pruning kept: records by origin and status, teaching units, and what went.

    ``records(doc_id, record_id, source_node_id, generated, status)``, ``units(doc_id, record_id)``. A document that lost every record is listed too.
    """
    before = records.groupBy("doc_id").agg(F.count(F.lit(1)).alias("before"))
    now = kept.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("records"), F.count_if(F.col("source_node_id").isNotNull()).alias("source_records"), F.count_if(F.coalesce("generated", F.lit(False))).alias("generated_prerequisites"),
        F.count_if(F.col("status") == "expansion_required").alias("pending"), F.count_if(F.col("status") == "unresolved_prerequisite").alias("unresolved_prerequisites"))
    teaching = units.join(kept.select("doc_id", "record_id"), ["doc_id", "record_id"], "left_semi").groupBy("doc_id").agg(F.count(F.lit(1)).alias("units"))
    out = before.join(now, "doc_id", "left").join(teaching, "doc_id", "left").fillna(0)
    return out.withColumn("pruned", F.col("before") - F.col("records"))
