import random

import pytest
from pyspark.sql import functions as F

from docloom.functions.ordering import with_position, with_running
from docloom.operators import enrichment as en
from docloom.operators import ordering as od
from docloom.operators import prose as pr
from docloom.operators import teaching as te

PACKED = ("The night train leaves the harbour at nine, crosses the long iron bridge while the river traffic passes under it, and stops at every small station on the plain because the "
          "morning papers have to be dropped there. Freight waits on the second track. A guard counts the mail bags. Nobody on the platform knows which of the carriages will be taken off in the hills.")


def reference_order(n, edges):
    left = set(range(n))
    order = []
    while True:
        ready = [v for v in sorted(left) if not any(a in left and b == v for a, b in edges)]
        if not ready:
            return order + sorted(left)
        order.append(ready[0])
        left.remove(ready[0])


@pytest.mark.parametrize("limit,seed", [(1000, 1), (3, 2), (1, 3), (1, 4)])
def test_topological_order_is_exact_for_small_and_large_groups(spark, limit, seed):
    rng = random.Random(seed)
    rows, deps, want = [], [], {}
    for doc in range(3):
        n = 14
        rank = list(range(n))
        rng.shuffle(rank)
        edges = {(a, b) for a, b in ((rng.randrange(n), rng.randrange(n)) for _ in range(16)) if rank[a] < rank[b]}
        if doc == 2:
            edges |= {(3, 9), (9, 3), (9, 1)}
        want[doc] = reference_order(n, edges)
        rows += [(doc, "c", f"r{i:02d}", i) for i in range(n)]
        deps += [(doc, f"r{a:02d}", f"r{b:02d}") for a, b in edges]
    out = od.topological_order(spark.createDataFrame(rows, "doc_id bigint, chapter string, record_id string, record_ord bigint"),
                               spark.createDataFrame(deps, "doc_id bigint, src string, dst string"), limit)
    got = out.orderBy("doc_id", "pos").collect()
    for doc in want:
        assert [int(r.record_id[1:]) for r in got if r.doc_id == doc] == want[doc]


def test_prune_keeps_prerequisites_and_stops_on_cycles(spark):
    records = spark.createDataFrame([(1, r) for r in "abcdxy"], "doc_id bigint, record_id string")
    deps = spark.createDataFrame([(1, "a", "b"), (1, "b", "a"), (1, "b", "c"), (1, "d", "a"), (1, "x", "y")], "doc_id bigint, src string, dst string")
    kept, inner = od.prune_reachable(records, deps, spark.createDataFrame([(1, "c")], "doc_id bigint, record_id string"))
    assert sorted(r.record_id for r in kept.collect()) == list("abcd") and inner.count() == 4


def test_levels(spark):
    records = spark.createDataFrame([(1, r) for r in "abcxyz"], "doc_id bigint, record_id string")
    deps = spark.createDataFrame([(1, "a", "b"), (1, "b", "c"), (1, "a", "c"), (1, "x", "y"), (1, "y", "x"), (1, "y", "z")], "doc_id bigint, src string, dst string")
    assert {r.record_id: r.level for r in od.dependency_levels(records, deps).collect()} == {"a": 0, "b": 1, "c": 2, "x": None, "y": None, "z": None}


def brute_levels(nodes, edges):
    """Longest path into each node; None where a walk of as many steps as there are nodes ends."""
    best = dict.fromkeys(nodes, 0)
    for _ in range(2 * len(nodes) + 2):
        best = {v: max([best[v]] + [best[a] + 1 for a, b in edges if b == v]) for v in nodes}
    return {v: n if n < len(nodes) else None for v, n in best.items()}


def graph_rows(seed):
    rng = random.Random(seed)
    shapes = {1: [(i, i + 1) for i in range(40)], 2: [(i, i + d) for i in range(30) for d in (1, 2)], 3: [(rng.randrange(25), rng.randrange(25)) for _ in range(30)],
              4: [(0, i) for i in range(1, 30)] + [(i, 30) for i in range(1, 30)] + [(30, 31), (31, 32)], 5: [(i, (i + 1) % 7) for i in range(7)] + [(3, 8), (8, 9), (10, 0), (11, 12)], 6: [(1, 1)]}
    nodes = {doc: sorted({v for e in edges for v in e}) for doc, edges in shapes.items()}
    return shapes, nodes


@pytest.mark.parametrize("limit,growth", [(1000, 4), (1, 4), (1, 0)])
def test_levels_and_reachability_of_small_and_large_groups(spark, limit, growth, monkeypatch):
    """Solved in a task, by doubling, and with the square refused at once."""
    monkeypatch.setattr(od, "GROWTH", growth)
    shapes, nodes = graph_rows(7)
    records = spark.createDataFrame([(d, f"r{v:02}") for d, vs in nodes.items() for v in vs] + [(7, "alone")], "doc_id bigint, record_id string")
    deps = spark.createDataFrame([(d, f"r{a:02}", f"r{b:02}") for d, es in shapes.items() for a, b in es] + [(1, "gone", "r00")], "doc_id bigint, src string, dst string")
    got = {(r.doc_id, r.record_id): r.level for r in od.dependency_levels(records, deps, group_limit=limit).collect()}
    want = {(d, f"r{v:02}"): n for d in nodes for v, n in brute_levels(nodes[d], [e for e in shapes[d] if e[0] != e[1]]).items()}
    assert got == {**want, (7, "alone"): 0}
    seeds = [(1, 20), (2, 11), (3, 4), (4, 5), (5, 9), (5, 12)]
    kept, inner = od.prune_reachable(records, deps, spark.createDataFrame([(d, f"r{v:02}") for d, v in seeds] + [(7, "alone"), (7, "none")], "doc_id bigint, record_id string"), limit)
    reach = {(d, v) for d, v in seeds if v in nodes[d]}
    while more := {(d, a) for d, es in shapes.items() for a, b in es if (d, b) in reach} - reach:
        reach |= more
    assert {(r.doc_id, r.record_id) for r in kept.collect()} == {(d, f"r{v:02}") for d, v in reach} | {(7, "alone")}
    assert inner.count() == sum((d, a) in reach and (d, b) in reach for d, es in shapes.items() for a, b in es)


def test_long_chain_takes_few_rounds(spark, monkeypatch):
    """Ten thousand records in a row, none of them solved in one task."""
    n, rounds, carried = 10_000, [], od._carried
    monkeypatch.setattr(od, "_carried", lambda *a: rounds.append(1) or carried(*a))
    records = spark.range(n).select(F.lit(1).cast("bigint").alias("doc_id"), F.format_string("r%05d", "id").alias("record_id"), F.col("id").alias("record_ord"))
    deps = spark.range(n - 1).select(F.lit(1).cast("bigint").alias("doc_id"), F.format_string("r%05d", F.col("id") + 1).alias("src"), F.format_string("r%05d", "id").alias("dst"))
    levels = od.dependency_levels(records, deps, group_limit=100)
    assert levels.selectExpr("count(*)", "max(level)", "count_if(level = 9999 - cast(substr(record_id, 2) as int))").first()[0:3] == (n, n - 1, n)
    assert len(rounds) <= 16
    rounds.clear()
    kept, _ = od.prune_reachable(records, deps, spark.createDataFrame([(1, "r00000")], "doc_id bigint, record_id string"), 100)
    assert kept.count() == n and len(rounds) <= 16


def test_prune_summary_counts_what_went(spark):
    records = spark.createDataFrame([(1, "a", "n1", False, "source_ready"), (1, "b", "n2", False, "expansion_required"), (1, "c", None, True, "unresolved_prerequisite"), (2, "a", "n1", None, "source_ready")],
                                    "doc_id bigint, record_id string, source_node_id string, generated boolean, status string")
    units = spark.createDataFrame([(1, "a"), (1, "a"), (1, "c"), (2, "a")], "doc_id bigint, record_id string")
    out = od.prune_summary(records, records.filter("doc_id = 1 and record_id <> 'b'"), units).orderBy("doc_id").collect()
    assert [r.asDict() for r in out] == [
        dict(doc_id=1, before=3, records=2, source_records=1, generated_prerequisites=1, pending=0, unresolved_prerequisites=1, units=3, pruned=1),
        dict(doc_id=2, before=1, records=0, source_records=0, generated_prerequisites=0, pending=0, unresolved_prerequisites=0, units=0, pruned=1)]


def test_report_accepts_only_complete_documents(spark):
    """One document passes; each other breaks one gate: a label, a pending record, the length, a dense record, a record without units."""
    rows = [(d, f"r{d}", f"n{d}", "Words are here [R1]", False, False, "source_ready", 1) for d in range(1, 7)]
    rows[2] = (3, "r3", "n3", "Words are here [R1]", False, False, "expansion_required", 1)
    rows[4] = (5, "r5", "n5", "Words are here [R1]", True, False, "expanded", 2)
    records = spark.createDataFrame(rows, "doc_id bigint, record_id string, source_node_id string, source_anchor string, dense boolean, generated boolean, status string, minimum_units bigint")
    units = spark.createDataFrame([(d, f"r{d}") for d in range(1, 6)], "doc_id bigint, record_id string")
    text = "# Guide\n\n<!-- docloom:source {} -->\n\nWords are here [R1]\n"
    documents = spark.createDataFrame([(d, text.replace("[R1]", "none") if d == 2 else text) for d in range(1, 7)], "doc_id bigint, text string")
    sources = spark.createDataFrame([(d, "Words are here " * (9 if d == 4 else 1)) for d in range(1, 7)], "doc_id bigint, text string")
    out = {r.doc_id: r for r in te.assembly_report(records, units, documents, sources).collect()}
    assert {d: r.accepted for d, r in out.items()} == {1: True, 2: False, 3: False, 4: False, 5: False, 6: False}
    assert (out[1].output_words, out[2].missing_labels, out[5].expanded_dense, out[6].mapped) == (5, 1, 0, 0)


def test_positions_and_running_values_do_not_depend_on_blocks(spark):
    df = spark.createDataFrame([(d, o * 3, float(o % 5)) for d in range(2) for o in range(50)], "k bigint, o bigint, v double")
    placed = with_position(df, ["k"], ["o"], "p", block_rows=4).collect()
    assert all(r.p == r.o // 3 + 1 for r in placed)
    run = with_running(df, ["k"], ["o"], {"s": ("sum", F.col("v")), "m": ("max", F.col("v"))}, block_rows=4).filter("k = 1").orderBy("o").collect()
    total, top = 0, 0
    for i, r in enumerate(run):
        total, top = total + i % 5, max(top, i % 5)
        assert (r.s, r.m) == (total, top)


def test_new_ids_skip_used_ones(spark):
    nodes = spark.createDataFrame([(1, i) for i in ("split-000001", "split-000003", "split-000004", "split-12", "n1")] + [(2, "n1")], "doc_id bigint, node_id string")
    fresh = spark.createDataFrame([(1, i) for i in range(4)] + [(2, 0)], "doc_id bigint, item_pos bigint")
    out = en.derive_node_ids(fresh, nodes, "split-", ["item_pos"]).orderBy("doc_id", "item_pos").collect()
    assert [r.node_id for r in out] == ["split-000002", "split-000005", "split-000006", "split-000007", "split-000001"]


def expansion(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, batch_no bigint, item_pos bigint, record_id string, pos bigint, role string, basis string, text string, requires array<string>, citation_required boolean")


def test_expansion_creates_prerequisites_once(spark):
    records = spark.createDataFrame([(1, 1, "r1", "n1", "Chapter 1", "model", "Track gauge.", None, None, True, "expansion_required", 2, False, 0)],
                                    "doc_id bigint, record_ord bigint, record_id string, source_node_id string, chapter string, kind string, source_anchor string, density_score double, density_source string, dense boolean, status string, minimum_units bigint, generated boolean, expansion_depth bigint")
    requests = records.select("doc_id", F.lit(1).cast("bigint").alias("batch_no"), "record_id", "source_node_id", "minimum_units")
    units = expansion(spark, [(1, 1, 1, "r1", 1, "statement", "source", "A.", ["rail width", "sleeper spacing", "Rail  Width"], False),
                              (1, 1, 1, "r1", 2, "mechanism", "source", "B.", ["wheel flange", "track gauge"], False),
                              (1, 1, 1, "r1", 3, "prerequisite", "common_knowledge", "C.", ["loading limit"], True)])
    good, failed = te.validate_expansion(units, requests)
    assert good.count() == 3 and failed.count() == 0
    known = spark.createDataFrame([(1, "track gauge")], "doc_id bigint, concept string")
    made = spark.createDataFrame([], "doc_id bigint, record_id string")
    out = te.expand_prerequisites(records, known, made, good, 0)
    assert out["new_records"].count() == 4 and out["dependencies"].count() == 4
    assert {r.status for r in out["records"].filter("record_id = 'r1'").collect()} == {"expanded"}
    assert [r.epistemic_status for r in out["units"].orderBy("unit_id").collect()] == ["source_grounded", "source_grounded", "citation_needed"]
    assert te.expand_prerequisites(records, known, made, good, 2)["new_records"].count() == 0


def test_frontier_resumes_at_a_later_depth(spark):
    records = spark.createDataFrame([(1, 1, "r1", None, "Chapter 1", "model_prerequisite", "Rail width", None, None, False, "expansion_required", 1, True, 1)],
                                    "doc_id bigint, record_ord bigint, record_id string, source_node_id string, chapter string, kind string, source_anchor string, density_score double, density_source string, dense boolean, status string, minimum_units bigint, generated boolean, expansion_depth bigint")
    answers = expansion(spark, [(1, 1, 1, "r1", 1, "statement", "common_knowledge", "D.", ["wheel flange"], False)]).withColumn("depth", F.lit(1))
    known = spark.createDataFrame([], "doc_id bigint, concept string")
    units = spark.createDataFrame([], "doc_id bigint, record_id string, unit_pos bigint, unit_id string, role string, text string, provenance string, epistemic_status string, expansion_depth bigint")
    out = te.expansion_frontier(records, known, units, answers, max_depth=2)
    assert {r.status for r in out["records"].filter("record_id = 'r1'").collect()} <= {"expanded", "expansion_required"}
    assert out["dependencies"] is not None and out["issues"] is not None
    assert out["records"].filter("status = 'expanded'").count() + out["issues"].count() >= 1
    none = te.expansion_frontier(records.limit(0), known, units, answers, max_depth=1)
    assert none["dependencies"].count() == none["issues"].count() == 0


@pytest.mark.parametrize("role,basis,text", [("poem", "source", "x"), ("statement", "rumor", "x"), ("statement", "source", " "), ("statement", "source", PACKED), ("statement", "common_knowledge", "x")])
def test_one_bad_unit_rejects_the_batch(spark, role, basis, text):
    requests = spark.createDataFrame([(1, 1, "r1", "n1", 2)], "doc_id bigint, batch_no bigint, record_id string, source_node_id string, minimum_units bigint")
    units = expansion(spark, [(1, 1, 1, "r1", 1, "statement", "source", "Fine.", [], False), (1, 1, 1, "r1", 2, role, basis, text, [], False)])
    good, failed = te.validate_expansion(units, requests)
    assert good.count() == 0 and failed.count() == 1


def test_split_loses_no_sentence(spark):
    row = pr.split_dense_prose(spark.createDataFrame([(1, PACKED)], "doc_id bigint, text string")).first()
    assert row.split_count > 0 and row.text.replace("\n\n", " ").strip() == PACKED
    assert pr.dense_paragraphs(spark.createDataFrame([(1, row.text)], "doc_id bigint, text string")).count() == 0


def test_split_leaves_protected_blocks_alone(spark):
    text = '# Timetable\n\n- north\n- south\n\n$$\nt=d/v\n$$\n\n<!-- docloom:issue {"id":"late-7"} -->\n'
    row = pr.split_dense_prose(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert row.text == text and row.split_count == 0


def test_dense_rule(spark):
    comment = '<!-- docloom:issue {"need":"' + "word. " * 120 + '"} -->'
    rows = pr.dense_paragraphs(spark.createDataFrame([(1, PACKED), (2, comment), (3, "word " * 95 + "end.")], "doc_id bigint, text string")).orderBy("doc_id").collect()
    assert [(r.doc_id, r.sentences) for r in rows] == [(1, 4), (3, 1)]


def test_replace_named_blocks(spark):
    documents = spark.createDataFrame([(1, "zero\n\none\n\ntwo\n")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, 1, ["a", "b"])], "doc_id bigint, block bigint, paragraphs array<string>")
    assert pr.apply_replacements(documents, items).first().text == "zero\n\na\n\nb\n\ntwo\n"


def test_navigation(spark):
    units = spark.createDataFrame([("u0", "- [Stations](#stations)"), ("u1", "The plain."), ("u2", " larger letters "), ("u3", "Print this page")], "unit_id string, text string")
    assert sorted(r.unit_id for r in te.navigation_units(units, (r"(?m)^-\s*\[[^\]]+\]\(#[^)]+\)\s*$", r"(?i)\Alarger letters\z", r"\APrint this page\z")).collect()) == ["u0", "u2", "u3"]


def test_groups_stay_whole_when_the_session_merges_partitions_of_each_side(spark):
    # Many small documents with uneven numbers of records and dependencies, read through shuffled joins.
    conf = {"spark.sql.shuffle.partitions": "32", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        docs = spark.range(3000).select(F.col("id").alias("doc_id"))
        name = lambda i: F.concat(F.lit("r"), i.cast("string"))
        records = docs.select("doc_id", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("i")).select("doc_id", name(F.col("i")).alias("record_id"))
        deps = docs.filter("doc_id % 3 > 0").select("doc_id", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("i")).select("doc_id", name(F.col("i")).alias("src"), name(F.col("i") + 1).alias("dst"))
        levels = od.dependency_levels(records, deps)
        right = levels.filter(F.col("level") == F.when((F.col("doc_id") % 3 > 0) & (F.col("record_id") <= "r5"), F.substring("record_id", 2, 1).cast("int")).otherwise(0))
        assert (levels.count(), right.count()) == (30_000, 30_000)
        kept, inner = od.prune_reachable(records, deps, docs.select("doc_id", F.lit("r5").alias("record_id")))
        assert (kept.count(), inner.count()) == (13_000, 10_000)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_depths_without_accepted_answers_move_no_records(spark, monkeypatch):
    columns = "doc_id bigint, record_ord bigint, record_id string, source_node_id string, chapter string, kind string, source_anchor string, density_score double, density_source string, dense boolean, status string, minimum_units bigint, generated boolean, expansion_depth bigint"
    records = spark.createDataFrame([(1, 1, "r1", None, "Chapter 1", "model_prerequisite", "Rail width", None, None, False, "expansion_required", 1, True, 0)], columns)
    answers = expansion(spark, [(1, 1, 1, "r1", 1, "poem", "common_knowledge", "D.", ["wheel flange"], False)]).withColumn("depth", F.lit(0))
    units = spark.createDataFrame([], "doc_id bigint, record_id string, unit_pos bigint, unit_id string, role string, text string, provenance string, epistemic_status string, expansion_depth bigint")
    calls, expand = [], te.expand_prerequisites
    monkeypatch.setattr(te, "expand_prerequisites", lambda *a, **k: calls.append(a) or expand(*a, **k))
    out = te.expansion_frontier(records, spark.createDataFrame([], "doc_id bigint, concept string"), units, answers, max_depth=1)
    assert not calls
    assert [(r.record_id, r.status) for r in out["records"].collect()] == [("r1", "expansion_required")]
    assert [(r.doc_id, r.depth) for r in out["issues"].collect()] == [(1, 0)] and out["dependencies"].count() == out["units"].count() == 0


def test_assembly_joins_each_record_text_once(spark, tmp_path):
    from docloom.operators import teaching as te

    rows = [(1, i, f"r{i}", f"n{i}", "One" if i < 3 else "Two", f"Text {i}", "expansion_required" if i == 2 else "source_ready") for i in range(1, 5)]
    spark.createDataFrame(rows, "doc_id bigint, record_ord bigint, record_id string, source_node_id string, chapter string, source_anchor string, status string").write.parquet(str(tmp_path / "records"))
    records = spark.read.parquet(str(tmp_path / "records"))
    order = spark.createDataFrame([(1, "One", "r2", 1), (1, "One", "r1", 2), (1, "Two", "r3", 1), (1, "Two", "r4", 2)], "doc_id bigint, chapter string, record_id string, pos bigint")
    units = spark.createDataFrame([(1, f"r{i}", 1, "source_statement", f"Text {i}") for i in (1, 3, 4)], "doc_id bigint, record_id string, unit_pos bigint, role string, text string")
    lists = spark.createDataFrame([(1, "r1", ["u1"])], "doc_id bigint, id string, source_unit_ids array<string>")
    gaps = spark.createDataFrame([], "doc_id bigint, gap_id string, node_ord bigint, gap_type string, need string, resolution_status string, resolved boolean")
    parts = te.document_parts(records, order, lists, units, gaps, lists, "Guide")
    plan = parts._jdf.queryExecution().sparkPlan().toString()
    assert sum("FileScan" in line and "source_anchor" in line for line in plan.splitlines()) == 1
    text = te.assemble_document(parts).collect()[0].text
    pieces = text.rstrip("\n").split("\n\n")
    assert pieces[:2] == ["# Guide", "## One"] and [p for p in pieces if p.startswith("Text")] == ["Text 1", "Text 3", "Text 4"]
    assert '"id":"r2"' in pieces[2] and '"id":"issue-r2"' in pieces[3] and '"sourceUnitIds":["u1"]' in pieces[4] and len(pieces) == 11


def test_report_of_marks_equals_report_of_assembled_books(spark):
    from docloom.functions.text import dense_block_count
    from docloom.operators.annotate import issue_ids

    rng = random.Random(6)
    prose = "One two three four five six seven eight nine. " * 5
    pieces = [prose, "Short.", "\n\n", "\n", "<!-- docloom:issue {\"id\":\"a\"} -->", "<!-- docloom:resolved {\"id\":\"b\"} -->", "<!-- docloom:issue {broken} -->", "<!-- docloom:issue {\"id\":\"c\"",
              "<!-- docloom:issue {\"id\":\"d", "\"} -->", "} -->", "}", "-->", "<!-- docloom:issue", "{\"id\":\"e\"} -->", "<!--", " ", "", "---"]
    texts = [(d, s, "".join(rng.choice(pieces) + rng.choice(["", " ", "\n\n"]) for _ in range(rng.randint(0, 5)))) for d in range(150) for s in range(1, rng.randint(2, 7))]
    sections = spark.createDataFrame([(d, s, "Title", t) for d, s, t in texts], "doc_id bigint, section bigint, title string, text string")
    written = spark.createDataFrame([(d, s, rng.choice([t, t[::2], "Written.\n\n" + prose, None]), rng.random() < 0.5) for d, s, t in texts if rng.random() < 0.6],
                                    "doc_id bigint, section bigint, text string, reused boolean")
    books = pr.assemble_book(pr.section_disposition(sections, written))
    want = {r.doc_id: (r.dense, len(set(r.ids))) for r in books.select("doc_id", dense_block_count(F.col("text")).alias("dense"), issue_ids(F.col("text")).alias("ids")).collect()}
    lost = {r.doc_id: r.n for r in pr.missing_issues(sections, books, ["doc_id"]).groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    report = {r.doc_id: r for r in pr.book_report(pr.section_disposition(sections, written, body=pr.BOOK_MARKS), sections).collect()}
    assert {d: (r.dense, r.kept_issues) for d, r in report.items()} == want and {d: r.missing_issues for d, r in report.items() if r.missing_issues} == lost
    assert len({n for _, n in want.values()}) > 2 and sum(n for n, _ in want.values()) > 100


def test_sections_and_their_report_shuffle_no_text(spark, tmp_path):
    from docloom.plans import QUERIES

    lines = ["".join(rng.choices("bcdfghjklmnpqrstvwxz ", k=4_000)) for rng in [random.Random(7)] for _ in range(90)]
    docs = [(d, "\n".join(["", *lines[d * 9:d * 9 + 4], "  ", *lines[d * 9 + 4:d * 9 + 9]][d % 2:])) for d in range(10)]
    spark.createDataFrame(docs, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    store, gateway = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._gateway

    def moved():
        stages = store.stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), None)
        return sum(stages.apply(i).shuffleWriteBytes() + stages.apply(i).outputBytes() for i in range(stages.size()))
    before = moved()
    rows = QUERIES["book_report"](spark, str(tmp_path)).collect()
    assert len(rows) >= 5 and moved() - before < 120_000  # the texts have 360,000 bytes; some documents have no top heading


def teaching_corpus(spark, folder):
    spark.createDataFrame([(i, "\n".join(f"{i} {n} A line of words, and more of them." for n in range(40))) for i in range(1, 9)], "doc_id bigint, text string").write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def staged_texts(spark, sf):
    from docloom.plans import fixtures

    paths = {name: path for (_, folder, name), path in fixtures._STAGED.items() if folder == sf}
    return {name for name, path in paths.items() if {"text", "src_text", "source_anchor", "title"} & set(spark.read.parquet(path).columns)}


def test_records_are_ordered_without_writing_texts(spark, tmp_path):
    from docloom.plans import teaching

    sf = teaching_corpus(spark, tmp_path)
    rows = teaching.topological_order(spark, sf).collect()
    assert {r.chapter for r in rows if r.doc_id == 1} and all(r.chapter.startswith("Chapter ") for r in rows)
    assert staged_texts(spark, sf) == set()


def test_frontiers_carry_no_texts_of_records(spark, tmp_path, monkeypatch):
    from docloom.plans import teaching

    sf, cut, real = teaching_corpus(spark, tmp_path), [], te.cut_lineage
    monkeypatch.setattr(te, "cut_lineage", lambda df: cut.append(df.columns) or real(df))
    assert teaching.expansion_frontier(spark, sf).collect()
    assert staged_texts(spark, sf) == {"fx_requests", "fx_expansions"}
    assert cut and not any("source_anchor" in columns and "record_ord" in columns for columns in cut)


def test_texts_of_documents_are_shuffled_once(spark, tmp_path):
    from docloom.plans import teaching

    sf = teaching_corpus(spark, tmp_path)
    out = te.assemble_document(teaching.document_parts(spark, sf))
    above = out._jdf.queryExecution().executedPlan().toString().split("Window", 1)[0]
    assert "Exchange" not in above and sum(r.text.startswith("# Guide\n") for r in out.collect()) == 8
    assert staged_texts(spark, sf) == set()


def test_assembly_reports_write_no_document(spark, tmp_path):
    from docloom.plans import teaching

    sf = teaching_corpus(spark, tmp_path)
    assert len(teaching.assembly_report(spark, sf).collect()) == 8 and staged_texts(spark, sf) == set()
