"""Answer texts to typed rows, the repair tree, the answer store, and graphs built from documents and answers."""
import json
import random

import pytest
from pyspark.sql import functions as F

from docloom.operators import answer_store as st
from docloom.operators import answers as an
from docloom.operators import build as bd
from docloom.operators import extraction as ex


def asked(spark, texts, spec, **how):
    rows = spark.createDataFrame(list(enumerate(texts, 1)), "k bigint, response string")
    return an.read_answers(rows, ["k"], spec, **how)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_answers_without_items_are_issues(spark):
    texts = ['{"scores":[]}', "no json", "null", "[1]", '{"scores":{}}', '```json\n{"scores":[{"id":"a","score":1}]}\n```', 'Sure: {"scores":[{"id":"b","score":2}]} done', None, "", '{"other":[]}', '{"scores":[{"id":"c"']
    out = asked(spark, texts, an.SCORES)
    assert rows_of(out["scores"], "k", "pos", "node_id", "score") == [(6, 1, "a", 1.0)]
    assert rows_of(out["issues"], "k", "category", "detail") == sorted([(k, "bad_json", "") for k in (2, 7, 8, 9, 11)] + [(k, "missing_list", "scores") for k in (3, 4, 5, 10)], key=repr)
    sliced = asked(spark, texts, an.SCORES, brace_slice=True)
    assert rows_of(sliced["scores"], "k", "node_id") == [(6, "a"), (7, "b")]


def test_members_of_other_types_are_null_and_named(spark):
    items = [{"id": "a", "score": "high", "reasons": ["x", 1, None, "y"]}, {"id": 7, "score": True}, {"id": None, "score": 1e400}, 5, None, [], {"score": 0.5, "reasons": "no"}, {"id": "b", "score": 3}]
    text = json.dumps({"scores": items}).replace("Infinity", "1e300")
    out = asked(spark, [text], an.SCORES)
    assert [tuple(r) for r in out["scores"].orderBy("pos").select("node_id", "score", "reasons", "wrong").collect()] == [
        ("a", None, ["x", "y"], ["score"]), (None, None, [], ["id", "score"]), (None, 1e300, [], []), (None, None, [], ["*"]), (None, None, [], ["*"]), (None, None, [], ["*"]),
        (None, 0.5, [], ["reasons"]), ("b", 3.0, [], [])]
    assert rows_of(an.type_verdicts(out, ["k"]), "list", "item_pos", "pos", "member") == sorted([("scores", None, p, m) for p, m in
        ((1, "score"), (2, "id"), (2, "score"), (4, "*"), (5, "*"), (6, "*"), (7, "reasons"))], key=repr)


def test_indexes_keep_what_is_no_index(spark):
    frames = [{"claim": 1, "evidence": [0, 1.0, 1.5, "2", None], "warrantGap": None}, {"claim": 2.5, "evidence": "x", "warrantGap": 3, "limitations": [4]}, {"claim": "1"}, {"claim": 2 ** 60, "warrantGap": "g"}]
    out = asked(spark, [json.dumps({"nodes": [], "edges": [{"from": 0, "to": 1e0, "relation": "x"}], "evidenceFrames": frames})], an.EXTRACTION)
    assert [tuple(r) for r in out["frames"].orderBy("pos").select("claim", "evidence", "warrant_gap", "limitations").collect()] == [
        (1, [0, 1, -1, -1, -1], None, []), (None, [], 3, [4]), (None, [], -1, []), (None, [], -1, [])]
    assert rows_of(out["edges"], "src", "dst") == [(0, 1)]


def test_inner_lists_carry_their_item(spark):
    answer = {"items": [{"recordId": "r1", "units": [{"role": "statement", "text": " a ", "requires": ["x"], "citationRequired": True}, {"text": 1}]}, {"recordId": "r2"}, {"recordId": "r3", "units": []}]}
    out = asked(spark, [json.dumps(answer)], an.TEACHING)
    assert rows_of(out["units"], "item_pos", "record_id", "pos", "role", "text", "citation_required", "wrong") == sorted([(1, "r1", 1, "statement", " a ", True, []), (1, "r1", 2, None, None, None, ["text"])], key=repr)
    assert rows_of(out["items"], "pos", "record_id", "wrong") == [(1, "r1", []), (2, "r2", ["units"]), (3, "r3", [])]
    assert out["issues"].count() == 0


# The repair tree


def tree_units(spark, n=9, length=10):
    return spark.createDataFrame([(1, "c1", i, f"u{i:06}", "prose", "x" * length) for i in range(1, n + 1)] + [(1, "c2", 20, "u000020", "code", "alone")],
                                 "doc_id bigint, chunk_id string, unit_ord bigint, unit_id string, kind string, text string")


def brute_tree(units, ok, max_depth):
    """(path, outcome, units) of the parts, halving."""
    out = []

    def visit(path, own, depth):
        if ok.get(path) is None:
            out.append((path, "ask", own))
        elif ok[path]:
            out.append((path, "answer", own))
        elif len(own) > 1 and depth < max_depth:
            out.append((path, "split", own))
            middle = -(-len(own) // 2)
            for k, part in enumerate((own[:middle], own[middle:]), 1):
                visit(f"{path}.{k:06}", part, depth + 1)
        else:
            out.append((path, "fallback", own))

    visit("", units, 0)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_repair_tree_splits_and_combines(spark, seed):
    draw, ok = random.Random(seed), {}
    for depth in range(4):
        for k in range(2 ** depth):
            path = "".join(f".{(k >> (depth - 1 - i) & 1) + 1:06}" for i in range(depth))
            ok[path] = draw.random() < 0.35
    ok[""] = False
    units = tree_units(spark)
    answers = spark.createDataFrame([(1, "c1", p, good, "late") for p, good in ok.items()] + [(1, "c2", "", False, "late")], "doc_id bigint, chunk_id string, path string, ok boolean, reason string")
    parts, members = ex.repair_tree(units, answers)
    want = brute_tree(list(range(1, 10)), ok, 3)
    assert rows_of(parts.filter("chunk_id = 'c1'"), "path", "outcome") == sorted((p, o) for p, o, _ in want)
    assert rows_of(members.filter("chunk_id = 'c1'"), "path", "unit_ord") == sorted((p, u) for p, o, own in want if o != "split" for u in own)
    # Answers give a node per unit, an edge between neighbours and a frame over the first two.
    leaves = {p: own for p, o, own in want if o == "answer"}
    nodes = spark.createDataFrame([(1, "c1", p, i, "claim", f"text {u}") for p, own in leaves.items() for i, u in enumerate(own)], "doc_id bigint, chunk_id string, path string, idx bigint, kind string, text string")
    edges = spark.createDataFrame([(1, "c1", p, i, i + 1) for p, own in leaves.items() for i in range(len(own) - 1)], "doc_id bigint, chunk_id string, path string, src bigint, dst bigint")
    frames = spark.createDataFrame([(1, "c1", p, 0, [1], 1, [0]) for p, own in leaves.items() if len(own) > 1], "doc_id bigint, chunk_id string, path string, claim bigint, evidence array<bigint>, warrant_gap bigint, limitations array<bigint>")
    out = ex.combine_tree(parts, members, nodes, edges, frames)
    texts, links, pairs, first = [], [], [], []
    for p, o, own in sorted(x for x in want if x[1] != "split"):
        base = len(texts)
        texts += [f"text {u}" if o == "answer" else "x" * 10 for u in own] + ([None] if o == "fallback" else [])
        if o == "answer":
            pairs += [(base + i, base + i + 1) for i in range(len(own) - 1)]
            first += [(base, [base + 1], base + 1, [base])] if len(own) > 1 else []
        else:
            links += [(base + i, f"u{u:06}") for i, u in enumerate(own)] + [(base + len(own), f"u{u:06}") for u in own]
    own = lambda df: df.filter("chunk_id = 'c1'")
    assert [r.text for r in own(out["nodes"]).orderBy("idx").collect()] == texts and [r.idx for r in own(out["nodes"]).orderBy("idx").collect()] == list(range(len(texts)))
    assert rows_of(own(out["edges"]), "src", "dst") == sorted(pairs, key=repr) and rows_of(own(out["frames"]), "claim", "evidence", "warrant_gap", "limitations") == sorted(first, key=repr)
    assert rows_of(own(out["node_units"]), "idx", "unit_id") == sorted(links, key=repr)
    assert rows_of(out["nodes"].filter("chunk_id = 'c2'"), "idx", "kind", "text") == [(0, "code", "alone"), (1, "gap", None)]


def test_repair_trees_are_cut_without_texts_into_compressed_tables(spark, monkeypatch):
    cut, real = [], ex.cut_lineage
    monkeypatch.setattr(ex, "cut_lineage", lambda df: cut.append(real(df)) or cut[-1])
    none = spark.createDataFrame([(1, "c1", "", False, "x")], "doc_id bigint, chunk_id string, path string, ok boolean, reason string")
    _, members = ex.repair_tree(tree_units(spark), none)
    assert cut and not any("text" in df.columns for df in cut)
    assert all(f.endswith(".zstd.parquet") for df in cut for f in df.inputFiles()) and any(df.inputFiles() for df in cut)
    assert sorted((r.path, r.unit_id, r.text) for r in members.collect() if r.chunk_id == "c2") == [("", "u000020", "alone")]


def test_unanswered_parts_are_the_work_list(spark):
    units = tree_units(spark)
    none = spark.createDataFrame([(1, "c1", "", False, "x")], "doc_id bigint, chunk_id string, path string, ok boolean, reason string")
    parts, members = ex.repair_tree(units, none)
    assert rows_of(parts.filter("outcome = 'ask'"), "chunk_id", "path") == [("c1", ".000001"), ("c1", ".000002"), ("c2", "")]
    large, _ = ex.repair_tree(tree_units(spark, 6, 1500), none, size=8_000)  # two units of 1,680 fit 4,000
    assert rows_of(large.filter("chunk_id = 'c1'"), "path", "outcome") == [("", "split"), (".000001", "ask"), (".000002", "ask"), (".000003", "ask")]


# The answer store


def chunk_rows(spark, texts):
    """Documents of chunks of units; ids follow the position in the document."""
    rows = []
    for doc, chunks in texts.items():
        at = 0
        for c, units in enumerate(chunks, 1):
            for text in units:
                at += 1
                rows.append((doc, f"c{c:04}", at, f"u{at:06}", "prose", text, ["Top"]))
    return spark.createDataFrame(rows, "doc_id bigint, chunk_id string, unit_ord bigint, unit_id string, kind string, text string, context array<string>")


def test_store_asks_only_for_changed_chunks(spark, tmp_path):
    path = str(tmp_path / "store")
    first = chunk_rows(spark, {1: [["a", "b"], ["c"], ["d", "e"]], 2: [["a", "b"], ["x"]]})
    digests = st.chunk_digests(first, "v1")
    assert rows_of(st.work_list(digests, st.read_store(spark, path)), "doc_id", "chunk_id") == [(1, "c0001"), (1, "c0002"), (1, "c0003"), (2, "c0002")]  # the copy is asked once
    order = first.filter("doc_id = 1")
    nodes = order.selectExpr("doc_id", "chunk_id", "row_number() over (partition by chunk_id order by unit_ord) - 1 as idx", "'claim' as kind", "concat('about ', text) as text", "'' as need", "cast(null as string) as gap_type",
                             "'source' as origin", "array(unit_id) as unit_ids", "array('k') as defines", "array() as requires", "array() as mentions", "array() as fills")
    edges = spark.createDataFrame([(1, "c0001", 0, 0, 1, "enables", "why"), (1, "c0003", 0, 1, 0, "supports", "")], "doc_id bigint, chunk_id string, idx bigint, src bigint, dst bigint, relation string, reason string")
    frames = spark.createDataFrame([(1, "c0001", 0, 0, [1], None, [])], "doc_id bigint, chunk_id string, idx bigint, claim bigint, evidence array<bigint>, warrant_gap bigint, limitations array<bigint>")
    st.add_results(path, digests, first, nodes, edges, frames, 1)
    assert rows_of(st.work_list(digests, st.read_store(spark, path)), "doc_id", "chunk_id") == [(2, "c0002")]
    # The second run: a chunk in front moves everything, one chunk is edited, headings and version count.
    second = chunk_rows(spark, {1: [["new"], ["a", "b"], ["c!"], ["d", "e"]], 2: [["a", "b"], ["x"]]})
    digests = st.chunk_digests(second, "v1")
    store = st.read_store(spark, path)
    assert rows_of(st.work_list(digests, store), "doc_id", "chunk_id") == [(1, "c0001"), (1, "c0003"), (2, "c0002")]
    again = st.recall(digests, second, store)
    assert rows_of(again["nodes"], "doc_id", "chunk_id", "idx", "text", "unit_ids", "defines") == sorted([
        (1, "c0002", 0, "about a", ["u000002"], ["k"]), (1, "c0002", 1, "about b", ["u000003"], ["k"]), (1, "c0004", 0, "about d", ["u000005"], ["k"]), (1, "c0004", 1, "about e", ["u000006"], ["k"]),
        (2, "c0001", 0, "about a", ["u000001"], ["k"]), (2, "c0001", 1, "about b", ["u000002"], ["k"])], key=repr)
    assert rows_of(again["edges"], "doc_id", "chunk_id", "src", "dst", "relation") == [(1, "c0002", 0, 1, "enables"), (1, "c0004", 1, 0, "supports"), (2, "c0001", 0, 1, "enables")]
    assert rows_of(again["frames"], "doc_id", "chunk_id", "claim", "evidence", "warrant_gap") == [(1, "c0002", 0, [1], None), (2, "c0001", 0, [1], None)]
    assert st.work_list(st.chunk_digests(second, "v2"), store).count() == 5
    moved = second.withColumn("context", F.array(F.lit("Other")))
    assert st.work_list(st.chunk_digests(moved, "v1"), store).count() == 5
    st.add_results(path, digests, second, nodes, edges, frames, 2)  # what is known already is not added again
    assert st.read_store(spark, path).count() == spark.read.parquet(path).count()


# Documents and answers


def test_graph_from_documents_and_answers(spark):
    text = "# Top\n\nAlpha text.\n\n```\ncode\n```\n\nBeta text.\n\n# Next\n\nGamma text.\n\n# Third\n\nDelta text."
    documents = spark.createDataFrame([(1, text), (2, "Alone.")], "doc_id bigint, text string")
    units = bd.chunked_units(documents, 420)
    chunks = {}
    for r in units.filter("doc_id = 1").orderBy("unit_ord").collect():
        chunks.setdefault(r.chunk_id, []).append(r.unit_id)
    assert chunks == {"c0001": ["u000001", "u000002"], "c0002": ["u000003", "u000004"], "c0003": ["u000005", "u000006"], "c0004": ["u000007", "u000008"]}
    node = lambda ids, **more: {"kind": "claim", "text": "t " + ids[0], "need": "", "gapType": None, "sourceUnitIds": ids, **more}
    answers = {
        "c0001": json.dumps({"nodes": [node(["u000001"], defines=["**Alpha**"]), node(["u000002"], kind="definition", requires=["Ｂeta"])], "edges": [{"from": 0, "to": 1, "relation": "enables"}],
                             "evidenceFrames": [{"claim": 0, "evidence": [1], "warrantGap": None, "limitations": []}]}),
        "c0002": json.dumps({"nodes": [node(["u000004"], defines=["beta"], requires=["alpha"]), 7, node(["u000009"])], "edges": [{"from": 0, "to": 2, "relation": "supports"}, {"from": 0, "to": 1, "relation": "supports"}], "evidenceFrames": []}),
        "c0003": "I cannot do that.", "c0004": json.dumps({"nodes": [node(["u000008"], requires=["omega"])], "edges": []})}
    rows = spark.createDataFrame([(1, c, t) for c, t in answers.items()] + [(1, "c0099", "{}")], "doc_id bigint, chunk_id string, response string")
    out = bd.build_graph(documents, rows, 420)
    assert rows_of(out["outcomes"], "doc_id", "chunk_id", "outcome", "reason") == sorted([
        (1, "c0001", "accepted", None), (1, "c0002", "salvaged", "not_an_object"), (1, "c0003", "failed", "bad_json"), (1, "c0004", "salvaged", "absent_list"), (2, "c0001", "failed", "no_answer")], key=repr)
    nodes = [(r.node_id, r.kind, r.text, r.coverage_fallback) for r in out["nodes"].filter("doc_id = 1").orderBy("node_ord").collect()]
    assert nodes == [
        ("n0000001", "claim", "t u000001", False), ("n0000002", "definition", "t u000002", False),
        ("n0000003", "claim", "t u000004", False), ("n0000004", "claim", "t u000009", False), ("n0000005", "code", "```\ncode\n```", True),
        ("n0000006", "gap", None, False), ("n0000007", "topic", "# Next", True), ("n0000008", "source", "Gamma text.", True),
        ("n0000009", "claim", "t u000008", False), ("n0000010", "topic", "# Third", True), ("n0000011", "gap", None, False)]
    edges = [(r.edge_ord, r.src, r.dst, r.relation, r.origin, r.concept) for r in out["edges"].filter("doc_id = 1").orderBy("edge_ord").collect()]
    assert edges == [(1, "n0000001", "n0000002", "enables", "model", None), (2, "n0000003", "n0000004", "supports", "model", None), (3, "n0000001", "n0000003", "enables", "concept-reconciliation", "alpha"),
                     (4, "n0000003", "n0000002", "enables", "concept-reconciliation", "beta"), (5, "n0000011", "n0000009", "enables", "gap-reconciliation", "omega")]
    assert rows_of(out["frames"], "claim", "evidence", "warrant_gap") == [("n0000001", ["n0000002"], None)]
    assert rows_of(out["issues"], "chunk_id", "category", "item_index") == sorted([("c0002", "invalid_edge", 1), ("c0003", "parsing_error", None), ("c0001", "parsing_error", None)], key=repr)
    assert rows_of(out["status"], "doc_id", "status", "errors") == [(1, "complete_with_gaps", 0), (2, "complete_with_gaps", 0)]
    assert rows_of(out["counts"], "doc_id", "coverage_fallbacks", "protected_fallbacks") == [(1, 4, 1), (2, 1, 0)]
    assert rows_of(out["unresolved"], "concept", "gap_id", "required_by") == [("omega", "n0000011", 1)]


def test_documents_are_segmented_once_for_paths_and_chunks(spark, monkeypatch):
    seen = []
    for name in ("heading_context", "pack_chunks"):
        def watched(units, *args, _inner=getattr(bd.sg, name), **how):
            seen.append(units._jdf.queryExecution().toString())
            return _inner(units, *args, **how)
        monkeypatch.setattr(bd.sg, name, watched)
    documents = spark.createDataFrame([(1, "# One\n\nText.\n\n## Two\n\nMore."), (2, "No heading")], "doc_id bigint, text string")
    units = bd.chunked_units(documents, 2_000)
    assert len(seen) == 2 and not any("Generate" in plan or "ArrowEvalPython" in plan for plan in seen)
    assert rows_of(units, "doc_id", "unit_ord", "context", "chunk_id") == [(1, 1, ["One"], "c0001"), (1, 2, ["One"], "c0001"), (1, 3, ["One", "Two"], "c0001"), (1, 4, ["One", "Two"], "c0001"), (2, 1, [], "c0001")]
    answers = spark.createDataFrame([(1, "c0001", '{"nodes":[],"edges":[],"evidenceFrames":[]}')], "doc_id bigint, chunk_id string, response string")
    given, own = (bd.build_graph(documents, answers, 2_000, **how) for how in ({"units": units}, {}))
    assert len(seen) == 4 and all(rows_of(given[t], *given[t].columns) == rows_of(own[t], *given[t].columns) for t in ("nodes", "outcomes", "status"))
