import datetime as dt

import pytest
from pyspark.sql import functions as F

from docloom.functions.ordering import first_by
from docloom.operators import annotate as an
from docloom.operators import batching
from docloom.operators import extraction as ex
from docloom.operators import graph as g
from docloom.operators import overlay as ov
from docloom.streaming.answers import compact, read_answers, start_answer_stream, state_folders

UNITS = "doc_id bigint, chunk_id string, unit_ord bigint, unit_id string, kind string, text string"
ITEMS = "doc_id bigint, chunk_ord bigint, chunk_id string, idx bigint, kind string, text string, need string, gap_type string, source_unit_ids array<string>"


def units(spark):
    return spark.createDataFrame([(1, "c1", 1, "u1", "prose", "One."), (1, "c1", 2, "u2", "code", "```\nx\n```")], UNITS)


def item(kind="claim", text="t", need="", gap_type=None, ids=("u1",), idx=0):
    return (1, 0, "c1", idx, kind, text, need, gap_type, list(ids))


def test_protected_text_is_restored_and_unknown_kinds_become_claims(spark):
    nodes, rejected = ex.validate_nodes(spark.createDataFrame([item("code", "x", ids=["u2", " u2 "]), item("idea", " y ", idx=1)], ITEMS), units(spark))
    rows = nodes.orderBy("idx").collect()
    assert rejected.count() == 0 and rows[0].text == "```\nx\n```" and (rows[1].kind, rows[1].text) == ("claim", "y")


@pytest.mark.parametrize("bad,reason", [(item("gap", "t", "n", "x"), "gap_with_text"), (item("gap", None, "", "x"), "untyped_gap"), (item("gap", None, "n", "--"), "untyped_gap"),
                                        (item(ids=[]), "no_source_units"), (item(ids=["zz"]), "unknown_unit"), (item(text=" "), "no_text")])
def test_one_violation_rejects_the_chunk(spark, bad, reason):
    good = item(idx=5)
    nodes, rejected = ex.validate_nodes(spark.createDataFrame([bad, good], ITEMS), units(spark))
    assert nodes.count() == 0 and [r.reason for r in rejected.collect()] == [reason]


def test_salvage_keeps_what_is_usable(spark):
    items = spark.createDataFrame([item("weird", "a"), item("claim", None, idx=1), item("gap", "t", "", None, idx=2), item("claim", "b", ids=["zz"], idx=3)], ITEMS)
    edges = spark.createDataFrame([(1, 0, "c1", 0, 0, 3, "supports", None), (1, 0, "c1", 1, 0, 0, "supports", ""), (1, 0, "c1", 2, 0, 9, "supports", ""), (1, 0, "c1", 3, 0, 1, "links", "")],
                                  "doc_id bigint, chunk_ord bigint, chunk_id string, idx bigint, src bigint, dst bigint, relation string, reason string")
    frames = spark.createDataFrame([(1, 0, "c1", 0, 0, [3, 9, 3], 0, [7]), (1, 0, "c1", 1, 0, [9], None, [])],
                                   "doc_id bigint, chunk_ord bigint, chunk_id string, idx bigint, claim bigint, evidence array<bigint>, warrant_gap bigint, limitations array<bigint>")
    out = ex.salvage_extraction(items, edges, frames, units(spark))
    rows = out["nodes"].orderBy("idx").collect()
    assert [(r.kind, r.annotations) for r in rows] == [("claim", ["kind_normalized"]), ("gap", ["parsing_error"]), ("gap", ["parsing_error"]), ("claim", ["parsing_error", "ungrounded"])]
    assert rows[2].need == "The answer left open what is missing here." and rows[1].gap_type == "parsing_error"
    assert [(r.src, r.dst) for r in out["edges"].collect()] == [(0, 3)]
    frame = out["frames"].first()
    assert (frame.claim, frame.evidence, frame.warrant_gap, frame.limitations) == (0, [3], None, [])
    assert sorted((r.category, r.item_index) for r in out["issues"].collect()) == [("invalid_edge", 1), ("invalid_edge", 2), ("invalid_edge", 3), ("invalid_evidence_frame", 1)]


def test_parts_are_combined_with_offsets(spark):
    key = "doc_id bigint, chunk_id string, part_ord bigint"
    nodes = spark.createDataFrame([(1, "c", 1, 0), (1, "c", 1, 1), (1, "c", 2, 0), (1, "c", 2, 1)], key + ", idx bigint")
    edges = spark.createDataFrame([(1, "c", 2, 0, 1)], key + ", src bigint, dst bigint")
    frames = spark.createDataFrame([(1, "c", 2, 0, [1], None, [0])], key + ", claim bigint, evidence array<bigint>, warrant_gap bigint, limitations array<bigint>")
    n, e, f = ex.combine_extractions(nodes, edges, frames)
    assert sorted(r.idx for r in n.collect()) == [0, 1, 2, 3] and (e.first().src, e.first().dst) == (2, 3)
    assert (f.first().claim, f.first().evidence, f.first().warrant_gap, f.first().limitations) == (2, [3], None, [2])


def graph(spark):
    nodes = spark.createDataFrame([(1, 1, "n0000001", "claim", "A", None, None, "source"), (1, 2, "n0000002", "definition", "B", None, None, "source"), (1, 3, "n0000003", "claim", "C", None, None, "source")],
                                  "doc_id bigint, node_ord bigint, node_id string, kind string, text string, need string, gap_type string, origin string")
    links = spark.createDataFrame([(1, i, f"n000000{i}", 1, f"u{i}") for i in (1, 2, 3)], "doc_id bigint, node_ord bigint, node_id string, pos bigint, unit_id string")
    concepts = spark.createDataFrame([(1, 1, "n0000001", "defines", 1, "*Operator*"), (1, 2, "n0000002", "defines", 1, "operator"), (1, 3, "n0000003", "requires", 1, "Operator"), (1, 3, "n0000003", "requires", 2, "spectrum")],
                                     "doc_id bigint, node_ord bigint, node_id string, role string, pos bigint, concept string")
    return nodes, links, concepts


def test_definition_nodes_win_and_missing_concepts_become_gaps(spark):
    nodes, links, node_concepts = graph(spark)
    members = g.concept_members(node_concepts)
    concepts = g.concept_index(members)
    assert {r.concept: r.label for r in concepts.collect()} == {"operator": "*Operator*", "spectrum": "spectrum"}
    out = g.materialize_gaps(nodes, links, members, concepts)
    assert [(r.concept, r.gap_id, r.generated) for r in out["gaps"].collect()] == [("spectrum", "n0000004", True)]
    assert [r.unit_id for r in out["node_units"].collect()] == ["u3"]
    edges = spark.createDataFrame([(1, 1, "n0000002", "n0000003", "enables", "model edge", "model"), (1, 2, "n0000001", "n0000003", "enables", "old", "concept-reconciliation")],
                                  "doc_id bigint, edge_ord bigint, src string, dst string, relation string, reason string, origin string")
    final = {(r.src, r.dst): r.origin for r in g.reconcile_concepts(edges, g.definer_edges(nodes, members, concepts), out["edges"]).collect()}
    assert final == {("n0000002", "n0000003"): "model", ("n0000004", "n0000003"): "gap-reconciliation"}
    again = g.reconcile_concepts(spark.createDataFrame([(1, i, *k, "enables", "", o) for i, (k, o) in enumerate(final.items())], edges.schema), g.definer_edges(nodes, members, concepts), out["edges"])
    assert {(r.src, r.dst): r.origin for r in again.collect()} == final


def test_fallback_restores_full_coverage(spark):
    nodes, links, _ = graph(spark)
    base = spark.createDataFrame([(1, i, f"u{i}", k, "text") for i, k in ((1, "prose"), (3, "prose"), (4, "table"), (5, "code"))], "doc_id bigint, unit_ord bigint, unit_id string, kind string, text string")
    rows, counts = ex.coverage_fallback(nodes, links, base)
    assert sorted((r.unit_id, r.kind) for r in rows.collect()) == [("u4", "evidence"), ("u5", "code")] and tuple(counts.first())[1:] == (2, 1)


def test_duplicate_and_self_edges_go(spark):
    edges = spark.createDataFrame([(1, 1, "a", "b", "supports"), (1, 2, "a", "b", "supports"), (1, 3, "a", "a", "supports"), (1, 4, "a", "b", "fills")], "doc_id bigint, edge_ord bigint, src string, dst string, relation string")
    assert sorted(r.edge_ord for r in g.dedupe_edges(edges).collect()) == [1, 4]


def test_variants_with_different_sources_are_found(spark):
    rows = spark.createDataFrame([(1, 1, "h"), (1, 2, "h"), (2, 1, "h"), (2, 2, "k")], "doc_id bigint, variant bigint, sha256 string")
    assert [r.doc_id for r in g.same_source(rows).collect()] == [2]


def test_responses_with_fences_prose_and_errors(spark):
    rows = spark.createDataFrame([(1, '```json\n{"items":[{"id":"a","n":1}]}\n```'), (2, 'Sure: {"items":[]} ok'), (3, "{bad"), (4, '{"other":1}')], "batch_no bigint, response string")
    items, issues = batching.ingest_responses(rows, ["batch_no"], "items", brace_slice=True)
    row = items.select(batching.item_string(F.col("item"), "$.id").alias("i"), batching.item_number(F.col("item"), "$.id").alias("x"), batching.item_number(F.col("item"), "$.n").alias("n")).collect()
    assert [tuple(r) for r in row] == [("a", None, 1.0)]
    assert sorted((r.batch_no, r.category) for r in issues.collect()) == [(3, "bad_json"), (4, "missing_field")]
    _, strict = batching.ingest_responses(rows, ["batch_no"], "items")
    assert sorted(r.batch_no for r in strict.collect()) == [2, 3, 4]


def test_annotation_places_comments_and_keeps_ids(spark):
    base = spark.createDataFrame([(1, 1, "u1", 1), (1, 2, "u2", 3)], "doc_id bigint, unit_ord bigint, unit_id string, end_line bigint")
    nodes = spark.createDataFrame([(1, 1, "n1", "topic", None, None, None, False, False), (1, 2, "n2", "source", None, None, None, False, True), (1, 3, "g1", "gap", "parsing_error", "Recover -- it.", None, False, False)],
                                  "doc_id bigint, node_ord bigint, node_id string, kind string, gap_type string, need string, resolution_status string, resolved boolean, repair_fallback boolean")
    links = spark.createDataFrame([(1, "n1", 1, "u1"), (1, "n2", 1, "u2"), (1, "g1", 1, "u2")], "doc_id bigint, node_id string, pos bigint, unit_id string")
    issues, issue_units = an.issue_annotations(nodes, links, base)
    status, summary = an.graded_coverage(nodes, links, base, issue_units)
    assert {r.unit_id: r.status for r in status.collect()} == {"u1": "extracted", "u2": "unresolved"}
    text = an.annotate_document(spark.createDataFrame([(1, "# Title\n\nDense source.\n")], "doc_id bigint, text string"), issues, issue_units, summary)
    body = text.first().text
    assert body.index("docloom:coverage") < body.index("Dense source.") < body.index("docloom:issue") and "Recover — it." in body
    assert [r.issue_id for r in an.extract_issue_ids(text).collect()] == ["g1"]
    solved = nodes.withColumn("resolution_status", F.when(F.col("node_id") == "g1", "source_recovery"))
    assert [(r.issue_id, r.type) for r in an.issue_annotations(solved, links, base)[0].collect()] == [("fallback-u2", "source_fallback")]


def test_annotated_documents_with_blank_lines_match_their_sql(spark, tmp_path):
    import duckdb
    from docloom.plans import overlay

    odd = [None, "", "  ", "\n", "\t", "a b.\n\nc d.\n\n\n\n\ne", "\n\n first\nsecond", "\tx\ny\t", "one\r\ntwo\r\n", "\u00a0z\nq\u00a0", "x\n\u2003\ny", "\u3000t", "\n".join("" if n % 4 == 2 else f"Line {n}." for n in range(30))]
    spark.createDataFrame(list(enumerate(odd, 1)), "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(overlay.ORACLES["annotate_document"]).fetchall()
    assert sorted((r.doc_id, r.text) for r in overlay.annotate_document(spark, str(tmp_path)).collect()) == sorted(want) and len(want) == 9


def test_triage_matches_brute_force_rules(spark):
    base = spark.createDataFrame([(1, 1, "u1", "A Fusion rule is called that.", ["Chapter 1 X"]), (1, 2, "u2", "Here we define, at some length, the fusion rule.", ["Chapter 1 X"]),
                                  (1, 3, "u3", "Confusion rule denotes.", ["Chapter 2 Y"]), (1, 4, "u4", "the C++ term refers to code", ["Chapter 1 X"]),
                                  (1, 5, "u5", "Now we call xμy a mean, and a x denotes denotes nothing.", ["Chapter 1 X"])],
                                 "doc_id bigint, unit_ord bigint, unit_id string, text string, context array<string>")
    rows = [(1, "g1", "fusion rule", "Chapter 1 X"), (1, "g2", "fusion rule", "Chapter 2 Y"), (1, "g3", "C++", "Chapter 1 X"), (1, "g4", "term", "Chapter 1 X"),
            (1, "g5", "μ", "Chapter 1 X"), (1, "g6", "a x", "Chapter 1 X"), (1, "g7", "", "Chapter 1 X"), (1, "g8", "λ", "Chapter 1 X")]
    records = (spark.createDataFrame(rows, "doc_id bigint, gap_id string, label string, chapter string").withColumn("status", F.lit("unresolved"))
               .withColumn("provenance", F.lit(None).cast("string")).withColumn("confidence", F.lit(None).cast("string")).withColumn("reason", F.lit("")))
    out, links = ov.triage_definitions(records, base)
    assert {r.gap_id: r.status for r in out.collect()} == {"g1": "already_defined", "g2": "unresolved", "g3": "unresolved", "g4": "already_defined",
                                                             "g5": "already_defined", "g6": "already_defined", "g7": "unresolved", "g8": "unresolved"}
    assert [(r.pos, r.unit_id) for r in links.filter("gap_id = 'g1'").orderBy("pos").collect()] == [(1, "u1"), (2, "u2")]


def test_batches_must_cover_requests_exactly(spark):
    requests = spark.createDataFrame([(1, b, f"g{b}{i}") for b in range(1, 6) for i in (1, 2)], "doc_id bigint, batch_no bigint, gap_id string")
    good = lambda b, i: (1, b, f"g{b}{i}", "Plain words.", "high")
    rows = [good(1, 1), good(1, 2), good(2, 1), good(3, 1), good(3, 1), good(4, 1), (1, 4, "zz", "x", "high"), good(5, 1), (1, 5, "g52", "uses $x$", "low")]
    accepted, issues = ov.validate_proposals(spark.createDataFrame(rows, "doc_id bigint, batch_no bigint, gap_id string, definition string, confidence string"), requests)
    assert {r.batch_no for r in accepted.collect()} == {1} and sorted(r.batch_no for r in issues.collect()) == [2, 3, 4, 5]


def test_hot_key_costs_one_row_per_task(spark):
    df = spark.range(10_000).select(F.lit(1).alias("k"), F.col("id").alias("o"), F.col("id").alias("v"))
    out = first_by(df, ["k"], ["o"])
    assert out.first().v == 0
    plan = df.sparkSession._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "simple")
    assert "partial_min_by" in plan


def test_answer_stream_equals_the_batch_result(spark, tmp_path):
    base = dt.datetime(2024, 1, 1)
    rows = [(i % 7, f"a{i}", base + dt.timedelta(minutes=(i * 37) % 500), i) for i in range(200)]
    schema = "gap_key bigint, answer string, ts timestamp, answer_id bigint"
    df = spark.createDataFrame(rows, schema)
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    df.filter("answer_id < 50").write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in"))
    start_answer_stream(stream, str(tmp_path / "out"), str(tmp_path / "ckpt")).awaitTermination(120)
    got = {r.gap_key: r.answer_id for r in read_answers(spark, str(tmp_path / "out")).collect()}
    assert got == {r.gap_key: r.answer_id for r in ov.latest_answers(df).collect()}


def test_answer_state_stays_small_over_a_restart(spark, tmp_path):
    """Many batches with late and resent rows, stopped and started again: few folders are read, the result is that of one batch."""
    base = dt.datetime(2024, 1, 1)
    schema = "gap_key bigint, answer string, ts timestamp, answer_id bigint"
    rows = [(i % 5, f"a{i}", base + dt.timedelta(minutes=(i * 53) % 700), i) for i in range(60)]
    source, out, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ckpt")

    def run(part):
        for k in range(0, len(part), 6):
            spark.createDataFrame(part[k:k + 6], schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        start_answer_stream(stream, out, checkpoint, compact_every=4).awaitTermination(240)

    run(rows[:36] + rows[:6])
    first = state_folders(spark, out)
    run(rows[36:] + rows[30:36])
    folders = state_folders(spark, out)
    assert all("snapshot=" in f[0] and len(f) <= 4 for f in (first, folders)) and first[0] != folders[0]
    assert len([p for p in (tmp_path / "out").iterdir() if p.is_dir()]) <= 2 * 4 + 2  # older ones are gone
    want = {r.gap_key: (r.answer_id, r.answer) for r in ov.latest_answers(spark.createDataFrame(rows, schema)).collect()}
    assert {r.gap_key: (r.answer_id, r.answer) for r in read_answers(spark, out).collect()} == want
    last = int(folders[-1].rsplit("=", 1)[1])
    compact(spark, out, last)  # again, and twice: the same rows
    compact(spark, out, last)
    assert state_folders(spark, out) == [f"{out}/snapshot={last}"]
    assert {r.gap_key: (r.answer_id, r.answer) for r in read_answers(spark, out).collect()} == want


def test_repeated_json_keys_keep_the_last_value(spark):
    responses = spark.createDataFrame([(1, '{"scores":[{"id":"a","id":"b","score":0.5}]}')], "doc_id bigint, response string")
    items, issues = batching.ingest_responses(responses, ["doc_id"], "scores")
    assert issues.count() == 0 and [r.i for r in items.selectExpr("variant_get(item, '$.id', 'string') as i").collect()] == ["b"]


def test_one_bad_edge_rejects_the_chunk(spark):
    items = spark.createDataFrame([item("claim", "a"), item("claim", "b", idx=1)], ITEMS)
    edges = lambda dst: spark.createDataFrame([(1, 0, "c1", 0, 0, dst, "supports", "")], "doc_id bigint, chunk_ord bigint, chunk_id string, idx bigint, src bigint, dst bigint, relation string, reason string")
    frames = spark.createDataFrame([(1, 0, "c1", 0, 0, [1], None, [])], "doc_id bigint, chunk_ord bigint, chunk_id string, idx bigint, claim bigint, evidence array<bigint>, warrant_gap bigint, limitations array<bigint>")
    good, rejected = ex.validate_extraction(items, edges(1), frames, units(spark))
    assert [good[k].count() for k in ("nodes", "edges", "frames")] == [2, 1, 1] and rejected.count() == 0
    good, rejected = ex.validate_extraction(items, edges(9), frames, units(spark))
    assert [good[k].count() for k in ("nodes", "edges", "frames")] == [0, 0, 0] and [r.reason for r in rejected.collect()] == ["bad_edge"]


def test_an_answer_without_nodes_becomes_a_gap(spark):
    items = spark.createDataFrame([], ITEMS)
    out = ex.salvage_empty_answers(units(spark), items, units(spark))
    assert [r.gap_type for r in out["nodes"].collect()] == ["parsing_error"] and out["node_units"].count() == 2


def test_checks_and_contexts_shuffle_no_text(spark, tmp_path):
    from docloom.plans import corpus, fixtures

    long_text = "word " * 400
    spark.createDataFrame([(i, "\n".join(f"{i} {n} {long_text}" for n in range(6))) for i in range(12)], "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    sf = str(tmp_path)
    assert corpus.unit_contexts(spark, sf).columns == ["doc_id", "unit_id", "context"]
    key = lambda name: (spark.sparkContext.applicationId, sf, name)
    assert key("fx_units") in fixtures._STAGED and key("fx_lines") not in fixtures._STAGED and key("units_with_context") not in fixtures._STAGED
    units, nodes, links = (fixtures.fixture(spark, sf, t) for t in ("fx_units", "fx_nodes", "fx_node_units"))
    from docloom.operators import graph as g
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        found = g.validate_graph(units, nodes, links, fixtures.fixture(spark, sf, "fx_edges"), fixtures.fixture(spark, sf, "fx_frames"))[0]
        verbatim = found.filter("rule = 'not_verbatim'")
        plan = verbatim._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    assert plan.count("sha2(") == 2
    covered = links.join(nodes.select("doc_id", "node_id", "text"), ["doc_id", "node_id"]).join(units.select("doc_id", "unit_id", "kind", units.text.alias("u")), ["doc_id", "unit_id"])
    right = covered.filter("text = u").select("doc_id", "unit_id").distinct()
    want = units.filter("kind in ('code', 'equation')").join(right, ["doc_id", "unit_id"], "left_anti").count()
    assert verbatim.count() == want > 0


def small_corpus(spark, folder):
    spark.createDataFrame([(i, "\n".join(f"{i} {n} A line of words, and more of them." for n in range(40))) for i in range(1, 9)], "doc_id bigint, text string").write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def test_audited_texts_are_written_once(spark, tmp_path):
    from docloom.plans import fixtures, prose

    sf = small_corpus(spark, tmp_path)
    rows = prose.audit_sections(spark, sf).collect()
    assert {r.status for r in rows} == {"present", "missing"}
    assert {name for app, folder, name in fixtures._STAGED if folder == sf} == {"fx_section_docs"}


def test_merged_nodes_are_told_apart_without_moving_texts(spark, tmp_path, monkeypatch):
    from docloom.plans import fixtures, graph

    sf, cut = small_corpus(spark, tmp_path), []
    real = g.cut_lineage
    monkeypatch.setattr(g, "cut_lineage", lambda df: cut.append(df.columns) or real(df))
    out = graph.merged(spark, sf)
    assert len(cut) == 3 and not any("text" in columns or "need" in columns for columns in cut)
    nodes = out["nodes"].collect()
    assert any(r.text for r in nodes) and len({(r.doc_id, r.node_id) for r in nodes}) == len(nodes)
    known = fixtures.fixture(spark, sf, "fx_vnodes").select("doc_id", "variant", "node_id", "kind", "text", "need")
    odd = out["id_map"].join(known, ["doc_id", "variant", "node_id"]).alias("a").join(out["nodes"].alias("b"), F.expr("a.doc_id = b.doc_id and a.merged_id = b.node_id"))
    assert odd.filter("not (a.kind <=> b.kind and a.text <=> b.text and a.need <=> b.need)").count() == 0 and odd.count() == known.count()


def test_exported_documents_are_not_shuffled_again(spark, tmp_path):
    from docloom.sources import corpus

    unit = spark.createDataFrame([(1, 1, "u1", "prose", "A"), (1, 2, "u2", "prose", "B"), (3, 1, "u1", "prose", "C")], "doc_id bigint, unit_ord bigint, unit_id string, kind string, text string")
    node = spark.createDataFrame([(1, 2, "n2", "claim", "B"), (1, 1, "n1", "claim", "A"), (2, 1, "n1", "gap", None)], "doc_id bigint, node_ord bigint, node_id string, kind string, text string")
    links = spark.createDataFrame([(1, 1, "n1", 2, "u2"), (1, 1, "n1", 1, "u1")], "doc_id bigint, node_ord bigint, node_id string, pos bigint, unit_id string")
    concepts = spark.createDataFrame([(1, 2, "n2", "requires", 1, "x"), (1, 2, "n2", "defines", 1, "y")], "doc_id bigint, node_ord bigint, node_id string, role string, pos bigint, concept string")
    edge = spark.createDataFrame([(4, 1, "n1", "n2", "enables")], "doc_id bigint, edge_ord bigint, src string, dst string, relation string")
    frame = spark.createDataFrame([(1, 1, "ef1", "n1")], "doc_id bigint, frame_ord bigint, frame_id string, claim string")
    tables = {"units": unit, "nodes": node, "node_units": links, "node_concepts": concepts, "edges": edge, "frames": frame}
    nested = corpus.export_graph(tables)
    assert "FullOuter" not in nested._jdf.queryExecution().optimizedPlan().toString()
    rows = {r.doc_id: r for r in nested.collect()}
    assert sorted(rows) == [1, 2, 3, 4] and rows[4].nodes is None and rows[3].nodes is None and rows[2].sourceUnits is None
    first, second = rows[1].nodes
    assert (first.id, first.text, first.sourceUnitIds, first.defines) == ("n1", "A", ["u1", "u2"], None)
    assert (second.id, second.text, second.sourceUnitIds, second.requires, second.defines, second.fills) == ("n2", "B", None, ["x"], ["y"], None)
    corpus.write_graph(tables, str(tmp_path / "g"))
    assert list((tmp_path / "g" / "graph").glob("*.json.gz")) and not list((tmp_path / "g" / "graph").glob("*.json"))
    back = corpus.read_export(spark, str(tmp_path / "g"))
    assert back["nodes"].count() == 3 and [r.unit_id for r in back["node_units"].orderBy("pos").collect()] == ["u1", "u2"]


def test_merging_shuffles_no_text_to_refuse_documents(spark, tmp_path, monkeypatch):
    from docloom.plans import graph

    sf, plans = small_corpus(spark, tmp_path), []
    real = g.validate_graph
    monkeypatch.setattr(g, "validate_graph", lambda units, *rest: plans.append(units.columns) or real(units, *rest))
    out = graph.merge_graphs(spark, sf).collect()
    assert plans == [["doc_id", "unit_id", "kind", "text_digest"]]
    assert {r.doc_id for r in out if r.part == "refused"} == {4} and {r.doc_id for r in out if r.part == "status"} == {1, 2, 3, 5, 6, 7, 8}
    assert not any(r.doc_id == 4 and r.part != "refused" for r in out)


def test_merging_writes_no_lines_of_documents(spark, tmp_path):
    from docloom.plans import fixtures, graph

    sf = small_corpus(spark, tmp_path)
    assert graph.merge_graphs(spark, sf).collect()
    paths = {name: path for (_, folder, name), path in fixtures._STAGED.items() if folder == sf}
    assert not [name for name, path in paths.items() if {"text", "src_text", "title"} & set(spark.read.parquet(path).columns)]


def test_salvage_moves_no_text_for_numbers_or_plain_units(spark):
    items = spark.createDataFrame([(1, "c", 4, "claim", "x", "", None, ["u1", "u9"]), (1, "c", 7, "code", "y", "", None, ["u2"]), (2, "c", 0, "claim", "z", "", None, ["u1"])],
                                  "doc_id bigint, chunk_id string, idx bigint, kind string, text string, need string, gap_type string, source_unit_ids array<string>")
    units = spark.createDataFrame([(1, "c", 1, "u1", "prose", "plain"), (1, "c", 2, "u2", "code", "verbatim")], "doc_id bigint, chunk_id string, unit_ord bigint, unit_id string, kind string, text string")
    rows = ex._prepared(items, units, True, numbered=True)
    assert sorted((r.doc_id, r.idx, r.new_idx, r.unknown_units, r.known_units, r._p and tuple(r._p)) for r in rows.collect()) == [
        (1, 4, 0, 1, ["u1"], None), (1, 7, 1, 0, ["u2"], ("code", "verbatim")), (2, 0, 0, 1, [], None)]
    plan = rows._jdf.queryExecution().optimizedPlan().toString().split("\n")
    below = next(plan[i + 1] for i, line in enumerate(plan) if "Window" in line)
    assert "text#" not in below


@pytest.mark.parametrize("ids", [(1, 2, None), (1, 1, 2)])
def test_chunk_units_equal_their_sql_and_join_only_for_repeated_documents(spark, tmp_path, ids):
    import duckdb

    from docloom.plans import extraction as plans
    from docloom.plans.fixtures import oracle
    texts = ["\n".join(f"line {i}" for i in range(n)) for n in (9, 3, 7)]
    spark.createDataFrame(list(zip(ids, texts)), "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    built = plans._chunk_units(spark, str(tmp_path))
    assert sorted(map(repr, map(tuple, built.collect()))) == sorted(map(repr, con.execute(oracle("select doc_id, chunk_id, unit_ord, unit_id, kind, text from fx_chunk_units")).fetchall()))
    assert ("Join" in built._jdf.queryExecution().optimizedPlan().toString()) == (len(set(ids)) < len(ids))


def test_open_gaps_stage_no_copy_of_the_units(spark):
    from docloom.plans import enrichment as plans
    from docloom.plans.fixtures import _STAGED, fixture
    sf, key = "/root/testdata/sf0.001", (spark.sparkContext.applicationId, "/root/testdata/sf0.001", "fx_units")
    kept = _STAGED.pop(key, None)
    fixture(spark, sf, "fx_node_units")
    plans.unresolved_gaps(spark, sf)
    assert key not in _STAGED
    if kept:
        _STAGED[key] = kept


def shuffled(spark, df):
    """Rows of ``df`` and the bytes shuffled for them."""
    store, gateway = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._gateway

    def total():
        stages = store.stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), None)
        return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))
    before = total()
    rows = df.collect()
    return rows, total() - before


def test_triage_reads_borders_of_labels_in_the_whole_text(spark):
    import random
    import re
    rng = random.Random(4)
    labels = ["ab", "ab c", "C++", "x" * 80, "y z " * 19 + "y z", "μ", "b", "is called", "a. b"]
    pieces = ["Kab", "ab", "AB  c", "C++", "x" * 80, "x" * 81, "y z " * 19 + "Y z", " ", " ", " ", "  ", ". ", "_", "μ", "is called", "IS DEFINED AS", "denotes", "we define", "this text  calls", "we call", "-" * 118, "-" * 130, "\U0001f600", "\n"]
    texts = ["Kab is called so.", "we define" + "-" * 120 + "ab", "we define" + "-" * 121 + "ab", "we define-" + "-" * 119 + "x" * 80, "we define-" + "-" * 119 + "x" * 80 + "_"]
    texts += ["".join(rng.choice(pieces) + rng.choice(["", " "]) for _ in range(rng.randint(1, 9))) for _ in range(300)]
    units = spark.createDataFrame([(1, i, f"u{i}", t, ["Chapter 1 X"]) for i, t in enumerate(texts)], "doc_id bigint, unit_ord bigint, unit_id string, text string, context array<string>")
    records = spark.createDataFrame([(1, f"g{j}", label, "Chapter 1 X", "unresolved", None, None, "") for j, label in enumerate(labels)],
                                    "doc_id bigint, gap_id string, label string, chapter string, status string, provenance string, confidence string, reason string")

    def matches(label, text):
        a, t = r"(?:(?<=[A-Za-z0-9_])(?![A-Za-z0-9_])|(?<![A-Za-z0-9_])(?=[A-Za-z0-9_]))", "".join(f"[{c.lower()}{c.upper()}]" if c.isascii() and c.isalpha() else re.escape(c) for c in label)
        cue = lambda s: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in s)
        said, told = "|".join(map(cue, ("is defined as", "is called", "denotes", "refers to"))), f"(?:{cue('we')}|{cue('this text')})\\s+(?:{cue('define')}|{cue('call')})"
        return re.search(f"{a}{t}{a}\\s+(?:{said}){a}|{a}{told}{a}[^.]{{0,120}}{a}{t}{a}", text) is not None
    want = {(f"g{j}", f"u{i}") for j, label in enumerate(labels) for i in [i for i, t in enumerate(texts) if matches(label, t)][:2]}
    chapters = units.select("doc_id", "unit_id", "context")
    for args in ((units,), (units.drop("context"), chapters)):
        out, links = ov.triage_definitions(records, *args)
        assert {(r.gap_id, r.unit_id) for r in links.collect()} == want and len(want) > 8
        assert {r.gap_id for r in out.filter("status = 'already_defined'").collect()} == {g for g, _ in want}


def test_triage_moves_parts_of_texts_only(spark):
    import random
    rng = random.Random(5)
    noise = lambda n: "".join(rng.choices("bcdfghjklmnpqrstvwxz", k=n))
    rows = [(1, i, f"u{i}", f"{noise(8_000)} term {i} is called so. {noise(8_000)}", [f"Chapter 1 {noise(2_000)}" if i % 2 else "Chapter 2 Y"]) for i in range(60)]
    units = spark.createDataFrame(rows, "doc_id bigint, unit_ord bigint, unit_id string, text string, context array<string>")
    records = spark.createDataFrame([(1, f"g{i}", f"term {i}", "Chapter 2 Y", "unresolved", None, None, "") for i in range(60)],
                                    "doc_id bigint, gap_id string, label string, chapter string, status string, provenance string, confidence string, reason string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        links, moved = shuffled(spark, ov.triage_definitions(records, units)[1])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert len(links) == 30 and moved < 200_000  # the texts have 960,000 bytes


def test_reconciling_writes_no_texts_and_no_tables_beside_it(spark, tmp_path):
    import random

    from docloom.plans import QUERIES
    from docloom.plans.fixtures import TABLES, Dialect, fixture
    rng = random.Random(8)
    docs = [(d, "\n".join("".join(rng.choices("bcdfghjklm ", k=3_000)) for _ in range(12))) for d in range(10)]
    spark.createDataFrame(docs, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    store, gateway = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._gateway

    def written():
        stages = store.stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), None)
        return sum(stages.apply(i).outputBytes() for i in range(stages.size()))
    before = written()
    assert QUERIES["reconcile_concepts"](spark, str(tmp_path)).count() > 50
    assert written() - before < 150_000  # the texts have 360,000 bytes, the nodes' tables two copies of them
    # The edges and concepts built in one pass are those of the tables' own SQL.
    dialect = Dialect("spark", str(tmp_path))
    fixture(spark, str(tmp_path), "fx_nodes").createOrReplaceTempView("fx_nodes")
    for name in ("fx_edges", "fx_node_concepts", "fx_node_units"):
        fixture(spark, str(tmp_path), "fx_units").createOrReplaceTempView("fx_units")
        want, got = spark.sql(TABLES[name](dialect)), fixture(spark, str(tmp_path), name)
        assert want.columns == got.columns and want.dtypes == got.dtypes
        assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0 < got.count()
