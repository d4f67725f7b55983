import random

import pytest
from pyspark.sql import functions as F

from docloom.functions import text as tx
from docloom.operators import segment
from docloom.sources import corpus, html


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts, 1)), "doc_id bigint, text string")


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "v string").select(fn(F.col("v")).alias("o")).first()["o"]


def test_units_keep_blocks_whole(spark):
    source = ("# Stations\n\nNorth line.\nSouth line.\n\n```sh\ncount --all\n\n```\nShort\n~~~~\na\n~~~\n~~~~\n$$\nx^2\n$$\n\\[ y \\]\n<details><summary>A</summary>Done.</details>\n"
              "| a |\n| b |\n## Sub ##\nAfter.   \n<details>\nopen\n</details>\nEnd")
    rows = segment.segment_units(docs(spark, source)).orderBy("unit_ord").collect()
    assert [(r.kind, r.start_line, r.end_line) for r in rows] == [
        ("heading", 1, 1), ("prose", 3, 4), ("code", 6, 9), ("prose", 10, 10), ("code", 11, 14), ("equation", 15, 17), ("equation", 18, 18), ("details", 19, 19),
        ("table", 20, 21), ("heading", 22, 22), ("prose", 23, 23), ("details", 24, 26), ("prose", 27, 27)]
    assert rows[2].text == "```sh\ncount --all\n\n```" and rows[10].text == "After." and rows[9].title == "Sub" and rows[9].level == 2
    assert [r.unit_id for r in rows][:2] == ["u000001", "u000002"]


def test_unclosed_block_runs_to_the_end(spark):
    rows = segment.segment_units(docs(spark, "Intro\n```\ncode\n# not a heading\n")).orderBy("unit_ord").collect()
    assert [(r.kind, r.end_line) for r in rows] == [("prose", 1), ("code", 5)]
    assert rows[1].text == "```\ncode\n# not a heading"


def test_plain_and_block_paths_agree(spark):
    rng = random.Random(3)
    pieces = ["word one", "", "# Head", "| t |", "  ", "### Deep ###", "more words", "#tag", "   # Three spaces", "    # Four"]
    texts = ["\n".join(rng.choice(pieces) for _ in range(rng.randint(1, 30))) for _ in range(40)]
    plain = segment.segment_units(docs(spark, *texts)).select("doc_id", "kind", "start_line", "end_line").collect()
    expected = [(i, s["kind"], s["start_line"], s["end_line"]) for i, t in enumerate(texts, 1) for s in segment._spans_with_blocks(t)]
    assert sorted(map(tuple, plain)) == sorted(expected)


BLOCK_LINES = ["", "text", "| a", "| <details >x", "```", "````", "`````js", "~~~", "~~~~ ", "\\[", "x \\]", "\\[ a \\]", "$$", "$$ a $$", "a $$", "<details open", "</details>", "<DETAILS> </details>", "# head", "   ## h #", "    # far", "``` ", "   ", " | b", "plain # text"]


@pytest.mark.parametrize("block_lines", [3, 1, 1000])
def test_lines_in_blocks_give_the_units_of_whole_texts(spark, block_lines):
    draw = random.Random(block_lines)
    texts = ["\n".join(draw.choice(BLOCK_LINES) for _ in range(draw.randint(1, 40))) for _ in range(60)] + ["", "```", "a\n```\n" + "x\n" * 30 + "````\nb"]
    whole = docs(spark, *texts)
    lines = whole.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("p", "text")).select("doc_id", (F.col("p") + 1).alias("line_no"), "text").repartition(5)
    columns = ["doc_id", "unit_ord", "unit_id", "kind", "text", "hash", "start_line", "end_line", "level", "title"]
    want, got = (sorted((tuple(r) for r in df.select(*columns).collect()), key=repr) for df in (segment.segment_units(whole), segment.segment_lines(lines, block_lines)))
    assert got == want and len(got) > 200
    assert segment.segment_lines(lines.limit(0)).count() == 0


def test_scanner_answers_hold_for_every_entry_state():
    """What a block says about its exits is what a scan from that state gives."""
    def looked_up(rows, state):
        fence = state[:1] in ("`", "~")
        key = state[0] if fence else {"": "", "prose": "", "table": "table"}.get(state, state[:1])
        return next((after for mark, length, after in rows if mark == key and (not fence or length >= len(state))), state)

    draw = random.Random(5)
    for _ in range(2000):
        lines = [draw.choice(BLOCK_LINES) for _ in range(draw.randint(1, 9))]
        rows = segment._exits(lines)
        for entry in ("", "prose", "table", "```", "````", "``````", "~~~", "~~~~~", "\\[", "$$", "<details"):
            state = entry
            for line in lines:
                state = segment._scan(line, state)[2]
            assert looked_up(rows, entry) == state


def test_rows_of_a_table_open_no_block(spark):
    rows = segment.segment_units(docs(spark, "| a |\n| <details > |\n| b |\n\ntext")).orderBy("unit_ord").collect()
    assert [(r.kind, r.start_line, r.end_line) for r in rows] == [("table", 1, 3), ("prose", 5, 5)]


def test_segmentation_has_one_python_node(spark):
    plan = segment.segment_units(docs(spark, "a"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "Exchange" not in plan


def test_heading_context_follows_a_stack(spark):
    text = "intro\n\n## B\n\np\n\n# A\n\n### C\n\nq\n\n## D\n\nr"
    units = segment.segment_units(docs(spark, text))
    rows = segment.heading_context(units).orderBy("unit_ord").collect()
    assert [r.context for r in rows] == [[], ["B"], ["B"], ["A"], ["A", "C"], ["A", "C"], ["A", "D"], ["A", "D"]]


def greedy(weights, limit):
    chunk, size, open_, out = 0, 0, False, []
    for w in weights:
        if open_ and size + w > limit:
            open_, size = False, 0
        if not open_:
            chunk, open_, size = chunk + 1, True, 0
        size += w
        out.append(chunk)
        if w > limit:
            open_, size = False, 0
    return out


@pytest.mark.parametrize("block_rows", [3, 7, 1 << 16])
def test_block_wise_packing_equals_the_sequential_one(spark, block_rows):
    rng = random.Random(block_rows)
    rows, want = [], {}
    for doc in range(6):
        lengths = [rng.choice([0, 5, 40, 120, 300, 900]) for _ in range(60)]
        want[doc] = greedy([n + 180 for n in lengths], 700)
        rows += [(doc, i, "x" * n) for i, n in enumerate(lengths, 1)]
    units = spark.createDataFrame(rows, "doc_id bigint, unit_ord bigint, text string")
    got = segment.pack_chunks(units, 700, block_rows=block_rows).orderBy("doc_id", "unit_ord").collect()
    for doc in want:
        assert [r.chunk_ord for r in got if r.doc_id == doc] == want[doc]


def test_oversized_unit_is_alone_and_whole(spark):
    units = segment.segment_units(docs(spark, "a\n\n```text\n" + "x" * 500 + "\n```\n\nb"))
    packed = {r.unit_ord: r.chunk_ord for r in segment.pack_chunks(units, 300).collect()}
    assert packed == {1: 1, 2: 2, 3: 3}


def test_failed_chunk_with_one_part_is_halved(spark):
    units = docs(spark, "a\n\nb\n\nc")
    units = segment.segment_units(units)
    chunks = units.select("doc_id", "unit_ord", F.lit("c0001").alias("chunk_id"))
    parts = segment.resplit_failed_chunks(chunks, units, chunks, 8_000, depth=1, flat=False).orderBy("unit_ord").collect()
    assert [r.part_id for r in parts] == ["c0001-repair-1-01", "c0001-repair-1-01", "c0001-repair-1-02"]


def test_html_structure(spark):
    page = ('<!doctype html><html><head><style>dropped</style></head><body><h1>Trains &amp; <b>boats</b></h1><p>See <a href="https://rail.test/a">our  <i>table</i></a>, <a>plain</a>.</p>'
            "<math alttext='d/t'>dropped</math><pre><code>go north</code></pre><ul><li>stop</li></ul><img src=pic.png alt='A &quot;b&quot;'><table><tr><td>1</td><td>2</td></tr></table>&#65;&#x42;&copy;</body></html>")
    good, _ = html.html_to_markdown(spark.createDataFrame([(1, page)], "page_id bigint, html string"))
    text = good.first()["text"]
    for part in ("# Trains & boats", "[our table](https://rail.test/a), plain.", "$d/t$", "```\ngo north\n```", "- stop", '![A "b"](pic.png)', "1 | 2 |", "AB&copy;"):
        assert part in text, (part, text)
    assert "dropped" not in text and text.endswith("\n")


def test_empty_page_is_an_issue(spark):
    good, issues = html.html_to_markdown(spark.createDataFrame([(1, "<script>x</script> "), (2, "<p>a</p>")], "page_id bigint, html string"))
    assert [r.page_id for r in good.collect()] == [2] and [r.page_id for r in issues.collect()] == [1]


def test_links_and_images(spark):
    pages = spark.createDataFrame([(1, "<a href='x y'>A &lt;b</a><a href=z>  </a><IMG alt=a src=\"s\">")], "page_id bigint, html string")
    assert [(r.pos, r.text, r.href) for r in html.page_links(pages).orderBy("pos").collect()] == [(1, "A <b", "x y"), (2, "", "z")]
    assert [(r.alt, r.src) for r in html.page_images(pages).collect()] == [("a", "s")]


def test_entities_are_decoded_in_order(spark):
    assert one(spark, "&amp;lt;&NBSP;&#39;&apos;", tx.decode_entities) == "< ''"


def test_normalizers(spark):
    assert one(spark, ' *"Fusion\u00a0 _Rule_"* ', tx.normalize_concept) == "fusion rule"
    assert one(spark, "  Fusion–Rule ", tx.normalize_label) == "fusion rule"
    assert one(spark, " Missing Definition! ", tx.normalize_gap_type) == "missing_definition"
    assert one(spark, "--", tx.normalize_gap_type) is None
    assert one(spark, "Ⅳ. The ﬁeld", tx.section_slug) == "iv-the-field"
    assert one(spark, "***", tx.section_slug) == "section"
    row = spark.createDataFrame([(["A", " *a* ", "", None, "b"],)], "v array<string>").select(tx.normalize_concepts(F.col("v")).alias("o")).first()
    assert row.o == ["a", "b"]


def test_scores(spark):
    df = spark.createDataFrame([(1.7,), (-2.0,), (0.12345,), (float("nan"),), (float("inf"),), (None,)], "v double")
    assert [r[0] for r in df.select(tx.clamp_score(F.col("v"))).collect()] == [1.0, 0.0, 0.123, None, None, None]
    assert one(spark, "two words", tx.surface_density) == 0.063
    assert one(spark, "don't stop-now x_1 — 2", tx.word_count) == 4


def test_first_sentences(spark):
    assert one(spark, "First fact. Second fact. Third fact.", tx.first_sentences) == "First fact. Second fact."
    assert one(spark, "no end", tx.first_sentences) == "no end"


def test_blank_documents_are_issues(spark):
    good, issues = corpus.accept_documents(docs(spark, "a\r\nb\rc", " \n\t"))
    assert good.first()["text"] == "a\nb\nc" and [r.doc_id for r in issues.collect()] == [2]


def test_graph_round_trip(spark, tmp_path):
    t = {"units": spark.createDataFrame([(1, 1, "u000001", "prose", "Text.", 1, 1)], "doc_id bigint, unit_ord bigint, unit_id string, kind string, text string, start_line bigint, end_line bigint"),
         "nodes": spark.createDataFrame([(1, 2, "n0000002", "claim", "B"), (1, 1, "n0000001", "claim", "A")], "doc_id bigint, node_ord bigint, node_id string, kind string, text string"),
         "node_units": spark.createDataFrame([(1, 1, "n0000001", 1, "u000001")], "doc_id bigint, node_ord bigint, node_id string, pos bigint, unit_id string"),
         "node_concepts": spark.createDataFrame([(1, 1, "n0000001", "defines", 1, "x")], "doc_id bigint, node_ord bigint, node_id string, role string, pos bigint, concept string"),
         "edges": spark.createDataFrame([(1, 1, "n0000001", "n0000002", "supports", "r")], "doc_id bigint, edge_ord bigint, src string, dst string, relation string, reason string"),
         "frames": spark.createDataFrame([(1, 1, "ef000001", "n0000001", ["n0000002"], None, [])], "doc_id bigint, frame_ord bigint, frame_id string, claim string, evidence array<string>, warrant_gap string, limitations array<string>")}
    corpus.write_graph(t, str(tmp_path / "out"))
    back = corpus.read_graph(spark, str(tmp_path / "out" / "graph"))
    assert [(r.node_id, r.text) for r in back["nodes"].orderBy("node_ord").collect()] == [("n0000001", "A"), ("n0000002", "B")]
    assert back["node_units"].first().unit_id == "u000001" and back["node_concepts"].first().concept == "x"
    assert back["edges"].first().dst == "n0000002" and back["frames"].first().evidence == ["n0000002"]


def test_blocks_say_how_many_units_start():
    draw = random.Random(6)
    for _ in range(2000):
        lines = [draw.choice(BLOCK_LINES) for _ in range(draw.randint(1, 9))]
        rows = segment._answers(lines)
        for entry in ("", "prose", "table", "```", "``````", "~~~", "\\[", "$$", "<details"):
            mark = entry if entry in ("", "prose", "table") else entry[0]
            fence = mark in ("`", "~")
            units = next((units for state, length, _, units in rows if state == mark and (not fence or length >= len(entry))), 0)
            pieces = segment._pieces(lines, entry)
            assert units == (pieces[-1]["n"] if pieces else 0)


def test_lines_are_shuffled_once_for_both_passes(spark):
    lines = spark.range(2000).selectExpr("id % 40 as doc_id", "id div 40 + 1 as line_no", "case when id % 3 = 0 then '' else 'line ' || id end as text")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        units = segment.segment_lines(lines, 7)
        assert len(units.collect()) > 600
        plan = units._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "MapInPandas" not in plan and "ReusedExchange" in plan


def test_cheap_heading_rules_say_what_the_pattern_says(spark):
    lines = ["# a", "#  a b ##", "## #", "#  ", "# 　x", "#", "#x", "####### x", "   # x", "    # x", "###### x # y", "# a#", "#\ta  ", "# #a", " ## t ###  ", "# \U0001F600"]
    for line in lines:
        got = {r.kind: (r.level, r.title) for r in segment.segment_units(docs(spark, line)).collect()}
        whole = spark.createDataFrame([(line,)], "t string")
        is_heading = whole.select(F.col("t").rlike(segment.HEADING)).first()[0]
        assert ("heading" in got) == is_heading, line
        if is_heading:
            trimmed = whole.select(tx.rtrim_ws(F.col("t")).alias("t"))
            want = trimmed.select(F.length(F.regexp_extract("t", segment.HEADING, 1)), tx.trim_ws(F.regexp_extract("t", segment.HEADING, 2))).first()
            assert got["heading"] == tuple(want), line


def test_lists_reach_python_as_texts(spark):
    rows = [(["Ａ＂", None, "é\n", "\\"],), (["a"],), ([None, "b"],), (None,), ([],)]
    df = spark.createDataFrame(rows, "v array<string>").select(tx.nfkc_list(F.col("v")).alias("o"))
    assert [r.o for r in df.collect()] == [['A"', None, "é\n", "\\"], ["a"], [None, "b"], None, []]
    assert "array" not in str(tx._composed_lists.returnType.simpleString())
