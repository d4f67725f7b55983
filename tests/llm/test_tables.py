"""Sharding, URL rules, page texts and vector search against plain Python."""
import random
from collections import Counter, defaultdict
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from docloom.llm import block_search, interleave, templates, url_rules

# Sharding


def sharded(spark, rows, **how):
    docs = spark.createDataFrame([(i, t, s, *"abc") for i, t, s in rows], "doc_id long, text string, source string, shard string, slot string, size string").repartition(3)
    return interleave.interleave(docs, **how).collect()


def test_interleaving_keeps_counts_slots_and_mixture(spark):
    draw = random.Random(1)
    rows = [(i, "x" * draw.randint(0, 50), "hot" if i % 3 == 0 else f"s{i % 5}") for i in range(1000)]
    rows += [(None, None, None), (5000, "é" * 20_000, None), (7, "same", "hot"), (7, "same", "hot")]
    got = sharded(spark, rows, shards=16, bucket_rows=7)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((i, len((t or "").encode()) + 1, crc32((t or "").encode())) for i, t, _ in rows)
    shards = defaultdict(list)
    for r in got:
        shards[r.shard].append(r)
    sizes = [len(s) for s in shards.values()]
    assert len(shards) == 16 and max(sizes) - min(sizes) <= 1
    total = Counter(r.stratum for r in got)
    for own in shards.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
        for stratum, n in total.items():
            assert abs(sum(r.stratum == stratum for r in own) - n / 16) <= 2
    # The order is that of one plain sort.
    ranked, place = [], {}
    import hashlib
    for stratum in total:
        own = sorted((hashlib.md5(f"docloom-1:{'null' if r.doc_id is None else r.doc_id}".encode()).hexdigest(), -1 if r.doc_id is None else r.doc_id, r.size, r.text_crc32) for r in got if r.stratum == stratum)
        ranked += [((2 * k + 1) / (2 * len(own)), stratum, *x) for k, x in enumerate(own)]
    place = {x: k for k, x in enumerate(sorted(ranked))}
    want = [x[3] for x in sorted(ranked)]
    start = {s: sum(len(shards[k]) for k in range(s)) for s in range(16)}
    assert [i for _, i in sorted((start[r.shard] + r.slot, -1 if r.doc_id is None else r.doc_id) for r in got)] == want and len(place) >= 1000


def test_interleaving_of_few_rows(spark):
    assert sharded(spark, []) == []
    assert sorted((r.shard, r.slot) for r in sharded(spark, [(i, "t", "s") for i in range(5)])) == [(i, 0) for i in range(5)]


def test_interleaving_of_sources_with_one_row_each(spark, monkeypatch):
    most, numbered = [], interleave._numbered

    def watched(df, keys, *rest):
        if keys == ["_all"]:  # rows of the largest task of the common order
            most.append(max(r["count"] for r in df.groupBy("_bucket").count().collect()))
        return numbered(df, keys, *rest)

    monkeypatch.setattr(interleave, "_numbered", watched)
    got = sharded(spark, [(i, "t", f"s{i:04}") for i in range(800)], bucket_rows=100)
    assert most[0] <= 250
    assert [r.stratum for r in sorted(got, key=lambda r: (r.shard, r.slot))] == [f"=s{i:04}" for i in range(800)]


# URL rules

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"),
         ("a.com", "/", "block"), ("a.com", "/x", "allow"), ("a.com", "/x/y", "block"), ("a.com", "/x/yz", "allow"), ("a.com", "/é", "allow"), ("a.com", "", "block"), ("b.a.com", "/x", "block"), ("com", "/fr/", "allow")]


def brute_url(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = lambda t, stops: t[:min((t.index(c) for c in stops if c in t), default=len(t))]
    host = cut(rest, "/?#")
    path = cut(rest[len(host):], "?#")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    top = max(fits, default=None)
    return host, path, top and top[2], top[3] if top else default


def test_url_rules_against_brute_force(spark):
    draw = random.Random(2)
    hosts = ["example.org", "x.EXAMPLE.org", "notexample.org", "org", "com", "a.com", "b.a.com", "c.b.a.com", "aa.com", "É.com", "", "a.com:80", "." * 50 + "com"]
    paths = ["", "/", "/es", "/es/", "/es/q", "/en/1", "/en/12/x", "/en/2", "/fr/", "/de/x", "/x", "/xa", "/x/y", "/x/yz", "/x/yzz", "/x/z", "/é", "/\uffff", "/x" + "y" * 20_000, "/x\n/y"]
    urls = [draw.choice(["http://", "https://", "x://y://", "://"]) + draw.choice(hosts) + draw.choice(paths) + draw.choice(["", "?a=/b://c", "#t", "?#"]) for _ in range(600)]
    urls += [None, "", "no scheme", "http:/one", "a://b"] + ["http://a.com/x/y"] * 50
    rows = [(None if i % 97 == 0 else i, u) for i, u in enumerate(urls)] + [(3, urls[3]), (3, urls[3]), (None, None), (None, None)]
    pages = spark.createDataFrame([(i, u, *"abcd") for i, u in rows], "page_id long, url string, html string, host string, copies string, rule string").repartition(3)
    rules = spark.createDataFrame(RULES + [("a.com", "/x", "block"), (None, "/", "block"), ("com", None, "block")], "host string, path string, verdict string")
    effective = [r for r in RULES if r != ("a.com", "/x", "allow")] + [("a.com", "/x", "block")]
    got = Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_rules.judge_urls(pages, rules, sweep_rows=10).collect())
    assert got == Counter((i, *brute_url(u, effective)) for i, u in rows)
    none = rules.limit(0)
    assert {(r.rule, r.verdict) for r in url_rules.judge_urls(pages, none, default="block").collect()} == {(None, "block")}
    assert url_rules.judge_urls(pages.limit(0), rules).count() == 0


# Page texts

@pytest.mark.parametrize("html, text", [
    ("", ""), ("plain  text\n", "plain text"), ("<p>a<p>b &amp; c&nbsp;d &am", "a\nb & c d &am"),
    ("<html><head><title>t</title><script>var t='</p>';</script></head><body><nav><a>menu</a></nav><!-- <p>no --><article><h1>H</h1><p><b>x <i>y</i><br>z<p>w</article><footer>f</footer>", "H\nx y z\nw"),
    ("<body><div class='cookie-notice'>n</div><main><header>top</header><p>main</p><aside>s</aside></main><div>other</div>", "main"),
    ("<article><header><h1>T</h1></header>text<div id=\"comments\"><article class=comment>c</article></div><form>f</form></article>", "T\ntext"),
    ("<div>a<div>b</div>c</div><ul><li>1<li>2</ul>", "a\nb\nc\n1\n2"), ("<p>a <script>x", "a"), ("<p>a <!-- open", "a"), ("<p>a <b title='x > y'>b</b> < c <d", "a b < c"),
    ("<p>1 < 2 & 3 &#233; &lt;p&gt;</p><p hidden>h</p><div role=search>s</div><div style='display: none'>d</div>", "1 < 2 & 3 é <p>"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"), ("<ARTICLE><P>Up</P></ARTICLE>", "Up"), ("</p></div>x</b>", "x"), ("<p>" + "w " * 100_000, ("w " * 100_000).strip())])
def test_page_text(html, text):
    assert templates.Page(html).text() == text


def test_templates_of_a_host_go(spark):
    menu, note = "<div><span>Home</span> <a>News</a></div>", "<section>All rights kept</section>"
    rows = [(i, f"http://a.example/{i}", f"{menu}<p>text {i}</p><p>often</p>{note}") for i in range(8)]
    rows += [(20 + i, f"http://b.example/{i}", f"{menu}<p>b {i}</p>") for i in range(3)]  # too few pages to tell
    rows += [(40 + i, f"http://c.example/{i}", f"{menu}<article><p>same</p><p>c {i}</p></article>") for i in range(8)]
    rows += [(60, None, None), (61, "x", ""), (62, "http://a.example/9", "<p>alone</p>"), (62, "http://a.example/9", "<p>alone</p>"), (None, "http://a.example/10", None)]
    pages = spark.createDataFrame([(*r, *"abc") for r in rows], "page_id long, url string, html string, host string, hashes string, text string").repartition(3)
    got = defaultdict(list)
    for r in templates.main_texts(pages).collect():
        got[r.page_id].append(r.text)
        assert r.n_chars == len(r.text)
    assert [got[i] for i in range(8)] == [[f"text {i}"] for i in range(8)]
    assert [got[20 + i] for i in range(3)] == [[f"Home News\nb {i}"] for i in range(3)]
    assert [got[40 + i] for i in range(8)] == [[f"same\nc {i}"] for i in range(8)]
    assert got[60] == got[61] == got[None] == [""] and got[62] == ["alone", "alone"]
    assert templates.main_texts(pages.limit(0)).count() == 0


@pytest.mark.parametrize("html, text", [
    ('<article class="post no-sidebar"><h2 id="social-structure">S</h2><section id="navigation-at-sea">N</section><p id="comments-on-rome">C</p><h2 id="comments">D</h2><p class="share-price">P</p></article>', "S\nN\nC\nD\nP"),
    ('<article><p>a <math><mi>x</mi><annotation>tex</annotation></math> <object>o</object> <span aria-hidden="true">h</span> <span id="navigation">n</span></p></article>', "a x o h n"),
    ('<article>a<div class="ad">b</div><div class="x newsletter-signup">c</div><section id="comments">d</section><div id="ad-12">e</div><math hidden>f</math></article>', "a"),
    ('<h2 id="social-structure">S</h2><p>a</p><div class="share-buttons">b</div><math>x</math>', "S\na")])
def test_names_that_only_hold_a_furniture_word_stay_in_articles(html, text):
    assert templates.Page(html).text() == text


def test_copies_are_no_template_and_menus_of_a_part_are(spark):
    menu, story = "<div><span>Home</span> <a>News</a></div>", "<p>once upon a time</p><p>the end</p>"
    rows = [(i, "http://a.example/s", f"<div id=page><article>{story}</article></div>") for i in range(9)]  # copies with an article
    rows += [(20 + i, "http://b.example/s", f"<div id=page>{story}</div>{menu}") for i in range(9)]  # and without
    rows += [(40 + i, f"http://b.example/{i}", f"<p>b {i}</p>{menu}") for i in range(6)]
    rows += [(100 + i, f"http://c.example/{i}", f"{menu if i % 3 == 0 else ''}<p>c {i}</p>") for i in range(60)]  # a menu on a third
    rows += [(200 + i, f"http://d.example/{i}", f"<div id=page><article><p>same</p></article></div><p>d {i}</p>") for i in range(9)]  # the rest differs
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r.page_id: r.text for r in templates.main_texts(pages, many_pages=20).collect()}
    assert {got[i] for i in range(9)} == {got[20 + i] for i in range(9)} == {"once upon a time\nthe end"}
    assert [got[40 + i] for i in range(6)] == [f"b {i}" for i in range(6)]
    assert [got[100 + i] for i in range(60)] == [f"c {i}" for i in range(60)]
    assert {got[200 + i] for i in range(9)} == {"same"}


# Vector search

def test_search_against_brute_force(spark):
    draw = random.Random(3)
    vectors = [(i, [draw.gauss(0, 1) for _ in range(8)]) for i in range(150)]
    vectors += [(i, [0.5] * 8) for i in range(150, 220)] + [(i, [float(draw.randint(-2, 2)) for _ in range(8)]) for i in range(220, 300)]
    vectors += [(300, None), (320, []), (340, [0.0] * 8), (360, [None] + [1.0] * 7), (380, [float("nan")] * 8), (400, [float("inf")] + [0.0] * 7), (420, [1e30] * 8), (440, [1e-30] * 8), (460, [1.0, 2.0]), (461, [3.0, 1.0]),
                (480, [1.0] * 3), (20, vectors[20][1]), (None, [1.0] * 8), (-20, [2.0] * 8)]
    table = spark.createDataFrame([(i, v, "a", "b") for i, v in vectors], "vec_id long, embedding array<double>, dim string, q string").repartition(3)
    got = defaultdict(list)
    for r in block_search.nearest(table, F.col("vec_id") % 20 == 0, k=20, query_rows=4, parts=3).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    import math
    ok = {i: v for i, v in vectors if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    for q in (i for i in ok if i % 20 == 0):
        scored = []
        for c, v in ok.items():
            if c != q and len(v) == len(ok[q]):
                total = 0.0
                for a, b in zip(ok[q], v):
                    total += a * b
                scored.append((-total, c))
        want = [(k + 1, c, -s) for k, (s, c) in enumerate(sorted(scored)[:20])]
        assert sorted(got.pop(q, [])) == want
    assert not got
    assert block_search.nearest(table.limit(0), F.col("vec_id") % 20 == 0).count() == 0
