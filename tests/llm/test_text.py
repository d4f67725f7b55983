"""Toxicity, decontamination and near duplicates against plain Python."""
import hashlib
import random
import re
from collections import defaultdict
from zlib import crc32

import numpy as np
import pytest

from docloom.llm import bottom_k, contamination, toxicity

SCHEMA = "doc_id long, text string, words string, label string, positions string, digest string, component string, item string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def frame(spark, rows, parts=3):
    """Documents with extra columns whose names clash with those that operators use."""
    return spark.createDataFrame([(i, t, *"abcdef") for i, t in rows], SCHEMA).repartition(parts)


def sentences(draw, n, vocabulary=3000):
    return " ".join(f"w{draw.randint(0, vocabulary)}" for _ in range(n))


# Toxicity

def toxic_corpus(n=500):
    draw, rows, labels = random.Random(4), [], []
    for i in range(n):
        words, toxic = sentences(draw, draw.randint(5, 60)).split(), i % 4 == 0
        if toxic:
            for _ in range(3):
                words.insert(draw.randint(0, len(words)), draw.choice(["grubbed", "grubber", "snarly,", "snarlish"]) + draw.choice(["", "x", "yz"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark):
    rows, labels = toxic_corpus()
    extra = [(9001, None), (9002, ""), (9003, " \n "), (None, "no id grubbed snarly, grubber"), (9004, "clean " * 30_000), (9005, "clean " * 30_000 + "grubbed grubber snarly, snarlish"), (1, rows[1][1])]
    table = spark.createDataFrame([*labels, (4, 0), (77777, 1), (3, None)], "doc_id long, toxic int")
    got = toxicity.toxicity(frame(spark, rows + extra), table).collect()
    assert len(got) == len(rows) + len(extra) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    of, truth = {r.doc_id: r.predicted for r in got}, dict(labels)
    held = [i for i in truth if crc32(str(i).encode()) % 5 == 0]
    assert sum(of[i] == truth[i] for i in held) >= 0.97 * len(held)
    assert of[9005] == 1 and of[9004] == of[9001] == of[9002] == of[9003] == 0 and of[None] == 1
    scores = [r.score for r in got if r.doc_id == 1]
    assert len(scores) == 2 and scores[0] == scores[1]


def test_toxicity_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.predicted for r in toxicity.toxicity(frame(spark, [(1, "a b")]), none).collect()] == [0]
    clean = spark.createDataFrame([(i, 0) for i in range(30)], "doc_id long, toxic int")
    assert {r.predicted for r in toxicity.toxicity(frame(spark, [(i, "a b") for i in range(30)]), clean).collect()} == {0}
    assert toxicity.toxicity(frame(spark, []), clean).count() == 0


def test_toxicity_thresholds_weigh_the_classes_as_the_corpus_does(spark):
    """A word that more clean than toxic rows have isn't toxic, though most of a sample with as many rows of each class says so."""
    draw, rows, labels = random.Random(12), [], []
    for i in range(6000):
        toxic = i % 8 == 0
        word = draw.choice(["grubber"] * 3 + ["murky"] * 2) if toxic else draw.choice(["murky"] + ["plain"] * 4)
        rows.append((i, f"{sentences(draw, 4)} {word} {sentences(draw, 4)}"))
        labels.append((i, int(toxic)))
    table, probes = spark.createDataFrame(labels, "doc_id long, toxic int"), [(10_000, "w1 grubber w2"), (10_001, "w1 murky w2"), (10_002, "w1 plain w2")]
    docs = frame(spark, rows + probes)
    got = {r.doc_id: r for r in toxicity.toxicity(docs, table, positives=400, negatives=400).collect()}
    assert [got[i].predicted for i, _ in probes] == [1, 0, 0]
    truth = dict(labels)
    held = [i for i in truth if crc32(str(i).encode()) % 5 == 0]
    hits, said, real = (sum(x) for x in zip(*((truth[i] * got[i].predicted, got[i].predicted, truth[i]) for i in held)))
    assert 2 * hits / (said + real) >= 0.7
    # The pipeline's way gives the same scores.
    model = toxicity.fit(docs, table, positives=400, negatives=400)
    assert {r.doc_id: r.score for r in toxicity.score(docs, model).collect()} == {i: r.score for i, r in got.items()}
    kept = {r.doc_id for r in toxicity.without_toxic(docs, model).collect()}
    assert kept == {i for i, r in got.items() if not r.predicted}


def test_gradients_against_differences():
    draw = np.random.default_rng(0)
    model = toxicity.Model(1)
    words, counts = toxicity.Words().read([b"one two three four", b"two five", b""])
    rows = draw.integers(1, 50, (6, 5))
    rows[0] = 0
    labels, weights = np.array([1.0, 0, 1], np.float32), np.ones(3)

    def loss():
        p = np.clip(model.raw(model.embed[rows].sum(1)[words], counts), 1e-9, 1 - 1e-9)
        return -(labels * np.log(p) + (1 - labels) * np.log(1 - p)).mean()

    before = loss()
    for _ in range(30):
        model.step(words, rows, counts, labels, weights, state={}, rate=0.01)
    assert loss() < before and (model.embed[0] == 0).all()
    again = toxicity.Model.from_bytes(model.to_bytes())
    x = model.embed[rows].sum(1)[words]
    assert (again.raw(x, counts) == model.raw(x, counts)).all()


# Contamination

def brute_contamination(rows, items, window=13):
    words_of = lambda t: WORD.findall((t or "").translate(UPPER))
    out = []
    for i, text in rows:
        words, hit, found = words_of(text), set(), set()
        for item_id, item in items:
            own = words_of(item)
            n = min(window, len(own))
            windows = {tuple(own[j:j + n]) for j in range(len(own) - n + 1)} if own else set()
            for j in range(len(words) - n + 1) if windows else ():
                if tuple(words[j:j + n]) in windows:
                    hit.update(range(j, j + n))
                    found.update([] if item_id is None else [str(item_id)])
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(words), len(hit), len(found), digest, len(hit) > 0 and 20 * len(hit) >= len(words)))
    return sorted(out, key=str)


def test_contamination_against_brute_force(spark):
    draw = random.Random(8)
    passage = sentences(draw, 40, 30)
    items = [(1, passage), (2, sentences(draw, 25, 30)), (3, "Rare Words"), (4, None), (5, ""), (6, "--- !"), (None, sentences(draw, 14, 30)), (10, passage), (1, "other text É of item one"), (2, None)]
    rows = [(i, sentences(draw, draw.randint(0, 90), 30)) for i in range(60)]
    parts = [passage.split(), items[1][1].split(), items[6][1].split()]
    for i in range(60, 120):
        own = draw.choice(parts)
        a = draw.randint(0, len(own) - 10)
        cut = own[a:a + draw.randint(10, 40)]
        rows.append((i, f"{sentences(draw, draw.randint(0, 300), 30)} {draw.choice([' ', '-', '. '])}{draw.choice([' ', '_', ', ']).join(cut).upper()}; {sentences(draw, draw.randint(0, 30), 30)}"))
    rows += [(200, None), (201, ""), (202, "?!"), (203, passage), (203, passage), (203, "other"), (None, passage), (204, "x rare words y"), (205, "rare-words rare words É of"), (206, "OTHER text É of item ONE"),
             (207, "other text é of item one"), (208, sentences(draw, 30_000, 30) + " " + passage)]
    table = spark.createDataFrame([(i, t, "a", "b") for i, t in items], "item_id long, text string, term string, pos string")
    got = contamination.contamination(frame(spark, rows), table)
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got.collect()), key=str) == brute_contamination(rows, items)


def test_contamination_of_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert [(r.n_words, r.n_hit, r.contaminated) for r in contamination.contamination(frame(spark, [(1, "a b")]), none).collect()] == [(2, 0, False)]
    assert contamination.contamination(frame(spark, []), none).count() == 0


def test_proximity(spark):
    filler = " ".join(f"fill{i}" for i in range(40))
    docs = spark.createDataFrame([(1, "alpha beta gamma"), (2, "gamma x beta y alpha"), (3, f"alpha {filler} beta gamma"), (4, "alpha beta"), (5, f"{filler} alpha beta gamma"), (None, "Alpha, GAMMA; beta"), (7, None)],
                                 "doc_id long, text string")
    items = spark.createDataFrame([("absent", "alpha beta gamma nowhere"), ("pair", "beta alpha"), ("lone", "gamma"), ("missing", "nowhere never"), (None, "alpha beta gamma"), ("empty", "")], "item_id string, text string")
    got = {(r.doc_id, r.item_id) for r in contamination.proximity_matches(docs, items, span=13).collect()}
    three, two = {1, 2, 5, None}, {1, 2, 4, 5, None}
    assert got == {(d, i) for d in three for i in ("absent", None)} | {(d, "pair") for d in two} | {(d, "lone") for d in three | {3}}
    with pytest.raises(ValueError):
        contamination.proximity_matches(docs, items, span=5)


def test_proximity_finds_every_copied_window(spark):
    """Copies of long items, whose rarest words stand far apart, and reworded ones."""
    draw = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    items = [(k, [draw.choice(words[:30]) for _ in range(50)]) for k in range(6)]
    for k, own in items:  # three rare words, over 20 apart
        own[2], own[25], own[48] = f"rare{k}a", f"rare{k}b", f"rare{k}c"
    docs = [(100 + k, " ".join(draw.choice(words) for _ in range(30)) + " " + " ".join(own) + " end") for k, own in items]
    docs += [(200 + k, " ".join(own[10:23])) for k, own in items] + [(300 + k, " ".join(reversed(own[20:33]))) for k, own in items]
    docs += [(400 + k, " ".join(draw.choice(words[30:]) for _ in range(60))) for k in range(6)]
    frame_of = lambda rows, names: spark.createDataFrame(rows, names)
    table = frame_of(docs, "doc_id long, text string")
    given = frame_of([(str(k), " ".join(own)) for k, own in items], "item_id string, text string")
    near = {(r.doc_id, r.item_id) for r in contamination.proximity_matches(table, given).collect()}
    exact = {(r.doc_id, r.item_id) for r in contamination.phrase_matches(table, given).collect()}
    assert exact <= near and {(100 + k, str(k)) for k in range(6)} | {(200 + k, str(k)) for k in range(6)} <= exact
    assert {(300 + k, str(k)) for k in range(6)} <= near - exact
    assert not [d for d, _ in near if d >= 400]


# Near duplicates

def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    n = min(5, len(words))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if words else set()


def brute_near(rows):
    sets, parent = [shingles(t) for _, t in rows], list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    ids = defaultdict(list)
    for x in range(len(rows)):
        if rows[x][0] is not None:
            ids[root(x)].append(rows[x][0])
    return sorted(((rows[x][0], len(sets[x]), name := (min(ids[root(x)], default=None) if sets[x] else rows[x][0]), rows[x][0] == name) for x in range(len(rows))), key=str)


def near_rows(draw):
    base = sentences(draw, 60).split()
    common = sentences(draw, 30)
    rows = [(i, sentences(draw, draw.randint(1, 80))) for i in range(60)]
    for i in range(60, 160):  # a group of near copies, of which some are linked through others only
        words = base[:]
        for _ in range(draw.randint(0, 2)):
            words[draw.randint(0, 59)] = f"new{draw.randint(0, 5)}"
        rows.append((i, " ".join(words)))
    rows += [(i, f"{common} {sentences(draw, draw.randint(0, 40))}") for i in range(160, 230)]  # a common passage
    rows += [(i, rows[i - 230][1].upper() if i % 2 else rows[i - 230][1].replace(" ", "\n ")) for i in range(230, 260)]
    rows += [(400, None), (401, ""), (402, " \n"), (403, "one"), (404, "One"), (405, "a b c d"), (406, "a b c d e"), (407, "a b c d e"), (407, "a b c d e"), (407, sentences(draw, 20)), (None, "a b c d e"), (None, "lone text here"),
             (408, "long " * 30_000), (409, sentences(draw, 20_000)), (410, "É é"), (411, "é é")]
    return rows


def test_near_duplicates_against_brute_force(spark):
    rows = near_rows(random.Random(6))
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in bottom_k.near_duplicates(frame(spark, rows)).collect()), key=str)
    assert [g[:3] for g in got] == [w[:3] for w in brute_near(rows)]
    assert all(g[3] == (g[0] == g[2]) for g in got)
    assert bottom_k.near_duplicates(frame(spark, [])).count() == 0


def test_near_duplicates_without_doc_id(spark):
    """A near copy without doc_id is linked, and bridges two texts that aren't linked with each other."""
    draw = random.Random(5)
    copied, chain = sentences(draw, 60).split(), [f"c{i}" for i in range(110)]
    rows = [(1, " ".join(copied)), (None, " ".join([*copied[:-1], "new"])), (None, " ".join([*copied[:-1], "new"])), (None, "alone " + sentences(draw, 40))]
    rows += [(10, " ".join(chain[:90])), (None, " ".join(chain[10:100])), (11, " ".join(chain[20:110]))]
    assert {w[2] for w in brute_near(rows)} == {1, 10, None}
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in bottom_k.near_duplicates(frame(spark, rows)).collect()), key=str)
    assert got == brute_near(rows)


def test_union_shares_against_sets():
    import pyarrow as pa
    draw = random.Random(3)
    left = [sorted(draw.sample(range(60), draw.randint(0, 8))) for _ in range(300)]
    right = [sorted(draw.sample(range(60), draw.randint(0, 8))) if i % 3 else left[i] for i in range(300)]
    want = [len(set(sorted(set(x) | set(y))[:8]) & set(x) & set(y)) for x, y in zip(left, right)]
    assert bottom_k.union_shares(pa.array(left, pa.list_(pa.int64())), pa.array(right, pa.list_(pa.int64())), 8).tolist() == want


def links_of(spark, rows, **sizes):
    """All links that open lists yield when nothing is connected yet, and all there are, as pairs of doc_ids."""
    docs = frame(spark, rows)
    found = bottom_k.written(bottom_k.sketches(docs), "t-sketches")
    classes = bottom_k.written(found.filter("n_shingles > 0").groupBy("digest", "n_shingles").agg(bottom_k.F.min("doc_id").alias("class_id"), bottom_k.F.max("doc_id").alias("member"), bottom_k.F.first("sketch").alias("sketch")), "t-classes")
    sets = bottom_k.written(bottom_k.class_sets(docs, classes, bottom_k.inverted_lists(classes)).dropDuplicates(["digest"]), "t-sets")
    alone = spark.createDataFrame([], "node binary, component binary")
    rest = bottom_k.written(bottom_k.open_lists(bottom_k.role_lists(sets), alone, **sizes), "t-rest")
    ids = {r.digest: r.class_id for r in classes.collect()}
    long = bottom_k.long_list_links(rest, sets).collect()
    short = bottom_k.exact_links(bottom_k.estimated(bottom_k.short_pairs(rest), classes), sets, group=4).collect()
    text, want = dict(rows), set()
    for a in ids.values():
        for b in ids.values():
            x, y = shingles(text[a]), shingles(text[b])
            if a < b and 100 * len(x & y) >= 75 * len(x | y):
                want.add(frozenset((a, b)))
    as_pairs = lambda found: [frozenset((ids[r.a], ids[r.b])) for r in found]
    return as_pairs(long), as_pairs(short), want


def joined(pairs):
    """The groups that pairs connect."""
    groups = {}
    for a, b in map(tuple, pairs):
        both = groups.get(a, {a}) | groups.get(b, {b})
        groups.update((x, both) for x in both)
    return {frozenset(g) for g in groups.values()}


def test_short_lists_find_every_link(spark):
    long, short, want = links_of(spark, near_rows(random.Random(9))[60:230], small=10 ** 6)
    assert not long and set(short) == want and len(short) == len(want)


@pytest.mark.parametrize("sizes", [dict(small=3, block=16), dict(small=0), dict(small=3, block_bytes=3000)])
def test_long_lists_connect_what_is_linked(spark, sizes):
    long, short, want = links_of(spark, near_rows(random.Random(9))[60:230], **sizes)
    assert set(long) | set(short) <= want and long
    assert joined(set(long) | set(short)) == joined(want)


def test_near_misses_of_a_hot_group_make_no_rows(spark):
    """Copies of one text with two to five words changed: nearly all pairs are alike, few are linked."""
    draw = random.Random(12)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(300):
        words = base[:]
        for at in draw.sample(range(120), draw.randint(2, 5)):
            words[at] = f"new{i}x{at}"
        rows.append((i, " ".join(words)))
    long, short, want = links_of(spark, rows)
    assert 0 < len(want) and joined(set(long) | set(short)) == joined(want)
    assert len(long) + len(short) <= 30 * len(rows)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in bottom_k.near_duplicates(frame(spark, rows)).collect()), key=str)
    assert [g[:3] for g in got] == [w[:3] for w in brute_near(rows)]
