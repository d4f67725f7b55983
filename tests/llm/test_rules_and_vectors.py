"""Quality rules, whitening and hard negatives against plain Python."""
import random
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from docloom.llm import hard_negatives, quality_rules, whitening

# Quality rules


def brute_counts(text):
    space = " \t\n\x0b\x0c\r"
    words, word = [], ""
    for c in (text or "") + " ":
        if c in space:
            words += [word] if word else []
            word = ""
        else:
            word += c
    windows = defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i:i + 8])].append(i)
    hit = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(8)}
    lines = [x for x in (text or "").split("\n") if any(c not in space for c in x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit), len(lines)


def brute_part(value):
    width = 1
    while value >= 512 * width:
        width *= 2
    return value // width * width + width // 2


def brute_rules(rows):
    """kept and failed measures of every row (doc_id, text, lang, source)."""
    counted = [brute_counts(t) for _, t, _, _ in rows]
    base = [n < 20 or 100 * rep > 30 * n for n, _, _, _, rep, _ in counted]
    values = [{"word_length": 1000 * c // max(n, 1), "symbols": 1000 * s // max(n, 1), "dup_lines": 1000 * d // max(k, 1), "repeat_words": 1000 * rep // max(n, 1)} for n, c, s, d, rep, k in counted]

    def quartile(group, measure):
        parts = sorted(brute_part(values[i][measure]) for i in group)
        return len(parts), *(next(p for k, p in enumerate(parts, 1) if k >= share * len(parts)) for share in (0.25, 0.75))

    def drawn(own, wider):
        return own[0], *((own[0] * a + 100 * b) / (own[0] + 100) for a, b in zip(own[1:], wider[1:]))

    sketched = [i for i in range(len(rows)) if not base[i]]
    out = []
    for i, (_, _, lang, source) in enumerate(rows):
        failed = []
        for m, (least, both) in sorted(quality_rules.MEASURES.items()):
            of_lang = [j for j in sketched if rows[j][2] == lang]
            group = [j for j in of_lang if rows[j][3] == source]
            if group:
                _, low, high = drawn(quartile(group, m), drawn(quartile(of_lang, m), quartile(sketched, m)))
                spread = 3 * max(high - low, least)
                if values[i][m] > high + spread or both and values[i][m] < low - spread:
                    failed.append(m)
        out.append((*counted[i][:5], base[i], failed, not base[i] and not failed))
    return out


def rule_rows(draw):
    word = lambda a, b: "".join(draw.choice("abcdefgé漢") for _ in range(draw.randint(a, b)))
    text = lambda n, a=3, b=7: " ".join(word(a, b) + ("\n" if draw.random() < 0.1 else "") for _ in range(n))
    rows = [(i, text(draw.randint(15, 120)), "en" if i % 3 else "de", "hot" if i % 2 else f"s{i % 5}") for i in range(150)]
    rows += [(i, text(60, 9, 14), "de", "long") for i in range(150, 175)]  # long words are normal in one source
    rows += [(220, text(60, 12, 14), "en", "hot"), (221, " ".join(["|", "x"] * 40), "en", "hot"), (222, "\n".join(["same line here and there"] * 4 + [text(90).replace("\n", " ")]), "en", "hot"), (223, text(40) + " ##", "en", "hot")]
    phrase = text(8)
    rows += [(230, f"{phrase} {phrase} {text(60)}", "en", "hot"), (231, "a " * 9, "en", "hot"), (232, "a " * 8, "en", "hot"), (233, "a b " * 30, "en", "hot"), (234, f"{text(50)} {phrase} {text(20)}", "en", "hot")]
    rows += [(300, None, "en", "hot"), (301, "", None, None), (302, " \n\t\x0b\x0c\r", "en", None), (303, text(40), None, None), (304, text(40), None, "hot"), (305, text(40), "xx", "one"), (None, text(40), "en", "hot")]
    rows += [(7, rows[7][1], "en", "hot"), (7, rows[7][1], "en", "hot"), (306, text(20_000), "en", "hot"), (307, "   " + text(30) + "\x1c\x85", "en", "hot"), (308, "x" * 100_000, "en", "hot")]
    return rows


def ruled(spark, rows, **how):
    docs = spark.createDataFrame([(i, t, a, s, 1, "x", "y") for i, t, a, s in rows], "doc_id long, text string, lang string, source string, n_words int, kept string, measure string").repartition(3)
    return quality_rules.quality_rules(docs, **how)


def test_rules_against_brute_force(spark):
    rows = rule_rows(random.Random(2))
    got = sorted((str(r.doc_id), r.lang or "", r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.failed, r.kept) for r in ruled(spark, rows).collect())
    assert got == sorted((str(row[0]), row[2] or "", *want) for row, want in zip(rows, brute_rules(rows)))
    judged = {x[0]: x for x in got}
    assert judged["160"][-1] and not judged["220"][-1]  # long words pass where they are normal, and only there
    assert judged["222"][-2] == ["dup_lines"] and not judged["221"][-1]
    assert ruled(spark, []).count() == 0


def test_sketches_merge_in_any_order(spark):
    rows = rule_rows(random.Random(4))
    sketches = [quality_rules.sketch(quality_rules.measured(spark.createDataFrame(part, "doc_id long, text string, lang string, source string"))) for part in (rows[:50], rows[50:51], rows[51:])]
    whole = quality_rules.sketch(quality_rules.measured(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")))
    as_set = lambda df: {tuple(r) for r in df.select("lang", "source", "measure", "part", "rows").collect()}
    assert as_set(whole) == as_set(quality_rules.merged(*sketches)) == as_set(quality_rules.merged(quality_rules.merged(sketches[2], sketches[0]), sketches[1]))
    # Rows seen earlier move the limits: a symbol in every other word is normal then.
    marked = [(i, "word ## " * 3 + " ".join(f"w{100 + i}x{k} |" for k in range(30)), "en", "hot") for i in range(400)]
    earlier = quality_rules.sketch(quality_rules.measured(spark.createDataFrame(marked, "doc_id long, text string, lang string, source string")))
    kept = lambda **how: {r.doc_id for r in ruled(spark, [*rows[:20], (900, marked[0][1], "en", "hot")], **how).filter("kept").collect()}
    assert 900 not in kept() and 900 in kept(earlier=earlier)


def test_parts_are_near_and_ordered(spark):
    values = [0, 1, 255, 511, 512, 513, 1023, 1024, 5000, 10 ** 6, 10 ** 9]
    got = [r.p for r in spark.createDataFrame([(v,) for v in values], "v long").select("v", quality_rules.part_of(F.col("v")).alias("p")).orderBy("v").collect()]
    assert got == [brute_part(v) for v in values] == sorted(got) and all(abs(p - v) <= v / 256 for p, v in zip(got, values))


# Whitening


def vectors_frame(spark, vectors):
    return spark.createDataFrame([(i, v, "a", 1) for i, v in vectors], "vec_id long, embedding array<double>, whitened string, n int").repartition(3)


def check_whitened(rows, vectors, wanted=32):
    x = np.array([[int(np.floor(64 * c)) + 1_000_000 for c in v] for _, v in vectors], object)
    n, s = len(x), x.sum(0)
    m = n * x.T.dot(x) - np.outer(s, s)
    e, axes = np.linalg.eigh(m.astype(float))
    e, axes = e[::-1], axes[:, ::-1]
    k = min(wanted, int((e > 1e-9 * e[0]).sum()))
    trace = int(np.trace(m))
    assert len(rows) == n * k
    own = defaultdict(list)
    for r in rows:
        own[r.component].append(r)
    for c in range(1, k + 1):
        assert {(r.n, r.identity_error) for r in own[c]} == {(n, rows[0].identity_error)}
        assert abs(own[c][0].explained - e[c - 1] / trace) <= 1e-9 * own[c][0].explained
    assert rows[0].identity_error <= 1e-9
    deviations = sorted(((i is None, i or 0), int(((n * row - s) ** 2).sum())) for (i, _), row in zip(vectors, x))
    assert sorted(((r.vec_id is None, r.vec_id or 0), int(r.deviation_exact)) for r in own[1]) == deviations
    assert all(r.deviation == int(r.deviation_exact) for r in rows)
    # The covariance of the whitened values with the entries gives the axes back, whatever their signs.
    if len({i for i, _ in vectors}) == n:
        place = {i: j for j, (i, _) in enumerate(vectors)}
        white = np.zeros((n, k))
        for r in rows:
            white[place[r.vec_id], r.component - 1] = r.whitened
        centred = (n * x - s).astype(float) / n
        found = centred.T @ white / n
        found /= np.linalg.norm(found, axis=0)
        for c in range(k):
            residual = m.astype(float) @ found[:, c] - e[c] * found[:, c]
            assert np.abs(residual).max() <= 1e-9 * e[0]


def test_whitening_against_numpy(spark):
    draw = np.random.default_rng(1)
    vectors = [(i, (draw.normal(size=40) * np.linspace(1, 3, 40)).tolist()) for i in range(300)]
    odd = [(900, None), (901, []), (902, [None] * 40), (903, [float("nan")] * 40), (904, [float("inf")] * 40), (905, [1.0] * 7)]
    check_whitened(whitening.whitening(vectors_frame(spark, vectors + odd)).collect(), vectors)
    few = [(i, v[:5]) for i, v in vectors] + [(3, vectors[3][1][:5]), (None, vectors[4][1][:5])]  # repeated ids and none
    check_whitened(whitening.whitening(vectors_frame(spark, few)).collect(), few)


def test_whitening_of_equal_and_missing_variances(spark):
    """A root three times over, a column that repeats another and one that never changes."""
    points = [(k, [float(s if k % 4 == j else 0) for j in range(4)] + [float(s if k % 4 == 0 else 0), 2.0]) for k, s in enumerate([1, 1, 1, 1, -1, -1, -1, -1])]
    rows = whitening.whitening(vectors_frame(spark, points)).collect()
    assert {r.component for r in rows} == {1, 2, 3, 4}
    check_whitened(rows, points)
    for same in ([(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], []):
        assert whitening.whitening(vectors_frame(spark, same)).collect() == []
    with pytest.raises(Exception, match="too large"):
        whitening.whitening(vectors_frame(spark, [(1, [1e15]), (2, [2.0])])).collect()


def test_large_entries_stay_exact(spark):
    vectors = [(i, [1e11 + i, -3e10 * i, float(i % 3)]) for i in range(9)]
    rows = whitening.whitening(vectors_frame(spark, vectors)).collect()
    x = [[int(64 * Fraction(c)) + 1_000_000 for c in v] for _, v in vectors]
    s = [sum(c) for c in zip(*x)]
    want = {i: sum((9 * a - b) ** 2 for a, b in zip(row, s)) for i, row in enumerate(x)}
    assert {r.vec_id: int(r.deviation_exact) for r in rows} == want
    assert all(r.deviation == (want[r.vec_id] if want[r.vec_id] < 1 << 63 else None) for r in rows)


def exact_polynomial(m):
    """Coefficients by the Faddeev-LeVerrier recurrence, in integers."""
    d = len(m)
    m = np.array(m, object)
    out, b = [1], np.eye(d, dtype=object) * 0
    for k in range(1, d + 1):
        b = m.dot(b) + out[-1] * np.eye(d, dtype=int).astype(object)
        out.append(-int(np.trace(m.dot(b))) // k)
    return out


def test_polynomial_and_roots_are_exact(spark):
    draw = random.Random(8)
    for d, rank in ((1, 1), (6, 6), (9, 4), (12, 12)):
        a = [[draw.randint(-10 ** 6, 10 ** 6) for _ in range(rank)] for _ in range(d)]
        m = [[sum(x * y for x, y in zip(r, s)) for s in a] for r in a]
        polynomial = whitening.characteristic_polynomial(spark, m)
        assert polynomial == exact_polynomial(m)
        trace = sum(m[i][i] for i in range(d))
        found = whitening.isolated(polynomial, trace, d)
        assert sum(n for *_, n in found) == rank  # roots of zero are none
        e = np.linalg.eigvalsh(np.array(m, float))[::-1]
        for k, f in enumerate(found):
            root, fraction = whitening.refined(polynomial, trace, *f, 400)
            assert abs(root / 2 ** fraction - e[k]) <= 1e-6 * e[0]
    # Roots that differ by a part in 10 ** 30, and axes that follow.
    big = 10 ** 30
    m = [[big, 0, 0], [0, big + 1, 0], [0, 0, big // 2]]
    parts = whitening.principal_components(spark, m, 3)
    assert [round(root / 2 ** fraction / big, 3) for root, fraction, _ in parts] == [1, 1, 0.5]
    assert [max(range(3), key=lambda i: abs(v[i])) for _, _, v in parts] == [1, 0, 2]


# Hard negatives


def brute_negatives(rows, anchor_mod, positives, negatives, low, high):
    ok = {}
    for i, v, label in sorted(rows, key=str):
        if i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v):
            ok[i] = min(ok.get(i, (99, [])), (label, v))
    if not ok:
        return []
    codes = {i: [int(np.floor(256 * x)) for x in v] for i, (_, v) in ok.items()}
    out = []
    for a in ok:
        if a % anchor_mod:
            continue
        scored = sorted((-sum(x * y for x, y in zip(codes[a], codes[b])), b) for b in ok if b != a and len(codes[b]) == len(codes[a]))
        for minus, p in [x for x in scored if ok[x[1]][0] == ok[a][0]][:positives]:
            fit = [x for x in scored if ok[x[1]][0] != ok[a][0] and low * -minus <= 100 * -x[0] <= high * -minus][:negatives]
            out += [(a, p, k + 1, b, -minus, -s) for k, (s, b) in enumerate(fit)]
    return sorted(out)


def mined(spark, rows, **how):
    table = spark.createDataFrame([(i, v, label, 1, "x") for i, v, label in rows], "vec_id long, embedding array<double>, label int, slot int, dim string").repartition(3)
    found = hard_negatives.hard_negatives(table, F.col("vec_id") % 10 == 0, F.col("label"), **how).collect()
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in found)


def test_negatives_against_brute_force(spark):
    draw = random.Random(7)
    rows = [(i, [draw.gauss(0.2, 1) for _ in range(6)], draw.choice([0, 0, 0, 0, 1, 2])) for i in range(200)]  # one label holds most rows
    rows += [(i, [float(draw.randint(0, 1)) for _ in range(6)], i % 2) for i in range(200, 320)]  # many ties
    rows += [(i, [0.5] * 6, i % 2) for i in range(320, 360)] + [(i, [-1.0] * 6, 5) for i in range(360, 366)]  # equal rows
    rows += [(400, None, 1), (410, [], 1), (420, [None] * 6, 1), (430, [float("nan")] * 6, 1), (440, [float("inf")] * 6, 1), (450, [1.0] * 6, None), (460, [1.0, 2.0], 0), (461, [2.0, 1.0], 0), (462, [1.0, 1.0], 1),
             (470, [1.0] * 6, 77), (20, rows[20][1], rows[20][2]), (30, [9.0] * 6, 9), (None, [1.0] * 6, 1), (-20, [1.0] * 6, 0), (480, [0.0] * 6, 0)]
    want = brute_negatives(rows, 10, 5, 10, 30, 90)
    assert len(want) > 300
    assert mined(spark, rows) == want
    assert mined(spark, rows, part_bytes=400, block_bytes=200) == want  # many parts and blocks
    assert mined(spark, rows, positives=3, negatives=4, low=80, high=120) == brute_negatives(rows, 10, 3, 4, 80, 120)
    assert mined(spark, []) == mined(spark, rows[1:10]) == []


def test_scores_of_large_components_are_exact(spark):
    draw = random.Random(3)
    for size in (2.0 ** 12, 2.0 ** 20):
        rows = [(i, [draw.uniform(0, size) for _ in range(3)], i % 3) for i in range(40)]
        assert mined(spark, rows) == brute_negatives(rows, 10, 5, 10, 30, 90)
    with pytest.raises(Exception, match="too large"):
        mined(spark, [(i, [1e30], i % 2) for i in range(4)])
