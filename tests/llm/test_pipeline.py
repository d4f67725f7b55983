"""The pipeline against plain Python, stage by stage."""
import random
from collections import defaultdict
from zlib import crc32

import numpy as np
from test_text import brute_contamination, brute_near, sentences, toxic_corpus
from tokenizers import Tokenizer

import corpus_pipeline
from docloom.llm import toxicity
from docloom.llm.tokens import tokenizer_path


def test_pipeline_against_plain_python(spark, tmp_path):
    draw = random.Random(12)
    rows, labels = toxic_corpus(300)
    passage = sentences(draw, 30, 40)
    rows += [(1000 + i, rows[4 * i + 1][1]) for i in range(20)] + [(1100 + i, rows[4 * i + 1][1] + " one more") for i in range(20)]
    rows += [(1200 + i, f"{sentences(draw, 20 * i, 900)} {passage} {sentences(draw, 5, 900)}") for i in range(8)]
    rows += [(1300, None), (1301, ""), (None, "no id " + sentences(draw, 30)), (1302, "long " * 20_000), (1303, rows[1][1]), (1303, rows[1][1]), (1303, sentences(draw, 12))]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    items = [(1, passage), (2, None)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    truth, texts = dict(labels), {i: t for i, t in rows if i in dict(labels)}
    sample = sorted((t.encode(), truth[i]) for i, t in texts.items() if crc32(str(i).encode()) % 5)
    model = toxicity.train([t for t, _ in sample], np.array([y for _, y in sample], np.float32))
    scores = toxicity.Scorer(model).scores([(t or "").encode() for _, t in rows])
    kept = [r for r, s in zip(rows, scores) if s < 0.5]
    assert len(kept) < len(rows)
    # Repeated rows and rows of one doc_id are told apart by their texts.
    near = defaultdict(bool)
    by_place = brute_near([(n, t) for n, (_, t) in enumerate(kept)])
    groups = defaultdict(list)
    for n, _, component, _ in by_place:
        groups[component].append(n)
    for members in groups.values():
        ids = [kept[n][0] for n in members if kept[n][0] is not None]
        for n in members:
            near[n] = not ids or kept[n][0] == min(ids)
    kept = [r for n, r in enumerate(kept) if near[n]]
    kept = [r for r in kept if not brute_contamination([r], items)[0][5]]
    plain, want = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json")), defaultdict(int)
    for i, t in kept:
        want[i] += len(plain.encode(t or "", add_special_tokens=False).ids) + 1
    got, filled = defaultdict(int), defaultdict(int)
    for p in corpus_pipeline.run(spark, str(tmp_path)).collect():
        got[p.doc_id] += p.length
        filled[p.sequence_id] += p.length
    assert got == want and max(filled.values()) <= 4096


def test_stages_on_empty_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([], schema)
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert out.count() == 0
        assert name == "packing" or out.columns == docs.columns


def test_stages_carry_clashing_columns(spark, tmp_path):
    spark.createDataFrame([(1, 0)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "a b c")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    names = ["doc_id", "text", "score", "predicted", "text_hash", "kept", "_id", "_hash", "digest", "member", "words", "pos", "term", "content", "label"]
    docs = spark.createDataFrame([(1, "some words of text here", *["x"] * 13), (2, None, *["y"] * 13)], "doc_id long, text string, " + ", ".join(f"{n} string" for n in names[2:]))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert out.count() == 2
        assert name == "packing" or out.columns == names
