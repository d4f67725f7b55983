"""Tokenization, id files, packing and the digest cache against the plain library."""
import random
from collections import defaultdict
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from docloom.llm import packing, repair
from docloom.llm.digest_cache import CACHE, append_misses, read_cache, token_counts
from docloom.llm.tokens import WordTable, tokenizer_digest, tokenizer_path, word_table

WORD, BYTE = "word_bpe_49k.json", "byte_bpe_50k.json"
ODD = ["", " ", "  ", " a  b", "a \n b", "a\n\n b ", "it's  \n\n x\t\ty z", "ΣΑΣ αΣ. ﬁ é ́x", "\x1ca\x1d b", "a\x00b \x00c", "<|endoftext|> a<|endoftext|>",
       "<|startoftext|>", "x" * 50_000, "word, " * 20_000, "Été À straße 123 4.5", "　a\u0085b"]
SCHEMA = "doc_id long, text string, content string, n_tokens string, digest string, start string"


def library(name):
    return Tokenizer.from_file(tokenizer_path(name))


def frame(spark, rows):
    """Documents with extra columns whose names clash with those that operators use."""
    return spark.createDataFrame([(i, t, "c", "n", "d", "s") for i, t in rows], SCHEMA).repartition(3)


def word_ids(text):
    return library(WORD).encode(text or "", add_special_tokens=False).ids + [2]


@pytest.mark.parametrize("name", [WORD, BYTE])
def test_table_gives_the_library_s_ids(name):
    draw, table, plain = random.Random(3), WordTable(tokenizer_path(name), limit=200), library(name)
    parts = ["a", "b", " ", "  ", "\n", "\t", "é", "É", "1", "'s", ",", ".", "\x00", "Σ", "　", "\x85", "<|endoftext|>", "th", "ing ", "The "]
    texts = ODD + ["".join(draw.choice(parts) for _ in range(draw.randint(0, 40))) for _ in range(800)]
    for first in range(0, len(texts), 100):
        some = texts[first:first + 100]
        for text, ids, n in zip(some, table.encode([t.encode() for t in some]), table.count([t.encode() for t in some])):
            want = plain.encode(text, add_special_tokens=False).ids
            assert ids.tolist() == want and n == len(want), text[:60]


def test_repair_is_lossless_and_random_access_works():
    draw = np.random.default_rng(1)
    for n, symbols in ((0, 5), (1, 5), (2, 5), (5000, 3), (20_000, 60), (3000, 1)):
        ids = draw.integers(0, symbols, n).astype(np.uint32)
        data = repair.to_bytes(ids, [n], [7], 100, pairs=8, rounds=20, least=2)
        shard = repair.from_bytes(data)
        assert (shard.expand(shard.symbols) == ids).all() and shard.doc_ids == [7]
        for _ in range(20):
            a = int(draw.integers(0, n + 1))
            b = int(draw.integers(0, n - a + 1))
            assert (shard.read(a, b) == ids[a:a + b]).all()
    pairs = [(1, 2), (3, 4)] * 2000
    assert len(repair.to_bytes(np.array(pairs, np.uint32).ravel(), [8000], [None], 10)) < 4000


def test_repair_replaces_one_pair_at_a_time_if_asked():
    seq, rules = repair.compress(np.array([1, 2, 1, 2, 1, 2, 3, 3, 3, 3], np.int64), 10, pairs=1, rounds=2, least=2)
    assert [r.tolist() for r in rules] == [[[1, 2]], [[3, 3]]] or [r.tolist() for r in rules] == [[[1, 2]], [[10, 10]]]
    assert len(seq) <= 8


def test_ids_in_files(spark, tmp_path):
    rows = [(i * 3 % 40, t) for i, t in enumerate(ODD + [None, "same", "same"])] + [(None, "no id"), (5, "twice"), (5, "twice")]
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in repair.encode_to_files(frame(spark, rows), WORD, 4, str(tmp_path / "ids"), shard_ids=3000).collect())
    want, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode())):
        ids = word_ids(t)
        want.append((start, i, len(ids), crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want
    assert repair.encode_to_files(frame(spark, []), WORD, 2, str(tmp_path / "none")).count() == 0


def check_packing(spark, rows, capacity):
    pieces = packing.pack(frame(spark, rows), WORD, capacity=capacity).collect()
    sequences, texts = defaultdict(list), defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
        texts[p.doc_id].append(p)
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    want = defaultdict(list)
    for i, t in rows:
        want[i].append(word_ids(t))
    for i, ids in want.items():
        if len(ids) == 1:
            own, at = sorted(texts[i], key=lambda p: p.start), 0
            for p in own:
                assert p.start == at and p.doc_tokens == len(ids[0]) and p.ids_crc32 == crc32(np.array(ids[0][at:at + p.length], "<u4").tobytes())
                at += p.length
            assert at == len(ids[0])
        else:
            assert sum(p.length for p in texts[i]) == sum(map(len, ids))
    assert set(texts) == set(want)
    total = sum(len(x) for ids in want.values() for x in ids)
    return len(sequences) * capacity - total


def test_packing_loses_nothing_and_pads_one_window_per_task(spark):
    draw = random.Random(5)
    rows = [(i, " ".join(["word"] * draw.randint(0, 150))) for i in range(400)] + [(1000 + i, t) for i, t in enumerate(ODD)] + [(None, None), (7777, "twice"), (7777, "twice"), (8, None)]
    assert check_packing(spark, rows, 64) < 3 * 64
    assert packing.pack(frame(spark, []), WORD).count() == 0


def test_sum_of_squares_rule_against_brute_force():
    draw, levels = random.Random(2), packing.SumOfSquares(30)
    count = [0] * 31
    for _ in range(2000):
        size = draw.randint(1, 29)

        def after(level):
            c = count[:]
            if level:
                c[level] -= 1
            c[level + size] += level + size < 30
            return sum(x * x for x in c[1:30])

        choices = [h for h in range(1, 31 - size) if count[h]] + [0]
        level = levels.place(size)
        assert level in choices and after(level) == min(map(after, choices))
        if level:
            count[level] -= 1
        count[level + size] += level + size < 30
        assert levels.count[1:30].tolist() == count[1:30]


def test_digest_cache_encodes_only_misses(spark, tmp_path):
    path, plain = str(tmp_path / "cache"), library(BYTE)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(50, None), (51, "a copy"), (52, "a copy"), (52, "a copy"), (None, "no id")]
    want = sorted(((-1 if i is None else i), len((t or "").encode()), len(plain.encode(t or "", add_special_tokens=False).ids)) for i, t in rows)
    read = lambda df: sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_tokens) for r in df.collect())
    assert read(token_counts(frame(spark, rows), path, BYTE)) == want
    stored = spark.read.schema(CACHE).parquet(path)
    assert stored.count() == len({t or "" for _, t in rows})
    # A planted count shows that a known digest is not encoded again; another version has entries of its own.
    version = tokenizer_digest(BYTE)
    spark.createDataFrame([(version, "planted")], "v string, t string").select(
        F.col("v").alias("tokenizer"), F.unhex(F.sha2(F.col("t").cast("binary"), 256)).alias("digest"), F.lit(7).cast("long").alias("n_bytes"), F.lit(999).cast("long").alias("n_tokens")).write.mode("append").parquet(path)
    more = frame(spark, [(1, "planted"), (2, "new one")])
    assert read(token_counts(more, path, BYTE)) == [(1, 7, 999), (2, 7, 2)]
    append_misses(more, path, WORD)
    assert read_cache(spark, path, tokenizer_digest(WORD)).count() == 2
    assert token_counts(frame(spark, []), path, BYTE).count() == 0
    assert word_table(BYTE) is word_table(BYTE)
