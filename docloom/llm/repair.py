"""Token ids on disk, compressed by a Re-Pair grammar per shard.

A shard is a run of documents in ascending doc_id order. Its ids are one sequence; round by round the most frequent
pairs of neighbours become nonterminals, counted exactly before they are replaced from left to right. ``pairs`` pairs are
taken per round (1 is the textbook order; more rounds, same format), and rounds end when no pair occurs ``least`` times,
after ``rounds`` rounds at the latest. The defaults (24 times, six rounds) mostly leave the symbols in two bytes; more
rules pass 65,536 symbols and need four: a shard of two million ids of the check tables takes 2.4 MB, and 4.3 MB with
``least=4, rounds=40``. Ids decode alike. The file keeps the sequence, the rules and the expansion length of every rule,
so a range of ids is found by adding lengths and only the symbols it touches are expanded. Texts of any length are
encoded whole; a document is never cut, so a shard ends after the document that fills it.

File, little-endian: ``RPR1``, then eight unsigned 64-bit counts (terminals, rules, symbols, documents, ids, rounds,
bytes per symbol, 0), rules per round (u4), left and right sides (u4), expansion lengths (u4), symbols (2 or 4 bytes
each), ids per document (u8), doc_ids (i8), null flags of doc_ids (u1).

Defined cases: a null or empty text is the end id alone. Repeated rows are written as often as given, next to each
other. A null doc_id comes first. An empty table gives no shards and no rows. Other columns are ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.common import fresh_folder, text_bytes
from docloom.llm.tokens import text_groups, word_table

MAGIC, HEAD = b"RPR1", "<4s8Q"
#: Ids of a shard, pairs replaced in a round, and rounds. A pair must occur LEAST times to be replaced.
SHARD_IDS, PAIRS, ROUNDS, LEAST = 2_000_000, 4096, 6, 24
_BUCKETS = 1 << 18
SHARDS = "part int, shard int, docs long, ids long, payload binary"


def compress(ids: np.ndarray, terminals: int, pairs: int = PAIRS, rounds: int = ROUNDS, least: int = LEAST) -> tuple[np.ndarray, list[np.ndarray]]:
    """The remaining symbols, and per round the rules as rows (left, right)."""
    seq, rules, symbols = ids.astype(np.int64), [], terminals
    for _ in range(rounds):
        if len(seq) < 2:
            break
        left, right = seq[:-1], seq[1:]
        bucket = (left * 40503 + right * 2654435761 >> 5) & (_BUCKETS - 1)
        often = np.bincount(bucket, minlength=_BUCKETS)
        # A pair is at most as frequent as its bucket; buckets hold the candidates, exact counts decide.
        bound = max(least, int(np.partition(often, -2 * pairs)[-2 * pairs]) if 2 * pairs < _BUCKETS else least)
        maybe = np.flatnonzero((often >= bound)[bucket])
        found, count = np.unique(left[maybe] << 32 | right[maybe], return_counts=True)
        take = np.flatnonzero(count >= least)
        if len(take) > pairs:
            take = np.sort(take[np.argsort(-count[take], kind="stable")[:pairs]])
        if not len(take):
            break
        chosen = found[take]
        keys = left[maybe] << 32 | right[maybe]
        rank = np.minimum(np.searchsorted(chosen, keys), len(chosen) - 1)
        hit = chosen[rank] == keys
        at, rank = maybe[hit], rank[hit]
        # Of overlapping occurrences in a row, every second one from the left is replaced.
        first = np.concatenate(([True], np.diff(at) != 1))
        run = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
        even = (np.arange(len(at)) - run) % 2 == 0
        at, rank = at[even], rank[even]
        seq[at] = symbols + rank
        seq = np.delete(seq, at + 1)
        rules.append(np.stack((chosen >> 32, chosen & 0xFFFFFFFF), 1))
        symbols += len(chosen)
    return seq, rules


@dataclass
class Shard:
    """A decoded file head: symbols and the flat expansions of all of them."""

    symbols: np.ndarray
    size: np.ndarray
    start: np.ndarray
    flat: np.ndarray
    doc_size: np.ndarray
    doc_ids: list

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        return _gather(self.flat, self.start[symbols], self.size[symbols])

    def read(self, start: int, length: int) -> np.ndarray:
        """Ids start to start + length of the shard, expanding only the symbols that hold them."""
        ends = np.cumsum(self.size[self.symbols])
        first, last = np.searchsorted(ends, start, "right"), np.searchsorted(ends, start + length, "left")
        ids = self.expand(self.symbols[first:last + 1])
        skip = start - (int(ends[first - 1]) if first else 0)
        return ids[skip:skip + length]


def _gather(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(start - ends + size, size) + np.arange(total)]


def to_bytes(ids: np.ndarray, doc_size: list[int], doc_ids: list, terminals: int, **how: int) -> bytes:
    """One shard file."""
    seq, rules = compress(ids, terminals, **how)
    pairs = np.concatenate(rules) if rules else np.zeros((0, 2), np.int64)
    size, done = np.ones(terminals + len(pairs), np.int64), terminals
    for r in rules:
        size[done:done + len(r)] = size[r[:, 0]] + size[r[:, 1]]
        done += len(r)
    wide = 2 if done <= 1 << 16 else 4
    head = struct.pack(HEAD, MAGIC, terminals, len(pairs), len(seq), len(doc_size), len(ids), len(rules), wide, 0)
    parts = [np.array([len(r) for r in rules], "<u4"), pairs[:, 0].astype("<u4"), pairs[:, 1].astype("<u4"), size[terminals:].astype("<u4"), seq.astype(f"<u{wide}"),
             np.array(doc_size, "<u8"), np.array([0 if d is None else d for d in doc_ids], "<i8"), np.array([d is None for d in doc_ids], "<u1")]
    return head + b"".join(p.tobytes() for p in parts)


def from_bytes(data: bytes) -> Shard:
    """A shard file, ready for whole or partial decoding."""
    magic, terminals, n_rules, n_symbols, n_docs, _, n_rounds, wide, _ = struct.unpack_from(HEAD, data)
    if magic != MAGIC:
        raise ValueError("not a shard file")
    at = struct.calcsize(HEAD)

    def part(kind: str, n: int) -> np.ndarray:
        nonlocal at
        a = np.frombuffer(data, kind, n, at)
        at += a.nbytes
        return a

    per_round, left, right, length = part("<u4", n_rounds), part("<u4", n_rules), part("<u4", n_rules), part("<u4", n_rules)
    symbols, doc_size, doc_ids, null = part(f"<u{wide}", n_symbols), part("<u8", n_docs), part("<i8", n_docs), part("<u1", n_docs)
    size = np.concatenate((np.ones(terminals, np.int64), length.astype(np.int64)))
    start = np.cumsum(size) - size
    flat = np.zeros(int(size.sum()), np.uint32)
    flat[:terminals] = np.arange(terminals)
    done = 0
    for n in per_round.tolist():  # a rule refers to earlier rounds only
        sides = np.stack((left[done:done + n], right[done:done + n]), 1).ravel()
        filled = _gather(flat, start[sides], size[sides])
        flat[start[terminals + done]:start[terminals + done] + len(filled)] = filled
        done += n
    return Shard(symbols, size, start, flat, doc_size.astype(np.int64), [None if x else d for d, x in zip(doc_ids.tolist(), null.tolist())])


def write_ids(docs: DataFrame, path: str, tokenizer: str, partitions: int, end_id: int = 2, shard_ids: int = SHARD_IDS, column: str = "text", **how: int) -> None:
    """Shard files of all documents in ascending doc_id order, a row each: part and shard give their order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, end, part, shard = word_table(tokenizer), np.array([end_id], np.uint32), TaskContext.get().partitionId(), 0
        terminals = table.library.get_vocab_size(with_added_tokens=True)
        ids, doc_size, doc_ids, held = [], [], [], 0

        def file() -> pa.RecordBatch:
            data = to_bytes(np.concatenate(ids), doc_size, doc_ids, terminals, **how)
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([len(doc_size)], pa.int64()), pa.array([held], pa.int64()),
                                               pa.array([data], pa.binary())], names=["part", "shard", "docs", "ids", "payload"])

        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for first, group in text_groups(texts):
                for i, got in enumerate(table.encode(group)):
                    ids += [got, end]
                    doc_size.append(len(got) + 1)
                    doc_ids.append(keys[first + i])
                    held += len(got) + 1
                    if held >= shard_ids:
                        yield file()
                        ids, doc_size, doc_ids, held, shard = [], [], [], 0, shard + 1
        if doc_size:
            yield file()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes(column).alias("content"))
    ordered = rows.repartitionByRange(partitions, "doc_id").sortWithinPartitions("doc_id", "content")
    ordered.mapInArrow(run, SHARDS).write.option("compression", "uncompressed").parquet(path)


def read_ids(spark, path: str) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, number, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                shard = from_bytes(data.as_py())
                ids, ends = shard.expand(shard.symbols).astype("<u4"), np.cumsum(shard.doc_size)
                raw, starts = memoryview(ids).cast("B"), ends - shard.doc_size
                sums = [crc32(raw[4 * a:4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                n = len(sums)
                yield pa.RecordBatch.from_arrays([pa.array([part] * n, pa.int32()), pa.array([number] * n, pa.int32()), pa.array(shard.doc_ids, pa.int64()),
                                                  pa.array(starts, pa.int64()), pa.array(shard.doc_size, pa.int64()), pa.array(sums, pa.int64())],
                                                 names=["part", "shard", "doc_id", "inside", "n_tokens", "ids_crc32"])

    files = spark.read.schema(SHARDS).parquet(path)
    # One row per file: its place among all ids.
    before = F.coalesce(F.sum("ids").over(Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    places = files.select("part", "shard", before.alias("_before"))
    docs = files.select("part", "shard", "payload").mapInArrow(run, "part int, shard int, doc_id long, inside long, n_tokens long, ids_crc32 long")
    return docs.join(places, ["part", "shard"]).select("doc_id", (F.col("_before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def encode_to_files(docs: DataFrame, tokenizer: str, partitions: int, path: str | None = None, **how: int) -> DataFrame:
    """Write the shard files, read them back."""
    path = path or fresh_folder(docs.sparkSession, "repair-shards")
    write_ids(docs, path, tokenizer, partitions, **how)
    return read_ids(docs.sparkSession, path)
