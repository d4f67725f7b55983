"""Online packing of documents into windows by the sum of squares.

Every task packs the documents it reads. A level array counts its open windows by fill level; a document goes to the
level (an open one, or a new window) that leaves the smallest sum of squared counts, so no level piles up and windows
that fit a later document stay at hand. Documents longer than a window give full windows first; their rest is placed.
At the end of a task the pieces of its emptiest open windows are cut to fill the fullest ones, so each task leaves one
partly filled window at most. A task holds its open windows, never more.

Defined cases: a null or empty text is the end id alone. Repeated rows are packed as often as given. A null doc_id is
carried. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import text_bytes
from docloom.llm.tokens import TABLE_PIECES, text_groups, word_table

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: Sequences that one task may number.
TASK_SEQUENCES = 1 << 32


class SumOfSquares:
    """Fill levels of open windows. ``place`` names the level a size goes to; 0 opens a window."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.count = np.zeros(capacity + 1, np.int64)

    def place(self, size: int) -> int:
        """The level of least growth in the sum of squares; ties go to the fullest level."""
        count, top = self.count, self.capacity - size
        levels = np.flatnonzero(count[1:top + 1]) + 1
        after = 2 * count[size] + 1 if size < self.capacity else 0
        best, level = after, 0
        if len(levels):
            reached = levels + size
            growth = np.where(reached < self.capacity, 2 * count[reached] + 2, 1) - 2 * count[levels]
            at = len(levels) - 1 - int(np.argmin(growth[::-1]))
            if growth[at] <= best:
                level = int(levels[at])
        if level:
            count[level] -= 1
        if level + size < self.capacity:
            count[level + size] += 1
        return level


class Packer:
    """Windows of one task. A piece is [doc_id, doc_tokens, start, ids]."""

    def __init__(self, capacity: int):
        self.capacity, self.levels = capacity, SumOfSquares(capacity)
        self.open: dict[int, list[list]] = {}
        self.closed: list[list] = []

    def add(self, doc_id, ids: np.ndarray) -> None:
        whole = len(ids) // self.capacity * self.capacity
        for start in range(0, whole, self.capacity):
            self.closed.append([[doc_id, len(ids), start, ids[start:start + self.capacity]]])
        if whole < len(ids):
            piece = [doc_id, len(ids), whole, ids[whole:].copy()]
            level = self.levels.place(len(ids) - whole)
            window = self.open[level].pop() if level else []
            window.append(piece)
            filled = level + len(ids) - whole
            if filled == self.capacity:
                self.closed.append(window)
            else:
                self.open.setdefault(filled, []).append(window)

    def close(self) -> None:
        """Fill the fullest open windows with pieces cut from the emptiest."""
        rest = [[level, window] for level in sorted(self.open, reverse=True) for window in self.open[level]]
        first, last = 0, len(rest) - 1
        while first < last:
            (level, window), donor = rest[first], rest[last]
            piece = donor[1][-1]
            take = min(self.capacity - level, len(piece[3]))
            cut = len(piece[3]) - take
            window.append([piece[0], piece[1], piece[2] + cut, piece[3][cut:]])
            rest[first][0] += take
            donor[0] -= take
            if cut:
                piece[3] = piece[3][:cut]
            else:
                donor[1].pop()
            if rest[first][0] == self.capacity:
                first += 1
            if not donor[1]:
                last -= 1
        self.closed += [window for _, window in rest if window]
        self.open = {}


def pack(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 2, column: str = "text", table_pieces: int = TABLE_PIECES) -> DataFrame:
    """Pieces of all documents, each with its place in a sequence of at most ``capacity`` ids.

    ``table_pieces``: word pieces whose ids a Python worker keeps; fewer take less memory and more time. A task's rows are a part of the input files, so a task that is run again gives the same sequences.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, packer, end = word_table(tokenizer, table_pieces), Packer(capacity), np.array([end_id], np.uint32)
        number = TaskContext.get().partitionId() * TASK_SEQUENCES
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for first, group in text_groups(texts):
                for i, ids in enumerate(table.encode(group)):
                    packer.add(doc_ids[first + i], np.concatenate((ids, end)))
                yield rows(packer.closed, number)
                number += len(packer.closed)
                packer.closed = []
        packer.close()
        if packer.closed:
            yield rows(packer.closed, number)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes(column).alias("content")).mapInArrow(run, PIECES)


def rows(windows: list[list], number: int) -> pa.RecordBatch:
    """Pieces of finished windows; ``number`` is the first one's sequence_id."""
    pieces = [(p, number + i, j) for i, w in enumerate(windows) for j, p in enumerate(w)]
    length = np.array([len(p[3]) for p, _, _ in pieces], np.int64)
    before = np.cumsum(length) - length
    first = np.array([j == 0 for _, _, j in pieces], bool)
    offset = before - before[np.maximum.accumulate(np.where(first, np.arange(len(pieces)), 0))] if pieces else before
    columns = [[p[0] for p, _, _ in pieces], [p[2] for p, _, _ in pieces], length, [crc32(p[3].astype("<u4").tobytes()) for p, _, _ in pieces],
               [p[1] for p, _, _ in pieces], [n for _, n, _ in pieces], offset]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
