"""Exact batch tokenization through a table of the words seen so far.

Both vocabularies split a text at white space before any merge, so the ids of a text are the ids of its
space-separated pieces in a row. A text is cut at ASCII white space (word vocabulary) or before single
spaces (byte vocabulary); only pieces not met yet go to the tokenizers library, many in one call, apart by
a special token. Texts that hold the start of a special token, or runs of spaces under the byte vocabulary,
go to the library whole. The table of a Python worker is bounded and starts anew when it is full.
"""

from __future__ import annotations

import hashlib
import os
import re
from itertools import chain, islice

import numpy as np

from docloom.llm.common import KEPT, claim

#: Pieces kept by one Python worker; about 150 bytes each.
TABLE_PIECES = 700_000
#: Pieces sent to the library in one string.
CALL_PIECES = 512

#: Pieces that are one run of composed Latin letters and perhaps one sign: one or two words for the merges.
PLAIN = re.compile("([A-Za-z\u00df-\u00f6\u00f8-\u00ff]+)([.,;:!?]?)")
#: Bytes as the letters that both vocabularies write for them: printable ones as they are, the others from U+0100 on.
_PRINTED = {*range(0x21, 0x7f), *range(0xa1, 0xad), *range(0xae, 0x100)}
BYTE_SIGNS = {b: chr(0x100 + i) for i, b in enumerate(b for b in range(256) if b not in _PRINTED)}
BYTE_TABLE = str.maketrans({chr(b): sign for b, sign in BYTE_SIGNS.items()})

_loaded: dict[str, "WordTable"] = {}


def tokenizer_path(name_or_path: str) -> str:
    """A file's own path, or the place of a public vocabulary of that name."""
    if os.path.sep in name_or_path:
        return name_or_path
    import public_tokenizers
    return public_tokenizers.path(name_or_path)


def tokenizer_digest(name_or_path: str) -> str:
    """Version of a tokenizer: SHA-256 of its file, hex."""
    with open(tokenizer_path(name_or_path), "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


class _Numbering(dict):
    """Numbers pieces in order of first use."""

    def __missing__(self, piece: bytes) -> int:
        self[piece] = number = len(self)
        return number


class WordTable:
    """Ids of pieces as flat arrays: piece i has ids[start[i]:start[i] + size[i]]."""

    def __init__(self, path: str, limit: int = TABLE_PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.library, self.limit = Tokenizer.from_file(path), limit
        added = sorted(self.library.get_added_tokens_decoder().items())
        self.marks = [t.content.encode() for _, t in added]
        self.mark_id, self.mark = added[-1][0], added[-1][1].content
        #: Word ends in the vocabulary: pieces are words. Otherwise a piece begins with its space.
        self.spaced = not (self.library.model.end_of_word_suffix if hasattr(self.library.model, "end_of_word_suffix") else None)
        self.clear()

    def clear(self) -> None:
        self.number = _Numbering()
        self.start, self.size = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int32)
        self.ids, self.used, self.known = np.zeros(1 << 14, np.uint32), 0, 0
        self.cores: dict[str, tuple[int, ...]] = {}

    def whole(self, text: bytes) -> bool:
        """Whether a text has to go to the library in one piece."""
        return any(m in text for m in self.marks) or self.spaced and b"  " in text

    def library_ids(self, text: bytes) -> np.ndarray:
        return np.array(self.library.encode(text.decode(), add_special_tokens=False).ids, np.uint32)

    def pieces(self, text: bytes) -> list[bytes]:
        if not self.spaced:
            return text.split()
        first, *rest = text.split(b" ")
        # A first piece has no space; 0x00 marks it, as a space marks the others.
        return [b"\x00" + first, *rest] if first else rest

    def _text(self, piece: bytes) -> str:
        if not self.spaced:
            return piece.decode()
        return piece[1:].decode() if piece[:1] == b"\x00" else " " + piece.decode()

    def _calls(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of any pieces, by whole calls of the library."""
        texts = [self._text(p) for p in pieces]
        calls = [self.mark.join(texts[i:i + CALL_PIECES]) for i in range(0, len(texts), CALL_PIECES)]
        out: list[np.ndarray] = []
        for i in range(0, len(calls), 64):
            for e in self.library.encode_batch_fast(calls[i:i + 64], add_special_tokens=False):
                ids = np.array(e.ids, np.uint32)
                at = np.flatnonzero(ids == self.mark_id)
                out += [part[1:] for part in np.split(np.concatenate(([self.mark_id], ids)).astype(np.uint32), at + 1)]
        if len(out) != len(pieces):
            raise ValueError("pieces and their ids don't match")
        return out

    def learn(self) -> None:
        """Encode the pieces numbered since the last call."""
        new = list(islice(reversed(self.number), len(self.number) - self.known))[::-1]
        if not new:
            return
        size, flat, odd = np.zeros(len(new), np.int32), [], []
        cores, merge, lead = self.cores, self.library.model.tokenize, BYTE_SIGNS[0x20] if self.spaced else ""
        for i, piece in enumerate(new):
            plain = PLAIN.fullmatch(piece.decode())
            if not plain:
                odd.append(i)
                flat.append(())
                continue
            word, sign = plain.groups()
            if not self.spaced:
                word = word.lower()
            ids = cores.get(word)
            if ids is None:
                signs = word if word.isascii() else word.encode().decode("latin-1").translate(BYTE_TABLE)
                ids = cores[word] = tuple([t.id for t in merge(lead + signs)])
            if sign:
                more = cores.get(sign)
                if more is None:
                    more = cores[sign] = tuple([t.id for t in merge(sign)])
                ids += more
            flat.append(ids)
        for i, ids in zip(odd, self._calls([new[i] for i in odd])):
            flat[i] = ids.tolist()
        size[:] = [len(x) for x in flat]
        total = int(size.sum())
        self.start, self.size, self.ids = (_room(a, n) for a, n in ((self.start, len(self.number)), (self.size, len(self.number)), (self.ids, self.used + total)))
        where = slice(self.known, len(self.number))
        self.size[where] = size
        self.start[where] = self.used + np.cumsum(size) - size
        self.ids[self.used:self.used + total] = np.fromiter(chain.from_iterable(flat), np.uint32, total)
        self.used, self.known = self.used + total, len(self.number)

    def numbers(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Piece numbers of all texts in a row, and the count of each text."""
        if len(self.number) > self.limit:
            self.clear()
        parts = [self.pieces(t) for t in texts]
        counts = np.array([len(p) for p in parts], np.int64)
        if self.spaced:  # a later piece that itself begins with 0x00 would be read as a first one
            for i, p in enumerate(parts):
                if b"\x00" in texts[i]:
                    counts[i], parts[i] = 0, []
        get = self.number.__getitem__
        flat = np.fromiter(map(get, chain.from_iterable(parts)), np.int64, int(counts.sum()))
        self.learn()
        return flat, counts

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of every text."""
        alone = [i for i, t in enumerate(texts) if self.whole(t) or self.spaced and b"\x00" in t]
        plain = [b"" if i in set(alone) else t for i, t in enumerate(texts)] if alone else texts
        flat, counts = self.numbers(plain)
        size = self.size[flat]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids[np.repeat(self.start[flat] - ends + size, size) + np.arange(total)]
        cuts = np.concatenate(([0], ends))[np.cumsum(counts)]
        out = np.split(ids, cuts[:-1]) if len(cuts) else []
        for i in alone:
            out[i] = self.library_ids(texts[i])
        return out

    def count(self, texts: list[bytes]) -> np.ndarray:
        """The number of ids of every text."""
        alone = [i for i, t in enumerate(texts) if self.whole(t) or self.spaced and b"\x00" in t]
        plain = [b"" if i in set(alone) else t for i, t in enumerate(texts)] if alone else texts
        flat, counts = self.numbers(plain)
        ends = np.concatenate(([0], np.cumsum(self.size[flat])))
        at = np.cumsum(counts)
        out = ends[at] - ends[at - counts]
        for i in alone:
            out[i] = len(self.library_ids(texts[i]))
        return out


def _room(a: np.ndarray, n: int) -> np.ndarray:
    return a if n <= len(a) else np.concatenate((a, np.zeros(max(n, 2 * len(a)) - len(a), a.dtype)))


KEPT["tokens"] = _loaded.clear


def word_table(name_or_path: str, pieces: int = TABLE_PIECES) -> WordTable:
    """The table of this Python worker, for so many pieces at most."""
    claim("tokens")
    path = tokenizer_path(name_or_path)
    if path not in _loaded:
        _loaded[path] = WordTable(path)
    _loaded[path].limit = pieces
    return _loaded[path]


def text_groups(texts: list[bytes], most: int = 4 << 20):
    """Runs of texts of about that many bytes, as (first, texts)."""
    first, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= most:
            yield first, texts[first:i + 1]
            first, held = i + 1, 0
    if first < len(texts):
        yield first, texts[first:]
