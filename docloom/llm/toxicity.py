"""Toxicity by a small convolutional text classifier, trained in numpy.

A word's embedding is the sum of hashed rows for the word and for its first 3 to 6 letters, so that an unseen form of a
known stem is near it. Filters over 1, 2 and 3 neighbouring words are max-pooled over the whole text and joined by a
logistic layer. One task trains the weights on a bounded sample of labelled rows (``POSITIVES`` and ``NEGATIVES`` texts,
those whose keys have the smallest hashes, out of four fifths of the rows). The thresholds, one for each language, come from all
labelled rows whose text wasn't trained on: executors score them, and their scores are counted by language, label and
bin, so the classes weigh as in the corpus at every size. If a class has too few such rows, all labelled rows count.
The language is guessed from common words of the text itself; labels, lang, source and doc_id are no inputs.
The score is moved so that the language's threshold lies at 0.5.

Defined cases: a null, empty or blank text is scored as a text without words. Repeated rows get equal scores. Labels of
unknown documents are ignored; of several labels of a document the larger counts. If only one class is labelled, every
text gets a score below 0.5 (no toxic example) or of 0.5 and above (no clean one); without labels below 0.5. An empty
table gives no rows. Other columns are ignored. Texts are read whole.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from functools import reduce
from itertools import chain, islice
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import claim, text_bytes, written
from docloom.llm.tokens import text_groups

#: Texts of each class that training may read.
POSITIVES, NEGATIVES = 2000, 3000
#: Rows of each class that a threshold needs, parts of the labelled rows of which one is never trained on, and bins of scores.
ENOUGH, FOLDS, BINS = 20, 5, 2000
#: Embedding rows and size, filter widths, filters of each width, passes.
ROWS, SIZE, WIDTHS, FILTERS, PASSES, BATCH = 1 << 16, 8, (1, 2, 3), 8, 4, 64
PREFIXES = (3, 4, 5, 6)
#: Common words by which a text's language is guessed; 0 stands for any other.
COMMON = {
    1: "the of and to in that is was for with on are as be at by from or not this have it",
    2: "der die und das ist den von zu mit sich auf für nicht ein eine dem des im auch es an als",
    3: "le la les des et du un une que qui dans pour pas au sur est par plus avec elle il ne",
    4: "el los las y que en una por con para su al lo se como más pero sus o este no es",
}
LANGUAGES = max(COMMON) + 1
_EDGE = b".,;:!?\"'()[]{}<>|*#$%&@~`-_+=/\\"
#: Words whose features one Python worker keeps.
KEPT_WORDS = 300_000


def features(word: bytes) -> list[int]:
    """Embedding rows of a lower-cased word."""
    text = word.decode("utf-8", "replace")
    return [crc32(word) % ROWS] + [crc32(text[:n].encode(), n) % ROWS if len(text) >= n else 0 for n in PREFIXES]


_VOTES: dict[bytes, int] = {}
for _language, _words in COMMON.items():
    for _word in _words.split():  # a word that several languages share votes for none
        _VOTES[_word.encode()] = 0 if _word.encode() in _VOTES else _language


class _Numbering(dict):
    """Numbers words in order of first use."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class Words:
    """Numbers the words of texts, with their features and language votes."""

    def __init__(self, limit: int = KEPT_WORDS):
        self.limit, self.turn = limit, 0
        self.clear()

    def clear(self) -> None:
        self.turn += 1
        # Number 0 is the padding between texts, and a text without words.
        self.number = _Numbering({b"": 0})
        self.rows, self.vote = [[0] * (1 + len(PREFIXES))], [0]

    def read(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of all texts, each followed by padding up to the widest filter, and the words of each (1 at least)."""
        if len(self.number) > self.limit:
            self.clear()
        parts = [t.lower().split() or [b""] for t in texts]
        counts = np.array([len(p) for p in parts], np.int64)
        flat = np.fromiter(map(self.number.__getitem__, chain.from_iterable(parts)), np.int64, int(counts.sum()))
        for raw in list(islice(reversed(self.number), len(self.number) - len(self.rows)))[::-1]:
            word = raw.strip(_EDGE)
            self.rows.append(features(word))
            self.vote.append(_VOTES.get(word, 0))
        pad = max(WIDTHS) - 1
        words = np.zeros(len(flat) + pad * len(texts), np.int64)
        words[np.arange(len(flat)) + pad * np.repeat(np.arange(len(texts)), counts)] = flat
        return words, counts


class Model:
    """Filters, logistic layer and thresholds; ``scores`` reads any texts."""

    def __init__(self, seed: int = 7):
        draw = np.random.default_rng(seed)
        self.embed = (draw.normal(size=(ROWS, SIZE)) * 0.1).astype(np.float32)
        self.embed[0] = 0
        self.filters = [(draw.normal(size=(w, SIZE, FILTERS)) / np.sqrt(w * SIZE)).astype(np.float32) for w in WIDTHS]
        self.bias = np.zeros((len(WIDTHS), FILTERS), np.float32)
        self.out = (draw.normal(size=len(WIDTHS) * FILTERS) * 0.3).astype(np.float32)
        self.shift = np.float32(0)
        self.thresholds = np.full(LANGUAGES, 0.5)

    def to_bytes(self) -> bytes:
        held = io.BytesIO()
        np.savez(held, embed=self.embed, bias=self.bias, out=self.out, shift=self.shift, thresholds=self.thresholds, **{f"filter{i}": f for i, f in enumerate(self.filters)})
        return held.getvalue()

    @staticmethod
    def from_bytes(data: bytes) -> "Model":
        model, held = Model.__new__(Model), np.load(io.BytesIO(data))
        model.embed, model.bias, model.out, model.shift, model.thresholds = (held[k] for k in ("embed", "bias", "out", "shift", "thresholds"))
        model.filters = [held[f"filter{i}"] for i in range(len(WIDTHS))]
        return model

    def _maps(self, x: np.ndarray) -> np.ndarray:
        """Filter responses at every word: word, width, filter."""
        n = len(x) - max(WIDTHS) + 1
        all_parts = x @ np.concatenate([f[j] for f in self.filters for j in range(len(f))], 1)
        out, column = np.empty((n, len(WIDTHS), FILTERS), np.float32), 0
        for i, w in enumerate(WIDTHS):
            out[:, i] = all_parts[:n, column:column + FILTERS] + self.bias[i]
            for j in range(1, w):
                out[:, i] += all_parts[j:n + j, column + j * FILTERS:column + (j + 1) * FILTERS]
            column += w * FILTERS
        return out

    def raw(self, x: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Probabilities of texts whose embedded words, with padding, are the rows of ``x``."""
        starts = np.cumsum(counts + max(WIDTHS) - 1) - counts - max(WIDTHS) + 1
        ranges = np.stack((starts, starts + counts), 1).ravel()
        maps = self._maps(x).reshape(-1, len(WIDTHS) * FILTERS)
        pooled = np.maximum.reduceat(np.concatenate((maps, np.zeros((1, maps.shape[1]), np.float32))), ranges, axis=0)[::2]
        return _sigmoid(np.maximum(pooled, 0) @ self.out + self.shift)

    def step(self, words: np.ndarray, rows: np.ndarray, counts: np.ndarray, labels: np.ndarray, weights: np.ndarray, state: dict, rate: float) -> None:
        """One pass of gradients over a batch: Adagrad on every parameter."""
        x = self.embed[rows].sum(1)[words]
        maps, starts = self._maps(x), np.cumsum(counts + max(WIDTHS) - 1) - counts - max(WIDTHS) + 1
        at = np.array([a + maps[a:a + n].argmax(0) for a, n in zip(starts, counts)])  # text, width, filter
        pooled = maps[at, np.arange(len(WIDTHS))[:, None], np.arange(FILTERS)]
        hidden = np.maximum(pooled, 0).reshape(len(counts), -1)
        slope = (_sigmoid(hidden @ self.out + self.shift) - labels) * weights / len(counts)
        grads = {"out": hidden.T @ slope, "shift": slope.sum()}
        back = (slope[:, None] * self.out).reshape(pooled.shape) * (pooled > 0)
        grads["bias"] = back.sum(0)
        dx_at, dx = [], []
        for i, w in enumerate(WIDTHS):
            grads[f"filter{i}"] = np.stack([np.einsum("tfd,tf->df", x[at[:, i] + j], back[:, i]) for j in range(w)])
            for j in range(w):
                dx_at.append((at[:, i] + j).ravel())
                dx.append((back[:, i][:, :, None] * self.filters[i][j].T[None]).reshape(-1, SIZE))
        where, gradient = words[np.concatenate(dx_at)], np.concatenate(dx)
        moved = np.any(gradient != 0, 1) & (where > 0)
        spots = rows[where[moved]]
        touched, inverse = np.unique(spots.ravel(), return_inverse=True)
        total = np.zeros((len(touched), SIZE), np.float32)
        np.add.at(total, inverse, np.repeat(gradient[moved], spots.shape[1], 0))
        sums = state.setdefault("embed", np.full((ROWS, 1), 1e-6, np.float32))
        sums[touched] += (total ** 2).mean(1, keepdims=True)
        keep = touched > 0
        self.embed[touched[keep]] -= (rate * total / np.sqrt(sums[touched]))[keep]
        for name, g in grads.items():
            sums = state[name] = state.get(name, 1e-6) + g ** 2
            change = (rate * g / np.sqrt(sums)).astype(np.float32)
            if name.startswith("filter"):
                self.filters[int(name[6:])] -= change
            else:
                setattr(self, name, getattr(self, name) - change)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def languages(vote: np.ndarray, words: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The language most common words speak for, of each text; 0 if none does."""
    text = np.repeat(np.arange(len(counts)), counts + max(WIDTHS) - 1)
    votes = np.bincount(text * LANGUAGES + vote[words], minlength=len(counts) * LANGUAGES).reshape(-1, LANGUAGES)
    votes[:, 0] = 0
    return votes.argmax(1)


def train(texts: list[bytes], labels: np.ndarray, passes: int = PASSES, seed: int = 7) -> Model:
    """Weights from labelled texts; the thresholds stay at 0.5."""
    model, draw = Model(seed), np.random.default_rng(seed)
    positive = int(labels.sum())
    if positive in (0, len(labels)):  # one class only
        model.out[:], model.shift = 0, np.float32(-3 if positive == 0 else 3)
        return model
    book = Words(1 << 62)
    words, counts = book.read(texts)
    rows = np.array(book.rows)
    ends = np.cumsum(counts + max(WIDTHS) - 1)
    parts = np.split(words, ends[:-1])
    weights = np.where(labels > 0, 0.5 * len(labels) / positive, 0.5 * len(labels) / (len(labels) - positive))
    state: dict = {}
    for turn in range(passes):
        order = draw.permutation(len(labels))
        for first in range(0, len(order), BATCH):
            some = order[first:first + BATCH]
            joined = np.concatenate([parts[i] for i in some])
            # Words are left out at random, so that no single rare word stands for a text.
            joined = np.where(draw.random(len(joined)) < 0.1, 0, joined)
            model.step(joined, rows, counts[some], labels[some], weights[some], state, 0.1 / (1 + turn))
    return model


def thresholds(bins: list) -> np.ndarray:
    """A threshold for each language from bins of scores (seen, language, label, n, low, high) of all labelled rows."""
    def enough(some: list) -> bool:
        return min(sum(b["n"] for b in some if b["label"] == y) for y in (0, 1)) >= ENOUGH

    judge = [b for b in bins if not b["seen"]]
    judge = judge if enough(judge) else bins
    common = _threshold(judge)
    of = [[b for b in judge if b["language"] == language] for language in range(LANGUAGES)]
    return np.array([_threshold(own) if enough(own) else common for own in of])


def _threshold(bins: list) -> float:
    """The middle of the widest cut of best F1, within 0.05 and 0.95."""
    merged: dict[int, list] = {}
    for b in bins:  # rows, toxic rows, smallest and largest score of a bin
        held = merged.setdefault(b["bin"], [0, 0, 1.0, 0.0])
        merged[b["bin"]] = [held[0] + b["n"], held[1] + b["n"] * b["label"], min(held[2], b["low"]), max(held[3], b["high"])]
    n, toxic, low, high = np.array([merged[k] for k in sorted(merged, reverse=True)], float).reshape(-1, 4).T
    if not toxic.sum():
        return 0.5
    quality = 2 * np.cumsum(toxic) / (np.cumsum(n) + toxic.sum())
    below = np.append(high[1:], 0.0)
    best = np.flatnonzero(quality >= quality.max() - 1e-9)
    at = best[np.argmax(low[best] - below[best])]
    return float(np.clip((low[at] + below[at]) / 2, 0.05, 0.95))


class Scorer:
    """A model with the words met by one Python worker."""

    def __init__(self, model: Model):
        claim("toxicity")
        self.model, self.book = model, Words()
        self.known, self.vectors, self.turn = 0, np.zeros((0, SIZE), np.float32), self.book.turn

    def raw(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities and guessed languages."""
        words, counts = self.book.read(texts)
        if self.book.turn != self.turn:  # the book has begun anew
            self.known, self.vectors, self.turn = 0, self.vectors[:0], self.book.turn
        new = np.array(self.book.rows[self.known:]).reshape(-1, 1 + len(PREFIXES))
        need = len(self.book.rows)
        if need > len(self.vectors):
            self.vectors = np.concatenate((self.vectors, np.zeros((max(need, 2 * len(self.vectors)) - len(self.vectors), SIZE), np.float32)))
        self.vectors[self.known:need] = self.model.embed[new].sum(1)
        self.book.rows[self.known:] = [None] * (need - self.known)  # the vectors stand for them
        self.known = need
        return self.model.raw(self.vectors[words], counts).astype(float), languages(np.array(self.book.vote, np.int64), words, counts)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        raw, language = self.raw(texts)
        limit = self.model.thresholds[language]
        return np.where(raw < limit, 0.5 * raw / limit, 0.5 + 0.5 * (raw - limit) / (1 - limit))


def held_out(column: str = "doc_id") -> Column:
    """The documents that no label is learned from."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def _learn(docs: DataFrame, labels: DataFrame, label: str, positives: int, negatives: int, column: str) -> tuple[Model, np.ndarray, DataFrame | None]:
    """Weights from a bounded sample, sorted hashes of its texts, and all learnable labels (none if there is nothing to calibrate)."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).alias("label"))
    known = written(known.join(docs.filter(~held_out()).select("doc_id"), "doc_id", "left_semi").withColumn("h", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))), "labelled")
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    none = np.zeros(0, np.int64)
    # A fifth of the labels is left to the thresholds, unless a class has too few.
    spare = min(counts.get(y, 0) for y in (0, 1)) >= ENOUGH * FOLDS
    own = known.filter(F.pmod(F.xxhash64("doc_id", F.lit("threshold")), F.lit(FOLDS)) > 0) if spare else known
    # Three times the bound by hash, then exactly the bound: only keys of the sample meet, and texts of the sample alone are read on.
    some = [own.filter((F.col("label") == y) & (F.col("h") < int((1 << 30) * min(1.0, 3 * n / counts[y])))).orderBy("h", "doc_id").limit(n)
            for y, n in ((1, positives), (0, negatives)) if counts.get(y)]
    if not some:
        return train([], np.zeros(0, np.float32)), none, None
    keys = written(reduce(DataFrame.unionByName, some).select("doc_id", "label"), "sample")
    sample = docs.select("doc_id", text_bytes(column).alias("content")).join(F.broadcast(keys), "doc_id").select("content", "label")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("toxicity")
        held = sorted((r["content"], r["label"]) for b in batches for r in b.to_pylist())
        model = train([t for t, _ in held], np.array([y for _, y in held], np.float32))
        yield pa.RecordBatch.from_arrays([pa.array([model.to_bytes()], pa.binary()), pa.array([_hashes([t for t, _ in held]).tobytes()], pa.binary())], names=["model", "seen"])

    # The sample has a fixed bound, and so have its keys, which are broadcast, and the model.
    got = sample.repartition(1).mapInArrow(run, "model binary, seen binary").first()
    return Model.from_bytes(got["model"]), np.unique(np.frombuffer(got["seen"], np.int64)), known if len(counts) == 2 else None


def _hashes(texts: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(t) for t in texts], np.uint64).view(np.int64)


def _raw_scores(docs: DataFrame, model: Model, seen: np.ndarray, column: str, keep: tuple[str, ...]) -> DataFrame:
    """``keep``, _id, _raw, _language, and _seen (the text was trained on) of every row. Stored; no texts."""
    shared = docs.sparkSession.sparkContext.broadcast((model.to_bytes(), seen))
    given = docs.select(*keep, F.col("doc_id").alias("_id"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema.fields] + ["_raw double, _language int, _seen boolean"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data, trained = shared.value
        scorer = Scorer(Model.from_bytes(data))
        for batch in batches:
            for first, group in text_groups(batch.column(batch.num_columns - 1).to_pylist(), 1 << 20):
                part, (raw, language) = batch.slice(first, len(group)), scorer.raw(group)
                found = [*part.columns[:-1], pa.array(raw, pa.float64()), pa.array(language, pa.int32()), pa.array(np.isin(_hashes(group), trained))]
                yield pa.RecordBatch.from_arrays(found, names=[*part.schema.names[:-1], "_raw", "_language", "_seen"])

    return written(docs.select(*keep, F.col("doc_id").alias("_id"), text_bytes(column).alias("_content")).mapInArrow(run, schema), "raw-scores")


def _calibrated(raw: DataFrame, known: DataFrame) -> np.ndarray:
    """Thresholds from the scores of all labelled rows; at most ``BINS`` bins of each language and label come to the driver."""
    met = raw.filter(~held_out("_id")).join(known.select(F.col("doc_id").alias("_id"), "label"), "_id")
    place = F.least(F.floor(F.col("_raw") * BINS), F.lit(BINS - 1)).alias("bin")
    bins = met.groupBy(F.col("_seen").alias("seen"), F.col("_language").alias("language"), "label", place)
    return thresholds(bins.agg(F.count("*").alias("n"), F.min("_raw").alias("low"), F.max("_raw").alias("high")).collect())


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", positives: int = POSITIVES, negatives: int = NEGATIVES, column: str = "text") -> bytes:
    """A model from the labelled rows that are not held out: weights from a bounded sample, thresholds from all of them."""
    model, seen, known = _learn(docs, labels, label, positives, negatives, column)
    if known is not None:
        model.thresholds = _calibrated(_raw_scores(docs.filter(~held_out()), model, seen, column, ()), known)
    return model.to_bytes()


def score(docs: DataFrame, model: bytes, column: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    given = docs.select(*keep)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema.fields] + ["score double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(Model.from_bytes(shared.value))
        for batch in batches:
            for first, group in text_groups(batch.column(batch.num_columns - 1).to_pylist(), 1 << 20):
                part = batch.slice(first, len(group))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(scorer.scores(group), pa.float64())], names=[*part.schema.names[:-1], "score"])

    return docs.select(*keep, text_bytes(column).alias("_content")).mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, column: str = "text", keep: tuple[str, ...] = ("doc_id",), label: str = "toxic", positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """``keep``, score and predicted (1 from 0.5 on) of every row. Texts are scored once, for thresholds and result alike."""
    model, seen, known = _learn(docs, labels, label, positives, negatives, column)
    if known is None:
        scored = score(docs, model.to_bytes(), column, keep)
    else:
        scored = _raw_scores(docs, model, seen, column, keep)
        raw, limit = F.col("_raw"), F.element_at(F.array(*[F.lit(float(x)) for x in _calibrated(scored, known)]), F.col("_language") + 1)
        scored = scored.select(*keep, F.when(raw < limit, 0.5 * raw / limit).otherwise(0.5 + 0.5 * (raw - limit) / (1 - limit)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def without_toxic(docs: DataFrame, model: bytes, column: str = "text") -> DataFrame:
    """The rows, with all their columns, whose score stays below 0.5."""
    shared, place = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(Model.from_bytes(shared.value))
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column(place).to_pylist()]
            for first, group in text_groups(texts, 1 << 20):
                yield batch.slice(first, len(group)).filter(pa.array(scorer.scores(group) < 0.5))

    return docs.mapInArrow(run, docs.schema)
