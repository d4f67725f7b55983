"""Near duplicates by bottom-k sketches of one hash function, inverted lists, and exact checks.

A document's set holds its distinct shingles of ``words`` words (A-Z lower-cased, split at ASCII white space), hashed to
63 bits; its sketch holds the ``k`` smallest. Documents with equal sets form a class, and only classes are compared.

*Inverted lists.* Of the k smallest shingles of a union, a linked pair (Jaccard 0.75 or more) shares ``least`` = 50 of 96
but for a chance of about 1e-6 at exactly 0.75, and less above; sets small enough that both sketches are whole sets share
three quarters for certain. So a class enters the lists of its size - least + 1 rarest retained values only (rare by the
number of classes that retain a value): two classes that share ``least`` values meet in one of these lists, while a
passage that a third of all documents share is not listed unless it is most of the document. The classes listed are listed
again by their full sets, of which linked pairs share three quarters for certain: what stays has hardly a quarter of
shingles of its own.

*Roles.* Two linked sets share three sevenths of their sizes' sum, so the smaller set shares six sevenths of itself and the
larger three quarters. The first value they share, rare ones first, hence stands among the smaller set's first
``shared - ceil(6/7 n) + 1`` values and among the larger one's first ``shared - ceil(3/4 n) + 1``, where ``shared`` counts the
values that some other class has too. A list holds the classes of both roles, and only those that have it in the first,
short part are compared with the others.

*Leaders.* First every class is compared with the leaders of its lists, one per list and size band (two seeds), and the
components of the links found are labelled. Most lists then lie in one component and are done.

*Open lists.* Pairs of a list of up to ``SMALL`` classes in different components go on if their sizes and the places of the
value leave room for enough shared values. A longer list is compared inside tasks, block by block, with the full sets: a
task returns a spanning forest of the links it finds between components, never pairs that aren't linked, so a group of
thousands of near misses costs products of bit rows and no rows. Every pair of a list is compared, or already connected.

*Estimates and exact check.* Pairs (of leaders and of short lists) whose union sketch shares fewer than ``least`` values are
out; the full sets of the others are compared, and 100 * intersection >= 75 * union links them.

Defined cases: null, empty or blank texts have no shingles and are linked with nothing; a text of fewer words is one
shingle. Repeated rows are one class. A null doc_id belongs to its class but never names it. An empty table gives no
rows. Other columns are ignored. Texts are read whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import KEPT, claim, fresh_folder, removed, settled, text_bytes, text_key, written
from docloom.llm.components import components

#: Shingle length, retained values, and retained values that a linked pair shares.
WORDS, K, LEAST = 5, 96, 50
#: Link threshold in percent.
PERCENT = 75
#: Seeds for list leaders; classes of a list that is joined with itself; classes and bytes of a block; pairs of a class that one task checks.
SEEDS, SMALL, BLOCK, BLOCK_BYTES, GROUP = 2, 32, 2048, 16 << 20, 128
#: Words whose hashes one Python worker keeps.
KEPT_WORDS = 500_000
SKETCHES = "doc_id long, text_hash long, n_shingles long, digest binary, sketch array<long>"

_FACTOR = np.uint64(0x9E3779B97F4A7C15)


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = _WordHash()
KEPT["bottom_k"] = _hashes.clear


def shingle_set(text: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 63-bit hashes of a text's shingles."""
    if len(_hashes) > KEPT_WORDS:
        _hashes.clear()
    parts = text.lower().split()
    each = np.fromiter(map(_hashes.__getitem__, parts), np.uint64, len(parts))
    if not len(each):
        return np.zeros(0, np.uint64)
    n = min(words, len(each))
    value = np.full(len(each) - n + 1, n, np.uint64)
    for i in range(n):
        value = (value ^ each[i:len(each) - n + 1 + i]) * _FACTOR
        value ^= value >> np.uint64(29)
    value = (value ^ value >> np.uint64(32)) * _FACTOR
    return np.unique(value >> np.uint64(1))


def sketches(docs: DataFrame, words: int = WORDS, k: int = K, column: str = "text") -> DataFrame:
    """doc_id, text_hash, n_shingles, digest of the set, and the k smallest hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("bottom_k")
        for batch in batches:
            sets = [shingle_set(t.as_py(), words) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                 pa.array([s[:k].astype(np.int64) for s in sets], pa.list_(pa.int64()))], names=["doc_id", "text_hash", "n_shingles", "digest", "sketch"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(column).alias("text_hash"), text_bytes(column).alias("content")).mapInArrow(run, SKETCHES)


def least_shared(n: Column, k: int = K, least: int = LEAST) -> Column:
    """Retained values that a class of n shingles shares with any linked class."""
    return F.when(n * 4 <= 3 * k, F.ceil(n * PERCENT / 100)).otherwise(least).cast("int")


def band(n: Column) -> Column:
    """Linked sets are in the same band of sizes or in neighbouring ones."""
    return F.floor(F.log(n.cast("double")) / math.log(100 / PERCENT) + 1e-9).cast("int")


def inverted_lists(classes: DataFrame, k: int = K, least: int = LEAST) -> DataFrame:
    """value, digest, n_shingles: each class under its rarest retained values, where another class retains them."""
    postings = classes.select("digest", "n_shingles", F.size("sketch").alias("size"), F.explode("sketch").alias("value"))
    shared = postings.groupBy("value").agg(F.count("*").alias("classes")).filter("classes > 1")
    per_class = postings.join(shared, "value").groupBy("digest", "n_shingles", "size").agg(F.sort_array(F.collect_list(F.struct("classes", "value"))).alias("values"))
    alone = F.col("size") - F.size("values")
    take = F.col("size") - least_shared(F.col("n_shingles"), k, least) + 1 - alone
    return per_class.filter(take > 0).select("digest", "n_shingles", F.explode(F.slice("values", F.lit(1), take)).alias("v")).select("v.value", "digest", "n_shingles")


def role_lists(sets: DataFrame) -> DataFrame:
    """value, digest, n_shingles, shared, place (from 0) and first: full sets under the values that a linked class may share first."""
    postings = sets.select("digest", F.size("shingles").cast("long").alias("n_shingles"), F.explode("shingles").alias("value"))
    often = postings.groupBy("value").agg(F.count("*").alias("classes")).filter("classes > 1")
    rare_first = postings.join(often, "value").groupBy("digest", "n_shingles").agg(F.sort_array(F.collect_list(F.struct("classes", "value"))).alias("values"))
    roles = rare_first.withColumn("shared", F.size("values")).withColumns({
        "small": F.expr("shared - cast((6 * n_shingles + 6) div 7 as int) + 1"), "large": F.expr(f"shared - cast(({PERCENT} * n_shingles + 99) div 100 as int) + 1")})
    rows = roles.filter("large > 0").select("digest", "n_shingles", "shared", "small", F.posexplode(F.slice("values", F.lit(1), F.col("large"))).alias("place", "v"))
    rows = rows.select("v.value", "digest", "n_shingles", "shared", "place", (F.col("place") < F.col("small")).alias("first"))
    useful = rows.groupBy("value").agg(F.count("*").alias("n"), F.max("first").alias("any_first")).filter("n > 1 and any_first").select("value")
    return rows.join(useful, "value", "left_semi")


def leader_pairs(lists: DataFrame, seeds: tuple[int, ...] = tuple(range(SEEDS))) -> DataFrame:
    """Distinct (a, b): the leader of a list's size band, and each class of the list in that band or the one above."""
    seeded = lists.select("value", "digest", band(F.col("n_shingles")).alias("band"), F.explode(F.array(*[F.lit(x) for x in seeds])).alias("seed"))
    leaders = seeded.groupBy("value", "band", "seed").agg(F.min_by("digest", F.xxhash64("digest", "seed")).alias("a"))
    near = seeded.select("value", "seed", F.col("digest").alias("b"), F.explode(F.array(F.col("band"), F.col("band") - 1)).alias("band"))
    return near.join(leaders, ["value", "band", "seed"]).filter("a <> b").select("a", "b").distinct()


def union_shares(a: pa.ListArray, b: pa.ListArray, k: int = K) -> np.ndarray:
    """Per pair of sketches: how many of the k smallest values of their union both hold."""
    most = np.iinfo(np.int64).max

    def padded(lists: pa.ListArray) -> np.ndarray:
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
        out = np.full((len(lists), k), most)
        out[np.arange(k) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
        return out

    both = np.sort(np.concatenate((padded(a), padded(b)), 1), axis=1)
    again = (both[:, 1:] == both[:, :-1]) & (both[:, 1:] != most)
    rank = 1 + np.cumsum(~again, axis=1)  # of a value among the distinct ones
    return (again & (rank <= k)).sum(1)


def estimated(pairs: DataFrame, classes: DataFrame, k: int = K, least: int = LEAST) -> DataFrame:
    """Pairs (a, b) whose sizes allow a link and whose union sketch shares enough."""
    side = lambda x: classes.select(F.col("digest").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}"))
    met = pairs.join(side("a"), "a").join(side("b"), "b").filter("100 * least(n_a, n_b) >= 75 * greatest(n_a, n_b)")
    need = F.greatest(*[least_shared(F.col(n), k, least) for n in ("n_a", "n_b")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, len(batch), 4096):
                part = batch.slice(first, 4096)
                good = pa.array(union_shares(part.column(3), part.column(4), k) >= part.column(2).to_numpy())
                yield pa.RecordBatch.from_arrays([part.column(0).filter(good), part.column(1).filter(good)], names=["a", "b"])

    return met.select("a", "b", need.alias("need"), "s_a", "s_b").mapInArrow(run, "a binary, b binary")


def class_sets(docs: DataFrame, classes: DataFrame, lists: DataFrame, words: int = WORDS, column: str = "text") -> DataFrame:
    """digest and full set (sorted) of every class that a list holds."""
    wanted = written(lists.select("digest").distinct().join(classes.select("digest", "member"), "digest"), "listed")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = set()
        for batch in batches:
            digests, sets = [], []
            for digest, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                if digest in done:  # copies without a doc_id share their hash
                    continue
                own = shingle_set(content.as_py(), words)
                if xxhash.xxh3_128_digest(own.tobytes()) == digest:  # rows may share a doc_id
                    done.add(digest)
                    digests.append(digest)
                    sets.append(own.astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(sets, pa.list_(pa.int64()))], names=["digest", "shingles"])

    # Listed classes are a part of all classes: both sides are dealt by key, at every size.
    # A row without doc_id is found by the hash of its text; the digest tells should another row have that as its doc_id.
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), text_key(column)).alias("member"), text_bytes(column).alias("content"))
    return texts.join(wanted.hint("merge"), "member").select("digest", "content").mapInArrow(run, "digest binary, shingles array<long>")


def exact_links(pairs: DataFrame, sets: DataFrame, group: int = GROUP) -> DataFrame:
    """Pairs (a, b) whose full sets are linked. A set travels once per group of partners."""
    pairs = written(pairs, "pairs")
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / F.lit(group)).cast("int").alias("parts"))
    grouped = written(pairs.join(parts, "a").withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int")), "grouped")
    wanted = grouped.select("a", "part", F.col("b").alias("digest")).unionByName(grouped.select("a", "part", F.col("a").alias("digest")).distinct())

    def run(key, table):
        a = key[0].as_py()
        sets = {d: x.values.to_numpy() for d, x in zip(table.column("digest").to_pylist(), table.column("shingles"))}
        mine, links = sets[a], []
        for digest, s in sets.items():
            if digest != a:
                at = np.minimum(np.searchsorted(mine, s), len(mine) - 1)
                both = int((mine[at] == s).sum())
                if 100 * both >= PERCENT * (len(mine) + len(s) - both):
                    links.append(digest)
        return pa.table({"a": pa.array([a] * len(links), pa.binary()), "b": pa.array(links, pa.binary())})

    return wanted.join(sets.hint("merge"), "digest").select("a", "part", "digest", "shingles").groupBy("a", "part").applyInArrow(run, "a binary, b binary")


def open_lists(lists: DataFrame, labels: DataFrame, small: int = SMALL, block: int = BLOCK, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of lists that lie in several components, with their component and the list's number of blocks (0: a short list)."""
    rows = lists.join(labels.withColumnRenamed("node", "digest"), "digest", "left").withColumn("component", F.coalesce("component", "digest"))
    totals = rows.groupBy("value").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n"), F.sum(8 * F.col("n_shingles")).alias("bytes"), F.max("first").alias("any_first"))
    blocks = F.when(F.col("n") <= small, 0).otherwise(F.greatest(F.ceil(F.col("n") / F.lit(block)), F.ceil(F.col("bytes") / F.lit(block_bytes)))).cast("int")
    return rows.join(totals.filter("low <> high and any_first").select("value", blocks.alias("blocks")), "value")


def short_pairs(rows: DataFrame) -> DataFrame:
    """Distinct (a, b) of short lists: other components, sizes and places that leave room for a link, the smaller with the value first."""
    few = rows.filter("blocks = 0")
    left, right = (few.select("value", F.col("digest").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("component", "n_shingles", "shared", "place", "first")]) for x in "ab")
    smaller = "(n_shingles_a < n_shingles_b or n_shingles_a = n_shingles_b and a < b)"
    room = "7 * least(shared_a - place_a, shared_b - place_b) >= 3 * (n_shingles_a + n_shingles_b)"
    met = left.filter("first_a").join(right, "value").filter(f"component_a <> component_b and {smaller} and 100 * n_shingles_a >= {PERCENT} * n_shingles_b and {room}")
    return met.select("a", "b").distinct()


def _forest(left: np.ndarray, right: np.ndarray, label: np.ndarray) -> list[int]:
    """Which of the links (pairs of rows) join labels that those before don't."""
    parent = list(range(int(label.max()) + 1))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for k, (x, y) in enumerate(zip(label[left].tolist(), label[right].tolist())):
        x, y = root(x), root(y)
        if x != y:
            parent[x] = y
            out.append(k)
    return out


def linked_rows(sets: list[np.ndarray], n: np.ndarray, first: np.ndarray, label: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of different labels whose sets of n values are linked, one of them with ``first``; exact, by products of bit rows."""
    size = np.array([len(s) for s in sets])
    _, code, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row, use = np.repeat(np.arange(len(sets)), size), times[code] > 1
    slot = (np.cumsum(times > 1) - 1)[code[use]]
    order = np.argsort(slot, kind="stable")
    row, slot = row[use][order], slot[order]
    probes = np.flatnonzero(first)
    if not len(probes):
        return probes, probes
    common = np.zeros((len(probes), len(sets)), np.float32)
    for start in range(0, int((times > 1).sum()), 1024):
        a, b = np.searchsorted(slot, (start, start + 1024))
        bits = np.zeros((len(sets), 1024), np.float32)
        bits[row[a:b], slot[a:b] - start] = 1
        common += bits[probes] @ bits.T
    pairs = []
    for start in range(0, len(probes), 256):
        own = probes[start:start + 256]
        part = common[start:start + 256]
        left, right = np.nonzero((100 * part >= percent * (n[own][:, None] + n - part)) & (label[own][:, None] != label))
        pairs.append((own[left], right))
    return np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])


def long_list_links(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): a spanning forest of the links between components that each block of a long list holds."""
    many = rows.filter("blocks > 0").withColumn("i", F.pmod(F.xxhash64("digest", "value"), F.col("blocks")).cast("int"))
    placed = many.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "value", F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"), F.col("i").alias("mine"), "first", "n_shingles", "digest", "component")

    def run(key, table):
        digest, n, first = table.column("digest").to_pylist(), np.array(table.column("n_shingles").to_pylist()), np.array(table.column("first").to_pylist())
        mine = np.array(table.column("mine").to_pylist())
        label = np.unique([c.hex() for c in table.column("component").to_pylist()], return_inverse=True)[1]
        left, right = linked_rows([x.values.to_numpy() for x in table.column("shingles")], n, first, label)
        if key[1].as_py() != key[2].as_py():  # pairs inside a block are another task's
            apart = mine[left] != mine[right]
            left, right = left[apart], right[apart]
        keep = _forest(left, right, label) if len(left) else []
        return pa.table({"a": pa.array([digest[left[k]] for k in keep], pa.binary()), "b": pa.array([digest[right[k]] for k in keep], pa.binary())})

    return placed.join(sets.hint("merge"), "digest").groupBy("value", "i", "j").applyInArrow(run, "a binary, b binary")


def near_duplicates(docs: DataFrame, words: int = WORDS, k: int = K, least: int = LEAST, column: str = "text") -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id and kept of every document."""
    spark, path = docs.sparkSession, fresh_folder(docs.sparkSession, "sketches")
    sketches(docs, words, k, column).write.parquet(path)
    rows = spark.read.schema(SKETCHES).parquet(path)
    classes = written(rows.filter("n_shingles > 0").groupBy("digest", "n_shingles").agg(F.min("doc_id").alias("class_id"), F.coalesce(F.max("doc_id"), F.max("text_hash")).alias("member"), F.first("sketch").alias("sketch")), "classes")
    rows = written(rows.drop("sketch"), "documents")
    removed(spark, path)
    lists = written(inverted_lists(classes, k, least), "sketch-lists")
    settled(spark)
    sets = written(class_sets(docs, classes, lists, words, column).dropDuplicates(["digest"]), "sets")
    lists = written(role_lists(sets), "full-lists")
    settled(spark)
    links = written(exact_links(estimated(leader_pairs(lists), classes, k, least), sets), "links")
    settled(spark)
    labels = components(links)
    rest = written(open_lists(lists, labels), "open-lists")
    settled(spark)
    if not rest.isEmpty():
        more = written(exact_links(estimated(short_pairs(rest), classes, k, least), sets).unionByName(long_list_links(rest, sets)), "last-links")
        if not more.isEmpty():
            labels = components(links.unionByName(more))
    labelled = classes.select("digest", "class_id").join(labels.withColumnRenamed("node", "digest"), "digest", "left").withColumn("component", F.coalesce("component", "digest"))
    names = labelled.groupBy("component").agg(F.min("class_id").alias("component_id"))
    of_class = written(labelled.join(names, "component").select("digest", "component_id"), "class-components")
    out = rows.join(of_class, "digest", "left").withColumn("component_id", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
    return out.select("doc_id", "text_hash", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
