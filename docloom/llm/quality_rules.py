"""Quality rules whose thresholds follow each language and source, from mergeable quantile sketches.

*Measures.* Every whole text gives its words (split at ASCII white space), their code points, symbols ``#*$%&|<>``,
repeated lines and words inside 8-word windows that the text holds twice or more (exact: windows are numbered by doubling,
no hash decides). Ratios of these, in thousandths, are what the rules look at.

*Sketch.* A value falls into one of ``2 ** BITS`` equal parts of its power of two (values below that are exact), so the
middle of a part is off by less than a hundredth. A sketch is the table (lang, source, measure, part, rows); sketches of
other runs or days merge by adding rows, in any order, with the same result (``merged``). Sources that hold a third of
all rows are counted before the shuffle and are a few hundred rows after it.

*Thresholds.* Quartiles of a source are drawn towards those of its language, and these towards those of all rows, with the
weight of ``PRIOR`` rows, so a source of three documents has thresholds too and no size switches the rule. A measure may
lie ``REACH`` spreads outside the quartiles; a spread is the distance of the quartiles, ``least`` at least. Rows that fail
the fixed base rule are not sketched. Then documents and thresholds are joined.

Defined cases: null, empty and blank texts have no words, fail the base rule and are not kept. A null lang or source is a
language or source of its own. Repeated rows and repeated doc_ids are rows of their own; a null doc_id stays null. Very
long texts are measured whole, one at a time. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import text_bytes, written

#: Words of a repeated window, and the fixed base rule: least words, and most repeated words in percent.
WINDOW, LEAST_WORDS, MOST_REPEATED = 8, 20, 30
SYMBOLS = b"#*$%&|<>"
#: Parts of a power of two (as bits), rows that the wider group weighs, spreads beyond the quartiles.
BITS, PRIOR, REACH = 8, 100, 3
#: Least spread of each measure, in thousandths, and whether small values fail as well.
MEASURES = {"word_length": (200, True), "symbols": (50, False), "dup_lines": (100, False), "repeat_words": (100, False)}
QUARTILES = {"low": 0.25, "high": 0.75}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of so many words found twice or more."""
    n = len(words)
    if n <= window:
        return 0
    numbers: dict[bytes, int] = {}
    code = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    if len(numbers) > n - window:  # fewer repeats than a second window needs
        return 0
    width = 1
    while width < window:  # codes of ``width`` words become codes of up to twice as many
        step = min(width, window - width)
        pair = code[:len(code) - step] * (int(code.max()) + 1) + code[step:]
        code = np.unique(pair, return_inverse=True)[1]
        width += step
    twice = np.bincount(code)[code] > 1
    if not twice.any():
        return 0
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, np.flatnonzero(twice), 1)
    np.add.at(cover, np.flatnonzero(twice) + window, -1)
    return int((np.cumsum(cover[:n]) > 0).sum())


def counts(text: bytes) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and the number of lines with a word."""
    words = text.split()
    letters = b"".join(words)
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    return (len(words), len(letters.decode("utf-8", "replace")), len(text) - len(text.translate(None, SYMBOLS)), len(lines) - len(set(lines)),
            repeated_words(words), len(lines))


def measured(docs: DataFrame, column: str = "text") -> DataFrame:
    """doc_id, lang, source, the five counts, base_failed, and a column for each of ``MEASURES`` (thousandths)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, len(batch), 256):
                part = batch.slice(first, 256)
                rows = [counts(t.as_py()) for t in part.column(3)]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], *(pa.array([r[i] for r in rows], pa.int64()) for i in range(6))],
                                                 names=["doc_id", "lang", "source", *COUNTS, "n_lines"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), text_bytes(column).alias("content"))
    rows = own.mapInArrow(run, "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in COUNTS) + ", n_lines long")
    share = lambda a, b: F.expr(f"1000 * {a} div greatest({b}, 1)")
    return rows.select("doc_id", "lang", "source", *COUNTS, (F.expr(f"n_words < {LEAST_WORDS} or 100 * n_repeat_words > {MOST_REPEATED} * n_words")).alias("base_failed"),
                       share("word_chars", "n_words").alias("word_length"), share("n_symbols", "n_words").alias("symbols"),
                       share("n_dup_lines", "n_lines").alias("dup_lines"), share("n_repeat_words", "n_words").alias("repeat_words"))


def part_of(value: Column, bits: int = BITS) -> Column:
    """The middle of the sketch part that a value (0 or more) falls into; integers only, so every engine agrees."""
    width = F.lit(1).cast("long") * F.pow(F.lit(2), F.greatest(F.length(F.bin(value)) - F.lit(bits + 1), F.lit(0))).cast("long")
    return F.floor(value / width).cast("long") * width + F.floor(width / 2).cast("long")


def sketch(rows: DataFrame, bits: int = BITS) -> DataFrame:
    """(lang, source, measure, part, rows) of the rows that the base rule keeps."""
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), part_of(F.col(m), bits).alias("part")) for m in MEASURES])).alias("x")
    return rows.filter("not base_failed").select("lang", "source", each).groupBy("lang", "source", "x.measure", "x.part").agg(F.count("*").alias("rows"))


def merged(*sketches: DataFrame) -> DataFrame:
    """One sketch of all rows that the sketches have seen."""
    every = sketches[0]
    for other in sketches[1:]:
        every = every.unionByName(other)
    return every.groupBy("lang", "source", "measure", "part").agg(F.sum("rows").alias("rows"))


def quartiles(parts: DataFrame, keys: list[str]) -> DataFrame:
    """keys, measure, n, low and high: the first part at which so large a share of the rows is reached.

    A group's parts are bounded (2 ** bits for each power of two), so its rows are folded into one list.
    """
    summed = parts.groupBy(*keys, "measure", "part").agg(F.sum("rows").alias("rows"))
    lists = summed.groupBy(*keys, "measure").agg(F.sum("rows").alias("n"), F.sort_array(F.collect_list(F.struct("part", "rows"))).alias("parts"))

    def at(share: float) -> Column:
        step = lambda s, x: F.when(s["seen"] >= F.lit(share) * F.col("n"), s).otherwise(F.struct((s["seen"] + x["rows"]).alias("seen"), x["part"].alias("part")))
        start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(0).cast("long").alias("part"))
        return F.aggregate("parts", start, step, lambda s: s["part"].cast("double"))

    return lists.select(*keys, "measure", "n", *[at(share).alias(name) for name, share in QUARTILES.items()])


def thresholds(parts: DataFrame, prior: int = PRIOR, reach: int = REACH) -> DataFrame:
    """lang, source, measure, floor and ceiling, one row per group and measure."""
    parts = written(parts, "quality-sketch")

    def drawn(own: DataFrame, wider: DataFrame, on: Column) -> DataFrame:
        wider = wider.select(*[F.col(c).alias(f"w_{c}") for c in wider.columns])
        met = own.join(wider, on & (F.col("measure") == F.col("w_measure")))
        blend = lambda c: ((F.col("n") * F.col(c) + F.lit(prior) * F.col(f"w_{c}")) / (F.col("n") + F.lit(prior))).alias(c)
        return met.select(*[blend(c) if c in QUARTILES else F.col(c) for c in own.columns])

    every = quartiles(parts, [])
    langs = drawn(quartiles(parts, ["lang"]), every, F.lit(True))
    groups = drawn(quartiles(parts, ["lang", "source"]), langs, F.col("lang").eqNullSafe(F.col("w_lang")))
    least = F.create_map(*[F.lit(x) for m, (low, _) in MEASURES.items() for x in (m, float(low))])
    both = F.create_map(*[F.lit(x) for m, (_, two) in MEASURES.items() for x in (m, two)])
    spread = F.lit(reach) * F.greatest(F.col("high") - F.col("low"), least[F.col("measure")])
    return groups.select("lang", "source", "measure", F.when(both[F.col("measure")], F.col("low") - spread).alias("floor"), (F.col("high") + spread).alias("ceiling"))


def judged(rows: DataFrame, limits: DataFrame) -> DataFrame:
    """The measured rows with ``failed`` (measures outside their limits, sorted) and ``kept``."""
    wide = limits.groupBy("lang", "source").agg(*[F.max(F.when(F.col("measure") == m, F.struct("floor", "ceiling"))).alias(f"_{m}") for m in MEASURES])
    wide = written(wide.withColumnsRenamed({"lang": "_lang", "source": "_source"}), "quality-limits")
    met = rows.join(wide, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    out = lambda m: F.when((F.col(m) > F.col(f"_{m}")["ceiling"]) | F.coalesce(F.col(m) < F.col(f"_{m}")["floor"], F.lit(False)), F.lit(m))
    failed = F.array_compact(F.array(*[out(m) for m in sorted(MEASURES)]))
    return met.withColumn("failed", failed).withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0)).drop("_lang", "_source", *[f"_{m}" for m in MEASURES])


def quality_rules(docs: DataFrame, column: str = "text", earlier: DataFrame | None = None) -> DataFrame:
    """Every document with its counts, base_failed, failed measures and kept. ``earlier``: a sketch of other rows to count in."""
    rows = written(measured(docs, column), "quality-measures")
    own = sketch(rows)
    return judged(rows, thresholds(own if earlier is None else merged(own, earlier)))
