"""Documents to source units, heading paths, chunks."""

from __future__ import annotations

import re
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.functions.ordering import BLOCK_ROWS, dealt, union_all, with_running
from docloom.functions.text import WS, is_blank, rtrim_ws, sha256_hex, text_length, trim_ws, zero_pad

HEADING = rf"\A{WS}{{0,3}}(#{{1,6}}){WS}+([\s\S]+?){WS}*#*{WS}*\z"
# The same lines as ``HEADING``: what follows the mark may be anything, so only its first character is looked at.
HEADING_MARK = rf"\A{WS}{{0,3}}(#{{1,6}}){WS}"
# Text that may open a block running over several lines; everything else needs no line state.
MAY_OPEN_BLOCK = rf"(?i)(?:\A|\n){WS}*(?:```|~~~|\\\[|\$\$)|<details[\t\n\x0B\f\r >]"
SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start_line", T.IntegerType()),
                                  T.StructField("end_line", T.IntegerType())]))
ANSWERS = T.ArrayType(T.StructType([T.StructField("state", T.StringType()), T.StructField("length", T.IntegerType()), T.StructField("after", T.StringType()),
                                    T.StructField("units", T.IntegerType())]))
PIECES = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("n", T.IntegerType()), T.StructField("a", T.IntegerType()),
                                   T.StructField("b", T.IntegerType())]))


def _line_kind(line: Column) -> Column:
    return (F.when(is_blank(line), "blank").when(line.contains("#") & line.rlike(rf"{HEADING_MARK}[\s\S]"), "heading")
            .when(line.contains("|") & line.rlike(rf"\A{WS}*\|"), "table").otherwise("prose"))


def _plain_spans(kinds: Column) -> Column:
    """Runs of equal line kinds (headings stand alone), found from each line and its neighbours only."""
    edge = F.array(F.lit("blank"))
    before = F.concat(edge, F.slice(kinds, 1, F.size(kinds) - 1))
    after = F.concat(F.slice(kinds, 2, F.size(kinds)), edge)

    def borders(neighbour):
        pairs = F.transform(F.zip_with(kinds, neighbour, lambda k, n: F.struct(k.alias("k"), n.alias("n"))),
                            lambda x, i: F.struct(x["k"].alias("k"), x["n"].alias("n"), (i + 1).alias("line")))
        return F.filter(pairs, lambda x: (x["k"] != "blank") & ((x["k"] == "heading") | (x["k"] != x["n"])))
    return F.zip_with(borders(before), borders(after), lambda s, e: F.struct(
        s["k"].alias("kind"), s["line"].alias("start_line"), e["line"].alias("end_line")))


# --- the line scanner ------------------------------------------------------------------
# Its state before a line is a string: "" (nothing open), "prose" or "table" (the line before belongs to such a run),
# or what opened a block that runs on: a fence as written (its character and length count), "\[", "$$" or "<details".

_SPACE = "\t\n\x0b\f\r \xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
_RE_HEADING = re.compile(rf"[{_SPACE}]{{0,3}}#{{1,6}}[{_SPACE}]+[\s\S]+?[{_SPACE}]*#*[{_SPACE}]*\Z")
_RE_FENCE = re.compile(r"`{3,}|~{3,}")
_RE_DETAILS = re.compile(rf"<details[{_SPACE}>]", re.I)
_RE_DETAILS_END = re.compile(r"</details>", re.I)
BLOCK_KINDS = {"`": "code", "~": "code", "\\": "equation", "$": "equation", "<": "details"}


def _opens(line: str, text: str) -> tuple[str, bool] | None:
    """For a line that opens a block: (state, whether the line closes it too)."""
    if text[0] in "`~":
        fence = _RE_FENCE.match(text)
        if fence:
            return fence[0], False
    elif text.startswith("\\["):
        return "\\[", "\\]" in text
    elif text.startswith("$$"):
        return "$$", text.count("$$") >= 2
    if "<" in text and _RE_DETAILS.search(line):
        return "<details", _RE_DETAILS_END.search(line) is not None
    return None


def _closes(state: str, text: str) -> bool:
    if state[0] in "`~":
        return len(text) >= len(state) and text == state[0] * len(text)
    return "\\]" in text if state == "\\[" else "$$" in text if state == "$$" else _RE_DETAILS_END.search(text) is not None


def _open_run(line: str, text: str, state: str) -> tuple[str | None, str]:
    """(kind, state after) of a line outside blocks that opens none; the kind of a blank line is None."""
    if not text:
        return None, ""
    if text[0] == "|":
        return "table", "table"
    if text[0] == "#" and _RE_HEADING.match(line):
        return "heading", ""
    return "prose", "prose"


def _scan(line: str, state: str) -> tuple[str | None, bool, str]:
    """One step: the line's kind (None for a blank line between units), whether a unit starts here, the state after."""
    text = line.strip(_SPACE)
    if state and state[0] in BLOCK_KINDS:
        return BLOCK_KINDS[state[0]], False, "" if _closes(state, text) else state
    opened = _opens(line, text) if text and not (state == "table" and text[0] == "|") else None
    if opened:
        return BLOCK_KINDS[opened[0][0]], True, "" if opened[1] else opened[0]
    kind, after = _open_run(line, text, state)
    return kind, kind == "heading" or kind != state, after


def _spans_with_blocks(text: str):
    spans, state = [], ""
    for number, line in enumerate(text.split("\n"), 1):
        kind, starts, state = _scan(line, state)
        if kind and starts:
            spans.append({"kind": kind, "start_line": number, "end_line": number})
        elif kind:
            spans[-1]["end_line"] = number
    return spans


def _answers(lines: list[str]) -> list[tuple[str, int, str, int]]:
    """What these lines do for every state before them: (state, length, state after, units that start), in order of precedence.

    A fence of n characters takes the first row of its character with a length of n or more; a state without a row stays as it
    is and starts no unit. One pass from the last line to the first.
    """
    after = {state: (state, 0) for state in ("", "prose", "table")}  # before the line that comes next
    closers: dict[str, list[tuple[int, str, int]]] = {}
    for line in reversed(lines):
        text = line.strip(_SPACE)
        opens = _opens(line, text) if text else None
        before = {}
        for state in after:
            if not opens or state == "table" and text[0] == "|":
                kind, then = _open_run(line, text, state)
                done, units = after[then]
                before[state] = done, units + (kind is not None and (kind == "heading" or kind != state))
            else:
                rows = closers.get(opens[0][0], ())
                done, units = after[""] if opens[1] else next((row[1:] for row in reversed(rows) if row[0] >= len(opens[0])), (opens[0], 0))
                before[state] = done, units + 1
        for mark in BLOCK_KINDS:
            fence = mark in "`~"
            if text and (text[0] == mark and text == mark * len(text) if fence else _closes({"\\": "\\[", "$": "$$", "<": "<details"}[mark], text)):
                rows = closers.setdefault(mark, [])
                while rows and rows[-1][0] <= len(text):  # farther and no longer: this line closes all that they close
                    rows.pop()
                rows.append((len(text) if fence else 1 << 30, *after[""]))
                if not fence:
                    rows[:] = rows[-1:]
        after = before
    return [(state, 0, *row) for state, row in after.items()] + [(mark, *row) for mark, rows in closers.items() for row in reversed(rows)]


def _exits(lines: list[str]) -> list[tuple[str, int, str]]:
    """The states of ``_answers`` alone; "" and "prose" leave alike."""
    return [row[:3] for row in _answers(lines) if row[0] != "prose"]


def _pieces(lines, state: str) -> list[dict]:
    """The units and parts of units among these lines: kind, units started so far, first and last line counted from 1."""
    found, units = [], 0
    for at, line in enumerate(lines, 1):
        kind, starts, state = _scan(line, state)
        if kind and (starts or not found):
            units += starts
            found.append({"kind": kind, "n": units, "a": at, "b": at})
        elif kind:
            found[-1]["b"] = at
    return found


@F.pandas_udf(ANSWERS)
def _block_answers(texts: pd.Series) -> pd.Series:
    return texts.map(lambda lines: [{"state": s, "length": n, "after": a, "units": u} for s, n, a, u in _answers(lines)])


@F.pandas_udf(PIECES)
def _block_pieces(texts: pd.Series, entries: pd.Series) -> pd.Series:
    return pd.Series([_pieces(lines, entry) for lines, entry in zip(texts, entries)], index=texts.index, dtype=object)


@F.pandas_udf(SPANS)
def _block_spans(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else _spans_with_blocks(t))


def segment_units(documents: DataFrame) -> DataFrame:
    """(doc_id, unit_ord, unit_id, kind, text, hash, start_line, end_line, level, title).

    Row-local: a document's units come from its own row, no shuffle. Only documents that
    contain a possible multi-line block hand their text to Python; the others send a null.
    Texts too long for a row come as lines: ``segment_lines``.
    """
    # One-row explodes keep each step's result; Spark would copy the expressions into every use.
    once = lambda df, *columns: df.select("doc_id", F.explode(F.array(F.struct(*columns))).alias("_x")).select("doc_id", "_x.*")
    marked = reduce(Column.__or__, [F.col("text").contains(mark) for mark in ("```", "~~~", "\\[", "$$", "<")])
    df = (documents.select("doc_id", "text").withColumn("_blocky", F.when(marked & F.col("text").rlike(MAY_OPEN_BLOCK), F.col("text")))
          .withColumn("_block_spans", _block_spans("_blocky")))
    df = once(df, F.split("text", "\n", -1).alias("_lines"), "_block_spans")
    df = once(df, "_lines", "_block_spans", F.when(F.col("_block_spans").isNull(), F.transform("_lines", _line_kind)).alias("_kinds"))
    spans = F.coalesce("_block_spans", _plain_spans(F.col("_kinds")).cast(SPANS))
    # Lines are taken by number: a slice would unpack all lines of the document for each unit.
    lines_of = lambda s: F.transform(F.sequence(s["start_line"], s["end_line"]), lambda i: F.get(F.col("_lines"), i - 1))
    parts = F.transform(spans, lambda s: F.struct(
        s["kind"].alias("kind"),
        F.transform(F.array(F.array_join(lines_of(s), "\n")), lambda t: F.when(F.substring(t, -1, 1).rlike(WS), rtrim_ws(t)).otherwise(t))[0].alias("text"),
        s["start_line"].cast("bigint").alias("start_line"), s["end_line"].cast("bigint").alias("end_line")))
    units = (df.select("doc_id", F.posexplode(parts).alias("_p", "_u"))
             .select("doc_id", (F.col("_p") + 1).cast("bigint").alias("unit_ord"), "_u.*"))
    return finished_units(units)


def finished_units(units: DataFrame) -> DataFrame:
    return with_headings(units.withColumn("unit_id", unit_id(F.col("unit_ord"))).withColumn("hash", sha256_hex(F.col("text"))))


def segment_lines(lines: DataFrame, block_lines: int = BLOCK_ROWS) -> DataFrame:
    """The units of ``segment_units`` from ``lines(doc_id, line_no, text)``, for documents of any length.

    Lines are cut into blocks of ``block_lines`` numbers, a row each. Every block says in one pass in which state it leaves the
    scanner, and how many units start in it, for each state it can be entered in; the answers of a document are chained, then the
    blocks are scanned in parallel. Of a document only these answers meet in one task, and of its text only a unit. The text is
    shuffled twice: into blocks, and by unit.
    """
    rows = lines.select("doc_id", F.col("line_no").cast("bigint").alias("line_no"), "text")
    blocks = rows.groupBy("doc_id", F.floor(F.col("line_no") / block_lines).cast("bigint").alias("_blk")).agg(F.sort_array(F.collect_list(F.struct("line_no", "text"))).alias("_l"))
    blocks = blocks.filter("doc_id is not null and _blk is not null")  # as the join below has it: Spark then uses one shuffle for both
    texts = F.col("_l.text")
    mark = lambda state: F.when(state.isin("", "prose", "table"), state).otherwise(F.substring(state, 1, 1))
    fits = lambda state, x: (x["state"] == mark(state)) & (~mark(state).isin("`", "~") | (x["length"] >= F.length(state)))
    hit = lambda s, b: F.try_element_at(F.filter(b["answers"], lambda x: fits(s["state"], x)), F.lit(1))
    step = lambda s, b: F.struct(F.array_append(s["entries"], F.struct(b["_blk"].alias("_blk"), s["state"].alias("entry"), s["units"].alias("_before"))).alias("entries"),
                                 F.coalesce(hit(s, b)["after"], s["state"]).alias("state"), (s["units"] + F.coalesce(hit(s, b)["units"], F.lit(0))).alias("units"))
    start = F.struct(F.array().cast("array<struct<_blk: bigint, entry: string, _before: bigint>>").alias("entries"), F.lit("").alias("state"), F.lit(0).cast("bigint").alias("units"))
    chained = (blocks.select("doc_id", "_blk", _block_answers(texts).alias("answers"))
               .groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("_blk", "answers"))).alias("blocks")))
    entries = chained.select("doc_id", F.explode(F.aggregate("blocks", start, step, lambda s: s["entries"])).alias("x")).select("doc_id", "x.*")
    pieces = blocks.join(entries, ["doc_id", "_blk"]).select("doc_id", "_before", "_l", F.explode(_block_pieces(texts, "entry")).alias("x"))
    number = lambda at: F.col("_l")[F.col(at) - 1]["line_no"]
    parts = pieces.select("doc_id", (F.col("_before") + F.col("x.n")).alias("unit_ord"), F.col("x.kind").alias("kind"), number("x.a").alias("start_line"), number("x.b").alias("end_line"),
                          F.array_join(F.slice(texts, F.col("x.a"), F.col("x.b") - F.col("x.a") + 1), "\n").alias("text"))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start_line", "text"))), lambda x: x["text"]), "\n")
    units = parts.groupBy("doc_id", "unit_ord").agg(F.min_by("kind", "start_line").alias("kind"), rtrim_ws(joined).alias("text"),
                                                    F.min("start_line").alias("start_line"), F.max("end_line").alias("end_line"))
    return finished_units(units)


def unit_id(position: Column) -> Column:
    return zero_pad("u", position, 6)


def with_headings(units: DataFrame) -> DataFrame:
    """Adds ``level`` and ``title``. Only texts that end with a mark or blanks need the pattern that looks for their end at every character."""
    heading = F.col("kind") == "heading"
    closed = F.substring("text", -1, 1).rlike(rf"#|{WS}")
    level = F.when(closed, F.length(F.regexp_extract("text", HEADING, 1))).otherwise(F.length(F.regexp_extract("text", HEADING_MARK, 1)))
    title = F.when(closed, trim_ws(F.regexp_extract("text", HEADING, 2))).when(F.col("text").rlike(HEADING_MARK), F.regexp_replace("text", rf"{HEADING_MARK}+", "")).otherwise("")
    return units.withColumn("level", F.when(heading, level)).withColumn("title", F.when(heading, title))


def heading_context(units: DataFrame) -> DataFrame:
    """Adds ``context``, the path of headings above a unit (a heading includes itself)."""
    keys = {f"_h{level}": ("max", F.when(F.col("level") == level, F.struct("unit_ord", "title"))) for level in range(1, 7)}
    df = with_running(units, ["doc_id"], ["unit_ord"], keys)
    slots, above = [], F.lit(0).cast("bigint")
    for level in range(1, 7):
        last = F.col(f"_h{level}")
        slots.append(F.when(last["unit_ord"] > above, last["title"]))
        above = F.greatest(above, F.coalesce(last["unit_ord"], F.lit(0)))
    return df.withColumn("context", F.filter(F.array(*slots), lambda t: t.isNotNull())).drop(*keys)


# --- greedy packing ------------------------------------------------------------------

def _fresh_exits(weights: np.ndarray, limit: int):
    """For each start i: (end of the chunk opened at i, chunks opened from i on, size left open at the end)."""
    total = np.concatenate(([0], np.cumsum(weights)))
    n = len(weights)
    stop = np.searchsorted(total, total[:-1] + limit, side="right") - 1
    stop = np.maximum(stop, np.arange(n) + 1)
    opened, left = np.zeros(n + 1, dtype=np.int64), np.zeros(n + 1, dtype=np.int64)
    for i in range(n - 1, -1, -1):
        j = stop[i]
        opened[i] = 1 + opened[j]
        open_end = j == n and weights[i] <= limit
        left[i] = total[n] - total[i] if open_end else left[j]
    return total, stop, opened, left


def _pack(keys, limit):
    """Rows arrive sorted by (keys, blk, unit_ord); only the open chunk is remembered between them."""
    def run(batches):
        current, chunk, size, is_open = None, 0, 0, False
        for pdf in batches:
            out = []
            columns = [pdf[c].tolist() for c in (*keys, "blk")]
            for *key, weight, entry_size, entry_chunks in zip(*columns, pdf["weight"].tolist(), pdf["entry_size"].tolist(), pdf["entry_chunks"].tolist()):
                if key != current:
                    current, chunk, size, is_open = key, entry_chunks, entry_size, entry_size > 0
                if is_open and size + weight > limit:
                    is_open = False
                if not is_open:
                    chunk, size, is_open = chunk + 1, 0, True
                size += weight
                if weight > limit:
                    is_open = False
                out.append(chunk)
            yield pdf[[*keys, "unit_ord"]].assign(chunk_ord=out)
    return run


def _summarize(keys, limit):
    def summary(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("unit_ord")
        weights = pdf["weight"].to_numpy()
        total, _, opened, left = _fresh_exits(weights, limit)
        n = len(weights)
        # Entering with size s > 0 the first break is at i with limit - total[i+1] < s <= limit - total[i].
        rows = [(0, 0, opened[0], left[0], False)]
        for i in range(n):
            if total[i] >= limit:
                break
            rows.append((limit - total[i + 1] + 1, limit - total[i], opened[i], left[i], False))
        if total[n] < limit:
            rows.append((1, limit - total[n], 0, total[n], True))
        out = pd.DataFrame(rows, columns=["low", "high", "opened", "exit_size", "adds"])
        for key in [*keys, "blk"]:
            out[key] = pdf[key].iloc[0]
        return out[[*keys, "blk", "low", "high", "opened", "exit_size", "adds"]]
    return summary


def _compose(keys):
    def scan(pdf: pd.DataFrame) -> pd.DataFrame:
        size = chunks = 0
        out = []
        for blk, rows in pdf.sort_values("blk").groupby("blk", sort=True):
            out.append((blk, size, chunks))
            row = rows[(rows["low"] <= size) & (size <= rows["high"])].iloc[0]
            chunks += int(row["opened"])
            size = int(row["exit_size"]) + (size if row["adds"] else 0)
        res = pd.DataFrame(out, columns=["blk", "entry_size", "entry_chunks"])
        for key in keys:
            res[key] = pdf[key].iloc[0]
        return res[[*keys, "blk", "entry_size", "entry_chunks"]]
    return scan


def pack_chunks(units: DataFrame, limit: int = 24_000, keys: tuple[str, ...] = ("doc_id",), *, overhead: int = 180,
                block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Greedy packing: (keys, unit_ord, chunk_ord), 1-based; a unit over the limit is alone and whole.

    Packing is sequential, so a key longer than ``block_rows`` positions is packed in blocks: each
    block says where it would leave off for every possible size it can be entered with (at most
    ``limit / overhead`` cases), the per-block answers are chained, and the blocks are then packed
    in parallel. Only positions and weights travel, never text. Units may come with ``chars`` in place of ``text``.
    """
    if limit < 1 or overhead < 1:
        raise ValueError("limit and overhead must be positive")
    keys = list(keys)
    types = dict(units.dtypes)
    key_ddl = ", ".join(f"{k} {types[k]}" for k in keys)
    chars = F.col("chars") if "chars" in units.columns else text_length(F.col("text"))
    rows = units.select(*keys, F.col("unit_ord").cast("bigint").alias("unit_ord"),
                        (chars + overhead).cast("bigint").alias("weight"),
                        F.floor(F.col("unit_ord") / block_rows).cast("bigint").alias("blk"))
    long_keys = rows.groupBy(*keys).agg(F.min("blk").alias("a"), F.max("blk").alias("b")).filter("b > a").select(*keys)
    # Spread the blocks of a long key over tasks; the join alone would leave them together.
    summaries = (rows.join(long_keys, keys, "left_semi").repartition(*keys, "blk").groupBy(*keys, "blk")
                 .applyInPandas(_summarize(keys, limit), f"{key_ddl}, blk bigint, low bigint, high bigint, opened bigint, exit_size bigint, adds boolean"))
    entries = summaries.groupBy(*keys).applyInPandas(_compose(keys), f"{key_ddl}, blk bigint, entry_size bigint, entry_chunks bigint")
    rows = rows.join(entries, [*keys, "blk"], "left").fillna(0, ["entry_size", "entry_chunks"])
    ordered = dealt(rows, [*keys, "blk"], ["unit_ord"])
    return ordered.mapInPandas(_pack(keys, limit), f"{key_ddl}, unit_ord bigint, chunk_ord bigint")


def chunk_id(position: Column) -> Column:
    return zero_pad("c", position, 4)


def split_parts(rows: DataFrame, limit: int, keys: tuple[str, ...]) -> DataFrame:
    """(keys, unit_ord, part_ord): each key's units packed to ``limit``; a key that would stay one part is halved instead."""
    keys = list(keys)
    parts = pack_chunks(rows, limit, tuple(keys)).withColumnRenamed("chunk_ord", "part_ord")
    totals = parts.groupBy(*keys).agg(F.max("part_ord").alias("_parts"), F.count(F.lit(1)).alias("_n"))
    # A chunk holds a bounded number of units, so ranking inside it stays small.
    ranked = with_running(parts.join(totals, keys), keys, ["unit_ord"], {"_rank": ("sum", F.lit(1))})
    halves = F.when(F.col("_rank") <= F.ceil(F.col("_n") / 2), 1).otherwise(2)
    return ranked.withColumn("part_ord", F.when((F.col("_parts") == 1) & (F.col("_n") > 1), halves).otherwise(F.col("part_ord")).cast("bigint")).drop("_parts", "_n", "_rank")


def resplit_failed_chunks(unit_chunks: DataFrame, units: DataFrame, failed: DataFrame, size: int = 8_000,
                          depth: int = 0, flat: bool = True) -> DataFrame:
    """Failed chunks cut into smaller parts: (doc_id, chunk_id, part_id, part_ord, unit_ord)."""
    rows = (unit_chunks.join(failed.select("doc_id", "chunk_id").distinct(), ["doc_id", "chunk_id"], "left_semi")
            .select("doc_id", "chunk_id", "unit_ord").join(units.select("doc_id", "unit_ord", "text"), ["doc_id", "unit_ord"]))
    if flat:
        parts = pack_chunks(rows, size, ("doc_id", "chunk_id")).withColumnRenamed("chunk_ord", "part_ord")
    else:
        parts = split_parts(rows, max(2_000, size // 2 ** depth), ("doc_id", "chunk_id"))
    label = "-flat-" if flat else f"-repair-{depth}-"
    return parts.withColumn("part_id", F.concat("chunk_id", zero_pad(label, F.col("part_ord"), 2)))
