"""Column functions over text. All but ``nfkc`` and ``nfkc_list`` stay in the JVM."""

from __future__ import annotations

import json
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# The whitespace and word classes every text rule relies on.
WS = r"[\t\n\x0B\f\r \x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"
NON_WS = r"[^\t\n\x0B\f\r \x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"
WORD = r"[\p{L}\p{N}][\p{L}\p{N}_'-]*"
QUOTES = "\"'“”‘’"


@F.pandas_udf(StringType())
def _composed(values: pd.Series) -> pd.Series:
    return values.str.normalize("NFKC")


@F.pandas_udf(StringType())
def _composed_lists(values: pd.Series) -> pd.Series:
    composed = lambda items: [None if x is None else unicodedata.normalize("NFKC", x) for x in items]
    return values.map(lambda text: None if text is None else json.dumps(composed(json.loads(text))))


NON_ASCII = r"[^\x00-\x7F]"


def nfkc(col: Column) -> Column:
    """Unicode compatibility composition; Spark has no built-in for it. Only strings beyond ASCII are sent to Python."""
    return F.coalesce(_composed(F.when(col.rlike(NON_ASCII), col)), col)


def nfkc_list(col: Column) -> Column:
    """Lists travel as JSON texts: Spark measures a batch after every row, which for a column of lists takes a pass over all rows before."""
    sent = F.when(F.exists(col, lambda x: x.rlike(NON_ASCII)), F.to_json(col, {"ignoreNullFields": "false"}))
    return F.coalesce(F.from_json(_composed_lists(sent), ArrayType(StringType())), col)


def trim_ws(col: Column) -> Column:
    """Trim Unicode whitespace on both sides (Spark's trim strips only spaces)."""
    return F.regexp_replace(col, rf"\A{WS}+|{WS}+\z", "")


#: A character other than a space, by Unicode; what has none is a blank line.
NO_SPACE = r"[^\p{Zs}]"


def trim_spaces(col: Column) -> Column:
    """Trim Unicode spaces on both sides; tabs and line ends stay."""
    return F.regexp_replace(col, r"\A\p{Zs}+|\p{Zs}+\z", "")


def rtrim_ws(col: Column) -> Column:
    return F.regexp_replace(col, rf"{WS}+\z", "")


def collapse_ws(col: Column) -> Column:
    """Every whitespace run becomes one space, ends trimmed."""
    return F.trim(F.regexp_replace(col, rf"{WS}+", " "))


def is_blank(col: Column) -> Column:
    return F.coalesce(~col.rlike(NON_WS), F.lit(True))


def normalize_newlines(col: Column) -> Column:
    return F.regexp_replace(col, "\r\n?", "\n")


def text_length(col: Column) -> Column:
    """Length in UTF-16 code units, the measure all size limits use."""
    return (F.octet_length(F.encode(col, "UTF-16BE")) / 2).cast("bigint")


def zero_pad(prefix: str, number: Column, width: int) -> Column:
    """``prefix`` + number padded to ``width`` digits, longer numbers kept whole."""
    return F.format_string(f"{prefix}%0{width}d", number.cast("bigint"))


def sha256_hex(col: Column) -> Column:
    return F.sha2(col, 256)


def normalize_concept(col: Column, *, compose: bool = True) -> Column:
    """Canonical concept key: no emphasis marks, single spaces, no outer quotes, lower case."""
    base = nfkc(col) if compose else col
    base = F.regexp_replace(base, r"[*_`]+", "")
    base = F.regexp_replace(base, rf"{WS}+", " ")
    base = F.regexp_replace(base, rf"\A[ {QUOTES}]+|[ {QUOTES}]+\z", "")
    return F.lower(base)


def normalize_concepts(col: Column, *, compose: bool = True) -> Column:
    """List form: canonical keys, blanks dropped, first occurrence kept."""
    items = F.coalesce(col, F.array().cast("array<string>"))
    cleaned = F.transform(nfkc_list(items) if compose else items, lambda x: trim_ws(normalize_concept(x, compose=False)))
    return F.array_distinct(F.filter(cleaned, lambda x: x.isNotNull() & (x != "")))


def unique_trimmed(col: Column) -> Column:
    """Trimmed, non-empty, distinct strings in first-seen order."""
    items = F.transform(F.coalesce(col, F.array().cast("array<string>")), trim_ws)
    return F.array_distinct(F.filter(items, lambda x: x.isNotNull() & (x != "")))


def normalize_gap_type(col: Column, *, compose: bool = True) -> Column:
    base = nfkc(col) if compose else col
    base = F.lower(trim_ws(base))
    base = F.regexp_replace(base, r"[^\p{L}\p{N}]+", "_")
    return F.nullif(F.regexp_replace(base, r"\A_+|_+\z", ""), F.lit(""))


def normalize_label(col: Column, *, compose: bool = True) -> Column:
    """Letters and digits only, words separated by one space, lower case."""
    base = nfkc(col) if compose else col
    return F.coalesce(F.trim(F.regexp_replace(F.lower(base), r"[^\p{L}\p{N}]+", " ")), F.lit(""))


def section_slug(col: Column, *, compose: bool = True) -> Column:
    base = F.lower(nfkc(col) if compose else col)
    base = F.regexp_replace(base, r"[^\p{L}\p{N}]+", "-")
    base = F.substring(F.regexp_replace(base, r"\A-+|-+\z", ""), 1, 80)
    return F.coalesce(F.nullif(base, F.lit("")), F.lit("section"))


def word_count(col: Column) -> Column:
    return F.coalesce(F.regexp_count(col, F.lit(WORD)), F.lit(0))


def surface_density(col: Column, words: int = 32) -> Column:
    """Word count over ``words``, capped at 1, three decimals; null text scores 0."""
    return F.round(F.least(F.lit(1.0), word_count(col) / F.lit(float(words))), 3)


def clamp_score(col: Column) -> Column:
    """A finite number limited to [0, 1] with three decimals, anything else null."""
    value = col.cast("double")
    finite = value.isNotNull() & ~F.isnan(value) & (F.abs(value) != F.lit(float("inf")))
    return F.when(finite, F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), value)), 3))


def sentence_count(collapsed: Column) -> Column:
    """Sentence ends in whitespace-collapsed text."""
    return F.coalesce(F.regexp_count(collapsed, F.lit(r"[.!?](?= |\z)")), F.lit(0))


def split_sentences(col: Column) -> Column:
    parts = F.split(collapse_ws(col), r"(?<=[.!?]) +(?=[A-Z0-9*_`(\[\\“])")
    return F.filter(parts, lambda s: s != "")


def first_sentences(col: Column, limit: int = 2, chars: int = 1200) -> Column:
    """The first ``limit`` sentences, at most ``chars`` characters."""
    found = F.regexp_extract_all(col, F.lit(r"([^.!?]+[.!?]+)"), F.lit(1))
    found = F.when(F.size(found) > 0, found).otherwise(F.array(col))
    picked = F.array_join(F.slice(F.transform(found, trim_ws), 1, limit), " ")
    return F.substring(trim_ws(picked), 1, chars)


# Block openings that are never treated as prose.
_NOT_PROSE_AFTER_COLLAPSE = r"\A(?:#{1,6} |[-*+] |\d+\. |>|```|\$\$|\\\[|\||<!--)"
_KEEP_WHOLE = rf"\A(?:#{{1,6}}{WS}|[-*+]{WS}|\d+\.{WS}|>|```|\$\$|\||<!--)"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once; inside lambdas Spark shares no common subexpressions."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _is_dense(col: Column, settled: Column, words) -> Column:
    def judge(text):
        counts = F.named_struct(F.lit("words"), words(text), F.lit("sentences"), sentence_count(text))
        dense = let(counts, lambda c: (c["sentences"] > 0) & (((c["words"] >= 35) & (c["sentences"] >= 4)) | (c["words"] >= 90)))
        return (text != "") & ~text.rlike(_NOT_PROSE_AFTER_COLLAPSE) & dense
    return F.when(settled, F.lit(False)).otherwise(let(collapse_ws(col), judge))


def is_dense_block(col: Column) -> Column:
    """A prose block with >=35 words in >=4 sentences, or >=90 words with any sentence end."""
    # 35 words need at least 69 characters, so short blocks are settled without any counting.
    return _is_dense(col, F.length(col) < 69, word_count)


def is_dense_block_of(col: Column, words: Column) -> Column:
    """``is_dense_block`` of a text whose number of words is known."""
    return _is_dense(col, words < 35, lambda text: words)


def is_kept_whole(col: Column) -> Column:
    return trim_ws(col).rlike(_KEEP_WHOLE)


BLOCK_BREAK = rf"\n{WS}*\n"


def blocks_of(col: Column) -> Column:
    return F.split(col, BLOCK_BREAK, -1)


def dense_block_count(col: Column) -> Column:
    return F.size(F.filter(blocks_of(col), is_dense_block))


def decode_entities(col: Column) -> Column:
    """Named entities in their fixed order, one after the other, so ``&amp;lt;`` ends as ``<``.

    Numeric entities need a code point lookup and are decoded by the HTML job.
    """
    # Entity names and their replacements, in order.
    for pattern, text in (("(?i)&nbsp;", " "), ("(?i)&amp;", "&"), ("(?i)&lt;", "<"), ("(?i)&gt;", ">"),
                          ("(?i)&quot;", '"'), ("(?i)&#39;|&apos;", "'")):
        col = F.regexp_replace(col, pattern, text)
    return col


def strip_fence(col: Column) -> Column:
    """Body of a fenced JSON answer, or the trimmed text when there is no fence."""
    # Only texts with blanks at an end are searched for them.
    text = F.when(col.rlike(rf"\A{WS}") | F.substring(col, -1, 1).rlike(WS), trim_ws(col)).otherwise(col)
    body = F.regexp_extract(text, rf"(?i)\A```(?:json)?{WS}*([\s\S]*?){WS}*```\z", 1)
    fenced = text.startswith("```") & text.endswith("```") & text.rlike(rf"(?i)\A```(?:json)?{WS}*[\s\S]*?{WS}*```\z")
    return F.when(fenced, body).otherwise(text)
