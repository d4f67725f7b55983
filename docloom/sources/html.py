"""Raw pages to Markdown, links and images, as JVM column expressions.

Elements that need a computed replacement are handled by ``replace_matches``: the text
between matches and the matches themselves become two arrays, each match is rewritten by
ordinary column functions and the arrays are zipped together again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions.text import WS, collapse_ws, decode_entities, is_blank, trim_ws

TAG = "<[^>]*>"
ANY = r"[\s\S]*?"
LINK = rf"(?i)<a\b[^>]*>{ANY}</a>"
LINK_PARTS = rf"(?i)\A<a\b([^>]*)>({ANY})</a>\z"
IMAGE = r"(?i)<img\b[^>]*>"
CODE = rf"(?i)<pre\b[^>]*>{WS}*<code\b[^>]*>{ANY}</code>{WS}*</pre>"
CODE_PARTS = rf"(?i)\A<pre\b[^>]*>{WS}*<code\b[^>]*>({ANY})</code>{WS}*</pre>\z"
MATH = rf"""(?i)<math\b[^>]*\balttext=(?:"[^"]*"|'[^']*')[^>]*>{ANY}</math>"""
MATH_PARTS = rf"""(?i)\A<math\b[^>]*\balttext=(?:"([^"]*)"|'([^']*)')[^>]*>{ANY}</math>\z"""
HEADING = rf"(?i)<h[1-6]\b[^>]*>{ANY}</h[1-6]>"


def replace_matches(col: Column, pattern: str, rewrite) -> Column:
    between = F.split(col, pattern, -1)
    found = F.transform(F.regexp_extract_all(col, F.lit(pattern), F.lit(0)), rewrite)
    return F.array_join(F.zip_with(between, found, lambda b, m: F.concat(b, F.coalesce(m, F.lit("")))), "")


def _code_point(entity: Column) -> Column:
    digits = F.regexp_extract(entity, r"(?i)&#x?([0-9a-f]+);", 1)
    value = F.when(entity.rlike(r"(?i)\A&#x"), F.conv(digits, 16, 16)).otherwise(F.conv(digits, 10, 16))
    return F.decode(F.unhex(F.lpad(value, 8, "0")), "UTF-32")


def decode_all_entities(col: Column) -> Column:
    """Named entities in order, then numeric ones."""
    named = decode_entities(col)
    return F.when(named.contains("&#"), replace_matches(named, r"(?i)&#(?:x[0-9a-f]+|\d+);", _code_point)).otherwise(named)


def attribute(tag: Column, name: str) -> Column:
    pattern = rf"""(?i)\b{name}{WS}*={WS}*(?:"([^"]*)"|'([^']*)'|([^\s>]+))"""
    parts = [F.nullif(F.regexp_extract(tag, pattern, i), F.lit("")) for i in (1, 2, 3)]
    return decode_all_entities(F.coalesce(*parts, F.lit("")))


def strip_tags(col: Column) -> Column:
    return decode_all_entities(collapse_ws(F.regexp_replace(col, TAG, "")))


def _link_text(tag: Column) -> Column:
    return strip_tags(F.regexp_extract(tag, LINK_PARTS, 2))


def _link_href(tag: Column) -> Column:
    return attribute(F.regexp_extract(tag, LINK_PARTS, 1), "href")


def _drop_invisible(html: Column) -> Column:
    html = F.regexp_replace(html, rf"<!--{ANY}-->", "")
    html = F.regexp_replace(html, rf"(?i)<(script|style|noscript|svg){ANY}</\1>", "")
    return F.regexp_replace(html, rf"(?i)<head{ANY}</head>", "")


def _when_present(col: Column, pattern: str, rewrite) -> Column:
    return F.when(col.rlike(pattern), replace_matches(col, pattern, rewrite)).otherwise(col)


def _keep_code(match: Column) -> Column:
    body = decode_all_entities(F.regexp_replace(F.regexp_extract(match, CODE_PARTS, 1), TAG, ""))
    return F.concat(F.lit("\n\n```\n"), body, F.lit("\n```\n\n"))


def _math(match: Column) -> Column:
    text = F.concat(F.regexp_extract(match, MATH_PARTS, 1), F.regexp_extract(match, MATH_PARTS, 2))
    return F.concat(F.lit("\n\n$"), decode_all_entities(text), F.lit("$\n\n"))


def _image(tag: Column) -> Column:
    return F.concat(F.lit("!["), attribute(tag, "alt"), F.lit("]("), attribute(tag, "src"), F.lit(")"))


def _link(tag: Column) -> Column:
    text, href = _link_text(tag), _link_href(tag)
    return F.when((text != "") & (href != ""), F.concat(F.lit("["), text, F.lit("]("), href, F.lit(")"))).otherwise(text)


def _heading(match: Column) -> Column:
    level = F.regexp_extract(match, r"(?i)\A<h([1-6])", 1).cast("int")
    text = strip_tags(F.regexp_extract(match, rf"(?i)\A<h[1-6]\b[^>]*>({ANY})</h[1-6]>\z", 1))
    return F.concat(F.lit("\n\n"), F.repeat(F.lit("#"), level), F.lit(" "), text, F.lit("\n\n"))


def _through_images(pages: DataFrame) -> DataFrame:
    # One column per step: a step mentions its input more than once, and a separate
    # projection keeps Catalyst from evaluating the earlier steps again.
    return (pages.withColumn("_h", _drop_invisible(F.col("html")))
            .withColumn("_h", _when_present(F.col("_h"), MATH, _math))
            .withColumn("_h", _when_present(F.col("_h"), CODE, _keep_code))
            .withColumn("_i", F.col("_h"))
            .withColumn("_h", _when_present(F.col("_h"), IMAGE, _image)))


def html_to_markdown(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``documents(page_id, text)`` and ``issues`` for pages that come out empty."""
    df = _through_images(pages).drop("html", "_i").withColumn("_h", _when_present(F.col("_h"), LINK, _link))
    for level in "123456":
        df = df.withColumn("_h", _when_present(F.col("_h"), rf"(?i)<h{level}\b[^>]*>{ANY}</h{level}>", _heading))
    text = F.col("_h")
    # Block tags and what each becomes, in order.
    for pattern, out in ((r"(?i)<(p|section|article|main|figure|figcaption|blockquote|div)\b[^>]*>", "\n\n"),
                         (r"(?i)</(p|section|article|main|figure|figcaption|blockquote|div)>", "\n\n"),
                         (rf"(?i)<br{WS}*/?{WS}*>", "\n"), (r"(?i)<li\b[^>]*>", "\n- "), (r"(?i)</?(ul|ol)\b[^>]*>", "\n"),
                         (r"(?i)<table\b[^>]*>", "\n\n"), (r"(?i)</table>", "\n\n"), (r"(?i)<tr\b[^>]*>", "\n"),
                         (r"(?i)</(tr|td|th)>", " | "), (TAG, "")):
        text = F.regexp_replace(text, pattern, out)
    df = df.withColumn("_h", text).withColumn("_h", decode_all_entities(F.col("_h")))
    text = F.col("_h")
    for pattern, out in ((r"[ \t]+\n", "\n"), (r"\n[ \t]+", "\n"), (r"\n{3,}", "\n\n"), (r"[ \t]{2,}", " ")):
        text = F.regexp_replace(text, pattern, out)
    # The one-row explode is a fence: without it the blank test below would be pushed through
    # every step above, copying the whole chain for each mention of its input.
    df = df.withColumn("text", F.explode(F.array(F.concat(trim_ws(text), F.lit("\n"))))).drop("_h")
    empty = is_blank(F.col("text"))
    return df.filter(~empty), df.filter(empty).select("page_id", F.lit("empty_markdown").alias("category"))


def page_links(pages: DataFrame) -> DataFrame:
    """(page_id, pos, text, href) of every link."""
    tags = _through_images(pages).select("page_id", F.posexplode(F.regexp_extract_all("_h", F.lit(LINK), F.lit(0))).alias("pos", "tag"))
    return tags.select("page_id", (F.col("pos") + 1).cast("bigint").alias("pos"),
                       _link_text(F.col("tag")).alias("text"), _link_href(F.col("tag")).alias("href"))


def page_images(pages: DataFrame) -> DataFrame:
    """(page_id, pos, alt, src) of every image outside code and formulas."""
    tags = _through_images(pages).select("page_id", F.posexplode(F.regexp_extract_all("_i", F.lit(IMAGE), F.lit(0))).alias("pos", "tag"))
    return tags.select("page_id", (F.col("pos") + 1).cast("bigint").alias("pos"),
                       attribute(F.col("tag"), "alt").alias("alt"), attribute(F.col("tag"), "src").alias("src"))
