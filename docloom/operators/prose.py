"""Prose density, lossless splitting, replacements, section documents, audits and gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions.text import (NON_WS, blocks_of, collapse_ws, dense_block_count, is_blank, is_dense_block, is_kept_whole, let, sentence_count,
                                    split_sentences, text_length, trim_ws, word_count)
from docloom.operators.annotate import COMMENT_END, ISSUE_COMMENT, ISSUE_OPENING, issue_ids
from docloom.operators.overlay import exact_cover

MIN_CHARS = 2_000


def dense_paragraphs(documents: DataFrame, key: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(key, block, words, sentences, excerpt) of every dense block; ``block`` counts from 0."""
    blocks = documents.select(*key, F.posexplode(blocks_of(F.col("text"))).alias("block", "_b")).filter(is_dense_block(F.col("_b")))
    text = collapse_ws(F.col("_b"))
    return blocks.select(*key, F.col("block").cast("bigint").alias("block"), word_count(text).cast("bigint").alias("words"),
                         sentence_count(text).cast("bigint").alias("sentences"), F.substring(text, 1, 300).alias("excerpt"))


def _groups(sentences: Column) -> Column:
    """Sentences joined greedily: at most two and at most 55 words per group."""
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"), F.lit(0).alias("n"))

    def add(state, sentence):
        joined = F.concat(state["open"], F.lit(" "), sentence)
        return let((state["n"] > 0) & ((state["n"] >= 2) | (word_count(joined) > 55)), lambda full: step(state, sentence, joined, full))

    def step(state, sentence, joined, full):
        return F.struct(
            F.when(full, F.array_append(state["done"], state["open"])).otherwise(state["done"]).alias("done"),
            F.when(full | (state["n"] == 0), sentence).otherwise(joined).alias("open"),
            F.when(full, F.lit(1)).otherwise(state["n"] + 1).alias("n"))
    return F.aggregate(sentences, start, add, lambda s: F.when(s["n"] > 0, F.array_append(s["done"], s["open"])).otherwise(s["done"]))


def _split_block(block: Column) -> Column:
    keep = F.struct(block.alias("text"), F.lit(0).alias("splits"))
    made = let(_groups(split_sentences(block)), lambda g: F.when(F.size(g) >= 2, F.struct(
        F.array_join(g, "\n\n").alias("text"), (F.size(g) - 1).alias("splits"))).otherwise(keep))
    return F.when(is_dense_block(block) & ~is_kept_whole(block), made).otherwise(keep)


def split_dense_text(text: Column) -> Column:
    """Struct (text, splits): dense blocks cut at sentence ends, everything else untouched."""
    return let(F.transform(blocks_of(text), _split_block), lambda b: F.struct(
        F.concat(trim_ws(F.array_join(F.transform(b, lambda x: x["text"]), "\n\n")), F.lit("\n")).alias("text"),
        F.aggregate(b, F.lit(0), lambda total, x: total + x["splits"]).cast("bigint").alias("splits")))


def split_dense_prose(documents: DataFrame) -> DataFrame:
    """Adds ``split_count`` and replaces ``text``; works inside each row, nothing is shuffled."""
    df = documents.withColumn("_s", split_dense_text(F.col("text")))
    return df.withColumn("text", F.col("_s.text")).withColumn("split_count", F.col("_s.splits")).drop("_s")


def prose_split_report(documents: DataFrame) -> DataFrame:
    """Splits and dense blocks left per (doc_id, section) of ``split_dense_prose`` output, with totals (section null)."""
    rows = documents.select("doc_id", "section", "split_count", dense_block_count(F.col("text")).cast("bigint").alias("dense"))
    return (rows.rollup("doc_id", "section").agg(F.sum("split_count").alias("splits"), F.sum("dense").alias("remaining_dense"))
            .filter("doc_id is not null"))


def dense_sections(section_documents: DataFrame) -> DataFrame:
    """Section documents that still hold dense blocks: the rewrite targets."""
    # The one-row explode keeps the count from being evaluated once for the filter and once for the output.
    return section_documents.withColumn("dense", F.explode(F.array(dense_block_count(F.col("text")).cast("bigint")))).filter("dense > 0")


def validate_replacements(items: DataFrame, dense_blocks: DataFrame, documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted ``items(doc_id, block, paragraphs)`` per document: every dense block exactly once, each with at
    least two non-blank paragraphs that are not dense themselves, and a document less dense than before."""
    ok = ((F.size("paragraphs") >= 2) & F.forall("paragraphs", lambda p: ~is_blank(p)) & F.forall("paragraphs", lambda p: dense_block_count(p) == 0))
    accepted, issues = exact_cover(items, dense_blocks, ["doc_id"], "block", ok)
    before = dense_blocks.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_a"))
    after = apply_replacements(documents.join(accepted.select("doc_id").distinct(), "doc_id", "left_semi"), accepted).select("doc_id", dense_block_count(F.col("text")).alias("_b"))
    better = before.join(after, "doc_id").filter("_b < _a").select("doc_id")
    return accepted.join(better, "doc_id", "left_semi"), issues


def apply_replacements(documents: DataFrame, accepted: DataFrame) -> DataFrame:
    """Named blocks replaced, the others kept; the blocks are woven inside the document's row."""
    new = accepted.groupBy("doc_id").agg(F.collect_list(F.struct(F.col("block").cast("int").alias("block"), F.lit(0).alias("kept"),
                                                               F.array_join("paragraphs", "\n\n").alias("text"))).alias("_new"))
    df = documents.join(new, "doc_id", "left")
    old = F.transform(blocks_of(F.col("text")), lambda b, i: F.struct(i.alias("block"), F.lit(1).alias("kept"), b.alias("text")))
    both = F.array_sort(F.concat(old, F.coalesce("_new", F.array().cast("array<struct<block:int,kept:int,text:string>>"))))
    df = df.withColumn("_both", both)
    before = F.concat(F.array(F.lit(-1)), F.transform(F.slice("_both", 1, F.size("_both") - 1), lambda x: x["block"]))
    kept = F.filter(F.zip_with("_both", before, lambda x, p: F.struct(x["block"].alias("block"), p.alias("previous"), x["text"].alias("text"))),
                    lambda x: x["block"] != x["previous"])
    text = F.concat(trim_ws(F.array_join(F.transform(kept, lambda x: x["text"]), "\n\n")), F.lit("\n"))
    return df.withColumn("text", text).drop("_both", "_new")


def section_disposition(sections: DataFrame, documents: DataFrame, transition_titles: tuple[str, ...] = (), body: dict = {"text": lambda t: t}) -> DataFrame:
    """``sections(doc_id, section, title, text)`` against finished ``documents(doc_id, section, text, reused)``.

    ``transition_titles``: patterns of titles whose sections pass through as they are, like short ones.
    ``body``: columns made of the text that stands for the section. They are made before the join, so it moves nothing else of a text.
    """
    made = lambda prefix: [f(F.col("text")).alias(f"{prefix}{name}") for name, f in body.items()]
    have = documents.select("doc_id", "section", F.col("text").isNotNull().alias("_have"), "reused", *made("_d_"))
    passes = text_length(F.col("text")) < MIN_CHARS
    for pattern in transition_titles:
        passes = passes | F.coalesce(F.col("title").rlike(pattern), F.lit(False))
    have_it = F.coalesce("_have", F.lit(False))
    status = (F.when(have_it & F.col("reused"), "reused").when(F.col("_passes"), "source_transition")
              .when(have_it, "generated").otherwise("source_fallback"))
    df = sections.select("doc_id", "section", "title", passes.alias("_passes"), *made("_s_")).join(have, ["doc_id", "section"], "left").withColumn("status", status)
    chosen = [F.when(F.col("status").isin("reused", "generated"), F.col(f"_d_{name}")).otherwise(F.col(f"_s_{name}")).alias(name) for name in body]
    return df.select("doc_id", "section", "title", "status", *chosen)


def assemble_book(section_documents: DataFrame) -> DataFrame:
    rows = F.array_sort(F.collect_list(F.struct("section", trim_ws(F.col("text")).alias("text"))))
    return section_documents.groupBy("doc_id").agg(F.concat(F.array_join(F.transform(rows, lambda r: r["text"]), "\n\n---\n\n"), F.lit("\n")).alias("text"))


def _ids(documents: DataFrame, key: list[str]) -> DataFrame:
    return documents.select(*key, F.explode(issue_ids(F.col("text"))).alias("issue_id")).distinct()


def missing_issues(expected_in: DataFrame, kept_in: DataFrame, key: list[str]) -> DataFrame:
    """Issue ids of the annotated texts that the written texts neither keep nor resolve."""
    return _ids(expected_in, key).join(_ids(kept_in, key), [*key, "issue_id"], "left_anti")


def _comments(text: Column) -> Column:
    """Struct (ids, open): issue ids of the text, and whether it ends inside a comment."""
    return F.struct(issue_ids(text).alias("ids"), F.regexp_replace(text, ISSUE_COMMENT, "|").rlike(ISSUE_OPENING).alias("open"))


def _book_marks(text: Column) -> Column:
    """What a section adds to its book: dense blocks, and its comments both if it begins outside of one and inside of one.

    Sections are trimmed and a line ``---`` stands between them, so no block reaches from one into the next. A comment may; its body
    holds that line then, so it is no JSON and has no id. What is trimmed counts neither way, so it stays.
    """
    rest = lambda t: F.regexp_replace(t, rf"\A[\s\S]*?{COMMENT_END}", "")
    nothing = F.struct(F.array().cast("array<string>").alias("ids"), F.lit(True).alias("open"))
    return let(F.coalesce(text, F.lit("")), lambda t: F.struct(
        dense_block_count(t).cast("bigint").alias("dense"), _comments(t).alias("outside"),
        F.when(t.rlike(COMMENT_END), let(rest(t), _comments)).otherwise(nothing).alias("inside")))


BOOK_MARKS = {"marks": _book_marks}


def _book_ids(marked: DataFrame) -> DataFrame:
    """(doc_id, issue_id) that ``issue_ids`` finds in the assembled books."""
    start = F.struct(F.array().cast("array<array<string>>").alias("ids"), F.lit(False).alias("open"))

    def add(state, row):
        return let(F.when(state["open"], row["marks"]["inside"]).otherwise(row["marks"]["outside"]), lambda c: F.struct(
            F.when(F.size(c["ids"]) > 0, F.array_append(state["ids"], c["ids"])).otherwise(state["ids"]).alias("ids"), c["open"].alias("open")))
    # Only sections with something to add are listed.
    moves = (F.size("marks.outside.ids") > 0) | F.col("marks.outside.open") | (F.size("marks.inside.ids") > 0) | ~F.col("marks.inside.open")
    rows = F.array_sort(F.collect_list(F.struct("section", F.struct("marks.outside", "marks.inside").alias("marks"))))
    closed = F.flatten(F.transform("_rows", lambda r: r["marks"]["outside"]["ids"]))
    ids = F.when(F.exists("_rows", lambda r: r["marks"]["outside"]["open"]), F.aggregate("_rows", start, add, lambda s: F.flatten(s["ids"]))).otherwise(closed)
    return marked.filter(moves).groupBy("doc_id").agg(rows.alias("_rows")).select("doc_id", F.explode(ids).alias("issue_id")).distinct()


def book_report(dispositions: DataFrame, annotated_sections: DataFrame) -> DataFrame:
    """Per document: sections by status, expected, kept and missing issue ids, dense blocks of the book.

    ``dispositions`` is ``section_disposition`` with ``BOOK_MARKS``: what the report says of a book follows from marks of its sections.
    """
    statuses = dispositions.groupBy("doc_id").agg(F.count(F.lit(1)).alias("sections"), *[
        F.count_if(F.col("status") == s).alias(s) for s in ("reused", "source_transition", "generated", "source_fallback")], F.sum("marks.dense").alias("dense"))
    count = lambda df, name: df.groupBy("doc_id").agg(F.count(F.lit(1)).alias(name))
    expected, kept = _ids(annotated_sections, ["doc_id"]), _book_ids(dispositions)
    out = statuses
    for df, name in ((expected, "expected_issues"), (kept, "kept_issues"), (expected.join(kept, ["doc_id", "issue_id"], "left_anti"), "missing_issues")):
        out = out.join(count(df, name), "doc_id", "left")
    return out.fillna(0)


def document_gate(documents: DataFrame, annotated: DataFrame) -> DataFrame:
    """Why a document may not be published: start, length, density, dropped issues; ``passes`` when none holds."""
    lost = missing_issues(annotated, documents, ["doc_id"]).groupBy("doc_id").agg(F.count(F.lit(1)).alias("missing_issues"))
    df = documents.select("doc_id", trim_ws(F.col("text")).startswith("#").alias("starts_with_heading"), (text_length(F.col("text")) >= MIN_CHARS).alias("long_enough"),
                          dense_block_count(F.col("text")).cast("bigint").alias("dense")).join(lost, "doc_id", "left").fillna(0, ["missing_issues"])
    return df.withColumn("passes", F.col("starts_with_heading") & F.col("long_enough") & (F.col("dense") == 0) & (F.col("missing_issues") == 0))


def audit_sections(sections: DataFrame, documents: DataFrame, annotated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per section words, dense blocks, expected and missing issues; and a summary per document."""
    key = ["doc_id", "section"]
    texts = documents.select(*key, F.regexp_count("text", F.lit(f"{NON_WS}+")).cast("bigint").alias("words"), dense_block_count(F.col("text")).cast("bigint").alias("dense"))
    expected = _ids(annotated, key).groupBy(*key).agg(F.count(F.lit(1)).alias("expected_issues"))
    lost = missing_issues(annotated, documents, key).groupBy(*key).agg(F.count(F.lit(1)).alias("missing_issues"))
    per = (sections.select(*key, "title").join(texts, key, "left").join(expected, key, "left").join(lost, key, "left").fillna(0, ["expected_issues", "missing_issues"])
           .withColumn("status", F.when(F.col("words").isNull(), "missing").otherwise("present")))
    present = F.col("status") == "present"
    per = per.withColumn("expected_issues", F.when(present, F.col("expected_issues"))).withColumn("missing_issues", F.when(present, F.col("missing_issues")))
    summary = per.groupBy("doc_id").agg(F.count(F.lit(1)).alias("sections"), F.count_if(present & (F.col("dense") == 0) & (F.col("missing_issues") == 0)).alias("passing"),
                                        F.count_if(F.col("dense") > 0).alias("dense"), F.count_if(F.col("missing_issues") > 0).alias("missing_issues"),
                                        F.count_if(~present).alias("missing_documents"))
    return per, summary
