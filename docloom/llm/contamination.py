"""Benchmark passages in documents, through a positional inverted index.

Words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after lower-casing A-Z. An item's windows are its runs of
``window`` words, or all its words if it has fewer. The search goes from the rarest terms:

1. count the corpus occurrences of the benchmark's terms (combined before the shuffle);
2. pick the ``LISTS`` rarest positions of every window; a window with a term the corpus lacks is out;
3. store the postings (doc, term, position) of the picked terms, in segments sorted by term;
4. take the list of each window's rarest term, shift it by the term's offset, and intersect it with the shifted lists of
   the next rarest terms;
5. compare all words at the places left, exactly.

Nothing depends on how often a term or passage occurs: lists are joined on keys that spread a frequent term over its
documents, and hit words are counted per document.

Defined cases: null or empty texts have no words, are never hit and are never found; a word position hit by several
windows or items counts once. Repeated rows get equal results. Items without an item_id count their hits but are not
listed. Items that share an item_id are listed once. Empty tables give rows without hits, or no rows. Other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import LOWER, UPPER, text_key, written

#: Between words, as the contract's word class has it: everything in ASCII but digits and a-z.
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Lists intersected for a window before its words are compared.
LISTS = 3


def split_words(text: str = "text") -> Column:
    """Words in order; the first and the last element may be empty, which keeps positions in step."""
    column = F.coalesce(F.col(text), F.lit(""))
    ascii_only = F.length(column) == F.octet_length(column)
    return F.split(F.when(ascii_only, F.lower(column)).otherwise(F.translate(column, UPPER, LOWER)), SEPARATOR)


def word_count(words: Column) -> Column:
    """Number of non-empty words of ``split_words``."""
    ends = F.when(F.get(words, F.lit(0)) == "", 1).otherwise(0) + F.when((F.size(words) > 1) & (F.get(words, F.size(words) - 1) == ""), 1).otherwise(0)
    return (F.size(words) - ends).cast("long")


def _keyed(docs: DataFrame, column: str) -> DataFrame:
    """doc_id, a hash of the text (rows may share a doc_id) and words."""
    return docs.select("doc_id", text_key(column).alias("text_hash"), split_words(column).alias("words"))


def _positions(keyed: DataFrame) -> DataFrame:
    return keyed.select("doc_id", "text_hash", F.posexplode("words").alias("pos", "term")).filter("term <> ''")


def item_words(items: DataFrame, column: str = "text") -> DataFrame:
    """item, item_id and words of the items that have words; equal rows once."""
    words = F.filter(split_words(column), lambda w: w != "")
    return (items.select(F.col("item_id").cast("string").alias("item_id"), words.alias("words")).filter(F.size("words") > 0)
            .distinct().withColumn("item", F.xxhash64("item_id", "words")))


def term_counts(docs: DataFrame, terms: DataFrame, column: str = "text") -> DataFrame:
    """Occurrences of the given terms in all documents."""
    return _positions(_keyed(docs, column)).join(terms, "term").groupBy("term").agg(F.count("*").alias("occurrences"))


def rarest_terms(items: DataFrame, counts: DataFrame, window: int, lists: int = LISTS) -> DataFrame:
    """Distinct picks of the windows: item and an array of (occurrences, at, term), rarest first."""
    last = F.greatest(F.size("words") - window, F.lit(0))
    places = (items.select("item", "words", F.explode(F.sequence(F.lit(0), last)).alias("first"))
              .select("item", "first", F.least(F.size("words"), F.lit(window)).alias("length"), F.posexplode(F.slice("words", F.col("first") + 1, window)).alias("at", "term")))
    found = (places.join(counts, "term").groupBy("item", "first", "length")
             .agg(F.sort_array(F.collect_list(F.struct("occurrences", (F.col("first") + F.col("at")).alias("at"), "term"))).alias("picks")))
    return found.filter(F.size("picks") == F.col("length")).select("item", F.slice("picks", 1, lists).alias("picks")).distinct()


def build_index(docs: DataFrame, terms: DataFrame, column: str = "text") -> DataFrame:
    """Positional postings of the given terms: doc_id, text_hash, pos, term. Stored; equal rows of documents once."""
    postings = _positions(_keyed(docs, column)).join(terms, "term").select("doc_id", "text_hash", "pos", "term")
    return written(postings.sortWithinPartitions("term", "doc_id", "pos"), "postings").distinct()


def intersect(index: DataFrame, picks: DataFrame, lists: int = LISTS) -> DataFrame:
    """Places (doc_id, text_hash, item, shift) where the picked terms of some window stand as in the item.

    ``shift`` is the document position of the item's first word.
    """
    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_doc")
    postings = index.select("doc_id", doc, "text_hash", "pos", "term")
    pick = lambda n: F.get("picks", F.lit(n))
    found = (picks.withColumn("term", pick(0)["term"]).join(postings, "term")
             .withColumn("shift", F.col("pos") - pick(0)["at"]).drop("pos", "term"))
    for n in range(1, lists):
        wanted = found.withColumn("term", pick(n)["term"]).withColumn("pos", F.col("shift") + pick(n)["at"])
        short = wanted.filter("term is null")
        found = wanted.filter("term is not null").join(postings.drop("doc_id"), ["_doc", "text_hash", "term", "pos"], "left_semi").unionByName(short).drop("term", "pos")
    return found.select("doc_id", "text_hash", "item", "shift").distinct()


def exact_hits(docs: DataFrame, items: DataFrame, places: DataFrame, window: int, column: str = "text") -> DataFrame:
    """doc_id, text_hash, item_id and the document positions hit there, after comparing all words."""
    places = written(places, "places")
    some = places.select("doc_id", "text_hash").distinct()
    keyed = _keyed(docs, column)
    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["text_hash"] == b["text_hash"])
    texts = keyed.join(some, same(keyed, some), "left_semi").dropDuplicates(["doc_id", "text_hash"])
    met = places.join(texts, same(places, texts)).select(places["doc_id"], places["text_hash"], "item", "shift", F.col("words").alias("doc_words")).join(items, "item")
    equal = F.array_join(F.transform("words", lambda w, i: F.when(F.get("doc_words", F.col("shift") + i) == w, "1").otherwise("0")), "")
    length = F.least(F.size("words"), F.lit(window))
    met = met.select("doc_id", "text_hash", "item_id", "shift", F.size("words").alias("n"), length.alias("length"), equal.alias("equal"))
    starts = F.filter(F.sequence(F.lit(0), F.col("n") - F.col("length")), lambda j: F.substring(F.col("equal"), j + 1, F.col("length")) == F.expr("repeat('1', length)"))
    hit = F.array_distinct(F.flatten(F.transform("starts", lambda j: F.sequence(F.col("shift") + j, F.col("shift") + j + F.col("length") - 1))))
    return met.withColumn("starts", starts).filter(F.size("starts") > 0).select("doc_id", "text_hash", "item_id", hit.alias("positions"))


def phrase_matches(docs: DataFrame, items: DataFrame, window: int = 13, lists: int = LISTS, column: str = "text") -> DataFrame:
    """doc_id, text_hash, item_id, positions of all exact occurrences of the items' windows."""
    items = written(item_words(items, column), "items")
    terms = written(items.select(F.explode("words").alias("term")).distinct(), "terms")
    counts = written(term_counts(docs, terms, column), "term-counts")
    picks = written(rarest_terms(items, counts, window, lists), "picks")
    index = build_index(docs, written(picks.select(F.explode("picks.term").alias("term")).distinct(), "picked"), column)
    return exact_hits(docs, items, intersect(index, picks, lists), window, column)


def nearby_terms(items: DataFrame, counts: DataFrame, window: int, lists: int = LISTS) -> DataFrame:
    """Distinct picks of the windows: item and an array of (occurrences, term) of the rarest different terms that the corpus has.

    Terms that the corpus lacks are passed over; a window needs ``lists`` others, or all its words if it has fewer.
    """
    last = F.greatest(F.size("words") - window, F.lit(0))
    own = F.array_distinct(F.slice("words", F.col("first") + 1, window))
    places = items.select("item", "words", F.explode(F.sequence(F.lit(0), last)).alias("first")).select("item", "first", F.size(own).alias("different"), F.explode(own).alias("term"))
    found = places.join(counts, "term").groupBy("item", "first", "different").agg(F.slice(F.sort_array(F.collect_list(F.struct("occurrences", "term"))), 1, lists).alias("picks"))
    return found.filter(F.size("picks") >= F.least(F.col("different"), F.lit(lists))).select("item", "picks").distinct()


def proximity_matches(docs: DataFrame, items: DataFrame, window: int = 13, span: int = 20, lists: int = LISTS, column: str = "text") -> DataFrame:
    """doc_id, text_hash, item_id, pos: places of an item window's rarest term with the window's next rarest at most ``span`` words away.

    Order and other words don't matter, so rewordings are found that phrases miss. As ``span`` is at least ``window``, every
    exact copy of a window is found too, wherever its rare words stand and whatever words the corpus lacks elsewhere.
    """
    if span < window - 1:
        raise ValueError("span must cover a window")
    items = written(item_words(items, column), "items")
    terms = written(items.select(F.explode("words").alias("term")).distinct(), "terms")
    picks = written(nearby_terms(items, term_counts(docs, terms, column), window, lists), "picks")
    index = build_index(docs, written(picks.select(F.explode("picks.term").alias("term")).distinct(), "picked"), column)
    found = picks.withColumn("term", F.get("picks", F.lit(0))["term"]).join(index, "term").drop("term")
    near = index.select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h"), F.col("term").alias("_t"), F.col("pos").alias("_p"))
    for n in range(1, lists):
        term = F.coalesce(F.get("picks", F.lit(n))["term"], F.get("picks", F.lit(0))["term"])  # a short window asks for itself again
        meets = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_hash") == F.col("_h")) & (term == F.col("_t")) & (F.abs(F.col("pos") - F.col("_p")) <= span)
        found = found.join(near, meets, "left_semi")
    return found.join(items.select("item", "item_id"), "item").select("doc_id", "text_hash", "item_id", "pos").distinct()


def contamination(docs: DataFrame, items: DataFrame, window: int = 13, column: str = "text") -> DataFrame:
    """doc_id, text_hash, n_words, n_hit, n_items, items_sha256 and contaminated of every document."""
    hits = written(phrase_matches(docs, items, window, column=column), "hits")
    words = hits.select("doc_id", "text_hash", F.explode("positions").alias("pos")).distinct().groupBy("doc_id", "text_hash").agg(F.count("*").alias("n_hit"))
    listed = hits.select("doc_id", "text_hash", "item_id").distinct().groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    found = words.join(listed.withColumnRenamed("doc_id", "_d").withColumnRenamed("text_hash", "_h"), F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_hash") == F.col("_h"))).drop("_d", "_h")
    found = written(found, "found").withColumnRenamed("doc_id", "_d").withColumnRenamed("text_hash", "_h")
    counted = _keyed(docs, column).select("doc_id", "text_hash", word_count(F.col("words")).alias("n_words"))
    out = counted.join(found, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_hash") == F.col("_h")), "left")
    n_hit, items_of = F.coalesce("n_hit", F.lit(0).cast("long")), F.coalesce("items", F.array().cast("array<string>"))
    return out.select("doc_id", "text_hash", "n_words", n_hit.alias("n_hit"), F.size(items_of).cast("long").alias("n_items"),
                      F.sha2(F.array_join(items_of, ","), 256).alias("items_sha256"), ((n_hit > 0) & (n_hit * 20 >= F.col("n_words"))).alias("contaminated"))
