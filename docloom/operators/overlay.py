"""Definition overlay: one record per definition gap, and the steps that resolve it.

``overlay_records(doc_id, gap_id, node_ord, canonical_concept, label, chapter, group_key, status, ...)``;
the nodes that depend on a record are link rows ``dependents(doc_id, gap_id, node_id)``.
Answers, reference definitions and URL checks are ordinary tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions.ordering import top_by, union_all
from docloom.functions.text import WS, first_sentences, is_blank, normalize_label, trim_ws
from docloom.operators.sections import CHAPTER, chapter_key, chapter_of, unit_chapter

# Statuses and answer vocabularies.
RESOLVED = ("external_definition", "source_recovery", "already_defined")
CONFIDENCE = ("high", "medium", "low")
KEY = ["doc_id", "gap_id"]
CUE = rf"(?i)(?:is defined as|is called|denotes|refers to)|(?:we|this text){WS}+(?:define|call)"
NONE = "string"
# A border between an ASCII word character and anything else; Java's own \b also counts other letters.
EDGE = r"(?:(?<=[A-Za-z0-9_])(?![A-Za-z0-9_])|(?<![A-Za-z0-9_])(?=[A-Za-z0-9_]))"


def build_overlay(nodes: DataFrame, node_units: DataFrame, members: DataFrame, concepts: DataFrame, units: DataFrame, *,
                  compose: bool = True) -> tuple[DataFrame, DataFrame]:
    """``overlay_records`` and ``dependents``. The label comes from the gap's last concept, else its need.

    Units without texts leave ``first_use_context`` null.
    """
    gaps = nodes.filter("kind = 'gap' and gap_type = 'definition'").select("doc_id", F.col("node_id").alias("gap_id"), "node_ord", "need")
    filled = members.filter("role = 'fills'").groupBy("doc_id", F.col("node_id").alias("gap_id")).agg(F.max("concept").alias("concept"))
    df = gaps.join(filled, KEY, "left").join(concepts.select("doc_id", "concept", F.col("label").alias("_l")), ["doc_id", "concept"], "left")
    links = node_units.select("doc_id", F.col("node_id").alias("gap_id"), "pos", "unit_id").join(gaps.select(*KEY), KEY, "left_semi")
    chapters = chapter_of(links, units, CHAPTER, item="gap_id")
    if "text" in units.columns:
        texts = links.join(units.select("doc_id", "unit_id", "text"), ["doc_id", "unit_id"]).filter("text <> ''")
        first = (top_by(texts, KEY, ["pos"], 2).groupBy(*KEY)
                 .agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"]).alias("first_use_context")))
        df = df.join(first, KEY, "left")
    else:
        df = df.withColumn("first_use_context", F.lit(None).cast("array<string>"))
    depends = (members.filter("role = 'requires'").select("doc_id", "concept", "node_id")
               .join(df.filter("concept is not null").select(*KEY, "concept"), ["doc_id", "concept"]).select(*KEY, "node_id"))
    totals = depends.groupBy(*KEY).agg(F.count(F.lit(1)).alias("dependent_count"))
    df = df.join(chapters, KEY, "left").join(totals, KEY, "left").fillna(0, ["dependent_count"])
    df = (df.withColumn("label", F.coalesce("_l", "need")).withColumn("chapter", F.coalesce("chapter", F.lit("Unscoped")))
          .withColumn("canonical_concept", normalize_label(F.col("label"), compose=compose)))
    records = df.select(*KEY, "node_ord", "canonical_concept", "label", "chapter", "dependent_count", "first_use_context",
                        F.concat("chapter", F.lit("\0"), "canonical_concept").alias("group_key"), F.lit("unresolved").alias("status"),
                        F.lit("Open: neither the source nor a citation defines it yet.").alias("reason"),
                        *[F.lit(None).cast(NONE).alias(c) for c in ("provenance", "confidence", "candidate_definition")])
    return records, depends


def overlay_groups(records: DataFrame) -> DataFrame:
    """One row per (chapter, canonical concept); members keep their ``group_key``, so no id list is gathered."""
    return records.groupBy("doc_id", "group_key", "canonical_concept", "chapter").agg(
        F.min_by("label", "node_ord").alias("label"), F.count(F.lit(1)).alias("gaps"), F.max("dependent_count").alias("dependent_count")
    ).withColumn("status", F.lit("pending"))


def sorted_groups(groups: DataFrame) -> DataFrame:
    return groups.orderBy(F.desc("dependent_count"), "chapter", "canonical_concept")


def _escaped(label: Column) -> Column:
    return F.regexp_replace(label, r"[.*+?^${}()|\[\]\\]", r"\\$0")


def _ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def triage_definitions(records: DataFrame, units: DataFrame, chapters: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Records a unit of their chapter defines in plain words become ``already_defined``; (gap, unit) matches too.

    ``chapters(doc_id, unit_id, context)`` where the units don't carry their heading paths.

    Only units with a definition cue take part. Of their texts only what a label can reach is shuffled: the 80 characters before
    a cue and the 200 after a "we define", each with one more that shows the border. A label meets a unit only through its
    last two ASCII words (or its only one), which must stand right before a cue or soon after a "we define".
    A label without ASCII words can only match between two ASCII words, so it meets the unit as that whole run.
    """
    key = ["doc_id", "_chapter"]
    words = F.regexp_extract_all(_ascii_lower(F.col("label")), F.lit(r"([a-z0-9_]+)"), F.lit(1))
    ending = F.array_join(F.when(F.size(words) > 1, F.slice(words, -2, 2)).otherwise(words), " ")
    labels = (records.filter((F.col("label") != "") & (F.length("label") <= 80)).select("doc_id", "chapter", "label").distinct()
              .withColumn("_chapter", chapter_key()).withColumn("token", F.coalesce(F.nullif(ending, F.lit("")), _ascii_lower(F.col("label")))))
    asked = (unit_chapter(units if chapters is None else chapters, CHAPTER).select("doc_id", "unit_id", chapter_key().alias("_chapter"))
             .join(labels.select(*key).distinct(), key, "left_semi"))
    # The one-row explode keeps the texts from being made once for the filter and once for the parts.
    cued = units.select("doc_id", "unit_ord", "unit_id", F.explode(F.array("text")).alias("text")).filter(F.col("text").rlike(CUE))
    # Read backwards, a match is a cue and then the up to 81 characters that end right before it.
    before = F.regexp_extract_all(F.reverse("text"), F.lit(rf"(?is){EDGE}(?=(?:sa denifed si|dellac si|setoned|ot srefer){WS}+([A-Za-z0-9_].{{0,80}}))"), F.lit(1))
    after = F.regexp_extract_all("text", F.lit(rf"(?is){EDGE}(?=((?:we|this text){WS}+(?:define|call){EDGE}.{{0,201}}))"), F.lit(1))
    parts = cued.select("doc_id", "unit_ord", "unit_id", F.transform(F.array_distinct(before), lambda t: F.reverse(t)).alias("_before"), F.array_distinct(after).alias("_after"))
    reached = parts.filter((F.size("_before") > 0) | (F.size("_after") > 0)).join(asked, ["doc_id", "unit_id"])
    ends = F.flatten(F.transform("_before", lambda t: F.regexp_extract_all(_ascii_lower(t), F.lit(r"(?<![a-z0-9_])(?=([a-z0-9_]+(?:[^a-z0-9_]+[a-z0-9_]+)?)\z)"), F.lit(1))))
    ends = F.transform(ends, lambda t: F.regexp_replace(t, "[^a-z0-9_]+", " "))
    # The last letter of "define" stays: a run may begin right behind it.
    windows = F.transform("_after", lambda t: F.regexp_replace(_ascii_lower(t), rf"\A(?:we|this text){WS}+(?:defin|cal)", ""))
    near = F.flatten(F.transform("_windows", lambda w: F.regexp_extract_all(w, F.lit(r"([a-z0-9_]+)"), F.lit(1))))
    runs = F.flatten(F.transform("_windows", lambda w: F.regexp_extract_all(w, F.lit(r"(?<=[a-z0-9_])([^a-z0-9_]+)(?=[a-z0-9_])"), F.lit(1))))
    pairs = F.filter(F.zip_with("_near", F.slice("_near", F.lit(2), F.greatest(F.size("_near"), F.lit(1))), lambda a, b: F.concat(a, F.lit(" "), b)), lambda t: t.isNotNull())
    tokens = (reached.withColumn("_windows", windows).withColumn("_near", near)
              .withColumn("token", F.explode(F.array_distinct(F.concat(ends, "_near", pairs, runs)))).drop("_windows", "_near"))
    term = _escaped(F.col("label"))
    ends_so = F.concat(F.lit("(?i)" + EDGE), term, F.lit(r"\z"))
    goes_on = F.concat(F.lit(rf"(?i)\A(?:we|this text){WS}+(?:define|call){EDGE}[^.]{{0,120}}{EDGE}"), term, F.lit(EDGE))
    found = (tokens.join(labels, [*key, "token"]).filter(F.exists("_before", lambda t: F.rlike(t, ends_so)) | F.exists("_after", lambda t: F.rlike(t, goes_on)))
             .select("doc_id", "chapter", "label", "unit_ord", "unit_id").distinct())
    best = top_by(found, ["doc_id", "chapter", "label"], ["unit_ord"], 2)
    matched = best.select("doc_id", "chapter", "label").distinct().withColumn("_hit", F.lit(True))
    out = records.join(matched, ["doc_id", "chapter", "label"], "left")
    hit = F.col("_hit").isNotNull()
    for column, value in (("status", "already_defined"), ("provenance", "source_definition_match"), ("confidence", "high"),
                          ("reason", "The chapter itself defines it.")):
        out = out.withColumn(column, F.when(hit, value).otherwise(F.col(column)))
    links = records.select(*KEY, "chapter", "label").join(best, ["doc_id", "chapter", "label"]).select(*KEY, F.col("rank").cast("bigint").alias("pos"), "unit_id")
    return out.drop("_hit").select(*records.columns), links


def is_resolved() -> Column:
    return F.col("status").isin(*RESOLVED)


def pending_proposals(records: DataFrame) -> DataFrame:
    return records.filter(~is_resolved() & (F.coalesce("candidate_definition", F.lit("")) == ""))


def exact_cover(items: DataFrame, requests: DataFrame, batch: list[str], key: str, good: Column) -> tuple[DataFrame, DataFrame]:
    """Items of the batches that answer every request exactly once with only good items; the other batches as issues."""
    asked = requests.groupBy(*batch).agg(F.count(F.lit(1)).alias("_asked"), F.count_distinct(key).alias("_asked_keys"))
    known = requests.select(*batch, key).distinct().withColumn("_known", F.lit(True))
    marked = items.withColumn("_good", F.coalesce(good, F.lit(False))).join(known, [*batch, key], "left")
    got = marked.groupBy(*batch).agg(F.count(F.lit(1)).alias("_items"), F.count_distinct(key).alias("_item_keys"),
                                     F.bool_and(F.col("_good") & F.col("_known").isNotNull()).alias("_ok"))
    verdict = asked.join(got, batch, "left").withColumn("_pass", F.coalesce(
        F.col("_ok") & (F.col("_items") == F.col("_asked")) & (F.col("_item_keys") == F.col("_asked")) & (F.col("_asked_keys") == F.col("_asked")), F.lit(False)))
    accepted = marked.drop("_good", "_known").join(verdict.filter("_pass").select(*batch), batch, "left_semi")
    issues = verdict.filter("not _pass").select(*batch, F.col("_asked").alias("requested"), F.coalesce("_items", F.lit(0)).alias("returned"))
    return accepted, issues


def validate_proposals(items: DataFrame, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    good = F.col("confidence").isin(*CONFIDENCE) & ~is_blank(F.col("definition")) & ~F.col("definition").rlike(r"[\\$]")
    accepted, issues = exact_cover(items, requests, ["doc_id", "batch_no"], "gap_id", good)
    return accepted.withColumn("definition", trim_ws(F.col("definition"))), issues


def apply_proposals(records: DataFrame, accepted: DataFrame) -> tuple[DataFrame, DataFrame]:
    new = accepted.select(*KEY, F.col("definition").alias("_d"), F.col("confidence").alias("_c"))
    df = records.join(new, KEY, "left")
    hit = F.col("_d").isNotNull()
    df = (df.withColumn("status", F.when(hit, "citation_needed").otherwise(F.col("status")))
          .withColumn("candidate_definition", F.coalesce("_d", "candidate_definition"))
          .withColumn("proposal_confidence", F.col("_c")).withColumn("proposal_provenance", F.when(hit, "model_unverified"))
          .withColumn("reason", F.when(hit, "A candidate is there, unchecked.").otherwise(F.col("reason"))).drop("_d", "_c"))
    open_ = ~is_resolved() & F.col("candidate_definition").isNull()
    summary = df.groupBy("doc_id").agg(F.count("candidate_definition").alias("candidates"), F.count_if(open_).alias("unresolved_without_candidate"))
    return df, summary


def validate_research(items: DataFrame, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``items`` carry ``evidence ARRAY<STRUCT<url, title, excerpt, claim>>``."""
    field = lambda e, name: F.coalesce(trim_ws(e[name]), F.lit(""))
    evidence = F.transform(F.coalesce("evidence", F.array()), lambda e: F.struct(*[field(e, n).alias(n) for n in ("url", "title", "excerpt", "claim")]))
    df = items.withColumn("evidence", evidence).withColumn("definition", F.coalesce(trim_ws(F.col("definition")), F.lit("")))
    complete = (F.size("evidence") > 0) & F.forall("evidence", lambda e: e["url"].rlike("^https?://") & (e["title"] != "") & (e["excerpt"] != "") & (e["claim"] != ""))
    external = F.col("status") == "external_definition"
    good = (F.col("status").isin("external_definition", "unresolved") & F.col("confidence").isin(*CONFIDENCE)
            & (~external | ((F.col("definition") != "") & ~F.col("definition").rlike(r"[\\$]") & complete)))
    return exact_cover(df, requests, ["doc_id", "batch_no"], "gap_id", good)


def attach_candidates(plan: DataFrame, records: DataFrame, proposals: DataFrame, start: int, end: int) -> DataFrame:
    """Planned research rows with current record fields and the candidate of the batch's preferred proposal set."""
    rows = plan.filter(F.col("batch_no").between(start, end))
    batch = ["doc_id", "batch_no"]
    preferred = proposals.groupBy(*batch).agg(F.min_by("variant", F.when(F.col("variant") == "strict", 0).otherwise(1)).alias("variant"))
    chosen = proposals.join(preferred, [*batch, "variant"], "left_semi").groupBy(*batch, "gap_id").agg(F.max_by("definition", "pos").alias("candidate"))
    return rows.join(records.drop("candidate_definition"), KEY, "left").join(chosen, [*batch, "gap_id"], "left")


def evidence_check(evidence: DataFrame, url_checks: DataFrame) -> DataFrame:
    """``evidence(doc_id, gap_id, pos, status, url, ...)`` plus reachable and http_status, each URL looked up once."""
    wanted = evidence.filter("status = 'external_definition'").select("url").distinct()
    checked = wanted.join(url_checks.dropDuplicates(["url"]), "url").select("url", "reachable", "http_status")
    return evidence.join(checked, "url", "left")


def apply_research(records: DataFrame, items: DataFrame, checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Research answers and their looked-up evidence applied to the records; the evidence becomes their citations.

    ``checked(doc_id, gap_id, pos, url, reachable, http_status)`` and, where given, title, excerpt and claim.
    """
    said = [c for c in ("url", "title", "excerpt", "claim") if c in checked.columns]
    look = F.struct(F.coalesce("reachable", F.lit(False)).alias("reachable"), F.col("http_status").alias("status")).alias("verification")
    sources = F.transform(F.sort_array(F.collect_list(F.struct("pos", F.struct(*said, look).alias("c")))), lambda x: x["c"])  # an answer bounds them
    reach = checked.groupBy(*KEY).agg(F.bool_and(F.coalesce("reachable", F.lit(False))).alias("_reach"), sources.alias("_cited"))
    new = items.select(*KEY, F.col("status").alias("_s"), F.col("definition").alias("_d"), F.col("confidence").alias("_c"), F.col("reason").alias("_r")).join(reach, KEY, "left")
    df = records.join(new, KEY, "left")
    hit, external = F.col("_s").isNotNull(), F.col("_s") == "external_definition"
    verified = external & F.coalesce("_reach", F.lit(False))
    values = {
        "status": F.when(verified, "external_definition").when(F.col("_s") == "unresolved", "unresolved").otherwise("citation_needed"),
        "provenance": F.when(verified, "verified_external_source").when(external, "model_citation_unverified"),
        "reason": F.when(verified | ~external, F.col("_r")).otherwise("A cited address did not answer."),
        "confidence": F.col("_c"), "candidate_definition": F.nullif(F.col("_d"), F.lit(""))}
    for column, value in values.items():
        df = df.withColumn(column, F.when(hit, value).otherwise(F.col(column)))
    before = F.col("citations") if dict(records.dtypes).get("citations") == dict(df.dtypes)["_cited"] else F.lit(None)
    df = df.withColumn("citations", F.when(hit, F.col("_cited")).otherwise(before)).drop("_s", "_d", "_c", "_r", "_reach", "_cited")
    return df, overlay_summary(df)


def search_query(label: Column, chapter: Column) -> Column:
    """Label plus the chapter's own name, as external searches are keyed."""
    name = F.when(chapter == "Unscoped", "").otherwise(F.regexp_replace(chapter, rf"(?i)\AChapter{WS}+\d+{WS}+[—-]{WS}+", ""))
    return trim_ws(F.concat(label, F.lit(" "), name))


def _usable(definitions: DataFrame) -> DataFrame:
    return (definitions.filter((F.coalesce("type", F.lit("")) != "disambiguation") & (F.coalesce("extract", F.lit("")) != "") & (F.coalesce("title", F.lit("")) != ""))
            .dropDuplicates(["title"]))


OPEN = "status in ('unresolved', 'citation_needed')"
CLAIM = "Defines "


def _update_external(records: DataFrame, found: DataFrame, key: list[str]) -> DataFrame:
    """``found(key, definition, new_confidence, url, source_title, source)`` applied to open records; ``_hit`` tells which."""
    df = records.join(found, key, "left").withColumn("_hit", F.expr(OPEN) & F.col("definition").isNotNull())
    values = {"status": F.lit("external_definition"), "provenance": F.lit("verified_external_source"), "confidence": F.col("new_confidence"),
              "candidate_definition": F.col("definition"), "reason": F.lit("Definition recovered from a reachable external reference.")}
    verification = F.struct(F.lit(True).alias("reachable"), F.lit(200).alias("status"), F.col("source").alias("source"))
    citation = F.struct(F.col("url").alias("url"), F.col("source_title").alias("title"), F.col("definition").alias("excerpt"),
                        F.concat(F.lit(CLAIM), "label", F.lit(".")).alias("claim"), verification.alias("verification"))
    df = df.withColumn("_open", F.expr(OPEN)).withColumn("citations", F.when(F.col("_hit"), F.array(citation)))
    for column, value in values.items():
        df = df.withColumn(column, F.when(F.col("_hit"), value).otherwise(F.col(column)))
    return df.drop("definition", "new_confidence", "url", "source_title", "source")


def resolve_external(records: DataFrame, definitions: DataFrame, search_hits: DataFrame, *, page_address: str = "", compose: bool = True) -> DataFrame:
    """Exact title, else the first usable of three search hits; one lookup per (chapter, label) of a document.

    ``definitions(title, extract, type, url)``, ``search_hits(query, rank, title)``. ``page_address`` is what a title without a
    url is appended to.
    """
    keyed = records.withColumn("_k", normalize_label(F.col("label"), compose=compose))
    lookups = keyed.filter(OPEN).groupBy("doc_id", "chapter", "_k").agg(F.min_by("label", "node_ord").alias("_l"))
    usable = _usable(definitions)
    # The reference is asked for distinct (label, chapter) pairs only, whatever the number of records behind them.
    asked = lookups.select(F.col("_l").alias("label"), "chapter").distinct().withColumn("query", search_query(F.col("label"), F.col("chapter")))
    exact = asked.select("label").distinct().join(usable.withColumn("label", F.col("title")), "label")
    missing = asked.join(exact.select("label"), "label", "left_anti")
    ranked = (search_hits.filter(F.col("rank") <= 3).join(missing.select("query").distinct(), "query", "left_semi").join(usable, "title")
              .groupBy("query").agg(F.min_by(F.struct("title", "extract", "url"), "rank").alias("_u")))
    found = union_all(asked.join(exact, "label").select("label", "chapter", "title", "extract", "url"),
                      missing.join(ranked, "query").select("label", "chapter", "_u.title", "_u.extract", "_u.url"))
    a, b = normalize_label(F.col("label"), compose=compose), normalize_label(F.col("title"), compose=compose)
    found = (found.withColumn("definition", first_sentences(F.col("extract"))).filter("definition <> ''")
             .withColumn("new_confidence", F.when((a == b) | a.contains(b) | b.contains(a), "high").otherwise("medium"))
             .withColumn("url", F.coalesce("url", F.concat(F.lit(page_address), F.url_encode(F.replace(F.col("title"), F.lit(" "), F.lit("_")))))))
    answer = (lookups.withColumnRenamed("_l", "label").join(found, ["label", "chapter"])
              .select("doc_id", "chapter", "_k", "definition", "new_confidence", "url", F.col("title").alias("source_title"), F.lit("encyclopedia").alias("source")))
    df = _update_external(keyed, answer, ["doc_id", "chapter", "_k"])
    missed = F.col("_open") & ~F.col("_hit") & (F.col("status") == "unresolved")
    return (df.withColumn("status", F.when(missed, "citation_needed").otherwise(F.col("status")))
            .withColumn("reason", F.when(F.col("_open") & ~F.col("_hit"), F.coalesce(F.nullif(F.col("reason"), F.lit("")), F.lit("No outside source was found.")))
                        .otherwise(F.col("reason"))).drop("_k", "_hit", "_open"))


def resolve_fallback(records: DataFrame, abstracts: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Sourced abstracts by query, then a dictionary by label, always at medium confidence; else unresolved.

    ``abstracts(query, heading, text, url)``, ``dictionary(title, extract, type, url)``.
    """
    asked = records.filter(OPEN).select("label", "chapter").distinct().withColumn("query", search_query(F.col("label"), F.col("chapter")))
    sourced = abstracts.filter((F.coalesce("text", F.lit("")) != "") & (F.coalesce("url", F.lit("")) != "")).dropDuplicates(["query"])
    first = asked.join(sourced, "query").select("label", "chapter", F.lit(1).alias("_p"), F.col("text").alias("body"), "url",
                                                F.coalesce(F.nullif(F.col("heading"), F.lit("")), "label").alias("source_title"), F.lit("abstract").alias("source"))
    second = asked.join(_usable(dictionary).withColumn("label", F.col("title")), "label").select(
        "label", "chapter", F.lit(2).alias("_p"), F.col("extract").alias("body"), "url", F.concat("title", F.lit(" — Dictionary")).alias("source_title"), F.lit("dictionary").alias("source"))
    best = first.unionByName(second).groupBy("label", "chapter").agg(F.min_by(F.struct("body", "url", "source_title", "source"), "_p").alias("_b")).select("label", "chapter", "_b.*")
    best = best.withColumn("definition", first_sentences(F.col("body"))).withColumn("new_confidence", F.lit("medium")).drop("body")
    df = _update_external(records, best, ["label", "chapter"])
    missed = F.col("_open") & ~F.col("_hit")
    return (df.withColumn("status", F.when(missed, "unresolved").otherwise(F.col("status")))
            .withColumn("reason", F.when(missed, "No definition found in the encyclopedia, the sourced abstracts or the dictionary.").otherwise(F.col("reason")))
            .drop("_hit", "_open"))


def overlay_summary(records: DataFrame) -> DataFrame:
    return records.groupBy("doc_id").agg(
        F.count_if(is_resolved()).alias("resolved"), F.count_if(~is_resolved()).alias("unresolved"),
        *[F.count_if(F.col("status") == s).alias(s) for s in ("already_defined", "citation_needed", "external_definition", "source_recovery")])


def latest_answers(answers: DataFrame) -> DataFrame:
    """``answers(gap_key, answer, ts, answer_id)``: the latest answer per key, combined before the shuffle."""
    return answers.groupBy("gap_key").agg(F.max_by(F.struct("answer", "ts", "answer_id"), F.struct("ts", "answer_id")).alias("_a")).select("gap_key", "_a.*")


def upsert_answers(records: DataFrame, answers: DataFrame) -> DataFrame:
    """Records keyed by ``gap_key`` with the latest answer; keys without a record are ignored."""
    new = latest_answers(answers).select("gap_key", F.col("answer").alias("_a"), F.col("ts").alias("_t"))
    df = records.join(new, "gap_key", "left")
    newer = F.col("_t").isNotNull() & (F.col("answered_at").isNull() | (F.col("_t") > F.col("answered_at")))
    return (df.withColumn("answer", F.when(newer, F.col("_a")).otherwise(F.col("answer")))
            .withColumn("answered_at", F.when(newer, F.col("_t")).otherwise(F.col("answered_at"))).drop("_a", "_t"))
