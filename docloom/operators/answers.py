"""Answer texts of every phase to typed rows.

What a phase expects is declared once (``Listing``): which lists an answer holds, the typed members of their objects, and
lists inside these. ``read_answers`` parses a text once and yields one table per list, with the position of each item and
the names of members that were given with another type. An answer that is no JSON or lacks a list yields an issue instead.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions.ordering import cut_lineage, union_all
from docloom.functions.text import strip_fence

#: Spark types of the members, and the variant types they are read from.
TYPES = {"string": ("string", "STRING"), "number": ("double", "BIGINT|DOUBLE|DECIMAL.*|FLOAT"), "integer": ("bigint", "BIGINT|DOUBLE|DECIMAL.*|FLOAT"),
         "reference": ("bigint", "BIGINT|DOUBLE|DECIMAL.*|FLOAT"), "boolean": ("boolean", "BOOLEAN"), "strings": ("array<string>", "ARRAY.*"), "integers": ("array<bigint>", "ARRAY.*")}
SAFE = float(2 ** 53 - 1)
NOWHERE = -1


@dataclass(frozen=True)
class Listing:
    """A list of objects: its member name, ``column: (member, type)``, and named lists inside each object.

    Types: ``string``, ``number``, ``integer``, ``boolean`` (null unless of that type), ``strings`` (the string elements),
    ``integers`` (other elements become -1, an index that no item has) and ``reference`` (null only if the answer says
    null; missing or of another type it is -1).
    """
    member: str
    fields: dict[str, tuple[str, str]]
    inner: dict[str, "Listing"] = field(default_factory=dict)
    required: bool = True


def _one(member: str, fields: str, inner: dict | None = None, required: bool = True) -> Listing:
    """``fields``: ``column member type`` or ``member type``, separated by commas."""
    parts = [f.split() for f in fields.split(",")]
    return Listing(member, {p[0]: (p[-2], p[-1]) for p in parts}, inner or {}, required)


# The members of each phase's answers.
EXTRACTION = {
    "nodes": _one("nodes", "kind string, text string, need string, gap_type gapType string, source_unit_ids sourceUnitIds strings, defines strings, requires strings, mentions strings, fills strings"),
    "edges": _one("edges", "src from integer, dst to integer, relation string, reason string", required=False),
    "frames": _one("evidenceFrames", "claim integer, evidence integers, warrant_gap warrantGap reference, limitations integers", required=False)}
SCORES = {"scores": _one("scores", "node_id id string, score number, reasons strings")}
_IDEA = "text string, score densityScore number"
DECOMPOSITION = {"items": _one("items", "parent_id parentId string", {"splits": _one("splits", _IDEA, required=False), "expansions": _one("expansions", f"type string, {_IDEA}", required=False)})}
INJECTION = {"items": _one("items", "target_id targetId string", {"injections": _one("injections", f"type string, {_IDEA}, relation string, reason string", required=False)})}
RESOLUTION = {"items": _one("items", "gap_id gapId string", {"nodes": _one("nodes", f"{_IDEA}, confidence string", required=False)})}
PROPOSAL = {"items": _one("items", "gap_id gapId string, definition string, confidence string")}
RESEARCH = {"items": _one("items", "gap_id gapId string, status string, definition string, confidence string, reason string",
                          {"evidence": _one("evidence", "url string, title string, excerpt string, claim string", required=False)})}
TEACHING = {"items": _one("items", "record_id recordId string", {"units": _one("units", "role string, basis string, text string, requires strings, citation_required citationRequired boolean")})}
REWRITE = {"items": _one("items", "block index integer, paragraphs strings")}


def _kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def _member(item: Column, name: str) -> Column:
    return F.try_variant_get(item, f"$.{name}", "variant")


def _whole(value: Column) -> Column:
    """A JSON number without a fraction that doubles hold exactly, else null."""
    number = F.try_variant_get(value, "$", "double")
    return F.when(_kind(value).rlike(f"^({TYPES['integer'][1]})$") & (number == F.floor(number)) & (F.abs(number) <= SAFE), number.cast("bigint"))


def _elements(value: Column) -> Column:
    return F.coalesce(F.try_variant_get(value, "$", "array<variant>"), F.array().cast("array<variant>"))


def _typed(value: Column, kind: str) -> Column:
    if kind == "integer":
        return _whole(value)
    if kind == "reference":
        return F.when(_kind(value) == "VOID", F.lit(None)).otherwise(F.coalesce(_whole(value), F.lit(NOWHERE).cast("bigint")))
    if kind == "integers":
        return F.transform(_elements(value), lambda x: F.coalesce(_whole(x), F.lit(NOWHERE).cast("bigint")))
    if kind == "strings":
        texts = F.transform(_elements(value), lambda x: F.when(_kind(x) == "STRING", F.try_variant_get(x, "$", "string")))
        return F.filter(texts, lambda s: s.isNotNull())
    return F.when(_kind(value).rlike(f"^({TYPES[kind][1]})$"), F.try_variant_get(value, "$", TYPES[kind][0]))


def _objects(value: Column, listing: Listing) -> Column:
    """The list's elements as structs: typed members, ``wrong`` (members of another type, "*" for no object), inner lists."""
    def one(item):
        members = {name: _member(item, m) for name, (m, _) in listing.fields.items()}
        wrong = [F.when(members[name].isNotNull() & (_kind(members[name]) != "VOID") & ~_kind(members[name]).rlike(f"^({TYPES[kind][1]})$"), F.lit(m))
                 for name, (m, kind) in listing.fields.items()]
        wrong += [F.when(F.coalesce(~_kind(_member(item, x.member)).rlike("^ARRAY"), F.lit(x.required)), F.lit(x.member)) for x in listing.inner.values()]
        faults = F.when(_kind(item).startswith("OBJECT"), F.array_compact(F.array(*wrong))).otherwise(F.array(F.lit("*")))
        return F.struct(*[_typed(members[name], kind).cast(TYPES[kind][0]).alias(name) for name, (_, kind) in listing.fields.items()], faults.alias("wrong"),
                        *[_objects(_member(item, x.member), x).alias(f"_{name}") for name, x in listing.inner.items()])
    return F.transform(_elements(value), one)


def read_answers(responses: DataFrame, keys: list[str], spec: dict[str, Listing], *, brace_slice: bool = False) -> dict[str, DataFrame]:
    """One table per list of ``spec`` and per inner list, and ``issues``.

    ``responses(keys, response)``. Tables of lists have (keys, pos, members, wrong), those of inner lists (keys, item_pos, the outer
    members, pos, members, wrong). ``brace_slice`` tries the outermost braces of a text that is no JSON as a whole.
    ``issues(keys, category, detail)``: ``bad_json`` or ``missing_list`` for answers without items, ``absent_list`` where only a
    list is lacking that others don't need. Texts are parsed once, into a checkpoint.
    """
    # Of a key that an object repeats, the last value counts.
    parse = lambda text: F.expr("try_parse_json(_body)") if text is None else F.try_parse_json(text)
    body = responses.select(*keys, strip_fence(F.col("response")).alias("_body"))
    value = parse(None)
    if brace_slice:
        value = F.coalesce(value, parse(F.regexp_extract("_body", r"(\{[\s\S]*\})", 1)))
    parsed = body.select(*keys, F.explode(F.array(value)).alias("_v"))
    has = lambda x: _kind(_member(F.col("_v"), x.member)).startswith("ARRAY")
    lacking = lambda required: F.array_compact(F.array(F.lit(None).cast("string"), *[F.when(~F.coalesce(has(x), F.lit(False)), F.lit(x.member)) for x in spec.values() if x.required == required]))
    rows = cut_lineage(parsed.select(*keys, F.when(F.col("_v").isNull(), F.array(F.lit(""))).otherwise(lacking(True)).alias("_missing"), lacking(False).alias("_absent"),
                                     *[_objects(_member(F.col("_v"), x.member), x).alias(name) for name, x in spec.items()]))
    category = F.when(F.size("_missing") == 0, "absent_list").when(F.get("_missing", F.lit(0)) == "", "bad_json").otherwise("missing_list")
    bad = rows.filter((F.size("_missing") > 0) | (F.size("_absent") > 0))
    issues = bad.select(*keys, category.alias("category"), F.array_join(F.when(F.size("_missing") > 0, F.col("_missing")).otherwise(F.col("_absent")), ",").alias("detail"))
    good, out = rows.filter(F.size("_missing") == 0), {}
    for name, listing in spec.items():
        items = good.select(*keys, F.posexplode(name).alias("_p", "_x"))
        own = [f"_x.{c}" for c in listing.fields]
        out[name] = items.select(*keys, (F.col("_p") + 1).cast("bigint").alias("pos"), *own, "_x.wrong")
        for inner, x in listing.inner.items():
            each = items.select(*keys, (F.col("_p") + 1).cast("bigint").alias("item_pos"), *own, F.posexplode(F.col(f"_x._{inner}")).alias("_q", "_y"))
            out[inner] = each.select(*keys, "item_pos", *listing.fields, (F.col("_q") + 1).cast("bigint").alias("pos"), *[f"_y.{c}" for c in x.fields], "_y.wrong")
    return {**out, "issues": issues}


def type_verdicts(tables: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """(keys, list, item_pos, pos, member): every member that an answer gave with another type than its list declares."""
    none = F.lit(None).cast("bigint")
    return union_all(*[df.select(*keys, F.lit(name).alias("list"), (F.col("item_pos") if "item_pos" in df.columns else none).alias("item_pos"), "pos", F.explode("wrong").alias("member"))
                       for name, df in tables.items() if "wrong" in df.columns])


def extraction_items(responses: DataFrame) -> dict[str, DataFrame]:
    """``nodes``, ``edges`` and ``frames`` of the extraction operators from ``responses(doc_id, chunk_id, response)``.

    Indexes start at 0, as references inside an answer do. ``broken(doc_id, chunk_id, reason)`` are answers that the strict
    check rejects whatever their other items are: an item that is no object, or no list of edges or frames. ``issues`` as read.
    """
    keys = ["doc_id", "chunk_id"]
    tables = read_answers(responses, keys, EXTRACTION, brace_slice=True)
    strange = union_all(*[tables[t].filter(F.array_contains("wrong", "*")).select(*keys) for t in EXTRACTION]).withColumn("reason", F.lit("not_an_object"))
    absent = tables["issues"].filter("category = 'absent_list'").select(*keys, F.col("category").alias("reason"))
    broken = union_all(strange, absent).groupBy(*keys).agg(F.min("reason").alias("reason"))
    # An edge or frame that is no object keeps its position: salvage reports it. A node that is none only leaves a hole.
    out = {t: tables[t].withColumn("idx", F.col("pos") - 1) for t in EXTRACTION}
    out["nodes"] = out["nodes"].filter(~F.array_contains("wrong", "*"))
    return {**{t: df.drop("pos", "wrong") for t, df in out.items()}, "issues": tables["issues"], "broken": broken}
