"""URL rules by a sort-merge range join.

The canonical key of a rule or url is its host with labels reversed, then its path. A rule's path is a prefix, so on its
host it is the interval from the path to the path followed by byte FF (which UTF-8 never holds); the intervals of a host
are nested or apart. A url meets the intervals of its host and of every parent host that has rules. Interval ends and
urls are sorted by key and swept: a start puts its rule on the stack, an end takes it off. Since the stack below a rule
is always the same, an event carries the top that it leaves (at an end, the next outer rule), and a url takes the last
event's. A host's urls are swept in as many parts as their number asks for, each with the host's intervals.

Defined cases: a null url or one without ``://`` has an empty host and path and meets no rule. Of equal rules with
different verdicts, block stands. A repeated row stays as often as given. An empty table gives no rows; without rules
every url gets the default. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.common import LOWER, UPPER, written

#: Urls of one host that one task sweeps: a partition's share, and so many at least.
SWEEP_ROWS = 200
_SPLIT = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def url_host(url: str = "url") -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, _SPLIT, 1), F.lit("")), UPPER, LOWER)


def url_path(url: str = "url") -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, _SPLIT, 2), F.lit(""))


def rule_events(rules: DataFrame) -> DataFrame:
    """Starts and ends of the rules' intervals: rhost, key, kind 0 and the rule on top of the stack after the event."""
    rhost = F.array_join(F.reverse(F.split("host", r"\.")), ".")
    rules = (rules.filter(F.col("host").isNotNull() & F.col("path").isNotNull() & F.col("verdict").isNotNull())
             .groupBy(rhost.alias("rhost"), F.concat("host", "path").alias("rule"), "path").agg(F.max("verdict").alias("verdict")))
    top = F.struct(F.length("rule").alias("size"), F.length("rhost").alias("host_size"), "rule", "verdict")
    rules = rules.select("rhost", "path", top.alias("top"))
    inner = rules.select("rhost", F.col("path").alias("inner"), F.explode(F.transform(F.sequence(F.lit(0), F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n))).alias("path"))
    outer = (inner.filter("path <> inner").join(rules, ["rhost", "path"]).groupBy("rhost", "inner").agg(F.max_by("top", F.length("path")).alias("below"))
             .withColumnRenamed("inner", "path"))
    none = F.struct(F.lit(0).alias("size"), F.lit(0).alias("host_size"), F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    ends = rules.join(outer, ["rhost", "path"], "left").select(
        "rhost", F.concat(F.col("path").cast("binary"), F.unhex(F.lit("FF"))).alias("key"), F.lit(0).alias("kind"), F.coalesce("below", none).alias("top"))
    return rules.select("rhost", F.col("path").cast("binary").alias("key"), F.lit(0).alias("kind"), "top").unionByName(ends)


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", sweep_rows: int = SWEEP_ROWS) -> DataFrame:
    """page_id, host, path, rule and verdict of every row; the longest rule that fits decides."""
    events = written(rule_events(rules), "url-rules")
    deepest = events.agg(F.max(F.size(F.split("rhost", r"\.")))).first()[0] or 0
    rows = pages.groupBy("page_id", "url").agg(F.count("*").alias("copies"))
    labels = F.reverse(F.split("host", r"\."))
    levels = F.transform(F.sequence(F.lit(1), F.least(F.size("labels"), F.lit(max(deepest, 1)))), lambda n: F.array_join(F.slice("labels", 1, n), "."))
    urls = (rows.select("page_id", "url", url_host().alias("host"), url_path().cast("binary").alias("key")).withColumn("labels", labels)
            .select("page_id", "url", "key", F.explode(levels).alias("rhost")).join(events.select("rhost").distinct(), "rhost", "left_semi"))
    urls = written(urls, "url-levels")
    sweep_rows = max(sweep_rows, urls.count() // int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    parts = urls.groupBy("rhost").agg(F.ceil(F.count("*") / F.lit(sweep_rows)).cast("int").alias("parts"))
    swept = (urls.join(parts, "rhost").select("rhost", F.pmod(F.xxhash64("page_id", "url"), "parts").cast("int").alias("part"), "key", F.lit(1).alias("kind"), "page_id", "url")
             .unionByName(events.join(parts, "rhost").select("rhost", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "key", "kind", "top"), allowMissingColumns=True))
    sweep = Window.partitionBy("rhost", "part").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = swept.withColumn("top", F.last("top", True).over(sweep)).filter("kind = 1 and top.rule is not null").select("page_id", "url", "top")
    judged = rows.unionByName(met, allowMissingColumns=True).groupBy("page_id", "url").agg(F.max("copies").alias("copies"), F.max("top").alias("top"))
    return (judged.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
            .select("page_id", url_host().alias("host"), url_path().alias("path"), F.col("top.rule").alias("rule"), F.coalesce("top.verdict", F.lit(default)).alias("verdict")))
