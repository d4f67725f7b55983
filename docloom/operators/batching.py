"""Request batches out of Spark and response texts back in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions.ordering import with_position
from docloom.functions.text import strip_fence


def plan_batches(df: DataFrame, size: int, by: list[str], order: list[str]) -> DataFrame:
    """Consecutive batches of ``size`` rows inside each ``by`` key."""
    df = with_position(df, by, order, "_pos")
    return df.withColumn("batch_no", (F.floor((F.col("_pos") - 1) / size) + 1).cast("bigint")).drop("_pos")


def build_requests(batched: DataFrame, by: list[str], order: list[str], fields: list[Column]) -> DataFrame:
    """One JSON array payload per batch; a group holds at most one batch."""
    rows = F.array_sort(F.collect_list(F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                                                F.struct(*fields).alias("_x"))))
    return (batched.groupBy(*by, "batch_no")
            .agg(F.to_json(F.transform(rows, lambda r: r["_x"]), {"ignoreNullFields": "false"}).alias("payload"),
                 F.count(F.lit(1)).alias("items")))


def ingest_responses(responses: DataFrame, keys: list[str], field: str, *,
                     brace_slice: bool = False) -> tuple[DataFrame, DataFrame]:
    """Response texts to (``keys``, pos, item VARIANT) rows, and one issue row per unusable response."""
    # Of a key that an object repeats, the last value counts.
    responses.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    body = strip_fence(F.col("response"))
    parsed = responses.withColumn("_body", body).withColumn("_v", F.try_parse_json("_body"))
    if brace_slice:
        outer = F.regexp_extract("_body", r"(\{[\s\S]*\})", 1)
        parsed = parsed.withColumn("_v", F.coalesce("_v", F.try_parse_json(outer)))
    parsed = parsed.withColumn("_items", F.try_variant_get("_v", f"$.{field}", "array<variant>"))
    items = (parsed.filter(F.col("_items").isNotNull())
             .select(*keys, F.posexplode("_items").alias("pos", "item"))
             .withColumn("pos", (F.col("pos") + 1).cast("bigint")))
    issues = parsed.filter(F.col("_items").isNull()).select(
        *keys, F.when(F.col("_v").isNull(), "bad_json").otherwise("missing_field").alias("category"))
    return items, issues


def _type_of(item: Column, path: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(item, path, "variant"))


def item_string(item: Column, path: str) -> Column:
    """A string member; any other type counts as absent."""
    return F.when(_type_of(item, path) == "STRING", F.try_variant_get(item, path, "string"))


def item_number(item: Column, path: str) -> Column:
    """A numeric member; a number written as a string counts as absent."""
    return F.when(_type_of(item, path).rlike("BIGINT|DOUBLE|DECIMAL|FLOAT"), F.try_variant_get(item, path, "double"))


def item_strings(item: Column, path: str) -> Column:
    """The string elements of an array member."""
    values = F.coalesce(F.try_variant_get(item, path, "array<variant>"), F.array().cast("array<variant>"))
    return F.filter(F.transform(values, lambda v: item_string(v, "$")), lambda s: s.isNotNull())
