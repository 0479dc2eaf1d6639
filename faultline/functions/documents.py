"""Look-ups in nested JSON documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.functions.scalar import numeric_text
from faultline.session import written

DEFAULT_KEYS = ("azimuthal-gap", "num-stations-used", "minimum-distance")
ALL_KEYS = ("depth",) + DEFAULT_KEYS
DEFAULT_PRODUCTS = ("origin", "phase-data")
KEY_OF = {"nst": "num-stations-used", "dmin": "minimum-distance", "gap": "azimuthal-gap"}

_PRODUCTS = "MAP<STRING, ARRAY<STRUCT<properties: MAP<STRING, STRING>>>>"
_FEATURE = f"properties: STRUCT<products: {_PRODUCTS}>"
_DOCUMENT = f"STRUCT<type: STRING, {_FEATURE}, features: ARRAY<STRUCT<{_FEATURE}>>>"


def with_detail_values(df: DataFrame, body: str, keys: dict[str, str], products: tuple[str, ...] | None = DEFAULT_PRODUCTS) -> DataFrame:
    """Adds column → first value found for its key: products in the given order,
    entries in document order. ``products=None`` looks at all of them; a broken
    document gives NULLs. Parsing is a step of its own, so that it runs once per row."""
    doc = F.col("_doc")
    collection = (doc["type"] == "FeatureCollection") & (F.size(doc["features"]) > 0)
    found = F.when(collection, F.get(doc["features"], 0)["properties"]["products"]).otherwise(
        doc["properties"]["products"]
    )
    if products is None:
        lists = F.map_values(F.col("_found"))
    else:
        lists = F.array(*[F.try_element_at("_found", F.lit(p)) for p in products])
    entries = F.flatten(F.filter(lists, lambda x: x.isNotNull()))

    def first(key: str) -> Column:
        hits = F.filter("_entries", lambda e: F.coalesce(F.map_contains_key(e["properties"], key), F.lit(False)))
        return numeric_text(F.try_element_at(F.get(hits, 0)["properties"], F.lit(key)))

    return (
        df.withColumn("_doc", F.from_json(body, _DOCUMENT))
        .withColumn("_found", found).withColumn("_entries", entries)
        .withColumns({c: first(k) for c, k in keys.items()})
        .drop("_doc", "_found", "_entries")
    )


def key_paths(df: DataFrame, body: str) -> DataFrame:
    """(path, n): how often every key path occurs, at any depth. Array steps read ``[]``.

    Documents are parsed once. A level's values are written and opened for the next, until a level holds no object or
    array any more; what a level costs shrinks with what is left of the documents.
    """
    level = df.select(F.lit("$").alias("path"), F.try_parse_json(F.col(body)).alias("v")).filter("v IS NOT NULL")
    counts = []
    while True:
        opened = level.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("v").outer())).select(
            F.concat("path", F.when(F.col("key").isNull(), "[]").otherwise(F.concat(F.lit("."), "key"))).alias("path"),
            F.col("value").alias("v"))
        level = written(opened, "json-level")
        if level.isEmpty():
            break
        counts.append(level.groupBy("path").agg(F.count("*").alias("n")))  # a path belongs to one level
    if not counts:
        return df.sparkSession.createDataFrame([], "path string, n bigint")
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return out
