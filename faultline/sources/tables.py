"""Table names from file paths, atomic loads, clustered layout."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NAME_LIMIT = 63


def shortened(name: Column) -> Column:
    """Names over 63 characters keep 54 and get a hash suffix."""
    return F.when(F.length(name) > NAME_LIMIT, F.concat(F.substring(name, 1, 54), F.lit("_"), F.substring(F.sha2(name, 256), 1, 8))
                  ).otherwise(name)


def table_name(relative_path: Column) -> Column:
    """Destination table of a file below its source folder."""
    bare = F.regexp_replace(relative_path, r"\.[^./]*$", "")
    clean = F.btrim(F.regexp_replace(F.lower(F.regexp_replace(bare, "/", "_")), "[^a-z0-9_]+", "_"), F.lit("_"))
    return shortened(F.when(clean.rlike("^[0-9]"), F.concat(F.lit("data_"), clean)).otherwise(clean))


def discover_imports(spark: SparkSession, root: str, prepared: str, raw_schema: str = "raw", prepared_schema: str = "prepped") -> DataFrame:
    """(path, schema, table) of the CSV files below ``root``; only names are read."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").load(root).select("path")
    )
    rel = F.regexp_replace("path", rf"^.*?{re.escape(root.rstrip('/'))}/", "")
    inside = rel.startswith(prepared.rstrip("/") + "/")
    out = files.select(
        "path", F.when(inside, prepared_schema).otherwise(raw_schema).alias("schema"),
        table_name(F.when(inside, F.substring(rel, F.lit(len(prepared.rstrip("/")) + 2), F.length(rel))).otherwise(rel)).alias("table"))
    if out.isEmpty():
        raise FileNotFoundError(f"no CSV files below {root}")
    check_destinations(out)
    return out


def duplicate_destinations(imports: DataFrame) -> DataFrame:
    return imports.groupBy("schema", "table").agg(F.count("*").alias("n")).filter("n > 1")


def check_destinations(imports: DataFrame) -> None:
    clash = duplicate_destinations(imports).first()
    if clash:
        raise ValueError(f"several files map to {clash['schema']}.{clash['table']}")


def _beside(target: str, what: str) -> str:
    """A name of the target's schema that is not in use."""
    schema, _, table = target.rpartition(".")
    return f"{schema}{'.' if schema else ''}_{what}_{table}_{uuid.uuid4().hex[:12]}"


def _rename(spark: SparkSession, old: str, new: str) -> None:
    spark.sql(f"ALTER TABLE {old} RENAME TO {new}")


def staged_load(df: DataFrame, target: str) -> DataFrame:
    """Loads next to the target, then swaps; the catalog places the files.

    The old table is renamed, not dropped, before the new one takes its name, and gets it back if that fails; it goes
    only after the swap. A load that fails or has no rows leaves the target as it was.
    """
    if not target.strip():
        raise ValueError("a load needs a table name")
    spark = df.sparkSession
    staging, backup = _beside(target, "staging"), _beside(target, "backup")
    try:
        df.write.format("parquet").saveAsTable(staging)
        if spark.table(staging).isEmpty():
            raise ValueError("no rows to load")
        replaces = spark.catalog.tableExists(target)
        if replaces:
            _rename(spark, target, backup)
        try:
            _rename(spark, staging, target)
        except Exception:
            if replaces:
                _rename(spark, backup, target)
            raise
        if replaces:
            spark.sql(f"DROP TABLE {backup}")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {staging}")
    return spark.table(target)


def load_all(imports: DataFrame, read: Callable[[str], DataFrame]) -> DataFrame:
    """(schema, table, n): every discovered file loaded into its table, schemas created first.

    One staged load after the other; a file that fails stops the job and leaves the tables before it loaded, its own as
    it was. ``imports`` has one row per file (see ``discover_imports``).
    """
    spark = imports.sparkSession
    check_destinations(imports)
    files = imports.orderBy("schema", "table").collect()
    for schema in sorted({f["schema"] for f in files}):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")
    done = []
    for f in files:
        name = f"{f['schema']}.{f['table']}"
        done.append((f["schema"], f["table"], staged_load(read(f["path"]), name).count()))
    return spark.createDataFrame(done, "schema string, table string, n bigint")


def write_clustered(df: DataFrame, path: str, *order: str) -> None:
    """Range-partitioned and sorted files, so that min/max statistics skip files.
    ``order`` ends in a unique column, so that a hot value is spread."""
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(path)


def write_bucketed(df: DataFrame, table: str, column: str, buckets: int = 64) -> None:
    """Bucketed table for repeated joins on ``column``."""
    df.write.bucketBy(buckets, column).sortBy(column).mode("overwrite").saveAsTable(table)
