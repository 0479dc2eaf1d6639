"""Ingestion windows, landed GeoJSON, CSV and relational scans."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.operators.joins import recombine

MIN_MAGNITUDE = 2.5

# Properties of a feed feature that the catalogue keeps.
FEATURE_PROPERTIES = T.StructType([
    T.StructField(n, t) for n, t in [
        ("mag", T.DoubleType()), ("place", T.StringType()), ("time", T.LongType()), ("updated", T.LongType()), ("tz", T.DoubleType()),
        ("url", T.StringType()), ("detail", T.StringType()), ("felt", T.DoubleType()), ("cdi", T.DoubleType()), ("mmi", T.DoubleType()),
        ("alert", T.StringType()), ("status", T.StringType()), ("tsunami", T.IntegerType()), ("sig", T.IntegerType()),
        ("net", T.StringType()), ("code", T.StringType()), ("ids", T.StringType()), ("sources", T.StringType()), ("types", T.StringType()),
        ("nst", T.DoubleType()), ("dmin", T.DoubleType()), ("rms", T.DoubleType()), ("gap", T.DoubleType()),
        ("magType", T.StringType()), ("type", T.StringType()), ("title", T.StringType()),
    ]
])
COLLECTION = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("features", T.ArrayType(T.StructType([
        T.StructField("id", T.StringType()),
        T.StructField("properties", FEATURE_PROPERTIES),
        T.StructField("geometry", T.StructType([
            T.StructField("type", T.StringType()), T.StructField("coordinates", T.ArrayType(T.DoubleType()))])),
    ]))),
])


def request_text(start: Column, end: Column, min_magnitude: float = MIN_MAGNITUDE) -> Column:
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    return F.concat(F.lit("starttime="), day(start), F.lit("%2000:00:00&endtime="), day(end),
                    F.lit(f"%2000:00:00&minmagnitude={min_magnitude}&orderby=time"))


def ingestion_windows(years: DataFrame, months: int = 6) -> DataFrame:
    """(period, starts, ends, request) for one row of (start_year, end_year, now).

    Steps of months·30 days from January 1 of the start year, clipped to ``now`` and
    to the end of the end year. A later window replaces an earlier one of the same
    month key.
    """
    step = F.make_dt_interval(days=F.lit(months * 30))
    span = years.select(
        F.make_timestamp_ntz(F.coalesce("start_year", F.year("now") - 5), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)).alias("a"),
        F.least(F.make_timestamp_ntz(F.coalesce("end_year", F.year("now")) + 1, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)),
                F.col("now")).alias("b"))
    rows = span.select(F.explode(F.sequence("a", "b", step)).alias("starts"), "b").filter("starts < b").select(
        F.concat(F.lit("period_"), F.date_format("starts", "yyyyMM")).alias("period"),
        "starts", F.least(F.col("starts") + step, F.col("b")).alias("ends"))
    last = rows.groupBy("period").agg(F.max(F.struct("starts", "ends")).alias("w")).select("period", "w.*")
    return last.withColumn("request", request_text(F.col("starts"), F.col("ends")))


def read_geojson(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """One row per feature of landed feature collections, one document per line or
    per file; broken documents give no rows."""
    docs = spark.read.schema(COLLECTION).option("multiLine", whole_files).json(path)
    at = lambda i: F.get(F.col("f.geometry.coordinates"), F.lit(i))
    return docs.select(F.explode("features").alias("f")).select(
        F.col("f.id").alias("id"), "f.properties.*", at(0).alias("longitude"), at(1).alias("latitude"), at(2).alias("elevation"))


def write_geojson(df: DataFrame, path: str, per_document: int = 500, key: str = "idx") -> None:
    """Feature collections of at most ``per_document`` consecutive keys, one per line."""
    names = [f.name for f in FEATURE_PROPERTIES if f.name in df.columns]
    feature = F.struct(
        F.lit("Feature").alias("type"), F.col(key).cast("string").alias("id"),
        F.struct(*[F.col(n).cast(FEATURE_PROPERTIES[n].dataType).alias(n) for n in names]).alias("properties"),
        F.struct(F.lit("Point").alias("type"), F.array("longitude", "latitude", "elevation").alias("coordinates")).alias("geometry"))
    docs = df.groupBy(F.floor(F.col(key) / per_document)).agg(F.collect_list(feature).alias("features"))
    docs.select(F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), "features")).alias("value")).write.text(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def write_csv(df: DataFrame, path: str, by_year: str | None = None) -> None:
    """CSV with a header and no index; optionally one folder per year of a time column."""
    options = {"header": True, "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    if by_year is None:
        df.write.options(**options).csv(path)
    else:
        df.withColumn("year", F.year(by_year)).write.partitionBy("year").options(**options).csv(path)


def read_periods(spark: SparkSession, paths: list[str]) -> DataFrame | None:
    """Union by name of the periods that have landed; None when none has."""
    found = []
    for path in paths:
        try:
            found.append(spark.read.parquet(path))
        except AnalysisException:
            continue   # nothing landed for this period
    return recombine(*found) if found else None


def fetch_or_cache(spark: SparkSession, cache: str, paths: list[str]) -> DataFrame | None:
    """The saved table if there is one, else all landed periods, saved."""
    try:
        return spark.read.parquet(cache)
    except AnalysisException:
        df = read_periods(spark, paths)
        if df is None:
            return None
        df.write.parquet(cache)
        return spark.read.parquet(cache)


def fetch_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table; absent and empty tables are errors."""
    if not spark.catalog.tableExists(name):
        raise RuntimeError(f"table {name} does not exist")
    df = spark.table(name)
    if df.isEmpty():
        raise ValueError(f"table {name} is empty")
    return df


def read_jdbc(spark: SparkSession, url: str, table: str, key: str = "idx", low: int = 0, high: int = 1_000_000_000,
              partitions: int = 64, rows_per_fetch: int = 10_000, **options) -> DataFrame:
    """Relational scan in ``partitions`` parallel key ranges."""
    return spark.read.jdbc(
        url, table, column=key, lowerBound=low, upperBound=high, numPartitions=partitions,
        properties={"fetchsize": str(rows_per_fetch), **options})
