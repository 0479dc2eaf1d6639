"""Cleaning: geometry, filters, data-driven column pruning, base tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.functions.scalar import degrees_to_km, epoch_millis, nan_to_null, region_of, wkt_ordinate
from faultline.operators.joins import combine_first

ORDINATES = ("longitude", "latitude", "elevation")
# Columns the catalogue clean-up always drops / always keeps.
ALWAYS_DROP = ("tsunami", "updated", "sig")
ALWAYS_KEEP = ("magType", "detail")
FEED_EXTRAS = (
    "tz", "url", "detail", "felt", "cdi", "mmi", "alert", "status", "tsunami", "sig",
    "net", "code", "ids", "sources", "nst", "title", "types", "gap", "updated",
)
DEFAULT_IMPUTE_COLUMNS = ("latitude", "longitude", "dmin", "gap", "rms")


def normalise_nan(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in every floating column."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: nan_to_null(F.col(c)) for c in floats}) if floats else df


def numeric_columns(df: DataFrame, wanted: list[str] | None = None) -> list[str]:
    """Wanted (or all) columns that exist and are numeric; booleans are not."""
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    return numeric if wanted is None else [c for c in wanted if c in numeric]


def non_numeric_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in numeric_columns(df)]


def expand_coordinates(df: DataFrame, geo: str = "geo") -> DataFrame:
    """Three ordinate columns; a missing or non-3-D geometry gives three NULLs."""
    if geo not in df.columns:
        raise KeyError(f"no geometry column {geo!r}")
    return df.withColumns({name: wkt_ordinate(F.col(geo), i) for i, name in enumerate(ORDINATES)})


def coordinate_report(df: DataFrame, geo: str = "geo") -> DataFrame:
    """(total, null_geo, invalid, valid) in one pass."""
    valid = wkt_ordinate(F.col(geo), 0).isNotNull()
    return df.agg(
        F.count("*").alias("total"),
        F.count_if(F.col(geo).isNull()).alias("null_geo"),
        F.count_if(F.col(geo).isNotNull() & ~valid).alias("invalid"),
        F.count_if(valid).alias("valid"),
    )


def check_coordinates(df: DataFrame, geo: str = "geo") -> None:
    """Raises when there is no usable geometry at all."""
    row = coordinate_report(df, geo).first()
    if row["valid"] == 0:
        raise ValueError("every geometry is missing" if row["null_geo"] == row["total"] else "no valid 3-D point")


def reviewed(df: DataFrame) -> DataFrame:
    return df.filter(F.col("status") == "reviewed")


def earthquakes(df: DataFrame) -> DataFrame:
    return df.filter(F.col("type") == "earthquake").drop("type")


def prune_table(
    df: DataFrame, max_null: float = 0.3, drop: tuple[str, ...] = ALWAYS_DROP, keep: tuple[str, ...] = ALWAYS_KEEP
) -> DataFrame:
    """Decision per column: (column, null_frac, is_string, dropped)."""
    missing = [c for c in keep if c not in df.columns]
    if missing:
        raise KeyError(f"columns needed later are absent: {missing}")
    strings = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    nulls = df.agg(F.count("*").alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    share = {c: F.when(F.col("_n") > 0, F.col(c) / F.col("_n")).otherwise(F.lit(0.0)) for c in df.columns}
    return nulls.select(F.inline(F.array(*[
        F.struct(
            F.lit(c).alias("column"),
            share[c].alias("null_frac"),
            F.lit(c in strings).alias("is_string"),
            (F.lit(c not in keep) & ((share[c] > max_null) | F.lit(c in strings or c in drop))).alias("dropped"),
        )
        for c in df.columns
    ])))


def prune(df: DataFrame, **options) -> DataFrame:
    """Drops what ``prune_table`` marks; its one row per column is read here."""
    dropped = [r["column"] for r in prune_table(df, **options).filter("dropped").collect()]
    return df.drop(*dropped)


def refine_catalog(df: DataFrame, geo: str | None = "geo") -> DataFrame:
    """Coordinates, reviewed events only, pruned columns, ``index`` named ``idx``."""
    if geo is not None:
        check_coordinates(df, geo)
        df = expand_coordinates(df, geo)
    out = prune(reviewed(df))
    if "index" in out.columns:
        out = out.withColumnRenamed("index", "idx")
    if "idx" not in out.columns:
        raise KeyError("neither 'idx' nor 'index' found")
    return out


def refine_patch(df: DataFrame) -> DataFrame:
    return df.drop("Unnamed: 0").withColumnRenamed("old_idx", "idx")


def two_source_base(catalog: DataFrame, patch: DataFrame, with_time: bool = False, geo: str | None = "geo") -> DataFrame:
    """Refined catalogue with missing values patched from the engineered file."""
    out = combine_first(refine_catalog(catalog, geo), refine_patch(patch)).drop("nst", "detail")
    return out if with_time else out.drop("time", "time_ms")


def notebook_base(catalog: DataFrame, patch: DataFrame) -> DataFrame:
    """Patched reviewed events that keep the text columns, plus the region."""
    kept = ("magType", "detail", "place", "geo")
    refined = prune(reviewed(expand_coordinates(catalog)), keep=kept)
    out = combine_first(refined, refine_patch(patch)).drop("detail", "geo", "nst", "time", "time_ms")
    return out.withColumn("region", region_of(F.col("place")))


def model_base(df: DataFrame, with_time: bool = False, geo: str | None = None) -> DataFrame:
    """Refined catalogue without nst/detail; without times, rows with any NULL go too."""
    out = refine_catalog(df, geo).drop("nst", "detail")
    return out if with_time else out.drop("time", "time_ms").na.drop("any")


def feed_events(df: DataFrame) -> DataFrame:
    """Plain feed clean-up: fixed drop list, earthquakes, timestamps, coordinates."""
    out = expand_coordinates(earthquakes(df.drop(*FEED_EXTRAS))).drop("place", "geo")
    return out.withColumn("time", epoch_millis(F.col("time_ms"))).drop("time_ms")


def convert_dmin(df: DataFrame) -> DataFrame:
    if "dmin" in df.columns:
        return df.withColumn("dmin_km", degrees_to_km(F.col("dmin"))).drop("dmin")
    if "dmin_km" in df.columns:
        return df
    raise KeyError("neither 'dmin' nor 'dmin_km' found")


# --- predicates -------------------------------------------------------------

def null_count(columns: list[str]) -> Column:
    total = F.lit(0)
    for c in columns:
        total = total + F.col(c).isNull().cast("int")
    return total


def has_link(detail: str = "detail") -> Column:
    return F.coalesce(F.length(F.trim(F.col(detail))) > 0, F.lit(False))


def needs_detail(columns=("nst", "dmin", "gap")) -> Column:
    return has_link() & (null_count(list(columns)) >= 1)


def any_zero(columns: list[str]) -> Column:
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.coalesce(F.col(c) == 0, F.lit(False))
    return hit


def below_average(df: DataFrame, column: str) -> DataFrame:
    mean = df.agg(F.avg(column)).first()[0]
    return df.filter(F.col(column) < mean)


def time_range(df: DataFrame, start: str, end: str, time: str = "time") -> DataFrame:
    """Closed range; the literals reach the scan as pushed filters."""
    kind = df.schema[time].dataType.typeName()
    return df.filter(F.col(time).between(F.lit(start).cast(kind), F.lit(end).cast(kind)))


def harmonise_types(df: DataFrame, drop: tuple[str, ...] = ("time_bin",)) -> DataFrame:
    """Integers widen to BIGINT, floats to DOUBLE with NULLs set to the column mean."""
    from faultline.operators.profile import fill_numeric

    casts = {}
    floats = []
    for f in df.schema:
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            casts[f.name] = F.col(f.name).cast("bigint")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            floats.append(f.name)
    out = df.withColumns(casts) if casts else df
    return fill_numeric(out, floats, "mean").drop(*drop)
