"""Encoders, scalers, data-driven transforms and the feature tables built of them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.functions import binning
from faultline.functions.scalar import cyclic_time, safe_cbrt, safe_log, safe_sqrt
from faultline.operators.clean import convert_dmin, harmonise_types, model_base, numeric_columns
from faultline.operators.ordered import ROW, lay_out, with_row_index
from faultline.operators.profile import adjusted_skew, correlation, daily, fill_numeric, skew_table
from faultline.session import written
from faultline.operators.windows import events_last, rolling_rows, split_sequential, time_since_last

MIN_LABEL_SHARE = 0.003
# Columns the model table scales.
SCALED = ("dmin", "dmin_km", "elevation", "gap", "latitude", "longitude", "rms")
EVENT_COLUMNS = ("idx", "time", "mag", "rms", "gap", "dmin", "longitude", "latitude", "elevation")


@dataclass(frozen=True)
class Scale:
    """Fitted (shift, width) per column; x → (x − shift) / width."""
    params: dict[str, tuple[float | None, float | None]]
    flat: float | None  # value for columns of zero width

    def _apply(self, c: str) -> Column:
        shift, width = self.params[c]
        if shift is None:
            return F.lit(None).cast("double")
        if not width:
            return F.when(F.col(c).isNotNull(), F.lit(self.flat))
        return (F.col(c) - F.lit(shift)) / F.lit(width)

    def transform(self, df: DataFrame) -> DataFrame:
        here = [c for c in self.params if c in df.columns]
        return df.withColumns({c: self._apply(c) for c in here}) if here else df

    def inverse(self, df: DataFrame) -> DataFrame:
        here = [c for c in self.params if c in df.columns]
        return df.withColumns({c: F.col(c) * F.lit(self.params[c][1]) + F.lit(self.params[c][0]) for c in here})

    def table(self, spark) -> DataFrame:
        return spark.createDataFrame([(c, *p) for c, p in self.params.items()], "column string, shift double, width double")


def fit_zscore(df: DataFrame, columns: list[str]) -> Scale:
    """Mean and population deviation; zero deviation scales to NULL."""
    columns = numeric_columns(df, columns)
    row = df.agg(*[F.avg(c).alias(f"a_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]).first()
    return Scale({c: (row[f"a_{c}"], row[f"s_{c}"]) for c in columns}, None)


def fit_minmax(df: DataFrame, columns: list[str]) -> Scale:
    """To (0, 1); constant columns scale to 0."""
    row = df.agg(*[F.min(c).cast("double").alias(f"a_{c}") for c in columns],
                 *[(F.max(c) - F.min(c)).cast("double").alias(f"s_{c}") for c in columns]).first()
    return Scale({c: (row[f"a_{c}"], row[f"s_{c}"]) for c in columns}, 0.0)


def frequent_labels(df: DataFrame, column: str = "magType", share: float = MIN_LABEL_SHARE) -> list[str]:
    """Labels with at least ``share`` of all rows, most frequent first. At most 1/share come back."""
    if column not in df.columns:
        raise AttributeError(f"no column {column!r}")
    total = df.count()
    rows = df.groupBy(column).count().filter(
        F.col(column).isNotNull() & (F.col("count") >= F.lit(share) * total)
    ).orderBy(F.desc("count"), column).collect()
    return [r[column] for r in rows]


def onehot_names(df: DataFrame, column: str, labels: list[str]) -> dict[str, str]:
    """Label → its column: the label itself, unless a column of the table or an earlier label has that name in any
    case; then column_label, with a number if that is taken, too."""
    taken = {c.lower() for c in df.columns if c != column} | {"others"}
    out = {}
    for lb in labels:
        if lb == "others":
            continue
        name, n = lb, 1
        while name.lower() in taken:
            name, n = f"{column}_{lb}" + (f"_{n}" if n > 1 else ""), n + 1
        taken.add(name.lower())
        out[lb] = name
    return out


def hybrid_onehot(df: DataFrame, column: str = "magType", labels: list[str] | None = None) -> DataFrame:
    """0/1 column per frequent label, named by ``onehot_names``; everything else, NULL included, is ``others``."""
    labels = frequent_labels(df, column) if labels is None else labels
    flags = {name: F.coalesce(F.col(column) == lb, F.lit(False)).cast("int") for lb, name in onehot_names(df, column, labels).items()}
    known = F.coalesce(F.col(column).isin(labels), F.lit(False)) if labels else F.lit(False)
    kept = [F.col(f"`{c}`") for c in df.columns if c != column and c.lower() != "others"]
    return df.select(*kept, *[f.alias(n) for n, f in flags.items()], (~known).cast("int").alias("others"))


def missing_flags(df: DataFrame) -> DataFrame:
    return hybrid_onehot(df).withColumns({
        "dmin_missing": F.col("dmin").isNull().cast("int"), "gap_missing": F.col("gap").isNull().cast("int")})


def label_encode(df: DataFrame, column: str, name: str) -> DataFrame:
    """Rank of the label in ascending order, 0-based; NULL has none."""
    ranks = with_row_index(lay_out(df.select(column).filter(F.col(column).isNotNull()).distinct(), column))
    return df.join(ranks.select(column, F.col(ROW).cast("int").alias(name)), column, "left")


def skew_decisions(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, skew, transform): above 1 the log, above ½ the root."""
    return skew_table(df, columns).withColumn(
        "transform", F.when(F.col("skew") > 1, "log").when(F.col("skew") > 0.5, "sqrt").otherwise("none"))


def skew_transform(df: DataFrame, columns: list[str] | None = None, fit_on: DataFrame | None = None, exclude: tuple[str, ...] = ()) -> DataFrame:
    """Applies ``skew_decisions``; one row per column is read here."""
    columns = [c for c in numeric_columns(df, columns) if c not in exclude]
    chosen = {r["column"]: r["transform"] for r in skew_decisions(df if fit_on is None else fit_on, columns).collect()}
    apply = {"log": safe_log, "sqrt": safe_sqrt}
    new = {c: apply[chosen[c]](F.col(c).cast("double")) for c in columns if chosen[c] in apply}
    return df.withColumns(new) if new else df


def fixed_transform(df: DataFrame, log: bool = True, square: bool = True, columns: tuple[str, ...] = ("dmin_km", "elevation"), convert: bool = True) -> DataFrame:
    """Log, square root or cube root of named columns, after the unit change."""
    out = convert_dmin(df) if convert else df
    fn = safe_log if log else safe_sqrt if square else safe_cbrt
    return out.withColumns({c: fn(F.col(c)) for c in columns if c in out.columns})


def correlated_columns(df: DataFrame, columns: list[str], limit: float = 0.8) -> DataFrame:
    """(position, column, dropped): dropped when correlated above the limit with an
    earlier column, dropped ones included."""
    place = F.create_map(*[x for i, c in enumerate(columns) for x in (F.lit(c), F.lit(i))])
    m = correlation(df, columns)
    hit = (place[F.col("col_b")] < place[F.col("col_a")]) & (F.abs("r") > limit)
    return m.groupBy(F.col("col_a").alias("column")).agg(F.max(hit).alias("dropped")).select(
        place[F.col("column")].alias("position"), "column", "dropped")


def drop_correlated(df: DataFrame, keep: tuple[str, ...] = ("idx",), limit: float = 0.8) -> DataFrame:
    columns = [c for c in numeric_columns(df) if c not in keep]
    gone = [r["column"] for r in correlated_columns(df, columns, limit).filter("dropped").collect()]
    return df.drop(*gone)


# --- composed tables ----------------------------------------------------------

def event_features(df: DataFrame, filler: str = "mean", bins: int = 50) -> DataFrame:
    """Pause before each event, filled numerics, grid cell and the figures of its day."""
    timed = written(time_since_last(df.select(*[c for c in EVENT_COLUMNS if c in df.columns])), "timed")  # read for the means, the bins, the days and the rows
    filled = fill_numeric(timed, [c for c in numeric_columns(timed) if c != "idx"], filler)
    edges = binning.fit_bins(filled, ["latitude", "longitude"], bins)
    celled = binning.encode_cells(binning.spatial_bins(filled, edges), edges).drop("lat_bin", "lon_bin")
    return celled.join(daily(filled).withColumnRenamed("day", "time_bin"), "time_bin", "left")


def training_table(df: DataFrame, filler: str = "mean") -> DataFrame:
    """Event features, rolling windows per cell, harmonised types, correlated
    columns removed, cyclic time added."""
    rolled = written(rolling_rows(event_features(df, filler), ("lat_bin_mid", "lon_bin_mid")))  # read three times
    return cyclic_time(drop_correlated(harmonise_types(rolled), keep=("idx",)), "time")


def model_table(df: DataFrame, target: str = "mag", fit_on_train: bool = False, skip_onehot: bool = False) -> DataFrame:
    """Encoded, split, transformed and scaled table with a ``split`` column.

    The skew transform is chosen per split, one-hot columns included, unless asked
    otherwise; scaling is fitted on the training rows.
    """
    base = convert_dmin(model_base(df))
    labels = frequent_labels(base)
    parts = split_sequential(hybrid_onehot(base, labels=labels))
    features = [c for c in numeric_columns(parts) if c not in ("idx", target)]
    exclude = {*onehot_names(base, "magType", labels).values(), "others"} if skip_onehot else set()
    parts = written(parts, "split")  # read for the skews, for the scale and for the result
    curved = [c for c in features if c not in exclude]
    skews = {r["split"]: r for r in parts.groupBy("split").agg(*[adjusted_skew(c).alias(c) for c in curved]).collect()}

    def shaped(c: str) -> Column:
        """The column under the transform that the skew of its split asks for."""
        x = F.col(c).cast("double")
        out = x
        for split in skews:
            skew = skews["train" if fit_on_train and "train" in skews else split][c]
            changed = safe_log(x) if skew is not None and skew > 1 else safe_sqrt(x) if skew is not None and skew > 0.5 else None
            if changed is not None:
                out = F.when(F.col("split") == split, changed).otherwise(out)
        return out

    done = parts.select(*[shaped(c).alias(c) if c in curved else F.col(c).cast("double").alias(c) if c in features else F.col(c) for c in parts.columns])
    return fit_zscore(done.filter("split = 'train'"), [c for c in SCALED if c in features]).transform(done)


def legacy_features(df: DataFrame) -> DataFrame:
    """Forward events_last counts, cyclic time v1, everything min-max scaled."""
    table = cyclic_time(events_last(time_since_last(df)), "time", version=1)
    table = fill_numeric(table, [c for c in numeric_columns(table) if c != "idx"], "zero")
    columns = [c for c in numeric_columns(table) if c != "idx"]
    return fit_minmax(table, columns).transform(table.withColumns({c: F.col(c).cast("double") for c in columns}))


def dmin_table(df: DataFrame) -> DataFrame:
    """Rows with gap or dmin known: log transforms, z-scores fitted on the
    training rows, one-hot without ``others``; ``dmin_km`` is the target."""
    base = fixed_transform(df.filter(~(F.col("gap").isNull() & F.col("dmin").isNull())))
    columns = [c for c in numeric_columns(base) if c not in ("idx", "dmin_km")]
    parts = split_sequential(base)
    scaled = fit_zscore(parts.filter("split = 'train'"), columns).transform(parts)
    return hybrid_onehot(scaled).drop("others")
