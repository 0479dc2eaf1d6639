"""Equal-width bins with right-closed edges, and grid cells made of two of them."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _rounded_edge(x: float, digits: int) -> float:
    if x == 0 or not math.isfinite(x):
        return x
    if abs(x) < 1:
        digits += -int(math.floor(math.log10(abs(x)))) - 1
    return round(x, digits)


@dataclass(frozen=True)
class Bins:
    low: float
    high: float
    count: int

    @property
    def width(self) -> float:
        return (self.high - self.low) / self.count

    def edges(self) -> list[float]:
        """Printed edges: the lowest is pushed out by 0.1 % of the range, and
        all keep as few digits (three or more) as keep them apart."""
        raw = [self.low + i * self.width for i in range(self.count + 1)]
        raw[-1] = self.high
        raw[0] -= 0.001 * (self.high - self.low)
        for digits in range(3, 20):
            edges = [_rounded_edge(x, digits) for x in raw]
            if len(set(edges)) == len(edges):
                return edges
        return raw

    def labels(self) -> list[str]:
        e = self.edges()
        return [f"({a}, {b}]" for a, b in zip(e, e[1:])]

    def index(self, x: Column) -> Column:
        """0-based bin; the division's rounding is corrected at the edges."""
        guess = F.least(F.greatest(F.ceil((x - self.low) / self.width), F.lit(1)), F.lit(self.count)) - 1
        above = (x > self.low + (guess + 1) * self.width) & (guess < self.count - 1)
        below = (x <= self.low + guess * self.width) & (guess > 0)
        index = F.when(above, guess + 1).when(below, guess - 1).otherwise(guess).cast("int")
        return F.when(x.isNotNull(), index)  # least/greatest would pass over a NULL

    def midpoint(self, x: Column) -> Column:
        e = self.edges()
        mids = F.array(*[F.lit((a + b) / 2) for a, b in zip(e, e[1:])])
        return F.element_at(mids, self.index(x) + 1)


def fit_bins(df: DataFrame, columns: list[str], count: int = 50) -> dict[str, Bins]:
    """Edges from one min/max aggregate."""
    row = df.agg(
        *[F.min(c).alias(f"lo_{c}") for c in columns], *[F.max(c).alias(f"hi_{c}") for c in columns]
    ).first()
    out = {}
    for c in columns:
        lo, hi = row[f"lo_{c}"], row[f"hi_{c}"]
        if lo is None:
            raise ValueError(f"no values to bin in {c}")
        if lo == hi:
            pad = 0.001 * abs(lo) if lo else 0.001
            lo, hi = lo - pad, hi + pad
        out[c] = Bins(float(lo), float(hi), count)
    return out


def spatial_bins(df: DataFrame, bins: dict[str, Bins]) -> DataFrame:
    """Adds day, bin indices and bin midpoints."""
    return df.withColumns({
        "time_bin": F.to_date("time"),
        "lat_bin": bins["latitude"].index(F.col("latitude")),
        "lon_bin": bins["longitude"].index(F.col("longitude")),
        "lat_bin_mid": bins["latitude"].midpoint(F.col("latitude")),
        "lon_bin_mid": bins["longitude"].midpoint(F.col("longitude")),
    })


def encode_cells(df: DataFrame, bins: dict[str, Bins]) -> DataFrame:
    """Adds ``lat_lon_bin_encoded``: rank of the cell's printed label among the
    cells in use. There are at most count² cells, so their list fits the driver."""
    lat, lon = bins["latitude"].labels(), bins["longitude"].labels()
    used = [(r.lat_bin, r.lon_bin) for r in df.select("lat_bin", "lon_bin").distinct().collect()
            if r.lat_bin is not None and r.lon_bin is not None]
    used.sort(key=lambda cell: f"{lat[cell[0]]}_{lon[cell[1]]}")
    codes = df.sparkSession.createDataFrame(
        [(*cell, code) for code, cell in enumerate(used)], "lat_bin int, lon_bin int, lat_lon_bin_encoded int"
    )
    return df.join(F.broadcast(codes), ["lat_bin", "lon_bin"], "left")
