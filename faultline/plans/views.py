"""Catalogue views over the ``events`` table, as expressions valid in Spark SQL and DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# One expression per column of the catalogue view.
CATALOG = {
    "idx": "event_id",
    "time": "ts",
    "time_ms": "1704067200000 + event_id * 259123",
    "updated": "event_id * 1000",
    "status": "CASE WHEN event_id % 10 = 3 THEN 'automatic' ELSE 'reviewed' END",
    "type": "CASE WHEN event_id % 25 = 7 THEN 'quarry blast' ELSE 'earthquake' END",
    "magType": "CASE WHEN event_id % 400 = 1 THEN 'mh' WHEN event_id % 500 = 2 THEN 'mwb' "
               "WHEN event_id % 4 = 0 THEN 'ml' WHEN event_id % 4 = 1 THEN 'mb' "
               "WHEN event_id % 4 = 2 THEN 'md' ELSE 'mww' END",
    "mag": "CAST(250 + (event_id * 37) % 600 AS DOUBLE) / 100",
    "rms": "CAST((event_id * 53) % 150 AS DOUBLE) / 100",
    "gap": "CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END",
    "dmin": "CASE WHEN event_id % 5 = 0 THEN NULL "
            "ELSE CAST(((event_id * 61) % 977) * ((event_id * 61) % 977) AS DOUBLE) / 65536 END",
    "nst": "CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id % 120 END",
    "felt": "CASE WHEN event_id % 10 = 0 THEN event_id % 50 ELSE NULL END",
    "tsunami": "event_id % 2",
    "sig": "(event_id * 11) % 900",
    "longitude": "CAST((event_id * 7919) % 36000 AS DOUBLE) / 100 - 180",
    "latitude": "CAST((event_id * 104729) % 18000 AS DOUBLE) / 100 - 90",
    "elevation": "value",
    "place": "concat(CAST(event_id % 90 AS VARCHAR(9)), ' km N of ', event_type, ', R', "
             "CAST(user_id % 12 AS VARCHAR(9)))",
    "detail": "CASE WHEN event_id % 11 = 4 THEN '' ELSE concat('https://example.org/detail/', "
              "CAST(event_id - event_id % 2 AS VARCHAR(20)), '.geojson') END",
    "geo": "CASE WHEN event_id % 101 = 6 THEN NULL WHEN event_id % 97 = 5 THEN 'POINT (1 2)' "
           "ELSE concat('POINT Z (', CAST((event_id * 7919) % 360 - 180 AS VARCHAR(20)), ' ', "
           "CAST((event_id * 104729) % 180 - 90 AS VARCHAR(20)), ' ', CAST(event_id % 70 AS VARCHAR(20)), ')') END",
}

# Engineered patch file: one row per event, two thirds of its ids unknown to the
# catalogue, one column the catalogue lacks.
PATCH = {
    "old_idx": "event_id * 3",
    "nst": "event_id % 99",
    "dmin": "CASE WHEN event_id % 2 = 0 THEN CAST(event_id % 40 AS DOUBLE) / 8 ELSE NULL END",
    "gap": "CAST(event_id % 360 AS DOUBLE)",
    "patch_batch": "event_id % 5",
}

# One landed JSON document per detail link; some documents are broken.
DETAIL = {
    "detail": "concat('https://example.org/detail/', CAST(event_id * 2 AS VARCHAR(20)), '.geojson')",
    "body": "CASE WHEN event_id % 13 = 5 THEN 'service unavailable' ELSE "
            "concat('{\"properties\":{\"products\":{\"origin\":[{\"properties\":{\"azimuthal-gap\":\"', "
            "CAST(event_id % 360 AS VARCHAR(9)), '\",\"minimum-distance\":\"0.', "
            "CAST(event_id % 9 + 1 AS VARCHAR(9)), '\"}},{\"properties\":{\"azimuthal-gap\":\"999\"}}],"
            "\"phase-data\":[{\"properties\":{\"num-stations-used\":\"', "
            "CAST(event_id % 99 AS VARCHAR(9)), '\",\"depth\":\"', CAST(event_id % 70 AS VARCHAR(9)), '.5\"}}]}}}') END",
}

NONFINITE = {
    "idx": "event_id",
    "x": "CASE WHEN event_id % 50 = 0 THEN CAST('NaN' AS DOUBLE) WHEN event_id % 50 = 1 THEN CAST('Infinity' AS DOUBLE) "
         "WHEN event_id % 50 = 2 THEN CAST('-Infinity' AS DOUBLE) WHEN event_id % 50 = 3 THEN NULL ELSE value END",
    "label": "event_type",
}


def _sql(columns: dict[str, str]) -> str:
    return "SELECT " + ", ".join(f"{e} AS {n}" for n, e in columns.items()) + " FROM events"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _view(spark: SparkSession, sf_dir: str, columns: dict[str, str]) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*[f"{e} AS {n}" for n, e in columns.items()])


def catalog(spark, sf_dir):
    return _view(spark, sf_dir, CATALOG)


def patch(spark, sf_dir):
    return _view(spark, sf_dir, PATCH)


def detail(spark, sf_dir):
    return _view(spark, sf_dir, DETAIL)


def nonfinite(spark, sf_dir):
    return _view(spark, sf_dir, NONFINITE)


# The same chain the library's refine_catalog / model_base build, in SQL.
_MORE = {
    "cat": _sql(CATALOG),
    "patch": _sql(PATCH),
    "detail_docs": _sql(DETAIL),
    "nonfinite": _sql(NONFINITE),
    "rev": "SELECT * FROM cat WHERE status = 'reviewed'",
    "base": "SELECT idx, time, mag, magType, rms, gap, dmin, longitude, latitude, elevation FROM rev "
            "WHERE gap IS NOT NULL AND dmin IS NOT NULL",
}
_NEEDS = {"rev": ["cat"], "base": ["rev"]}


def with_views(sql: str, *names: str) -> str:
    """Prefix ``sql`` (a SELECT, or CTE definitions followed by one) with the views it names."""
    wanted: list[str] = []

    def add(n: str) -> None:
        for need in _NEEDS.get(n, []):
            add(need)
        if n not in wanted:
            wanted.append(n)

    for n in names or ("cat",):
        add(n)
    ctes = ", ".join(f"{n} AS ({_MORE[n]})" for n in wanted)
    body = sql.strip()
    if body.upper().startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {ctes}, {body[14:].strip()}"
    return f"WITH {ctes}, {body[4:].strip()}" if body.upper().startswith("WITH") else f"WITH {ctes} {body}"
