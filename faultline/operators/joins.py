"""Key-aligned patches, incremental selection, detail look-ups, as-of join."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.functions.documents import KEY_OF, with_detail_values
from faultline.operators.ordered import carry_forward, lay_out


def require_unique(df: DataFrame, key: str) -> None:
    """Raises if a key occurs twice; a patch with repeated keys would multiply rows."""
    twice = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).filter("n > 1").first()
    if twice:
        raise ValueError(f"{twice['n']} rows for {key} = {twice[key]!r}")


def combine_first(left: DataFrame, right: DataFrame, key: str = "idx") -> DataFrame:
    """Left rows only; NULLs patched from the right; right-only columns added;
    columns in lexicographic order after the key. Repeated keys on the right raise."""
    require_unique(right, key)
    mine, theirs = set(left.columns) - {key}, set(right.columns) - {key}
    joined = left.alias("l").join(right.alias("r"), key, "left")

    def pick(c: str) -> Column:
        if c in mine and c in theirs:
            return F.coalesce(F.col(f"l.`{c}`"), F.col(f"r.`{c}`")).alias(c)
        return F.col(f"l.`{c}`" if c in mine else f"r.`{c}`").alias(c)

    return joined.select(key, *[pick(c) for c in sorted(mine | theirs)])


def fill_from(left: DataFrame, patch: DataFrame, key: str = "idx") -> DataFrame:
    """Only NULLs are overwritten, only in shared columns; column order is kept. Repeated keys in the patch raise."""
    shared = [c for c in left.columns if c in patch.columns and c != key]
    if not shared:
        return left
    require_unique(patch, key)
    joined = left.alias("l").join(patch.select(key, *shared).alias("p"), key, "left")
    return joined.select(*[
        F.coalesce(F.col(f"l.`{c}`"), F.col(f"p.`{c}`").cast(left.schema[c].dataType)).alias(c)
        if c in shared else (F.col(key) if c == key else F.col(f"l.`{c}`"))
        for c in left.columns
    ])


def not_processed(df: DataFrame, done: DataFrame | None, key: str = "idx", done_key: str = "old_idx") -> DataFrame:
    """Rows whose key is not among the processed ones."""
    if done is None:
        return df
    if done_key not in done.columns:
        raise ValueError(f"processed table has no {done_key!r} column")
    return df.join(done.select(F.col(done_key).alias(key)), key, "left_anti")


def also_in(df: DataFrame, other: DataFrame, key: str = "idx") -> DataFrame:
    return df.join(other.select(key), key, "left_semi")


def detail_updates(links: DataFrame, documents: DataFrame, keys: dict[str, str] = KEY_OF) -> DataFrame:
    """(link, found, value columns…): each distinct link looked up once, parsed once.

    Of several documents of a link the latest counts, by ``fetched`` if the documents have it; then a readable one, the
    longer one, the greater one.
    """
    wanted = links.select(F.trim("detail").alias("link")).distinct()
    latest = [F.col("fetched").alias("a")] if "fetched" in documents.columns else []
    rank = F.struct(*latest, F.try_parse_json("body").isNotNull().alias("b"), F.length("body").alias("c"), F.col("body").alias("d"))
    docs = documents.filter(F.col("body").isNotNull()).groupBy(F.trim("detail").alias("link")).agg(F.max_by("body", rank).alias("body"))
    joined = with_detail_values(wanted.join(docs, "link", "left"), "body", keys)
    return joined.select("link", F.coalesce(F.try_parse_json("body").isNotNull(), F.lit(False)).alias("found"), *keys)


def fill_from_details(df: DataFrame, documents: DataFrame, columns: dict[str, str] = KEY_OF) -> DataFrame:
    """NULLs in nst/dmin/gap taken from the detail document of the row's link.

    Rows that need nothing are neither shuffled nor joined. A link shared by many
    rows is split by AQE's skew handling, as the look-up side is unique per link.
    """
    from faultline.operators.clean import needs_detail

    missing = [c for c in ("detail", *columns) if c not in df.columns]
    if missing:
        raise KeyError(f"missing columns {missing}")
    need = needs_detail(tuple(columns))
    todo = df.filter(need)
    updates = detail_updates(todo, documents, columns).drop("found")
    joined = todo.withColumn("link", F.trim("detail")).alias("l").join(updates.alias("u"), "link", "left")
    filled = joined.select(*[
        F.coalesce(F.col(f"l.{c}"), F.col(f"u.{c}").cast(df.schema[c].dataType)).alias(c)
        if c in columns else F.col(f"l.`{c}`")
        for c in df.columns
    ])
    return df.filter(~need).unionByName(filled)


def detail_counters(df: DataFrame, documents: DataFrame) -> DataFrame:
    """(rows_considered, links, completed, failed) of a look-up run."""
    from faultline.operators.clean import needs_detail

    todo = df.filter(needs_detail())
    per_link = todo.groupBy(F.trim("detail").alias("link")).agg(F.count("*").alias("rows"))
    found = detail_updates(todo, documents).select("link", "found")
    return per_link.join(found, "link").agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows_considered"),
        F.count("*").alias("links"),
        F.count_if("found").alias("completed"),
        F.count_if(~F.col("found")).alias("failed"),
    )


def fetch_documents(links: DataFrame, fetch: Callable[[str], str | None]) -> DataFrame:
    """(detail, body) for distinct links, through a caller-supplied ``fetch``."""
    def run(batches):
        for batch in batches:
            yield batch.assign(body=[fetch(u) for u in batch["detail"]])

    return links.select(F.trim("detail").alias("detail")).distinct().mapInPandas(run, "detail string, body string")


def patch_job(catalog: DataFrame, documents: DataFrame, done: DataFrame | None = None, geo: str | None = None) -> DataFrame:
    """Rows lacking nst, pruned, not yet processed, filled from their details."""
    from faultline.operators.clean import expand_coordinates, prune_table

    df = expand_coordinates(catalog, geo) if geo else catalog
    dropped = [r["column"] for r in prune_table(df).filter("dropped").collect()]
    todo = df.filter(F.col("nst").isNull())
    if done is not None:
        todo = not_processed(todo, done)
    filled = fill_from_details(todo, documents)
    return filled.drop(*[c for c in dropped if c != "nst"]).withColumnRenamed("idx", "old_idx")


def asof_join(
    left: DataFrame, right: DataFrame, time: str, values: list[str], by: str | None = None,
    tolerance_seconds: float | None = None, left_id: str = "idx",
) -> DataFrame:
    """Each left row with the latest right row at or before it (same ``by``).

    Both sides are put into one global order by (by, time, side, id) and the last
    right row is carried forward, so no key has to fit into one task. The left rows
    travel whole, so hand over the columns that are needed.
    """
    from faultline.functions.scalar import seconds_between

    key = F.col(by).cast("string") if by else F.lit("")
    payload = F.struct(key.alias("k"), F.col(time).alias("t"), *[F.col(v) for v in values])
    right_rows = right.select(
        key.alias("_k"), F.col(time).alias("_t"), F.lit(0).alias("_side"),
        F.xxhash64(payload).alias("_id"), payload.alias("_last"),
    )
    left_rows = left.select(
        key.alias("_k"), F.col(time).alias("_t"), F.lit(1).alias("_side"),
        F.col(left_id).cast("bigint").alias("_id"), F.struct(*left.columns).alias("_row_cols"),
    )
    both = left_rows.unionByName(right_rows, allowMissingColumns=True)
    carried = carry_forward(lay_out(both, "_k", "_t", "_side", "_id"), ["_last"])
    ok = F.col("_last.k") == F.col("_k")
    if tolerance_seconds is not None:
        ok = ok & (seconds_between(F.col("_t"), F.col("_last.t")) <= tolerance_seconds)
    return carried.filter("_side = 1").select(
        "_row_cols.*",
        F.when(ok, F.col("_last.t")).alias(f"{time}_right"),
        *[F.when(ok, F.col(f"_last.{v}")).alias(v) for v in values],
    )


def split_by_null(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    return df.filter(F.col(column).isNotNull()), df.filter(F.col(column).isNull())


def recombine(*parts: DataFrame) -> DataFrame:
    """Row-wise concat, columns matched by name."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
