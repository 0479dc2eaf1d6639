"""Structured Streaming forms of the batch jobs.

Every job writes its micro-batches into ``batch=<id>`` folders, replaced when a
batch is retried, so that a rerun after a lost driver gives the same table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.operators.joins import fill_from_details
from faultline.operators.windows import time_since_last
from faultline.functions.scalar import seconds_between


def file_stream(spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.parquet", files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def run(stream: DataFrame, write: Callable[[DataFrame, int], None], sink: str, mode: str = "append", checkpoint: str | None = None) -> None:
    """Processes what is there now and stops. The checkpoint belongs to the sink, so that a rerun goes on where the last
    run ended and its batch numbers go on, too."""
    query = (
        stream.writeStream.outputMode(mode).foreachBatch(write).trigger(availableNow=True)
        .option("checkpointLocation", checkpoint or f"{sink.rstrip('/')}-checkpoint").start()
    )
    query.awaitTermination()


def batch_writer(path: str, change: Callable[[DataFrame], DataFrame] = lambda df: df) -> Callable[[DataFrame, int], None]:
    def write(df: DataFrame, batch: int) -> None:
        change(df).write.mode("overwrite").parquet(f"{path}/batch={batch}")

    return write


def with_event_time(df: DataFrame, delay: str, time: str = "time") -> DataFrame:
    return df.withColumn("event_time", F.col(time).cast("timestamp")).withWatermark("event_time", delay)


def newest(df: DataFrame, key: list[str], version: str) -> DataFrame:
    """The row of the highest version per key; partial maxima are taken before the shuffle."""
    rest = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.max_by(F.struct(*rest), version).alias("_v")).select(*key, "_v.*")


def ingest(stream: DataFrame, sink: str, checkpoint: str | None = None) -> DataFrame:
    """Catalogue of everything landed; of repeated ids the newest ``updated`` wins.
    Late and repeated rows are all stored, so nothing is lost to a watermark."""
    run(stream, batch_writer(sink), sink, checkpoint=checkpoint)
    landed = stream.sparkSession.read.parquet(sink)
    return newest(landed, ["idx"], "updated").drop("batch")


def _updates(stream: DataFrame, sink: str, key: list[str], checkpoint: str | None) -> DataFrame:
    run(stream, batch_writer(sink), sink, mode="update", checkpoint=checkpoint)
    return newest(stream.sparkSession.read.parquet(sink), key, "batch").drop("batch")


def _ntz(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def daily(stream: DataFrame, sink: str, delay: str = "2 days", checkpoint: str | None = None) -> DataFrame:
    """Magnitude count, max, mean per day, kept up to date until the watermark passes."""
    days = with_event_time(stream, delay).groupBy(F.window("event_time", "1 day")).agg(
        F.count("mag").alias("mag_count"), F.max("mag").alias("mag_max"), F.avg("mag").alias("mag_mean"))
    flat = days.select(F.col("window.start").alias("day"), "mag_count", "mag_max", "mag_mean")
    return _updates(flat, sink, ["day"], checkpoint).withColumn("day", F.to_date("day"))


def sliding(stream: DataFrame, sink: str, cell: str, days: int = 7, delay: str = "2 days", checkpoint: str | None = None) -> DataFrame:
    """Count and max per cell over ``days`` days, every day."""
    windows = with_event_time(stream, delay).groupBy(F.window("event_time", f"{days} days", "1 day"), cell).agg(
        F.count("mag").alias("eq_count"), F.max("mag").alias("max_mag"))
    flat = windows.select(F.col("window.start").alias("starts"), F.col("window.end").alias("ends"), cell, "eq_count", "max_mag")
    return _ntz(_updates(flat, sink, ["starts", "ends", cell], checkpoint), "starts", "ends")


def sessions(stream: DataFrame, sink: str, cell: str, gap: str, delay: str = "1 day", checkpoint: str | None = None) -> DataFrame:
    """Closed activity sessions per cell: no event for ``gap`` ends one."""
    made = with_event_time(stream, delay).groupBy(F.session_window("event_time", gap), cell).agg(
        F.count("*").alias("events"), F.max("mag").alias("max_mag"))
    flat = made.select(cell, F.col("session_window.start").alias("starts"), F.col("session_window.end").alias("ends"), "events", "max_mag")
    run(flat, batch_writer(sink), sink, checkpoint=checkpoint)
    return _ntz(stream.sparkSession.read.parquet(sink).drop("batch"), "starts", "ends")


def pauses(stream: DataFrame, sink: str, cell: str, checkpoint: str | None = None) -> DataFrame:
    """Seconds since the previous event of the cell, across micro-batches.

    Inside a batch the gaps come from the batch operator, which spreads hot cells.
    Between batches one row per cell, the last time seen, is kept as a table
    written per batch; an event older than that has no previous one.
    """
    state = f"{sink}-state"

    def write(df: DataFrame, batch: int) -> None:
        spark = df.sparkSession
        df = df.persist()  # read for the gaps and for the last times
        rows = time_since_last(df, by=cell, name="pause_s")
        seen = df.groupBy(cell).agg(F.max("time").alias("last"))
        if batch > 0:
            before = spark.read.parquet(f"{state}/batch={batch - 1}")
            late = F.when(F.col("last") <= F.col("time"), seconds_between(F.col("time"), F.col("last")))
            rows = rows.join(before, cell, "left").withColumn("pause_s", F.coalesce("pause_s", late)).drop("last")
            seen = seen.unionByName(before).groupBy(cell).agg(F.max("last").alias("last"))
        rows.write.mode("overwrite").parquet(f"{sink}/batch={batch}")
        seen.write.mode("overwrite").parquet(f"{state}/batch={batch}")
        df.unpersist()

    run(stream, write, sink, checkpoint=checkpoint)
    return stream.sparkSession.read.parquet(sink).drop("batch")


def patch(stream: DataFrame, documents: DataFrame, sink: str, checkpoint: str | None = None) -> DataFrame:
    """Missing nst/dmin/gap filled from the landed detail documents, batch by batch."""
    run(stream, batch_writer(sink, lambda df: fill_from_details(df, documents)), sink, checkpoint=checkpoint)
    return stream.sparkSession.read.parquet(sink).drop("batch")


def patch_jobs(stream: DataFrame, documents: DataFrame, sink: str, checkpoint: str | None = None) -> DataFrame:
    """The incremental patch job: each batch skips ids already in the sink."""
    from faultline.operators.joins import not_processed

    def write(df: DataFrame, batch: int) -> None:
        spark = df.sparkSession
        todo = df.filter(F.col("nst").isNull())
        if batch > 0:
            done = spark.read.parquet(sink).filter(F.col("batch") < batch).select(F.col("idx").alias("old_idx"))
            todo = not_processed(todo, done)
        fill_from_details(todo, documents).write.mode("overwrite").parquet(f"{sink}/batch={batch}")

    run(stream, write, sink, checkpoint=checkpoint)
    return stream.sparkSession.read.parquet(sink).drop("batch")
