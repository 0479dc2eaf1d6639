"""Session helpers: the shared working folder and written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: str = "*", partitions: int = 8) -> SparkSession:
    """A session for tests and the bench; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("faultline")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")  # small data, all cores
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder for written intermediate tables, visible to every executor.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may
    fall back to a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="faultline-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


_RUN = uuid.uuid4().hex
_step = "main"


def begin_step(name: str | None = None) -> str:
    """What is written from now on goes to a folder of its own; returns the name of the step before."""
    global _step
    before, _step = _step, name or uuid.uuid4().hex
    return before


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path below this run's own folder."""
    return f"{shared_folder(spark)}/faultline-{_RUN}/{_step}/{label}-{uuid.uuid4().hex}"


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_step(spark: SparkSession, name: str) -> None:
    """Removes the intermediate tables of one step; results built on them must be stored first."""
    _delete(spark, f"{shared_folder(spark)}/faultline-{_RUN}/{name}")


def drop_written(spark: SparkSession) -> None:
    """Removes the intermediate tables of this run; results built on them must be
    stored first."""
    _delete(spark, f"{shared_folder(spark)}/faultline-{_RUN}")


FEW_ROWS = 100_000


def small_side(df: DataFrame, label: str = "small", rows: int = FEW_ROWS) -> DataFrame:
    """A narrow table for a join: written, counted, and broadcast only if it has few rows. A larger one is left to AQE,
    which can split its hot keys."""
    out = written(df, label)
    return F.broadcast(out) if out.limit(rows + 1).count() <= rows else out


def written(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` once and read it back.

    Cuts the lineage and survives lost executors; readers of the result still
    get column pruning and filter pushdown, which an RDD checkpoint would not give.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
