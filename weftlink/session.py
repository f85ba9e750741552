"""Session helpers: reading tables, cutting lineage, and keeping frames by name."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

#: Gives the frame of a name: from where it was kept before, or by making and writing it.
Keep = Callable[[str, Callable[[], DataFrame]], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def file_of(spark: SparkSession, path: str) -> tuple:
    """(file system, path) of the storage layer."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_of(spark, path)
    return fs.exists(p)


def _ensure_checkpoint_dir(spark: SparkSession) -> None:
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        # only a local session may fall back to a machine-local folder
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = os.path.join(tempfile.gettempdir(), "weftlink-checkpoints")
    sc.setCheckpointDir(configured)


def cut(df: DataFrame) -> DataFrame:
    """Writes ``df`` once to the shared checkpoint folder and reads it from there on.

    The driver is then asked to collect garbage: only then are the shuffle files and
    checkpoints removed that nothing refers to any more.
    """
    _ensure_checkpoint_dir(df.sparkSession)
    out = df.checkpoint(eager=True)
    df.sparkSession.sparkContext._jvm.System.gc()
    return out


def written(name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """Keeps a frame for this run only."""
    return cut(make())


def cache(spark: SparkSession, folder: str) -> Keep:
    """Keeps frames as Parquet in a folder that later runs read; one that cannot be read is made again."""

    def keep(name: str, make: Callable[[], DataFrame]) -> DataFrame:
        path = f"{folder}/{name}"
        if exists(spark, f"{path}/_SUCCESS"):
            try:
                kept = spark.read.parquet(path)
                kept.limit(1).count()
                return kept
            except PySparkException:
                pass
        make().write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    return keep
