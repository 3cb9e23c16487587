"""Shared-folder tables that cut lineage, so that lost executors never force a recomputation from the raw input."""

from __future__ import annotations

import atexit
import gc
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a temporary one only where the setting is unset and all runs in one process (tests)."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the whole cluster shares")
        at = tempfile.mkdtemp(prefix="tickforge-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back with the same schema."""
    spark = df.sparkSession
    at = f"{shared_folder(spark)}/tickforge/{name}-{uuid.uuid4().hex}"
    df.write.parquet(at)
    if not _written:
        atexit.register(_sweep)
    _written.append((spark, at))
    out = spark.read.schema(df.schema).parquet(at)
    out._tickforge_path = at
    return out


def discard(*tables: DataFrame) -> None:
    """Delete settled tables that no later plan reads."""
    for t in tables:
        if at := getattr(t, "_tickforge_path", None):
            _delete(t.sparkSession, at)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that nothing refers to any more.

    Its cleaner acts when the driver's heap is collected, which may be long after a large shuffle was last read.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _delete(spark: SparkSession, at: str) -> None:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(at)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _sweep() -> None:
    for spark, at in _written:
        try:
            if spark.sparkContext._jsc is not None:
                _delete(spark, at)
        except Exception:  # the session may have ended before the interpreter
            return
