"""Intermediate tables in the folder of spark.checkpoint.dir, which the whole cluster shares."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []


def held(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet and read it back; the files go when the interpreter ends.

    Without the setting a temporary folder serves, but only where all runs in one process.
    """
    spark = df.sparkSession
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the whole cluster shares")
        at = tempfile.mkdtemp(prefix="tickforge-")
        spark.conf.set("spark.checkpoint.dir", at)
    at = f"{at.rstrip('/')}/tickforge/{name}-{uuid.uuid4().hex}"
    df.write.parquet(at)
    if not _written:
        atexit.register(_sweep)
    _written.append((spark, at))
    return spark.read.schema(df.schema).parquet(at)


def _sweep() -> None:
    for spark, at in _written:
        try:
            if spark.sparkContext._jsc is not None:
                path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at)
                path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        except Exception:  # the session may have ended before the interpreter
            return
