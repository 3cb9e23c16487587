"""Structured Streaming jobs: replay ingestion by micro-batches and windowed metrics."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickforge.operators import alarms as A
from tickforge.operators import occupancy as O
from tickforge.operators import replay as R
from tickforge.sources import replays as S


def ingest(spark: SparkSession, source: str, out: str, checkpoint: str, cell_size: float = 0.5, archive: str | None = None) -> StreamingQuery:
    """Read new replay files (JSON, .gz, .zst), bin their samples and append voxels (host machine players left out), discards and dead letters.

    Every table carries the batch id and is written under it, so that a batch that is tried again replaces itself.
    A bad file becomes a dead letter and fails nothing else.  With archive, files that were read are moved there.
    """

    def write(batch: DataFrame, number: int) -> None:
        docs = S.game_key(S.parse(batch.withColumn("error", F.lit(None).cast("string")))).persist()
        good = docs.where("error is null")
        classified = O.classify(S.player_samples(good))
        cells = O.capped(O.voxels(classified, cell_size))
        contexts = R.merge_contexts(R.network_contexts(S.network_players(good)), R.tick_contexts(S.end_players(good), S.machines(good)), R.explicit_contexts(S.explicit_players(good)))
        own, gone = O.exclude_slots(cells.where("cap is null").drop("cap"), R.hosts(contexts))
        kept = O.saturated(own).select("game_id", "slot", "cx", "cy", "cz", "ticks")
        for name, df in (("voxels", kept), ("discards", O.discards(classified, cells, gone)), ("dead_letters", docs.where("error is not null").select("file", "error"))):
            df.write.mode("overwrite").parquet(f"{out}/{name}/batch={number}")
        docs.unpersist()

    reader = spark.readStream.option("maxFilesPerTrigger", 1000)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    files = reader.text(source, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("doc"))
    return files.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def metric_windows(points: DataFrame, period: int, late: str = "10 minutes") -> DataFrame:
    """Tumbling windows of a stream of points (ts, metric, value) with every statistic of alarms; points later than the watermark are dropped."""
    w = F.window("ts", f"{period} seconds")
    out = points.withWatermark("ts", late).groupBy("metric", w.alias("w")).agg(F.count("*").alias("points"), *[f("value").alias(s.lower()) for s, f in A.STATISTICS.items()])
    return out.select("metric", F.col("w.start").alias("start"), "points", *[s.lower() for s in A.STATISTICS])


def breaches(windows: DataFrame, alarm: A.Alarm) -> DataFrame:
    """(metric, start, value, breach) of one alarm over streamed windows; alarms of one period fire where it breaches."""
    value = F.col(alarm.statistic.lower())
    return windows.where(F.col("metric") == alarm.metric).select("metric", "start", value.alias("value"), alarm.breach(value).alias("breach"))


def maintain(spark: SparkSession, dirty: DataFrame, roll_up: Callable[[str, int], None], most: int = 4, seconds: float = 810.0) -> list[str]:
    """Roll up the first dirty scopes (scope_id, source_revision, built_revision) by name while time is left; returns those done."""
    began, done = time.monotonic(), []
    for r in dirty.where("built_revision is null or built_revision < source_revision").orderBy("scope_id").limit(most).collect():
        if time.monotonic() - began > seconds:
            break
        roll_up(r["scope_id"], r["source_revision"])
        done.append(r["scope_id"])
    return done
