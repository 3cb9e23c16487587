"""Generations of rollup outputs: immutable writes, activation, retention, exports and dead letters."""

from __future__ import annotations

import gzip
import hashlib
import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

LONGEST_MESSAGE = 4096


class ConflictError(RuntimeError):
    """The generation exists with other content, or the scope's revision has moved on."""


def content_hash(df: DataFrame) -> str:
    """A hash of a table's rows, whatever their order: counts and sums of two hashes of each row."""
    names = sorted(df.columns)
    row = F.to_json(F.struct(*names), {"ignoreNullFields": "false"})
    r = df.select(F.xxhash64(row).alias("a"), F.crc32(row).alias("b")).agg(F.count("*").alias("n"), F.sum(F.col("a").cast("decimal(38,0)")).alias("a"), F.sum("b").alias("b")).first()
    return hashlib.sha256(f"{names}{r['n']}{r['a']}{r['b']}".encode()).hexdigest()


def write_generation(df: DataFrame, root: str, scope: str, generation: int) -> str:
    """Write a generation once; writing equal rows again is no error, other rows are.

    The rows are written under a name of their own and renamed, so of two writers one is first and the other compares.  This
    needs a file system whose renames are atomic; on an object store without them writers of a scope must take turns.
    """
    at, mine = f"{root}/scope={scope}/generation={generation}", f"{root}/_writing/{uuid.uuid4().hex}"
    spark = df.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(path(at)):
        try:
            df.write.parquet(mine)
            digest = content_hash(spark.read.schema(df.schema).parquet(mine))
            files.mkdirs(path(f"{root}/scope={scope}"))
            # a folder that is there by now would take the renamed one in, so its own marker tells who was first
            if files.rename(path(mine), path(at)) and not files.exists(path(f"{at}/{mine.rsplit('/', 1)[1]}")):
                return digest
            files.delete(path(f"{at}/{mine.rsplit('/', 1)[1]}"), True)
        finally:
            files.delete(path(mine), True)
    digest = content_hash(df)
    if content_hash(spark.read.schema(df.schema).parquet(at)) != digest:
        raise ConflictError("immutable_generation_conflict")
    return digest


def latest(manifests: DataFrame, by: str = "scope_id", order: str = "generation") -> DataFrame:
    """The newest active row of each scope; artifacts whose generations don't rise are ordered by commit time instead."""
    w = Window.partitionBy(by).orderBy(F.col(order).desc())
    return manifests.where("state = 'active'").withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def activate(manifests: DataFrame, scope: str, generation: int, revision: int, current: int) -> DataFrame:
    """Make one generation the active one and supersede the others; refused if the scope's revision is no longer the pinned one."""
    if revision != current:
        raise ConflictError("stale_revision")
    mine = F.col("scope_id") == scope
    state = F.when(mine & (F.col("generation") == generation), "active").when(mine & (F.col("state") == "active"), "superseded").otherwise(F.col("state"))
    return manifests.withColumn("state", state)


def expired(manifests: DataFrame, now: Column, days: int = 30) -> DataFrame:
    """Superseded rows older than the retention."""
    return manifests.where((F.col("state") == "superseded") & (F.col("committed_at") < now - F.make_dt_interval(F.lit(days))))


def reprocess_generation(attempt: Column) -> Column:
    """A UUID as a number modulo 2^31 - 2, plus 2, taken 32 bits at a time."""
    digits = F.lower(F.replace(attempt, F.lit("-"), F.lit("")))
    rest, m = F.lit(0).cast("bigint"), (1 << 31) - 2
    for k in range(4):
        part = F.conv(F.substring(digits, 8 * k + 1, 8), 16, 10).cast("bigint")
        rest = (rest * (1 << 32) + part) % m
    return F.when(F.length(digits) == 32, rest + 2)


def status(rows: DataFrame) -> DataFrame:
    """Status rows with their message cut to what is stored."""
    return rows.withColumn("message", F.substring("message", 1, LONGEST_MESSAGE))


def dead_letters(rows: DataFrame, most_attempts: int = 4) -> DataFrame:
    """Failed items that won't be tried again: not retryable, or tried often enough."""
    return rows.where("error is not null and (not retryable or attempts >= %d)" % most_attempts)


def export_json(df: DataFrame, order: list[str], most_plain: int, most_packed: int) -> tuple[bytes, str]:
    """Canonical JSON lines of a small table, gzipped without a time; (bytes, sha256).  Too large a table is refused.

    The rows come to the driver one partition at a time, and no more than most_plain bytes of them."""
    out, size = [], 0
    for r in df.orderBy(*order).toLocalIterator():
        line = json.dumps(r.asDict(recursive=True), sort_keys=True, separators=(",", ":"), default=str).encode() + b"\n"
        size += len(line)
        if size > most_plain:
            raise ValueError("artifact_too_large")
        out.append(line)
    packed = gzip.compress(b"".join(out), 6, mtime=0)
    if len(packed) > most_packed:
        raise ValueError("artifact_too_large")
    return packed, hashlib.sha256(packed).hexdigest()


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def totals(results: DataFrame, counters: list[str]) -> DataFrame:
    """One row: sums of the counters of many results."""
    return results.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in counters], F.count("*").alias("results"))


# What the results of scopes count, and the metric that each total is sent as.
SCOPE_COUNTERS = ("input_games", "input_bytes", "output_bytes", "output_decoded_bytes", "output_cells", "region_output_bytes", "region_output_decoded_bytes", "region_membership_checks", "region_source_cells", "region_missing_games", "region_incompatible_games")
RUN_COUNTERS = ("input_decoded_bytes", "s3_gets", "api_requests", "api_duration_ms")
METRICS = {
    "ScopesCompleted": "completed",
    "ScopesStale": "stale",
    "ScopesFailed": "failed",
    "InputGames": "input_games",
    "InputBytes": "input_bytes",
    "InputDecodedBytes": "input_decoded_bytes",
    "OutputBytes": "output_bytes",
    "OutputDecodedBytes": "output_decoded_bytes",
    "OutputCells": "output_cells",
    "RegionOutputBytes": "region_output_bytes",
    "RegionOutputDecodedBytes": "region_output_decoded_bytes",
    "RegionMembershipChecks": "region_membership_checks",
    "RegionSourceCells": "region_source_cells",
    "RegionMissingGames": "region_missing_games",
    "RegionIncompatibleGames": "region_incompatible_games",
    "RegionArtifactsWritten": "region_artifacts_written",
    "S3Gets": "s3_gets",
    "ApiRequests": "api_requests",
    "ApiDuration": "api_duration_ms",
    "InvocationDuration": "duration_ms",
    "ProcessPeakRssKiB": "peak_rss_kib",
}


def invocation(results: DataFrame) -> DataFrame:
    """One row: the 19 totals of a run over its scopes' results (status, and any of SCOPE_COUNTERS and RUN_COUNTERS; absent and null count 0)."""
    n = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) if c in results.columns else F.lit(0).cast("bigint").alias(c)
    ended = [F.count_if(F.col("status") == s).alias(s) for s in ("completed", "stale", "failed")]
    written = F.count_if(F.col("region_output_bytes") > 0) if "region_output_bytes" in results.columns else F.lit(0).cast("bigint")
    return results.agg(*ended, *map(n, SCOPE_COUNTERS), written.alias("region_artifacts_written"), *map(n, RUN_COUNTERS))


def metrics(run: DataFrame) -> DataFrame:
    """(metric, value, unit) of a run's totals, with duration_ms and peak_rss_kib if they are there (0 otherwise): 21 rows."""
    unit = lambda m: "Milliseconds" if m.endswith("Duration") else "Bytes" if m.endswith("Bytes") else "Kilobytes" if m.endswith("KiB") else "Count"
    value = lambda c: F.coalesce(F.col(c).cast("bigint"), F.lit(0).cast("bigint")) if c in run.columns else F.lit(0).cast("bigint")
    return run.select(F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), value(c).alias("value"), F.lit(unit(m)).alias("unit")) for m, c in METRICS.items()])))


def attempted(failed: DataFrame, earlier: DataFrame, most_attempts: int = 4) -> tuple[DataFrame, DataFrame]:
    """(to try again, dead letters), both (id, error, retryable, attempts), of the items that failed now (id, error, retryable).

    earlier: (id, attempts) of all tries before, of which the highest counts."""
    before = earlier.groupBy("id").agg(F.max("attempts").alias("_before"))
    now = failed.groupBy("id").agg(F.min("error").alias("error"), F.min("retryable").alias("retryable"))
    rows = now.join(before, "id", "left").select("id", "error", "retryable", (F.coalesce("_before", F.lit(0)) + 1).cast("int").alias("attempts"))
    dead = dead_letters(rows, most_attempts)
    return rows.where("not (not retryable or attempts >= %d)" % most_attempts), dead


def drop(spark: SparkSession, path: str) -> None:
    """Delete an output that failed or went stale."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def generated_at(manifests: DataFrame, scope: str, generation: int, now: Column) -> Column:
    """The time that an earlier try of the generation has left, so that a retry writes the same; else now."""
    r = manifests.where((F.col("scope_id") == scope) & (F.col("generation") == generation) & F.col("generated_at").isNotNull()).select("generated_at").first()
    return F.lit(r["generated_at"]) if r else now


def complete(manifests: DataFrame, scope: str, outputs: dict[str, tuple[int, str]], revision: int, current: int) -> DataFrame:
    """Activate several outputs (kind: generation, hash) of a scope at once, or none: their manifests must be there with those hashes."""
    wanted = F.lit(False)
    for kind, (generation, digest) in outputs.items():
        wanted = wanted | ((F.col("kind") == kind) & (F.col("generation") == generation) & (F.col("sha256") == digest))
    here = {r["kind"] for r in manifests.where((F.col("scope_id") == scope) & (F.col("state") != "superseded") & wanted).select("kind").distinct().collect()}
    if revision != current:
        raise ConflictError("stale_revision")
    if here != set(outputs):
        raise ConflictError("incomplete_outputs")
    mine = F.col("scope_id") == scope
    now = F.lit(False)
    for kind, (generation, _) in outputs.items():
        now = now | ((F.col("kind") == kind) & (F.col("generation") == generation))
    return manifests.withColumn("state", F.when(mine & now, "active").when(mine & (F.col("state") == "active") & F.col("kind").isin(*outputs), "superseded").otherwise(F.col("state")))


def write_partitioned(df: DataFrame, root: str, by: tuple[str, ...] = ("upload_id", "generation")) -> None:
    """Key layout of spatial artifacts: one folder for each upload and generation; only the folders written are replaced."""
    df.write.option("partitionOverwriteMode", "dynamic").partitionBy(*by).mode("overwrite").parquet(root)
