"""Validation of claims, manifests, artifacts and participants: every function adds error (null if sound)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickforge.functions import coerce as C
from tickforge.operators.regions import compatible_size

SCOPES, ELIGIBILITY = ("map", "player_map"), ("public_stats", "validated")
ARTIFACT_SCHEMA, SPACE = "tickforge.spatial.v1", "replay_world.v1"
MOST_ROWS = 2_000_000

#: Whether an error may pass if the same work is tried again.
RETRYABLE = {
    "invalid_claim": False, "invalid_manifest": False, "invalid_artifact": False, "invalid_input_contract": False, "artifact_too_large": False, "size_mismatch": False, "hash_mismatch": False,
    "immutable_generation_conflict": False, "rollup_counter_overflow": False, "rollup_cell_limit_exceeded": False, "rollup_group_limit_exceeded": False, "region_membership_limit_exceeded": False,
    "invalid_region_configuration": False, "region_configuration_limit_exceeded": False, "region_group_limit_exceeded": False, "bad_json": False, "bad_zip": False, "zip_needs_one_json": False, "bad_job": False,
    "stale_revision": False, "missing_artifact": True, "unexpected_error": True,
}


def _first(*checks: tuple[Column, str]) -> Column:
    """The code of the first condition that does not hold; null conditions don't hold."""
    out = F.lit(None).cast("string")
    for ok, code in reversed(checks):
        out = F.when(F.coalesce(ok, F.lit(False)), out).otherwise(F.lit(code))
    return out


def claims(df: DataFrame) -> DataFrame:
    """(scope_id, scope_type, map_id, player_id, eligibility, source_revision, built_revision, next_generation, region_stats_requested, region_configuration_revision, region_configuration_hash).

    A map's scope has no player and a player's one has; region statistics need a configuration's revision and hash."""
    ok = F.col("scope_id").isNotNull() & F.col("map_id").isNotNull() & F.col("scope_type").isin(*SCOPES) & F.col("eligibility").isin(*ELIGIBILITY)
    player = F.col("player_id").isNotNull() == (F.col("scope_type") == "player_map")
    counts = (F.col("source_revision") >= 0) & (F.coalesce("built_revision", F.lit(0)) >= 0) & (F.col("next_generation") >= 1)
    regions = ~F.coalesce("region_stats_requested", F.lit(False)) | ((F.col("region_configuration_revision") >= 1) & C.sha256_text(F.col("region_configuration_hash")).isNotNull())
    return df.withColumn("error", _first((ok & player & counts & F.coalesce(regions, F.lit(False)), "invalid_claim")))


def manifests(df: DataFrame) -> DataFrame:
    """(schema, coordinate_space, cell_size, bucket, key, encoding, size_bytes, sha256)."""
    ok = (F.col("schema") == ARTIFACT_SCHEMA) & (F.col("coordinate_space") == SPACE) & compatible_size(F.col("cell_size")) & (F.col("bucket") != "") & (F.col("key") != "")
    return df.withColumn("error", _first((ok & F.coalesce("encoding", F.lit("identity")).isin("identity", "gzip") & (F.col("size_bytes") >= 1) & C.sha256_text(F.col("sha256")).isNotNull(), "invalid_manifest")))


def artifacts(df: DataFrame) -> DataFrame:
    """(schema, coordinate_space, cell_size, ticks_per_second, occupancy array<struct<slot_index, cell array, observed_ticks>>); a bad row spoils its artifact."""
    row = lambda r: (r["slot_index"] >= 0) & (F.size(r["cell"]) == 3) & ~F.exists(r["cell"], lambda c: c.isNull()) & (r["observed_ticks"] >= 1)
    ok = (F.col("schema") == ARTIFACT_SCHEMA) & (F.col("coordinate_space") == SPACE) & compatible_size(F.col("cell_size")) & (F.abs(F.col("ticks_per_second") - C.TICKS_PER_SECOND) < 1e-6)
    return df.withColumn("error", _first((ok & (F.size("occupancy") <= MOST_ROWS), "invalid_artifact"), (~F.exists("occupancy", lambda r: ~F.coalesce(row(r), F.lit(False))), "invalid_artifact")))


def participants(df: DataFrame) -> DataFrame:
    """(game_id, participant_id, slot, team): slots are unique in a game, teams null or from -1 to 63."""
    alone = F.count("*").over(Window.partitionBy("game_id", "slot")) == 1
    ok = F.col("participant_id").isNotNull() & (F.col("participant_id") != "") & (F.col("slot") >= 0) & (F.col("team").isNull() | F.col("team").between(-1, 63))
    return df.withColumn("error", _first((ok, "invalid_input_contract"), (alone, "invalid_input_contract")))


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sound rows, rejects)."""
    return df.where("error is null").drop("error"), df.where("error is not null")


def failures(df: DataFrame, most: int = 1000) -> DataFrame:
    """Rows (scope_id, code, message) with whether trying again may help, and the message cut."""
    known = F.create_map(*[x for k, v in RETRYABLE.items() for x in (F.lit(k), F.lit(v))])
    code = F.when(known[F.col("code")].isNotNull(), F.col("code")).otherwise("unexpected_error")
    return df.select("scope_id", code.alias("code"), F.substring("message", 1, most).alias("message"), F.coalesce(known[code], F.lit(True)).alias("retryable"))
