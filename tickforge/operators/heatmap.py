"""Heatmap rollups: project voxels and events to the render plane and add them up by metric and team.

Every table carries scope_id, so many scopes roll up in one job.  participants: (scope_id, game_id, participant_id,
slot, team).  occupancy: (game_id, slot, cx, cy, cz, ticks, cell_size).  events: (scope_id, game_id, participant_id,
team, event_type, x, y).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickforge.functions.coerce import ROLLUP_LIMIT, team_key, team_label, team_order

PLANE_CELL = 0.5
PLANE_LOW, PLANE_HIGH = -2_000_001, 2_000_000
MOST_GROUPS, MOST_CELLS = 64, 2_000_000
METRICS = ("occupancy", "killer_position", "victim_position")


def project_voxel(cx: Column, cy: Column, cell_size: Column) -> tuple[Column, Column]:
    """Plane cell of a voxel's centre; height is dropped and y turned over."""
    ratio = cell_size / F.lit(PLANE_CELL)
    return F.floor((cx + F.lit(0.5)) * ratio), F.floor(-(cy + F.lit(0.5)) * ratio)


def project_point(x: Column, y: Column) -> tuple[Column, Column]:
    """Plane cell of a point."""
    return F.floor(x / F.lit(PLANE_CELL)), F.floor(-y / F.lit(PLANE_CELL))


def rows(participants: DataFrame, occupancy: DataFrame, events: DataFrame) -> DataFrame:
    """(scope_id, metric, game_id, participant_id, team, px, py, value) of all three metrics; voxels of slots that are not selected drop out."""
    px, py = project_voxel(F.col("cx"), F.col("cy"), F.col("cell_size"))
    held = occupancy.join(participants, ["game_id", "slot"]).select("scope_id", F.lit("occupancy").alias("metric"), "game_id", "participant_id", "team", px.alias("px"), py.alias("py"), F.col("ticks").cast("bigint").alias("value"))
    ex, ey = project_point(F.col("x"), F.col("y"))
    seen = events.where(F.col("event_type").isin(*METRICS[1:])).select("scope_id", F.col("event_type").alias("metric"), "game_id", "participant_id", "team", ex.alias("px"), ey.alias("py"), F.lit(1).cast("bigint").alias("value"))
    return held.unionByName(seen)


def cells(heat: DataFrame) -> DataFrame:
    """(scope_id, metric, team_key, px, py, value); a null team is a group of its own."""
    return heat.groupBy("scope_id", "metric", team_key(F.col("team")).alias("team_key"), "px", "py").agg(F.sum("value").alias("value"))


def summary(heat: DataFrame, participants: DataFrame, games: DataFrame) -> DataFrame:
    """One row a scope and metric: games and participants selected (rows) and contributing (distinct).

    games: (scope_id, game_id), every selected game, with participants or without.
    """
    one = heat.groupBy("scope_id", "metric").agg(F.countDistinct("game_id").alias("games_contributing"), F.countDistinct("participant_id").alias("participants_contributing"))
    each = games.select("scope_id", F.lit(1).alias("g"), F.lit(0).alias("p")).unionByName(participants.select("scope_id", F.lit(0).alias("g"), F.lit(1).alias("p")))
    picked = each.groupBy("scope_id").agg(F.sum("g").alias("games_selected"), F.sum("p").alias("participants_selected"))
    spine = picked.select("*", F.explode(F.array(*map(F.lit, METRICS))).alias("metric"))
    return spine.join(one, ["scope_id", "metric"], "left").select("scope_id", "metric", "games_selected", F.coalesce("games_contributing", F.lit(0)).cast("bigint").alias("games_contributing"), "participants_selected", F.coalesce("participants_contributing", F.lit(0)).cast("bigint").alias("participants_contributing"))


def groups(cell_rows: DataFrame) -> DataFrame:
    """One row a scope, metric and team: label, order, number of cells and their total."""
    k = F.col("team_key")
    return cell_rows.groupBy("scope_id", "metric", "team_key").agg(F.count("*").alias("cells"), F.sum("value").alias("value")).withColumns({"label": team_label(k), "position": team_order(k)})


def faults(cell_rows: DataFrame, low: int = PLANE_LOW, high: int = PLANE_HIGH, most_cells: int = MOST_CELLS, most_groups: int = MOST_GROUPS) -> DataFrame:
    """(scope_id, code) of scopes that pass a limit: plane bounds, cell value, cells of a group, groups of a metric."""
    out = cell_rows.where(~F.col("px").between(low, high) | ~F.col("py").between(low, high)).select("scope_id", F.lit("invalid_input_contract").alias("code"))
    over = cell_rows.where(F.col("value") > ROLLUP_LIMIT).select("scope_id", F.lit("rollup_counter_overflow").alias("code"))
    g = groups(cell_rows)
    many = g.where(F.col("cells") > most_cells).select("scope_id", F.lit("rollup_cell_limit_exceeded").alias("code"))
    wide = g.groupBy("scope_id", "metric").count().where(F.col("count") > most_groups).select("scope_id", F.lit("rollup_group_limit_exceeded").alias("code"))
    return out.unionByName(over).unionByName(many).unionByName(wide).distinct()
