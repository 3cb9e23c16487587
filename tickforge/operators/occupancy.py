"""Voxel occupancy: classify player samples, bin them, apply caps, exclude slots and account for what is discarded.

Samples are rows (game_id, tick, pos, slot, hostman, has_object, x, y, z, x_null, y_null, z_null); coordinates come as
doubles and the *_null flags tell a value that is present but null from one that is absent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickforge.functions.coerce import COUNTER_LIMIT

SLOT_CELLS = 50_000
GAME_CELLS = 200_000
MOST_COORDINATE = 1_000_000.0


def discard_reason(slot: Column, hostman: Column, has_object: Column, x: Column, y: Column, z: Column, missing: Column | None = None) -> Column:
    """Null for a usable sample, else the first reason that holds.

    missing: whether a coordinate is absent, rather than unusable; by default any null coordinate is absent.
    """
    absent = missing if missing is not None else x.isNull() | y.isNull() | z.isNull()
    odd = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    far = lambda c: F.abs(c) > MOST_COORDINATE
    return (
        F.when(slot.isNull() | ~slot.between(0, 63), "invalid_slot")
        .when(F.coalesce(hostman, F.lit(False)), "hostman")
        .when(~F.coalesce(has_object, F.lit(False)), "missing_player_object")
        .when(absent, "missing_coordinate")
        .when(odd(x) | odd(y) | odd(z), "non_finite")
        .when(far(x) | far(y) | far(z), "out_of_bounds")
    )


def classify(samples: DataFrame) -> DataFrame:
    """Add reason; columns that are absent default to: no hostman, an object, null coordinates absent."""
    has = lambda n, d: F.col(n) if n in samples.columns else F.lit(d)
    return samples.withColumn("reason", discard_reason(F.col("slot"), has("hostman", False), has("has_object", True), F.col("x"), F.col("y"), F.col("z"), F.col("missing") if "missing" in samples.columns else None))


def voxels(classified: DataFrame, cell_size: float = 0.5) -> DataFrame:
    """(game_id, slot, cx, cy, cz, ticks, first): samples of each voxel and the first of them as (tick, pos)."""
    size = F.lit(float(cell_size))
    first = F.min(F.struct("tick", "pos")) if {"tick", "pos"} <= set(classified.columns) else F.lit(None).cast("struct<tick: bigint, pos: bigint>")
    cells = classified.where("reason is null").select("*", *[F.floor(F.col(a) / size).alias(f"c{a}") for a in "xyz"])
    return cells.groupBy("game_id", "slot", "cx", "cy", "cz").agg(F.count("*").alias("ticks"), first.alias("first"))


def capped(cells: DataFrame, slot_cells: int = SLOT_CELLS, game_cells: int = GAME_CELLS) -> DataFrame:
    """Add cap: null for cells that are kept, else `slot_cell_limit` or `global_cell_limit`.

    Cells come in the order of their first sample.  A slot takes its first slot_cells, a game the first game_cells of
    those.  A refused cell counts against its slot if the slot is full in the end, else against the game.
    """
    line = Window.orderBy("first", "cx", "cy", "cz")
    ranked = cells.withColumn("_s", F.row_number().over(line.partitionBy("game_id", "slot")))
    ranked = ranked.withColumn("_g", F.when(F.col("_s") <= slot_cells, F.row_number().over(Window.partitionBy("game_id", F.col("_s") <= slot_cells).orderBy("first", "slot", "cx", "cy", "cz"))))
    ranked = ranked.withColumn("_ok", (F.col("_s") <= slot_cells) & (F.col("_g") <= game_cells))
    full = F.count_if("_ok").over(Window.partitionBy("game_id", "slot")) >= slot_cells
    return ranked.withColumn("cap", F.when(~F.col("_ok"), F.when(full & (F.col("_s") > slot_cells), "slot_cell_limit").otherwise("global_cell_limit"))).drop("_s", "_g", "_ok")


def exclude_slots(cells: DataFrame, hosts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cells of other slots, (game_id, ticks) of the slots in hosts(game_id, slot)); done after the caps, so excluded slots use them up."""
    gone = hosts.select("game_id", "slot").distinct()
    removed = cells.join(gone, ["game_id", "slot"], "left_semi").groupBy("game_id").agg(F.sum("ticks").alias("ticks"))
    return cells.join(gone, ["game_id", "slot"], "left_anti"), removed


def saturated(cells: DataFrame) -> DataFrame:
    """Counters held at the parser's limit."""
    return cells.withColumn("ticks", F.least(F.col("ticks"), F.lit(COUNTER_LIMIT).cast("bigint")))


def faults(cells: DataFrame, slot_cells: int = SLOT_CELLS, game_cells: int = GAME_CELLS) -> DataFrame:
    """(game_id, code) of games whose finished cells (game_id, slot, cx, cy, cz, ticks) can't be right.

    `invalid_slot`, `invalid_cell` (a null place, or a counter outside 1 to the limit), `duplicate_cell`,
    `slot_cell_limit` and `global_cell_limit`.  Places are counted before they are gathered by slot and by game.
    """
    spots = cells.groupBy("game_id", "slot", "cx", "cy", "cz").agg(F.count("*").alias("n"), F.min(F.coalesce("ticks", F.lit(0))).alias("low"), F.max("ticks").alias("high"))
    gap = F.col("cx").isNull() | F.col("cy").isNull() | F.col("cz").isNull()
    flags = {"invalid_slot": ~F.coalesce(F.col("slot").between(0, 63), F.lit(False)), "invalid_cell": gap | (F.col("low") < 1) | (F.col("high") > COUNTER_LIMIT), "duplicate_cell": F.col("n") > 1}
    slots = spots.groupBy("game_id", "slot").agg(F.count("*").alias("cells"), *[F.max(c).alias(k) for k, c in flags.items()])
    games = slots.groupBy("game_id").agg(*[F.max(k).alias(k) for k in flags], (F.max("cells") > slot_cells).alias("slot_cell_limit"), (F.sum("cells") > game_cells).alias("global_cell_limit"))
    codes = F.array_compact(F.array(*[F.when(F.col(k), F.lit(k)) for k in (*flags, "slot_cell_limit", "global_cell_limit")]))
    return games.select("game_id", F.explode(codes).alias("code"))


def discards(classified: DataFrame, capped_cells: DataFrame | None = None, removed: DataFrame | None = None) -> DataFrame:
    """(game_id, reason, n) of everything that no voxel holds; reasons without samples are left out."""
    parts = [classified.where("reason is not null").groupBy("game_id", "reason").agg(F.count("*").alias("n"))]
    if capped_cells is not None:
        parts.append(capped_cells.where("cap is not null").groupBy("game_id", F.col("cap").alias("reason")).agg(F.sum("ticks").alias("n")))
    if removed is not None:
        parts.append(removed.select("game_id", F.lit("hostman").alias("reason"), F.col("ticks").alias("n")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("game_id", "reason").agg(F.sum("n").alias("n")).where("n > 0")


def coverage(cells: DataFrame, samples: DataFrame) -> DataFrame:
    """One row a game: samples seen, observations, distinct cells, slots observed in order, status."""
    seen = samples.groupBy("game_id").agg(F.count("*").alias("samples_seen"))
    own = cells.groupBy("game_id").agg(F.sum("ticks").alias("observations"), F.count("*").alias("cells"), F.sort_array(F.collect_set("slot")).alias("slots"))
    out = seen.join(own, "game_id", "left")
    return out.select("game_id", "samples_seen", F.coalesce("observations", F.lit(0)).cast("bigint").alias("observations"), F.coalesce("cells", F.lit(0)).cast("bigint").alias("cells"), F.coalesce("slots", F.array().cast("array<int>")).alias("slots"), F.when(F.coalesce("cells", F.lit(0)) > 0, "available").otherwise("unavailable").alias("status"))
