"""Time in regions: boxes over voxels, with totals by region, team and collection of regions.

Configurations are validated on the driver; they are small by their limits (100 regions, 50 collections, 20 sets, 16
boxes a region, 400 a set), so the boxes become a literal of the plan and matching needs no join.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickforge.functions.coerce import ROLLUP_LIMIT, TICKS_PER_SECOND, team_key, team_label, team_order

SNAP = 0.5
MOST_SETS, MOST_REGIONS, MOST_COLLECTIONS, MOST_BOXES, MOST_SET_BOXES, MOST_GROUPS = 20, 100, 50, 16, 400, 64
#: Selected cells times boxes that a scope may need.
MOST_CHECKS = 5_000_000
SPACE = "replay_world.v1"


class RegionError(ValueError):
    """A configuration or rollup that must not be used; code says why."""

    def __init__(self, code: str):
        super().__init__(code)
        self.code = code


@dataclass(frozen=True)
class Box:
    low: tuple[float, float, float]
    high: tuple[float, float, float]

    def cells(self, size: float) -> tuple[int, ...]:
        """Half-open bounds in cells of a size: exact for the snap size, else of cells whose centres lie inside."""
        at = (lambda v: round(v / SNAP)) if math.isclose(size, SNAP) else (lambda v: math.ceil(v / size - 0.5))
        return tuple(x for a, b in zip(self.low, self.high, strict=True) for x in (at(a), at(b)))


@dataclass(frozen=True)
class Region:
    id: str
    key: str
    boxes: tuple[Box, ...]
    label: str | None = None
    color: str | None = None


@dataclass(frozen=True)
class Collection:
    id: str
    key: str
    mode: str
    regions: tuple[str, ...]
    label: str | None = None


@dataclass(frozen=True)
class Configuration:
    revision: int
    hash: str
    regions: tuple[Region, ...]
    collections: tuple[Collection, ...]
    sets: tuple[dict, ...] = field(default=(), compare=False)

    @property
    def boxes(self) -> int:
        return sum(len(r.boxes) for r in self.regions)


def _need(ok: bool, code: str = "invalid_region_configuration") -> None:
    if not ok:
        raise RegionError(code)


def _real(v: object) -> float:
    _need(isinstance(v, int | float) and not isinstance(v, bool) and math.isfinite(v))
    return float(v)  # type: ignore[arg-type]


def _words(v: object, most: int, optional: bool = False) -> str | None:
    if v is None and optional:
        return None
    _need(isinstance(v, str) and 0 < len(v) <= most)
    return v  # type: ignore[return-value]


def _id(v: object) -> str:
    _need(isinstance(v, str))
    try:
        return str(uuid.UUID(v))  # type: ignore[arg-type]
    except ValueError:
        raise RegionError("invalid_region_configuration") from None


def _key(v: object) -> str:
    _need(bool(re.fullmatch(r"[a-z0-9][a-z0-9_-]*", _words(v, 80) or "")))
    return v  # type: ignore[return-value]


def _whole(v: object) -> int:
    _need(isinstance(v, int) and not isinstance(v, bool) and v >= 1)
    return v  # type: ignore[return-value]


def parse_box(v: object, space: str = SPACE) -> Box:
    """A box: known type, space and boundary, corners in order, within a million, on the snap grid."""
    _need(isinstance(v, Mapping) and v.get("type") == "axis_aligned_box" and v.get("coordinate_space") == space and v.get("boundary") == "min_inclusive_max_exclusive")
    _need(math.isclose(_real(v.get("snap_size")), SNAP))
    corner = []
    for name in ("min", "max"):
        _need(isinstance(v.get(name), Mapping))
        corner.append(tuple(_real(v[name].get(a)) for a in "xyz"))
    for a, b in zip(*corner, strict=True):
        _need(a < b and abs(a) <= 1e6 and abs(b) <= 1e6 and all(math.isclose(x / SNAP, round(x / SNAP)) for x in (a, b)))
    return Box(*corner)


def parse_region(v: object, space: str = SPACE) -> Region:
    """A region with one `geometry` or up to 16 different `geometries`."""
    _need(isinstance(v, Mapping))
    color = _words(v.get("display_color"), 7, True)
    _need(color is None or bool(re.fullmatch("#[0-9A-Fa-f]{6}", color)))
    raw = v.get("geometries")
    _need(raw is None or (isinstance(raw, list) and 1 <= len(raw) <= MOST_BOXES))
    boxes = tuple(parse_box(b, space) for b in ([v.get("geometry")] if raw is None else raw))
    _need(len(set(boxes)) == len(boxes))
    return Region(_id(v.get("id")), _key(v.get("key")), boxes, _words(v.get("display_name"), 160, True), color)


def parse_collection(v: object, known: set[str]) -> Collection:
    """A partition or overlay of different regions of its set."""
    _need(isinstance(v, Mapping) and v.get("analysis_mode") in ("partition", "overlay") and isinstance(v.get("region_ids"), list) and len(v["region_ids"]) <= MOST_REGIONS)
    ids = tuple(map(_id, v["region_ids"]))
    _need(len(set(ids)) == len(ids) and set(ids) <= known)
    return Collection(_id(v.get("id")), _key(v.get("key")), v["analysis_mode"], ids, _words(v.get("display_name"), 160, True))


def parse_configuration(v: object, revision: int | None = None, digest: str | None = None, space: str = SPACE) -> Configuration:
    """Validate a configuration document; revision and digest, if given, must be those it names."""
    _need(isinstance(v, Mapping) and isinstance(v.get("hash"), str) and bool(re.fullmatch("[0-9a-f]{64}", v["hash"].lower())))
    own, sets = _whole(v.get("revision")), v.get("sets")
    _need(revision in (None, own) and digest in (None, v["hash"].lower()) and v.get("coordinate_space") == space and isinstance(sets, list) and 1 <= len(sets) <= MOST_SETS)
    regions: list[Region] = []
    collections: list[Collection] = []
    seen: set[tuple[str, str]] = set()

    def once(*names: tuple[str, str]) -> None:
        _need(not any(n in seen for n in names))
        seen.update(names)

    shown = []
    for s in sets:
        _need(isinstance(s, Mapping) and isinstance(s.get("regions"), list) and isinstance(s.get("collections"), list) and isinstance(s.get("is_default", False), bool))
        _need(1 <= len(s["regions"]) <= MOST_REGIONS and len(s["collections"]) <= MOST_COLLECTIONS)
        sid = _id(s.get("id"))
        once(("set", sid), ("set-key", _key(s.get("key"))))
        name, version = _words(s.get("display_name"), 160), _whole(s.get("version"))
        mine = [parse_region(r, space) for r in s["regions"]]
        for r in mine:
            once(("region", r.id), (f"region-key {sid}", r.key))
        _need(sum(len(r.boxes) for r in mine) <= MOST_SET_BOXES, "region_configuration_limit_exceeded")
        some = [parse_collection(c, {r.id for r in mine}) for c in s["collections"]]
        for c in some:
            once(("collection", c.id), (f"collection-key {sid}", c.key))
        regions += mine
        collections += some
        shown.append({"id": sid, "key": s["key"], "display_name": name, "version": version, "is_default": s.get("is_default", False)})
    _need(len(regions) <= MOST_REGIONS and len(collections) <= MOST_COLLECTIONS, "region_configuration_limit_exceeded")
    return Configuration(own, v["hash"].lower(), tuple(regions), tuple(collections), tuple(shown))


def compatible_size(size: Column) -> Column:
    """Cell sizes from 0.5 to 1000 that are multiples of 0.5."""
    n = size / F.lit(SNAP)
    return F.coalesce(size.between(SNAP, 1000.0) & (F.abs(n - F.round(n)) <= F.abs(n) * 1e-9), F.lit(False))


def match(cells: DataFrame, conf: Configuration) -> DataFrame:
    """Add matched (ids of regions with a box around the cell) and checks (boxes tried, stopping at a region's first hit).

    Bounds in cells follow from each row's cell_size (Box.cells), whatever sizes there are; a null size matches nothing.
    The boxes are one literal, so the plan does not grow with their number.
    """
    size = F.col("cell_size")
    grid = F.abs(size - SNAP) <= 1e-9 * F.greatest(F.abs(size), F.lit(SNAP))
    listed = F.array(*[F.struct(F.lit(r.id).alias("id"), F.array(*[F.array(*[F.lit(float(v)) for ab in zip(b.low, b.high, strict=True) for v in ab]) for b in r.boxes]).alias("boxes")) for r in conf.regions])
    if not conf.regions:
        return cells.withColumns({"matched": F.array().cast("array<string>"), "checks": F.lit(0).cast("bigint")})

    def inside(box: Column) -> Column:
        at = lambda i: F.when(grid, F.round(F.get(box, F.lit(i)) / SNAP)).otherwise(F.ceil(F.get(box, F.lit(i)) / size - 0.5))
        ok = F.lit(True)
        for i, c in enumerate(("cx", "cy", "cz")):
            ok = ok & (F.col(c) >= at(2 * i)) & (F.col(c) < at(2 * i + 1))
        return F.coalesce(ok, F.lit(False))

    first = F.transform(listed, lambda r: F.struct(r["id"].alias("id"), F.size(r["boxes"]).alias("n"), F.array_position(F.transform(r["boxes"], inside), F.lit(True)).alias("k")))
    out = cells.withColumn("_first", first)
    matched = F.transform(F.filter("_first", lambda r: r["k"] > 0), lambda r: r["id"])
    checks = F.aggregate("_first", F.lit(0).cast("bigint"), lambda s, r: s + F.when(size.isNull(), 0).when(r["k"] > 0, r["k"]).otherwise(r["n"]))
    return out.withColumns({"matched": matched, "checks": checks}).drop("_first")


def begin(games: DataFrame) -> DataFrame:
    """Add compatible: games with an artifact of 30 ticks a second, a fitting cell size and status `available`.

    games: (scope_id, game_id, has_artifact, ticks_per_second, cell_size, status, discarded_samples)."""
    ok = (F.abs(F.col("ticks_per_second") - TICKS_PER_SECOND) <= 1e-9 * TICKS_PER_SECOND) & compatible_size(F.col("cell_size")) & (F.coalesce("status", F.lit("available")) == "available")
    return games.withColumn("compatible", F.col("has_artifact") & F.coalesce(ok, F.lit(False)))


def assign(games: DataFrame, participants: DataFrame, occupancy: DataFrame) -> DataFrame:
    """Cells of compatible games, with the participant of their slot (null: not selected), scope and size."""
    own = begin(games).where("compatible").select("scope_id", "game_id", "cell_size")
    return occupancy.drop("cell_size").join(own, "game_id").join(participants, ["scope_id", "game_id", "slot"], "left")


def grouped(matched: DataFrame, games: DataFrame) -> DataFrame:
    """Each selected cell once for all players and once for its team.

    Every scope of games has the group of all players, with a row of no ticks, so that it shows without any cell too.
    """
    held = matched.where("participant_id is not null").select("*", F.explode(F.array(F.lit("all"), team_key(F.col("team")))).alias("group_key"))
    none = games.select("scope_id").distinct().select("scope_id", F.lit("all").alias("group_key"), F.lit(0).cast("bigint").alias("ticks"), F.array().cast("array<string>").alias("matched"))
    return held.unionByName(none, allowMissingColumns=True)


def group_faults(groups: DataFrame, most: int = MOST_GROUPS) -> DataFrame:
    """(scope_id, code) of scopes with more groups than allowed, or whose ticks pass the limit of counters."""
    per = groups.groupBy("scope_id", "group_key").agg(F.sum("ticks").alias("t"))
    many = per.groupBy("scope_id").count().where(F.col("count") > most).select("scope_id", F.lit("rollup_group_limit_exceeded").alias("code"))
    return many.unionByName(per.where(F.col("t") > ROLLUP_LIMIT).select("scope_id", F.lit("rollup_counter_overflow").alias("code"))).distinct()


def group_totals(groups: DataFrame) -> DataFrame:
    k = F.col("group_key")
    return groups.groupBy("scope_id", "group_key").agg(F.sum("ticks").alias("observed")).withColumns({"label": team_label(k), "position": team_order(k)})


def region_totals(groups: DataFrame, conf: Configuration) -> DataFrame:
    """(scope_id, group_key, region_id, ticks, share_of_group, share_of_region), zero rows included."""
    spark = groups.sparkSession
    dims = F.broadcast(spark.createDataFrame([(r.id,) for r in conf.regions], "region_id string"))
    hit = groups.select("scope_id", "group_key", "ticks", F.explode("matched").alias("region_id")).groupBy("scope_id", "group_key", "region_id").agg(F.sum("ticks").alias("ticks"))
    spine = group_totals(groups).select("scope_id", "group_key", "observed", F.lit(1).alias("_j")).join(dims.withColumn("_j", F.lit(1)), "_j").drop("_j")
    out = spine.join(hit, ["scope_id", "group_key", "region_id"], "left").withColumn("ticks", F.coalesce("ticks", F.lit(0)).cast("bigint"))
    whole = out.where("group_key = 'all'").select("scope_id", "region_id", F.col("ticks").alias("_all"))
    out = out.join(whole, ["scope_id", "region_id"], "left")
    return out.select("scope_id", "group_key", "region_id", "ticks", (F.col("ticks") / float(TICKS_PER_SECOND)).alias("seconds"), F.try_divide(F.col("ticks").cast("double"), F.col("observed").cast("double")).alias("share_of_group"), F.try_divide(F.col("ticks").cast("double"), F.coalesce("_all", F.lit(0)).cast("double")).alias("share_of_region"))


def collection_totals(groups: DataFrame, conf: Configuration) -> DataFrame:
    """(scope_id, group_key, collection_id, mode, member_ticks, union_ticks, outside_ticks, overlap_ticks, outside_share).

    Members, union and overlap are sums over the same pass: a cell's matches with the collection are counted in place."""
    aggs = []
    for i, c in enumerate(conf.collections):
        n = F.size(F.array_intersect("matched", F.array(*map(F.lit, c.regions)).cast("array<string>")))
        aggs += [F.sum(F.col("ticks") * n).alias(f"m{i}"), F.sum(F.when(n > 0, F.col("ticks")).otherwise(0)).alias(f"u{i}"), F.sum(F.when(n > 1, F.col("ticks")).otherwise(0)).alias(f"o{i}")]
    wide = groups.groupBy("scope_id", "group_key").agg(F.sum("ticks").alias("observed"), *aggs)
    one = [F.struct(F.lit(c.id).alias("collection_id"), F.lit(c.mode).alias("mode"), F.col(f"m{i}").alias("member_ticks"), F.col(f"u{i}").alias("union_ticks"), F.col(f"o{i}").alias("overlap_ticks")) for i, c in enumerate(conf.collections)]
    if not one:
        return wide.sparkSession.createDataFrame([], "scope_id string, group_key string, collection_id string, mode string, member_ticks long, union_ticks long, outside_ticks long, overlap_ticks long, outside_share double")
    out = wide.select("scope_id", "group_key", "observed", F.inline(F.array(*one)))
    return out.select("scope_id", "group_key", "collection_id", "mode", "member_ticks", "union_ticks", (F.col("observed") - F.col("union_ticks")).alias("outside_ticks"), "overlap_ticks", F.try_divide((F.col("observed") - F.col("union_ticks")).cast("double"), F.col("observed").cast("double")).alias("outside_share"))


def coverage(games: DataFrame, participants: DataFrame, matched: DataFrame) -> DataFrame:
    """One row a scope: the summary of what contributed, what is missing, and whether coverage is complete.

    A game is missing if it gave no ticks; an incompatible one counts as both."""
    g = begin(games)
    per = matched.groupBy("scope_id", "game_id").agg(F.sum(F.when(F.col("participant_id").isNotNull(), F.col("ticks"))).alias("t"), F.sum(F.when(F.col("participant_id").isNull(), F.col("ticks"))).alias("d"))
    precision = F.when(F.col("compatible"), F.when(F.abs(F.col("cell_size") - SNAP) <= SNAP * 1e-9, "grid_exact").otherwise("voxel_center"))
    a = g.join(per, ["scope_id", "game_id"], "left").groupBy("scope_id").agg(
        F.count("*").alias("games_selected"), F.count_if(F.col("t") > 0).alias("games_contributing"), F.count_if(~F.coalesce(F.col("t") > 0, F.lit(False))).alias("games_missing_data"),
        F.count_if(F.col("has_artifact") & ~F.col("compatible")).alias("incompatible_games"), F.coalesce(F.sum("t"), F.lit(0)).alias("observed_ticks"), F.coalesce(F.sum("d"), F.lit(0)).alias("discarded_ticks"),
        F.coalesce(F.sum(F.when(F.col("compatible"), F.greatest(F.coalesce("discarded_samples", F.lit(0)), F.lit(0)))), F.lit(0)).cast("bigint").alias("discarded_samples"),
        F.sort_array(F.collect_set(F.when(F.col("compatible"), F.col("cell_size")))).alias("cell_sizes"), F.collect_set(precision).alias("_p"),
    )
    b = participants.groupBy("scope_id").agg(F.count("*").alias("participants_selected"))
    c = matched.where("participant_id is not null").groupBy("scope_id").agg(F.countDistinct("participant_id").alias("participants_contributing"), F.sum("checks").alias("membership_checks"), F.count("*").alias("source_cells"))
    out = a.join(b, "scope_id", "left").join(c, "scope_id", "left")
    zero = {n: F.coalesce(n, F.lit(0)).cast("bigint") for n in ("participants_selected", "participants_contributing", "membership_checks", "source_cells")}
    complete = (F.col("games_missing_data") == 0) & (F.col("incompatible_games") == 0) & (F.col("discarded_ticks") == 0) & (F.col("discarded_samples") == 0)
    how = F.when(F.size("_p") > 1, "mixed").otherwise(F.coalesce(F.get("_p", F.lit(0)), F.lit("grid_exact")))
    return out.withColumns({**zero, "coverage_complete": complete, "membership_precision": how}).drop("_p")


def over_budget(matched: DataFrame, conf: Configuration, limit: int = MOST_CHECKS) -> DataFrame:
    """Scopes whose selected cells times all boxes pass the work limit."""
    work = matched.where("participant_id is not null").groupBy("scope_id").agg((F.count("*") * conf.boxes).alias("work"))
    return work.where(F.col("work") > limit).select("scope_id", "work", F.lit("region_membership_limit_exceeded").alias("code"))
