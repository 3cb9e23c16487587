"""Artifacts: JSON documents of occupancy, heatmaps and regions, packed on the executors, and back from them to rows.

A document is one string with its keys in order.  What goes into one document is bounded: the cells of a game by the
caps of occupancy, a heatmap by its size in bytes, which is summed up before anything is gathered, and a region
document by the limits of groups and configurations.  Scopes beyond a limit are refused with a code and not gathered.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickforge.functions.coerce import TICKS_PER_SECOND, team_label, team_order
from tickforge.operators import heatmap as H
from tickforge.operators import regions as R
from tickforge.operators import validate as V

#: Bytes of a document before and after packing.
SPATIAL_BYTES, HEATMAP_BYTES, REGION_BYTES = (64 << 20, 10 << 20), (256 << 20, 64 << 20), (32 << 20, 16 << 20)
HEATMAP_SCHEMA, REGION_SCHEMA, PLANE = "tickforge.heatmap.v1", "tickforge.regions.v1", "map_render_world.v1"
_UNITS = {"occupancy": "observed_ticks", "killer_position": "events", "victim_position": "events"}
_KEPT_NULLS = {"ignoreNullFields": "false"}


def _sorted(*parts: str) -> Column:
    """The last part of every row of a group, in the order of the parts before it."""
    return F.transform(F.sort_array(F.collect_list(F.struct(*parts))), lambda x: x[parts[-1]])


def _team(key: Column) -> Column:
    return F.when(key.startswith("team:") & (key != "team:none"), F.substring_index(key, ":", -1).cast("int"))


def spatial_documents(cells: DataFrame, games: DataFrame, coverage: DataFrame) -> DataFrame:
    """(game_id, document) of every game of games (game_id, cell_size, source_sha256), cells in order of slot and place.

    cells: (game_id, slot, cx, cy, cz, ticks), after the caps.  coverage: as occupancy.coverage gives it.
    """
    row = F.struct(F.array("cx", "cy", "cz").alias("cell"), F.col("ticks").alias("observed_ticks"), F.col("slot").alias("slot_index")).alias("row")
    held = cells.select("game_id", "slot", "cx", "cy", "cz", row).groupBy("game_id").agg(_sorted("slot", "cx", "cy", "cz", "row").alias("rows"))
    out = games.select("game_id", "cell_size", "source_sha256").join(held, "game_id", "left").join(coverage, "game_id", "left")
    seen = F.struct(F.col("cells").alias("distinct_cells"), F.col("observations").alias("position_observations"), "samples_seen", F.col("slots").alias("slots_observed"), F.struct(F.col("source_sha256").alias("replay_sha256")).alias("source"), "status")
    rows = F.coalesce("rows", F.array().cast(held.schema["rows"].dataType))
    doc = F.struct("cell_size", F.lit(V.SPACE).alias("coordinate_space"), seen.alias("coverage"), rows.alias("occupancy"), F.lit(V.ARTIFACT_SCHEMA).alias("schema"), F.lit(TICKS_PER_SECOND).alias("ticks_per_second"))
    return out.select("game_id", F.to_json(doc, _KEPT_NULLS).alias("document"))


def heatmap_documents(cells: DataFrame, summary: DataFrame, claims: DataFrame, most: int = HEATMAP_BYTES[0]) -> tuple[DataFrame, DataFrame]:
    """((scope_id, document, cells), refused (scope_id, code)) of the scopes of claims.

    cells and summary: as heatmap.cells and heatmap.summary give them; a metric without cells has no groups.
    claims: (scope_id, scope_type, map_id, player_id, eligibility, source_revision).
    """
    own = F.length(F.concat(*[F.col(c).cast("string") for c in ("px", "py", "value")])) + F.lit(len('{"cell":[,],"value":},'))
    large = cells.groupBy("scope_id").agg(F.sum(own).alias("bytes")).where(F.col("bytes") > most).select("scope_id", F.lit("artifact_too_large").alias("code"))
    refused = H.faults(cells).unionByName(large)
    gone = refused.select("scope_id").distinct()
    k = F.col("team_key")
    place = F.struct(F.array("px", "py").alias("cell"), "value").alias("place")
    groups = cells.join(gone, "scope_id", "left_anti").select("scope_id", "metric", "team_key", "px", "py", place).groupBy("scope_id", "metric", "team_key").agg(_sorted("px", "py", "place").alias("cells"))
    groups = groups.select("scope_id", "metric", team_order(k).alias("at"), F.size("cells").alias("n"), F.struct("cells", k.alias("key"), team_label(k).alias("label"), _team(k).alias("team_index")).alias("group"))
    groups = groups.groupBy("scope_id", "metric").agg(_sorted("at", "group").alias("groups"), F.sum("n").alias("n"))
    counts = F.struct("games_contributing", "games_selected", "participants_contributing", "participants_selected")
    unit = F.create_map(*[F.lit(x) for kv in _UNITS.items() for x in kv])[F.col("metric")]
    shown = summary.join(groups, ["scope_id", "metric"], "left").select("scope_id", "metric", "n", F.struct(F.coalesce("groups", F.array().cast(groups.schema["groups"].dataType)).alias("groups"), counts.alias("summary"), unit.alias("value_unit")).alias("m"))
    whole = shown.groupBy("scope_id").agg(*[F.first(F.when(F.col("metric") == n, F.col("m")), ignorenulls=True).alias(n) for n in sorted(_UNITS)], F.coalesce(F.sum("n"), F.lit(0)).alias("cells"))
    scope = F.struct("eligibility", "map_id", "player_id", "source_revision", F.col("scope_type").alias("type"))
    doc = F.struct(F.struct(*sorted(_UNITS)).alias("metrics"), F.lit(PLANE).alias("plane_coordinate_space"), F.lit(HEATMAP_SCHEMA).alias("schema"), scope.alias("scope"), F.lit(H.PLANE_CELL).alias("source_cell_size"), F.lit(V.SPACE).alias("source_coordinate_space"))
    out = claims.join(gone, "scope_id", "left_anti").join(whole, "scope_id")
    return out.select("scope_id", F.to_json(doc, _KEPT_NULLS).alias("document"), "cells"), refused


def region_documents(groups: DataFrame, coverage: DataFrame, claims: DataFrame, conf: R.Configuration, generated_at: Column) -> tuple[DataFrame, DataFrame]:
    """((scope_id, document), refused (scope_id, code)) of the scopes of claims, zero rows included.

    groups and coverage: as regions.grouped and regions.coverage give them; claims: as for heatmaps.
    """
    spark = groups.sparkSession
    refused = R.group_faults(groups)
    gone = refused.select("scope_id").distinct()
    groups = groups.join(gone, "scope_id", "left_anti")
    names = F.broadcast(spark.createDataFrame([(r.id, i, r.key, r.label, r.color) for i, r in enumerate(conf.regions)], "region_id string, at int, key string, label string, display_color string"))
    entry = F.struct("display_color", "key", "label", F.col("seconds").alias("observed_player_seconds"), F.col("ticks").alias("observed_player_ticks"), "region_id", F.col("share_of_group").alias("share_of_group_observed"), F.col("share_of_region").alias("share_of_region_observed")).alias("entry")
    regions = R.region_totals(groups, conf).join(names, "region_id").select("scope_id", "group_key", "at", entry).groupBy("scope_id", "group_key").agg(_sorted("at", "entry").alias("regions"))
    names = F.broadcast(spark.createDataFrame([(c.id, i, c.key, c.label) for i, c in enumerate(conf.collections)], "collection_id string, at int, key string, label string"))
    entry = F.struct(F.col("mode").alias("analysis_mode"), "collection_id", "key", "label", "member_ticks", "outside_share", "outside_ticks", "overlap_ticks", "union_ticks").alias("entry")
    collections = R.collection_totals(groups, conf).join(names, "collection_id").select("scope_id", "group_key", "at", entry).groupBy("scope_id", "group_key").agg(_sorted("at", "entry").alias("collections"))
    k = F.col("group_key")
    none = lambda df, c: F.coalesce(c, F.array().cast(df.schema[c].dataType)).alias(c)
    group = F.struct(none(collections, "collections"), k.alias("key"), "label", (F.col("observed") / float(TICKS_PER_SECOND)).alias("observed_player_seconds_total"), F.col("observed").alias("observed_player_ticks_total"), F.lit(None).cast("string").alias("participant_id"), none(regions, "regions"), _team(k).alias("team_index")).alias("group")
    shown = R.group_totals(groups).join(regions, ["scope_id", "group_key"], "left").join(collections, ["scope_id", "group_key"], "left").select("scope_id", "position", group).groupBy("scope_id").agg(_sorted("position", "group").alias("groups"))
    total = F.col("observed_ticks")
    summary = F.struct(
        "coverage_complete", "discarded_samples", F.col("discarded_ticks").alias("discarded_player_ticks"), "games_contributing", "games_missing_data", "games_selected", "incompatible_games", "membership_precision", (total / float(TICKS_PER_SECOND)).alias("observed_player_seconds_total"),
        total.alias("observed_player_ticks_total"), "participants_contributing", "participants_selected", F.col("membership_checks").alias("region_membership_checks"), F.col("cell_sizes").alias("source_cell_sizes"),
    )
    made = F.struct(F.lit(R.SPACE).alias("coordinate_space"), F.lit(conf.hash).alias("hash"), F.lit(conf.revision).alias("revision"))
    sets = F.parse_json(F.lit(json.dumps(list(conf.sets), sort_keys=True)))
    doc = F.struct(generated_at.alias("generated_at"), "groups", made.alias("region_configuration"), sets.alias("region_sets"), F.lit(REGION_SCHEMA).alias("schema"), F.struct("eligibility", "map_id", "player_id", F.col("scope_type").alias("type")).alias("scope"), "source_revision", summary.alias("summary"), F.lit(TICKS_PER_SECOND).alias("ticks_per_second"))
    return claims.join(shown, "scope_id").join(coverage, "scope_id").select("scope_id", F.to_json(doc, _KEPT_NULLS).alias("document")), refused


def pack(documents: DataFrame, key: str, limits: tuple[int, int]) -> DataFrame:
    """(key, content, size_bytes, decoded_size_bytes, sha256, error): ASCII JSON, gzipped at level 6 without a time.

    A document over one of the limits (before, after packing) has no content and the error artifact_too_large; a null
    one the error invalid_artifact.
    """
    plain, packed = limits
    schema = pa.schema([(key, pa.string()), ("content", pa.binary()), ("size_bytes", pa.int64()), ("decoded_size_bytes", pa.int64()), ("sha256", pa.string()), ("error", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, document in zip(batch.column(0), batch.column(1), strict=True):
                row = {key: name.as_py(), "error": "invalid_artifact"}
                if (text := document.as_py()) is not None:
                    text = text if text.isascii() else json.dumps(json.loads(text), separators=(",", ":"), sort_keys=True)
                    content = gzip.compress(text.encode(), 6, mtime=0) if len(text) <= plain else b""
                    row |= {"decoded_size_bytes": len(text), "error": "artifact_too_large"}
                    if 0 < len(content) <= packed:
                        row |= {"content": content, "size_bytes": len(content), "sha256": hashlib.sha256(content).hexdigest(), "error": None}
                yield pa.RecordBatch.from_pylist([row], schema)

    rows = documents.select(F.col(key).cast("string"), "document")
    return rows.mapInArrow(run, f"`{key}` string, content binary, size_bytes long, decoded_size_bytes long, sha256 string, error string")


def decode(files: DataFrame, key: str = "path", most: int = SPATIAL_BYTES[0]) -> DataFrame:
    """(key, document, decoded_size_bytes, error) of files (key, content, encoding), of which no more than most bytes are decoded.

    The encoding is `gzip` or `identity` (or null); other ones, broken or longer content, and what is no JSON object
    have the error invalid_artifact.
    """
    schema = pa.schema([(key, pa.string()), ("document", pa.string()), ("decoded_size_bytes", pa.int64()), ("error", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content, encoding in zip(*batch.columns, strict=True):
                row = {key: name.as_py(), "error": "invalid_artifact"}
                try:
                    raw = content.as_py()
                    if encoding.as_py() == "gzip":
                        with gzip.open(io.BytesIO(raw or b"")) as source:
                            raw = source.read(most + 1)
                    elif encoding.as_py() not in (None, "identity"):
                        raw = None
                    if raw is not None and len(raw) <= most and isinstance(json.loads(raw), dict):
                        row |= {"document": raw.decode(), "decoded_size_bytes": len(raw), "error": None}
                except (OSError, EOFError, zlib.error, ValueError, RecursionError):
                    pass
                yield pa.RecordBatch.from_pylist([row], schema)

    rows = files.select(F.col(key).cast("string"), "content", F.col("encoding").cast("string"))
    return rows.mapInArrow(run, f"`{key}` string, document string, decoded_size_bytes long, error string")


_SPATIAL = "schema string, coordinate_space string, cell_size double, ticks_per_second double, occupancy array<struct<slot_index: int, cell: array<bigint>, observed_ticks: bigint>>"
_GROUPS = "array<struct<key: string, cells: array<struct<cell: array<bigint>, value: bigint>>>>"


def spatial_rows(decoded: DataFrame, key: str = "path") -> tuple[DataFrame, DataFrame]:
    """((key, cell_size, slot, cx, cy, cz, ticks), rejects (key, error)) of decoded spatial documents."""
    sound = decoded.where("error is null").select(key, F.from_json("document", _SPATIAL).alias("d")).select(key, "d.*")
    good, bad = V.split(V.artifacts(sound))
    rows = good.select(key, "cell_size", F.explode("occupancy").alias("r"))
    rows = rows.select(key, "cell_size", F.col("r.slot_index").alias("slot"), *[F.get("r.cell", F.lit(i)).alias(c) for i, c in enumerate(("cx", "cy", "cz"))], F.col("r.observed_ticks").alias("ticks"))
    return rows, bad.select(key, "error").unionByName(decoded.where("error is not null").select(key, "error"))


def heatmap_rows(decoded: DataFrame, key: str = "scope_id") -> DataFrame:
    """(key, metric, team_key, px, py, value) of decoded heatmap documents."""
    metrics = ", ".join(f"{m}: struct<groups: {_GROUPS}>" for m in sorted(_UNITS))
    d = decoded.where("error is null").select(key, F.from_json("document", f"metrics struct<{metrics}>").alias("d"))
    each = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(f"d.metrics.{m}.groups").alias("groups")) for m in sorted(_UNITS)])
    rows = d.select(key, F.inline(each)).select(key, "metric", F.inline("groups")).select(key, "metric", F.col("key").alias("team_key") if key != "key" else "key", F.explode("cells").alias("c"))
    return rows.select(key, "metric", "team_key", F.get("c.cell", F.lit(0)).alias("px"), F.get("c.cell", F.lit(1)).alias("py"), F.col("c.value").alias("value"))


def region_rows(decoded: DataFrame, key: str = "scope_id") -> DataFrame:
    """(key, group_key, region_id, ticks, seconds, share_of_group, share_of_region) of decoded region documents."""
    fields = "struct<region_id: string, observed_player_ticks: bigint, observed_player_seconds: double, share_of_group_observed: double, share_of_region_observed: double>"
    d = decoded.where("error is null").select(F.col(key).alias("_name"), F.explode(F.from_json("document", f"groups array<struct<key: string, regions: array<{fields}>>>")["groups"]).alias("g"))
    rows = d.select("_name", F.col("g.key").alias("group_key"), F.explode("g.regions").alias("r"))
    return rows.select(F.col("_name").alias(key), "group_key", "r.region_id", F.col("r.observed_player_ticks").alias("ticks"), F.col("r.observed_player_seconds").alias("seconds"), F.col("r.share_of_group_observed").alias("share_of_group"), F.col("r.share_of_region_observed").alias("share_of_region"))
