"""Readers of replay documents, work items, artifacts and logs."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Collection, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.functions import coerce as C
from tickforge.functions.sanitise import viewed

#: The parts of a replay document that are read; fields that may have any type are VARIANT.
PLAYER = "STRUCT<player_index: VARIANT, local_player: VARIANT, name: VARIANT, player_name: VARIANT, team: VARIANT, score: VARIANT, ctf_score: VARIANT, kills: VARIANT, deaths: VARIANT, assists: VARIANT, suicides: VARIANT, team_kills: VARIANT, player_quit: VARIANT, derived_stats: STRUCT<is_host: VARIANT, is_hostman: VARIANT>, player_object_data: STRUCT<x: VARIANT, y: VARIANT, z: VARIANT>>"
TICK = f"STRUCT<multiplayer_map_name: STRING, game_type: VARIANT, variant: VARIANT, current_time: STRING, start_time: STRING, game_id: VARIANT, game_ended_this_tick: BOOLEAN, map_info: VARIANT, game_time_info: VARIANT, network_game_client: VARIANT, spawns: VARIANT, players: ARRAY<{PLAYER}>>"
REPLAY = f"summary STRUCT<game_id: VARIANT, is_full_game: BOOLEAN, recording_started: STRING, recording_ended: STRING, game_duration_ingame: STRING, ticks_elapsed: BIGINT, ticks_recorded: BIGINT, ticks_dropped: BIGINT, recording_duration: STRING>, game_meta VARIANT, gametype_settings VARIANT, network_game_client VARIANT, participant_context VARIANT, spawns VARIANT, events ARRAY<VARIANT>, ticks ARRAY<{TICK}>"
PARTS = ("summary", "game_meta", "gametype_settings", "network_game_client", "participant_context", "spawns", "events", "ticks")

ACCESS_LOG = "ts TIMESTAMP, requestId STRING, requestTime STRING, httpMethod STRING, path STRING, routeKey STRING, protocol STRING, status STRING, responseLength STRING, responseLatency STRING, integrationStatus STRING, integrationLatency STRING, integrationRequestId STRING, integrationErrorMessage STRING, errorMessage STRING, errorMessageString STRING, errorResponseType STRING, authorizerError STRING, sourceIp STRING, userAgent STRING, domainName STRING, stage STRING, apiId STRING, accountId STRING, extendedRequestId STRING"

#: Limits of a decoded artifact and of the bytes it is stored in.
MOST_DECODED, MOST_STORED = 64 << 20, 10 << 20


def read_replays(spark: SparkSession, path: str) -> DataFrame:
    """One row a file: file, and the REPLAY columns.  Files are .json, .json.gz, .json.zst or .zip with one .json.

    The codec follows from the name.  A file that is no replay gives a row with null columns and error set.
    """
    text = spark.read.option("pathGlobFilter", "*.{json,gz,zst}").text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("doc"), F.lit(None).cast("string").alias("error"))
    zipped = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path).select(F.col("path").alias("file"), "content")

    def members(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            docs, errors = [], []
            for content in part["content"]:
                doc, error = None, None
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        names = [n for n in z.namelist() if n.lower().endswith(".json") and not n.endswith("/")]
                        if len(names) == 1:
                            doc = z.read(names[0]).decode("utf-8")
                        else:
                            error = "zip_needs_one_json"
                except (zipfile.BadZipFile, UnicodeDecodeError):
                    error = "bad_zip"
                docs.append(doc)
                errors.append(error)
            yield pd.DataFrame({"file": part["file"], "doc": docs, "error": errors})

    return parse(text.unionByName(zipped.mapInPandas(members, "file string, doc string, error string")))


def parse(rows: DataFrame) -> DataFrame:
    """Documents (file, doc as text, error) as the REPLAY columns; a document that is no replay gets nulls and error set."""
    parsed = rows.withColumn("r", F.from_json("doc", f"{REPLAY}, _bad STRING", {"columnNameOfCorruptRecord": "_bad"}))
    error = F.coalesce("error", F.when(F.col("r").isNull() | F.col("r._bad").isNotNull(), F.lit("bad_json")))
    return parsed.select("file", error.alias("error"), *[F.when(error.isNull(), F.col(f"r.{n}")).alias(n) for n in PARTS])


def game_key(replays: DataFrame) -> DataFrame:
    """Add game_id: what the summary or the last tick says, else the file."""
    own = F.coalesce(C.text(C.as_text(F.col("summary.game_id"))), C.text(C.as_text(F.element_at("ticks", -1)["game_id"])), F.col("file"))
    return replays.withColumn("game_id", F.when(F.size("ticks") > 0, own).otherwise(F.coalesce(C.text(C.as_text(F.col("summary.game_id"))), F.col("file"))))


#: What `scanned` can keep of a document.
SCANNED = ("ends", "samples", "network", "explicit", "meta")


def scanned(replays: DataFrame, parts: Collection[str]) -> DataFrame:
    """(game_id, error, and the columns of parts) of keyed documents, narrowed so that they can be written after one parse.

    `ends` gives ticks, the first and the last without the players' places; `samples` gives all_ticks, with the places and
    what decides their use; `network`, `explicit` (participant_context) and `meta` (game_meta) give VARIANT columns.  Rows
    with an error stay: a filter in front of the parser would make Spark parse for the filter and again for the rows.
    """
    of_end = lambda t: F.struct(F.transform(t["players"], lambda p: p.dropFields("player_object_data")).alias("players"))
    of_all = lambda t: F.struct(F.transform(t["players"], lambda p: F.struct(*[p[n].alias(n) for n in ("player_index", "derived_stats", "player_object_data")])).alias("players"))
    ends = F.when(F.size("ticks") > 0, F.transform(F.array(F.get("ticks", F.lit(0)), F.element_at("ticks", -1)), of_end))
    columns = {"ends": ends.alias("ticks"), "samples": F.transform("ticks", of_all).alias("all_ticks"), "network": F.col("network"), "explicit": F.col("participant_context"), "meta": F.col("game_meta")}
    return _network(replays).select("game_id", "error", *[columns[p] for p in SCANNED if p in parts])


def player_samples(replays: DataFrame) -> DataFrame:
    """(game_id, tick, pos, slot, hostman, has_object, x, y, z, missing) of every player in every tick, in array order."""
    t = replays.select("game_id", F.posexplode("ticks").alias("tick", "t")).select("game_id", "tick", F.posexplode("t.players").alias("pos", "p"))
    d = F.col("p.player_object_data")
    absent = F.lit(False)
    for a in "xyz":
        absent = absent | d[a].isNull()
    # one projection for each step, so that Spark computes each once
    values = {"i": F.col("p.player_index"), **{a: d[a] for a in "xyz"}}
    t = t.select("game_id", "tick", "pos", C.as_text(F.col("p.derived_stats.is_hostman")).alias("hostman"), d.isNotNull().alias("has_object"), absent.alias("missing"), values["i"].isNull().alias("no_index"), *[F.schema_of_variant(v).alias(f"{n}_kind") for n, v in values.items()], *[F.try_variant_get(v, "$", "string").alias(f"{n}_raw") for n, v in values.items()])
    t = t.withColumns({n: F.when(~F.col(f"{n}_kind").rlike("^(?:OBJECT|ARRAY|BOOLEAN)"), F.col(f"{n}_raw")) for n in values}).withColumns({n: C.number(F.col(n)) for n in values})
    slot = F.coalesce(C.slot_of(F.col("i")), F.when(F.col("no_index"), F.col("pos")))
    return t.select("game_id", "tick", "pos", slot.cast("int").alias("slot"), F.coalesce(C.boolean(F.col("hostman")), F.lit(False)).alias("hostman"), "has_object", *[C.finite(F.col(a)).alias(a) for a in "xyz"], "missing")


def end_players(replays: DataFrame) -> DataFrame:
    """Players of the first and the last tick as text columns: what operators.replay takes."""
    ends = replays.where(F.size("ticks") > 0).select("game_id", F.explode(F.array(F.struct(F.lit("first").alias("moment"), F.get("ticks", F.lit(0)).alias("t")), F.struct(F.lit("last").alias("moment"), F.element_at("ticks", -1).alias("t")))).alias("e"))
    p = ends.select("game_id", "e.moment", F.posexplode("e.t.players").alias("pos", "p"))
    whole = ("player_index", "local_player", "team", "score", "ctf_score", "kills", "deaths", "assists", "suicides", "team_kills")
    return p.select("game_id", "moment", "pos", *[C.as_text(F.col(f"p.{n}")).alias(n) for n in ("name", "player_name")], *[C.as_whole(F.col(f"p.{n}")).alias(n) for n in whole], F.col("p.team").isNotNull().alias("team_given"), C.as_text(F.col("p.derived_stats.is_host")).alias("is_host"), C.as_text(F.col("p.derived_stats.is_hostman")).alias("is_hostman"))


def event_counts(replays: DataFrame, sample: int = 10) -> DataFrame:
    """(game_id, ticks, events, sample): sizes of both arrays and the first events as JSON."""
    return replays.select("game_id", F.coalesce(F.size("ticks"), F.lit(0)).alias("ticks"), F.coalesce(F.size("events"), F.lit(0)).alias("events"), F.transform(F.slice(F.coalesce("events", F.array().cast("array<variant>")), 1, sample), lambda e: F.to_json(e)).alias("sample"))


def work_items(messages: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(objects, jobs, rejects) of queue messages (id, body): storage events, reprocess jobs, and what is neither.

    A body may wrap its payload as text under Message.  Objects without a bucket or key are skipped; keys are
    URL-decoded.  A job needs its ids, its mode and where its source lies.  A bad message never fails the others."""
    outer = F.try_parse_json("body")
    inner = F.try_parse_json(F.try_variant_get(outer, "$.Message", "string"))
    m = messages.select("id", F.coalesce(inner, outer).alias("p"))
    s3 = "ARRAY<STRUCT<eventName: STRING, s3: STRUCT<bucket: STRUCT<name: STRING>, object: STRUCT<key: STRING>>>>"
    records = F.try_variant_get("p", "$.Records", s3)
    objects = m.select("id", F.explode(records).alias("r")).select("id", F.col("r.s3.bucket.name").alias("bucket"), F.try_url_decode("r.s3.object.key").alias("key"), F.col("r.eventName").alias("event_name")).where("bucket <> '' and key <> ''")
    get = lambda p: C.text(F.try_variant_get("p", p, "string"))
    fields = {"job_id": "$.job_id", "operation_id": "$.operation_id", "attempt_id": "$.attempt_id", "mode": "$.mode", "trigger": "$.trigger", "replay_id": "$.replay.id", "game_id": "$.replay.game_id", "upload_id": "$.replay.upload_id", "bucket": "$.source_replay.s3_bucket", "key": "$.source_replay.s3_key", "role": "$.current_replay_file.file_role", "sha256": "$.current_replay_file.sha256"}
    jobs = m.where(records.isNull()).select("id", *[get(p).alias(n) for n, p in fields.items()], F.try_variant_get("p", "$.current_replay_file.size_bytes", "bigint").alias("size_bytes"))
    valid = F.col("job_id").isNotNull() & F.col("attempt_id").isNotNull() & (F.col("mode") == "full_reparse") & F.col("upload_id").isNotNull() & F.col("bucket").isNotNull() & F.col("key").isNotNull()
    good = jobs.where(F.coalesce(valid, F.lit(False)))
    bad = m.where(records.isNull()).join(good.select("id"), "id", "left_anti").select("id", F.when(F.col("p").isNull(), "bad_json").otherwise("bad_job").alias("error"))
    return objects, good, bad


def unprocessed(items: DataFrame, prefix: str) -> DataFrame:
    """Objects (key, ...) that uploads have made: those under the prefix, and of them those whose event, if there is one, is a creation."""
    made = F.col("event_name").isNull() | F.col("event_name").startswith("ObjectCreated:") if "event_name" in items.columns else F.lit(True)
    return items.where(F.col("key").startswith(prefix) & made)


def verified(files: DataFrame, manifests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, rejects) of artifacts: files (path, content, length) whose size and SHA-256 are what manifests (path, size_bytes, sha256) say."""
    j = manifests.join(files.select("path", "content", "length"), "path", "left")
    error = (
        F.when(F.col("content").isNull(), "missing_artifact")
        .when(F.col("length") > MOST_STORED, "artifact_too_large")
        .when(F.col("length") != F.col("size_bytes"), "size_mismatch")
        .when(F.sha2("content", 256) != F.lower("sha256"), "hash_mismatch")
    )
    j = j.withColumn("error", error)
    return j.where("error is null").drop("error"), j.where("error is not null").select("path", "error")


def page(df: DataFrame, revision: int, after: str | None, most: int, key: str = "game_id") -> DataFrame:
    """The next page of a pinned revision in key order."""
    rows = df.where(F.col("source_revision") == revision)
    return (rows.where(F.col(key) > after) if after is not None else rows).orderBy(key).limit(most)


def objects(spark: SparkSession, path: str, prefix: str = "", suffix: str = "") -> DataFrame:
    """(key, size, modified) of stored files whose name begins and ends as given; contents are not read."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    return rows.where(name.startswith(prefix) & name.endswith(suffix)).select(F.col("path").alias("key"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def journal(rows: DataFrame, now: Column, days: int = 7) -> DataFrame:
    """Records of a change journal (at, ...) that have not expired."""
    return rows.where(F.col("at") > now - F.make_dt_interval(F.lit(days)))


def digests(files: DataFrame) -> DataFrame:
    """(path, length, sha256) of read files (path, content, length)."""
    return files.select("path", "length", F.sha2("content", 256).alias("sha256"))


def read_lines(spark: SparkSession, path: str, stamp: str = r"^(\S+)") -> DataFrame:
    """(ts, message) of text logs; the time is what the pattern's group finds, null if it is none."""
    rows = spark.read.text(path)
    return rows.select(C.timestamp(F.regexp_extract("value", stamp, 1)).alias("ts"), F.col("value").alias("message"))


def read_access_log(spark: SparkSession, path: str) -> DataFrame:
    """The gateway's access log of JSON lines: all fields are texts, but for the time."""
    return spark.read.schema(ACCESS_LOG).json(path)


def _exploded(replays: DataFrame, path: str) -> DataFrame:
    """(game_id, pos, key, v) of a VARIANT object or list found by a SQL expression."""
    return viewed(replays, lambda name: f"SELECT game_id, e.pos, coalesce(e.key, cast(e.pos AS STRING)) AS key, e.value AS v FROM (SELECT game_id, {path} AS doc FROM {name}) d, LATERAL variant_explode(doc) e WHERE doc IS NOT NULL AND NOT is_variant_null(doc)")


# Names of a player's maps and numbers.
_MAPS = ("shots_by_weapon", "damage_to_player", "damage_from_player", "shots_by_tick", "kills_by_tick", "deaths_by_tick", "assists_by_tick", "streak_by_tick", "streak_counts_by_amount", "multikills_by_tick", "multikill_counts_by_amount")
_SCALARS = ("damage_dealt", "damage_received", "camo_count", "overshield_count")


def meta_players(replays: DataFrame, most: int = 64) -> DataFrame:
    """(game_id, slot, scalars as text, maps of text) of the players under game_meta; the by-weapon and by-player maps keep their first entries."""
    rows = _exploded(replays, "try_variant_get(game_meta, '$.players', 'variant')")
    as_map = lambda n: F.try_variant_get("v", f"$.{n}", "map<string,string>")
    first = lambda m: F.map_from_entries(F.slice(F.map_entries(m), 1, most))
    maps = [(first(as_map(n)) if n in _MAPS[:3] else as_map(n)).alias(n) for n in _MAPS]
    return rows.select("game_id", C.integer(F.col("key")).cast("int").alias("slot"), *[C.as_text(F.try_variant_get("v", f"$.{n}", "variant")).alias(n) for n in _SCALARS], *maps).where("slot is not null")


def _network(replays: DataFrame) -> DataFrame:
    """The network client: of the document if it is not empty, else of the first tick that has one; scanned documents have it."""
    if "network" in replays.columns:
        return replays
    full = lambda v: F.schema_of_variant(v).startswith("OBJECT") & (F.schema_of_variant(v) != "OBJECT<>")
    of_ticks = F.get(F.filter(F.transform("ticks", lambda t: t["network_game_client"]), lambda v: F.coalesce(full(v), F.lit(False))), F.lit(0))
    return replays.withColumn("network", F.when(F.coalesce(full(F.col("network_game_client")), F.lit(False)), F.col("network_game_client")).otherwise(of_ticks))


def network_players(replays: DataFrame) -> DataFrame:
    """Rows for operators.replay.network_contexts."""
    rows = _exploded(_network(replays), "try_variant_get(network, '$.network_game_data.network_players', 'variant')")
    return rows.select("game_id", "pos", *[C.as_whole(F.try_variant_get("v", f"$.{n}", "variant")).alias(n) for n in ("player_list_index", "machine_index", "controller_index")])


def machines(replays: DataFrame) -> DataFrame:
    """(game_id, machine) that recorded the game."""
    return _network(replays).select("game_id", C.truncated(C.as_whole(F.try_variant_get("network", "$.machine_index", "variant"))).cast("int").alias("machine")).where("machine is not null")


def explicit_players(replays: DataFrame) -> DataFrame:
    """Rows for operators.replay.explicit_contexts."""
    rows = _exploded(replays, "try_variant_get(participant_context, '$.players', 'variant')")
    of = lambda n: F.try_variant_get("v", f"$.{n}", "variant")
    whole = ("slot_index", "player_list_index", "player_index", "machine_index", "controller_index")
    return rows.select("game_id", "pos", "key", *[C.as_whole(of(n)).alias(n) for n in whole], *[C.as_text(of(n)).alias(n) for n in ("is_host", "is_hostman", "screen_slot", "screen_layout")])


def game_ends(replays: DataFrame) -> DataFrame:
    """One row a game: what operators.replay.games and graph_coverage take from the summary and both end ticks."""
    first, last = F.get("ticks", F.lit(0)), F.when(F.size("ticks") > 0, F.element_at("ticks", -1))
    t = replays.select("game_id", "summary", "gametype_settings", first.alias("f"), last.alias("l"))
    text = lambda c: C.as_text(F.col(c))
    setting = lambda n: C.as_text(F.try_variant_get("gametype_settings", f"$.{n}", "variant"))
    filled = lambda v: F.coalesce(F.schema_of_variant(v).startswith("OBJECT") & (F.schema_of_variant(v) != "OBJECT<>"), F.lit(False))
    info = F.when(filled(F.col("l.map_info")), F.col("l.map_info")).otherwise(F.col("f.map_info"))
    about = lambda n: C.as_text(F.try_variant_get(info, f"$.{n}", "variant"))

    def time(at: str, n: str) -> Column:
        return C.as_text(F.try_variant_get(f"{at}.game_time_info", f"$.{n}", "variant"))

    from tickforge.operators.replay import recorded_seconds

    tick = {at: C.nonnegative(time(at, "game_time")) for at in "fl"}
    secs = {at: recorded_seconds([time(at, n) for n in ("elapsed_seconds", "time_seconds", "game_time_seconds", "current_game_time_seconds")], tick[at], time(at, "real_time_elapsed")) for at in "fl"}
    return t.select(
        "game_id", F.col("l.multiplayer_map_name").alias("last_map_name"), F.col("f.multiplayer_map_name").alias("first_map_name"), text("l.game_type").alias("last_game_type"), text("f.game_type").alias("first_game_type"), text("l.variant").alias("last_variant"), text("f.variant").alias("first_variant"),
        setting("mode").alias("settings_mode"), setting("name").alias("settings_name"), F.col("summary.is_full_game").alias("is_full_game"), F.col("l.game_ended_this_tick").alias("game_ended"), F.col("summary.recording_started").alias("recording_started"), F.col("f.start_time").alias("first_start_time"),
        F.col("summary.recording_ended").alias("recording_ended"), F.col("l.current_time").alias("last_current_time"), F.col("summary.game_duration_ingame").alias("duration"), tick["f"].alias("first_tick"), tick["l"].alias("last_tick"), secs["f"].alias("first_seconds"), secs["l"].alias("last_seconds"),
        about("game_release_key").alias("game_release_key"), about("cache_family").alias("cache_family"), about("cache_version").alias("cache_version"), about("cache_version_name").alias("cache_version_name"), about("build_version").alias("build_version"),
    )


def spawns(replays: DataFrame) -> DataFrame:
    """(game_id, spawns): the document's list, else that of the first tick with one."""
    is_list = lambda v: F.coalesce(F.schema_of_variant(v).startswith("ARRAY"), F.lit(False))
    of_ticks = F.get(F.filter(F.transform("ticks", lambda t: t["spawns"]), is_list), F.lit(0))
    return replays.select("game_id", F.when(is_list(F.col("spawns")), F.col("spawns")).otherwise(of_ticks).alias("spawns")).where("spawns is not null")
