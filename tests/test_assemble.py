"""Replay files to all tables, and the validation of what is passed between jobs."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tickforge.operators import validate as V
from tickforge.plans.assemble import tables
from tickforge.session import configure
from tickforge.sinks import generations as G
from tickforge.sources import replays as D


def document():
    players = [{"player_index": k, "name": f"N{k}", "team": k % 2, "kills": 2 - k, "deaths": 1, "score": 10 * k, "local_player": k, "player_object_data": {"x": k + 0.1, "y": -0.1, "z": 0}} for k in range(3)]
    tick = lambda n, ps: {"multiplayer_map_name": "levels\\arena", "variant": "Team", "game_time_info": {"game_time": n}, "players": ps, "map_info": {"game_release_key": "first_box", "cache_version": "7", "cache_family": "unknown"}}
    return {
        "summary": {"game_id": "g", "is_full_game": False, "recording_started": "2026-05-09 15:51:32"},
        "game_meta": {"players": {"0": {"damage_dealt": 2.5, "kills_by_tick": {"1": [[0, 0, 0]]}, "streak_by_tick": {"5": 4}}, "1": {"multikills_by_tick": {"3": [2, 3]}}}},
        "gametype_settings": {"mode": "Slayer", "name": "My Game", "score_limit": "25"},
        "network_game_client": {"machine_index": 0, "network_game_data": {"network_players": [{"player_list_index": 0, "machine_index": 0, "controller_index": 0}, {"player_list_index": 1, "machine_index": 1, "controller_index": 0}]}},
        "participant_context": {"players": {"2": {"is_hostman": True, "screen_slot": "FULL"}}},
        "ticks": [tick(30, players), {**tick(60, players), "spawns": [{"x": 1, "y": 2, "z": 3}]}, tick(90, players)],
    }


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    configure(spark)
    at = tmp_path_factory.mktemp("in")
    (at / "g.json").write_text(json.dumps(document()))
    (at / "bad.json").write_text("[")
    return {k: v.collect() for k, v in tables(D.read_replays(spark, str(at))).items()}


def test_game_row(made):
    (g,) = made["games"]
    assert (g.game_id, g.map_short_name, g.game_type, g.variant_name, g.status, g.started_at) == ("g", "arena", "slayer", "My Game", "imported", "2026-05-09T15:51:32Z")
    assert (g.winning_team, g.host_style, g.game_release_key, g.cache_version, g.cache_family) == (0, "on_off", "first_box", 7, None)
    doc = json.loads(made["documents"][0].document)
    assert [p["slot"] for p in doc["participants"]] == [0, 1, 2] and doc["facts"]["gametype.score_limit"] == "25" and len(doc["teams"]) == 2


def test_participants_and_facts(made):
    p = {r.slot: r for r in made["participants"]}
    assert (p[0].kills, p[0].damage_dealt, p[0].max_kill_streak) == (2, 2.5, 4) and tuple(p[1].multikills) == (1, 1, 0)
    f = {(r.slot, r.key): r.value for r in made["participant_facts"]}
    assert f[0, "participant.max_kill_streak"] == "4" and f[1, "participant.is_host"] == "false" and f[2, "participant.screen_slot"] == "full"


def test_occupancy_without_the_host_machine_player(made):
    assert {(r.slot, r.cx, r.ticks) for r in made["voxels"]} == {(0, 0, 3), (1, 2, 3)}
    assert [(r.reason, r.n) for r in made["discards"]] == [("hostman", 3)]
    assert made["coverage"][0].observations == 6 and made["coverage"][0].slots == [0, 1]


def test_graph_spawns_and_dead_letters(made):
    c = made["graph_coverage"][0]
    assert (c.first_tick, c.last_tick, c.first_seconds, c.last_seconds, c.starts_after_game_start) == (30, 90, 1.0, 3.0, True)
    assert sorted(r.slot for r in made["graph_players"]) == [0, 1]
    assert [(r.x, r.y, r.z) for r in made["spawn_points"]] == [(1, 2, 3)]
    assert [r.error for r in made["dead_letters"]] == ["bad_json"]


def test_claims(spark):
    good = ("s", "map", "m", None, "validated", 3, 2, 1, False, None, None)
    bad = [("s", "map", "m", "p", *good[4:]), ("s", "player_map", "m", None, *good[4:]), (*good[:4], "other", *good[5:]), (*good[:5], -1, *good[6:]), (*good[:7], 0, *good[8:]), (*good[:8], True, 1, "x"), (None, *good[1:])]
    schema = "scope_id string, scope_type string, map_id string, player_id string, eligibility string, source_revision int, built_revision int, next_generation int, region_stats_requested boolean, region_configuration_revision int, region_configuration_hash string"
    got = V.claims(spark.createDataFrame([good, (*good[:8], True, 1, "A" * 64), *bad], schema)).collect()
    assert [r.error for r in got] == [None, None] + ["invalid_claim"] * len(bad)


def test_manifests_artifacts_and_participants(spark):
    good = (V.ARTIFACT_SCHEMA, V.SPACE, 0.5, "b", "k", "gzip", 5, "a" * 64)
    bad = [("x", *good[1:]), (*good[:2], 0.75, *good[3:]), (*good[:5], "zip", *good[6:]), (*good[:6], 0, good[7]), (*good[:7], None)]
    got = V.manifests(spark.createDataFrame([good, *bad], "schema string, coordinate_space string, cell_size double, bucket string, key string, encoding string, size_bytes long, sha256 string")).collect()
    assert [r.error for r in got] == [None] + ["invalid_manifest"] * len(bad)
    art = lambda rows, size=1.0: (V.ARTIFACT_SCHEMA, V.SPACE, size, 30.0, rows)
    df = spark.createDataFrame([art([(0, [1, 2, 3], 1)]), art([]), art([(0, [1, 2], 1)]), art([(0, [1, 2, 3], 0)]), art([(-1, [1, 2, 3], 1)]), art(None), art([], 0.3)], "schema string, coordinate_space string, cell_size double, ticks_per_second double, occupancy array<struct<slot_index: int, cell: array<int>, observed_ticks: long>>")
    assert [r.error for r in V.artifacts(df).collect()] == [None, None] + ["invalid_artifact"] * 5
    p = spark.createDataFrame([("g", "a", 0, None), ("g", "b", 1, 64), ("g", "c", 2, -1), ("g", "d", 3, 1), ("g", "e", 3, 1)], "game_id string, participant_id string, slot int, team int")
    ok, rejects = V.split(V.participants(p))
    assert sorted(r.participant_id for r in ok.collect()) == ["a", "c"] and rejects.count() == 3


def test_failures(spark):
    rows = V.failures(spark.createDataFrame([("s", "missing_artifact", "m"), ("s", "hash_mismatch", "x" * 2000), ("s", "odd", None)], "scope_id string, code string, message string")).collect()
    assert [(r.code, r.retryable, r.message and len(r.message)) for r in rows] == [("missing_artifact", True, 1), ("hash_mismatch", False, 1000), ("unexpected_error", True, None)]


def test_paired_completion_and_retry_time(spark):
    at = datetime(2026, 1, 2)
    m = spark.createDataFrame([("s", "heat", 2, "h2", "written", at), ("s", "region", 2, "r2", "written", None), ("s", "heat", 1, "h1", "active", at), ("t", "heat", 1, "x", "active", at)], "scope_id string, kind string, generation int, sha256 string, state string, generated_at timestamp")
    done = {(r.scope_id, r.kind, r.generation): r.state for r in G.complete(m, "s", {"heat": (2, "h2"), "region": (2, "r2")}, 1, 1).collect()}
    assert done == {("s", "heat", 2): "active", ("s", "region", 2): "active", ("s", "heat", 1): "superseded", ("t", "heat", 1): "active"}
    for outputs, now, why in (({"heat": (2, "h2")}, 2, "stale_revision"), ({"heat": (2, "h2"), "region": (2, "other")}, 1, "incomplete_outputs")):
        with pytest.raises(G.ConflictError, match=why):
            G.complete(m, "s", outputs, 1, now)
    now = F.lit("2026-03-03").cast("timestamp")
    got = [spark.range(1).select(G.generated_at(m, "s", g, now).alias("t")).first().t for g in (2, 3)]
    assert got == [at, datetime(2026, 3, 3)]


def test_logs_and_layout(spark, tmp_path):
    (tmp_path / "log").write_text('2026-01-01T00:00:00Z {"event":"x"}\nno time\n')
    rows = D.read_lines(spark, str(tmp_path / "log")).orderBy("message").collect()
    assert [r.ts is None for r in rows] == [False, True]
    (tmp_path / "access").write_text('{"requestId":"r","status":"404","other":1}\n')
    assert D.read_access_log(spark, str(tmp_path / "access")).select("status").first().status == "404"
    df = spark.createDataFrame([("u", 1, 5), ("v", 1, 6)], "upload_id string, generation int, x int")
    G.write_partitioned(df, str(tmp_path / "o"))
    G.write_partitioned(df.where("upload_id = 'u'").withColumn("x", F.lit(9)), str(tmp_path / "o"))
    assert {(r.upload_id, r.x) for r in spark.read.parquet(str(tmp_path / "o")).collect()} == {("u", 9), ("v", 6)}
