"""Whole replay documents through the readers and the replay operators."""

import gzip
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from tickforge.functions import coerce as C
from tickforge.functions import sanitise as S
from tickforge.operators import occupancy as O
from tickforge.operators import replay as R
from tickforge.session import configure
from tickforge.sources import replays as D


def player(i, **more):
    at = more.pop("at", (1.0, 1.0, 1.0))
    return {"player_index": i, "name": f"N{i}", "team": i % 2, "kills": 1, "deaths": 2, "assists": 0, "score": 5, "player_object_data": None if at is None else dict(zip("xyz", at, strict=True)), **more}


def replay(game="g1", ticks=None, **more):
    return {"summary": {"game_id": game, "is_full_game": True, "recording_started": "2026-05-09 15:51:32.5", "game_duration_ingame": "0:00:47"}, "events": [{"k": n} for n in range(12)], "ticks": ticks or [{"players": [player(0), player(1)]}], **more}


@pytest.fixture()
def read(spark, tmp_path):
    configure(spark)

    def go(*docs):
        for k, d in enumerate(docs):
            (tmp_path / f"r{k}.json").write_text(json.dumps(d))
        return D.game_key(D.read_replays(spark, str(tmp_path)))

    return go


def test_codecs_and_bad_files(spark, tmp_path):
    text = json.dumps(replay())
    (tmp_path / "a.json").write_text(json.dumps(replay("a"), indent=1))
    (tmp_path / "b.json.gz").write_bytes(gzip.compress(json.dumps(replay("b")).encode()))
    with zipfile.ZipFile(tmp_path / "c.zip", "w") as z:
        z.writestr("readme.txt", "x")
        z.writestr("c.json", json.dumps(replay("c")))
    with zipfile.ZipFile(tmp_path / "d.zip", "w") as z:
        z.writestr("1.json", text)
        z.writestr("2.json", text)
    (tmp_path / "e.zip").write_bytes(b"no zip")
    (tmp_path / "f.json").write_text("{broken")
    got = D.game_key(D.read_replays(spark, str(tmp_path)))
    rows = {r.file.rsplit("/", 1)[1]: (r.error, r.game_id) for r in got.select("file", "error", "game_id").collect()}
    assert {k: v[0] for k, v in rows.items()} == {"a.json": None, "b.json.gz": None, "c.zip": None, "d.zip": "zip_needs_one_json", "e.zip": "bad_zip", "f.json": "bad_json"}
    assert [rows[k][1] for k in ("a.json", "b.json.gz", "c.zip")] == ["a", "b", "c"]


def test_samples_keep_order_and_tell_null_from_absent(read):
    ticks = [{"players": [player(0, at=(-0.1, -1.0, 1.49)), player(1, player_index="1", at=None)]}, {"players": []}, {"players": [player(0, at=(-0.1, -1.0, 1.49)), {**player(2), "player_object_data": {"x": None, "y": 1, "z": 1}}, {**player(3), "player_object_data": {"x": 1, "y": 1}}, player(4, derived_stats={"is_hostman": "yes"}), player(5, player_index=True), player(99), player(5, at=("2.5", 2e6, 1))]}]
    s = D.player_samples(read(replay(ticks=ticks)))
    c = O.classify(s)
    got = {(r.tick, r.pos): r.reason for r in c.collect()}
    assert got == {(0, 0): None, (0, 1): "missing_player_object", (2, 0): None, (2, 1): "non_finite", (2, 2): "missing_coordinate", (2, 3): "hostman", (2, 4): "invalid_slot", (2, 5): "invalid_slot", (2, 6): "out_of_bounds"}
    assert [(r.slot, r.cx, r.cy, r.cz, r.ticks) for r in O.voxels(c).collect()] == [(0, -1, -2, 2, 2)]


def test_event_counts(read):
    r = D.event_counts(read(replay())).first()
    assert (r.ticks, r.events, len(r.sample), json.loads(r.sample[9])) == (1, 12, 10, {"k": 9})


def test_participants_come_from_the_last_tick(spark, read):
    first = {"players": [player(0, team=1, name="First"), player(7)]}
    last = {"players": [player(0, name=" ", kills=0, score=0, ctf_score=4), {k: v for k, v in player(1).items() if k != "team"}, player(2, team=None)]}
    ends = D.end_players(read(replay(ticks=[first, {"players": []}, last])))
    one = spark.createDataFrame([("g1", 0, {"10": "1", "20": "[[1,2,3],[1,2,3]]"})], "game_id string, slot int, kills_by_tick map<string,string>")
    none = F.lit(None).cast("map<string,string>")
    meta = one.select("*", *[none.alias(n) for n in ("deaths_by_tick", "assists_by_tick", "shots_by_tick", "streak_by_tick", "streak_counts_by_amount", "multikill_counts_by_amount", "multikills_by_tick")], F.lit("1.5").alias("damage_dealt"), F.lit(None).cast("string").alias("damage_received"))
    got = {r.slot: r for r in R.participants(ends, meta).collect()}
    assert sorted(got) == [0, 1, 2]
    assert (got[0].name, got[0].kills, got[0].score, got[0].team, got[0].damage_dealt) == ("First", 3, 4, 0, 1.5)
    assert got[1].team is None and got[2].team is None and got[0].team_name == "Red"


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_context_priority_and_screens(spark):
    net = frame(spark, [("g", 0, "0", "0", "0"), ("g", 1, "1", "0", "1"), ("g", 2, "2", "1", "0"), ("g", 3, "x", "1", "0")], "game_id string, pos int, player_list_index string, machine_index string, controller_index string")
    n = R.network_contexts(net)
    got = {r.slot: (r.machine_index, r.is_host, r.screen_slot, r.screen_layout) for r in n.collect()}
    assert got == {0: (0, True, "top", "vertical_2"), 1: (0, True, "bottom", "vertical_2"), 2: (1, False, "full", "single")}
    players = frame(spark, [("g", "last", 0, "0", "0", "no", None), ("g", "first", 0, "0", "1", "yes", "on"), ("g", "last", 5, None, "2", None, None)], "game_id string, moment string, pos int, player_index string, local_player string, is_host string, is_hostman string")
    t = R.tick_contexts(players, frame(spark, [("g", 4)], "game_id string, machine int"))
    explicit = frame(spark, [("g", 0, "0", None, None, None, "2", "3", "no", None, " Bottom-Right", "quad"), ("g", 1, "8", None, None, None, None, "-1", None, None, "middle", None)], "game_id string, pos int, key string, slot_index string, player_list_index string, player_index string, machine_index string, controller_index string, is_host string, is_hostman string, screen_slot string, screen_layout string")
    m = {r.slot: r for r in R.merge_contexts(n, t, R.explicit_contexts(explicit)).collect()}
    assert sorted(m) == [0, 1, 2, 5]
    assert m[0][2:] == (2, 3, False, True, "bottom-right", "quad")
    assert (m[5].machine_index, m[5].controller_index, m[5].is_host, m[5].screen_slot) == (4, 2, False, "bottom")
    assert [(r.game_id, r.slot) for r in R.hosts(R.merge_contexts(n, t, R.explicit_contexts(explicit))).collect()] == [("g", 0)]


@pytest.mark.parametrize(("hosts", "want"), [([], "neutral"), ([True], "neutral"), ([False], "on_off"), ([True, True], "on_off")])
def test_host_style(spark, hosts, want):
    rows = [("g", 9, None, None)] + [("g", k, True, h) for k, h in enumerate(hosts)]
    assert R.host_style(frame(spark, rows, "game_id string, slot int, is_host boolean, is_hostman boolean")).first().host_style == want


def test_teams_and_winner(spark):
    rows = [("g", 0, 3, 1, 1), ("g", 0, None, 1, 1), ("g", 1, 3, 2, 0), ("g", None, 9, 1, 1), ("h", 5, 0, 0, 0)]
    t = R.team_stats(frame(spark, rows, "game_id string, team int, score int, kills int, deaths int"))
    assert sorted((r.game_id, r.team, r.score, r.players, r.kills) for r in t.collect()) == [("g", 0, 3, 2, 2), ("g", 1, 3, 1, 2), ("h", 5, 0, 1, 0)]
    assert {r.game_id: r.winning_team for r in R.winners(t).collect()} == {"g": None, "h": 5}


def test_streaks_and_multikills(spark):
    m = "map<string,string>"
    rows = [({"1": "2", "2": "3"}, {"5": "1", "9": "0"}, {"2": "3", "3": "1", "4": "1", "5": "1"}, {"1": "9"}), (None, None, {}, {"1": "[2,2,4]", "2": "3", "3": "1"}), (None, None, None, None)]
    df = frame(spark, rows, f"a {m}, b {m}, c {m}, d {m}").select(R.max_streak(F.col("a"), F.col("b")).alias("s"), R.multikills(F.col("c"), F.col("d")).alias("k"))
    assert [(r.s, r.k and tuple(r.k)) for r in df.collect()] == [(5, (3, 1, 2)), (None, (2, 1, 1)), (None, None)]


def test_recorded_seconds_and_graph_players(spark):
    df = frame(spark, [(None, 100, None), ("7.25", 100, None), ("-1", None, "0:01:00"), (None, None, "x")], "e string, t int, r string")
    assert [r.s for r in df.select(R.recorded_seconds([F.col("e")], F.col("t"), F.col("r")).alias("s")).collect()] == [3.333, 7.25, 60.0, None]
    rows = [("g", "first", k, str(k % 18), "3", None, "x", None) for k in range(20)] + [("g", "first", 20, "30", None, None, None, None), ("g", "first", 21, "31", "1", "1", "1", "true"), ("g", "last", 0, "40", "1", "1", "1", None)]
    p = frame(spark, rows, "game_id string, moment string, pos int, player_index string, kills string, deaths string, assists string, is_hostman string")
    got = R.graph_players(p, frame(spark, [("g", 0)], "game_id string, slot int")).collect()
    assert sorted(r.slot for r in got) == list(range(1, 17)) and {(r.kills, r.deaths, r.assists) for r in got} == {(3, None, None)}


def test_settings_to_facts(spark):
    configure(spark)
    doc = {"score_limit": "50", "teamplay": 1, "Host_Name": "x", "presigned_url": "y", "mode_settings": {"kill_in_order": False, "deep": {"deeper": {"deepest": 1}}}, "name": "see http://x", "list": [1], "none": None, "ratio": 1.5, "bad key": 1}
    df = spark.createDataFrame([("g", json.dumps(doc))], "game_id string, j string").select("game_id", F.parse_json("j").alias("v"))
    got = {(r.key, r.kind, r.value) for r in S.facts(S.flatten(df, "v")).collect()}
    assert got == {("gametype.score_limit", "integer", "50"), ("gametype.teamplay", "boolean", "true"), ("gametype.mode_settings.kill_in_order", "boolean", "false"), ("gametype.mode_settings.deep.deeper.deepest", "number", "1"), ("gametype.ratio", "number", "1.5")}


def test_settings_limits_and_keys_that_normalise_alike(spark):
    configure(spark)
    doc = {f"key_{k:03d}": k for k in range(200)} | {"deep": {f"k{k:03d}": 1 for k in range(130)}}
    alike = {"Score_Limit": 5, "score_limit": 7}
    df = spark.createDataFrame([("g", json.dumps(doc)), ("h", json.dumps(alike))], "game_id string, j string").select("game_id", F.parse_json("j").alias("v"))
    facts = S.facts(S.flatten(df, "v"))
    per = facts.groupBy("game_id", F.col("key").startswith("gametype.deep.").alias("deep")).count().collect()
    assert {(r.game_id, r.deep): r["count"] for r in per} == {("g", False): 127, ("g", True): 128, ("h", False): 1}
    assert facts.where("game_id = 'h'").first().value == "7"
    assert not any(t.name.startswith("tickforge") for t in spark.catalog.listTables())


def test_numbers_without_suffixes(spark):
    texts = ["1d", "5f", "1D", " 2.5 ", "1e3", ".5", "5.", "nan", "-inf", "0x10", "1_0", "", None, "+7"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.n for r in df.select(C.number(F.col("t")).alias("n")).collect()]
    assert got[:3] == [None] * 3 and got[3:7] == [2.5, 1000.0, 0.5, 5.0] and got[7] != got[7] and got[8] == float("-inf") and got[9:13] == [None] * 4 and got[13] == 7.0


def test_times_do_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([("2026-05-09 15:51:32.5",), ("2026-05-09T17:51:32+02:00",), ("2026-05-09",)], "t string")
    was = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert [r.t for r in df.select(C.timestamp_text(F.col("t")).alias("t")).collect()] == ["2026-05-09T15:51:32.500000Z", "2026-05-09T15:51:32Z", "2026-05-09T00:00:00Z"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", was)


def test_spawn_points(spark):
    doc = [{"x": 1, "y": 2, "z": 3}, {"position": {"x": "4", "y": 5, "z": 6}}, {"origin": [7, 8, 9, 0]}, [1, 1, 1], [1, 2], {"x": "nan", "y": 1, "z": 1}, {"x": "bad", "y": 1, "z": 1, "location": {"x": 0, "y": 0, "z": 0}}, 5, None]
    df = spark.createDataFrame([("g", json.dumps(doc)), ("h", "{}")], "game_id string, j string").select("game_id", F.parse_json("j").alias("v"))
    got = [(r.n, r.x, r.y, r.z) for r in S.spawn_points(df, "v").orderBy("n").collect()]
    assert got == [(1, 1, 2, 3), (2, 4, 5, 6), (3, 7, 8, 9), (4, 1, 1, 1), (5, 0, 0, 0)]
    assert S.spawn_points(df, "v", most=2).count() == 2


@pytest.mark.parametrize(
    ("f", "cases"),
    [
        (C.duration, {"0:00:47": 47, "1:02:03.9": 3723, "2:30": 150, "1 day, 0:00:01": None, "": None, "x:y": None}),
        (C.timestamp_text, {"2026-05-09 15:51:32.887485": "2026-05-09T15:51:32.887485Z", "2026-05-09T17:51:32+02:00": "2026-05-09T15:51:32Z", "soon": None, None: None}),
        (C.short_name, {"levels\\east\\tower": "tower", "a/b/": "b", "/": None}),
        (C.boolean, {"Yes": True, "0": False, "1.0": None, " t ": True}),
        (C.nonnegative, {"5": 5, "5.0": 5, "5.5": None, "-1": None, "true": None, "nan": None, "1e3": 1000}),
        (C.slot, {"0": 0, "63.0": 63, "64": None, "1.5": None, "x": None}),
        (C.truncated, {"3.9": 3, "-3.9": -3, "inf": None, " 5 ": 5}),
        (S.authoritative, {" unknown <7> ": None, "Unknown 0x1f": None, "Slayer": "Slayer", "10.0.0.1": None, "C:\\x": None, "ab" * 16: None, "x" * 300: "x" * 256}),
        (S.safe_key, {"ghost": None, "draw_mode": None, "score_limit": "score_limit", "9x": None}),
        (S.fact_key, {" Kill-In Order ": "kill_in_order", "__": None, "9a": None}),
        (S.release_key, {"first_box_nhe": "first_box_nhe", "First Box": None}),
    ],
)
def test_scalars(spark, f, cases):
    configure(spark)
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert [r[0] for r in df.select(f(F.col("t"))).collect()] == list(cases.values())


def test_texts_with_a_fraction_are_no_whole_numbers(spark):
    docs = ['{"a": 3.9}', '{"a": "3.9"}', '{"a": " 12 "}', '{"a": "1e3"}', '{"a": 1000.0}', '{"a": [1]}', '{"a": {"b": 1}}', '{"a": null}', "{}"]
    v = F.try_variant_get(F.parse_json("d"), "$.a", "variant")
    rows = frame(spark, list(enumerate(docs)), "n int, d string").select("n", C.truncated(C.as_whole(v)).alias("v")).orderBy("n").collect()
    assert [r["v"] for r in rows] == [3, None, 12, None, 1000, None, None, None, None]
