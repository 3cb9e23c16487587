"""Tables that start from a held scan: one parse a document, and the same rows as without it."""

import json
import os

import pytest
from pyspark.sql import functions as F
from tests.test_assemble import document

from tickforge.operators import replay as R
from tickforge.plans import catalog
from tickforge.plans.assemble import Tables
from tickforge.session import configure
from tickforge.sinks.held import held
from tickforge.sources import replays as D

SF = "/root/testdata/sf0.001"
TABLES = ["contexts", "graph_players", "discards", "participant_facts", "voxels"]


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.skipif(not os.path.isdir(SF), reason="the tables are not here")
@pytest.mark.parametrize("table", TABLES)
def test_documents_are_parsed_once(spark, monkeypatch, table):
    plans = []

    def seen(df, name):
        plans.append(plan(df))
        return held(df, name)

    monkeypatch.setattr(catalog, "held", seen, raising=False)
    plans.append(plan(catalog.QUERIES[f"replay_doc_{table}"](spark, SF)))
    assert sum(p.count("from_json(StructField") for p in plans) == 1


@pytest.fixture(scope="module")
def odd(spark):
    configure(spark)
    full = document()
    late = {**document(), "summary": {"game_id": "late"}}
    late["ticks"] = [late["ticks"][0], {**late["ticks"][0], "network_game_client": {"machine_index": 1, "network_game_data": {"network_players": [{"player_list_index": 0, "machine_index": 1}, {"player_list_index": "1", "machine_index": 0}]}}, "players": None}, *late["ticks"]]
    people = [{"player_index": v, "derived_stats": {"is_hostman": h}, "player_object_data": d} for v, h, d in [(True, "yes", {"x": 1, "y": 2, "z": 3}), ("2", None, {"x": "1e1", "y": "nan", "z": 0}), (None, 0, {"x": True, "y": [1], "z": {}}), (3.5, False, {"x": None, "y": 1}), (64, 1, None), ([1], True, {"x": 5e6, "y": 1, "z": 1}), (7.0, None, {"x": " 2 ", "y": "3d", "z": "-.5e0"})]]
    docs = [full, late, {"summary": {"game_id": "one"}, "ticks": [{"players": people}]}, {"summary": {"game_id": "none"}, "ticks": []}, {"participant_context": {"players": {"1": {"is_hostman": "on"}}}}, {"ticks": 5}]
    rows = [(f"f{i}", json.dumps(d), None) for i, d in enumerate(docs)] + [("bad", "{no", None), ("null", None, None), ("zip", None, "bad_zip")]
    return D.parse(spark.createDataFrame(rows, "file string, doc string, error string"))


@pytest.mark.parametrize("table", TABLES)
def test_same_rows_as_without_the_scan(odd, table):
    whole, scanned = (getattr(Tables(odd, hold=h, only=o), table) for h, o in ((lambda df: df, None), (lambda df: held(df, table), table)))
    assert whole.columns == scanned.columns
    got = sorted(map(repr, scanned.collect()))
    assert got and got == sorted(map(repr, whole.collect()))


def test_samples_of_odd_values(odd):
    rows = D.player_samples(D.game_key(odd.where("error is null"))).where("game_id = 'one'").orderBy("pos").collect()
    assert [(r.slot, r.hostman, r.has_object, r.x, r.y, r.z, r.missing) for r in rows] == [
        (None, True, True, 1.0, 2.0, 3.0, False), (2, False, True, 10.0, None, 0.0, False), (None, False, True, None, None, None, False), (None, False, True, None, 1.0, None, True),
        (None, True, False, None, None, None, True), (None, True, True, 5e6, 1.0, 1.0, False), (7, False, True, 2.0, None, -0.5, False),
    ]


@pytest.mark.skipif(not os.path.isdir(SF), reason="the tables are not here")
@pytest.mark.parametrize("table", ["contexts", "participant_facts"])
def test_nothing_is_broadcast_for_the_size_of_its_files(spark, table):
    """A held scan of few bytes may hold millions of players; they must not meet on the driver."""
    df = catalog.QUERIES[f"replay_doc_{table}"](spark, SF)
    assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()


def test_streaks_have_the_rows_of_participants(spark):
    configure(spark)
    players = spark.createDataFrame([("g", m, i, p) for m in ("first", "last") for i, p in enumerate(["0", None, "1", "x", "7"])], "game_id string, moment string, pos int, player_index string")
    players = players.selectExpr("*", "true AS team_given", *[f"CAST(NULL AS STRING) AS {c}" for c in ("name", "player_name", "team", "score", "ctf_score", "kills", "deaths", "assists", "suicides", "team_kills")])
    meta = D.meta_players(D.parse(spark.createDataFrame([("g", json.dumps({"game_meta": {"players": {"0": {"streak_by_tick": {"5": 3}}, "1": {"multikill_counts_by_amount": {"2": 4, "5": 1}}, "01": {"multikills_by_tick": {"9": [2, 3]}}, "9": {}}}}), None)], "file string, doc string, error string")).withColumn("game_id", F.lit("g")))
    columns = ["game_id", "slot", "max_kill_streak", "multikills"]
    got = sorted(map(repr, R.streaks(players, meta).select(columns).collect()))
    assert len(got) == 7 and got == sorted(map(repr, R.participants(players, meta).select(columns).collect()))
