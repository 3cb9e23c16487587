import gzip
import hashlib
import json

from pyspark.sql import functions as F

from tickforge.operators import heatmap as H
from tickforge.operators import occupancy as O
from tickforge.operators import regions as R
from tickforge.sinks import artifacts as A
from tickforge.sinks import generations as G
from tickforge.sources import replays as S

CLAIM = "scope_id string, scope_type string, map_id string, player_id string, eligibility string, source_revision int"


def test_spatial_documents_and_rows(spark):
    cells = spark.createDataFrame([("g", 1, 2, 0, 0, 5), ("g", 0, -1, 0, 0, 1), ("g", 0, -2, 3, 0, 2)], "game_id string, slot int, cx long, cy long, cz long, ticks long")
    games = spark.createDataFrame([("g", 0.5, "a" * 64), ("empty", 0.5, None)], "game_id string, cell_size double, source_sha256 string")
    samples = spark.createDataFrame([("g",)] * 9 + [("empty",)], "game_id string")
    documents = A.spatial_documents(cells, games, O.coverage(cells, samples))
    got = {r.game_id: json.loads(r.document) for r in documents.collect()}
    assert [(r["slot_index"], r["cell"], r["observed_ticks"]) for r in got["g"]["occupancy"]] == [(0, [-2, 3, 0], 2), (0, [-1, 0, 0], 1), (1, [2, 0, 0], 5)]
    assert got["g"]["coverage"]["distinct_cells"] == 3 and got["g"]["coverage"]["position_observations"] == 8 and got["g"]["ticks_per_second"] == 30
    assert got["empty"]["occupancy"] == [] and got["empty"]["coverage"]["status"] == "unavailable" and got["empty"]["coverage"]["source"]["replay_sha256"] is None
    text = documents.where("game_id = 'g'").first().document
    assert text == json.dumps(json.loads(text), separators=(",", ":"), sort_keys=True)
    packed = A.pack(documents, "game_id", A.SPATIAL_BYTES)
    for r in packed.collect():
        assert gzip.decompress(r.content).decode() and r.sha256 == hashlib.sha256(r.content).hexdigest() and r.size_bytes == len(r.content) and r.error is None
    rows, bad = A.spatial_rows(A.decode(packed.select("game_id", "content", F.lit("gzip").alias("encoding")), "game_id"), "game_id")
    assert {(r.game_id, r.slot, r.cx, r.cy, r.cz, r.ticks) for r in rows.collect()} == {tuple(r) for r in cells.collect()} and bad.count() == 0


def test_packing_and_decoding_are_bounded(spark):
    documents = spark.createDataFrame([("a", '{"x":"é"}'), ("b", None), ("c", json.dumps({"x": "y" * 500}))], "k string, document string")
    got = {r.k: r for r in A.pack(documents, "k", (100, 90)).collect()}
    assert gzip.decompress(got["a"].content) == b'{"x":"\\u00e9"}' and got["a"].decoded_size_bytes == 14
    assert (got["b"].error, got["c"].error, got["c"].content) == ("invalid_artifact", "artifact_too_large", None)
    assert {r.k: r.error for r in A.pack(documents, "k", (1000, 5)).collect()}["a"] == "artifact_too_large"
    rows = [("plain", b'{"a":1}', None), ("zip", gzip.compress(b'{"a":1}'), "gzip"), ("bomb", gzip.compress(b'{"a":"' + b" " * 5000 + b'"}'), "gzip"), ("cut", gzip.compress(b'{"a":1}')[:-9], "gzip"), ("kind", b"{}", "br"), ("list", b"[1]", "identity"), ("none", None, "gzip"), ("bytes", b"\xff", None)]
    got = {r.path: (r.document, r.error) for r in A.decode(spark.createDataFrame(rows, "path string, content binary, encoding string"), most=1000).collect()}
    assert got.pop("plain") == got.pop("zip") == ('{"a":1}', None)
    assert set(got.values()) == {(None, "invalid_artifact")} and len(got) == 6
    broken = [("p", '{"schema":"other"}', 1, None), ("q", None, None, "invalid_artifact")]
    rows, bad = A.spatial_rows(spark.createDataFrame(broken, "path string, document string, decoded_size_bytes long, error string"))
    assert rows.count() == 0 and {(r.path, r.error) for r in bad.collect()} == {("p", "invalid_artifact"), ("q", "invalid_artifact")}


def test_heatmap_documents(spark):
    heat = spark.createDataFrame([("s", "occupancy", "g", "p1", 1, 2, 0, 5), ("s", "occupancy", "g", "p2", None, 0, 0, 1), ("s", "occupancy", "g", "p1", 1, -1, 7, 2), ("s", "killer_position", "g", "p1", 1, 0, 0, 1)], "scope_id string, metric string, game_id string, participant_id string, team int, px long, py long, value long")
    people = spark.createDataFrame([("s", "g", "p1"), ("s", "g", "p2"), ("t", "h", "p3")], "scope_id string, game_id string, participant_id string")
    games = spark.createDataFrame([("s", "g"), ("s", "g2"), ("t", "h")], "scope_id string, game_id string")
    claims = spark.createDataFrame([(s, "map", "m", None, "validated", 3) for s in "st"], CLAIM)
    documents, refused = A.heatmap_documents(H.cells(heat), H.summary(heat, people, games), claims)
    got = {r.scope_id: (json.loads(r.document), r.cells) for r in documents.collect()}
    one = got["s"][0]["metrics"]["occupancy"]
    assert [(g["key"], g["label"], g["team_index"], [(c["cell"], c["value"]) for c in g["cells"]]) for g in one["groups"]] == [("team:1", "Team 1", 1, [([-1, 7], 2), ([2, 0], 5)]), ("team:none", "No team", None, [([0, 0], 1)])]
    assert one["summary"] == {"games_contributing": 1, "games_selected": 2, "participants_contributing": 2, "participants_selected": 2} and one["value_unit"] == "observed_ticks"
    assert got["s"][0]["scope"] == {"eligibility": "validated", "map_id": "m", "player_id": None, "source_revision": 3, "type": "map"} and got["s"][1] == 4
    assert got["t"][1] == 0 and all(m["groups"] == [] for m in got["t"][0]["metrics"].values()) and refused.count() == 0
    documents, refused = A.heatmap_documents(H.cells(heat), H.summary(heat, people, games), claims, most=50)
    assert [r.scope_id for r in documents.collect()] == ["t"] and [tuple(r) for r in refused.collect()] == [("s", "artifact_too_large")]


def test_region_documents(spark):
    conf = R.Configuration(4, "b" * 64, (R.Region("r2", "k2", (R.Box((0, 0, 0), (1, 1, 1)),), "Two", "#fff"), R.Region("r1", "k1", (R.Box((5, 5, 5), (6, 6, 6)),))), (R.Collection("c", "kc", "union", ("r1", "r2"), "Both"),))
    games = spark.createDataFrame([("s", "g", True, 30.0, 0.5, None, 0), ("t", "h", False, None, None, None, None)], "scope_id string, game_id string, has_artifact boolean, ticks_per_second double, cell_size double, status string, discarded_samples long")
    people = spark.createDataFrame([("s", "g", "p", 0, None)], "scope_id string, game_id string, participant_id string, slot int, team int")
    cells = spark.createDataFrame([("g", 0, 0, 0, 0, 30), ("g", 0, 9, 9, 9, 15), ("g", 1, 0, 0, 0, 7)], "game_id string, slot int, cx long, cy long, cz long, ticks long")
    m = R.match(R.assign(games, people, cells), conf)
    claims = spark.createDataFrame([(s, "map", "m", None, "validated", 3) for s in "st"], CLAIM)
    documents, refused = A.region_documents(R.grouped(m, games), R.coverage(games, people, m), claims, conf, F.lit("now"))
    got = {r.scope_id: json.loads(r.document) for r in documents.collect()}
    assert [g["key"] for g in got["s"]["groups"]] == ["all", "team:none"] and refused.count() == 0
    assert [(r["region_id"], r["label"], r["observed_player_ticks"], r["observed_player_seconds"]) for r in got["s"]["groups"][0]["regions"]] == [("r2", "Two", 30, 1.0), ("r1", None, 0, 0.0)]
    assert got["s"]["groups"][1]["collections"][0]["outside_ticks"] == 15 and got["s"]["summary"]["discarded_player_ticks"] == 7 and got["s"]["region_sets"] == []
    assert got["t"]["groups"][0]["key"] == "all" and got["t"]["groups"][0]["observed_player_ticks_total"] == 0 and got["t"]["summary"]["games_missing_data"] == 1 and got["t"]["generated_at"] == "now"
    rows = A.region_rows(documents.withColumn("error", F.lit(None).cast("string")))
    assert {(r.scope_id, r.group_key, r.region_id, r.ticks) for r in rows.collect()} >= {("s", "all", "r2", 30), ("t", "all", "r1", 0)}


def test_occupancy_faults(spark):
    rows = [("ok", 0, 1, 1, 1, 3), ("twice", 0, 1, 1, 1, 3), ("twice", 0, 1, 1, 1, 2), ("slot", 64, 1, 1, 1, 1), ("slot", None, 1, 1, 1, 1), ("cell", 0, None, 1, 1, 1), ("zero", 0, 1, 1, 1, 0)]
    rows += [("many", 0, i, 0, 0, 1) for i in range(3)] + [("many", 1, i, 0, 0, 1) for i in range(2)]
    cells = spark.createDataFrame(rows, "game_id string, slot int, cx long, cy long, cz long, ticks long")
    got = {(r.game_id, r.code) for r in O.faults(cells, 2, 4).collect()}
    assert got == {("twice", "duplicate_cell"), ("slot", "invalid_slot"), ("cell", "invalid_cell"), ("zero", "invalid_cell"), ("many", "slot_cell_limit"), ("many", "global_cell_limit")}
    assert O.faults(cells.limit(0)).count() == 0


def test_invocation_and_attempts(spark):
    results = spark.createDataFrame([("completed", 2, 10, 5), ("completed", None, 0, 1), ("stale", 1, None, 0)], "status string, input_games long, region_output_bytes long, s3_gets long")
    run = G.invocation(results)
    assert len(run.columns) == 19
    r = run.first()
    assert (r.completed, r.stale, r.failed, r.input_games, r.region_artifacts_written, r.s3_gets, r.api_requests) == (2, 1, 0, 3, 1, 6, 0)
    got = {x.metric: (x.value, x.unit) for x in G.metrics(run.withColumn("duration_ms", F.lit(9))).collect()}
    assert len(got) == 21 and got["InvocationDuration"] == (9, "Milliseconds") and got["RegionOutputBytes"] == (10, "Bytes") and got["ProcessPeakRssKiB"] == (0, "Kilobytes")
    assert G.invocation(results.limit(0)).first().completed == 0
    failed = spark.createDataFrame([("a", "e", True), ("b", "e", True), ("c", "e", False)], "id string, error string, retryable boolean")
    earlier = spark.createDataFrame([("a", 1), ("b", 3), ("b", 2)], "id string, attempts int")
    again, dead = G.attempted(failed, earlier)
    assert {(r.id, r.attempts) for r in again.collect()} == {("a", 2)} and {(r.id, r.attempts) for r in dead.collect()} == {("b", 4), ("c", 1)}


def test_unprocessed_objects(spark):
    items = spark.createDataFrame([("in/a", "ObjectCreated:Put"), ("in/b", "ObjectRemoved:Delete"), ("in/c", None), ("out/d", None)], "key string, event_name string")
    assert {r.key for r in S.unprocessed(items, "in/").collect()} == {"in/a", "in/c"}
    assert S.unprocessed(items.select("key"), "in/").count() == 3
