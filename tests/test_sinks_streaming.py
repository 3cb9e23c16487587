import gzip
import hashlib
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tickforge.operators import alarms as A
from tickforge.operators import logquery as L
from tickforge.session import configure
from tickforge.sinks import generations as G
from tickforge.sources import replays as D
from tickforge.streaming import jobs as J


def test_generation_is_written_once(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 0.5), (2, None, 1.5)], "k int, s string, v double")
    one = G.write_generation(df, str(tmp_path), "s", 1)
    assert G.write_generation(df.repartition(3), str(tmp_path), "s", 1) == one
    with pytest.raises(G.ConflictError, match="immutable_generation_conflict"):
        G.write_generation(df.limit(1), str(tmp_path), "s", 1)
    G.drop(spark, f"{tmp_path}/scope=s/generation=1")
    assert G.write_generation(df.limit(1), str(tmp_path), "s", 1) != one


def manifests(spark):
    rows = [("s", 1, datetime(2026, 1, 1), "superseded"), ("s", 2, datetime(2026, 5, 1), "active"), ("s", 3, datetime(2026, 5, 2), "written"), ("t", 1, datetime(2026, 5, 2), "active")]
    return spark.createDataFrame(rows, "scope_id string, generation int, committed_at timestamp, state string")


def test_activation_supersedes_and_refuses_stale(spark):
    m = G.activate(manifests(spark), "s", 3, 5, 5)
    assert {(r.scope_id, r.generation): r.state for r in m.collect()} == {("s", 1): "superseded", ("s", 2): "superseded", ("s", 3): "active", ("t", 1): "active"}
    assert {(r.scope_id, r.generation) for r in G.latest(m).collect()} == {("s", 3), ("t", 1)}
    with pytest.raises(G.ConflictError, match="stale_revision"):
        G.activate(manifests(spark), "s", 3, 5, 6)
    now = F.lit("2026-05-10").cast("timestamp")
    assert [(r.scope_id, r.generation) for r in G.expired(m, now).collect()] == [("s", 1)]


def test_export_is_deterministic_and_bounded(spark):
    df = spark.createDataFrame([(2, "b"), (1, "a")], "k int, s string")
    a, b = G.export_json(df, ["k"], 1000, 1000), G.export_json(df.repartition(2), ["k"], 1000, 1000)
    assert a == b and a[1] == hashlib.sha256(a[0]).hexdigest()
    assert [json.loads(x) for x in gzip.decompress(a[0]).splitlines()] == [{"k": 1, "s": "a"}, {"k": 2, "s": "b"}]
    for limits in ((5, 1000), (1000, 5)):
        with pytest.raises(ValueError, match="artifact_too_large"):
            G.export_json(df, ["k"], *limits)


def test_reprocess_generation(spark):
    ids = ["00000000-0000-0000-0000-000000000000", "ffffffff-ffff-4fff-8fff-ffffffffffff", "0A1B2C3D-1111-4222-8333-444455556666", "bad"]
    got = [r.g for r in spark.createDataFrame([(i,) for i in ids], "u string").select(G.reprocess_generation(F.col("u")).alias("g")).collect()]
    assert got == [int(i.replace("-", ""), 16) % (2**31 - 2) + 2 for i in ids[:3]] + [None]


def test_status_and_dead_letters(spark):
    s = G.status(spark.createDataFrame([("x" * 5000,), (None,)], "message string")).collect()
    assert len(s[0].message) == 4096 and s[1].message is None
    rows = [("a", None, True, 9), ("b", "e", True, 1), ("c", "e", True, 4), ("d", "e", False, 1)]
    assert [r.id for r in G.dead_letters(spark.createDataFrame(rows, "id string, error string, retryable boolean, attempts int")).collect()] == ["c", "d"]


def test_work_items(spark):
    event = {"Records": [{"eventName": "ObjectCreated:Put", "s3": {"bucket": {"name": "b"}, "object": {"key": "a+b%2Fc.json"}}}, {"s3": {"bucket": {"name": "b"}}}, {"other": 1}]}
    job = {"job_id": "j", "operation_id": "o", "attempt_id": "a", "mode": "full_reparse", "replay": {"id": 1, "upload_id": "u"}, "source_replay": {"s3_bucket": "b", "s3_key": "k"}, "current_replay_file": {"size_bytes": 7}}
    rows = [("1", json.dumps(event)), ("2", json.dumps({"Message": json.dumps(event)})), ("3", json.dumps(job)), ("4", json.dumps({**job, "mode": "other"})), ("5", "{bad"), ("6", None)]
    objects, jobs, bad = D.work_items(spark.createDataFrame(rows, "id string, body string"))
    assert {(r.id, r.key) for r in objects.collect()} == {("1", "a b/c.json"), ("2", "a b/c.json")}
    assert [(r.id, r.replay_id, r.size_bytes) for r in jobs.collect()] == [("3", "1", 7)]
    assert {(r.id, r.error) for r in bad.collect()} == {("4", "bad_job"), ("5", "bad_json"), ("6", "bad_json")}


def test_artifacts_are_verified(spark):
    good = b"data"
    digest = hashlib.sha256(good).hexdigest()
    files = spark.createDataFrame([("a", bytearray(good), 4), ("b", bytearray(good), 4), ("c", bytearray(good), 4)], "path string, content binary, length long")
    m = spark.createDataFrame([("a", 4, digest.upper()), ("b", 5, digest), ("c", 4, "0" * 64), ("d", 4, digest)], "path string, size_bytes long, sha256 string")
    ok, bad = D.verified(files, m)
    assert [r.path for r in ok.collect()] == ["a"]
    assert {r.path: r.error for r in bad.collect()} == {"b": "size_mismatch", "c": "hash_mismatch", "d": "missing_artifact"}


def test_objects_and_journal(spark, tmp_path):
    for n in ("x.json", "x.txt", "y.json"):
        (tmp_path / n).write_text("12345")
    got = D.objects(spark, str(tmp_path), "x", ".json").collect()
    assert [(r.key.rsplit("/", 1)[1], r["size"]) for r in got] == [("x.json", 5)]
    j = spark.createDataFrame([(datetime(2026, 1, 1),), (datetime(2026, 1, 9),)], "at timestamp")
    assert D.journal(j, F.lit("2026-01-10").cast("timestamp")).count() == 1


def replay(game, x):
    return {"summary": {"game_id": game}, "ticks": [{"players": [{"player_index": 0, "player_object_data": {"x": x, "y": 1, "z": 1}}, {"player_index": 1}]}]}


def test_ingestion_by_micro_batches(spark, tmp_path):
    configure(spark)
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    (source / "a.json").write_text(json.dumps(replay("a", 1.0)))
    (source / "bad.json").write_text("{")
    run = lambda: J.ingest(spark, str(source), out, str(tmp_path / "cp")).awaitTermination(120)
    assert run()
    (source / "b.json.gz").write_bytes(gzip.compress(json.dumps(replay("b", 2.6), indent=1).encode()))
    assert run()
    cells = spark.read.parquet(f"{out}/voxels").collect()
    assert {(r.game_id, r.slot, r.cx, r.ticks) for r in cells} == {("a", 0, 2, 1), ("b", 0, 5, 1)}
    assert {(r.game_id, r.reason, r.n) for r in spark.read.parquet(f"{out}/discards").collect()} == {("a", "missing_player_object", 1), ("b", "missing_player_object", 1)}
    assert [r.file.rsplit("/", 1)[1] for r in spark.read.parquet(f"{out}/dead_letters").collect()] == ["bad.json"]


def test_streamed_windows_drop_late_points(spark, tmp_path):
    src = str(tmp_path / "points")
    schema = "ts timestamp, metric string, value double"
    put = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
    put([(datetime(2026, 1, 1, 0, 1), "m", 1.0), (datetime(2026, 1, 1, 0, 4), "m", 5.0)])
    stream = J.metric_windows(spark.readStream.schema(schema).parquet(src), 300)
    name, cp = "windows_out", str(tmp_path / "cp")
    go = lambda: stream.writeStream.format("parquet").option("path", str(tmp_path / name)).option("checkpointLocation", cp).outputMode("append").trigger(availableNow=True).start().awaitTermination(120)
    assert go()
    put([(datetime(2026, 1, 1, 1, 0), "m", 2.0)])
    assert go()
    put([(datetime(2026, 1, 1, 0, 2), "m", 9.0), (datetime(2026, 1, 1, 2, 0), "m", 2.0)])
    assert go()
    got = spark.read.parquet(str(tmp_path / name)).orderBy("start").collect()
    assert (got[0].points, got[0]["sum"], got[0].maximum) == (2, 6.0, 5.0)


def test_maintenance_takes_the_first_dirty_scopes(spark):
    dirty = spark.createDataFrame([("c", 2, 1), ("a", 1, None), ("b", 3, 3)], "scope_id string, source_revision int, built_revision int")
    seen = []
    assert J.maintain(spark, dirty, lambda s, r: seen.append((s, r)), most=1) == ["a"] and seen == [("a", 1)]


def points(spark, *values):
    return spark.createDataFrame([(datetime(2026, 1, 1, 0, 5 * m, 1), "m", float(v)) for m, v in values], "ts timestamp, metric string, value double")


def test_alarm_counts_periods_not_rows(spark):
    configure(spark)
    a = A.Alarm("a", "m", "Maximum", 10, 300, 3, 2)
    got = [(r.breaches, r.firing) for r in A.states(points(spark, (0, 10), (1, 3), (2, 11), (6, 12), (7, 12)), a).orderBy("start").collect()]
    assert got == [(1, False), (1, False), (2, True), (1, False), (1, False), (0, False), (1, False), (2, True)]
    strict = A.Alarm("a", "m", "Maximum", 10, 300, 1, 1, strict=True)
    assert [r.firing for r in A.states(points(spark, (0, 10), (1, 11)), strict).orderBy("start").collect()] == [False, True]
    assert [(r.firing) for r in A.changes(A.states(points(spark, (0, 1), (1, 11), (2, 11), (3, 1)), strict), 300).orderBy("start").collect()] == [True, False]
    assert A.states(points(spark), a).count() == 0 and len({x.name for x in A.ALARMS}) == 14


def test_log_pipeline_on_missing_fields(spark):
    lines = spark.createDataFrame([(datetime(2026, 1, 1), '{"event":"request_completed","route":"/a","duration_ms":2000.5,"trace_id":null}'), (datetime(2026, 1, 1), '{"event":"request_completed","duration_ms":1}'), (datetime(2026, 1, 1), "noise"), (datetime(2026, 1, 1), None)], "ts timestamp, message string")
    r = L.slow_requests(lines).collect()
    assert [(x.route, x.trace_value, x.db_query_ms) for x in r] == [("/a", "null", None)]
    assert {(x.route, x.requests, x.p95_ms) for x in L.route_performance(lines).collect()} == {("/a", 1, 2000.5), (None, 1, 1.0)}
    assert set(L.SAVED) == {"route-performance", "slow-requests", "database-hotspots", "cold-versus-warm", "recent-server-errors", "gateway-failures"}
