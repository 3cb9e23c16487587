"""Deterministic projections of the star-schema tables to the operators' inputs, as SQL that Spark and DuckDB share.

Spark runs the same SELECT over temporary views, so both engines start from equal rows.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from tickforge.operators.regions import Configuration, parse_configuration
from tickforge.session import configure

SAMPLES = """
SELECT l_orderkey AS game_id, unix_micros_(l_shipdate) AS tick, l_partkey AS pos,
  CAST(CASE WHEN l_linenumber = 5 AND l_quantity = 1 THEN 99 ELSE l_linenumber END AS INT) AS slot,
  (l_linestatus = 'F' AND l_linenumber = 7) AS hostman, NOT (l_returnflag = 'R' AND l_linenumber = 6) AS has_object,
  CASE WHEN l_quantity = 50 THEN CAST(2000000 AS DOUBLE) ELSE l_quantity - 25 END AS x,
  CASE WHEN l_discount = 0 THEN CAST('NaN' AS DOUBLE) ELSE (l_discount - CAST(0.05 AS DOUBLE)) * 100 END AS y,
  CASE WHEN l_tax = 0 THEN NULL ELSE l_tax * 100 END AS z
FROM lineitem
"""

PARTICIPANTS = """
SELECT DISTINCT o_orderpriority AS scope_id, l_orderkey AS game_id, CAST(o_custkey AS STRING_) AS participant_id,
  CAST(l_linenumber AS INT) AS slot, CAST(CASE WHEN l_linenumber % 3 = 2 THEN NULL ELSE l_linenumber % 3 END AS INT) AS team
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""

GAMES = """
SELECT o_orderpriority AS scope_id, o_orderkey AS game_id, o_orderkey % 5 <> 0 AS has_artifact,
  CAST(CASE WHEN o_orderkey % 7 = 0 THEN 60 ELSE 30 END AS DOUBLE) AS ticks_per_second,
  CASE WHEN o_orderkey % 2 = 0 THEN CAST(0.5 AS DOUBLE) ELSE CAST(1.0 AS DOUBLE) END AS cell_size,
  CASE WHEN o_orderstatus = 'P' THEN 'unavailable' ELSE NULL END AS status, CAST(o_orderkey % 4 AS BIGINT) AS discarded_samples
FROM orders
"""

POSITION_EVENTS = """
SELECT CASE WHEN user_id % 2 = 0 THEN '1-URGENT' ELSE '2-HIGH' END AS scope_id, user_id AS game_id, CAST(user_id AS STRING_) AS participant_id,
  CAST(CASE WHEN user_id % 3 = 2 THEN NULL ELSE user_id % 3 END AS INT) AS team,
  CASE event_type WHEN 'click' THEN 'killer_position' WHEN 'view' THEN 'victim_position' ELSE event_type END AS event_type,
  value - 100 AS x, CAST(user_id - 10 AS DOUBLE) AS y
FROM events
"""

REQUEST_LOG = """
SELECT ts, concat('{"event":"', CASE WHEN event_id % 17 = 0 THEN 'api_error' WHEN event_id % 19 = 0 THEN 'unhandled_exception' ELSE 'request_completed' END,
  '","route":"/v1/', event_type, '","request_id":"r', CAST(event_id AS STRING_), '","trace_id":', CASE WHEN event_id % 4 = 0 THEN 'null' ELSE concat('"t', CAST(event_id AS STRING_), '"') END,
  ',"status":', CAST(CASE WHEN event_id % 13 = 0 THEN 500 ELSE 200 END AS STRING_), CASE WHEN event_id % 13 = 0 THEN ',"outcome":"server_error"' ELSE '' END,
  ',"duration_ms":', CAST((event_id * 7919) % 6000 AS STRING_), '.5', CASE WHEN event_id % 11 = 0 THEN '' ELSE concat(',"db_query_ms":', CAST((event_id * 31) % 400 AS STRING_)) END,
  ',"db_query_count":', CAST(event_id % 9 AS STRING_), ',"db_connect_ms":', CAST(event_id % 50 AS STRING_), ',"cold_start":', CASE WHEN event_id % 10 = 0 THEN 'true' ELSE 'false' END,
  CASE WHEN event_id % 17 = 0 THEN ',"error_type":"Timeout"' ELSE '' END, '}') AS message
FROM events
"""

ACCESS_LOG = """
SELECT ts, concat('r', CAST(event_id AS STRING_)) AS requestId, concat('GET /v1/', event_type) AS routeKey,
  CASE WHEN event_id % 23 = 0 THEN '-' ELSE CAST(200 + 100 * (event_id % 4) AS STRING_) END AS status, CAST(event_id % 900 AS STRING_) AS responseLatency,
  CAST(200 + 100 * (event_id % 4) AS STRING_) AS integrationStatus, CAST(event_id % 800 AS STRING_) AS integrationLatency,
  CASE WHEN event_id % 4 = 3 THEN 'INTEGRATION_FAILURE' ELSE NULL END AS errorResponseType, CAST(NULL AS STRING_) AS integrationErrorMessage
FROM events
"""

POINTS = "SELECT ts, event_type AS metric, value FROM events"

#: Players at both ends of a recording, as texts; line 1 of every third order has no index, so its position counts.
PLAYERS = """
SELECT game_id, e.moment, pos, player_index, CASE WHEN e.moment = 'last' AND pos % 2 = 0 THEN NULL WHEN pos % 4 = 1 THEN '  ' ELSE concat('p', CAST(pos AS STRING_)) END AS name,
  CASE WHEN pos % 4 = 3 THEN NULL ELSE concat(' n', CAST(pos AS STRING_), ' ') END AS player_name,
  CASE WHEN pos % 5 = 4 THEN NULL ELSE CAST(pos % 3 AS STRING_) END AS team, e.moment = 'first' OR pos % 2 = 0 AS team_given,
  CASE WHEN e.moment = 'last' THEN CAST(q AS STRING_) ELSE '0' END AS kills, CASE WHEN pos % 2 = 0 THEN '0' ELSE CAST(q % 7 AS STRING_) END AS deaths,
  CASE WHEN pos = 3 THEN 'x' ELSE CAST(q % 5 AS STRING_) END AS assists, CAST(NULL AS STRING_) AS suicides, '1' AS team_kills,
  CASE WHEN q % 4 = 0 THEN '0' ELSE CAST(q AS STRING_) END AS score, CAST(q % 6 AS STRING_) AS ctf_score,
  CASE WHEN pos % 2 = 0 THEN CAST(pos AS STRING_) ELSE '-1' END AS local_player, CASE WHEN q % 3 = 0 THEN 'yes' WHEN q % 3 = 1 THEN '0' ELSE NULL END AS is_host,
  CASE WHEN q % 9 = 0 THEN 'TRUE' ELSE NULL END AS is_hostman
FROM (SELECT l_orderkey AS game_id, CAST(l_linenumber - 1 AS INT) AS pos, CAST(max(l_quantity) AS BIGINT) AS q,
    CASE WHEN l_linenumber = 1 AND l_orderkey % 3 = 0 THEN NULL ELSE CAST(l_linenumber - 1 AS STRING_) END AS player_index FROM lineitem GROUP BY l_orderkey, l_linenumber) p
CROSS JOIN (SELECT 'first' AS moment UNION ALL SELECT 'last' AS moment) e WHERE e.moment = 'last' OR pos < 4
"""

NETWORK = """
SELECT DISTINCT l_orderkey AS game_id, CAST(l_linenumber - 1 AS INT) AS pos, CAST(l_linenumber - 1 AS STRING_) AS player_list_index,
  CASE WHEN l_linenumber = 6 THEN NULL ELSE CAST(l_linenumber % 2 AS STRING_) END AS machine_index,
  CASE WHEN l_linenumber = 4 THEN NULL ELSE CAST(l_linenumber / 2 - (l_linenumber % 2) * CAST(0.5 AS DOUBLE) AS STRING_) END AS controller_index
FROM lineitem
"""

EXPLICIT = """
SELECT DISTINCT l_orderkey AS game_id, CAST(l_linenumber AS INT) AS pos, CAST(l_linenumber AS STRING_) AS key, CAST(NULL AS STRING_) AS slot_index,
  CAST(l_linenumber - 1 AS STRING_) AS player_list_index, '9' AS player_index, CASE WHEN l_linenumber = 2 THEN '3' ELSE 'x' END AS machine_index, '-1' AS controller_index,
  CASE WHEN l_linenumber = 1 THEN 'no' ELSE NULL END AS is_host, CASE WHEN l_linenumber <= 2 AND l_orderkey % 3 = 0 THEN 'on' ELSE NULL END AS is_hostman, CASE WHEN l_linenumber = 1 THEN ' Bottom-Right ' ELSE 'middle' END AS screen_slot,
  CASE WHEN l_linenumber = 1 THEN 'quad' ELSE ' ' END AS screen_layout
FROM lineitem
"""

TEXTS = """
SELECT page_id AS id, 0 AS k, url AS t FROM pages
UNION ALL SELECT doc_id, 1, text FROM documents
UNION ALL SELECT doc_id, 2, source FROM documents
"""

#: Every document's whole text.
DOCUMENT_TEXTS = "SELECT doc_id AS id, 1 AS k, text AS t FROM documents"

MANIFESTS = """
SELECT CAST(o_custkey AS STRING_) AS scope_id, o_orderkey AS generation, o_orderdate AS committed_at, CASE WHEN o_orderstatus = 'F' THEN 'superseded' ELSE 'active' END AS state FROM orders
"""


def _boxes(*boxes: tuple[float, float]) -> list[dict]:
    return [{"type": "axis_aligned_box", "coordinate_space": "replay_world.v1", "boundary": "min_inclusive_max_exclusive", "snap_size": 0.5, "min": {"x": a, "y": -5, "z": 0}, "max": {"x": b, "y": 4.5, "z": 8}} for a, b in boxes]


def _uuid(n: int) -> str:
    return f"00000000-0000-4000-8000-{n:012d}"


def region_configuration() -> Configuration:
    """Four regions, one of two boxes and one that overlaps others, in a partition and an overlay."""
    regions = [("west", [(-25, -10)]), ("middle", [(-10, 0), (2.5, 8)]), ("east", [(8, 25)]), ("band", [(-12.5, 9.5)])]
    own = [{"id": _uuid(k + 1), "key": name, "geometries": _boxes(*b)} for k, (name, b) in enumerate(regions)]
    collections = [{"id": _uuid(11), "key": "parts", "analysis_mode": "partition", "region_ids": [_uuid(1), _uuid(2), _uuid(3)]}, {"id": _uuid(12), "key": "over", "analysis_mode": "overlay", "region_ids": [_uuid(2), _uuid(4)]}]
    doc = {"revision": 1, "hash": "0" * 64, "coordinate_space": "replay_world.v1", "sets": [{"id": _uuid(21), "key": "main", "display_name": "Main", "version": 1, "regions": own, "collections": collections}]}
    return parse_configuration(json.loads(json.dumps(doc)))


def spark_sql(sql: str) -> str:
    return sql.replace("STRING_", "STRING").replace("unix_micros_", "unix_micros").replace("C:\\temp\\x", "C:\\\\temp\\\\x")


def duck_sql(sql: str) -> str:
    return sql.replace("STRING_", "VARCHAR").replace("unix_micros_", "epoch_us")


def adapt(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run an adapter over the tables of a folder."""
    configure(spark)
    sql, own = spark_sql(sql), uuid.uuid4().hex
    views = [name for name in ("lineitem", "orders", "events", "documents", "pages") if re.search(rf"\b(?:FROM|JOIN) {name}\b", sql)]
    for name in views:
        table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        local = {c: table[c].cast("timestamp") for c, kind in table.dtypes if kind == "timestamp_ntz"}
        table.withColumns(local).createOrReplaceTempView(f"{name}_{own}")
        sql = re.sub(rf"\b(FROM|JOIN) {name}\b", rf"\1 {name}_{own} AS {name}", sql)
    try:
        return spark.sql(sql)
    finally:
        for name in views:
            spark.catalog.dropTempView(f"{name}_{own}")
