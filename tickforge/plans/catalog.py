"""All registered queries of the replay engine and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.functions import coerce as C
from tickforge.functions import sanitise as S
from tickforge.operators import alarms, heatmap, logquery, occupancy, regions, replay
from tickforge.plans import adapters as A
from tickforge.plans import assemble, documents
from tickforge.plans.adapters import adapt, duck_sql
from tickforge.sinks import artifacts, generations
from tickforge.sinks.held import held

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def put(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = duck_sql(sql)
        return f

    return put


def _micros(df: DataFrame) -> DataFrame:
    return df.withColumn("ts", F.unix_micros("ts"))


def _round(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


# ---- occupancy ----

_CLASSIFIED = f"""s AS ({A.SAMPLES}),
c AS (SELECT *, CASE WHEN slot IS NULL OR slot < 0 OR slot > 63 THEN 'invalid_slot' WHEN hostman THEN 'hostman' WHEN NOT has_object THEN 'missing_player_object'
  WHEN x IS NULL OR y IS NULL OR z IS NULL THEN 'missing_coordinate' WHEN isnan(x) OR isnan(y) OR isnan(z) OR isinf(x) OR isinf(y) OR isinf(z) THEN 'non_finite'
  WHEN abs(x) > 1000000 OR abs(y) > 1000000 OR abs(z) > 1000000 THEN 'out_of_bounds' END AS reason FROM s)"""
_VOXELS = f"""{_CLASSIFIED},
v AS (SELECT game_id, slot, CAST(floor(x / CAST(0.5 AS DOUBLE)) AS BIGINT) AS cx, CAST(floor(y / CAST(0.5 AS DOUBLE)) AS BIGINT) AS cy, CAST(floor(z / CAST(0.5 AS DOUBLE)) AS BIGINT) AS cz,
  count(*) AS ticks, min((tick, pos)) AS f FROM c WHERE reason IS NULL GROUP BY 1, 2, 3, 4, 5)"""


def _capped(slot: int = occupancy.SLOT_CELLS, game: int = occupancy.GAME_CELLS) -> str:
    return f"""{_VOXELS},
r AS (SELECT *, row_number() OVER (PARTITION BY game_id, slot ORDER BY f, cx, cy, cz) AS rs FROM v),
r2 AS (SELECT *, CASE WHEN rs <= {slot} THEN row_number() OVER (PARTITION BY game_id, rs <= {slot} ORDER BY f, slot, cx, cy, cz) END AS rg FROM r),
r3 AS (SELECT *, rs <= {slot} AND rg <= {game} AS ok FROM r2),
k AS (SELECT *, CASE WHEN coalesce(ok, false) THEN NULL WHEN rs > {slot} AND count(*) FILTER (WHERE ok) OVER (PARTITION BY game_id, slot) >= {slot} THEN 'slot_cell_limit' ELSE 'global_cell_limit' END AS cap FROM r3)"""


def _classified(spark: SparkSession, d: str) -> DataFrame:
    return occupancy.classify(adapt(spark, d, A.SAMPLES))


@query("voxel_occupancy", f"WITH {_VOXELS} SELECT game_id, slot, cx, cy, cz, ticks FROM v")
def voxel_occupancy(spark, d):
    return occupancy.saturated(occupancy.voxels(_classified(spark, d))).drop("first")


@query("occupancy_discards", f"WITH {_CLASSIFIED} SELECT game_id, reason, count(*) AS n FROM c WHERE reason IS NOT NULL GROUP BY ALL")
def occupancy_discards(spark, d):
    return occupancy.discards(_classified(spark, d))


@query("occupancy_coverage", f"WITH {_VOXELS}, a AS (SELECT game_id, count(*) AS samples_seen FROM s GROUP BY 1), b AS (SELECT game_id, sum(ticks)::BIGINT AS observations, count(*) AS cells, list_sort(list(DISTINCT slot)) AS slots FROM v GROUP BY 1) SELECT game_id, samples_seen, coalesce(observations, 0)::BIGINT AS observations, coalesce(cells, 0)::BIGINT AS cells, array_to_string(coalesce(slots, []), ',') AS slots, CASE WHEN cells > 0 THEN 'available' ELSE 'unavailable' END AS status FROM a LEFT JOIN b USING (game_id)")
def occupancy_coverage(spark, d):
    c = _classified(spark, d)
    return occupancy.coverage(occupancy.voxels(c), c).withColumn("slots", F.array_join(F.transform("slots", lambda s: s.cast("string")), ","))


def caps_sql(*limits: int) -> str:
    return f"WITH {_capped(*limits)} SELECT game_id, slot, cx, cy, cz, ticks, cap FROM k"


@query("occupancy_caps", caps_sql())
def occupancy_caps(spark, d, *limits):
    return occupancy.capped(occupancy.voxels(_classified(spark, d)), *limits).drop("first")


_HOSTS = "SELECT DISTINCT l_orderkey AS game_id, CAST(l_linenumber AS INT) AS slot FROM lineitem WHERE l_returnflag = 'A' AND l_linenumber = 2"


def exclusion_sql(*limits: int) -> str:
    return f"""WITH {_capped(*limits)}, h AS ({_HOSTS}), kept AS (SELECT k.* FROM k LEFT JOIN h USING (game_id, slot) WHERE cap IS NULL AND h.slot IS NULL),
p AS (SELECT game_id, reason, count(*) AS n FROM c WHERE reason IS NOT NULL GROUP BY ALL UNION ALL SELECT game_id, cap, sum(ticks) FROM k WHERE cap IS NOT NULL GROUP BY ALL
UNION ALL SELECT game_id, 'hostman', sum(ticks) FROM k JOIN h USING (game_id, slot) WHERE cap IS NULL GROUP BY ALL)
SELECT game_id, reason, sum(n)::BIGINT AS n FROM p GROUP BY ALL UNION ALL SELECT game_id, 'kept', sum(ticks)::BIGINT FROM kept GROUP BY ALL"""


@query("occupancy_exclusion", exclusion_sql())
def occupancy_exclusion(spark, d, *limits):
    c = _classified(spark, d)
    cells = occupancy.capped(occupancy.voxels(c), *limits)
    kept, gone = occupancy.exclude_slots(cells.where("cap is null"), adapt(spark, d, _HOSTS))
    own = kept.groupBy("game_id").agg(F.sum("ticks").alias("n")).select("game_id", F.lit("kept").alias("reason"), "n")
    return occupancy.discards(c, cells, gone).unionByName(own)


# ---- heatmaps ----

_SCOPE = f"""{_VOXELS}, g AS ({A.GAMES}), p AS ({A.PARTICIPANTS}), e AS ({A.POSITION_EVENTS}),
o AS (SELECT v.game_id, slot, cx, cy, cz, ticks, cell_size FROM v JOIN g USING (game_id)),
h AS (SELECT p.scope_id, 'occupancy' AS metric, game_id, participant_id, team, CAST(floor((cx + CAST(0.5 AS DOUBLE)) * (cell_size / CAST(0.5 AS DOUBLE))) AS BIGINT) AS px, CAST(floor(-(cy + CAST(0.5 AS DOUBLE)) * (cell_size / CAST(0.5 AS DOUBLE))) AS BIGINT) AS py, ticks AS value
  FROM o JOIN p USING (game_id, slot) UNION ALL
  SELECT scope_id, event_type, game_id, participant_id, team, CAST(floor(x / CAST(0.5 AS DOUBLE)) AS BIGINT), CAST(floor(-y / CAST(0.5 AS DOUBLE)) AS BIGINT), 1 FROM e WHERE event_type IN ('killer_position', 'victim_position')),
hc AS (SELECT scope_id, metric, CASE WHEN team IS NULL THEN 'team:none' ELSE 'team:' || team END AS team_key, px, py, sum(value)::BIGINT AS value FROM h GROUP BY ALL)"""


def _occupancy(spark: SparkSession, d: str) -> DataFrame:
    cells = occupancy.voxels(_classified(spark, d)).drop("first")
    return cells.join(adapt(spark, d, A.GAMES).select("game_id", "cell_size"), "game_id")


def _heat(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    p = adapt(spark, d, A.PARTICIPANTS)
    return heatmap.rows(p, _occupancy(spark, d), adapt(spark, d, A.POSITION_EVENTS)), p


@query("heatmap_cells", f"WITH {_SCOPE} SELECT * FROM hc")
def heatmap_cells(spark, d):
    return heatmap.cells(_heat(spark, d)[0])


@query("heatmap_summary", f"""WITH {_SCOPE}, m AS (SELECT unnest(['occupancy', 'killer_position', 'victim_position']) AS metric),
a AS (SELECT scope_id, sum(n)::BIGINT AS games_selected, sum(k)::BIGINT AS participants_selected FROM (SELECT scope_id, 1 AS n, 0 AS k FROM g UNION ALL SELECT scope_id, 0, 1 FROM p) GROUP BY 1),
b AS (SELECT scope_id, metric, count(DISTINCT game_id) AS gc, count(DISTINCT participant_id) AS pc FROM h GROUP BY 1, 2)
SELECT scope_id, metric, games_selected, coalesce(gc, 0)::BIGINT AS games_contributing, participants_selected, coalesce(pc, 0)::BIGINT AS participants_contributing FROM a CROSS JOIN m LEFT JOIN b USING (scope_id, metric)""")
def heatmap_summary(spark, d):
    return heatmap.summary(*_heat(spark, d), adapt(spark, d, A.GAMES))


@query("heatmap_groups", f"""WITH {_SCOPE} SELECT scope_id, metric, team_key, count(*) AS cells, sum(value)::BIGINT AS value, CASE team_key WHEN 'team:none' THEN 'No team' ELSE 'Team ' || split_part(team_key, ':', 2) END AS label,
CASE team_key WHEN 'team:none' THEN 1073741824 ELSE split_part(team_key, ':', 2)::INT END AS position FROM hc GROUP BY ALL""")
def heatmap_groups(spark, d):
    return heatmap.groups(heatmap.cells(_heat(spark, d)[0]))


@query("heatmap_top_cells", f"WITH {_SCOPE} SELECT * FROM (SELECT scope_id, metric, px, py, sum(value)::BIGINT AS value FROM hc GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY scope_id, metric ORDER BY value DESC, px, py) <= 10")
def heatmap_top_cells(spark, d):
    from pyspark.sql.window import Window

    c = heatmap.cells(_heat(spark, d)[0]).groupBy("scope_id", "metric", "px", "py").agg(F.sum("value").alias("value"))
    w = Window.partitionBy("scope_id", "metric").orderBy(F.col("value").desc(), "px", "py")
    return c.withColumn("_r", F.row_number().over(w)).where("_r <= 10").drop("_r")


def faults_sql(low: int = heatmap.PLANE_LOW, high: int = heatmap.PLANE_HIGH, cells: int = heatmap.MOST_CELLS, groups: int = heatmap.MOST_GROUPS) -> str:
    return f"WITH {_SCOPE} SELECT DISTINCT scope_id, 'invalid_input_contract' AS code FROM hc WHERE px NOT BETWEEN {low} AND {high} OR py NOT BETWEEN {low} AND {high} UNION ALL SELECT DISTINCT scope_id, 'rollup_cell_limit_exceeded' FROM hc GROUP BY scope_id, metric, team_key HAVING count(*) > {cells} UNION ALL SELECT DISTINCT scope_id, 'rollup_group_limit_exceeded' FROM (SELECT DISTINCT scope_id, metric, team_key FROM hc) GROUP BY scope_id, metric HAVING count(*) > {groups}"


@query("heatmap_faults", faults_sql())
def heatmap_faults(spark, d, *limits):
    return heatmap.faults(heatmap.cells(_heat(spark, d)[0]), *limits)


# ---- regions ----

_CONF = A.region_configuration()
_SIZES = (0.5, 1.0)
_BOXES = ", ".join(f"('{r.id}', {i}, {k}, CAST({s} AS DOUBLE), {', '.join(map(str, b.cells(s)))})" for i, r in enumerate(_CONF.regions) for k, b in enumerate(r.boxes) for s in _SIZES)
_MEMBERS = ", ".join(f"('{c.id}', '{c.mode}', '{r}')" for c in _CONF.collections for r in c.regions)
_REGION = f"""{_SCOPE}, bx(region_id, ri, bi, size, x0, x1, y0, y1, z0, z1) AS (VALUES {_BOXES}), mem(collection_id, mode, region_id) AS (VALUES {_MEMBERS}),
cg AS (SELECT * FROM g WHERE has_artifact AND ticks_per_second = 30 AND coalesce(status, 'available') = 'available'),
a AS (SELECT cg.scope_id, v.game_id, v.slot, cx, cy, cz, ticks, cg.cell_size, participant_id, team FROM v JOIN cg USING (game_id) LEFT JOIN p ON p.scope_id = cg.scope_id AND p.game_id = v.game_id AND p.slot = v.slot),
t AS (SELECT DISTINCT a.scope_id, a.game_id, a.slot, cx, cy, cz, region_id FROM a JOIN bx ON size = cell_size AND cx >= x0 AND cx < x1 AND cy >= y0 AND cy < y1 AND cz >= z0 AND cz < z1 WHERE participant_id IS NOT NULL),
w AS (SELECT a.*, unnest(['all', CASE WHEN team IS NULL THEN 'team:none' ELSE 'team:' || team END]) AS group_key FROM a WHERE participant_id IS NOT NULL
  UNION ALL BY NAME SELECT DISTINCT scope_id, 0::BIGINT AS ticks, 'all' AS group_key FROM g),
gt AS (SELECT scope_id, group_key, sum(ticks)::BIGINT AS observed FROM w GROUP BY ALL),
rt AS (SELECT w.scope_id, group_key, region_id, sum(ticks)::BIGINT AS ticks FROM w JOIN t USING (scope_id, game_id, slot, cx, cy, cz) GROUP BY ALL)"""


def _matched(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    games, p = adapt(spark, d, A.GAMES), adapt(spark, d, A.PARTICIPANTS)
    cells = occupancy.voxels(_classified(spark, d)).drop("first")
    return regions.match(regions.assign(games, p, cells), _CONF), games, p


@query("region_groups", f"WITH {_REGION} SELECT scope_id, group_key, observed, CASE group_key WHEN 'all' THEN 'All players' WHEN 'team:none' THEN 'No team' ELSE 'Team ' || split_part(group_key, ':', 2) END AS label, CASE group_key WHEN 'all' THEN -1073741824 WHEN 'team:none' THEN 1073741824 ELSE split_part(group_key, ':', 2)::INT END AS position FROM gt")
def region_groups(spark, d):
    m, games, _ = _matched(spark, d)
    return regions.group_totals(regions.grouped(m, games))


@query("region_totals", f"""WITH {_REGION}, z AS (SELECT gt.*, region_id, coalesce(ticks, 0) AS ticks FROM gt CROSS JOIN (SELECT DISTINCT region_id FROM bx) LEFT JOIN rt USING (scope_id, group_key, region_id))
SELECT scope_id, group_key, region_id, ticks::BIGINT AS ticks, ticks / 30.0::DOUBLE AS seconds, CASE WHEN observed > 0 THEN ticks::DOUBLE / observed END AS share_of_group, CASE WHEN al > 0 THEN ticks::DOUBLE / al END AS share_of_region
FROM z JOIN (SELECT scope_id, region_id, ticks AS al FROM z WHERE group_key = 'all') USING (scope_id, region_id)""")
def region_totals(spark, d):
    m, games, _ = _matched(spark, d)
    return regions.region_totals(regions.grouped(m, games), _CONF)


@query("region_collections", f"""WITH {_REGION}, n AS (SELECT scope_id, game_id, slot, cx, cy, cz, collection_id, count(*) AS k FROM t JOIN mem USING (region_id) GROUP BY ALL),
z AS (SELECT w.scope_id, group_key, collection_id, sum(ticks * k) AS m, sum(ticks) AS u, sum(CASE WHEN k > 1 THEN ticks ELSE 0 END) AS o FROM w JOIN n USING (scope_id, game_id, slot, cx, cy, cz) GROUP BY ALL)
SELECT gt.scope_id, gt.group_key, c.collection_id, c.mode, coalesce(m, 0)::BIGINT AS member_ticks, coalesce(u, 0)::BIGINT AS union_ticks, (observed - coalesce(u, 0))::BIGINT AS outside_ticks, coalesce(o, 0)::BIGINT AS overlap_ticks,
CASE WHEN observed > 0 THEN (observed - coalesce(u, 0))::DOUBLE / observed END AS outside_share FROM gt CROSS JOIN (SELECT DISTINCT collection_id, mode FROM mem) c LEFT JOIN z ON z.scope_id = gt.scope_id AND z.group_key = gt.group_key AND z.collection_id = c.collection_id""")
def region_collections(spark, d):
    m, games, _ = _matched(spark, d)
    return regions.collection_totals(regions.grouped(m, games), _CONF)


_CHECKS = """f AS (SELECT a.scope_id, a.game_id, a.slot, cx, cy, cz, ri, coalesce(min(CASE WHEN cx >= x0 AND cx < x1 AND cy >= y0 AND cy < y1 AND cz >= z0 AND cz < z1 THEN bi + 1 END), count(*)) AS k FROM a JOIN bx ON size = cell_size WHERE participant_id IS NOT NULL GROUP BY ALL)"""


@query("region_coverage", f"""WITH {_REGION}, {_CHECKS}, per AS (SELECT scope_id, game_id, sum(ticks) FILTER (WHERE participant_id IS NOT NULL) AS tt, sum(ticks) FILTER (WHERE participant_id IS NULL) AS dd FROM a GROUP BY ALL),
x AS (SELECT g.*, has_artifact AND ticks_per_second = 30 AND coalesce(status, 'available') = 'available' AS ok, tt, dd FROM g LEFT JOIN per USING (scope_id, game_id)),
y AS (SELECT scope_id, count(*) AS games_selected, count(*) FILTER (WHERE tt > 0) AS games_contributing, count(*) FILTER (WHERE coalesce(tt, 0) <= 0) AS games_missing_data, count(*) FILTER (WHERE has_artifact AND NOT ok) AS incompatible_games, coalesce(sum(tt), 0)::BIGINT AS observed_ticks, coalesce(sum(dd), 0)::BIGINT AS discarded_ticks, coalesce(sum(discarded_samples) FILTER (WHERE ok), 0)::BIGINT AS discarded_samples, array_to_string(list_sort(list(DISTINCT cell_size) FILTER (WHERE ok)), ',') AS cell_sizes, count(DISTINCT cell_size) FILTER (WHERE ok) AS ns, min(cell_size) FILTER (WHERE ok) AS mn FROM x GROUP BY 1)
SELECT y.scope_id, games_selected, games_contributing, games_missing_data, incompatible_games, observed_ticks, discarded_ticks, discarded_samples, cell_sizes, coalesce(ps, 0)::BIGINT AS participants_selected, coalesce(pc, 0)::BIGINT AS participants_contributing, coalesce(mc, 0)::BIGINT AS membership_checks, coalesce(sc, 0)::BIGINT AS source_cells,
games_missing_data = 0 AND incompatible_games = 0 AND discarded_ticks = 0 AND discarded_samples = 0 AS coverage_complete, CASE WHEN ns > 1 THEN 'mixed' WHEN mn = 1 THEN 'voxel_center' ELSE 'grid_exact' END AS membership_precision
FROM y LEFT JOIN (SELECT scope_id, count(*) AS ps FROM p GROUP BY 1) USING (scope_id) LEFT JOIN (SELECT scope_id, count(DISTINCT participant_id) AS pc, count(*) AS sc FROM a WHERE participant_id IS NOT NULL GROUP BY 1) USING (scope_id) LEFT JOIN (SELECT scope_id, sum(k) AS mc FROM f GROUP BY 1) USING (scope_id)""")
def region_coverage(spark, d):
    m, games, p = _matched(spark, d)
    return regions.coverage(games, p, m).withColumn("cell_sizes", F.array_join(F.transform("cell_sizes", lambda s: s.cast("string")), ","))


def budget_sql(limit: int = regions.MOST_CHECKS) -> str:
    return f"WITH {_REGION} SELECT scope_id, (count(*) * {_CONF.boxes})::BIGINT AS work, 'region_membership_limit_exceeded' AS code FROM a WHERE participant_id IS NOT NULL GROUP BY 1 HAVING count(*) * {_CONF.boxes} > {limit}"


@query("region_budget", budget_sql())
def region_budget(spark, d, *limits):
    return regions.over_budget(_matched(spark, d)[0], _CONF, *limits)


# ---- logs ----


def _field(name: str) -> str:
    pattern, kind = logquery.FIELDS[name]
    got = f"nullif(regexp_extract(message, '{pattern}', 1), '')"
    return f"{f'TRY_CAST({got} AS {kind.upper()})' if kind else got} AS {name}"


def _lines(where: str, *fields: str) -> str:
    return f"l AS (SELECT ts, {', '.join(map(_field, fields))} FROM ({A.REQUEST_LOG}) WHERE {where})"


_DONE = "regexp_matches(message, '\"event\":\"request_completed\"')"


@query("log_route_performance", f"WITH {_lines(_DONE, 'route', 'duration_ms', 'db_query_ms')} SELECT route, count(*) AS requests, round(avg(duration_ms), 6) AS avg_ms, round(quantile_cont(duration_ms, 0.95), 6) AS p95_ms, round(quantile_cont(duration_ms, 0.99), 6) AS p99_ms, max(duration_ms) AS max_ms, round(avg(db_query_ms), 6) AS avg_db_ms FROM l GROUP BY 1 ORDER BY p95_ms DESC, route LIMIT 50")
def log_route_performance(spark, d):
    return _round(logquery.route_performance(adapt(spark, d, A.REQUEST_LOG)), "avg_ms", "p95_ms", "p99_ms", "avg_db_ms")


@query("log_slow_requests", f"WITH {_lines(_DONE, 'request_id', 'trace_value', 'route', 'status', 'duration_ms', 'db_query_ms', 'db_query_count')} SELECT * REPLACE (epoch_us(ts) AS ts) FROM l WHERE duration_ms >= 2000 ORDER BY duration_ms DESC, l.ts, request_id LIMIT 100")
def log_slow_requests(spark, d):
    return _micros(logquery.slow_requests(adapt(spark, d, A.REQUEST_LOG)))


@query("log_database_hotspots", f"WITH {_lines(_DONE, 'route', 'db_query_ms', 'db_query_count')} SELECT route, count(*) AS requests, sum(db_query_count)::BIGINT AS queries, round(avg(db_query_count), 6) AS avg_queries, round(quantile_cont(db_query_count::DOUBLE, 0.95), 6) AS p95_queries, round(avg(db_query_ms), 6) AS avg_db_ms, round(quantile_cont(db_query_ms, 0.95), 6) AS p95_db_ms FROM l GROUP BY 1 ORDER BY p95_db_ms DESC, route LIMIT 50")
def log_database_hotspots(spark, d):
    return _round(logquery.database_hotspots(adapt(spark, d, A.REQUEST_LOG)), "avg_queries", "p95_queries", "avg_db_ms", "p95_db_ms")


@query("log_cold_versus_warm", f"WITH {_lines(_DONE, 'cold_start', 'duration_ms', 'db_connect_ms')} SELECT cold_start, count(*) AS requests, round(avg(duration_ms), 6) AS avg_ms, round(quantile_cont(duration_ms, 0.95), 6) AS p95_ms, round(avg(db_connect_ms), 6) AS avg_db_connect_ms FROM l GROUP BY 1")
def log_cold_versus_warm(spark, d):
    return _round(logquery.cold_versus_warm(adapt(spark, d, A.REQUEST_LOG)), "avg_ms", "p95_ms", "avg_db_connect_ms")


@query("log_recent_errors", "WITH " + _lines("""regexp_matches(message, '"event":"api_error"') OR regexp_matches(message, '"event":"unhandled_exception"') OR regexp_matches(message, '"outcome":"server_error"')""", "request_id", "trace_value", "route", "event", "error_type") + " SELECT * REPLACE (epoch_us(ts) AS ts) FROM l ORDER BY l.ts DESC, request_id LIMIT 100")
def log_recent_errors(spark, d):
    return _micros(logquery.recent_server_errors(adapt(spark, d, A.REQUEST_LOG)))


@query("log_gateway_failures", f"SELECT * REPLACE (epoch_us(ts) AS ts) FROM ({A.ACCESS_LOG}) l WHERE TRY_CAST(status AS INT) >= 400 ORDER BY l.ts DESC, requestId LIMIT 100")
def log_gateway_failures(spark, d):
    return _micros(logquery.gateway_failures(adapt(spark, d, A.ACCESS_LOG)))


# ---- metrics ----

_BUCKET = "CAST(floor(epoch(ts) / {0}) * {0} AS BIGINT)"


def _alarm_sql(a: alarms.Alarm) -> str:
    stat = {"Sum": "sum(value)", "Maximum": "max(value)"}.get(a.statistic, f"quantile_cont(value, {int(a.statistic[1:] or 0) / 100 if a.statistic[0] == 'p' else 0})")
    return f"""WITH w AS (SELECT {_BUCKET.format(a.period)} AS start, {stat} AS value FROM events WHERE event_type = '{a.metric}' GROUP BY 1),
s AS (SELECT unnest(range(min(start), max(start) + 1, {a.period})) AS start FROM w), b AS (SELECT start, value, CASE WHEN value {'>' if a.strict else '>='} {a.threshold} THEN 1 ELSE 0 END AS hit FROM s LEFT JOIN w USING (start)),
r AS (SELECT start, value, sum(hit) OVER (ORDER BY start ROWS BETWEEN {a.n - 1} PRECEDING AND CURRENT ROW)::BIGINT AS breaches FROM b) SELECT start, round(value, 6) AS value, breaches, breaches >= {a.m} AS firing FROM r"""


def _alarm(name: str, a: alarms.Alarm) -> None:
    def run(spark: SparkSession, d: str) -> DataFrame:
        return alarms.states(adapt(spark, d, A.POINTS), a).select(F.unix_timestamp("start").alias("start"), F.round("value", 6).alias("value"), "breaches", "firing")

    query(name, _alarm_sql(a))(run)


_alarm("alarm_p95_2_of_3", alarms.Alarm("p95", "view", "p95", 100, 3600, 3, 2))
_alarm("alarm_max_2_of_2", alarms.Alarm("max", "click", "Maximum", 80, 3600, 2, 2, strict=True))
_alarm("alarm_sum_1_of_1", alarms.Alarm("sum", "error", "Sum", 150, 300))


@query("metric_windows", f"SELECT event_type AS metric, {_BUCKET.format(3600)} AS start, count(*) AS points, round(sum(value), 4) AS sum, max(value) AS maximum, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95, round(quantile_cont(value, 0.99), 6) AS p99 FROM events GROUP BY 1, 2")
def metric_windows(spark, d):
    w = alarms.windows(adapt(spark, d, A.POINTS), 3600)
    return _round(w.withColumns({"start": F.unix_timestamp("start"), "sum": F.round("sum", 4)}), "p50", "p95", "p99")


_NAMES = "SELECT DISTINCT concat(event_type, '-', CAST(user_id % 3 AS STRING_)) AS name, CAST(user_id % 3 * 10 AS INT) AS threshold FROM events"


@query("alarm_names", f"WITH n AS ({_NAMES}) SELECT DISTINCT name FROM n ORDER BY name")
def alarm_names(spark, d):
    n = adapt(spark, d, _NAMES)
    return alarms.names(n, n.where("threshold > 0"))


@query("alarm_labels", f"WITH n AS ({_NAMES}) SELECT threshold, threshold || ': ' || string_agg(name, ', ' ORDER BY name) AS label FROM n GROUP BY 1")
def alarm_labels(spark, d):
    return alarms.labels(adapt(spark, d, _NAMES))


# ---- replays ----

_INT = "CAST(trunc(TRY_CAST({0} AS DOUBLE)) AS BIGINT)"
_P = f"pl AS ({A.PLAYERS}), q AS (SELECT *, CAST(coalesce({_INT.format('player_index')}, pos) AS INT) AS slot FROM pl), fi AS (SELECT * FROM q WHERE moment = 'first'), la AS (SELECT * FROM q WHERE moment = 'last')"
_META = "SELECT l_orderkey AS game_id, CAST(l_linenumber - 1 AS INT) AS slot, CAST(max(l_partkey) AS BIGINT) AS k FROM lineitem GROUP BY 1, 2"


def _meta(spark: SparkSession, d: str) -> DataFrame:
    text = lambda *kv: F.create_map(*[x for k, v in kv for x in (F.lit(k), v)])
    n, s = F.col("k"), lambda c: c.cast("string")
    return adapt(spark, d, _META).select(
        "game_id", "slot", text(("10", s(n % 3)), ("20", F.lit("[1,2]"))).alias("kills_by_tick"), text(("5", F.lit("[[1,2,3]]")), ("6", F.lit("[]"))).alias("deaths_by_tick"), text(("1", F.lit("[9]")), ("2", s(n % 2)), ("3", F.lit("1.9"))).alias("assists_by_tick"),
        text(("1", s(n % 11)), ("2", F.lit("x"))).alias("shots_by_tick"), s(n / 2).alias("damage_dealt"), F.lit(" 7.5 ").alias("damage_received"), text(("1", s(n % 4)), ("2", F.lit("2"))).alias("streak_by_tick"), text(("5", s(n % 2))).alias("streak_counts_by_amount"),
        F.when(n % 3 == 0, text(("2", s(n % 5)), ("3", F.lit("1")), ("4", F.lit("1")), ("7", F.lit("2")), ("1", F.lit("9")))).otherwise(F.create_map().cast("map<string,string>")).alias("multikill_counts_by_amount"), F.when(n % 3 == 1, text(("1", F.lit("[2,3,2]")), ("2", F.lit("4")))).alias("multikills_by_tick"),
    )


_PARTS = f"""{_P}, me AS ({_META}),
pa AS (SELECT la.game_id, la.slot, CAST(CASE WHEN la.team_given THEN {_INT.format('la.team')} ELSE {_INT.format('fi.team')} END AS INT) AS team,
  coalesce(nullif(trim(la.name), ''), nullif(trim(la.player_name), ''), nullif(trim(fi.name), ''), nullif(trim(fi.player_name), ''), 'Player ' || la.slot) AS name,
  CASE WHEN coalesce({_INT.format('la.kills')}, 0) <> 0 THEN {_INT.format('la.kills')} ELSE coalesce(k % 3 + 2, 0) END AS kills,
  CASE WHEN coalesce({_INT.format('la.deaths')}, 0) <> 0 THEN {_INT.format('la.deaths')} ELSE coalesce(0 * k + 1, 0) END AS deaths,
  CASE WHEN coalesce({_INT.format('la.assists')}, 0) <> 0 THEN {_INT.format('la.assists')} ELSE coalesce(k % 2 + 1, 0) END AS assists,
  {_INT.format('la.suicides')} AS suicides, {_INT.format('la.team_kills')} AS betrayals,
  CASE WHEN coalesce({_INT.format('la.score')}, 0) <> 0 THEN {_INT.format('la.score')} ELSE {_INT.format('la.ctf_score')} END AS score,
  coalesce(k % 11, 0) AS shots_fired, k / 2.0::DOUBLE AS damage_dealt, CASE WHEN k IS NOT NULL THEN 7.5::DOUBLE END AS damage_taken,
  CASE WHEN k IS NOT NULL THEN greatest(k % 4, 2, CASE WHEN k % 2 > 0 THEN 5 ELSE 0 END) END AS max_kill_streak,
  CAST(CASE k % 3 WHEN 0 THEN k % 5 WHEN 1 THEN 2 END AS BIGINT) AS double_kills, CAST(CASE k % 3 WHEN 0 THEN 1 WHEN 1 THEN 1 END AS BIGINT) AS triple_kills, CAST(CASE k % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 END AS BIGINT) AS multikills_4_plus
  FROM la LEFT JOIN fi ON fi.game_id = la.game_id AND fi.slot = la.slot LEFT JOIN me ON me.game_id = la.game_id AND me.slot = la.slot),
tm AS (SELECT game_id, team, sum(coalesce(score, 0))::BIGINT AS score, count(*) AS players, sum(kills)::BIGINT AS kills, sum(deaths)::BIGINT AS deaths FROM pa WHERE team IS NOT NULL GROUP BY 1, 2)"""
_TEAM = "CASE WHEN team = 0 THEN 'Red' WHEN team = 1 THEN 'Blue' WHEN team IS NOT NULL THEN 'Team ' || team END AS team_name"


def _participants(spark: SparkSession, d: str) -> DataFrame:
    return replay.participants(adapt(spark, d, A.PLAYERS), _meta(spark, d))


@query("replay_participants", f"WITH {_PARTS} SELECT *, {_TEAM} FROM pa")
def replay_participants(spark, d):
    return _participants(spark, d).select("*", F.col("multikills.double").alias("double_kills"), F.col("multikills.triple").alias("triple_kills"), F.col("multikills.more").alias("multikills_4_plus")).drop("multikills")


@query("replay_teams", f"WITH {_PARTS} SELECT *, {_TEAM} FROM tm")
def replay_teams(spark, d):
    return replay.team_stats(_participants(spark, d))


@query("replay_winners", f"WITH {_PARTS}, r AS (SELECT *, rank() OVER (PARTITION BY game_id ORDER BY score DESC) AS k FROM tm) SELECT game_id, CASE WHEN count(*) = 1 THEN min(team) END AS winning_team FROM r WHERE k = 1 GROUP BY 1")
def replay_winners(spark, d):
    return replay.winners(replay.team_stats(_participants(spark, d)))


_SCREEN = """CASE n WHEN 1 THEN 'full' WHEN 2 THEN ['top', 'bottom'][k] WHEN 3 THEN ['top', 'bottom-left', 'bottom-right'][k] WHEN 4 THEN ['top-left', 'top-right', 'bottom-left', 'bottom-right'][k] END AS screen_slot,
CASE n WHEN 1 THEN 'single' WHEN 2 THEN 'vertical_2' WHEN 3 THEN 'three_player' WHEN 4 THEN 'quad' END AS screen_layout"""
_BOOL = "CASE WHEN lower(trim({0})) IN ('1', 'true', 'yes', 'on', 'y', 't') THEN true WHEN lower(trim({0})) IN ('0', 'false', 'no', 'off', 'n', 'f') THEN false END"
_CONTEXTS = f"""{_P}, nw AS (SELECT game_id, pos, CAST({_INT.format('player_list_index')} AS INT) AS slot, CAST({_INT.format('machine_index')} AS INT) AS machine, CAST({_INT.format('controller_index')} AS INT) AS controller FROM ({A.NETWORK})),
ns AS (SELECT game_id, slot, row_number() OVER (PARTITION BY game_id, machine ORDER BY coalesce(controller, pos), slot) AS k, count(*) OVER (PARTITION BY game_id, machine) AS n FROM nw WHERE machine IS NOT NULL),
n1 AS (SELECT nw.game_id, nw.slot, machine AS machine_index, controller AS controller_index, machine = 0 AS is_host, CAST(NULL AS BOOLEAN) AS is_hostman, {_SCREEN} FROM nw LEFT JOIN ns ON ns.game_id = nw.game_id AND ns.slot = nw.slot),
tj AS (SELECT la.game_id, la.slot, coalesce({_INT.format('la.local_player')}, {_INT.format('fi.local_player')}) AS local, coalesce({_BOOL.format('la.is_host')}, {_BOOL.format('fi.is_host')}) AS host, coalesce({_BOOL.format('la.is_hostman')}, {_BOOL.format('fi.is_hostman')}) AS hm, CASE WHEN la.game_id % 4 <> 1 THEN la.game_id % 2 END AS machine FROM la LEFT JOIN fi ON fi.game_id = la.game_id AND fi.slot = la.slot),
ts AS (SELECT game_id, slot, row_number() OVER (PARTITION BY game_id, machine ORDER BY local, slot) AS k, count(*) OVER (PARTITION BY game_id, machine) AS n FROM tj WHERE local >= 0 AND machine IS NOT NULL),
t1 AS (SELECT tj.game_id, tj.slot, CAST(CASE WHEN local >= 0 THEN machine END AS INT) AS machine_index, CAST(CASE WHEN local >= 0 THEN local END AS INT) AS controller_index, coalesce(host, CASE WHEN local >= 0 THEN machine = 0 END) AS is_host, hm AS is_hostman, {_SCREEN} FROM tj LEFT JOIN ts ON ts.game_id = tj.game_id AND ts.slot = tj.slot),
e1 AS (SELECT game_id, CAST(coalesce({_INT.format('slot_index')}, {_INT.format('player_list_index')}, {_INT.format('player_index')}, {_INT.format('key')}) AS INT) AS slot, CAST(CASE WHEN {_INT.format('machine_index')} >= 0 THEN {_INT.format('machine_index')} END AS INT) AS machine_index, CAST(CASE WHEN {_INT.format('controller_index')} >= 0 THEN {_INT.format('controller_index')} END AS INT) AS controller_index,
  {_BOOL.format('is_host')} AS is_host, {_BOOL.format('is_hostman')} AS is_hostman, CASE WHEN lower(trim(screen_slot)) IN ('full', 'top', 'bottom', 'bottom-left', 'bottom-right', 'top-left', 'top-right') THEN lower(trim(screen_slot)) END AS screen_slot, nullif(trim(screen_layout), '') AS screen_layout FROM ({A.EXPLICIT})),
cx AS (SELECT coalesce(e1.game_id, n1.game_id, t1.game_id) AS game_id, coalesce(e1.slot, n1.slot, t1.slot) AS slot, {', '.join(f'coalesce(e1.{c}, n1.{c}, t1.{c}) AS {c}' for c in replay.CONTEXT)}
  FROM n1 FULL JOIN t1 ON n1.game_id = t1.game_id AND n1.slot = t1.slot FULL JOIN e1 ON e1.game_id = coalesce(n1.game_id, t1.game_id) AND e1.slot = coalesce(n1.slot, t1.slot)),
ctx AS (SELECT * FROM cx WHERE {' OR '.join(f'{c} IS NOT NULL' for c in replay.CONTEXT)})"""
_MACHINES = "SELECT o_orderkey AS game_id, CAST(o_orderkey % 2 AS INT) AS machine FROM orders"


def _contexts(spark: SparkSession, d: str) -> DataFrame:
    return replay.merge_contexts(replay.network_contexts(adapt(spark, d, A.NETWORK)), replay.tick_contexts(adapt(spark, d, A.PLAYERS), adapt(spark, d, _MACHINES)), replay.explicit_contexts(adapt(spark, d, A.EXPLICIT)))


@query("replay_contexts", f"WITH {_CONTEXTS} SELECT * FROM ctx")
def replay_contexts(spark, d):
    return _contexts(spark, d)


@query("replay_host_style", f"WITH {_CONTEXTS} SELECT game_id, CASE WHEN count(*) FILTER (WHERE is_host) = 0 OR (count(*) FILTER (WHERE is_host) = 1 AND count(*) FILTER (WHERE is_host AND is_hostman) = 1) THEN 'neutral' ELSE 'on_off' END AS host_style FROM ctx GROUP BY 1")
def replay_host_style(spark, d):
    return replay.host_style(_contexts(spark, d))


def graph_sql(most: int = 16) -> str:
    return f"""WITH {_CONTEXTS}, b AS (SELECT fi.game_id, fi.slot, fi.pos, {', '.join(f"CASE WHEN regexp_full_match(trim(fi.{c}), '[0-9]+') THEN TRY_CAST(fi.{c} AS BIGINT) END AS {c}" for c in ('kills', 'deaths', 'assists'))} FROM fi LEFT JOIN (SELECT game_id, slot FROM ctx WHERE is_hostman) h ON h.game_id = fi.game_id AND h.slot = fi.slot WHERE h.slot IS NULL AND fi.slot >= 0 AND {_BOOL.format('fi.is_hostman')} IS NOT TRUE)
SELECT game_id, slot, kills, deaths, assists FROM (SELECT * FROM b WHERE coalesce(kills, deaths, assists) IS NOT NULL QUALIFY row_number() OVER (PARTITION BY game_id, slot ORDER BY pos) = 1) QUALIFY row_number() OVER (PARTITION BY game_id ORDER BY pos) <= {most}"""


@query("replay_graph_players", graph_sql())
def replay_graph_players(spark, d, *limits):
    return replay.graph_players(adapt(spark, d, A.PLAYERS), replay.hosts(_contexts(spark, d)), *limits)


@query("replay_first_last", "SELECT conv_id AS game_id, count(*) AS n_ticks, min_by(role, turn) AS first_role, max_by(role, turn) AS last_role, min_by(length(text), turn) AS first_length, max_by(length(text), turn) AS last_length FROM conversations GROUP BY 1")
def replay_first_last(spark, d):
    t = spark.read.parquet(f"{d}/conversations.parquet").select(F.col("conv_id").alias("game_id"), F.col("turn").alias("tick"), "role", F.length("text").cast("bigint").alias("n"))
    return replay.first_last(t).select("game_id", "n_ticks", F.col("first.role").alias("first_role"), F.col("last.role").alias("last_role"), F.col("first.n").alias("first_length"), F.col("last.n").alias("last_length"))


_GAMES = """SELECT o_orderkey AS game_id, CASE WHEN o_orderkey % 2 = 0 THEN concat('levels/test/m', CAST(o_orderkey % 9 AS STRING_), '/') END AS last_map_name, concat('levels/', o_orderpriority) AS first_map_name, CASE WHEN o_orderkey % 3 = 0 THEN ' CTF' ELSE 'custom' END AS settings_mode,
CASE WHEN o_orderkey % 4 = 0 THEN 'unknown' ELSE CAST(o_orderkey % 4 AS STRING_) END AS last_game_type, 'Slayer' AS first_game_type, CASE WHEN o_orderkey % 5 = 0 THEN ' unknown <7>' ELSE NULL END AS settings_name, CASE WHEN o_orderkey % 5 = 1 THEN '' ELSE 'V' END AS last_variant, 'W' AS first_variant,
CASE WHEN o_orderkey % 3 = 1 THEN NULL ELSE o_orderkey % 3 = 0 END AS is_full_game, o_orderkey % 7 = 0 AS game_ended, CASE WHEN o_orderkey % 2 = 0 THEN '2026-05-09 15:51:32.887485' ELSE NULL END AS recording_started, '2026-05-09T17:51:32+02:00' AS first_start_time,
'bad' AS recording_ended, '2026-05-09 15:52:00' AS last_current_time, CASE WHEN o_orderkey % 3 = 0 THEN concat('1:0', CAST(o_orderkey % 10 AS STRING_), ':07.9') WHEN o_orderkey % 3 = 1 THEN '2:30' ELSE '1 day, 0:00:01' END AS duration FROM orders"""


@query("replay_games", f"""WITH {_PARTS}, g AS ({_GAMES}), r AS (SELECT *, rank() OVER (PARTITION BY game_id ORDER BY score DESC) AS k FROM tm), wi AS (SELECT game_id, CASE WHEN count(*) = 1 THEN min(team) END AS winning_team FROM r WHERE k = 1 GROUP BY 1)
SELECT g.game_id, coalesce(last_map_name, first_map_name) AS map_engine_name, list_last(string_split(rtrim(coalesce(last_map_name, first_map_name), '/'), '/')) AS map_short_name, CASE WHEN trim(settings_mode) = 'CTF' THEN 'ctf' WHEN last_game_type <> 'unknown' THEN last_game_type END AS game_type,
coalesce(nullif(last_variant, ''), first_variant) AS variant_name, CASE WHEN coalesce(is_full_game, true) OR game_ended THEN 'completed' ELSE 'imported' END AS status, CASE WHEN recording_started IS NOT NULL THEN '2026-05-09T15:51:32.887485Z' ELSE '2026-05-09T15:51:32Z' END AS started_at, CAST(NULL AS VARCHAR) AS ended_at,
CASE g.game_id % 3 WHEN 0 THEN 3600 + 60 * (g.game_id % 10) + 7 WHEN 1 THEN 150 END AS duration_seconds, winning_team FROM g LEFT JOIN wi USING (game_id)""")
def replay_games(spark, d):
    return replay.games(adapt(spark, d, _GAMES), replay.winners(replay.team_stats(_participants(spark, d))))


@query("meta_sums", "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS numbers, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS events, round(event_id / 30.0::DOUBLE, 3) AS seconds FROM events")
def meta_sums(spark, d):
    m = F.from_json("props", "map<string,string>")
    return spark.read.parquet(f"{d}/events.parquet").select("event_id", replay.sum_numbers(m).alias("numbers"), replay.sum_events(m).alias("events"), C.tick_seconds(F.col("event_id")).alias("seconds"))


# ---- replay documents ----

#: Columns of a table that its query returns, where it does not return all.
_COLUMNS = {
    "games": ["game_id", "map_engine_name", "map_short_name", "game_type", "variant_name", "status", "started_at", "duration_seconds", "winning_team"],
    "participants": ["game_id", "slot", "team", "name", "kills", "deaths", "suicides", "score", "damage_dealt"],
    "teams": ["game_id", "team", "score", "players"],
    "contexts": ["game_id", "slot", "is_hostman"],
    "event_counts": ["game_id", "ticks", "events"],
}


def _document(table: str) -> None:
    def run(spark: SparkSession, d: str) -> DataFrame:
        docs = documents.parsed(spark, d)
        made = assemble.Tables(docs, hold=lambda df: held(df, table), only=table) if table in assemble.Tables.NEEDS else assemble.Tables(docs, hold=lambda df: df)
        made = getattr(made, "team_stats" if table == "teams" else table)
        return made.select(*_COLUMNS.get(table, made.columns))

    query(f"replay_doc_{table}", documents.EXPECTED[table])(run)


for _table in documents.EXPECTED:
    _document(_table)


# ---- texts and keys ----

_UNSAFE = r"""(lower({0}) LIKE '%http://%' OR lower({0}) LIKE '%https://%' OR lower({0}) LIKE '%x-amz-%' OR regexp_matches({0}, '^([a-z]:[\\/]|\\\\|/(tmp|var|home|users|mnt)/)', 'i') OR regexp_matches({0}, '^([0-9]{{1,3}}\.){{3}}[0-9]{{1,3}}(:[0-9]{{1,5}})?$') OR regexp_matches({0}, '^(0x)?[0-9a-f]{{32,}}$', 'i'))"""


def _texts_sql(rows: str) -> str:
    return rf"""WITH w AS (SELECT id, k, nullif(regexp_replace(t, '^\s+|\s+$', '', 'g'), '') AS u FROM ({rows})), x AS (SELECT *, left(u, 256) AS t FROM w), y AS (SELECT id, k, CASE WHEN NOT {_UNSAFE.format('t')} THEN t END AS safe, u FROM x)
SELECT id, k, safe, CASE WHEN NOT regexp_matches(safe, '^(unknown|unknown\s*<[^>]+>|unknown\s+[-+]?(0x[0-9a-f]+|[0-9]+))$', 'i') THEN safe END AS authoritative, CASE WHEN lower(u) IN ('ctf', 'slayer', 'oddball', 'king', 'race') THEN lower(u) END AS mode, CASE WHEN regexp_matches(u, '^[a-z0-9][a-z0-9_]*$') THEN u END AS release_key FROM y"""


def _texts(spark, d, sql):
    t = F.col("t")
    return adapt(spark, d, sql).select("id", "k", S.safe_text(t).alias("safe"), S.authoritative(t).alias("authoritative"), S.known_mode(t).alias("mode"), S.release_key(t).alias("release_key"))


@query("settings_texts", _texts_sql(A.TEXTS))
def settings_texts(spark, d):
    """URLs of all pages, whole texts and sources of all documents; only safe and authoritative texts are cut."""
    return _texts(spark, d, A.TEXTS)


@query("settings_document_texts", _texts_sql(A.DOCUMENT_TEXTS))
def settings_document_texts(spark, d):
    return _texts(spark, d, A.DOCUMENT_TEXTS)


_KEYS = "SELECT doc_id AS id, CASE WHEN doc_id % 5 = 0 THEN 'Ghost_Mode' WHEN doc_id % 5 = 1 THEN concat(' Kill-In Order ', CAST(doc_id % 3 AS STRING_)) WHEN doc_id % 5 = 2 THEN 'score_limit' WHEN doc_id % 5 = 3 THEN '_9lives' ELSE concat('a', source) END AS t FROM documents"


@query("settings_keys", rf"""WITH x AS (SELECT id, trim(t) AS t FROM ({_KEYS})), y AS (SELECT *, regexp_replace(regexp_replace(lower(t), '[^a-z0-9_]+', '_', 'g'), '^_+|_+$', '', 'g') AS f FROM x)
SELECT id, CASE WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9_]{{0,63}}$') AND NOT regexp_matches(lower(t), '{'|'.join(S.UNSAFE_PARTS)}') THEN t END AS safe_key, CASE WHEN regexp_matches(f, '^[a-z][a-z0-9_]*$') THEN f END AS fact_key FROM y""")
def settings_keys(spark, d):
    return adapt(spark, d, _KEYS).select("id", S.safe_key(F.col("t")).alias("safe_key"), S.fact_key(F.col("t")).alias("fact_key"))


_RAW = "SELECT event_id AS id, CASE event_id % 12 WHEN 0 THEN ' 5 ' WHEN 1 THEN '3.9' WHEN 2 THEN '-7' WHEN 3 THEN 'Yes' WHEN 4 THEN 'off' WHEN 5 THEN 'nan' WHEN 6 THEN '' WHEN 7 THEN CAST(event_id AS STRING_) WHEN 8 THEN '64' WHEN 9 THEN '1e3' WHEN 10 THEN 'x' END AS t FROM events"


@query("coercions", rf"""WITH x AS (SELECT id, nullif(trim(t), '') AS t FROM ({_RAW})), y AS (SELECT *, TRY_CAST(t AS DOUBLE) AS d FROM x)
SELECT id, t AS text, CASE WHEN regexp_matches(t, '^[-+]?[0-9]+$') THEN TRY_CAST(t AS BIGINT) END AS integer, CASE WHEN NOT isnan(d) THEN CAST(trunc(d) AS BIGINT) END AS truncated, {_BOOL.format('t')} AS boolean, CASE WHEN isnan(d) THEN NULL ELSE d END AS number, CASE WHEN d >= 0 AND NOT isnan(d) THEN round(d, 3) END AS seconds,
CASE WHEN d BETWEEN 0 AND 63 AND d = floor(d) THEN CAST(d AS INT) END AS slot, CASE WHEN d = floor(d) AND d >= 0 AND NOT isnan(d) THEN CAST(d AS BIGINT) END AS nonnegative FROM y""")
def coercions(spark, d):
    t = F.col("t")
    return adapt(spark, d, _RAW).select("id", C.text(t).alias("text"), C.integer(t).alias("integer"), C.truncated(t).alias("truncated"), C.boolean(t).alias("boolean"), C.coordinate(t).alias("number"), C.seconds(t).alias("seconds"), C.slot(t).alias("slot"), C.nonnegative(t).alias("nonnegative"))


_OBJECTS = "SELECT event_id AS id, concat('replays/', CASE WHEN event_id % 3 = 0 THEN 'unprocessed' ELSE 'other' END, '/', CASE WHEN event_id % 4 = 0 THEN 'none' ELSE concat('0A1B2C3D-0000-4000-8000-', lpad(CAST(event_id AS STRING_), 12, '0')) END, '/f.json.gz') AS k FROM events"


@query("object_keys", rf"""WITH x AS ({_OBJECTS}) SELECT id, lower(nullif(regexp_extract(k, '[0-9a-fA-F]{{8}}-[0-9a-fA-F]{{4}}-[1-5][0-9a-fA-F]{{3}}-[89abAB][0-9a-fA-F]{{3}}-[0-9a-fA-F]{{12}}'), '')) AS upload_id,
'replays/processed/' || CASE WHEN starts_with(k, 'replays/unprocessed/') THEN substr(k, 21) ELSE list_last(string_split(k, '/')) END AS processed, sha256(k) AS digest, list_last(string_split(k, '/')) AS name FROM x""")
def object_keys(spark, d):
    k = F.col("k")
    return adapt(spark, d, _OBJECTS).select("id", C.uuid_in(k).alias("upload_id"), C.rekey(k, "replays/unprocessed/", "replays/processed/").alias("processed"), C.sha256_text(F.sha2(k, 256)).alias("digest"), C.short_name(k).alias("name"))


_ATTEMPTS = "SELECT event_id AS id, concat(lpad(CAST(event_id * 7 AS STRING_), 8, '0'), '-0000-4', lpad(CAST(event_id % 1000 AS STRING_), 3, '0'), '-8000-', lpad(CAST(event_id AS STRING_), 12, 'f')) AS u FROM events"


@query("reprocess_generations", f"WITH x AS (SELECT id, replace(u, '-', '') AS u FROM ({_ATTEMPTS})) SELECT id, CAST((('0x' || substr(u, 1, 16))::UBIGINT::HUGEINT * (18446744073709551616::HUGEINT % 2147483646) + ('0x' || substr(u, 17, 16))::UBIGINT::HUGEINT) % 2147483646 + 2 AS BIGINT) AS generation FROM x")
def reprocess_generations(spark, d):
    return adapt(spark, d, _ATTEMPTS).select("id", generations.reprocess_generation(F.col("u")).alias("generation"))


# ---- generations ----


@query("latest_generations", f"SELECT scope_id, generation, epoch_us(committed_at) AS committed_at, state FROM ({A.MANIFESTS}) WHERE state = 'active' QUALIFY row_number() OVER (PARTITION BY scope_id ORDER BY generation DESC) = 1")
def latest_generations(spark, d):
    return generations.latest(adapt(spark, d, A.MANIFESTS)).withColumn("committed_at", F.unix_micros("committed_at"))


@query("expired_generations", f"SELECT scope_id, generation, epoch_us(committed_at) AS committed_at, state FROM ({A.MANIFESTS}) WHERE state = 'superseded' AND committed_at < TIMESTAMP '1998-01-01' - INTERVAL 30 DAY")
def expired_generations(spark, d):
    now = F.lit("1998-01-01").cast("timestamp")
    return generations.expired(adapt(spark, d, A.MANIFESTS), now).withColumn("committed_at", F.unix_micros("committed_at"))


@query("input_page", "SELECT game_id, source_revision FROM (SELECT CAST(o_orderkey AS VARCHAR) AS game_id, CAST(o_orderkey % 3 AS INT) AS source_revision FROM orders) WHERE source_revision = 1 AND game_id > '1234' ORDER BY game_id LIMIT 100")
def input_page(spark, d):
    from tickforge.sources.replays import page

    rows = spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_orderkey").cast("string").alias("game_id"), (F.col("o_orderkey") % 3).cast("int").alias("source_revision"))
    return page(rows, 1, "1234", 100)


_RESULTS = "SELECT CAST(l_quantity AS BIGINT) AS cells, CAST(l_linenumber AS BIGINT) AS games, CASE WHEN l_linestatus = 'F' THEN CAST(1 AS BIGINT) ELSE CAST(0 AS BIGINT) END AS failed FROM lineitem"


@query("run_totals", f"SELECT sum(cells)::BIGINT AS cells, sum(games)::BIGINT AS games, sum(failed)::BIGINT AS failed, count(*) AS results FROM ({_RESULTS})")
def run_totals(spark, d):
    return generations.totals(adapt(spark, d, _RESULTS), ["cells", "games", "failed"])



_RUNS = """SELECT CASE WHEN l_returnflag = 'A' THEN 'completed' WHEN l_returnflag = 'R' THEN 'stale' ELSE 'failed' END AS status, CAST(l_linenumber AS BIGINT) AS input_games, CAST(l_quantity AS BIGINT) AS output_cells,
CASE WHEN l_linestatus = 'F' THEN CAST(l_partkey AS BIGINT) ELSE CAST(0 AS BIGINT) END AS region_output_bytes, CAST(l_suppkey AS BIGINT) AS s3_gets FROM lineitem"""
_COUNTED = {"completed": "count(*) FILTER (WHERE status = 'completed')", "stale": "count(*) FILTER (WHERE status = 'stale')", "failed": "count(*) FILTER (WHERE status = 'failed')", "input_games": "sum(input_games)", "output_cells": "sum(output_cells)", "region_output_bytes": "sum(region_output_bytes)", "region_artifacts_written": "count(*) FILTER (WHERE region_output_bytes > 0)", "s3_gets": "sum(s3_gets)"}
_UNIT = "CASE WHEN metric LIKE '%Duration' THEN 'Milliseconds' WHEN metric LIKE '%Bytes' THEN 'Bytes' WHEN metric LIKE '%KiB' THEN 'Kilobytes' ELSE 'Count' END"


@query("invocation_metrics", f"WITH r AS ({_RUNS}), m AS (" + " UNION ALL ".join(f"SELECT '{m}' AS metric, CAST({_COUNTED.get(c, 'max(0)')} AS BIGINT) AS value FROM r" for m, c in generations.METRICS.items()) + f") SELECT metric, value, {_UNIT} AS unit FROM m")
def invocation_metrics(spark, d):
    return generations.metrics(generations.invocation(adapt(spark, d, _RUNS)))


# ---- artifacts: rows to packed documents, and from these back to rows ----


def _reread(documents: DataFrame, key: str, limits: tuple[int, int]) -> DataFrame:
    packed = artifacts.pack(documents, key, limits).where("error IS NULL AND length(content) = size_bytes AND sha2(content, 256) = sha256")
    return artifacts.decode(packed.select(key, "content", F.lit("gzip").alias("encoding")), key, limits[0])


def _claims(games: DataFrame) -> DataFrame:
    return games.select("scope_id").distinct().select("scope_id", F.lit("map").alias("scope_type"), F.col("scope_id").cast("string").alias("map_id"), F.lit(None).cast("string").alias("player_id"), F.lit("validated").alias("eligibility"), F.lit(1).alias("source_revision"))


@query("spatial_artifact_rows", f"WITH {_VOXELS} SELECT game_id, CAST(0.5 AS DOUBLE) AS cell_size, slot, cx, cy, cz, ticks FROM v")
def spatial_artifact_rows(spark, d):
    cells = occupancy.saturated(occupancy.capped(occupancy.voxels(_classified(spark, d))).where("cap is null"))
    games = cells.select("game_id").distinct().select("game_id", F.lit(0.5).alias("cell_size"), F.sha2(F.col("game_id").cast("string"), 256).alias("source_sha256"))
    documents = artifacts.spatial_documents(cells, games, occupancy.coverage(cells, _classified(spark, d)))
    rows, _ = artifacts.spatial_rows(_reread(documents, "game_id", artifacts.SPATIAL_BYTES), "game_id")
    return rows.withColumn("game_id", F.col("game_id").cast("bigint"))


@query("heatmap_artifact_cells", f"WITH {_SCOPE} SELECT * FROM hc")
def heatmap_artifact_cells(spark, d):
    games = adapt(spark, d, A.GAMES)
    heat, p = _heat(spark, d)
    documents, _ = artifacts.heatmap_documents(heatmap.cells(heat), heatmap.summary(heat, p, games), _claims(games))
    return artifacts.heatmap_rows(_reread(documents.select("scope_id", "document"), "scope_id", artifacts.HEATMAP_BYTES))


@query("region_artifact_totals", ORACLE["region_totals"])
def region_artifact_totals(spark, d):
    m, games, p = _matched(spark, d)
    documents, _ = artifacts.region_documents(regions.grouped(m, games), regions.coverage(games, p, m), _claims(games), _CONF, F.lit("2026-01-01T00:00:00Z"))
    return artifacts.region_rows(_reread(documents, "scope_id", artifacts.REGION_BYTES))


@query("occupancy_faults", f"WITH {_VOXELS} SELECT game_id, 'slot_cell_limit' AS code FROM v GROUP BY game_id, slot HAVING count(*) > {occupancy.SLOT_CELLS}")
def occupancy_faults(spark, d):
    return occupancy.faults(occupancy.saturated(occupancy.voxels(_classified(spark, d))))
