"""Replay documents made of the star-schema tables, one for each order, and what has to come out of them as SQL.

A document has two ticks.  The order's lines are its players, in order of their numbers.  Between both ticks every other
player moves, counters rise, and fields that the last tick leaves out are to be taken from the first.  Every 97th
document is no JSON.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.plans.adapters import adapt
from tickforge.sources.replays import parse

#: One row a player: g is the order, pos the player's place, q a quantity that decides the odd cases.
LINES = """
SELECT g, n, q, CAST(row_number() OVER (PARTITION BY g ORDER BY n) - 1 AS INT) AS pos
FROM (SELECT l_orderkey AS g, l_linenumber AS n, CAST(max(l_quantity) AS BIGINT) AS q FROM lineitem GROUP BY l_orderkey, l_linenumber) a
"""


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file, doc, error): the documents as text, as a reader of files gives them."""
    p = adapt(spark, sf_dir, LINES)
    q, pos = F.col("q"), F.col("pos")

    def player(moment: str):
        last = moment == "last"
        place = F.when(q != 50, F.struct(((q - 25) + (F.when(pos % 2 == 0, 1).otherwise(0) if last else 0) + F.when(q == 49, 2000000).otherwise(0)).cast("double").alias("x"), (pos * 1.25 - 2).cast("string").alias("y"), F.when(q != 48, (q % 7).cast("double")).alias("z")))
        return F.struct(
            F.when(q % 3 != 0, pos).alias("player_index"), F.when(F.lit(not last) | (pos != 1), F.concat(F.lit(" p"), pos.cast("string"))).alias("name"), F.when((pos % 3 != 2) & (F.lit(not last) | (pos % 2 == 0)), pos % 3).alias("team"),
            q.cast("string").alias("score"), (q % 6 if last else F.lit(0).cast("bigint")).alias("kills"), F.when(pos % 2 == 0, "3.9").otherwise("2").alias("deaths"), F.lit(2.9).alias("suicides"),
            F.when(F.lit(last) & (pos == 3) & (q % 5 == 0), F.struct(F.lit(True).alias("is_hostman"))).alias("derived_stats"), place.alias("player_object_data"),
        )

    by_tick = F.struct(F.struct(F.lit(2).alias("10"), F.array(F.lit(1), F.lit(2)).alias("20")).alias("kills_by_tick"), (q / 2).alias("damage_dealt"))
    rows = p.groupBy("g").agg(F.array_sort(F.collect_list(F.struct(pos, player("first").alias("f"), player("last").alias("l"), by_tick.alias("m")))).alias("p"))
    tick = lambda n, k: F.struct(F.concat(F.lit("levels\\test\\m"), (F.col("g") % 3).cast("string")).alias("multiplayer_map_name"), F.lit(n == "l").alias("game_ended_this_tick"), F.lit("V").alias("variant"), F.struct(F.lit(k).alias("game_time")).alias("game_time_info"), F.transform("p", lambda x: x[n]).alias("players"))
    g = F.col("g")
    settings = F.struct(F.when(g % 2 == 0, "King").otherwise("slayer").alias("mode"), (g % 50).cast("string").alias("Score_Limit"), F.lit("yes").alias("teamplay"), F.lit("x").alias("base_url"), F.array(F.lit(1)).alias("listed"), F.struct((g % 4).alias("lives"), F.when(g % 5 == 0, "http://x").otherwise(" n ").alias("note")).alias("options"))
    at = lambda x, xs: F.struct(x.cast("double").alias("x"), F.when(x.isNotNull(), 1.5).alias("y"), F.when(x.isNotNull(), 0.25).alias("z"), xs.alias("position"))
    no, none = F.lit(None).cast("double"), F.lit(None).cast("array<double>")
    doc = F.struct(
        F.struct(F.concat(F.lit("g"), g.cast("string")).alias("game_id"), F.lit("2026-05-09 15:51:32").alias("recording_started"), F.lit("0:02:30").alias("game_duration_ingame")).alias("summary"), settings.alias("gametype_settings"),
        F.struct(F.map_from_entries(F.transform("p", lambda x: F.struct(x["pos"].cast("string"), x["m"]))).alias("players")).alias("game_meta"), F.array(at(g % 10, none), at(no, none), at(no, F.array(F.lit(1.0), F.lit(2.0), F.lit(3.0)))).alias("spawns"),
        F.transform(F.sequence(F.lit(1), F.size("p")), lambda i: F.struct(i.alias("at"))).alias("events"), F.array(tick("f", 30), tick("l", 4500)).alias("ticks"),
    )
    return rows.select(F.concat(F.lit("replays/"), g.cast("string"), F.lit(".json")).alias("file"), F.when(g % 97 == 0, "{no json").otherwise(F.to_json(doc)).alias("doc"), F.lit(None).cast("string").alias("error"))


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse(documents(spark, sf_dir))


_WITH = f"""WITH li AS ({LINES}), ok AS (SELECT *, 'g' || g AS game_id, CAST(CASE WHEN pos % 3 <> 2 THEN pos % 3 END AS INT) AS team FROM li WHERE g % 97 <> 0),
sa AS (SELECT game_id, pos AS slot, q, t, pos = 3 AND q % 5 = 0 AS host, q - 25 + t * (1 - pos % 2) + CASE WHEN q = 49 THEN 2000000 ELSE 0 END AS x, pos * CAST(1.25 AS DOUBLE) - 2 AS y, q % 7 AS z FROM ok CROSS JOIN (SELECT unnest([0, 1]) AS t)),
cl AS (SELECT *, CASE WHEN t = 1 AND host THEN 'hostman' WHEN q = 50 THEN 'missing_player_object' WHEN q = 48 THEN 'missing_coordinate' WHEN abs(x) > 1000000 THEN 'out_of_bounds' WHEN host THEN 'hostman' END AS reason FROM sa),
vo AS (SELECT game_id, slot, CAST(floor(x / CAST(0.5 AS DOUBLE)) AS BIGINT) AS cx, CAST(floor(y / CAST(0.5 AS DOUBLE)) AS BIGINT) AS cy, CAST(floor(z / CAST(0.5 AS DOUBLE)) AS BIGINT) AS cz, count(*) AS ticks FROM cl WHERE reason IS NULL GROUP BY ALL),
te AS (SELECT game_id, team, sum(q)::BIGINT AS score, count(*) AS players FROM ok WHERE team IS NOT NULL GROUP BY ALL), wi AS (SELECT game_id, CASE WHEN count(*) = 1 THEN min(team) END AS winning_team FROM (SELECT *, rank() OVER (PARTITION BY game_id ORDER BY score DESC) AS r FROM te) WHERE r = 1 GROUP BY 1),
ga AS (SELECT DISTINCT g, game_id FROM ok)"""

#: What each table of the documents has to be, by name.
EXPECTED = {
    "games": f"{_WITH} SELECT game_id, 'levels\\test\\m' || g % 3 AS map_engine_name, 'm' || g % 3 AS map_short_name, CASE WHEN g % 2 = 0 THEN 'king' ELSE 'slayer' END AS game_type, 'V' AS variant_name, 'completed' AS status, '2026-05-09T15:51:32Z' AS started_at, 150::BIGINT AS duration_seconds, winning_team FROM ga LEFT JOIN wi USING (game_id)",
    "participants": f"{_WITH} SELECT game_id, pos AS slot, team, 'p' || pos AS name, CASE WHEN q % 6 > 0 THEN q % 6 ELSE 4 END AS kills, CASE WHEN pos % 2 = 0 THEN 0 ELSE 2 END::BIGINT AS deaths, 2::BIGINT AS suicides, q AS score, q / 2.0::DOUBLE AS damage_dealt FROM ok",
    "teams": f"{_WITH} SELECT game_id, team, score, players FROM te",
    "contexts": f"{_WITH} SELECT game_id, pos AS slot, true AS is_hostman FROM ok WHERE pos = 3 AND q % 5 = 0",
    "game_facts": f"""{_WITH} SELECT game_id, 'gametype.mode' AS key, 'text' AS kind, CASE WHEN g % 2 = 0 THEN 'King' ELSE 'slayer' END AS value FROM ga UNION ALL SELECT game_id, 'gametype.score_limit', 'integer', (g % 50)::VARCHAR FROM ga
UNION ALL SELECT game_id, 'gametype.teamplay', 'boolean', 'true' FROM ga UNION ALL SELECT game_id, 'gametype.options.lives', 'number', (g % 4)::VARCHAR FROM ga UNION ALL SELECT game_id, 'gametype.options.note', 'text', 'n' FROM ga WHERE g % 5 <> 0""",
    "participant_facts": f"{_WITH} SELECT game_id, pos AS slot, 'participant.is_hostman' AS key, 'true' AS value FROM ok WHERE pos = 3 AND q % 5 = 0",
    "graph_coverage": f"{_WITH} SELECT game_id, 30::BIGINT AS first_tick, 4500::BIGINT AS last_tick, 1.0::DOUBLE AS first_seconds, 150.0::DOUBLE AS last_seconds, true AS starts_after_game_start, true AS incomplete_before_first_tick FROM ga",
    "graph_players": f"{_WITH} SELECT game_id, pos AS slot, 0::BIGINT AS kills, CASE WHEN pos % 2 = 1 THEN 2 END::BIGINT AS deaths, NULL::BIGINT AS assists FROM ok WHERE NOT (pos = 3 AND q % 5 = 0)",
    "spawn_points": f"{_WITH} SELECT game_id, 1::INT AS n, (g % 10)::DOUBLE AS x, 1.5::DOUBLE AS y, 0.25::DOUBLE AS z FROM ga UNION ALL SELECT game_id, 2::INT, 1.0::DOUBLE, 2.0::DOUBLE, 3.0::DOUBLE FROM ga",
    "voxels": f"{_WITH} SELECT game_id, slot, cx, cy, cz, ticks FROM vo",
    "discards": f"{_WITH} SELECT game_id, reason, count(*) AS n FROM cl WHERE reason IS NOT NULL GROUP BY ALL",
    "event_counts": f"{_WITH} SELECT game_id, 2::INT AS ticks, count(*)::INT AS events FROM ok GROUP BY 1",
    "dead_letters": f"WITH li AS ({LINES}) SELECT DISTINCT 'replays/' || g || '.json' AS file, 'bad_json' AS error FROM li WHERE g % 97 = 0",
}
