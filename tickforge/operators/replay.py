"""Games, participants, contexts, teams and graph context from scanned replays.

players: (game_id, moment, pos, fields as text), moment being `first` or `last`.  All joins are on game and slot; a slot that
occurs twice in a tick counts once, the last position winning.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickforge.functions import coerce as C
from tickforge.functions.sanitise import authoritative, known_mode, release_key

# The names of screen parts by number of players of one machine.
SCREEN_SLOTS = {1: ("full",), 2: ("top", "bottom"), 3: ("top", "bottom-left", "bottom-right"), 4: ("top-left", "top-right", "bottom-left", "bottom-right")}
SCREEN_LAYOUTS = {1: "single", 2: "vertical_2", 3: "three_player", 4: "quad"}
CONTEXT = ("machine_index", "controller_index", "is_host", "is_hostman", "screen_slot", "screen_layout")
KINDS = {"machine_index": "int", "controller_index": "int", "is_host": "boolean", "is_hostman": "boolean", "screen_slot": "string", "screen_layout": "string"}
MOST_GRAPH_PLAYERS = 16


def first_last(ticks: DataFrame) -> DataFrame:
    """(game_id, n_ticks, first, last): the ticks' count and the structs at both ends, by array position."""
    fields = F.struct(*[c for c in ticks.columns if c not in ("game_id", "tick")])
    return ticks.groupBy("game_id").agg(F.count("*").alias("n_ticks"), F.min_by(fields, "tick").alias("first"), F.max_by(fields, "tick").alias("last"))


def slots(players: DataFrame) -> DataFrame:
    """Add slot: the player's index, or its position where that is no integer."""
    return players.withColumn("slot", F.coalesce(C.truncated(F.col("player_index")), F.col("pos")).cast("int"))


def last_wins(players: DataFrame, *by: str) -> DataFrame:
    """One row for each slot, the last position."""
    w = Window.partitionBy(*(by or ("game_id", "slot"))).orderBy(F.col("pos").desc())
    return players.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def screens(rows: DataFrame) -> DataFrame:
    """Screen slot and layout by machine: (game_id, slot, screen_slot, screen_layout) for machines of 1 to 4 players.

    rows: (game_id, machine, place, slot), place being the controller or list order."""
    machine = Window.partitionBy("game_id", "machine")
    names = F.create_map(*[x for k, v in SCREEN_SLOTS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    layouts = F.create_map(*[x for k, v in SCREEN_LAYOUTS.items() for x in (F.lit(k), F.lit(v))])
    out = rows.withColumns({"_n": F.count("*").over(machine).cast("int"), "_k": F.row_number().over(machine.orderBy("place", "slot"))})
    out = out.where("_n <= 4")
    return out.select("game_id", "slot", F.get(names[F.col("_n")], F.col("_k") - 1).alias("screen_slot"), layouts[F.col("_n")].alias("screen_layout"))


def _shape(df: DataFrame) -> DataFrame:
    return df.select("game_id", "slot", *[(F.col(c) if c in df.columns else F.lit(None)).cast(KINDS[c]).alias(c) for c in CONTEXT])


def network_contexts(network: DataFrame) -> DataFrame:
    """Contexts of the network client's players (game_id, pos, player_list_index, machine_index, controller_index); machine 0 hosts."""
    rows = network.select("game_id", "pos", C.truncated(F.col("player_list_index")).cast("int").alias("slot"), C.truncated(F.col("machine_index")).cast("int").alias("machine_index"), C.truncated(F.col("controller_index")).cast("int").alias("controller_index")).where("slot is not null")
    own = last_wins(rows).withColumn("is_host", F.col("machine_index") == 0)
    s = screens(rows.where("machine_index is not null").select("game_id", F.col("machine_index").alias("machine"), F.coalesce("controller_index", "pos").alias("place"), "slot"))
    s = s.groupBy("game_id", "slot").agg(F.min("screen_slot").alias("screen_slot"), F.min("screen_layout").alias("screen_layout"))
    return _shape(own.drop("pos").join(s.hint("merge"), ["game_id", "slot"], "left"))


def tick_contexts(players: DataFrame, machines: DataFrame) -> DataFrame:
    """Contexts of the last tick's players, filled from the first tick; machines: (game_id, machine) is the recording machine.

    One shuffle brings both ticks of a slot together.  Joins merge: players out of a compressed scan look small to Spark,
    which would gather all of them on the driver to broadcast them.
    """
    p = slots(players).withColumns({"local": C.truncated(F.col("local_player")).cast("int"), "host": C.boolean(F.col("is_host")), "hostman": C.boolean(F.col("is_hostman"))}).select("game_id", "moment", "slot", F.struct("pos", "local", "host", "hostman").alias("s"))
    end = lambda m: F.max(F.when(F.col("moment") == m, F.col("s"))).alias(m)
    j = p.groupBy("game_id", "slot").agg(end("first"), end("last")).where("last is not null").join(machines.hint("merge"), "game_id", "left")
    j = j.select("game_id", "slot", "machine", *[F.coalesce(f"last.{c}", f"first.{c}").alias(c) for c in ("local", "host", "hostman")])
    here = (F.col("local") >= 0) & F.col("machine").isNotNull()
    own = j.select("game_id", "slot", F.when(here, F.col("machine")).alias("machine_index"), F.when(F.col("local") >= 0, F.col("local")).alias("controller_index"), F.coalesce("host", F.when(here, F.col("machine") == 0)).alias("is_host"), F.col("hostman").alias("is_hostman"))
    s = screens(j.where(here).select("game_id", "machine", F.col("local").alias("place"), "slot"))
    return _shape(own.join(s.hint("merge"), ["game_id", "slot"], "left"))


def explicit_contexts(rows: DataFrame) -> DataFrame:
    """Contexts that the document states (game_id, pos, key, slot_index, player_list_index, player_index and context fields as text)."""
    slot = F.coalesce(*[C.truncated(F.col(c)) for c in ("slot_index", "player_list_index", "player_index", "key")]).cast("int")
    whole = lambda c: F.when(C.truncated(F.col(c)) >= 0, C.truncated(F.col(c)).cast("int"))
    part = F.lower(C.text(F.col("screen_slot")))
    valid = sorted({s for v in SCREEN_SLOTS.values() for s in v})
    out = rows.select("game_id", "pos", slot.alias("slot"), whole("machine_index").alias("machine_index"), whole("controller_index").alias("controller_index"), C.boolean(F.col("is_host")).alias("is_host"), C.boolean(F.col("is_hostman")).alias("is_hostman"), F.when(part.isin(*valid), part).alias("screen_slot"), C.text(F.col("screen_layout")).alias("screen_layout"))
    return _shape(last_wins(out.where("slot is not null")))


def merge_contexts(network: DataFrame, tick: DataFrame, explicit: DataFrame) -> DataFrame:
    """One context a slot; of each field the document's statement comes first, then the network's, then the tick's."""
    known = F.coalesce(*[F.col(c).cast("string") for c in CONTEXT]).isNotNull()
    tag = lambda df, t: df.where(known).select("game_id", "slot", F.struct(*CONTEXT).alias(t))
    j = reduce(lambda a, b: a.join(b, ["game_id", "slot"], "full_outer"), [tag(network, "n"), tag(tick, "t"), tag(explicit, "e")])
    return j.select("game_id", "slot", *[F.coalesce(f"e.{c}", f"n.{c}", f"t.{c}").alias(c) for c in CONTEXT])


def hosts(contexts: DataFrame) -> DataFrame:
    """Slots that a context marks as the host's own machine player."""
    return contexts.where("is_hostman").select("game_id", "slot").distinct()


def sum_numbers(m: Column) -> Column:
    """Sum of the whole parts of a map's numeric values (map<string,string>); lists and other texts count 0."""
    return F.aggregate(F.map_values(m), F.lit(0).cast("bigint"), lambda s, v: s + F.coalesce(C.truncated(v), F.lit(0)))


def sum_events(m: Column) -> Column:
    """The same, but a JSON list counts its length."""
    size = lambda v: F.when(v.startswith("["), F.json_array_length(v).cast("bigint")).otherwise(C.truncated(v))
    return F.aggregate(F.map_values(m), F.lit(0).cast("bigint"), lambda s, v: s + F.coalesce(size(v), F.lit(0)))


def max_streak(by_tick: Column, counts: Column) -> Column:
    """Largest of the streaks by tick and of the amounts counted more than 0 times; null without any."""
    amounts = F.transform(F.filter(F.map_entries(counts), lambda e: C.truncated(e["value"]) > 0), lambda e: C.integer(e["key"]))
    return F.array_max(F.array_compact(F.array_union(F.coalesce(F.transform(F.map_values(by_tick), C.truncated), F.array().cast("array<bigint>")), F.coalesce(amounts, F.array().cast("array<bigint>")))))


def multikills(counts: Column, by_tick: Column) -> Column:
    """struct(double, triple, more): from counts by amount if there are any, else from amounts by tick (numbers or JSON lists); null without either."""
    one = F.transform(F.map_entries(counts), lambda e: F.struct(C.integer(e["key"]).alias("a"), C.truncated(e["value"]).alias("n")))
    listed = F.flatten(F.transform(F.map_values(by_tick), lambda v: F.when(v.startswith("["), F.from_json(v, "array<string>")).otherwise(F.array(v))))
    two = F.transform(listed, lambda v: F.struct(C.truncated(v).alias("a"), F.lit(1).cast("bigint").alias("n")))
    rows = F.when(F.size(counts) > 0, one).when(F.size(by_tick) > 0, two)
    total = lambda keep: F.aggregate(rows, F.lit(0).cast("bigint"), lambda s, r: s + F.when(keep(r["a"]), F.coalesce(r["n"], F.lit(0))).otherwise(0))
    return F.when(rows.isNotNull(), F.struct(total(lambda a: a == 2).alias("double"), total(lambda a: a == 3).alias("triple"), total(lambda a: a >= 4).alias("more")))


def participants(players: DataFrame, meta: DataFrame) -> DataFrame:
    """One row for each player of the last tick: team, name and statistics.

    players: text fields player_index, name, player_name, team, team_given (whether the key is present), score,
    ctf_score, kills, deaths, assists, suicides, team_kills.  meta: (game_id, slot, maps of text, damage).  Counters of
    0 fall back to the sums by tick; assists don't count list lengths; an explicit null team stays null.
    """
    p = slots(players)
    first = last_wins(p.where("moment = 'first'")).select("game_id", "slot", F.col("team").alias("f_team"), F.col("name").alias("f_name"), F.col("player_name").alias("f_player_name"))
    j = p.where("moment = 'last'").join(first, ["game_id", "slot"], "left").join(meta, ["game_id", "slot"], "left")
    n = lambda c: C.truncated(F.col(c))
    team = F.when(F.col("team_given"), n("team")).otherwise(n("f_team")).cast("int")
    or_sum = lambda c, s: F.when(F.coalesce(n(c), F.lit(0)) != 0, n(c)).otherwise(F.coalesce(s, F.lit(0)))
    score = F.when(F.coalesce(n("score"), F.lit(0)) != 0, n("score")).otherwise(n("ctf_score"))
    name = F.coalesce(*[C.text(F.col(c)) for c in ("name", "player_name", "f_name", "f_player_name")], F.concat(F.lit("Player "), F.col("slot").cast("string")))
    return j.select("game_id", "slot", team.alias("team"), C.team_name(team).alias("team_name"), name.alias("name"), or_sum("kills", sum_events(F.col("kills_by_tick"))).alias("kills"), or_sum("deaths", sum_events(F.col("deaths_by_tick"))).alias("deaths"), or_sum("assists", sum_numbers(F.col("assists_by_tick"))).alias("assists"), n("suicides").alias("suicides"), n("team_kills").alias("betrayals"), score.alias("score"), F.coalesce(sum_numbers(F.col("shots_by_tick")), F.lit(0)).alias("shots_fired"), C.number(F.col("damage_dealt")).alias("damage_dealt"), C.number(F.col("damage_received")).alias("damage_taken"), max_streak(F.col("streak_by_tick"), F.col("streak_counts_by_amount")).alias("max_kill_streak"), multikills(F.col("multikill_counts_by_amount"), F.col("multikills_by_tick")).alias("multikills"))


def team_stats(rows: DataFrame) -> DataFrame:
    """(game_id, team, team_name, score, players, kills, deaths); players without a team are left out."""
    z = lambda c: F.sum(F.coalesce(c, F.lit(0))).cast("bigint").alias(c)
    return rows.where("team is not null").groupBy("game_id", "team").agg(z("score"), F.count("*").alias("players"), z("kills"), z("deaths")).withColumn("team_name", C.team_name(F.col("team")))


def winners(teams: DataFrame) -> DataFrame:
    """(game_id, winning_team): the team of the highest score; null where the highest is shared."""
    return teams.groupBy("game_id").agg(F.max("score").alias("_m"), F.collect_list(F.struct("score", "team")).alias("_t")).select("game_id", F.transform(F.filter("_t", lambda t: t["score"] == F.col("_m")), lambda t: t["team"]).alias("_w")).select("game_id", F.when(F.size("_w") == 1, F.col("_w")[0]).alias("winning_team"))


def host_style(contexts: DataFrame) -> DataFrame:
    """(game_id, host_style): neutral without a host or with one that is the host machine's player, else on_off."""
    h = F.coalesce("is_host", F.lit(False))
    a = contexts.groupBy("game_id").agg(F.count_if(h).alias("n"), F.count_if(h & F.coalesce("is_hostman", F.lit(False))).alias("m"))
    return a.select("game_id", F.when((F.col("n") == 0) | ((F.col("n") == 1) & (F.col("m") == 1)), "neutral").otherwise("on_off").alias("host_style"))


def recorded_seconds(elapsed: list[Column], tick: Column, real_time: Column) -> Column:
    """The first usable of several second counts, else the tick's seconds, else the clock's."""
    return F.coalesce(*[C.seconds(e) for e in elapsed], C.tick_seconds(tick), F.when(C.duration(real_time) >= 0, C.duration(real_time)).cast("double"))


def graph_coverage(ends: DataFrame) -> DataFrame:
    """Coverage of a recording: ends (game_id, first_tick, last_tick, first_seconds, last_seconds)."""
    late = F.col("first_tick") > 0
    return ends.select("game_id", "first_tick", "last_tick", "first_seconds", "last_seconds", late.alias("starts_after_game_start"), late.alias("incomplete_before_first_tick"))


def graph_players(players: DataFrame, host_slots: DataFrame, most: int = MOST_GRAPH_PLAYERS) -> DataFrame:
    """Baseline counters of the first tick's players: the first of a slot wins, 16 at most, host machine players left out."""
    base = [C.nonnegative(F.col(c)).alias(c) for c in ("kills", "deaths", "assists")]
    p = slots(players.where("moment = 'first'")).where("slot >= 0 and not coalesce(lower(trim(is_hostman)) in ('1','true','yes','on','y','t'), false)")
    p = p.join(host_slots, ["game_id", "slot"], "left_anti").select("game_id", "slot", "pos", *base).where("coalesce(kills, deaths, assists) is not null")
    w = Window.partitionBy("game_id", "slot").orderBy("pos")
    p = p.withColumn("_r", F.row_number().over(w)).where("_r = 1").withColumn("_k", F.row_number().over(Window.partitionBy("game_id").orderBy("pos")))
    return p.where(F.col("_k") <= most).drop("_r", "_k", "pos")


def games(ends: DataFrame, wins: DataFrame) -> DataFrame:
    """One row a game from its summary and both end ticks (text columns prefixed first_ and last_, is_full_game, game_ended, settings_mode, settings_name)."""
    pick = lambda c: F.coalesce(C.text(F.col(f"last_{c}")), C.text(F.col(f"first_{c}")))
    name = pick("map_name")
    done = F.coalesce(F.col("is_full_game"), F.lit(True)) | F.coalesce(F.col("game_ended"), F.lit(False))
    return ends.join(wins, "game_id", "left").select(
        "game_id", name.alias("map_engine_name"), C.short_name(name).alias("map_short_name"),
        F.coalesce(known_mode(F.col("settings_mode")), authoritative(pick("game_type"))).alias("game_type"),
        F.coalesce(authoritative(F.col("settings_name")), authoritative(pick("variant"))).alias("variant_name"),
        F.when(done, "completed").otherwise("imported").alias("status"),
        C.timestamp_text(F.coalesce(C.text(F.col("recording_started")), C.text(F.col("first_start_time")))).alias("started_at"),
        C.timestamp_text(F.coalesce(C.text(F.col("recording_ended")), C.text(F.col("last_current_time")))).alias("ended_at"),
        C.duration(F.col("duration")).alias("duration_seconds"), "winning_team",
    )


def release(ends: DataFrame) -> DataFrame:
    """(game_id and the release evidence of the map: release key, cache and build), unknown or unsafe texts left out."""
    safe = [authoritative(F.col(c)).alias(c) for c in ("cache_family", "cache_version_name", "build_version")]
    return ends.select("game_id", release_key(F.col("game_release_key")).alias("game_release_key"), C.truncated(F.col("cache_version")).alias("cache_version"), *safe)


def streaks(players: DataFrame, meta: DataFrame) -> DataFrame:
    """The rows of participants with max_kill_streak and multikills alone: made before the shuffle, and no first tick is joined."""
    m = meta.select("game_id", "slot", max_streak(F.col("streak_by_tick"), F.col("streak_counts_by_amount")).alias("max_kill_streak"), multikills(F.col("multikill_counts_by_amount"), F.col("multikills_by_tick")).alias("multikills"))
    return slots(players.where("moment = 'last'")).select("game_id", "slot").join(m.hint("merge"), ["game_id", "slot"], "left")


def participant_facts(rows: DataFrame, contexts: DataFrame) -> DataFrame:
    """(game_id, slot, key, value): what is known of a participant's context and streaks, as texts."""
    j = rows.select("game_id", "slot", "max_kill_streak", F.col("multikills.double").alias("double_kills"), F.col("multikills.triple").alias("triple_kills"), F.col("multikills.more").alias("multikills_4_plus")).join(contexts, ["game_id", "slot"], "left")
    names = ["is_host", "is_hostman", "machine_index", "controller_index", "screen_slot", "screen_layout", "max_kill_streak", "double_kills", "triple_kills", "multikills_4_plus"]
    pairs = F.array(*[F.struct(F.lit(f"participant.{n}").alias("key"), F.col(n).cast("string").alias("value")) for n in names])
    return j.select("game_id", "slot", F.inline(pairs)).where("value is not null")


def documents(game_rows: DataFrame, people: DataFrame, teams: DataFrame, facts: DataFrame) -> DataFrame:
    """(game_id, document): one JSON result a game with its participants and teams in order and its facts by key."""
    p = people.groupBy("game_id").agg(F.sort_array(F.collect_list(F.struct("slot", *[c for c in people.columns if c not in ("game_id", "slot")]))).alias("participants"))
    t = teams.groupBy("game_id").agg(F.sort_array(F.collect_list(F.struct("team", *[c for c in teams.columns if c not in ("game_id", "team")]))).alias("teams"))
    f = facts.groupBy("game_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("key", "value")))).alias("facts"))
    j = game_rows.join(p, "game_id", "left").join(t, "game_id", "left").join(f, "game_id", "left")
    return j.select("game_id", F.to_json(F.struct(*[c for c in j.columns if c != "game_id"])).alias("document"))
