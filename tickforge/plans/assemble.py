"""From scanned replays to every table that the engine makes of them."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.functions import sanitise as S
from tickforge.operators import occupancy as O
from tickforge.operators import replay as R
from tickforge.sources import replays as D

_CONTEXT = ("ends", "network", "explicit")


class Tables:
    """The tables of replay documents (D.read_replays); each is planned when it is first asked for.

    Slots of host machine players are excluded after the caps, so they use them up; the excluded samples count as
    `hostman`.  Files with an error make no row but in dead_letters.

    The typed projections that several tables start from (players, contexts, samples, voxels) go through `hold`, so the
    documents are parsed once for each of those and not for each table.  The default caches them; for large inputs give
    a function that writes a table and reads it back.

    With `only`, the name of a table in NEEDS, just that table is to be asked for: the documents are parsed once, what it
    needs of them is held, and of what follows only samples and capped cells are.
    """

    NAMES = ("games", "participants", "contexts", "team_stats", "game_facts", "participant_facts", "graph_coverage", "graph_players", "spawn_points", "voxels", "discards", "coverage", "event_counts", "documents", "dead_letters")

    #: What a table needs of each document, where it can start from a held scan.
    NEEDS = {"contexts": _CONTEXT, "graph_players": _CONTEXT, "discards": (*_CONTEXT, "samples"), "participant_facts": (*_CONTEXT, "meta"), "voxels": (*_CONTEXT, "samples")}

    def __init__(self, docs: DataFrame, cell_size: float = 0.5, slot_cells: int = O.SLOT_CELLS, game_cells: int = O.GAME_CELLS, hold: Callable[[DataFrame], DataFrame] = DataFrame.persist, only: str | None = None):
        self.docs, self.cell_size, self.caps, self.held = docs, cell_size, (slot_cells, game_cells), hold
        self.only, self.hold = only, hold if only is None else lambda df: df

    @cached_property
    def good(self) -> DataFrame:
        if self.only is None:
            return D.game_key(self.docs.where("error is null"))
        return self.held(D.scanned(D.game_key(self.docs), self.NEEDS[self.only])).where("error is null")

    @cached_property
    def players(self) -> DataFrame:
        return self.hold(D.end_players(self.good))

    @cached_property
    def ends(self) -> DataFrame:
        return self.hold(D.game_ends(self.good))

    @cached_property
    def contexts(self) -> DataFrame:
        return self.hold(R.merge_contexts(R.network_contexts(D.network_players(self.good)), R.tick_contexts(self.players, D.machines(self.good)), R.explicit_contexts(D.explicit_players(self.good))))

    @cached_property
    def hosts(self) -> DataFrame:
        return R.hosts(self.contexts)

    @cached_property
    def participants(self) -> DataFrame:
        return self.hold(R.participants(self.players, D.meta_players(self.good)))

    @cached_property
    def team_stats(self) -> DataFrame:
        return self.hold(R.team_stats(self.participants))

    @cached_property
    def games(self) -> DataFrame:
        style = R.host_style(self.participants.select("game_id", "slot").join(self.contexts, ["game_id", "slot"], "left"))
        return self.hold(R.games(self.ends, R.winners(self.team_stats)).join(R.release(self.ends), "game_id").join(style, "game_id", "left"))

    @cached_property
    def classified(self) -> DataFrame:
        ticks = self.good if self.only is None else self.good.select("game_id", F.col("all_ticks").alias("ticks"))
        return O.classify(self.held(D.player_samples(ticks)))

    @cached_property
    def capped(self) -> DataFrame:
        return self.held(O.capped(O.voxels(self.classified, self.cell_size), *self.caps))

    @cached_property
    def excluded(self) -> tuple[DataFrame, DataFrame]:
        return O.exclude_slots(self.capped.where("cap is null").drop("cap"), self.hosts)

    @cached_property
    def voxels(self) -> DataFrame:
        return O.saturated(self.excluded[0]).drop("first")

    @cached_property
    def discards(self) -> DataFrame:
        return O.discards(self.classified, self.capped, self.excluded[1])

    @cached_property
    def coverage(self) -> DataFrame:
        return O.coverage(self.voxels, self.classified)

    @cached_property
    def game_facts(self) -> DataFrame:
        return self.hold(S.facts(S.flatten(self.good, "gametype_settings")))

    @cached_property
    def participant_facts(self) -> DataFrame:
        rows = self.participants if self.only is None else R.streaks(self.players, D.meta_players(self.good))
        return R.participant_facts(rows, self.contexts)

    @cached_property
    def graph_coverage(self) -> DataFrame:
        return R.graph_coverage(self.ends)

    @cached_property
    def graph_players(self) -> DataFrame:
        return R.graph_players(self.players, self.hosts)

    @cached_property
    def spawn_points(self) -> DataFrame:
        return S.spawn_points(D.spawns(self.good), "spawns")

    @cached_property
    def event_counts(self) -> DataFrame:
        return D.event_counts(self.good)

    @cached_property
    def documents(self) -> DataFrame:
        return R.documents(self.games, self.participants, self.team_stats, self.game_facts)

    @cached_property
    def dead_letters(self) -> DataFrame:
        return self.docs.where("error is not null").select("file", "error")


def tables(docs: DataFrame, cell_size: float = 0.5, slot_cells: int = O.SLOT_CELLS, game_cells: int = O.GAME_CELLS, hold: Callable[[DataFrame], DataFrame] = DataFrame.persist) -> dict[str, DataFrame]:
    """All Tables of replay documents by name."""
    made = Tables(docs, cell_size, slot_cells, game_cells, hold)
    return {name: getattr(made, name) for name in Tables.NAMES}
