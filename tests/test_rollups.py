import copy

import pytest

from tickforge.operators import heatmap as H
from tickforge.operators import regions as R

OCC = "game_id long, slot int, cx long, cy long, cz long, ticks long"
PART = "scope_id string, game_id long, participant_id string, slot int, team int"
GAMES = "scope_id string, game_id long, has_artifact boolean, ticks_per_second double, cell_size double, status string, discarded_samples long"


def uid(n):
    return f"00000000-0000-4000-8000-{n:012d}"


def box(a, b):
    return {"type": "axis_aligned_box", "coordinate_space": R.SPACE, "boundary": "min_inclusive_max_exclusive", "snap_size": 0.5, "min": {"x": a, "y": -10, "z": -10}, "max": {"x": b, "y": 10, "z": 10}}


def document(*regions, collections=()):
    own = [{"id": uid(k + 1), "key": f"r{k + 1}", "geometries": [box(*b) for b in boxes]} for k, boxes in enumerate(regions)]
    cs = [{"id": uid(50 + k), "key": f"c{k}", "analysis_mode": mode, "region_ids": [uid(i) for i in ids]} for k, (mode, ids) in enumerate(collections)]
    return {"revision": 3, "hash": "a" * 64, "coordinate_space": R.SPACE, "sets": [{"id": uid(99), "key": "main", "display_name": "Main", "version": 1, "regions": own, "collections": cs}]}


def run(spark, conf, cells, participants, size=0.5, games=None):
    g = spark.createDataFrame(games or [("s", 1, True, 30.0, size, "available", 2)], GAMES)
    p = spark.createDataFrame(participants, PART)
    occ = spark.createDataFrame(cells, OCC)
    m = R.match(R.assign(g, p, occ), conf)
    return m, g, p


def test_heatmap_projection(spark):
    occ = spark.createDataFrame([(1, 0, -1, 2, 9, 3, 0.5), (1, 1, 4, -2, 1, 5, 0.5), (1, 9, 0, 0, 0, 7, 0.5)], OCC + ", cell_size double")
    p = spark.createDataFrame([("s", 1, "a", 0, 0), ("s", 1, "b", 1, None)], PART)
    e = spark.createDataFrame([("s", 1, "a", 0, "killer_position", -0.1, 0.1), ("s", 1, "a", 0, "victim_position", 1.0, -1.0)], "scope_id string, game_id long, participant_id string, team int, event_type string, x double, y double")
    heat = H.rows(p, occ, e)
    got = {(r.metric, r.team_key, r.px, r.py): r.value for r in H.cells(heat).collect()}
    assert got == {("occupancy", "team:0", -1, -3): 3, ("occupancy", "team:none", 4, 1): 5, ("killer_position", "team:0", -1, -1): 1, ("victim_position", "team:0", 2, 2): 1}
    s = {r.metric: (r.games_selected, r.games_contributing, r.participants_selected, r.participants_contributing) for r in H.summary(heat, p, spark.createDataFrame([("s", 1), ("s", 2)], "scope_id string, game_id long")).collect()}
    assert s == {"occupancy": (2, 1, 2, 2), "killer_position": (2, 1, 2, 1), "victim_position": (2, 1, 2, 1)}
    assert H.faults(H.cells(heat)).count() == 0


def test_coarse_voxels_go_to_one_plane_cell(spark):
    occ = spark.createDataFrame([(1, 0, -1, -1, 0, 3, 1.0), (1, 0, 0, 0, 0, 4, 1.0)], OCC + ", cell_size double")
    p = spark.createDataFrame([("s", 1, "a", 0, 0)], PART)
    e = spark.createDataFrame([], "scope_id string, game_id long, participant_id string, team int, event_type string, x double, y double")
    assert {(r.px, r.py): r.value for r in H.cells(H.rows(p, occ, e)).collect()} == {(-1, 1): 3, (1, -1): 4}


def test_region_totals_and_collections(spark):
    conf = R.parse_configuration(document([(-2, 0)], [(0, 2)], [(-0.5, 0.5)], collections=[("partition", [1, 2]), ("overlay", [1, 2, 3])]), 3, "a" * 64)
    cells = [(1, 0, -1, 0, 0, 45, ), (1, 1, 0, 0, 0, 15), (1, 1, 2, 0, 0, 40), (1, 1, 9, 0, 0, 5), (1, 9, 0, 0, 0, 7)]
    m, g, p = run(spark, conf, cells, [("s", 1, "a", 0, 0), ("s", 1, "b", 1, 1)])
    groups = R.grouped(m, g)
    t = {(r.group_key, r.region_id): r.ticks for r in R.region_totals(groups, conf).collect()}
    assert [t["all", uid(k)] for k in (1, 2, 3)] == [45, 55, 60] and t["team:0", uid(2)] == 0 and t["team:1", uid(2)] == 55
    c = {(r.group_key, r.mode): (r.member_ticks, r.union_ticks, r.outside_ticks, r.overlap_ticks) for r in R.collection_totals(groups, conf).collect()}
    assert c["all", "partition"] == (100, 100, 5, 0) and c["all", "overlay"] == (160, 100, 5, 60)
    s = R.coverage(g, p, m).first()
    assert (s.observed_ticks, s.discarded_ticks, s.discarded_samples, s.membership_checks, s.source_cells) == (105, 7, 2, 12, 4)
    assert not s.coverage_complete and s.membership_precision == "grid_exact"


def test_boxes_of_one_region_count_once(spark):
    conf = R.parse_configuration(document([(-2, 1), (-1, 2)], [(-0.5, 0.5)], collections=[("overlay", [1, 2])]))
    m, g, _ = run(spark, conf, [(1, 0, -1, 0, 0, 30), (1, 0, 2, 0, 0, 15)], [("s", 1, "a", 0, None)])
    t = {r.region_id: r.ticks for r in R.region_totals(R.grouped(m, g), conf).collect() if r.group_key == "all"}
    assert t == {uid(1): 45, uid(2): 30}
    c = R.collection_totals(R.grouped(m, g), conf).where("group_key = 'all'").first()
    assert (c.member_ticks, c.union_ticks, c.overlap_ticks) == (75, 45, 30)


def test_upper_bound_is_outside(spark):
    conf = R.parse_configuration(document([(-1, 0)], [(0, 1)]))
    m, g, _ = run(spark, conf, [(1, 0, -1, 0, 0, 3), (1, 0, 0, 0, 0, 4)], [("s", 1, "a", 0, 0)])
    assert {r.region_id: r.ticks for r in R.region_totals(R.grouped(m, g), conf).collect() if r.group_key == "all"} == {uid(1): 3, uid(2): 4}


def test_coarse_cells_count_by_centre(spark):
    conf = R.parse_configuration(document([(-1, 0)], [(0, 1)]))
    m, g, p = run(spark, conf, [(1, 0, -1, 0, 0, 3), (1, 0, 0, 0, 0, 4)], [("s", 1, "a", 0, 0)], size=1.0)
    assert {r.region_id: r.ticks for r in R.region_totals(R.grouped(m, g), conf).collect() if r.group_key == "all"} == {uid(1): 3, uid(2): 4}
    assert R.coverage(g, p, m).first().membership_precision == "voxel_center"


def test_missing_and_incompatible_games(spark):
    conf = R.parse_configuration(document([(-1, 0)]))
    games = [("s", 1, False, None, None, None, None), ("s", 2, True, 30.0, 0.5, "unavailable", 9)]
    m, g, p = run(spark, conf, [(2, 0, 0, 0, 0, 4)], [("s", k, f"p{k}{s}", s, 0) for k in (1, 2) for s in (0, 1)], games=games)
    s = R.coverage(g, p, m).first()
    assert (s.games_selected, s.games_contributing, s.games_missing_data, s.incompatible_games, s.participants_selected, s.discarded_samples) == (2, 0, 2, 1, 4, 0)


def test_a_scope_without_ticks_has_its_group_of_all(spark):
    conf = R.parse_configuration(document([(-1, 0)], [(0, 1)], collections=[("overlay", [1, 2])]))
    m, g, _ = run(spark, conf, [], [("s", 1, "a", 0, 0)])
    groups = R.grouped(m, g)
    assert [(r.group_key, r.observed) for r in R.group_totals(groups).collect()] == [("all", 0)]
    assert sorted((r.region_id, r.ticks, r.share_of_group, r.share_of_region) for r in R.region_totals(groups, conf).collect()) == [(uid(1), 0, None, None), (uid(2), 0, None, None)]
    assert [(r.member_ticks, r.outside_ticks, r.outside_share) for r in R.collection_totals(groups, conf).collect()] == [(0, 0, None)]


def test_any_cell_size(spark):
    """Cells of 1.5 and 2.5 whose centres lie in the box, against the bounds of Box.cells."""
    conf = R.parse_configuration(document([(-4, 3.5)], [(3.5, 9)]))
    for size in (1.5, 2.5):
        m, *_ = run(spark, conf, [(1, 0, x, 0, 0, 1) for x in range(-4, 8)], [("s", 1, "a", 0, 0)], size=size)
        for r in m.collect():
            want = [q.id for q in conf.regions for b in q.boxes if b.cells(size)[0] <= r.cx < b.cells(size)[1]]
            assert r.matched == want and r.checks == 2, (size, r.cx)


def test_group_limits(spark):
    conf = R.parse_configuration(document([(-1, 0)]))
    m, g, _ = run(spark, conf, [(1, k, -1, 0, 0, 1 << 52) for k in range(3)], [("s", 1, f"p{k}", k, k) for k in range(3)])
    groups = R.grouped(m, g)
    assert {r.code for r in R.group_faults(groups).collect()} == {"rollup_counter_overflow"}
    assert {r.code for r in R.group_faults(groups, 3).collect()} == {"rollup_counter_overflow", "rollup_group_limit_exceeded"}


def test_work_limit(spark):
    conf = R.parse_configuration(document([(-1, 0), (1, 2), (3, 4)]))
    m, *_ = run(spark, conf, [(1, 0, -1, 0, 0, 3)], [("s", 1, "a", 0, 0)])
    assert R.over_budget(m, conf, 2).first().code == "region_membership_limit_exceeded" and R.over_budget(m, conf, 3).count() == 0


def change(path, value):
    doc = copy.deepcopy(document([(-1, 0)], [(0, 1)], collections=[("partition", [1, 2])]))
    at = doc
    for k in path[:-1]:
        at = at[k]
    if value is KeyError:
        del at[path[-1]]
    else:
        at[path[-1]] = value
    return doc


S, G = ("sets", 0), ("sets", 0, "regions", 0, "geometries", 0)


@pytest.mark.parametrize(
    ("path", "value"),
    [(("revision",), 0), (("revision",), True), (("hash",), "x"), (("coordinate_space",), "other"), (("sets",), []), ((*S, "id"), "no"), ((*S, "key"), "Bad Key"), ((*S, "display_name"), ""), ((*S, "version"), 1.5), ((*S, "is_default"), 1), ((*S, "regions", 1, "id"), uid(1)), ((*S, "regions", 1, "key"), "r1"), ((*S, "regions", 0, "display_color"), "red"), ((*S, "regions", 0, "geometries"), []), ((*S, "regions", 0, "geometries"), [box(0, 1), box(0, 1)]), ((*G, "type"), "sphere"), ((*G, "snap_size"), 1), ((*G, "min", "x"), 0.25), ((*G, "min", "x"), 5), ((*G, "max", "x"), 2e6), ((*G, "max"), KeyError), ((*G, "min", "y"), float("nan")), ((*S, "collections", 0, "analysis_mode"), "mix"), ((*S, "collections", 0, "region_ids"), [uid(1), uid(1)]), ((*S, "collections", 0, "region_ids"), [uid(7)])],
)
def test_bad_configurations(path, value):
    with pytest.raises(R.RegionError) as e:
        R.parse_configuration(change(path, value))
    assert e.value.code == "invalid_region_configuration"


def test_configuration_limits_and_single_geometry():
    many = document(*[[(k, k + 0.5) for k in range(16)]] * 26)
    with pytest.raises(R.RegionError) as e:
        R.parse_configuration(many)
    assert e.value.code == "region_configuration_limit_exceeded"
    one = change((*S, "regions", 0, "geometry"), box(0, 1))
    del one["sets"][0]["regions"][0]["geometries"]
    assert len(R.parse_configuration(one).regions[0].boxes) == 1
    with pytest.raises(R.RegionError):
        R.parse_configuration(one, revision=9)
