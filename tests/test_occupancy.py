import random

from pyspark.sql import functions as F

from tickforge.operators import occupancy as O

SCHEMA = "game_id long, tick long, pos long, slot int, hostman boolean, has_object boolean, x double, y double, z double"


def rows(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def cells_of(df):
    return {(r.slot, r.cx, r.cy, r.cz): r.ticks for r in df.collect()}


def test_bins_are_floors_and_gaps_stay_gaps(spark):
    data = [(1, 0, 0, 0, False, True, -0.1, -1.0, 1.49), (1, 1, 0, 0, False, True, -0.1, -1.0, 1.49), (1, 3, 0, 0, False, True, 1.0, 1.0, 1.0), (1, 3, 1, 1, False, True, 2.0, 3.0, 4.0)]
    c = O.classify(rows(spark, data))
    cells = O.voxels(c)
    assert cells_of(cells) == {(0, -1, -2, 2): 2, (0, 2, 2, 2): 1, (1, 4, 6, 8): 1}
    own = O.coverage(cells, c).first()
    assert (own.observations, own.cells, own.slots, own.status) == (4, 3, [0, 1], "available")


def test_reasons_and_exclusion(spark):
    nan, far = float("nan"), 1_000_001.0
    data = [(1, 0, 0, 0, False, True, 1.0, 1.0, 1.0), (1, 0, 1, 1, True, True, 1.0, 1.0, 1.0), (1, 0, 2, 2, False, False, None, None, None), (1, 0, 3, 3, False, True, 1.0, 1.0, None), (1, 0, 4, 4, False, True, nan, 1.0, 1.0), (1, 0, 5, 5, False, True, far, 1.0, 1.0), (1, 0, 6, 999, False, True, 1.0, 1.0, 1.0), (1, 0, 7, 7, False, True, far, nan, 1.0)]
    c = O.classify(rows(spark, data))
    kept, gone = O.exclude_slots(O.voxels(c), spark.createDataFrame([(1, 0)], "game_id long, slot int"))
    assert kept.count() == 0
    assert {r.reason: r.n for r in O.discards(c, None, gone).collect()} == {"hostman": 2, "missing_player_object": 1, "missing_coordinate": 1, "non_finite": 2, "out_of_bounds": 1, "invalid_slot": 1}
    assert O.coverage(kept, c).first().status == "unavailable"


def test_present_but_null_is_not_finite(spark):
    one = rows(spark, [(1, 0, 0, 0, False, True, None, 1.0, 1.0)])
    assert O.classify(one.withColumn("missing", F.lit(False))).first().reason == "non_finite"
    assert O.classify(one).first().reason == "missing_coordinate"


def simulate(samples, slot_cells, game_cells):
    """The rule as a loop over samples in order: cells are taken until a limit is met, then only known ones count."""
    cells, reasons = {}, {}
    for _, _, slot, key in samples:
        k = (slot, *key)
        if k in cells:
            cells[k] += 1
        elif sum(c[0] == slot for c in cells) >= slot_cells:
            reasons["slot_cell_limit"] = reasons.get("slot_cell_limit", 0) + 1
        elif len(cells) >= game_cells:
            reasons["global_cell_limit"] = reasons.get("global_cell_limit", 0) + 1
        else:
            cells[k] = 1
    return cells, reasons


def test_caps_equal_a_sequential_run(spark):
    r = random.Random(3)
    data, want = [], {}
    for game in range(40):
        own = [(t, p, p % 3, (r.randint(0, 4), r.randint(0, 1), 0)) for t in range(r.randint(1, 12)) for p in range(3)]
        data += [(game, t, p, s, False, True, k[0] + 0.1, k[1] + 0.1, 0.1) for t, p, s, k in own]
        want[game] = simulate(own, 2, 4)
    c = O.classify(rows(spark, data))
    capped = O.capped(O.voxels(c, 1.0), 2, 4).collect()
    lost = O.discards(c, O.capped(O.voxels(c, 1.0), 2, 4)).collect()
    for game, (cells, reasons) in want.items():
        assert {(x.slot, x.cx, x.cy, x.cz): x.ticks for x in capped if x.game_id == game and x.cap is None} == cells
        assert {x.reason: x.n for x in lost if x.game_id == game} == reasons


def test_counters_stop_at_their_limit(spark):
    big = spark.createDataFrame([(1, 0, 0, 0, 0, 3_000_000_000)], "game_id long, slot int, cx long, cy long, cz long, ticks long")
    assert O.saturated(big).first().ticks == 2_147_483_647
