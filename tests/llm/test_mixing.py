import re
from collections import defaultdict
from itertools import product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickforge.llm import mixing
from tickforge.llm.mixing import copies, mix, route, targets

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def reshare(sizes, weights=(5, 2, 1), most=3):
    """The rule as stated: share, stop at the limit, share the excess again until none is above."""
    names = sorted(s for s in sizes if s is not None) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, free, left = {}, set(names), sum(sizes.values())
    while free:
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            return out | share
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
            free.remove(s)
    return out


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.one_of(st.none(), st.text("abé", max_size=2)), st.integers(0, 10_000), min_size=1, max_size=7))
def test_targets(sizes):
    want = reshare(sizes)
    got = targets(sizes)
    assert all(got[s] == pytest.approx(want[s], abs=1e-6) for s in sizes)
    assert sum(got.values()) == pytest.approx(sum(sizes.values()), abs=1e-5)


def cost_of(capacity, given_, most):
    """Least cost of giving given_[p] tokens of each pattern."""
    return sum(max(0, n - k * capacity[p]) if k else 0 for p, n in given_.items() for k in range(1, most))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=3, max_size=3), st.lists(st.integers(0, 6), min_size=2, max_size=2))
def test_route_against_every_flow(caps, quotas):
    patterns = [frozenset("a"), frozenset("b"), frozenset("ab")]
    capacity, quota = dict(zip(patterns, caps, strict=True)), dict(zip("ab", quotas, strict=True))
    best = None
    for xa, xb, ya, yb in product(*[range(quota[s] + 1) for s in "abab"]):
        given_ = {patterns[0]: xa, patterns[1]: xb, patterns[2]: ya + yb}
        if xa + ya <= quota["a"] and xb + yb <= quota["b"] and all(n <= 3 * capacity[p] for p, n in given_.items()):
            key = (-(xa + xb + ya + yb), cost_of(capacity, given_, 3))
            best = key if best is None or key < best else best
    flow = route(capacity, quota, (0, 1, 2))
    got = defaultdict(int)
    for (p, s), n in flow.items():
        assert s in p and n > 0
        got[p] += n
    assert all(n <= 3 * capacity[p] for p, n in got.items())
    assert (-sum(flow.values()), cost_of(capacity, got, 3)) == best


def test_rows(spark):
    rows = [(i, "w " * (i % 7 + 1), ["a", "b", None, "é"][i % 4 if i % 3 else 0], 1) for i in range(200)]
    rows += [(500, None, "a", 1), (501, "", "b", 1), (502, " \t", None, 1), (None, "x y", "b", 1), (503, "z " * 300, "c", 1), (7, rows[7][1], rows[7][2], 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    got = mix(df).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, mix(df.repartition(3)).collect()))
    assert len(got) == len(rows)
    held, taken, target = defaultdict(int), defaultdict(int), {}
    for r in got:
        assert r["size"] == len(WORD.findall(r.text or "")) and 0 <= r.taken <= 3 * r["size"]
        held[r.source] += r["size"]
        taken[r.source] += r.taken
        target[r.source] = r.target
    want = targets(held)
    for r in got:
        assert r.source_size == held[r.source]
    for s in held:
        assert target[s] == want[s] and abs(taken[s] - want[s]) <= 1


def test_overlapping_sources(spark):
    rows = [(i, "w " * 10, [["a"], ["b"], ["a", "b"], None, []][i % 5]) for i in range(100)]
    got = mix(spark.createDataFrame(rows, "doc_id long, text string, source array<string>"), weights=(3, 1)).collect()
    total = sum(r["size"] for r in got)
    assert abs(sum(r.taken for r in got) - total) <= 2
    lone = {r.target for r in got if not r.source}
    assert len(lone) == 1


def test_copies_follow_taken(spark):
    rows = [(i, "w " * 10, "ab"[i % 10 == 0]) for i in range(200)]
    mixed = mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), weights=(1, 4))
    out = copies(mixed, ["doc_id", "text", "source"])
    assert out.columns == ["doc_id", "text", "source"]
    n = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert all(abs(n.get(r.doc_id, 0) - r.taken / 10) <= 0.5 for r in mixed.collect())


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mix(df).count() == 0
    assert mix(spark.createDataFrame([(1, None, "a")], df.schema)).select("taken", "target").first() == (0, 0.0)
    assert mix(df.withColumn("target", F.lit(1))).columns.count("target") == 1


def test_rows_with_one_source_go_through_the_flow(spark, monkeypatch):
    ran, keep = [], mixing._ssp
    monkeypatch.setattr(mixing, "_ssp", lambda *a: ran.append(a[1]) or keep(*a))
    mix(spark.createDataFrame([(1, "a b", "x"), (2, "c", "y")], "doc_id long, text string, source string")).collect()
    assert sorted(ran) == [["x"], ["y"]]
