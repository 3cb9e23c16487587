import numpy as np
import pytest

from tickforge.llm import covertree
from tickforge.llm.covertree import CoverTree, linked, near_duplicates, summarise

SCHEMA = "vec_id long, embedding array<double>, label int, n int, kept string"


def vectors(seed, n=300, d=16):
    r = np.random.default_rng(seed)
    base = r.normal(size=(n // 6, d))
    return [base[r.integers(len(base))] * r.uniform(0.5, 9) + r.normal(size=d) * r.choice([0.0, 0.02, 0.08, 0.2, 0.6]) for _ in range(n)]


def brute(rows, cosine=0.98):
    n, root = {}, {i: i for i, *_ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, x, la, *_ in rows:
        n[a] = 0
        for b, y, lb, *_ in rows:
            if a != b and la is not None and la == lb and len(x) == len(y):
                u, v = np.array(x), np.array(y)
                if u @ v / (np.linalg.norm(u) * np.linalg.norm(v)) >= cosine:
                    n[a] += 1
                    p, q = find(a), find(b)
                    root[max(p, q)] = min(p, q)
    return {i: (n[i], find(i), find(i) == i) for i in root}


@pytest.mark.parametrize(("block", "seed"), [(2048, 1), (40, 2)])
def test_against_brute_force(spark, block, seed, monkeypatch):
    monkeypatch.setattr(covertree, "BLOCK", block)
    rows = [(1000 - i, [float(c) for c in x], [1, 2, None][i % 5 // 2], 7, "x") for i, x in enumerate(vectors(seed))]
    odd = [(2000, None, 1), (2001, [], 1), (2002, [0.0] * 16, 1), (2003, [1.0] * 15 + [None], 1), (2004, [1.0] * 15 + [float("nan")], 1), (2005, [float("inf")] * 16, 1)]
    got = near_duplicates(spark.createDataFrame([*rows, *[(i, e, lab, 7, "x") for i, e, lab in odd], rows[3]], SCHEMA)).collect()
    assert len(got) == len(rows) + len(odd) + 1
    by = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got}
    want = brute(rows) | {i: (0, i, True) for i, *_ in odd}
    assert by == want


def test_hot_cluster_makes_no_row_for_a_link():
    r = np.random.default_rng(3)
    x = np.ones(32) / np.sqrt(32) + r.normal(size=(700, 32)) * 1e-4
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    t = CoverTree(x, 0.05)
    assert len(t.centre) == 1
    ids, n, low = summarise(linked(t, t, 0.98), np.arange(700)[t.order], np.arange(700)[t.order], True)
    assert len(ids) == 700 and set(n) == {699} and set(low) == {0}


def test_tree_covers_and_separates():
    x = np.array(vectors(5))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    t = CoverTree(x, 0.05)
    assert sorted(t.order) == list(range(len(x)))
    for i in range(len(t.centre)):
        own = t.x[t.start[i] : t.end[i]]
        assert np.all(np.linalg.norm(own - t.centres[i], axis=1) <= t.radius[i] + 1e-7)
        kids = t.children[i]
        assert not kids or [t.start[k] for k in kids][1:] == [t.end[k] for k in kids][:-1]


def test_empty(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    assert near_duplicates(spark.createDataFrame([(1, [1.0], None, 1, "")], SCHEMA)).first()[:4] == (1, 0, 1, True)
