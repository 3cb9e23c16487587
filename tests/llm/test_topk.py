import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickforge.llm import topk
from tickforge.llm.topk import top_k

SCHEMA = "vec_id long, embedding array<float>, score int, rank int"


def brute(rows, is_query, k=10):
    ok = [(i, [math.floor(1024 * float(np.float32(x))) for x in e]) for i, e, *_ in rows if i is not None and e and all(x is not None and math.isfinite(x) for x in e)]
    out = set()
    for q, x in {(i, tuple(x)) for i, x in ok if is_query(i)}:
        c = sorted(((-sum(a * b for a, b in zip(x, y, strict=True)), j) for j, y in ok if j != q and len(y) == len(x)))[:k]
        out |= {(q, r + 1, j, -s) for r, (s, j) in enumerate(c)}
    return out


@pytest.mark.parametrize("blocks", [(4096, 1024, 64 << 20), (50, 3, 0)])
def test_against_brute_force(spark, blocks, monkeypatch):
    for name, n in zip(("CANDIDATES", "QUERIES", "MOST_BROADCAST"), blocks, strict=True):
        monkeypatch.setattr(topk, name, n)
    r = np.random.default_rng(1)
    rows = [(i, [float(x) for x in np.float32(r.normal(size=20) * (5 if i % 7 else 0.1))], 1, 2) for i in range(400)]
    rows += [(i + 1000, rows[i][1], 1, 2) for i in range(0, 400, 3)]
    rows += [(5000, None, 1, 2), (5100, [], 1, 2), (5200, [1.0] * 19 + [None], 1, 2), (5300, [1.0] * 19 + [float("nan")], 1, 2), (5400, [float("inf")] * 20, 1, 2), (None, [1.0] * 20, 1, 2), (5500, [0.5] * 3, 1, 2), (5501, [0.25] * 3, 1, 2), rows[7]]
    df = spark.createDataFrame(rows, SCHEMA)
    got = top_k(df, F.col("vec_id") % 100 == 0)
    found = [(x.query_id, x["rank"], x.vec_id, x["score"]) for x in got.collect()]
    assert len(found) == len(set(found)) and set(found) == brute(rows, lambda i: i % 100 == 0)


def test_large_components_stay_exact(spark):
    rows = [(i, [float((i * 7919) % 1000) * 1e9 + i, 3.0 * i], 1, 2) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int, rank int")
    want = {(0, 1, 1), (0, 2, 2)}
    ints = {i: [math.floor(1024 * x) for x in e] for i, e, *_ in rows}
    got = top_k(df, F.col("vec_id") == 7, 3).collect()
    best = sorted((-max(-(1 << 63), min((1 << 63) - 1, sum(a * b for a, b in zip(ints[7], ints[j], strict=True)))), j) for j in ints if j != 7)[:3]
    assert want and {x["score"] for x in got} == {-s for s, _ in best}


def test_empty(spark):
    assert top_k(spark.createDataFrame([], SCHEMA), F.lit(True)).count() == 0
    assert top_k(spark.createDataFrame([(1, [1.0], 1, 1)], SCHEMA), F.lit(True)).count() == 0
    assert top_k(spark.createDataFrame([(1, [1.0], 1, 1), (2, [2.0], 1, 1)], SCHEMA), F.lit(False)).count() == 0
