import random
import zlib
from math import exp

import numpy as np
import pyarrow as pa

from tickforge.llm.bytesops import utf8
from tickforge.llm.quality import FILTERS, HALF, HIDDEN, LAGS, ByteCnn, classify, windows


def text(good, rng):
    words = ["".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(40, 400))]
    if not good:
        kind, at = rng.randrange(3), rng.randrange(len(words) // 2)
        bad = [w.upper() + "!!" for w in words[at:]] if kind == 0 else [words[at]] * (len(words) - at) if kind == 1 else [w + "$$$" for w in words[at:]]
        words = words[:at] + bad
    return " ".join(words)


def test_held_out_accuracy(spark):
    rng = random.Random(4)
    y = [int(rng.random() < 0.8) for _ in range(1500)]
    rows = [(i, text(y[i], rng), "x") for i in range(1500)] + [(2000, None, "x"), (2001, "", "x"), (2002, "a", "x"), (None, "word", "x"), (2003, text(1, rng) * 100, "x")]
    rows.append(rows[3])
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, y[i], 9) for i in range(1500)] + [(1, None, 9), (None, 1, 9), (5000, 0, 9)], "doc_id long, quality int, text int")
    got = classify(docs, labels, each=250).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    held = [(r.predicted, y[r.doc_id]) for r in got if r.doc_id is not None and r.doc_id < 1500 and r.held_out]
    assert np.mean([a == b for a, b in held]) > 0.95
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got if r.doc_id is not None)
    by = {r.doc_id: r.score for r in got}
    assert by[2000] == by[2001] and by[2003] > 0.5


def test_edges(spark):
    docs, labels = "doc_id long, text string", "doc_id long, quality int"
    assert classify(spark.createDataFrame([], docs), spark.createDataFrame([], labels)).count() == 0
    some = spark.createDataFrame([(i, "words") for i in range(6)], docs)
    assert classify(some, spark.createDataFrame([], labels)).count() == 6
    assert {r.predicted for r in classify(some, spark.createDataFrame([(i, 1) for i in range(6)], labels)).collect()} == {1}


def test_score_does_not_depend_on_neighbours_and_covers_all():
    m = ByteCnn()
    rng = random.Random(1)
    rows = ["", "ab", text(1, rng), text(0, rng), "é" * 999, "x" * 5000 + text(1, rng)]
    tables = m.tables()
    both = m.score(*utf8(pa.array(rows)), tables)
    for i, t in enumerate(rows):
        assert abs(both[i] - m.score(*utf8(pa.array([t])), tables)[0]) < 1e-5
    x = windows(*utf8(pa.array(rows)))
    _, of, at, n = m.chunks(x, tables)
    for i in range(len(rows)):
        seen = np.zeros(x[3][i, 1], bool)
        for a, k in zip(at[of == i] - x[3][i, 0], n[of == i], strict=True):
            seen[a : a + k] = True
        assert seen.all()


def test_gradient():
    m, rng = ByteCnn(), random.Random(2)
    m.p = {k: v.astype(np.float64) for k, v in m.p.items()}
    rows = [text(i % 2, rng)[:700] for i in range(4)]
    data, off = utf8(pa.array(rows))
    x, y = windows(data, off), np.array([0, 1, 0, 1.0])
    g = m.gradients(x, y, m.tables())

    def loss():
        z = m.forward(x, m.tables())[0].astype(np.float64)
        return np.mean(np.log1p(np.exp(z)) - y * z)

    for k, at in (("w", 1), ("b", 0), ("v", (2, 3)), ("c", 1), ("a", 2), ("d", 0), ("e", (1, 97, 2))):
        was, step = m.p[k][at], 1e-3
        m.p[k][at] = was + step
        up = loss()
        m.p[k][at] = was - step
        down = loss()
        m.p[k][at] = was
        assert abs((up - down) / (2 * step) - g[k][at]) < 2e-3


def plain_score(m, data):
    """Window by window, chunk by chunk, as the docstring of the module states it."""
    windows_ = [bytes(data[i : i + 4]).ljust(4, b"\0") for i in range(0, len(data), 2)]
    every = [bytes(data[i : i + 4]).ljust(4, b"\0") for i in range(len(data))]
    head = max(LAGS) // 2 + 1
    p, responses = m.p, []
    for k, w in enumerate(windows_):
        again = k >= head and any(2 * k >= lag and every[2 * k - lag] == w for lag in LAGS)
        responses.append([max(0.0, sum(float(p["e"][j, w[j], f]) for j in range(4)) + float(p["a"][f]) + (float(p["c"][f]) if again else 0)) for f in range(FILTERS)])
    halves = [responses[a : a + HALF] for a in range(0, len(responses), HALF)]
    chunks = [x + y for x, y in zip(halves, halves[1:], strict=False)] if len(halves) > 1 else halves
    means = [[sum(r[f] for r in c) / len(c) for f in range(FILTERS)] for c in chunks]
    hidden = [[max(0.0, sum(float(p["v"][h, f]) * x[f] for f in range(FILTERS)) + float(p["d"][h])) for h in range(HIDDEN)] for x in means]
    logit = sum(max((z[h] for z in hidden), default=0.0) * float(p["w"][h]) for h in range(HIDDEN)) + float(p["b"][0]) + m.shift
    return 1 / (1 + exp(-logit))


def test_score_by_hand():
    m, rng = ByteCnn(seed=9), random.Random(7)
    rows = ["", "a", "abc", "the the the the the the the the the the the", text(1, rng)[:900], text(0, rng)[:1500], "é$" * 300]
    got = m.score(*utf8(pa.array(rows)), m.tables())
    for s, t in zip(got, rows, strict=True):
        assert abs(s - plain_score(m, t.encode())) < 1e-4, t[:40]


def test_labels_in_conflict_and_repeated_ids(spark):
    rng = random.Random(3)
    docs = spark.createDataFrame([(i // 2, text(i // 2 % 2, rng), 0, "x") for i in range(400)], "doc_id long, text string, predicted int, held_out string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(i, 0) for i in range(200)], "doc_id long, quality int")
    got = classify(docs, labels, each=20).collect()
    assert len(got) == 400 and got[0].__fields__ == ["doc_id", "held_out", "score", "predicted"]
