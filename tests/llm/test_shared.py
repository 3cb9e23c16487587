import os
import random
import re
import subprocess
import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tickforge.llm.bytesops import shingles, slices, utf8, words
from tickforge.llm.components import components
from tickforge.llm.storage import discard, settle, shared_folder

ROOT = Path(__file__).resolve().parents[2]
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SEEN: dict[int, str] = {}


def plain(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from("aAbB \n\t\x0b\xa0é漢"), max_size=30)), max_size=8))
def test_words_and_shingles(rows):
    h, first, last = words(*utf8(pa.array(rows, pa.string())))
    for i, t in enumerate(rows):
        own = plain(t)
        assert last[i] - first[i] == len(own)
        for x, w in zip(h[first[i] : last[i]].tolist(), own, strict=True):
            assert SEEN.setdefault(x, w) == w
    for i, s in enumerate(shingles(h, first, last)):
        w = plain(rows[i])
        assert len(s) == len({tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({1} if w else ()))
        assert np.array_equal(s, np.unique(s))


def test_utf8_of_a_slice():
    a = pa.array(["x", None, "é", "", "漢"]).slice(1, 4)
    data, off = utf8(a)
    assert data.tobytes().decode() == "é漢" and off.tolist() == [0, 0, 2, 2, 5]


def test_slices_hold_every_row_once():
    b = pa.record_batch([pa.array(range(50)), pa.array([None if i % 7 == 0 else "x" * (i * 10) for i in range(50)])], ["id", "text"])
    for limit, rows in ((1, 100), (500, 100), (10**9, 3), (10**9, 100)):
        parts = list(slices(b, "text", limit, rows))
        assert pa.Table.from_batches(parts).column("id").to_pylist() == list(range(50)) and max(p.num_rows for p in parts) <= rows
    assert not list(slices(b.slice(0, 0), "text"))


def test_components(spark):
    r = random.Random(6)
    for n, m in ((1, 0), (40, 20), (60, 70), (200, 199)):
        edges = [(r.randrange(n), r.randrange(n)) for _ in range(m)] if n < 200 else [(7, k) for k in range(199)]
        edges += [(100 + k + n, 101 + k + n) for k in range(30)] if n == 40 else []
        root = {}

        def find(x, root=root):
            root.setdefault(x, x)
            while root[x] != x:
                x = root[x]
            return x

        for a, b in edges:
            if a != b:
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
        df = spark.createDataFrame([*edges, (None, 1), (1, None)], "a long, b long")
        got = {x.id: x.component for x in components(df).collect()}
        assert got == {x: find(x) for x in list(root)}


def test_settled_tables_can_be_discarded(spark):
    t = settle(spark.range(5), "t")
    assert t.count() == 5 and shared_folder(spark)
    discard(t, spark.range(1))
    assert spark.range(1).count() == 1


def test_workers_find_the_package_from_any_folder(tmp_path):
    code = (
        f"import sys; sys.path.insert(0, {str(ROOT)!r})\n"
        "from pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "import public_tokenizers as P\n"
        "from tickforge.llm.bpe import bpe_digest\n"
        "print(bpe_digest(s.createDataFrame([(1, 'two words')], 'doc_id long, text string'), P.path('byte_bpe_multi_50k.tiktoken'), P.PATTERN).first().n_tokens)"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert out.returncode == 0 and int(out.stdout.split()[-1]) > 0, out.stderr[-2000:]
