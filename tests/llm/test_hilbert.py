import random
import zlib
from collections import Counter, defaultdict
from itertools import product

import pytest
from pyspark.sql import functions as F

from tickforge.llm import hilbert
from tickforge.llm.hilbert import hilbert_index, shards


@pytest.mark.parametrize(("dims", "bits"), [(2, 3), (3, 2), (4, 2)])
def test_curve_visits_neighbours(spark, dims, bits):
    points = list(product(range(1 << bits), repeat=dims))
    df = spark.createDataFrame(points, ", ".join(f"c{k} int" for k in range(dims)))
    got = df.select("*", hilbert_index([F.col(f"c{k}") for k in range(dims)], bits).alias("i")).collect()
    line = [r[:dims] for r in sorted(got, key=lambda r: r.i)]
    assert sorted(r.i for r in got) == list(range(len(points)))
    assert all(sum(abs(a - b) for a, b in zip(x, y, strict=True)) == 1 for x, y in zip(line, line[1:], strict=False))


def rows_of(n, hot):
    rng = random.Random(5)
    rows = []
    for i in range(n):
        t = "copy of a text" if i < hot else "".join(rng.choice("abé \n") for _ in range(rng.randint(0, 300)))
        rows.append((i * 7, t, rng.choice(["a", "b", None]), rng.choice(["en", "de", None]), 1))
    return [*rows, (None, "x", None, "en", 1), (70, rows[10][1], "a", "en", 1), (1, None, "a", "en", 1), (2, None, "b", "de", 1)]


@pytest.mark.parametrize("hot", [0, 500])
def test_law(spark, hot, monkeypatch):
    monkeypatch.setattr(hilbert, "HOT", 8)
    rows = rows_of(1500, hot)
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, shard int")
    got = shards(df, 6).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter((i, len((t or "").encode()) + 8, None if t is None else zlib.crc32(t.encode())) for i, t, *_ in rows)
    size, slots, groups = Counter(), defaultdict(list), defaultdict(set)
    for r in got:
        assert r.law == "bytes" and r.grown_shard is None
        size[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
        groups[r.text_crc32, r["size"]].add(r.shard)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert max(size.values()) - min(size.values()) <= 2 * max(r["size"] for r in got) and len(size) == 6
    assert all(len(x) == 1 for k, x in groups.items() if not (hot and k[0] == zlib.crc32(b"copy of a text")))
    order = sorted((r.shard, r.slot, r.curve) for r in got)
    assert [x[2] for x in order] == sorted(x[2] for x in order)
    assert sorted(map(repr, got)) == sorted(map(repr, shards(df.repartition(5), 6).collect()))


def test_edges(spark):
    schema = "doc_id long, text string, source string, lang string"
    assert shards(spark.createDataFrame([], schema)).count() == 0
    one = shards(spark.createDataFrame([(5, "", None, None)], schema)).collect()
    assert len(one) == 1 and one[0].slot == 0 and one[0]["size"] == 8 and one[0].text_crc32 == 0


def test_shards_and_slots_by_hand(spark):
    """Along the returned curve, by id in a cell: shard by the middle of a group's bytes, slots in that order."""
    rng = random.Random(9)
    texts = ["x" * rng.randint(0, 400) + str(k) for k in range(180)]
    rows = [(i * 3 + 1, texts[i] if i < 180 else texts[rng.randrange(180)], "ab"[i % 2], "en") for i in range(240)]
    got = {r.doc_id: r for r in shards(spark.createDataFrame(rows, "doc_id long, text string, source string, lang string"), 5).collect()}
    lead = {}
    for i, t, *_ in rows:
        lead.setdefault(t, i)
    total, before, slots = sum(len(t) + 8 for _, t, *_ in rows), 0, Counter()
    for t in sorted(lead, key=lambda t: (got[lead[t]].curve, lead[t])):
        own = [i for i, x, *_ in rows if x == t]
        size = len(own) * (len(t) + 8)
        for k, i in enumerate(own):
            middle = 2 * before + size if size * 4 * 5 <= total else 2 * (before + k * (len(t) + 8)) + len(t) + 8
            shard = min(4, middle * 5 // (2 * total))
            assert (got[i].shard, got[i].slot) == (shard, slots[shard]), i
            slots[shard] += 1
        before += size


def test_no_block_is_hot(spark, monkeypatch):
    """One source, one language, one size and one outlying id; a third of the rows are one text."""
    monkeypatch.setattr(hilbert, "HOT", 64)
    monkeypatch.setattr(hilbert, "LEAST", 8)
    n = 6000
    rows = [(i, "copy 0" if i % 3 == 0 else f"text {i:06d}", "s", "en") for i in range(n - 1)] + [(1 << 60, "last one", "s", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    seen = []
    keep = hilbert.settle
    monkeypatch.setattr(hilbert, "settle", lambda d, name: seen.append((name, keep(d, name))) or seen[-1][1])
    got = shards(df, 6).collect()
    blocks = dict(seen)["shard-joined"].groupBy("_cell", "_hot", "_sub").count()
    assert blocks.agg(F.max("count")).first()[0] <= 2 * n / 64 + 8
    order = sorted((r.shard, r.slot, r.curve) for r in got)
    assert len(got) == n and [x[2] for x in order] == sorted(x[2] for x in order)
    size = Counter()
    for r in got:
        size[r.shard] += r["size"]
    assert max(size.values()) - min(size.values()) <= 40


def test_id_bins_are_exact_whatever_the_number_of_rows(spark):
    rows = spark.range(40_000).select((F.col("id") * F.col("id") + 10**9).alias("_id")).unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS _id"))
    n = 40_001
    bins = rows.select(F.struct(F.col("_id").alias("i")).alias("m")).where("m.i IS NOT NULL").groupBy(hilbert._id_bin(rows, n).alias("b")).count().collect()
    assert sorted(r["b"] for r in bins) == list(range(16)) and {r["count"] for r in bins} == {2500}
