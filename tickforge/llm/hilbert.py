"""Sharding along a Hilbert curve over quantised metadata, with DataFrame functions only.

Dimensions: source, language, size (power of two) and id (bins of near equal count), BITS bits each.  Groups of equal texts take the
metadata of their smallest id, so a group is one run of the curve.  The curve is walked by a state table that the rule
of Gray codes and rotations gives; cutting the sorted rows into runs of near equal bytes gives shards, each of which
covers few ranges of every dimension.
"""

from __future__ import annotations

import math
from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickforge.llm.storage import settle

DIMS = 4
BITS = 4
#: Leading curve bits that make a bucket of the prefix sums: 4096 at most, whatever the input.
BUCKET_BITS = 12
#: A group of equal texts with more than 1 / HOT of all rows is spread over its own blocks; at most HOT of those.  A
#: bucket with more is cut into its cells of the curve, and cells with more, whose rows agree in all dimensions, by a
#: hash of the group.  Tables of up to LEAST rows a block are never cut.
HOT, LEAST = 2048, 256
#: Ids in each range of them, and the most ranges.
RANGE, MOST_RANGES = 8192, 4096


@lru_cache
def _states(dims: int) -> tuple[list[int], list[int]]:
    """For state * 2^dims + cell: the cell's place on the curve, and the state inside it.

    A state is (entry corner e, direction d).  Within it, the cell with coordinate bits l has place gray^-1 of
    rotate(l xor e), and the sub-cube at place w has the entry and direction of the standard recursion.
    """
    n, full = dims, (1 << dims) - 1

    def rotate(x: int, by: int) -> int:
        by %= n
        return ((x >> by) | (x << (n - by))) & full

    def ungray(g: int) -> int:
        w = 0
        while g:
            w ^= g
            g >>= 1
        return w

    def gray(w: int) -> int:
        return w ^ (w >> 1)

    def ones(w: int) -> int:
        return ((w ^ (w + 1)).bit_length() - 1) if w >= 0 else 0

    place, follow = [], []
    for state in range((1 << n) * n):
        e, d = state & full, state >> n
        for cell in range(1 << n):
            w = ungray(rotate(cell ^ e, d + 1))
            entry = 0 if w == 0 else gray(2 * ((w - 1) // 2))
            turn = 0 if w == 0 else (ones(w - 1) if w % 2 == 0 else ones(w)) % n
            place.append(w)
            follow.append((e ^ rotate(entry, -(d + 1))) | ((d + turn + 1) % n) << n)
    return place, follow


def hilbert_index(dims: list[Column], bits: int) -> Column:
    """Place on the Hilbert curve of a point with integer coordinates of `bits` bits each."""
    n = len(dims)
    place, follow = _states(n)
    place_c, follow_c = F.array(*map(F.lit, place)), F.array(*map(F.lit, follow))
    cells = F.array(*[sum((F.shiftright(x.cast("int"), b).bitwiseAND(1) * (1 << k) for k, x in enumerate(dims)), F.lit(0)) for b in range(bits - 1, -1, -1)])

    def step(acc: Column, cell: Column) -> Column:
        at = acc["s"] * (1 << n) + cell
        return F.struct((acc["i"] * (1 << n) + F.get(place_c, at)).cast("long").alias("i"), F.get(follow_c, at).cast("int").alias("s"))

    return F.aggregate(cells, F.struct(F.lit(0).cast("long").alias("i"), F.lit(0).cast("int").alias("s")), step)["i"]


def _id_bin(rows: DataFrame, n: int) -> Column:
    """The bin of _id among 2^BITS of near equal count; their limits are the exact quantiles of the different ids.

    The ids are put in order by ranges; the ranges' counts say where the quantiles' ranks lie, and only those ranges are
    numbered, each in a task of about RANGE ids.
    """
    ids = rows.where(F.col("_id").isNotNull()).select(F.col("_id").cast("double").alias("i")).distinct()
    ids = settle(ids.repartitionByRange(min(MOST_RANGES, 1 + n // RANGE), "i").withColumn("_p", F.spark_partition_id()), "shard-ids")
    counts = sorted((r["_p"], r["count"]) for r in ids.groupBy("_p").count().collect())
    total = sum(c for _, c in counts)
    at = [(total - 1) * k / (1 << BITS) for k in range(1, 1 << BITS)] if total else []
    ranks, base, spots = sorted({f(x) for x in at for f in (math.floor, math.ceil)}), 0, {}
    for p, c in counts:
        spots |= {(p, r - base + 1): r for r in ranks if base <= r < base + c}
        base += c
    placed = ids.where(F.col("_p").isin([p for p, _ in spots])).withColumn("_r", F.row_number().over(Window.partitionBy("_p").orderBy("i")))
    found = placed.where(reduce(lambda x, y: x | y, [(F.col("_p") == p) & (F.col("_r") == r) for p, r in spots], F.lit(False))).collect() if spots else []
    value = {spots[r["_p"], r["_r"]]: r["i"] for r in found}
    limits = [value[math.floor(x)] if x == math.floor(x) else (math.ceil(x) - x) * value[math.floor(x)] + (x - math.floor(x)) * value[math.ceil(x)] for x in at]
    return sum((F.when(F.col("m.i") > x, 1).otherwise(0) for x in limits), F.lit(0))


def _blocked(rows: DataFrame, n: int) -> DataFrame:
    """Rows with their place on the curve and their block (_cell, _hot, _sub), none of which much more than n / HOT rows have."""
    top, limit = (1 << BITS) - 1, max(LEAST, n // HOT)
    group = ["_g", "_g2", "_size"]
    code = lambda c: F.when(F.col(c).isNull(), 0).otherwise(1 + F.pmod(F.xxhash64(c), F.lit(top)))
    first = F.struct(F.col("_id").alias("i"), F.coalesce(code("_source"), F.lit(0)).alias("s"), F.coalesce(code("_lang"), F.lit(0)).alias("l"))
    groups = rows.groupBy(*group).agg(F.min(first).alias("m"), F.count("*").alias("_gn"), F.sum("_size").alias("_gb"))
    dims = [F.col("m.s"), F.col("m.l"), F.least(F.floor(F.log2(F.col("_size").cast("double"))), F.lit(top)), _id_bin(rows, n)]
    hot = F.col("_gn") > limit
    parts = F.when(hot, F.least(F.lit(HOT), F.ceil(F.col("_gn") / limit))).otherwise(1).cast("int")
    groups = groups.select(*group, "_gn", "_gb", F.col("m.i").alias("_lead"), hilbert_index(dims, BITS).alias("curve"))
    groups = settle(groups.withColumn("_hot", F.when(hot, F.col("_g")).otherwise(F.lit(None).cast("long"))).withColumn("_parts", parts), "shard-groups")
    # at most 2^(DIMS * BITS) cells, whatever the input
    cells = groups.groupBy("curve").agg(F.sum("_gn").alias("_cn"), F.sum(F.when(F.col("_hot").isNull(), F.col("_gn")).otherwise(0)).alias("_free"))
    low = 1 << DIMS * BITS - BUCKET_BITS
    bucket = F.col("curve") - F.col("curve") % low
    heavy = F.sum("_cn").over(Window.partitionBy(bucket)) > limit
    cells = cells.select("curve", F.when(heavy, F.col("curve")).otherwise(bucket).alias("_cell"), F.when(heavy, F.greatest(F.lit(1), F.ceil(F.col("_free") / limit))).otherwise(1).cast("int").alias("_split"))
    sub = F.when(F.col("_hot").isNotNull(), F.pmod(F.xxhash64("_id"), F.col("_parts"))).otherwise(F.pmod(F.xxhash64("_g", F.lit(5)), F.col("_split"))).cast("int")
    return rows.join(groups, group).join(F.broadcast(settle(cells, "shard-cells")), "curve").withColumn("_sub", sub).drop("_parts", "_split", "_gn")


def shards(df: DataFrame, n_shards: int = 24, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """Return (id, size, text_crc32, law, shard, slot, grown_shard, curve) of every row; law is `bytes`.

    size is the text's UTF-8 bytes (null: none) plus 8.  Shards are consecutive runs of the curve whose sizes are near
    equal: a row or group belongs to the shard in which the middle of its bytes lies.  Equal texts keep together unless
    the group exceeds a quarter of a shard, which is then cut between rows.  slot counts each shard's rows from 0
    along the curve.  grown_shard is null: under this law one more shard moves the cuts.

    Nulls: a null text is the same group as no other row but null texts (text_crc32 null), empty texts are a group of
    size 8; null source and language are quantised as 0, null ids in the first bin, and sort first.  Repeated rows get slots of their own.
    Empty tables give empty tables; other columns are ignored, whatever their names.
    """
    bytes_ = F.coalesce(F.octet_length("_text"), F.lit(0)).cast("long") + 8
    rows = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.col(source_col).cast("string").alias("_source"), F.col(lang_col).cast("string").alias("_lang"))
    rows = rows.select("_id", "_source", "_lang", bytes_.alias("_size"), F.crc32("_text").alias("_crc"), F.xxhash64("_text", F.lit(1)).alias("_g"), F.coalesce(F.hash("_text"), F.lit(0)).alias("_g2"))
    rows = settle(rows, "shard-rows")
    whole = rows.agg(F.count("*").alias("n"), F.sum("_size").alias("b")).first()
    n, total = whole["n"], whole["b"] or 0
    group = ["_g", "_g2", "_size"]
    key = ["_cell", "_hot", "_sub"]
    joined = settle(_blocked(rows, n), "shard-joined")
    sums = joined.groupBy(*key).agg(F.sum("_size").alias("_bb"))
    # at most 2^BUCKET_BITS + (16 + 3) HOT blocks, whatever the input
    line = Window.orderBy(F.col("_cell"), F.col("_hot").asc_nulls_first(), F.col("_sub")).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_start", F.coalesce(F.sum("_bb").over(line), F.lit(0))).drop("_bb")
    block = Window.partitionBy(*key)
    walk = block.orderBy("curve", F.col("_lead").asc_nulls_first(), *group, F.col("_id").asc_nulls_first())
    placed = joined.join(F.broadcast(sums), (joined["_cell"] == sums["_cell"]) & joined["_hot"].eqNullSafe(sums["_hot"]) & (joined["_sub"] == sums["_sub"])).drop(*[sums[k] for k in key])
    prior = F.coalesce(F.sum("_size").over(walk.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.col("_start")
    placed = placed.withColumn("_prior", prior).withColumn("_rank", F.row_number().over(walk))
    # where the row's group begins, if it is kept together
    together = F.col("_hot").isNull() & (F.col("_gb") * 4 * n_shards <= total)
    begin = F.min("_prior").over(Window.partitionBy(*key, "curve", "_lead", *group))
    middle = F.when(together, begin * 2 + F.col("_gb")).otherwise(F.col("_prior") * 2 + F.col("_size"))
    shard = F.least(F.lit(n_shards - 1), F.floor(middle * n_shards / F.lit(max(1, 2 * total)))).cast("int")
    placed = settle(placed.withColumn("shard", shard).select("_id", "_size", "_crc", "curve", "_rank", "shard", *key), "shard-placed")

    counts = placed.groupBy(*key, "shard").agg(F.count("*").alias("_c"), F.min("_rank").alias("_r"))
    counts = counts.withColumn("_base", F.coalesce(F.sum("_c").over(Window.partitionBy("shard").orderBy(F.col("_cell"), F.col("_hot").asc_nulls_first(), F.col("_sub")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) - F.col("_r"))
    counts = counts.select(*key, "shard", "_base")
    out = placed.join(F.broadcast(counts), (placed["_cell"] == counts["_cell"]) & placed["_hot"].eqNullSafe(counts["_hot"]) & (placed["_sub"] == counts["_sub"]) & (placed["shard"] == counts["shard"])).drop(*[counts[k] for k in [*key, "shard"]])
    return out.select(F.col("_id").alias(id_col), F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", (F.col("_rank") + F.col("_base")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "curve")
