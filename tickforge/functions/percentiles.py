"""Exact, interpolated percentiles of groups of any size, without a group's values in one buffer."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Buckets for each doubling of a value.
FINE = 64
_ZERO = 1100 * FINE


def bucket(v: Column) -> Column:
    """A whole number that never falls as v rises, with FINE steps for each doubling; NaN comes last."""
    size = F.abs(v)
    at = F.floor(F.log2(size) * FINE).cast("int") + _ZERO
    at = F.when(size == 0, 0).when(size == float("inf"), 2 * _ZERO).otherwise(at)
    return F.when(F.isnan(v), 2 * _ZERO + 1).when(v < 0, -at).otherwise(at)


def attach(left: DataFrame, right: DataFrame, by: list[str], how: str = "inner") -> DataFrame:
    """left joined with right on the columns by, nulls being equal; only left's copies of these stay."""
    theirs = {c: f"_key{i}" for i, c in enumerate(by)}
    right = right.withColumnsRenamed(theirs)
    on = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(k)) for c, k in theirs.items()], F.lit(True))
    return left.join(right, on, how).drop(*theirs.values())


def percentiles(df: DataFrame, by: list[str], wanted: dict[str, tuple[str, float]]) -> DataFrame:
    """(by, and one column a name of wanted): wanted maps a name to a field and a share from 0 to 1.

    Equal values are counted first.  Sums of these counts by bucket say in which buckets a group's ranks lie, and only
    the values there are put in order; a window holds a group's buckets or a bucket's different values, never all of a
    group's.  Nulls don't count; a group or field without values has null, a group of nulls only no row.
    """
    asked = [(name, field, p) for name, (field, p) in wanted.items()]
    fields = sorted({field for _, field, _ in asked})
    rows = df.select(*by, F.inline(F.array(*[F.struct(F.lit(f).alias("_f"), F.col(f).cast("double").alias("_v")) for f in fields]))).where(F.col("_v").isNotNull())
    values = rows.groupBy(*by, "_f", "_v").agg(F.count("*").alias("_n")).withColumn("_b", bucket(F.col("_v")))
    group = [*by, "_f"]
    held = values.groupBy(*group, "_b").agg(F.sum("_n").alias("_m"))
    line = Window.partitionBy(*group)
    held = held.withColumns({"_end": F.sum("_m").over(line.orderBy("_b")), "_all": F.sum("_m").over(line)})
    every = F.filter(F.array(*[F.struct(F.lit(n).alias("_name"), F.lit(f).alias("_of"), F.lit(float(p)).alias("_p")) for n, f, p in asked]), lambda x: x["_of"] == F.col("_f"))
    ranks = held.select("*", F.inline(every)).withColumn("_at", F.col("_p") * (F.col("_all") - 1)).withColumns({"_lo": F.floor("_at"), "_up": F.ceil("_at"), "_base": F.col("_end") - F.col("_m")})
    inside = lambda rank, base, end: (F.col(rank) >= base) & (F.col(rank) < end)
    hit = ranks.where(inside("_lo", F.col("_base"), F.col("_end")) | inside("_up", F.col("_base"), F.col("_end"))).select(*group, "_b", "_name", "_at", "_lo", "_up", "_base")
    near = attach(values, hit, [*group, "_b"])
    end = F.col("_base") + F.sum("_n").over(Window.partitionBy(*group, "_b", "_name").orderBy("_v"))
    near = near.withColumn("_end", end).withColumn("_start", F.col("_end") - F.col("_n"))
    found = near.groupBy(*by, "_name", "_at", "_lo", "_up").agg(*[F.max(F.when(inside(r, F.col("_start"), F.col("_end")), F.col("_v"))).alias(f"{r}v") for r in ("_lo", "_up")])
    value = F.when(F.col("_lov") == F.col("_upv"), F.col("_lov")).otherwise((F.col("_up") - F.col("_at")) * F.col("_lov") + (F.col("_at") - F.col("_lo")) * F.col("_upv"))
    return found.groupBy(*by).agg(*[F.max(F.when(F.col("_name") == n, value)).alias(n) for n, _, _ in asked])
