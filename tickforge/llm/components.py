"""Connected components of an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.llm.storage import discard, settle


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """pairs(u, v), u != v, both directions for the large star; u > v for the small one."""
    low = settle(pairs.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("m")), "low")  # as a table, so that a join with a hot u can be split
    seen = pairs.join(low, "u")
    if large:
        return seen.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    kept = seen.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
    return kept


def components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """Return (id, component): for every id in edges, the smallest id reachable from it.

    Self loops and repeated edges are allowed; rows with a null end are ignored; no edge gives no row.  Only
    edge tables move between rounds, each written to the shared folder; stars of any degree are pre-aggregated
    by Spark's partial aggregation and never gathered in one task.
    """
    e = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u is not null and v is not null and u <> v")
    now = settle(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = F.struct(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).alias("mark")
    before = now.agg(mark).first()["mark"]
    for _ in range(most_rounds):
        if before["n"] == 0:
            break
        both = now.union(now.select("v", "u").toDF("u", "v"))
        wide = _star(both, True).where("u <> v").distinct()
        after = settle(_star(wide.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), False).where("u <> v").distinct(), "edges")
        seen = after.agg(mark).first()["mark"]
        discard(now)
        now = after
        if seen == before:
            break
        before = seen
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("v").alias("id")).distinct().withColumn("component", F.col("id"))
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
