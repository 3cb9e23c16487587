"""Exact top-k search by columnar branch and bound.

Candidates lie in blocks in vertical layout, one array for each dimension.  For a query, scores are accumulated one
group of dimensions at a time; what the dimensions left can add or take away is bounded by the product of both
remaining norms, and candidates whose upper bound is below the k-th best lower bound are compacted away.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickforge.llm.bytesops import map_batches
from tickforge.llm.storage import settle

CANDIDATES, QUERIES, DIMS = 4096, 1024, 8
#: Packed queries are broadcast up to this size, and joined by a shuffle beyond.
MOST_BROADCAST = 64 << 20


def search_block(vectors: np.ndarray, ids: np.ndarray, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best (ids, scores) of columns `vectors` (dims x n), ties to smaller ids; `own` takes no part."""
    d = len(query)
    alive = np.flatnonzero(ids != own)
    score = np.zeros(len(alive), vectors.dtype)
    cols = vectors[:, alive]
    exact = vectors.dtype != object
    if exact:
        rest = np.zeros((d // DIMS + 2, len(alive)))
        steps = list(range(0, d, DIMS))
        for s in range(len(steps) - 1, -1, -1):
            part = cols[steps[s] : steps[s] + DIMS]
            rest[s] = rest[s + 1] + np.einsum("ij,ij->j", part, part)
        rest = np.sqrt(rest) * (1 + 1e-12)
    for s, a in enumerate(range(0, d, DIMS)):
        score = score + query[a : a + DIMS] @ cols[a : a + DIMS]
        if not exact or len(alive) <= k or a + DIMS >= d:
            continue
        slack = float(np.sqrt(np.sum(query[a + DIMS :] ** 2))) * rest[s + 1] * (1 + 1e-12) + 1e-6
        floor = np.partition(score - slack, len(alive) - k)[len(alive) - k]
        keep = score + slack >= floor
        if keep.sum() < 0.7 * len(keep):
            alive, score, cols, rest = alive[keep], score[keep], cols[:, keep], rest[:, keep]
    best = np.lexsort((ids[alive], -score))[:k]
    return ids[alive[best]], score[best]


def _matrix(rows: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(ids, columns) of a list<struct<v, x list<long>>>; columns are doubles where sums stay exact in them, else Python ints."""
    flat = rows.flatten()
    ids = flat.field("v").to_numpy(zero_copy_only=False)
    x = flat.field("x").flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
    big = int(np.abs(x, dtype=np.float64).max(initial=0)) if x.size else 0
    kind = np.float64 if big * big * max(1, x.shape[1]) < 1 << 52 else object
    return ids, np.ascontiguousarray(x.T.astype(kind))


def top_k(df: DataFrame, queries: Column, k: int = 10, scale: int = 1024, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Return (query_id, rank from 1, id, score): for each row where `queries` holds, the k highest integer inner products.

    Components x become floor(scale * x) as 64-bit integers.  Candidates are all rows of the query's dimension but
    those with its id; ties go to the smaller id.  Fewer than k candidates give fewer rows.

    Nulls: rows with a null id, a null vector, no component, or a null or non-finite component take no part.  Repeated
    rows are candidates each; a query id that repeats counts once (equal rows are one query).  Scores that exceed 64
    bits are held at their limits.  Empty tables give empty tables; other columns are ignored, whatever their names.
    """
    spark = df.sparkSession
    sound = F.col("v").isNotNull() & (F.size("e") > 0) & ~F.exists("e", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.select(F.col(id_col).cast("long").alias("v"), F.col(vec_col).cast("array<double>").alias("e"), F.coalesce(queries, F.lit(False)).alias("q")).where(F.coalesce(sound, F.lit(False)))
    rows = settle(rows.select("v", F.size("e").alias("d"), F.transform("e", lambda x: F.floor(x * scale)).alias("x"), "q"), "vectors")
    sizes = rows.groupBy("d").agg(F.count("*").alias("n"), F.count_if("q").alias("m"), F.sum(F.when(F.col("q"), F.col("d").cast("long") * 8)).alias("b")).collect()
    out = "query_id long, vec_id long, score long"
    if not sizes or not any(r["m"] for r in sizes):
        return spark.createDataFrame([], f"query_id long, rank int, {id_col} long, score long")
    nq = F.create_map(*[c for r in sizes for c in (F.lit(r["d"]), F.lit(max(1, ceil(r["m"] / QUERIES))))])[F.col("d")]
    nc = F.create_map(*[c for r in sizes for c in (F.lit(r["d"]), F.lit(max(1, ceil(r["n"] / CANDIDATES))))])[F.col("d")]
    asked = rows.where("q").select("v", "x", "d").distinct().withColumn("qb", F.pmod(F.xxhash64("v"), nq).cast("int"))
    asked = asked.groupBy("d", "qb").agg(F.collect_list(F.struct("v", "x")).alias("qs"))
    blocks = rows.withColumn("cb", F.pmod(F.xxhash64("v", F.lit(3)), nc).cast("int")).groupBy("d", "cb").agg(F.collect_list(F.struct("v", "x")).alias("cs"))
    if sum(r["b"] or 0 for r in sizes) <= MOST_BROADCAST:
        asked = F.broadcast(asked)
    pairs = blocks.withColumn("qb", F.explode(F.sequence(F.lit(0), nq - 1))).join(asked, ["d", "qb"]).select("cs", "qs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, cols = _matrix(batch.column("cs").slice(i, 1))
                qid, qcols = _matrix(batch.column("qs").slice(i, 1))
                if cols.dtype != qcols.dtype:
                    cols, qcols = cols.astype(object), qcols.astype(object)
                found = [search_block(cols, ids, qcols[:, j], qid[j], k) for j in range(len(qid))]
                score = np.concatenate([s for _, s in found]) if found else np.zeros(0)
                score = [max(-(1 << 63), min((1 << 63) - 1, int(s))) for s in score]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(qid, [len(s) for _, s in found]), pa.int64()), pa.array(np.concatenate([v for v, _ in found]), pa.int64()), pa.array(score, pa.int64())], ["query_id", "vec_id", "score"])

    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    best = map_batches(pairs, run, out).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", F.col("vec_id").alias(id_col), "score")
