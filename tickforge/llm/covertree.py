"""Exact threshold pairs of embeddings by dual traversal of cover trees.

Unit vectors of a label lie in blocks by the signs of fixed projections, so that near ones tend to meet.  Each block
holds a cover tree: nested levels with halving radii, every node with the true radius of what it covers.  Pairs of
blocks, and within them pairs of nodes, are pruned where the centres are further apart than both radii and the
threshold's distance; where they are so near that all their vectors must be linked, they are linked without a look.
Per pair of blocks each vector gives one row (its number of links and its local component), never a row for a link.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.llm.bytesops import map_batches
from tickforge.llm.components import components
from tickforge.llm.storage import settle

BLOCK, PROJECTIONS = 2048, 16
_SLACK = 1e-9


class CoverTree:
    """Nodes over unit vectors x; members of node i are x[start[i]:end[i]] (x is put in tree order, `order` says how)."""

    def __init__(self, x: np.ndarray, least: float):
        self.centre, self.radius, self.start, self.end, self.children = [], [], [], [], []
        order: list[np.ndarray] = []
        self._x, self._at = x, 0
        if len(x):
            self._grow(np.arange(len(x)), 0, 2.0, least, order)
        self.order = np.concatenate(order) if order else np.zeros(0, np.int64)
        self.x = x[self.order]
        self.centres = x[np.array(self.centre, dtype=np.int64)] if self.centre else x
        self.radius, self.start, self.end = np.array(self.radius), np.array(self.start), np.array(self.end)
        self.leaf = np.array([not c for c in self.children], dtype=bool)
        del self._x

    def _grow(self, members: np.ndarray, centre: int, r: float, least: float, order: list) -> int:
        """Make the node of members, which all lie within r of x[centre]; members[0] need not be the centre."""
        far = self._apart(members, centre)
        node = len(self.centre)
        self.centre.append(centre)
        self.radius.append(float(far.max(initial=0.0)))
        self.start.append(self._at)
        self.end.append(0)
        self.children.append([])
        reach = self.radius[node]
        if len(members) == 1 or reach <= least:
            order.append(members)
            self._at += len(members)
        else:
            while r / 2 >= reach:
                r /= 2
            for c, part in self._cover(members, far, centre, r / 2):
                self.children[node].append(self._grow(part, c, r / 2, least, order))
        self.end[node] = self._at
        return node

    def _apart(self, members: np.ndarray, centre: int) -> np.ndarray:
        return np.sqrt(np.maximum(0, 2 - 2 * (self._x[members] @ self._x[centre])))

    def _cover(self, members: np.ndarray, far: np.ndarray, centre: int, r: float) -> Iterator[tuple[int, np.ndarray]]:
        """Centres further than r from one another, each with the members nearer than r that no earlier one took."""
        left, c = members, centre
        near = far <= r
        while True:
            yield c, left[near]
            left = left[~near]
            if not len(left):
                return
            c = int(left[0])
            near = self._apart(left, c) <= r
            near[0] = True


def linked(a: CoverTree, b: CoverTree, cosine: float) -> list[tuple[np.ndarray, np.ndarray] | tuple[slice, slice]]:
    """All links between members of a and b, as (i, j) in tree order: arrays of single links, or slices that are all linked.

    If a is b, each link is found once, as i < j; slices of one node with itself mean all its inner pairs.
    """
    far = sqrt(max(0.0, 2 - 2 * cosine))
    same = a is b
    out: list = []
    if not len(a.x) or not len(b.x):
        return out
    todo = [(0, 0)]
    while todo:
        na, nb = todo.pop()
        ka = np.array(a.children[na] or [na])
        kb = np.array(b.children[nb] or [nb])
        if a.leaf[na] and b.leaf[nb]:
            i0, i1, j0, j1 = a.start[na], a.end[na], b.start[nb], b.end[nb]
            hit = a.x[i0:i1] @ b.x[j0:j1].T >= cosine
            if same and na == nb:
                hit = np.triu(hit, 1)
            i, j = np.nonzero(hit)
            if len(i):
                out.append((i + i0, j + j0))
            continue
        dot = a.centres[ka] @ b.centres[kb].T
        d = np.sqrt(np.maximum(0, 2 - 2 * dot))
        both = a.radius[ka][:, None] + b.radius[kb][None, :]
        may = d <= both + far + _SLACK
        if same and na == nb:
            may = np.triu(may)
        single = (a.end[ka] - a.start[ka] == 1)[:, None] & (b.end[kb] - b.start[kb] == 1)[None, :]
        i, j = np.nonzero(may & single & (dot >= cosine))
        if same and na == nb:
            i, j = i[i != j], j[i != j]
        if len(i):
            out.append((a.start[ka[i]], b.start[kb[j]]))
        must = may & ~single & (d + both <= far - _SLACK)
        for i, j in zip(*np.nonzero(must), strict=True):
            out.append((slice(a.start[ka[i]], a.end[ka[i]]), slice(b.start[kb[j]], b.end[kb[j]])))
        for i, j in zip(*np.nonzero(may & ~single & ~must), strict=True):
            todo.append((int(ka[i]), int(kb[j])))
    return out


def summarise(links: list, ids_a: np.ndarray, ids_b: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, counts, lows): of every vector with a link, how many there are and the smallest id of its local component."""
    na = len(ids_a)
    ids = ids_a if same else np.concatenate([ids_a, ids_b])
    count = np.zeros(len(ids), np.int64)
    shift = 0 if same else na
    ends: list[tuple[np.ndarray, np.ndarray]] = []
    for i, j in links:
        if isinstance(i, slice):
            p, q = np.arange(i.start, i.stop), np.arange(j.start, j.stop)
            if same and i == j:
                count[p] += len(p) - 1
            else:
                count[p] += len(q)
                count[q + shift] += len(p)
            every = np.concatenate([p, q + shift])
            ends.append((every, np.full(len(every), every[0])))
        else:
            count += np.bincount(i, minlength=len(ids))
            count += np.bincount(j + shift, minlength=len(ids))
            ends.append((i, j + shift))
    low = ids.copy()
    if ends:
        u, v = (np.concatenate(x) for x in zip(*ends, strict=True))
        while True:
            m = np.minimum(low[u], low[v])
            before = low.copy()
            np.minimum.at(low, u, m)
            np.minimum.at(low, v, m)
            if np.array_equal(before, low):
                break
    seen = count > 0
    return ids[seen], count[seen], low[seen]


def near_duplicates(df: DataFrame, cosine: float = 0.98, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Return (id, n_links, component_id, kept) of every row.

    Two vectors of one label link when their cosine, in double precision, is `cosine` or more.

    Nulls: vectors that are null, empty, zero or hold a null or non-finite component, and rows with a null label or
    id, link with nothing; their component is their own id.  Vectors of different dimensions don't link.  Repeated rows
    are one vector and give equal rows; rows that share an id but not a vector are joined through that id.  Empty
    tables give empty tables; other columns are ignored, whatever their names.
    """
    base = df.select(F.col(id_col).cast("long").alias("v"), F.col(label_col).cast("string").alias("l"), F.col(vec_col).cast("array<double>").alias("e"))
    sound = F.col("v").isNotNull() & F.col("l").isNotNull() & (F.size("e") > 0) & ~F.exists("e", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))

    def unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            v, label, dims, u, code = [], [], [], [], []
            for i, lab, e in zip(batch.column("v").to_pylist(), batch.column("l").to_pylist(), batch.column("e"), strict=True):
                x = e.values.to_numpy(zero_copy_only=False)
                top = np.abs(x).max()
                if top == 0:
                    continue
                x = x / top
                x = x / np.sqrt(x @ x)
                if len(x) not in planes:
                    planes[len(x)] = np.random.default_rng(len(x)).normal(size=(PROJECTIONS, len(x)))
                v.append(i)
                label.append(lab)
                dims.append(len(x))
                u.append(x.tobytes())
                code.append(int(np.packbits(planes[len(x)] @ x > 0).view(">u2")[0]))
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()), pa.array(label, pa.string()), pa.array(dims, pa.int32()), pa.array(u, pa.binary()), pa.array(code, pa.int32())], ["v", "l", "d", "u", "code"])

    rows = settle(map_batches(base.where(F.coalesce(sound, F.lit(False))), unit, "v long, l string, d int, u binary, code int"), "units")
    # as many leading signs as bring a label's cells near BLOCK; fuller cells are cut further by a hash of the id
    labels = settle(rows.groupBy("l", "d").agg(F.least(F.lit(PROJECTIONS), F.ceil(F.log2(F.greatest(F.lit(1.0), F.count("*") / BLOCK)))).cast("int").alias("bits")), "labels")
    cells = rows.join(labels, ["l", "d"]).withColumn("cell", F.floor(F.col("code") / F.pow(F.lit(2), PROJECTIONS - F.col("bits"))).cast("int")).drop("code", "bits")
    parts = settle(cells.groupBy("l", "d", "cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts")), "cells")
    cells = cells.join(parts, ["l", "d", "cell"]).withColumn("part", F.pmod(F.xxhash64("v"), F.col("parts")).cast("int"))
    packed = cells.groupBy("l", "d", "cell", "part").agg(F.sort_array(F.collect_set(F.struct("v", "u"))).alias("m"))
    packed = packed.select("l", "d", F.concat_ws("/", "l", "d", "cell", "part").alias("block"), "m")

    def shape(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            centre, radius = [], []
            for k, m in enumerate(batch.column("m")):
                x = np.frombuffer(b"".join(m.values.field("u").to_pylist()), np.float64).reshape(-1, batch.column("d")[k].as_py())
                c = x.mean(axis=0)
                centre.append(c.tolist())
                radius.append(float(np.sqrt(np.max(np.sum((x - c) ** 2, axis=1)))))
            yield pa.RecordBatch.from_arrays([batch.column("l"), batch.column("d"), batch.column("block"), batch.column("m"), pa.array(centre, pa.list_(pa.float64())), pa.array(radius, pa.float64())], ["l", "d", "block", "m", "c", "r"])

    blocks = settle(map_batches(packed, shape, "l string, d int, block string, m array<struct<v: long, u: binary>>, c array<double>, r double"), "blocks")
    one = blocks.select("l", "d", F.col("block").alias("ba"), F.col("c").alias("ca"), F.col("r").alias("ra"))
    two = blocks.select("l", "d", F.col("block").alias("bb"), F.col("c").alias("cb"), F.col("r").alias("rb"))
    apart = F.sqrt(F.aggregate(F.zip_with("ca", "cb", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
    near = one.join(two, ["l", "d"]).where("ba <= bb").where(apart <= F.col("ra") + F.col("rb") + sqrt(max(0.0, 2 - 2 * cosine)) + _SLACK).select("ba", "bb")
    data = blocks.select("block", "d", "m")
    pairs = near.join(data.select(F.col("block").alias("ba"), "d", F.col("m").alias("ma")), "ba").join(data.select(F.col("block").alias("bb"), F.col("m").alias("mb")), "bb")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees: dict[str, tuple[CoverTree, np.ndarray]] = {}

        def tree(name: str, m: pa.ListScalar, d: int) -> tuple[CoverTree, np.ndarray]:
            if name not in trees:
                if len(trees) >= 4:
                    trees.pop(next(iter(trees)))
                t = CoverTree(np.frombuffer(b"".join(m.values.field("u").to_pylist()), np.float64).reshape(-1, d), sqrt(2 - 2 * cosine) / 4)
                trees[name] = t, m.values.field("v").to_numpy(zero_copy_only=False)[t.order]
            return trees[name]

        for batch in batches:
            for k in range(batch.num_rows):
                ba, bb, d = (batch.column(c)[k].as_py() for c in ("ba", "bb", "d"))
                (a, ia), (b, ib) = tree(ba, batch.column("ma")[k], d), tree(bb, batch.column("mb")[k], d)
                ids, n, low = summarise(linked(a, b, cosine), ia, ib, ba == bb)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(low, pa.int64())], ["v", "n", "low"])

    found = settle(map_batches(pairs.select("ba", "bb", "d", "ma", "mb"), meet, "v long, n long, low long"), "found")
    comp = components(found, "v", "low")
    counts = found.groupBy("v").agg(F.sum("n").alias("n"))
    out = base.select("v").join(counts, "v", "left").join(comp.withColumnRenamed("id", "v"), "v", "left")
    out = out.select(F.col("v").alias(id_col), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "v").alias("component_id"))
    return out.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
