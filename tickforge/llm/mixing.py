"""Mixing overlapping sources to target weights by a min-cost flow.

Documents are aggregated by membership pattern (the set of sources that hold them).  Each pattern offers its tokens
once at no cost, and again at costs that grow with every repetition (convex), to the quotas of its sources.  The flow
that meets the quotas at least cost says how many tokens each pattern gives to each source.  Documents of a pattern
are then taken in a seeded order: all of them as often as the flow covers the whole pattern, and those at the front
of the order once more.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickforge.llm.storage import settle

#: More patterns than this are refused, so that what the driver collects stays bounded; nothing is dropped.
MOST_PATTERNS = 100_000
#: Blocks of the seeded order in each pattern; also the most rows that one pattern adds to the prefix sums.
BLOCKS = 1024


def size_of(text: Column) -> Column:
    """Number of words [^\\x20\\x09-\\x0D]+ (null: 0), without making an array of them."""
    solid = F.regexp_replace(text, r"[^\x20\x09-\x0D]+", "x")
    return F.coalesce(F.length(F.regexp_replace(solid, r"[\x20\x09-\x0D]+", "")), F.lit(0)).cast("long")


def targets(sizes: dict, weights: tuple[int, ...] = (5, 2, 1), most: int = 3, total: int | None = None) -> dict:
    """Target of each source: its weight's share of the total (all sizes, if not given), at most `most` times its size, the excess reshared.

    Sources are ordered by code point, null last; weights repeat.  Water filling: sources stop in the order of
    size / weight, so the share for each unit of weight is found in one pass.
    """
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, heavy = sum(sizes.values()) if total is None else total, sum(weight.values())
    out = {}
    for s in sorted(names, key=lambda s: (Fraction(most * sizes[s], weight[s]), s is None, s or "")):
        if heavy and most * sizes[s] * heavy <= left * weight[s]:
            out[s] = float(most * sizes[s])
            left, heavy = left - most * sizes[s], heavy - weight[s]
        else:
            break
    for s in names:
        if s not in out:
            out[s] = float(left) * weight[s] / heavy
    return out


def route(capacity: dict[frozenset, int], quota: dict, costs: tuple[int, ...]) -> dict[tuple[frozenset, object], int]:
    """Min-cost flow from patterns to quotas; costs[k] is the price of a token's (k + 1)th use.  Whole tokens.

    Successive shortest paths on residual capacities, for each connected part of the graph separately.
    """
    by_source, flow = defaultdict(list), defaultdict(int)
    for p in capacity:
        for s in p:
            by_source[s].append(p)
    seen: set = set()
    for start in sorted(capacity, key=repr):
        if start in seen:
            continue
        part, todo = [], [start]
        seen.add(start)
        while todo:
            p = todo.pop()
            part.append(p)
            for q in (q for s in p for q in by_source[s]):
                if q not in seen:
                    seen.add(q)
                    todo.append(q)
        sources = sorted({s for p in part for s in p}, key=repr)
        _ssp(sorted(part, key=repr), sources, capacity, quota, costs, flow)
    return {k: v for k, v in flow.items() if v}


def _ssp(patterns: list, sources: list, capacity: dict, quota: dict, costs: tuple[int, ...], flow: dict) -> None:
    n = 2 + len(patterns) + len(sources)
    graph: list[list[list[int]]] = [[] for _ in range(n)]
    at = {s: 2 + len(patterns) + i for i, s in enumerate(sources)}

    def edge(u: int, v: int, cap: int, cost: int) -> list[int]:
        a, b = [v, cap, cost, len(graph[v])], [u, 0, -cost, len(graph[u])]
        graph[u].append(a)
        graph[v].append(b)
        return b

    back = {}
    for i, p in enumerate(patterns):
        for c in costs:
            edge(0, 2 + i, capacity[p], c)
        for s in sorted(p, key=repr):
            back[p, s] = edge(2 + i, at[s], sum(quota.values()), 0)
    for s in sources:
        edge(at[s], 1, quota[s], 0)
    potential = [0] * n
    while True:
        far, via = [None] * n, [None] * n
        far[0], heap = 0, [(0, 0)]
        while heap:
            d, u = heapq.heappop(heap)
            if d > far[u]:
                continue
            for e in graph[u]:
                if e[1] > 0:
                    x = d + e[2] + potential[u] - potential[e[0]]
                    if far[e[0]] is None or x < far[e[0]]:
                        far[e[0]], via[e[0]] = x, (u, e)
                        heapq.heappush(heap, (x, e[0]))
        if far[1] is None:
            break
        potential = [p + (f if f is not None else far[1]) for p, f in zip(potential, far, strict=True)]
        push, v = None, 1
        while v:
            u, e = via[v]
            push, v = e[1] if push is None else min(push, e[1]), u
        v = 1
        while v:
            u, e = via[v]
            e[1] -= push
            graph[v][e[3]][1] += push
            v = u
    for k, e in back.items():
        flow[k] += e[1]


def mix(df: DataFrame, sources: str = "source", id_col: str = "doc_id", text_col: str = "text", weights: tuple[int, ...] = (5, 2, 1), most: int = 3, seed: int = 17, size: Column | None = None) -> DataFrame:
    """Return df's rows with size, source_size, target and taken (words the mix takes of the row, repeats counted).

    sources names a string column (each row in one source, null being a source) or an array<string> column (a row in
    several sources; null or empty: the null source).  source_size and target are sums over the row's sources.  Each
    row is taken at most `most` times its size; a row at the cut of the seeded order is taken in part, so that the
    words taken of a pattern are what the flow asks for.  The quotas share the words of all documents, each counted once.  Rows are ordered by the MD5 of seed and id, ties by id and
    size; equal rows are interchangeable.

    Nulls: a null text has size 0 and is taken 0 times; null ids order as the empty string.  Empty tables give empty
    tables.  Extra columns stay; ones named size, source_size, target or taken are
    replaced; names that start with _mix_ are reserved.
    """
    spark = df.sparkSession
    drop = [c for c in df.columns if c.lower() in ("size", "source_size", "target", "taken")]
    many = dict(df.dtypes)[sources].startswith("array")
    base = df.withColumn("_mix_size", (size if size is not None else size_of(F.col(text_col))).cast("long"))
    key = F.array_sort(F.array_distinct(F.col(sources))) if many else F.array(F.col(sources))
    key = F.when(F.coalesce(F.size(F.col(sources)), F.lit(0)) > 0, key).otherwise(F.array(F.lit(None).cast("string"))) if many else key
    base = base.withColumn("_mix_key", key).drop(*[c for c in drop if c not in (id_col, text_col, sources)])
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    keyed = base.withColumn("_mix_order", order).withColumn("_mix_block", F.conv(F.substring("_mix_order", 1, 4), 16, 10).cast("int") % BLOCKS)

    blocks = settle(keyed.groupBy("_mix_key", "_mix_block").agg(F.sum("_mix_size").alias("_mix_sum")), "mix-blocks")
    found = blocks.groupBy("_mix_key").agg(F.sum("_mix_sum").alias("n")).limit(MOST_PATTERNS + 1).collect()
    if len(found) > MOST_PATTERNS:
        raise ValueError(f"more than {MOST_PATTERNS} membership patterns")
    capacity = {frozenset(r["_mix_key"]): r["n"] for r in found}
    held: dict = defaultdict(int)
    for p, n in capacity.items():
        for s in p:
            held[s] += n
    goal = targets(held, weights, most, sum(capacity.values())) if held else {}
    flow = route(capacity, {s: round(g) for s, g in goal.items()}, tuple(range(most)))
    given: dict = defaultdict(int)
    for (p, _), n in flow.items():
        given[p] += n
    plan = [(list(r["_mix_key"]), given[p], r["n"], sum(held[s] for s in p), sum(goal[s] for s in p)) for r in found for p in [frozenset(r["_mix_key"])]]
    plan = spark.createDataFrame(plan, "_mix_key array<string>, _mix_give long, _mix_all long, source_size long, target double")
    plan = plan.withColumn("_mix_k", F.to_json("_mix_key")).drop("_mix_key")
    passes = F.when(F.col("_mix_all") > 0, F.floor(F.col("_mix_give") / F.col("_mix_all"))).otherwise(0).cast("long")
    plan = F.broadcast(plan.withColumn("_mix_pass", passes).withColumn("_mix_rest", F.col("_mix_give") - F.col("_mix_pass") * F.col("_mix_all")))

    # the block in which the last pass over a pattern ends, and what is still to be taken there
    before = Window.partitionBy("_mix_k").orderBy("_mix_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.withColumn("_mix_k", F.to_json("_mix_key")).withColumn("_mix_start", F.coalesce(F.sum("_mix_sum").over(before), F.lit(0)))
    cuts = starts.join(plan, "_mix_k").where("_mix_start < _mix_rest and _mix_rest <= _mix_start + _mix_sum")
    cuts = cuts.select("_mix_k", F.col("_mix_block").alias("_mix_cut"), (F.col("_mix_rest") - F.col("_mix_start")).alias("_mix_left"))
    rows = keyed.withColumn("_mix_k", F.to_json("_mix_key")).join(plan, "_mix_k").join(F.broadcast(cuts), "_mix_k", "left")
    inside = F.coalesce(F.col("_mix_block") == F.col("_mix_cut"), F.lit(False))
    full = F.when(F.col("_mix_block") < F.col("_mix_cut"), F.col("_mix_size")).otherwise(0)
    within = Window.partitionBy("_mix_k").orderBy("_mix_order", F.col(id_col).asc_nulls_first(), "_mix_size").rowsBetween(Window.unboundedPreceding, -1)
    cut = rows.where(inside).withColumn("_mix_before", F.coalesce(F.sum("_mix_size").over(within), F.lit(0)))
    part = F.greatest(F.lit(0), F.least(F.col("_mix_size"), F.col("_mix_left") - F.col("_mix_before")))
    done = rows.where(~inside).withColumn("_mix_before", F.lit(None).cast("long")).withColumn("_mix_part", full.cast("long")).unionByName(cut.withColumn("_mix_part", part))
    out = done.withColumn("taken", (F.col("_mix_size") * F.col("_mix_pass") + F.col("_mix_part")).cast("long")).withColumn("size", F.col("_mix_size"))
    return out.drop(*[c for c in out.columns if c.startswith("_mix_")])


def copies(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The mixed rows as a table to train on: each row as many times as whole words taken / size, rounded half up."""
    n = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(0).cast("int")
    return mixed.withColumn("_mix_n", n).where("_mix_n > 0").withColumn("_mix_i", F.explode(F.sequence(F.lit(1), F.col("_mix_n")))).select(*columns)
