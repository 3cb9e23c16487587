"""Metric windows and M-of-N alarms over metric points (ts, metric, value)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATISTICS = {
    "Sum": lambda c: F.sum(c),
    "Maximum": lambda c: F.max(c),
    "p50": lambda c: F.percentile(c, 0.50),
    "p95": lambda c: F.percentile(c, 0.95),
    "p99": lambda c: F.percentile(c, 0.99),
}


@dataclass(frozen=True)
class Alarm:
    """An alarm fires in a period if at least m of the last n periods breach; periods without points don't."""

    name: str
    metric: str
    statistic: str
    threshold: float
    period: int = 300
    n: int = 1
    m: int = 1
    strict: bool = False

    def breach(self, value: Column) -> Column:
        hit = value > self.threshold if self.strict else value >= self.threshold
        return F.coalesce(hit, F.lit(False))


# Statistic, period, periods and threshold of every alarm of the service.
ALARMS = (
    Alarm("gateway-5xx", "gateway_5xx", "Sum", 3),
    Alarm("function-errors", "function_errors", "Sum", 1),
    Alarm("function-throttles", "function_throttles", "Sum", 1),
    Alarm("function-duration-p95", "function_duration", "p95", 5000, n=3, m=2),
    Alarm("function-duration-max", "function_duration", "Maximum", 25_000),
    Alarm("gateway-integration-p95", "gateway_integration", "p95", 3000, n=3, m=2),
    Alarm("queue-age", "queue_age", "Maximum", 300, n=2, m=2, strict=True),
    Alarm("dead-letters", "dead_letters", "Maximum", 1),
    Alarm("render-queue-age", "render_queue_age", "Maximum", 300, n=2, m=2, strict=True),
    Alarm("render-dead-letters", "render_dead_letters", "Maximum", 1),
    Alarm("rollup-errors", "rollup_errors", "Sum", 1),
    Alarm("rollup-duration", "rollup_duration", "Maximum", 780_000),
    Alarm("rollup-dead-letters", "rollup_dead_letters", "Maximum", 1),
    Alarm("rollup-scope-failures", "rollup_scope_failures", "Sum", 1),
)


def windows(points: DataFrame, period: int, statistics: tuple[str, ...] = tuple(STATISTICS)) -> DataFrame:
    """(metric, start, points, and one column a statistic) of tumbling windows of period seconds."""
    start = F.window("ts", f"{period} seconds")["start"]
    return points.groupBy("metric", start.alias("start")).agg(F.count("*").alias("points"), *[STATISTICS[s]("value").alias(s.lower()) for s in statistics])


def states(points: DataFrame, alarm: Alarm) -> DataFrame:
    """(start, value, breaches, firing) of every period from the metric's first point to its last, gaps included."""
    seen = windows(points.where(F.col("metric") == alarm.metric), alarm.period, (alarm.statistic,)).select("start", F.col(alarm.statistic.lower()).alias("value"))
    step = F.expr(f"interval {alarm.period} seconds")
    spine = seen.agg(F.min("start").alias("a"), F.max("start").alias("b")).where("a is not null").select(F.explode(F.sequence("a", "b", step)).alias("start"))
    rows = spine.join(seen, "start", "left").withColumn("breach", alarm.breach(F.col("value")).cast("int"))
    # n - 1 earlier periods: shifted copies keep the work partitioned by period, with no global window
    total = rows.select("start", F.explode(F.sequence(F.lit(0), F.lit(alarm.n - 1))).alias("k"), "breach")
    total = total.select((F.col("start") + F.col("k") * step).alias("start"), "breach").groupBy("start").agg(F.sum("breach").cast("bigint").alias("breaches"))
    return rows.join(total, "start").select("start", "value", "breaches", (F.col("breaches") >= alarm.m).alias("firing"))


def names(*groups: DataFrame) -> DataFrame:
    """Sorted distinct alarm names of several tables of names."""
    out = groups[0].select("name")
    for g in groups[1:]:
        out = out.unionByName(g.select("name"))
    return out.distinct().orderBy("name")


def labels(thresholds: DataFrame) -> DataFrame:
    """(threshold, label): thresholds with the sorted names that share them, as `threshold: a, b`."""
    names_ = F.array_join(F.sort_array(F.collect_list("name")), ", ")
    return thresholds.groupBy("threshold").agg(names_.alias("names")).select("threshold", F.concat(F.col("threshold").cast("string"), F.lit(": "), "names").alias("label"))


def changes(state_rows: DataFrame, period: int) -> DataFrame:
    """(start, firing) where the state differs from the period before; the first period counts from not firing.

    Every period's state is sent one period on and meets the next one there, so no window spans all of them."""
    own = state_rows.select("start", "firing", F.lit(None).cast("boolean").alias("before"))
    sent = state_rows.select((F.col("start") + F.expr(f"interval {period} seconds")).alias("start"), F.lit(None).cast("boolean").alias("firing"), F.col("firing").alias("before"))
    both = own.unionByName(sent).groupBy("start").agg(F.max("firing").alias("firing"), F.coalesce(F.max("before"), F.lit(False)).alias("_before"))
    return both.where("firing <> _before").select("start", "firing")
