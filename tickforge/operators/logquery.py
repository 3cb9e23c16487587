"""Log queries as pipelines of filter, parse, stats, sort, limit and display over text lines or structured rows.

Lines are rows (ts, message).  A field that a pattern does not find is null; `pct` is the exact, interpolated percentile.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickforge.functions.percentiles import attach, percentiles


class Pipeline:
    """A DataFrame behind the steps of a log query; every step returns a new pipeline."""

    def __init__(self, df: DataFrame, line: str = "message"):
        self.df, self.line = df, line

    def _with(self, df: DataFrame) -> Pipeline:
        return Pipeline(df, self.line)

    def like(self, *patterns: str) -> Pipeline:
        """Lines that match one of the patterns."""
        hit = F.lit(False)
        for p in patterns:
            hit = hit | F.col(self.line).rlike(p)
        return self._with(self.df.where(hit))

    def parse(self, field: str, pattern: str, kind: str | None = None) -> Pipeline:
        """Take the pattern's first group as a field, cast to kind where it can be."""
        got = F.nullif(F.regexp_extract(self.line, pattern, 1), F.lit(""))
        return self._with(self.df.withColumn(field, got.try_cast(kind) if kind else got))

    def filter(self, condition: Column | str) -> Pipeline:
        return self._with(self.df.where(condition))

    def stats(self, by: Iterable[str], **aggregates: Column | tuple[str, float]) -> Pipeline:
        """Aggregates of groups; pct() ones are found apart, so that a group of any size keeps no buffer of its values."""
        by = list(by)
        plain = {n: c for n, c in aggregates.items() if isinstance(c, Column)}
        ranked = {n: c for n, c in aggregates.items() if not isinstance(c, Column)}
        out = self.df.groupBy(*by).agg(*[c.alias(n) for n, c in (plain or {"_rows": F.count("*")}).items()])
        if ranked:
            out = attach(out, percentiles(self.df, by, ranked), by, "left").select(*by, *aggregates)
        return self._with(out)

    def sort(self, field: str, ties: Iterable[str] = ()) -> Pipeline:
        """Descending, nulls last; ties are broken by further fields, so that a limit is repeatable."""
        return self._with(self.df.orderBy(F.col(field).desc_nulls_last(), *[F.col(t).asc_nulls_first() for t in ties]))

    def display(self, *fields: str) -> Pipeline:
        return self._with(self.df.select(*fields))

    def limit(self, n: int) -> Pipeline:
        return self._with(self.df.limit(n))


def pct(field: str, p: float) -> tuple[str, float]:
    """An exact percentile for stats: the field and the share of its values below."""
    return field, p / 100


# The log fields and the patterns that find them.
FIELDS = {
    "route": (r'"route":"([^"]+)"', None),
    "status": (r'"status":([0-9]+)', "int"),
    "duration_ms": (r'"duration_ms":([0-9.]+)', "double"),
    "db_query_ms": (r'"db_query_ms":([0-9.]+)', "double"),
    "db_query_count": (r'"db_query_count":([0-9]+)', "bigint"),
    "db_connect_ms": (r'"db_connect_ms":([0-9.]+)', "double"),
    "cold_start": (r'"cold_start":(true|false)', None),
    "request_id": (r'"request_id":"([^"]+)"', None),
    "trace_value": (r'"trace_id":(null|"[^"]+")', None),
    "event": (r'"event":"([^"]+)"', None),
    "error_type": (r'"error_type":"([^"]+)"', None),
}
COMPLETED = '"event":"request_completed"'
FAILED = ('"event":"api_error"', '"event":"unhandled_exception"', '"outcome":"server_error"')


def parsed(lines: DataFrame, patterns: Iterable[str], fields: Iterable[str]) -> Pipeline:
    p = Pipeline(lines).like(*patterns)
    for f in fields:
        p = p.parse(f, *FIELDS[f])
    return p


def route_performance(lines: DataFrame, most: int = 50) -> DataFrame:
    p = parsed(lines, [COMPLETED], ["route", "status", "duration_ms", "db_query_ms"])
    p = p.stats(["route"], requests=F.count("*"), avg_ms=F.avg("duration_ms"), p95_ms=pct("duration_ms", 95), p99_ms=pct("duration_ms", 99), max_ms=F.max("duration_ms"), avg_db_ms=F.avg("db_query_ms"))
    return p.sort("p95_ms", ["route"]).limit(most).df


def slow_requests(lines: DataFrame, least_ms: float = 2000, most: int = 100) -> DataFrame:
    fields = ["request_id", "trace_value", "route", "status", "duration_ms", "db_query_ms", "db_query_count"]
    p = parsed(lines, [COMPLETED], fields).filter(F.col("duration_ms") >= least_ms)
    return p.sort("duration_ms", ["ts", "request_id"]).display("ts", *fields).limit(most).df


def database_hotspots(lines: DataFrame, most: int = 50) -> DataFrame:
    p = parsed(lines, [COMPLETED], ["route", "db_query_ms", "db_query_count"])
    p = p.stats(["route"], requests=F.count("*"), queries=F.sum("db_query_count"), avg_queries=F.avg("db_query_count"), p95_queries=pct("db_query_count", 95), avg_db_ms=F.avg("db_query_ms"), p95_db_ms=pct("db_query_ms", 95))
    return p.sort("p95_db_ms", ["route"]).limit(most).df


def cold_versus_warm(lines: DataFrame) -> DataFrame:
    p = parsed(lines, [COMPLETED], ["cold_start", "duration_ms", "db_connect_ms"])
    return p.stats(["cold_start"], requests=F.count("*"), avg_ms=F.avg("duration_ms"), p95_ms=pct("duration_ms", 95), avg_db_connect_ms=F.avg("db_connect_ms")).df


def recent_server_errors(lines: DataFrame, most: int = 100) -> DataFrame:
    fields = ["request_id", "trace_value", "route", "event", "error_type"]
    return parsed(lines, FAILED, fields).sort("ts", ["request_id"]).display("ts", *fields).limit(most).df


def gateway_failures(access: DataFrame, least: int = 400, most: int = 100) -> DataFrame:
    """Over the access log's string fields; status is read as a number where it is one."""
    fields = ["ts", "requestId", "routeKey", "status", "responseLatency", "integrationStatus", "integrationLatency", "errorResponseType", "integrationErrorMessage"]
    return Pipeline(access.select(*fields)).filter(F.col("status").try_cast("int") >= least).sort("ts", ["requestId"]).limit(most).df


SAVED = {
    "route-performance": route_performance,
    "slow-requests": slow_requests,
    "database-hotspots": database_hotspots,
    "cold-versus-warm": cold_versus_warm,
    "recent-server-errors": recent_server_errors,
    "gateway-failures": gateway_failures,
}
