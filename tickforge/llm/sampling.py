"""Bounded, repeatable samples of labelled rows for training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(id_col: str) -> Column:
    """True where crc32 of the id as text leaves 1 modulo 3; a null id counts as the empty string."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def per_class(df: DataFrame, label: str, by: list[str], each: int, counts: dict | None = None) -> tuple[DataFrame, dict]:
    """About `each` rows of every label, chosen by a hash of the columns `by`, and each label's count of all rows.

    The share of a label is set from its count, so the sample's size does not grow with the table; equal rows go
    together.  counts, if given, names the labels to sample and their counts.
    """
    if counts is None:
        counts = {r[label]: r["n"] for r in df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n")).collect()}
    if not counts:
        return df.limit(0), {}
    point = F.pmod(F.xxhash64(*[F.col(c) for c in by], F.lit(7)), F.lit(1_000_000_007))
    share = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(int(min(1.0, each / n) * 1_000_000_007)))])
    return df.where(F.col(label).isNotNull() & (point < share[F.col(label)])), counts
