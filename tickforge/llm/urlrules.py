"""URL filters: stated host and path rules, and association rules that Spark's FP-growth mines from labelled URLs.

A URL is a set of tokens: labels of its host, its last two labels together, path segments with digits folded, and
names of its query.  Frequent token sets that go with the label "block" with enough support and confidence become
rules; a rule that holds a smaller one is pruned.  Rules are matched by an inverted index that files each rule under
its rarest token.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickforge.llm.bytesops import map_batches

#: Stated rules are held in the query's plan; more than this many are refused.
MOST_RULES = 1000
_BLOCK = "label=block"


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty if url is null or has no ://."""
    host = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(url: Column) -> Column:
    """The URL's set of tokens."""
    labels = F.filter(F.split(host_of(url), r"\."), lambda x: x != "")
    segments = F.filter(F.split(path_of(url), "/"), lambda x: x != "")
    query = F.filter(F.split(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1), F.lit("")), "&"), lambda x: x != "")
    domain = F.when(F.size(labels) > 1, F.array(F.concat(F.lit("d="), F.array_join(F.slice(labels, -2, 2), ".")))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(
        F.concat(
            F.transform(labels, lambda x: F.concat(F.lit("h="), x)),
            domain,
            F.transform(segments, lambda x: F.concat(F.lit("p="), F.regexp_replace(x, "[0-9]+", "#"))),
            F.transform(query, lambda x: F.concat(F.lit("q="), F.substring_index(x, "=", 1))),
        )
    )


def mine(labelled: DataFrame, url_col: str = "url", label_col: str = "block", support: float = 0.005, confidence: float = 0.8, gain: float = 1 / 3) -> list[tuple[frozenset[str], float, float]]:
    """Association rules (tokens, confidence, support) that say "block"; label_col is boolean, null teaches nothing.

    support is a share of the labelled URLs, and at least five of them, so the number of frequent sets does not grow
    with the table.  A rule's confidence must also be above the base rate by `gain` of what the base rate leaves.  Where all or
    none are blocked nothing tells them apart, and there is no rule.  Sets of any size count; those that hold another rule's tokens are pruned.
    """
    rows = labelled.where(F.col(label_col).isNotNull() & F.col(url_col).isNotNull())
    items = rows.select(F.concat(tokens_of(F.col(url_col)), F.when(F.col(label_col), F.array(F.lit(_BLOCK))).otherwise(F.array().cast("array<string>"))).alias("items"))
    items = items.where(F.size("items") > 0)
    n, blocked = items.agg(F.count("*"), F.count_if(F.array_contains("items", _BLOCK))).first()
    if not blocked or blocked == n:
        return []
    least = max(confidence, blocked / n + (1 - blocked / n) * gain)
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, max(support, 5 / n)), minConfidence=least).fit(items)
    found = model.associationRules.where((F.size("consequent") == 1) & (F.col("consequent")[0] == _BLOCK))
    rules = [(frozenset(r["antecedent"]), r["confidence"], r["support"]) for r in found.select("antecedent", "confidence", "support").collect()]
    rules.sort(key=lambda r: (len(r[0]), sorted(r[0])))
    kept: list[tuple[frozenset[str], float, float]] = []
    for r in rules:
        if not any(k[0] <= r[0] for k in kept):
            kept.append(r)
    return kept


def match(df: DataFrame, rules: list[tuple[frozenset[str], float, float]], keep: tuple[str, ...], url_col: str = "url") -> DataFrame:
    """The kept columns, host, path, and mined: the first mined rule (in order of tokens) that fits, else null."""
    often: dict[str, int] = {}
    for tokens, *_ in rules:
        for t in tokens:
            often[t] = often.get(t, 0) + 1
    index: dict[str, list[tuple[frozenset[str], str]]] = {}
    for tokens, *_ in rules:
        index.setdefault(min(tokens, key=lambda t: (often[t], t)), []).append((tokens, " ".join(sorted(tokens))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = []
            for tokens in batch.column("_tokens").to_pylist():
                own = set(tokens)
                hit.append(min((name for t in tokens for need, name in index.get(t, ()) if need <= own), default=None))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in (*keep, "host", "path")], pa.array(hit, pa.string())], [*keep, "host", "path", "mined"])

    url = F.col(url_col)
    rows = df.select(*keep, host_of(url).alias("host"), path_of(url).alias("path"), tokens_of(url).alias("_tokens"))
    schema = ", ".join(f"`{c}` {k}" for c, k in rows.drop("_tokens").dtypes)
    return map_batches(rows, run, f"{schema}, mined string")


def judge(df: DataFrame, stated: list[tuple[str, str, str]], labelled: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url", label_col: str = "block", **limits: float) -> DataFrame:
    """Return (id, host, path, rule, verdict, mined) of every row.

    stated: (verdict, host, path); a rule fits its host and all its subdomains if the URL's path starts with its path.
    The longest fitting rule (host and path together; ties: the first in order of text) gives the verdict, else a mined
    rule blocks, else the URL is allowed.

    Nulls: a null URL, or one without ://, has an empty host and path, which no stated rule with a host fits; it has
    no tokens and is allowed.  Null ids are kept.  Without labelled URLs nothing is mined.  Repeated rows give equal
    rows; empty tables give empty tables; other columns are ignored, whatever their names.
    """
    if len(stated) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} stated rules")
    rows = match(df, mine(labelled, url_col, label_col, **limits) if labelled is not None else [], (id_col,), url_col)
    fits = [
        F.when(((F.col("host") == h) | F.col("host").endswith(f".{h}")) & F.col("path").startswith(p), F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")))
        for v, h, p in sorted(stated, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2], r[0]))
    ]
    best = F.coalesce(*fits) if fits else F.lit(None).cast("struct<rule: string, verdict: string>")
    rows = rows.withColumn("_best", best)
    verdict = F.coalesce(F.col("_best.verdict"), F.when(F.col("mined").isNotNull(), F.lit("block")).otherwise(F.lit("allow")))
    return rows.select(id_col, "host", "path", F.col("_best.rule").alias("rule"), verdict.alias("verdict"), "mined")
