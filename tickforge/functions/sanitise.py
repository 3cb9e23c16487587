"""Text and key filters for free-form settings, and their flattening to facts."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickforge.functions.coerce import boolean, integer, text

# Parts of keys that are never kept, game modes, and patterns of unsafe or empty texts.
UNSAFE_PARTS = ("address", "addr", "bytes", "credential", "dump", "host", "password", "path", "presigned", "private", "raw", "secret", "signature", "token", "uri", "url")
MODES = ("ctf", "slayer", "oddball", "king", "race")
UNKNOWN = r"(?i)^(?:unknown|unknown\s*<[^>]+>|unknown\s+[-+]?(?:0x[0-9a-f]+|[0-9]+))$"
LOCAL_PATH = r"(?i)^(?:[A-Za-z]:[\\/]|\\\\|/(?:tmp|var|home|users|mnt)/)"
ADDRESS = r"^(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?::[0-9]{1,5})?$"
HEX = r"(?i)^(?:0x)?[0-9a-f]{32,}$"
LONGEST, DEPTH, MOST_ITEMS, MOST_LISTED = 256, 4, 128, 32
BOOLEAN_FACTS = ("gametype.teamplay", "gametype.teams_enabled")
INTEGER_FACTS = ("gametype.score_limit", "gametype.time_limit")


def unsafe_text(t: Column) -> Column:
    """Links, signed-request parameters, local paths, addresses and long hex strings."""
    low = F.lower(t)
    return low.contains("http://") | low.contains("https://") | low.contains("x-amz-") | t.rlike(LOCAL_PATH) | t.rlike(ADDRESS) | t.rlike(HEX)


def safe_text(c: Column) -> Column:
    """Trimmed, cut to 256 characters, then null if unsafe."""
    t = F.substring(text(c), 1, LONGEST)
    return F.when(~unsafe_text(t), t)


def authoritative(c: Column) -> Column:
    """Safe text that is no placeholder for something unknown."""
    t = safe_text(c)
    return F.when(~t.rlike(UNKNOWN), t)


def known_mode(c: Column) -> Column:
    t = F.lower(text(c))
    return F.when(t.isin(*MODES), t)


def release_key(c: Column) -> Column:
    t = text(c)
    return F.when(t.rlike("^[a-z0-9][a-z0-9_]*$"), t)


def safe_key(c: Column) -> Column:
    """Keys of letters, digits and _, without an unsafe part anywhere in them."""
    t = text(c)
    low = F.lower(t)
    bad = low.contains(UNSAFE_PARTS[0])
    for p in UNSAFE_PARTS[1:]:
        bad = bad | low.contains(p)
    return F.when(t.rlike("^[A-Za-z][A-Za-z0-9_]{0,63}$") & ~bad, t)


def fact_key(c: Column) -> Column:
    """Lower case, other characters as _, trimmed of _; null unless it begins with a letter."""
    t = F.regexp_replace(F.regexp_replace(F.lower(text(c)), "[^a-z0-9_]+", "_"), "^_+|_+$", "")
    return F.when(t.rlike("^[a-z][a-z0-9_]*$"), t)


def viewed(df: DataFrame, sql: Callable[[str], str]) -> DataFrame:
    """SQL over df under a name of its own, which is gone afterwards."""
    name = f"tickforge_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(name)
    try:
        return df.sparkSession.sql(sql(name))
    finally:
        df.sparkSession.catalog.dropTempView(name)


def flatten(df: DataFrame, doc: str, by: str = "game_id", depth: int = DEPTH) -> DataFrame:
    """(by, path array<string>, at array<int>, v variant) of a VARIANT document's scalars under safe keys, to the given depth.

    Lists and nulls are left out.  Of each object the first MOST_ITEMS safe keys count; a VARIANT keeps its keys in
    order of their names, and `at` says the place of each.
    """
    level = df.select(by, F.array().cast("array<string>").alias("path"), F.array().cast("array<int>").alias("at"), F.col(doc).alias("v"), F.monotonically_increasing_id().alias("_doc"))
    out = None
    for _ in range(depth):
        obj = level.where(F.schema_of_variant("v").startswith("OBJECT"))
        rows = viewed(obj, lambda name: f"SELECT l.*, e.key AS k, e.value AS x, e.pos AS n FROM {name} l, LATERAL variant_explode(v) e")
        kind = F.schema_of_variant("x")
        rows = rows.withColumn("k", safe_key(F.col("k"))).where(F.col("k").isNotNull() & (kind != "VOID"))
        rows = rows.withColumn("r", F.row_number().over(Window.partitionBy("_doc", "path").orderBy("n"))).where(F.col("r") <= MOST_ITEMS)
        rows = rows.select(by, F.concat("path", F.array("k")).alias("path"), F.concat("at", F.array("n")).alias("at"), F.col("x").alias("v"), "_doc")
        kind = F.schema_of_variant("v")
        leaf = rows.where(~kind.startswith("OBJECT") & ~kind.startswith("ARRAY")).drop("_doc")
        out = leaf if out is None else out.unionByName(leaf)
        level = rows
    return out


def facts(flat: DataFrame, by: str = "game_id") -> DataFrame:
    """(by, key, kind, value): typed facts of flattened settings; keys are `gametype.` and the normalised path.

    Some keys are booleans and some integers whatever their text; of others, unsafe texts and non-finite numbers go.  Of
    keys that normalise alike the last one counts."""
    parts = F.transform("path", fact_key)
    key = F.concat(F.lit("gametype."), F.array_join(parts, "."))
    raw = F.try_variant_get("v", "$", "string")
    rows = flat.where(~F.exists(parts, lambda p: p.isNull())).select(by, "at", key.alias("key"), F.schema_of_variant("v").alias("k"), raw.alias("raw"))
    is_bool, is_int = F.col("key").isin(*BOOLEAN_FACTS), F.col("key").isin(*INTEGER_FACTS)
    plain = F.col("k") == "STRING"
    value = F.when(is_bool, boolean(F.col("raw")).cast("string")).when(is_int, integer(F.col("raw")).cast("string")).when(plain, safe_text(F.col("raw"))).otherwise(F.col("raw"))
    kind = F.when(is_bool, "boolean").when(is_int, "integer").when(plain, "text").when(F.col("k") == "BOOLEAN", "boolean").otherwise("number")
    typed = rows.select(by, "key", F.struct("at", kind.alias("kind"), value.alias("value")).alias("f")).where("f.value is not null")
    return typed.groupBy(by, "key").agg(F.max("f").alias("f")).select(by, "key", "f.kind", "f.value")


def spawn_points(df: DataFrame, doc: str, by: str = "game_id", most: int = 512) -> DataFrame:
    """(by, n, x, y, z): the first valid spawn points of a VARIANT list of records.

    A record is {x, y, z}, or holds such an object or a list under position, translation, origin or location, or is a
    list itself; the first shape that gives three finite numbers counts."""
    rows = viewed(df, lambda name: f"SELECT `{by}`, e.pos, e.value AS r FROM {name}, LATERAL variant_explode({doc}) e WHERE schema_of_variant({doc}) LIKE 'ARRAY%'")

    def at(paths: tuple[str, str, str]) -> Column:
        xyz = [F.try_variant_get("r", p, "string").try_cast("double") for p in paths]
        ok = xyz[0].isNotNull() & xyz[1].isNotNull() & xyz[2].isNotNull()
        for c in xyz:
            ok = ok & ~F.isnan(c) & (F.abs(c) < float("inf"))
        return F.when(ok, F.struct(*[c.alias(n) for c, n in zip(xyz, "xyz", strict=True)]))

    shapes = [("$.x", "$.y", "$.z")]
    for k in ("position", "translation", "origin", "location"):
        shapes += [(f"$.{k}.x", f"$.{k}.y", f"$.{k}.z"), (f"$.{k}[0]", f"$.{k}[1]", f"$.{k}[2]")]
    shapes.append(("$[0]", "$[1]", "$[2]"))
    rows = rows.select(by, "pos", F.coalesce(*map(at, shapes)).alias("p")).where("p is not null")
    return rows.withColumn("n", F.row_number().over(Window.partitionBy(by).orderBy("pos"))).where(F.col("n") <= most).select(by, "n", "p.x", "p.y", "p.z")
