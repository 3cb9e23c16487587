"""Column functions that turn loosely typed replay values (as text) into typed ones, with null for what does not fit.

Replay documents are late-bound, so every value may come as a number, a text or a boolean.  The functions take a string
column, as `as_text` makes of a VARIANT; none of them raises under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Counters of the parser stop at this value.
COUNTER_LIMIT = 2_147_483_647
#: Counters of the rollups must not pass this value.
ROLLUP_LIMIT = 2**53 - 1
TICKS_PER_SECOND = 30
#: A decimal number, without the suffixes that the cast would take.
NUMBER = r"(?i)^[-+]?(?:[0-9]+\.?[0-9]*(?:e[-+]?[0-9]+)?|\.[0-9]+(?:e[-+]?[0-9]+)?|inf|infinity|nan)$"

_BLANK = " \t\n\r\x0b\x0c"


def as_text(v: Column) -> Column:
    """A VARIANT's scalar as text; objects and arrays give null."""
    kind = F.schema_of_variant(v)
    return F.when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), F.lit(None)).otherwise(F.try_variant_get(v, "$", "string"))


def as_whole(v: Column) -> Column:
    """as_text for fields that hold whole numbers: of texts only plain integers count, numbers may have a fraction."""
    kind, raw = F.schema_of_variant(v), F.try_variant_get(v, "$", "string")
    odd = kind.rlike("^(?:OBJECT|ARRAY)") | ((kind == "STRING") & ~raw.rlike(r"^[ \t\n\r\x0b\f]*[-+]?[0-9]+[ \t\n\r\x0b\f]*$"))
    return F.when(~odd, raw)


def text(c: Column) -> Column:
    """Trimmed text; empty is null."""
    return F.nullif(_trimmed(c), F.lit(""))


def _trimmed(c: Column) -> Column:
    """text for patterns that an empty text does not match; it names its argument once, so plans stay small."""
    return F.btrim(c.cast("string"), F.lit(_BLANK))


def integer(c: Column) -> Column:
    """Integer text as it stands; numbers with a fraction are null, as are values outside 64 bits."""
    t = _trimmed(c)
    return F.when(t.rlike(r"^[-+]?[0-9]+$"), t.try_cast("bigint"))


def truncated(c: Column) -> Column:
    """The integer part of any number that 64 bits hold."""
    return number(c).try_cast("bigint")


def number(c: Column) -> Column:
    """A double; NaN and infinities are accepted, suffixes as in 1d and 5f are not."""
    t = _trimmed(c)
    return F.when(t.rlike(NUMBER), t.try_cast("double"))


def boolean(c: Column) -> Column:
    """True and false words in any case, else null."""
    t = F.lower(_trimmed(c))
    return F.when(t.isin("1", "true", "yes", "on", "y", "t"), True).when(t.isin("0", "false", "no", "off", "n", "f"), False)


def nonnegative(c: Column) -> Column:
    """Integers from 0; integral numbers like 5.0 count, booleans don't."""
    t = text(c)
    d = t.try_cast("double")
    whole = t.rlike(r"^[0-9]+$")
    return F.when(whole, t.try_cast("bigint")).when(t.rlike(r"^[0-9]+\.0*$|^[0-9.]+[eE][-+]?[0-9]+$") & (d == F.floor(d)) & (d < 9.2e18), d.try_cast("bigint"))


def seconds(c: Column) -> Column:
    """Finite seconds from 0, to three decimals."""
    d = number(c)
    return F.when(~F.isnan(d) & (d >= 0) & (d < float("inf")), F.round(d, 3))


def slot(c: Column) -> Column:
    """An integral slot from 0 to 63."""
    return slot_of(number(c))


def slot_of(d: Column) -> Column:
    """slot of a double."""
    return F.when((d == F.floor(d)) & d.between(0, 63), d.cast("int"))


def coordinate(c: Column) -> Column:
    """A finite double."""
    return finite(number(c))


def finite(d: Column) -> Column:
    """The double, null if it is NaN or infinite."""
    return F.when(~F.isnan(d) & (F.abs(d) < float("inf")), d)


def timestamp(c: Column) -> Column:
    """`Y-m-d H:M:S[.f]` in UTC, or ISO-8601 with an offset."""
    t = text(c)
    zoned = F.when(t.rlike(r"^[-0-9]+$"), F.concat(t, F.lit("T00:00:00Z"))).when(t.rlike(r"([Zz]|[-+][0-9]{2}:?[0-9]{2})$"), t).otherwise(F.concat(t, F.lit("Z")))
    return F.when(t.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?([Zz]|[-+][0-9]{2}:?[0-9]{2})?)?$"), zoned.try_cast("timestamp"))


def timestamp_text(c: Column) -> Column:
    """timestamp as text with Z; microseconds only if there are any."""
    t = timestamp(c)
    micros = F.pmod(F.unix_micros(t), F.lit(1_000_000))
    utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), t.cast("timestamp_ntz"))  # whatever the session's zone
    return F.concat(F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss"), F.when(micros != 0, F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0"))).otherwise(""), F.lit("Z"))


def duration(c: Column) -> Column:
    """`H:MM:SS[.f]` or `MM:SS[.f]` as whole seconds, cut towards zero."""
    t = text(c)
    parts = F.split(t, ":")
    n = F.size(parts)
    whole = lambda i: integer(F.get(parts, i))
    last = number(F.get(parts, n - 1))
    total = F.when(n == 3, whole(0) * 3600 + whole(1) * 60 + last).when(n == 2, whole(0) * 60 + last)
    return F.when(total < 0, F.ceil(total)).otherwise(F.floor(total)).cast("bigint")


def sha256_text(c: Column) -> Column:
    """Lower-cased, 64 hex digits."""
    t = F.lower(F.coalesce(text(c), F.lit("")))
    return F.when(t.rlike("^[0-9a-f]{64}$"), t)


def uuid_in(c: Column) -> Column:
    """The first UUID of version 1 to 5 in a key, lower-cased."""
    found = F.regexp_extract(c, "([0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[1-5][0-9a-fA-F]{3}-[89abAB][0-9a-fA-F]{3}-[0-9a-fA-F]{12})", 1)
    return F.lower(F.nullif(found, F.lit("")))


def tick_seconds(tick: Column) -> Column:
    return F.round(tick / F.lit(float(TICKS_PER_SECOND)), 3)


def short_name(c: Column) -> Column:
    """Last segment of a path with slashes or backslashes; null if there is none."""
    path = F.regexp_replace(F.translate(c, "\\", "/"), "/+$", "")
    return F.nullif(F.element_at(F.split(path, "/"), -1), F.lit(""))


def team_name(team: Column) -> Column:
    return F.when(team == 0, "Red").when(team == 1, "Blue").when(team.isNotNull(), F.concat(F.lit("Team "), team.cast("string")))


def team_key(team: Column) -> Column:
    return F.when(team.isNull(), "team:none").otherwise(F.concat(F.lit("team:"), team.cast("string")))


def team_label(key: Column) -> Column:
    return F.when(key == "all", "All players").when(key == "team:none", "No team").otherwise(F.concat(F.lit("Team "), F.substring_index(key, ":", -1)))


def team_order(key: Column) -> Column:
    """Sorts `all` first, teams by number, none last."""
    return F.when(key == "all", -(1 << 30)).when(key == "team:none", 1 << 30).otherwise(F.substring_index(key, ":", -1).try_cast("int"))


def rekey(key: Column, source: str, target: str) -> Column:
    """Move a key from one prefix to another; a key without the prefix keeps its last segment."""
    rest = F.when(key.startswith(source), F.substring(key, len(source) + 1, 1 << 30)).otherwise(F.element_at(F.split(key, "/"), -1))
    return F.concat(F.lit(target), F.regexp_replace(rest, "^/+", ""))
