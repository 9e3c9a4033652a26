"""Casts with the rules of the SQL dialect the marts were defined in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DECIMAL = "decimal(38,18)"

# Relative error up to which an exact number stands for the number that was read. Twelve digits are
# kept of every number of a millionth or more, however many digits its text or double has.
EXACT_STEP = 1e-12

# A zone suffix counts only behind a time of day, so plain dates stay untouched.
_ZONE_AFTER_TIME = r"(:\d{2}(?:\.\d+)?)\s*(?:[Zz]|UTC|[+-]\d{2}(?::?\d{2})?)$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_ntz(c: Column | str) -> Column:
    """Text to timestamp without zone: the zone suffix is dropped, not applied.

    Spark's cast does that by itself except for times without seconds; only those (and
    what is no timestamp at all, which fails) go through the pattern.
    """
    text = F.trim(_col(c).cast("string"))
    stripped = F.regexp_replace(text, _ZONE_AFTER_TIME, "$1")
    return F.coalesce(text.try_cast("timestamp_ntz"), stripped.cast("timestamp_ntz"))


def try_ntz(c: Column | str) -> Column:
    """Like ``to_ntz``, but null for text that is no timestamp."""
    text = F.trim(_col(c).cast("string"))
    return F.coalesce(text.try_cast("timestamp_ntz"), F.regexp_replace(text, _ZONE_AFTER_TIME, "$1").try_cast("timestamp_ntz"))


def to_bool(c: Column | str) -> Column:
    """Text or boolean to boolean; also takes on/off, which Spark's cast rejects."""
    text = F.lower(F.trim(_col(c).cast("string")))
    return (
        F.when(text == "on", F.lit(True))
        .when(text == "off", F.lit(False))
        .otherwise(text.cast("boolean"))
    )


def to_decimal(c: Column | str, type_name: str = DECIMAL) -> Column:
    """Number or text to an exact number.

    Digits below the scale are rounded off as long as twelve are left; a value that would lose
    more fails: a mass of 1e-19 must not turn into 0. The column is used several times, so pass
    one that is computed already.
    """
    exact, double = _col(c).cast(type_name), _col(c).cast("double")
    lost = F.abs(exact.cast("double") - double) > F.abs(double) * F.lit(EXACT_STEP)
    message = F.concat(F.lit(f"more digits than {type_name} holds: "), _col(c).cast("string"))
    return F.when(lost, F.raise_error(message).cast(type_name)).otherwise(exact)


def to_int(c: Column | str) -> Column:
    """Exact number to integer, rounding halves away from zero (Spark truncates)."""
    return F.round(_col(c).cast(DECIMAL), 0).cast("int")


def double_to_int(c: Column | str) -> Column:
    """Floating number to integer, rounding halves to even."""
    return F.rint(_col(c).cast("double")).cast("int")


def to_text(c: Column | str) -> Column:
    return _col(c).cast("string")


def to_day(c: Column | str) -> Column:
    return F.to_date(_col(c))
