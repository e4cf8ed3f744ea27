"""Tolerant casts that give the warehouse dialect's result on dirty input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Fixed value: what the cast to a whole number takes, within control characters and blanks.
_WHOLE_NUMBER = r"^[\x00-\x20\x7f]*[+-]?[0-9.]+[\x00-\x20\x7f]*$"


def safe_int(c: Column) -> Column:
    """Text to INT or NULL; decimals round half away from zero, exponents are accepted.

    Clean integers take the plain cast; only the rest pays for the pattern and the double detour.
    """
    text = c.cast("string")
    via_double = F.when(~text.rlike(r"[dDfF]\s*$"), text.try_cast("double"))
    return F.coalesce(text.try_cast("int"), F.round(via_double).try_cast("int"))


def safe_int_from_double(c: Column) -> Column:
    """Double to INT or NULL with ties to even."""
    return F.rint(c).try_cast("int")


def safe_double(c: Column) -> Column:
    """Text to DOUBLE or NULL; Java's d/f literal suffixes are not numbers here."""
    text = c.cast("string")
    return F.when(~text.rlike(r"[dD]\s*$|[0-9.][fF]\s*$"), text.try_cast("double"))


def safe_date(c: Column) -> Column:
    """Full dates only (year, month, day, optionally a time); ``/`` separators are accepted."""
    text = F.translate(c.cast("string"), "/", "-")
    return F.when(text.rlike(r"^\s*\d{4}-\d{1,2}-\d{1,2}([ T].*)?\s*$"), F.trim(text).try_cast("date"))


def cast_or_default(c: Column, kind: str, default) -> Column:
    """Cast, or the default where the cast fails or the value is NULL."""
    value = safe_double(c) if kind in ("double", "float") else c.try_cast(kind)
    return F.coalesce(value.cast(kind), F.lit(default).cast(kind))


def count_or_zero(c: Column) -> Column:
    """A displayed count such as ``2,700`` as BIGINT; 0 when it is not a number.

    A failed cast makes an exception inside, which costs far more than the pattern, so text that cannot be a count is not cast.
    """
    text = F.trim(F.replace(c, F.lit(","), F.lit("")))
    return F.coalesce(F.when(text.rlike(_WHOLE_NUMBER), text.try_cast("bigint")), F.lit(0).cast("bigint"))


def iso_timestamp(c: Column) -> Column:
    """ISO-8601 date or date-time, with ``Z`` or an offset, as TIMESTAMP; NULL when malformed."""
    iso = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}([.,]\d{1,6})?)?)?(Z|[+-]\d{2}:?\d{2})?)?$"
    return F.when(c.rlike(iso), c.try_cast("timestamp"))


def parse_price(c: Column) -> Column:
    """Displayed price to DOUBLE: ``$29.99`` is 29.99, ``Free to Play`` is 0, anything else NULL."""
    digits = F.regexp_extract(F.replace(c, F.lit(","), F.lit("")), r"(\d+(?:\.\d+)?)", 1)
    return F.when(F.lower(c).contains("free"), F.lit(0.0)).otherwise(F.nullif(digits, F.lit("")).try_cast("double"))


# Size suffix -> bytes.
SIZE_UNITS = {"B": 1, "KB": 1024, "MB": 1024**2, "GB": 1024**3, "TB": 1024**4}


def parse_size(c: Column, strict: bool = False) -> Column:
    """``5 MB`` to bytes. Malformed text or an unknown unit gives NULL, or fails the job when ``strict``."""
    pattern = r"^\s*(\d+(?:\.\d+)?)\s*([a-zA-Z]*)\s*$"
    unit = F.upper(F.regexp_extract(c, pattern, 2))
    factors = F.create_map(*[F.lit(x) for pair in SIZE_UNITS.items() for x in (pair[0], float(pair[1]))])
    factor = F.try_element_at(factors, F.when(unit == "", F.lit("B")).otherwise(unit))
    number = F.nullif(F.regexp_extract(c, pattern, 1), F.lit("")).cast("double")
    size = F.floor(number * factor)
    if not strict:
        return size
    bad = F.raise_error(F.concat(F.lit("cannot parse size: "), c)).cast("bigint")
    return F.when(c.isNotNull() & size.isNull(), bad).otherwise(size)
