"""Keys and identifiers taken from text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what stands for NULL inside a surrogate key.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
# Fixed value: the same for the pipe-joined fallback form.
NULL_TOKEN_FALLBACK = "_null_"


def surrogate_key(*columns: Column) -> Column:
    """MD5 over the columns' texts joined by ``-``, NULL-safe."""
    parts = [F.coalesce(c.cast("string"), F.lit(NULL_TOKEN)) for c in columns]
    return F.md5(F.concat_ws("-", *parts))


def surrogate_key_fallback(*columns: Column) -> Column:
    """The pipe-joined form used where the key package is not installed."""
    parts = [F.coalesce(c.cast("string"), F.lit(NULL_TOKEN_FALLBACK)) for c in columns]
    return F.md5(F.concat_ws("|", *parts))


def extract_app_id(url: Column) -> Column:
    """Path part that follows ``app``; empty when there is none."""
    return F.regexp_extract(url, r"(?:^|/)app/([^/]+)", 1)


def extract_title_id(url: Column) -> Column:
    """Title id (``tt`` and digits) below ``/title/``; empty when there is none."""
    return F.regexp_extract(url, r"/title/(tt\d+)", 1)


def extract_votes(text: Column) -> Column:
    """First run of digits and commas as BIGINT, 0 when there is none."""
    digits = F.replace(F.regexp_extract(text, r"([\d,]+)", 1), F.lit(","), F.lit(""))
    return F.coalesce(F.nullif(digits, F.lit("")).try_cast("bigint"), F.lit(0).cast("bigint"))


def strip_parentheses(text: Column) -> Column:
    """Remove leading and trailing round brackets, as around a year."""
    return F.btrim(text, F.lit("()"))
