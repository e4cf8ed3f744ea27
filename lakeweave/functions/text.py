"""Text cleaning as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the Unicode space separators (category Zs), which SQL TRIM removes in the warehouse dialect.
SPACE_SEPARATORS = (
    "\u0020\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
)
# Fixed value: the Unicode White_Space characters.
WHITE_SPACE = SPACE_SEPARATORS + "\t\n\u000b\f\r\u0085\u2028\u2029"


def trim_text(c: Column) -> Column:
    """TRIM that also removes no-break and other Unicode spaces, but keeps tabs and newlines."""
    return F.btrim(c, F.lit(SPACE_SEPARATORS))


def strip_whitespace(c: Column) -> Column:
    """Remove all leading and trailing whitespace, tabs and newlines included."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def normalize_text(c: Column) -> Column:
    """Keep ASCII letters, digits and spaces; trim; lower-case. Inner double spaces stay."""
    return F.lower(F.trim(F.regexp_replace(c, "[^a-zA-Z0-9 ]", "")))


def clean_html(c: Column) -> Column:
    """Drop everything that looks like a tag; entities and script text stay."""
    return F.regexp_replace(c, "<[^>]+>", "")


def slugify(c: Column) -> Column:
    """Lower-case identifier with single underscores."""
    return F.btrim(F.regexp_replace(F.lower(strip_whitespace(c)), "[^a-z0-9]+", "_"), F.lit("_"))


def dataset_name(source: Column) -> Column:
    """Fallback name of a dataset crawled from ``source``."""
    slug = F.btrim(F.regexp_replace(F.lower(source), "[^a-z0-9]+", "_"), F.lit("_"))
    return F.concat(slug, F.lit("_dataset"))


def suggested_dataset_name(suggestion: Column, source: Column) -> Column:
    """A proposed name made safe and cut to 40 characters, else the source's fallback."""
    # One character is replaced by one, so the cut can come first.
    start = F.substring(F.lower(strip_whitespace(suggestion)), 1, 40)
    safe = F.btrim(F.regexp_replace(start, "[^a-z0-9_]", "_"), F.lit("_"))
    return F.when(F.length(safe) > 0, safe).otherwise(F.concat(source, F.lit("_dataset")))


def truncate_string(c: Column, max_len: int = 200) -> Column:
    """Cut to ``max_len`` characters, the last three being dots when something was cut."""
    return F.when(F.length(c) > max_len, F.concat(F.left(c, F.lit(max_len - 3)), F.lit("..."))).otherwise(c)


def html_boilerplate_strip(c: Column, max_chars: int = 12_000) -> Column:
    """Remove script, style, svg, noscript and head blocks, then keep the first ``max_chars`` characters.

    The cut is the feature here: the result is a bounded page snippet.
    """
    return F.left(F.regexp_replace(c, r"(?is)<(script|style|svg|noscript|head)\b.*?</\1>", ""), F.lit(max_chars))


def page_title(html: Column) -> Column:
    """Content of the first title element, NULL when the page has none."""
    return F.nullif(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1), F.lit(""))


def strip_strings(df, columns: list[str] | None = None):
    """Strip whitespace on every string column (or on ``columns``)."""
    wanted = columns or [name for name, kind in df.dtypes if kind == "string"]
    return df.withColumns({name: strip_whitespace(F.col(name)) for name in wanted})
