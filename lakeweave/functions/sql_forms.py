"""The macros and generic tests as SQL functions, so that statements of users and models in SQL can call them.

``register_macros`` adds scalar functions, ``register_test`` a table function for one test on one relation. Their bodies are SQL
that the optimizer inlines: a call costs what the expression costs, filters and column lists reach the scan. They last as long as the session.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from lakeweave.functions.keys import NULL_TOKEN, NULL_TOKEN_FALLBACK
from lakeweave.functions.text import SPACE_SEPARATORS, WHITE_SPACE

# Name and parameters -> (type, body). Each gives what the column function of that name gives; later ones call earlier ones. Parts of keys
# are cast by the caller: an array of mixed types would not be one of texts.
MACROS: dict[str, tuple[str, str]] = {
    "normalize_text(value STRING)": ("STRING", "lower(trim(regexp_replace(value, '[^a-zA-Z0-9 ]', '')))"),
    "clean_html(value STRING)": ("STRING", "regexp_replace(value, '<[^>]+>', '')"),
    "trim_text(value STRING)": ("STRING", f"btrim(value, '{SPACE_SEPARATORS}')"),
    "strip_whitespace(value STRING)": ("STRING", "btrim(value, '" + "".join(f"\\u{ord(c):04x}" for c in WHITE_SPACE) + "')"),
    "slugify(value STRING)": ("STRING", "btrim(regexp_replace(lower(strip_whitespace(value)), '[^a-z0-9]+', '_'), '_')"),
    "dataset_name(source STRING)": ("STRING", "concat(btrim(regexp_replace(lower(source), '[^a-z0-9]+', '_'), '_'), '_dataset')"),
    "truncate_string(value STRING, max_len INT DEFAULT 200)": (
        "STRING", "CASE WHEN length(value) > max_len THEN concat(left(value, max_len - 3), '...') ELSE value END"
    ),
    "safe_double(value STRING)": ("DOUBLE", r"CASE WHEN NOT rlike(value, r'[dD]\s*$|[0-9.][fF]\s*$') THEN try_cast(value AS DOUBLE) END"),
    "safe_int(value STRING)": (
        "INT",
        r"coalesce(try_cast(value AS INT), try_cast(round(CASE WHEN NOT rlike(value, r'[dDfF]\s*$') THEN try_cast(value AS DOUBLE) END) AS INT))",
    ),
    "safe_int_from_double(value DOUBLE)": ("INT", "try_cast(rint(value) AS INT)"),
    "safe_date(value STRING)": (
        "DATE",
        r"CASE WHEN rlike(translate(value, '/', '-'), r'^\s*\d{4}-\d{1,2}-\d{1,2}([ T].*)?\s*$') THEN try_cast(trim(translate(value, '/', '-')) AS DATE) END",
    ),
    "round_whole(value DOUBLE)": ("DOUBLE", "(value - value % 1.0D) + CASE WHEN value % 1.0D >= 0.5D THEN 1.0D ELSE 0.0D END"),
    "round_half_up(value DOUBLE, places INT DEFAULT 2)": (
        "DOUBLE",
        "CASE WHEN isnan((abs(value) * power(10.0D, places)) % 1.0D) THEN value"
        " ELSE signum(value) * (round_whole(abs(value) * power(10.0D, places)) / power(10.0D, places)) END",
    ),
    "calculate_growth(current DOUBLE, previous DOUBLE)": (
        "DOUBLE", "CASE WHEN previous <> 0 THEN round_half_up(try_divide((current - previous) * 100.0D, previous), 2) END"
    ),
    "surrogate_key(parts ARRAY<STRING>)": ("STRING", f"md5(array_join(parts, '-', '{NULL_TOKEN}'))"),
    "surrogate_key_fallback(parts ARRAY<STRING>)": ("STRING", f"md5(array_join(parts, '|', '{NULL_TOKEN_FALLBACK}'))"),
    "count_or_zero(value STRING)": ("BIGINT", "coalesce(try_cast(trim(replace(value, ',', '')) AS BIGINT), 0L)"),
}


def register_macros(spark: SparkSession) -> list[str]:
    """Add all scalar functions to the session; their names."""
    for signature, (kind, body) in MACROS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS {kind} RETURN {body}")
    return [s.split("(")[0] for s in MACROS]


def _quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def _columns(fields: list[T.StructField]) -> str:
    return ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in fields)


def register_test(spark: SparkSession, name: str, test: str, relation: str, column: str = "", parent: str = "", parent_column: str = "") -> None:
    """A table function ``name`` with the failing rows of a generic test, which an empty result passes.

    ``test`` is one of ``unique``, ``not_null``, ``accepted_values`` (called with the array of values), ``relationships`` (to ``parent``), ``positive_score``,
    ``not_future_date`` (called with the time of the run), ``orphans`` (of the dimension ``parent``) and ``event_unique``. ``relation`` and ``parent`` are tables
    or temporary views; NULLs count as in the tests of ``operators.quality``.
    """
    table = spark.table(relation)
    c = _quoted(column or {"orphans": "source_name", "event_unique": "event_id"}.get(test, ""))
    if c == "``" or (test in ("relationships", "orphans")) != bool(parent):
        raise ValueError(f"{test} on {relation}: a column, and a parent for references only")
    fields = {f.name: f for f in table.schema}
    rows, arguments = list(table.schema), ""
    counted = lambda field, n: [fields[field], T.StructField(n, T.LongType())]
    match test:
        case "unique":
            rows = counted(column, "n_records")
            body = f"SELECT {c}, count(*) FROM {relation} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1"
        case "event_unique":
            rows = counted("event_id", "occurrence_count")
            body = f"SELECT event_id, count(*) FROM {relation} GROUP BY event_id HAVING count(*) > 1"
        case "accepted_values":
            rows, arguments = counted(column, "n_records"), f"accepted ARRAY<{fields[column].dataType.simpleString()}>"
            body = f"SELECT {c}, count(*) FROM {relation} WHERE NOT array_contains(accepted, {c}) GROUP BY {c}"
        case "not_null":
            body = f"SELECT * FROM {relation} WHERE {c} IS NULL"
        case "positive_score":
            body = f"SELECT * FROM {relation} WHERE {c} < 0"
        case "not_future_date":
            arguments = "as_of TIMESTAMP"
            body = f"SELECT * FROM {relation} WHERE {c} > as_of + INTERVAL 1 HOUR"
        case "relationships":
            body = f"SELECT child.* FROM {relation} child LEFT ANTI JOIN {parent} parent ON child.{c} = parent.{_quoted(parent_column)} WHERE child.{c} IS NOT NULL"
        case "orphans":
            rows = [fields["content_id"], fields["source_name"]]
            body = f"SELECT content_id, source_name FROM {relation} child LEFT ANTI JOIN {parent} parent USING (source_name)"
        case _:
            raise ValueError(f"no test {test!r}")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {_quoted(name)}({arguments}) RETURNS TABLE ({_columns(rows)}) RETURN {body}")
