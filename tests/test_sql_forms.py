"""SQL functions against the column functions and data tests they stand for."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakeweave.functions import casts, keys, numbers, sql_forms, text
from lakeweave.operators import quality

TEXTS = [None, "", " ", "  a B\tc ", "<p>Hi</p>&amp;\n< >", " x　", "Ärger 12", "3.7", " 1e3 ", "12d", "7f", "1_000", "2,700", "2147483648", "-2.5", "NaN",
         "2024/1/5", "2024-01-05T10:00", "2013", "x" * 250, "__a--b__"]
DOUBLES = [None, 0.0, -0.0, 0.005, 1.005, -2.675, 2.5, 1e15, -1e300, float("inf"), float("nan"), 123456.785]


def same(one, two):
    return repr(one) == repr(two)


@pytest.fixture(scope="module")
def macros(spark):
    assert len(sql_forms.register_macros(spark)) == len(sql_forms.MACROS)


@pytest.mark.parametrize("call, form", [
    ("normalize_text(x)", text.normalize_text), ("clean_html(x)", text.clean_html), ("trim_text(x)", text.trim_text),
    ("strip_whitespace(x)", text.strip_whitespace), ("slugify(x)", text.slugify), ("dataset_name(x)", text.dataset_name),
    ("truncate_string(x)", text.truncate_string), ("truncate_string(x, 5)", lambda c: text.truncate_string(c, 5)),
    ("safe_double(x)", casts.safe_double), ("safe_int(x)", casts.safe_int), ("safe_date(x)", casts.safe_date),
    ("count_or_zero(x)", casts.count_or_zero), ("surrogate_key(array(x, string(i)))", lambda c: keys.surrogate_key(c, F.col("i"))),
    ("surrogate_key_fallback(array(x, string(i)))", lambda c: keys.surrogate_key_fallback(c, F.col("i"))),
])
def test_text_forms(frame, macros, call, form):
    rows = frame(list(enumerate(TEXTS)), "i int, x string").select(F.expr(call).alias("one"), form(F.col("x")).alias("two")).collect()
    assert all(same(r.one, r.two) for r in rows) and len(rows) == len(TEXTS)


@pytest.mark.parametrize("call, form", [
    ("round_half_up(x)", numbers.round_half_up), ("round_half_up(x, 0)", lambda c: numbers.round_half_up(c, 0)),
    ("safe_int_from_double(x)", casts.safe_int_from_double), ("calculate_growth(x, y)", lambda c: numbers.growth(c, F.col("y"))),
])
def test_number_forms(frame, macros, call, form):
    rows = frame([(x, y) for x in DOUBLES for y in (None, 0.0, 3.0, -0.7)], "x double, y double")
    rows = rows.select(F.expr(call).alias("one"), form(F.col("x")).alias("two")).collect()
    assert all(same(r.one, r.two) for r in rows)


def test_test_forms(spark, frame):
    rows = frame(
        [(1, "a", -1.0, datetime(2024, 1, 2)), (1, None, 0.0, None), (None, "b", None, datetime(2024, 1, 1, 1)), (None, "b", 2.0, datetime(2024, 1, 1, 0, 30))],
        "content_id long, source_name string, event_id double, at timestamp",
    )
    rows.createOrReplaceTempView("sql_form_rows")
    frame([("a",), (None,)], "source_name string").createOrReplaceTempView("sql_form_parents")
    parents, as_of = spark.table("sql_form_parents"), datetime(2024, 1, 1)

    def check(test, call, want, *args):
        sql_forms.register_test(spark, "failing_rows", test, "sql_form_rows", *args)
        got = spark.sql(f"SELECT * FROM failing_rows({call})")
        assert got.columns == want.columns and sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())), test

    check("unique", "", quality.test_unique(rows, "content_id"), "content_id")
    check("not_null", "", quality.test_not_null(rows, "content_id"), "content_id")
    check("accepted_values", "array('a')", quality.test_accepted_values(rows, "source_name", ["a"]), "source_name")
    check("positive_score", "", quality.test_positive_score(rows, "event_id"), "event_id")
    check("not_future_date", "timestamp'2024-01-01'", quality.test_not_future_date(rows, "at", as_of), "at")
    check("relationships", "", quality.test_relationships(rows, "source_name", parents, "source_name").select(rows.columns), "source_name", "sql_form_parents", "source_name")
    check("orphans", "", quality.test_orphans(rows, parents), "", "sql_form_parents")
    check("event_unique", "", quality.test_event_unique(rows))
    for args in (("unique", "sql_form_rows"), ("relationships", "sql_form_rows", "source_name"), ("nothing", "sql_form_rows", "at")):
        with pytest.raises(ValueError):
            sql_forms.register_test(spark, "failing_rows", *args)


def test_bodies_are_inlined(spark, macros, tmp_path):
    """A call leaves the plan of the expression: the filter reaches the scan, one column is read."""
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("id", "cast(id as string) AS s", "id AS unused").write.parquet(path)
    spark.read.parquet(path).createOrReplaceTempView("sql_form_table")
    sql_forms.register_test(spark, "negative_ids", "positive_score", "sql_form_table", "id")
    plan = spark.sql("SELECT normalize_text(s) AS s FROM negative_ids()")._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(id,0)" in plan and "unused" not in plan.split("ReadSchema")[1]
