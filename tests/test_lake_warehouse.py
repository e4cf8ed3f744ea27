from datetime import UTC, date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeweave.operators.lake import Lake, Silver, lake_pipeline, latest_per_key
from lakeweave.operators.warehouse import Warehouse, register_view, stamp_loaded_at
from lakeweave.session import work_dir
from lakeweave.sources import files

NOW = datetime(2024, 5, 1, 12, 30, tzinfo=UTC)


@pytest.fixture
def lake(spark):
    return Lake(spark, work_dir(spark, "test-lake"))


@pytest.fixture
def sample(frame):
    return frame([(1, "a"), (2, "b"), (3, "c")], "id bigint, value string")


@pytest.fixture
def people(frame):
    return frame([(1, "Alice", 95.5), (2, "Bob", 87.0), (3, "Charlie", 91.2)], "id bigint, name string, score double")


@pytest.fixture
def warehouse(spark):
    import uuid

    return Warehouse(spark, work_dir(spark, "test-wh"), f"t_{uuid.uuid4().hex[:10]}")


def ids(df):
    return sorted(r.id for r in df.collect())


def test_round_trip_and_default_name(lake, sample):
    path = lake.write("raw", "s", sample, NOW)
    assert path.endswith("/raw/s/ingest_date=2024-05-01/version=2024-05-01T12-30-00+00-00")
    assert ids(lake.read("raw", "s")) == [1, 2, 3]
    assert lake.read("raw", "s").columns == ["id", "value"]


def test_missing_source_reads_as_none(lake):
    assert lake.read("raw", "none") is None
    assert lake.versions("raw", "none").count() == 0
    assert lake.entries("raw").count() == 0
    assert lake.preview("none", "x") is None
    assert lake.catalog().count() == 0


def test_unknown_layer(lake, sample):
    for call in (lambda: lake.write("copper", "s", sample, NOW), lambda: lake.read("copper", "s"),
                 lambda: lake.promote("copper", "raw", "s", sample, NOW), lambda: lake.promote("raw", "copper", "s", sample, NOW)):
        with pytest.raises(ValueError, match="copper"):
            call()


def test_day_filter_and_versions(lake, sample):
    lake.write("raw", "s", sample, datetime(2024, 1, 15, tzinfo=UTC), "one.parquet")
    lake.write("raw", "s", sample.withColumn("extra", F.lit(1)), datetime(2024, 6, 1, tzinfo=UTC), "two")
    assert lake.read("raw", "s", day=date(2024, 1, 15)).count() == 3
    assert lake.read("raw", "s", day=date(2024, 2, 1)) is None
    both = lake.read("raw", "s")
    assert both.count() == 6 and set(both.columns) == {"id", "value", "extra"}
    assert sorted(map(tuple, lake.versions("raw", "s").collect())) == [(date(2024, 1, 15), "one"), (date(2024, 6, 1), "two")]
    assert {r.version for r in lake.read("raw", "s", with_version=True).select("version").distinct().collect()} == {"one", "two"}


def test_day_read_touches_one_partition(lake, sample):
    lake.write("raw", "s", sample, datetime(2024, 1, 15, tzinfo=UTC))
    lake.write("raw", "s", sample, datetime(2024, 1, 16, tzinfo=UTC))
    assert all("ingest_date=2024-01-16" in f for f in lake.read("raw", "s", day=date(2024, 1, 16)).inputFiles())


def test_rewriting_a_version_replaces_it(lake, sample):
    lake.write("raw", "s", sample, NOW, "v")
    lake.write("raw", "s", sample.limit(1), NOW, "v")
    assert lake.read("raw", "s").count() == 1


def test_legacy_tree(spark, lake, sample):
    root = f"{lake.base}/raw/old"
    for tail in ("2024/01/15", "2024/06/01", "2024/13/45", "notes/a/b"):
        sample.coalesce(1).write.parquet(f"{root}/{tail}")
    assert sorted(r[0] for r in lake.legacy_versions(root).collect()) == [date(2024, 1, 15), date(2024, 6, 1)]
    assert lake.read_legacy(f"{root}/2024").count() == 9


def test_entries_and_catalog(spark, lake, sample, frame):
    lake.write("raw", "s", sample, NOW, "data")
    lake.write("gold", "t", sample, NOW, "other")
    entries = lake.entries("raw").collect()
    assert {e.source for e in entries} == {"s"} and all(e.size_bytes > 0 and e.filename.endswith(".parquet") for e in entries)
    assert lake.entries("raw", "s").count() == len(entries)
    listed = {(r.layer, r.source, r.name, r.row_count) for r in lake.catalog().collect()}
    assert listed == {("raw", "s", "data", 3), ("gold", "t", "other", 3)}
    remote = frame(
        [("raw/a/new.parquet", 5), ("raw/b/new.parquet", 6), ("raw/a/data.parquet", 7), ("raw/x.parquet", 8), ("raw/a/y.json", 9)],
        "key string, size_bytes bigint",
    )
    extra = [r for r in lake.catalog(remote).collect() if r.source == "s3"]
    assert [(r.name, r.size_bytes) for r in extra] == [("new", 5)]


def test_preview_has_at_most_100_rows(spark, lake):
    lake.write("bronze", "s", spark.range(200), NOW, "big")
    assert lake.preview("s", "big.parquet").count() == 100
    assert lake.preview("s", "missing") is None


def test_promotion_is_idempotent(spark, lake, frame):
    schema = "id string, v int, loaded_at timestamp"
    lake.write("raw", "s", frame([("a", 1, datetime(2024, 1, 1)), ("b", 1, datetime(2024, 1, 1))], schema), NOW, "l1")
    first = lake_pipeline(lake, {"s": "id", "empty": "id"}, NOW).collect()
    assert [(r.source, r.status, r.versions) for r in first] == [("s", "promoted", 1), ("empty", "skipped", 0)]
    lake.write("raw", "s", frame([("a", 2, datetime(2024, 1, 2)), ("c", 1, datetime(2024, 1, 2))], schema), NOW, "l2")
    later = datetime(2024, 5, 1, 13, tzinfo=UTC)
    lake_pipeline(lake, {"s": "id"}, later)
    lake_pipeline(lake, {"s": "id"}, later)
    assert lake.read("bronze", "s").count() == 4
    assert sorted((r.id, r.v) for r in Silver(lake, "s").snapshot("id").collect()) == [("a", 2), ("b", 1), ("c", 1)]


def _current(lake, source):
    return sorted((r.id, r.v) for r in Silver(lake, source).snapshot("id").collect())


def test_promotion_survives_a_failed_silver_write(lake, frame, monkeypatch):
    schema = "id string, v int, loaded_at timestamp"
    lake.write("raw", "s", frame([("a", 1, datetime(2024, 1, 1))], schema), NOW, "l1")
    lake_pipeline(lake, {"s": "id"}, NOW)
    lake.write("raw", "s", frame([("b", 1, datetime(2024, 1, 2))], schema), NOW, "l2")
    with monkeypatch.context() as broken:
        broken.setattr(Silver, "merge", lambda *a: 1 / 0)
        assert lake_pipeline(lake, {"s": "id"}, NOW).first().status == "failed"
    assert lake.read("bronze", "s").count() == 2 and _current(lake, "s") == [("a", 1)]
    assert lake_pipeline(lake, {"s": "id"}, NOW).first().versions == 1
    assert _current(lake, "s") == [("a", 1), ("b", 1)]


def test_backfill_under_an_earlier_time_counts(lake, frame):
    schema = "id string, v int, loaded_at timestamp"
    lake.write("raw", "s", frame([("a", 1, datetime(2024, 1, 5))], schema), NOW, "l1")
    lake_pipeline(lake, {"s": "id"}, NOW)
    lake.write("raw", "s", frame([("b", 1, datetime(2024, 1, 1)), ("a", 0, datetime(2024, 1, 1))], schema), NOW, "l0")
    lake_pipeline(lake, {"s": "id"}, datetime(2024, 1, 2, tzinfo=UTC))
    assert _current(lake, "s") == [("a", 1), ("b", 1)]


def test_promotion_rewrites_touched_buckets_and_rejects_rows_without_a_key(spark, lake, frame):
    schema = "id string, v int, loaded_at timestamp"
    rows = [(f"k{i}", 1, datetime(2024, 1, 1)) for i in range(300)] + [(None, 1, None), (None, 2, None), ("", 3, None)]
    lake.write("raw", "s", frame(rows, schema), NOW, "l1")
    status = lake_pipeline(lake, {"s": "id"}, NOW).first()
    assert (status.rows, status.rejected, status.current) == (303, 3, 300)
    assert lake.read("silver", "s_rejects").count() == 3
    lake.write("raw", "s", frame([("k7", 2, datetime(2024, 1, 2)), ("k8", 0, datetime(2023, 1, 1))], schema), NOW, "l2")
    assert lake_pipeline(lake, {"s": "id"}, NOW).first().current == 1
    assert Silver(lake, "s").snapshot("id").count() == 300
    assert lake.read("silver", "s").count() < 300 + 60  # the second version holds two buckets


def test_latest_per_key_keeps_rows_without_a_key(frame):
    rows = [(None, 1, NOW), (None, 2, NOW), ("a", 3, NOW)]
    assert latest_per_key(frame(rows, "k string, v int, loaded_at timestamp"), "k").count() == 3


def test_failing_source_does_not_stop_others(lake, sample):
    lake.write("raw", "bad", sample, NOW)
    lake.write("raw", "good", sample.withColumn("loaded_at", F.lit(NOW)), NOW)
    rows = {r.source: r for r in lake_pipeline(lake, {"bad": "no_such_column", "good": "id"}, NOW).collect()}
    assert rows["bad"].status == "failed" and rows["bad"].error
    assert rows["good"].status == "promoted"


def test_latest_per_key_with_a_hot_key(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.timestamp_seconds(F.col("id")).alias("loaded_at"), "id",
    )
    got = latest_per_key(df, "k")
    assert got.count() == 2001 and got.where("k = 'hot'").first().id == 2997
    assert "WindowGroupLimit" in got._jdf.queryExecution().executedPlan().toString()


def test_files(spark, lake, sample, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.parquet_load(spark, str(tmp_path / "none.parquet"))
    assert files.parquet_load_dir(spark, str(tmp_path / "none")) is None
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "a.csv").write_text("id,name,value\n1,Alice,100\n2,Bob,200\n3,Charlie,300\n")
    (folder / "b.csv").write_bytes("id,city\n1,München\n2,Köln\n".encode("latin-1"))
    out = spark.read.parquet(files.csv_to_parquet(spark, str(folder / "a.csv"), str(tmp_path / "a.parquet")))
    assert out.columns == ["id", "name", "value"] and out.count() == 3 and dict(out.dtypes)["value"] == "int"
    status = files.csv_dir_to_parquet(spark, str(folder), str(tmp_path / "out")).collect()
    assert [r.rows for r in status] == [3, 2] and all(r.success for r in status)
    cities = [r.city for r in spark.read.parquet(status[1].output_path).orderBy("id").collect()]
    assert cities == ["M�nchen", "K�ln"]
    latin = files.read_csv(spark, str(folder / "b.csv"), encoding="ISO-8859-1").orderBy("id").first()
    assert latin.city == "München"
    assert files.csv_dir_to_parquet(spark, str(tmp_path / "none"), str(tmp_path / "x")).count() == 0


def test_ingestion(spark, lake, sample, tmp_path):
    result = files.ingest_dataframe(lake, "s", sample, NOW).first()
    assert (result.files_ingested, result.rows_total, result.success) == (1, 3, True)
    missing = files.ingest_file(lake, "s", str(tmp_path / "none.parquet"), NOW).first()
    assert not missing.success and missing.error
    empty = files.ingest_directory(lake, "s", str(tmp_path), NOW).first()
    assert empty.success and empty.files_ingested == 0
    sample.coalesce(1).write.parquet(str(tmp_path / "in"))
    (tmp_path / "in" / "broken.parquet").write_text("not parquet")
    mixed = files.ingest_directory(lake, "m", str(tmp_path / "in"), NOW).first()
    assert mixed.success and mixed.rows_total == 3 and mixed.error


def test_equal_names_in_two_folders(spark, lake, sample, tmp_path):
    for folder, n in (("a", 1), ("b", 2)):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "t.csv").write_text("id\n" + "1\n" * n)
        sample.limit(n).coalesce(1).write.parquet(str(tmp_path / "p" / folder))
        part = next((tmp_path / "p" / folder).glob("part-*.parquet"))
        part.rename(part.with_name("t.parquet"))
    status = files.csv_dir_to_parquet(spark, str(tmp_path), str(tmp_path / "out")).collect()
    assert sorted(spark.read.parquet(r.output_path).count() for r in status) == [1, 2]
    done = files.ingest_directory(lake, "s", str(tmp_path / "p"), NOW).first()
    assert (done.files_ingested, done.rows_total) == (2, 3) and lake.read("raw", "s").count() == 3


def test_csv_quoting_and_rejects(spark, tmp_path):
    (tmp_path / "q.csv").write_text('id,text\n1,"two\nlines"\n2,"say ""hi"" x"\n3,plain\n')
    out = spark.read.parquet(files.csv_to_parquet(spark, str(tmp_path / "q.csv")))
    assert [(r.id, r.text) for r in out.orderBy("id").collect()] == [(1, "two\nlines"), (2, 'say "hi" x'), (3, "plain")]
    (tmp_path / "r.csv").write_text("id,v\n1,2\nx,3\n")
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("v", T.IntegerType())])
    dest = files.csv_to_parquet(spark, str(tmp_path / "r.csv"), schema=schema)
    assert [tuple(r) for r in spark.read.parquet(dest).collect()] == [(1, 2)]
    assert [r[0] for r in spark.read.parquet(f"{dest}.rejects").collect()] == ["x,3"]


def test_count_rows_skips_corrupt(spark, sample, tmp_path):
    sample.coalesce(1).write.parquet(str(tmp_path / "d"))
    (tmp_path / "d" / "broken.parquet").write_text("not parquet at all")
    assert files.count_rows(spark, [str(tmp_path / "d")]) == 3
    assert files.count_rows(spark, []) == 0


def test_warehouse_append_and_overwrite(warehouse, people):
    assert warehouse.load("people", people, NOW).rows_loaded == 3
    assert "loaded_at" in warehouse.table("people").columns
    warehouse.load("people", people.select("score", "name", "id"), NOW)
    assert warehouse.table("people").count() == 6
    assert {r.name for r in warehouse.table("people").collect()} == {"Alice", "Bob", "Charlie"}
    warehouse.load("people", people, NOW, "overwrite")
    assert warehouse.table("people").count() == 3
    with pytest.raises(ValueError):
        warehouse.load("people", people, NOW, "sideways")
    with pytest.raises(ValueError, match="no columns"):
        warehouse.load("people", people.withColumn("new", F.lit(1)), NOW)


def test_overwrite_from_itself(warehouse, people):
    warehouse.load("people", people, NOW)
    warehouse.load("people", warehouse.table("people").where("score > 90"), NOW, "overwrite")
    assert sorted(r.name for r in warehouse.table("people").collect()) == ["Alice", "Charlie"]


def test_incremental_replay_equals_one_load(warehouse, frame):
    rows = [(i, datetime(2024, 1, 1 + i // 3)) for i in range(12)]
    df = frame(rows, "id int, loaded_at timestamp")
    first = warehouse.load("t", df.where("id < 6"), NOW, "incremental")
    again = warehouse.load("t", df.where("id < 6"), NOW, "incremental")
    rest = warehouse.load("t", df, NOW, "incremental")
    assert [(r.rows_loaded, r.rows_skipped) for r in (first, again, rest)] == [(6, 0), (0, 6), (6, 6)]
    assert ids(warehouse.table("t")) == list(range(12))
    assert warehouse.load_log().count() == 3


def test_catalog(warehouse, people):
    assert warehouse.table_info("none") is None and not warehouse.table_exists("none")
    warehouse.load("people", people, NOW)
    info = warehouse.table_info("people")
    assert info["row_count"] == 3 and [c["name"] for c in info["columns"]] == ["id", "name", "score", "loaded_at"]
    assert [t["name"] for t in warehouse.list_tables()] == ["load_log", "people"]
    assert warehouse.columns("people").where("name = 'score'").first().type == "double"


def test_stamp_and_view(spark, frame, people, tmp_path):
    df = frame([(1, datetime(2024, 1, 1)), (2, None)], "id int, loaded_at timestamp")
    assert [r.loaded_at for r in stamp_loaded_at(df, datetime(2024, 2, 1)).orderBy("id").collect()] == [datetime(2024, 1, 1), datetime(2024, 2, 1)]
    people.write.parquet(str(tmp_path / "p"))
    register_view(spark, "people_view", str(tmp_path / "p"))
    assert spark.sql("select count(*) from people_view").first()[0] == 3


def test_log_lines(spark, frame):
    lines = [
        '{"record": {"time": {"repr": "2024-01-01"}, "level": {"name": "ERROR"}, "message": "m", "extra": {"pipeline_id": "p1"}}}',
        '{"time": "t2", "level": "debug", "message": "plain", "extra": {}}',
        '{"a": 1}', "not json", "   ", '{"level": ',
    ]
    got = files.parse_log_lines(frame([(x,) for x in lines], "value string")).collect()
    assert [tuple(r) for r in got] == [
        ("2024-01-01", "ERROR", "m", "p1"), ("t2", "debug", "plain", None), ("", "INFO", '{"a": 1}', None),
    ]


def test_two_writers_note_the_same_columns(spark, lake, sample, monkeypatch):
    """Both have listed the column files before either wrote one."""
    from lakeweave.operators import lake as lake_ops

    with monkeypatch.context() as patch:
        patch.setattr(lake_ops, "child_names", lambda *_: [])
        for _ in range(2):
            lake.note_columns("raw", "twice", sample.schema)
    assert lake.columns("raw", "twice") == sample.schema
