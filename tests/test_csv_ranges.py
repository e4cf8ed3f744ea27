"""A CSV file cut into ranges at every byte against the reading by one task."""

import random

import pytest
from pyspark.sql import types as T

from lakeweave.sources import files
from lakeweave.sources.csv_ranges import RangedCsv, inside_after, splittable

PART = "spark.sql.files.maxPartitionBytes"
TEXT = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])


@pytest.fixture
def cut(spark):
    """Set the size of ranges; the cost of opening a file goes down with it."""
    before = spark.conf.get(PART)

    def to(size):
        spark.conf.set(PART, str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield to
    spark.conf.set(PART, before)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def rows(df):
    """Values and whether the record is corrupt: its text has other line ends here."""
    return sorted(((r.a, r.b, r[files.CORRUPT] is not None) for r in df.collect()), key=repr)


@pytest.mark.parametrize("end", [b"\n", b"\r\n"])
def test_every_cut_gives_the_records_of_one_task(spark, cut, tmp_path, end):
    text = b'"a\nx",b\n1,"two\nlines, ""quoted"" ""\n\n"\n"",\n2,plain\n\n"3\n\n\n",4\n5\n6,7,8\nu"q,"r"s,t\n"last ""\none"' + b",z\n"
    path = str(tmp_path / "t.csv")
    (tmp_path / "t.csv").write_bytes(text.replace(b"\n", end))
    cut(1 << 20)
    want = rows(files.read_csv(spark, path, TEXT))
    assert len(want) == 8 and sum(r[2] for r in want) == 3
    for size in [*range(1, 12), 17, 23, 40, 64, 80, 99]:
        cut(size)
        assert rows(files.read_csv(spark, path, TEXT)) == want, size


@pytest.mark.parametrize("alphabet,seed", [('ab,,"""\n\n', 1), ('a ,"\n', 2), ('"\n', 3)])
def test_random_files(spark, cut, tmp_path, alphabet, seed):
    rng = random.Random(seed)
    for i in range(6):
        body = "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60)))
        data = f"a,b\n{body}" if rng.random() < 0.6 else f"a,b\r\n{body}".replace("\r\n", "\n").replace("\n", "\r\n")
        (tmp_path / f"{i}.csv").write_bytes(data.encode())
        path = str(tmp_path / f"{i}.csv")
        cut(1 << 20)
        want = rows(files.read_csv(spark, path, TEXT))
        cut(rng.choice([3, 5, 9]))
        assert rows(files.read_csv(spark, path, TEXT)) == want, data


def test_types_names_and_rejects_are_those_of_one_task(spark, cut, tmp_path):
    path = str(tmp_path / "t.csv")
    text = "﻿id,price,when,id,\n" + "".join(f'{i},{i}.5,2024-01-{i % 28 + 1:02d},"x\n{i}",y\n' for i in range(40)) + "7,short\n"
    (tmp_path / "t.csv").write_text(text, encoding="utf-8")
    cut(1 << 20)
    one = files.read_csv(spark, path)
    cut(100)
    many = files.read_csv(spark, path)
    assert many.schema == one.schema and sorted(many.collect(), key=repr) == sorted(one.collect(), key=repr)
    assert len(set(many.inputFiles())) > 3
    dest = files.csv_to_parquet(spark, path, str(tmp_path / "out"))
    assert spark.read.parquet(dest).count() == 40
    assert [r[0] for r in spark.read.parquet(f"{dest}.rejects").collect()] == ["7,short"]
    schema = T.StructType([T.StructField(n, T.StringType() if n in "cde" else T.IntegerType()) for n in "abcde"])
    dest = files.csv_to_parquet(spark, path, str(tmp_path / "typed"), schema)
    assert spark.read.parquet(f"{dest}.rejects").count() == 41  # 0.5 is no integer


def test_other_encodings_and_separators_in_the_text(spark, cut, tmp_path):
    (tmp_path / "l.csv").write_bytes("a,b\n1,München\n2,\x1eKöln\x1f\n".encode("latin-1"))
    cut(6)
    assert rows(files.read_csv(spark, str(tmp_path / "l.csv"), TEXT, "ISO-8859-1")) == [("1", "München", False), ("2", "\x1eKöln\x1f", False)]
    (tmp_path / "w.csv").write_bytes("a,b\n1,x\n".encode("utf-16"))
    assert not splittable(spark, str(tmp_path / "w.csv"), "UTF-16")
    assert files.read_csv(spark, str(tmp_path / "w.csv"), encoding="UTF-16").count() == 1
    (tmp_path / "all.csv").write_bytes(b"a,b\n1,\x02\x03\x04\x05\x1c\x1d\x1e\x1f\n")
    with pytest.raises(ValueError, match="separate"):
        RangedCsv(spark, str(tmp_path / "all.csv")).store()


def test_small_and_odd_files(spark, cut, tmp_path):
    for name, data in {"empty": b"", "header": b"a,b\n", "no_end": b"a,b\n1,2", "one_line": b"a,b", "cr": b"a,b\r1,2\r"}.items():
        (tmp_path / f"{name}.csv").write_bytes(data)
        cut(1 << 20)
        one = files.read_csv(spark, str(tmp_path / f"{name}.csv"), TEXT).collect()
        cut(2)
        assert files.read_csv(spark, str(tmp_path / f"{name}.csv"), TEXT).collect() == one, name


def test_states_of_lines():
    for line, outside, inside in [
        (b'a,"b', True, False), (b'"a"', False, False), (b'""', False, True), (b'"', True, False), (b'a"b', False, False), (b'"a"b,"c', True, True), (b"x", False, True),
    ]:
        assert (inside_after(line, False), inside_after(line, True)) == (outside, inside), line


def test_directory_with_a_schema_and_rejects(spark, tmp_path):
    (tmp_path / "in" / "sub").mkdir(parents=True)
    (tmp_path / "in" / "a.csv").write_text("id,v\n1,2\nx,3\n")
    (tmp_path / "in" / "sub" / "b.csv").write_text("id,v\n4,5\n")
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("v", T.IntegerType())])
    status = files.csv_dir_to_parquet(spark, str(tmp_path / "in"), str(tmp_path / "out"), schema).collect()
    assert [(r.rows, r.rejected, r.success) for r in status] == [(1, 1, True), (1, 0, True)]
    assert [r[0] for r in spark.read.parquet(f"{status[0].output_path}.rejects").collect()] == ["x,3"]


def test_names_of_ingested_files_do_not_collide(spark, tmp_path):
    from datetime import UTC, datetime

    from lakeweave.operators.lake import Lake
    from lakeweave.session import work_dir

    lake, at = Lake(spark, work_dir(spark, "test-lake")), datetime(2024, 1, 1, tzinfo=UTC)
    for n, name in enumerate(["a/b", "a__b", "x y", "x_y", "x+20y", "é"]):
        target = tmp_path / "in" / f"{name}.parquet"
        target.parent.mkdir(parents=True, exist_ok=True)
        spark.createDataFrame([(n,)], "n int").coalesce(1).write.parquet(str(tmp_path / f"made{n}"))
        next((tmp_path / f"made{n}").glob("part-*.parquet")).rename(target)
    done = files.ingest_directory(lake, "s", str(tmp_path / "in"), at).first()
    assert (done.files_ingested, done.rows_total, done.success) == (6, 6, True)
    assert sorted(r.n for r in lake.read("raw", "s").collect()) == list(range(6))
    assert lake.versions("raw", "s").count() == 6
