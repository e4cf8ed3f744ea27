"""Nested JSON without a declared schema."""

from pyspark.sql import types as T

from lakeweave.operators.json_records import flatten_json, json_type


def flat(frame, texts, sep="."):
    df = flatten_json(frame(list(enumerate(texts)), "i int, j string"), "j", sep)
    return df.columns, [tuple(r) for r in df.orderBy("i").collect()]


def test_depth_kinds_and_arrays(frame):
    texts = [
        '{"k": 1, "u": {"id": 2, "a b": "x"}}', '{"k": "x", "u": {"id": 2.5, "l": [1, 2]}, "m": [1, "a"], "n": null}', None, "nope",
        '{"o": [{"z": 1}, {"y": "s"}], "u": {"a.b": true, "e,f": 1, "OBJECT<": 4, "": {"v": {"w": false}}}, "e": {}}',
    ]
    columns, rows = flat(frame, texts)
    assert sorted(columns) == sorted(["i", "k", "m", "n", "o", "u..v.w", "u.OBJECT<", "u.a b", "u.a.b", "u.e,f", "u.id", "u.l"])
    cells = [dict(zip(columns, r, strict=True)) for r in rows]
    assert [c["k"] for c in cells] == ["1", '"x"', None, None, None]
    assert [c["m"] for c in cells] == [None, '[1,"a"]', None, None, None]
    assert [float(c["u.id"]) for c in cells[:2]] == [2.0, 2.5] and cells[1]["u.l"] == [1, 2] and cells[1]["n"] is None
    assert [tuple(x) for x in cells[4]["o"]] == [(None, 1), ("s", None)] and cells[4]["u..v.w"] is False and cells[4]["u.OBJECT<"] == 4
    assert all(v is None for c in cells[2:4] for name, v in c.items() if name != "i")


def test_taken_names(frame):
    columns, rows = flat(frame, ['{"I": 7, "a_b": 1, "a": {"b": 2}, "A": {"B": 3}}'], "_")
    assert len({c.lower() for c in columns}) == 5
    assert dict(zip(columns, rows[0], strict=True))["I_2"] == 7
    assert sorted(rows[0]) == [0, 1, 2, 3, 7]


def test_other_tops(frame):
    assert flat(frame, ["[1, 2]", None, "[]"]) == (["i", "j"], [(0, [1, 2]), (1, None), (2, [])])
    assert flat(frame, ["5", "[1]", '{"a": 1}']) == (["i", "j"], [(0, "5"), (1, "[1]"), (2, '{"a":1}')])
    assert flat(frame, ["{}", None]) == (["i"], [(0,), (1,)])


def test_empty_and_given_type(frame):
    none = frame([], "i int, j string")
    assert flatten_json(none, "j").columns == ["i", "j"] and json_type(none, "j") == T.StringType()
    kind = T.StructType([T.StructField("a", T.LongType())])
    assert [tuple(r) for r in flatten_json(frame([(1, '{"a": 2, "b": 3}')], "i int, j string"), "j", kind=kind).collect()] == [(1, 2)]
