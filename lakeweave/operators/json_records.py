"""Records and cursors from JSON API responses of unknown shape."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Keys that may hold the record list, keys below data.*, and flat cursor keys, in order.
LIST_KEYS = ["data", "results", "items", "records", "hits", "posts", "content", "list"]
NESTED_KEYS = ["items", "results", "nodes"]
CURSOR_KEYS = ["nextCursor", "next_cursor", "cursor", "after", "next_page_token", "continuation"]


def _object(text: Column) -> Column:
    """JSON object as key → JSON text of the value; NULL when the text is not an object."""
    return F.when(F.ltrim(text).startswith("{"), F.from_json(text, "map<string,string>"))


def _array(text: Column) -> Column:
    """JSON array as texts of its elements; NULL when the text is not an array."""
    return F.when(F.ltrim(text).startswith("["), F.from_json(text, "array<string>"))


def _objects_only(items: Column) -> Column:
    return F.filter(items, lambda i: F.ltrim(i).startswith("{"))


def _get(obj: Column, key: str) -> Column:
    return F.try_element_at(obj, F.lit(key))


def _node(edge: Column) -> Column:
    return F.coalesce(F.get_json_object(edge, "$.node"), edge)


def _nested_records(obj: Column) -> Column:
    """Records of one ``data.*`` object: its edges' nodes, else the first filled list; NULL when it has neither."""
    edges = _array(_get(obj, "edges"))
    filled = [F.when(~_get(obj, k).isin("[]", "", "0", "false", "{}"), _get(obj, k)) for k in NESTED_KEYS]
    chosen = _array(F.coalesce(*filled, _get(obj, NESTED_KEYS[-1])))
    return F.coalesce(F.transform(_objects_only(edges), _node), _objects_only(chosen))


def json_records(responses: DataFrame, column: str = "response") -> DataFrame:
    """One row per record: the other columns, ``record_no`` (from 0) and ``record`` (JSON text).

    Each level is parsed once, in its own projection: the response, then ``data``, then its values.
    """
    others = [c for c in responses.columns if c != column]
    response = F.col(column)
    top = responses.withColumns({"__top": _object(response), "__list": _array(response)})
    data = top.withColumn("__data", F.map_values(_object(_get(F.col("__top"), "data"))))
    below = data.withColumn("__below", F.transform("__data", _object))
    nested = F.filter(F.transform("__below", _nested_records), lambda found: found.isNotNull())
    listed = [_objects_only(_array(_get(F.col("__top"), key))) for key in LIST_KEYS]
    records = F.when(
        F.col("__top").isNotNull(), F.coalesce(F.try_element_at(nested, F.lit(1)), *listed, F.array(response))
    ).otherwise(_objects_only(F.col("__list")))
    return below.select(*others, F.posexplode(records).alias("record_no", "record"))


def json_cursor(response: Column) -> Column:
    """Cursor of the next request: the first non-empty flat text key, else the first open page's end cursor."""
    # Numbers and objects are no cursors. As a struct of variants the response is parsed once, and a text among them is
    # the only kind whose JSON form starts with a quote.
    fields = ", ".join(f"`{k}` variant" for k in [*CURSOR_KEYS, "data"])

    def cursor(parsed: Column) -> Column:
        def text(key: str) -> Column:
            return F.when(F.to_json(parsed[key]).startswith('"'), F.nullif(F.try_variant_get(parsed[key], "$", "string"), F.lit("")))

        pages = F.map_values(F.from_json(F.to_json(parsed["data"]), "map<string, variant>"))
        infos = F.filter(pages, lambda v: F.try_variant_get(v, "$.pageInfo.hasNextPage", "string") == "true")
        paged = F.try_variant_get(F.try_element_at(infos, F.lit(1)), "$.pageInfo.endCursor", "string")
        return F.coalesce(*[text(k) for k in CURSOR_KEYS], paged)

    parsed = F.when(F.ltrim(response).startswith("{"), F.from_json(response, fields))
    # A lambda over one element holds the parsed value, so that no use of it parses again.
    return F.element_at(F.transform(F.array(parsed), cursor), 1)


# --- nested objects without a declared schema -----------------------------------------------------


def _readable(kind: T.DataType) -> T.DataType:
    """The type with text in place of nothing: a field that is null everywhere has no type of its own."""
    if isinstance(kind, T.NullType):
        return T.StringType()
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_readable(kind.elementType))
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _readable(f.dataType)) for f in kind])
    return kind


def _numbered(kind: T.DataType) -> T.DataType:
    """The same struct with numbers for names: names that differ in case only cannot be told apart when a field is taken."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f"f{i}", _numbered(f.dataType)) for i, f in enumerate(kind)])
    return kind


def _mixed(kind: T.DataType) -> bool:
    """Whether values of more than one kind meet somewhere below."""
    if isinstance(kind, T.ArrayType):
        return _mixed(kind.elementType)
    return isinstance(kind, T.VariantType) or (isinstance(kind, T.StructType) and any(_mixed(f.dataType) for f in kind))


def json_type(df: DataFrame, column: str) -> T.DataType:
    """The type that all JSON texts of a column fit, merged from every row: one aggregation with partial results, one row to the driver."""
    found = df.agg(F.schema_of_variant_agg(F.try_parse_json(F.col(f"`{column}`"))).alias("t")).first().t
    # Spark names an object's type OBJECT where a column's is STRUCT; quoted names are left alone.
    parts = re.split(r"(`(?:[^`]|``)*`)", found)
    return _readable(T._parse_datatype_string("".join(p if p.startswith("`") else p.replace("OBJECT<", "STRUCT<") for p in parts)))


def flatten_json(df: DataFrame, column: str, sep: str = ".", kind: T.DataType | None = None) -> DataFrame:
    """``df`` with one column per leaf of the JSON objects in ``column``, in place of it; names are paths joined by ``sep``.

    The leaves are found from the data (``json_type``), at any depth, or given as ``kind``. Numbers of different widths widen. Arrays stay arrays, of
    structs where they hold objects. Where values of different kinds meet (a number here, an object there), and for arrays that hold such values, the column
    is JSON text. A field that is null everywhere is a text column of nulls. A text that is no JSON and a null give
    nulls. Where no top is an object the column keeps its name and gets its type (JSON text if tops differ in kind). An empty object has no leaf. A name that is taken,
    whatever its case, gets ``_2``, ``_3``, ... in the order of paths.
    """
    kind = kind or json_type(df, column)
    # Parsed once per row, whatever the number of leaves.
    source = "__json"
    while source in df.columns:
        source += "_"
    value = F.try_parse_json(F.col(f"`{column}`"))
    parsed = df.withColumn(source, value if isinstance(kind, T.VariantType) else value.try_cast(kind).cast(_numbered(kind)))

    def leaves(kind: T.DataType, here: Column, path: tuple[str, ...]) -> list[tuple[str, Column]]:
        if isinstance(kind, T.StructType):
            return [leaf for i, f in enumerate(kind) for leaf in leaves(f.dataType, here.getField(f"f{i}"), (*path, f.name))]
        return [(sep.join(path) or column, F.to_json(here) if _mixed(kind) else here)]

    others = [c for c in df.columns if c != column]
    taken, columns = {c.lower() for c in others}, []
    for name, leaf in leaves(kind, F.col(source), ()):
        free, n = name, 2
        while free.lower() in taken:
            free, n = f"{name}_{n}", n + 1
        taken.add(free.lower())
        columns.append(leaf.alias(free))
    return parsed.select(*[F.col(f"`{c}`") for c in others], *columns)
