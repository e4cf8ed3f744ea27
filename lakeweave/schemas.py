"""Type map, source contracts and record schemas."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Dtype name -> Spark type (unsigned types widen, uint64 needs 20 digits).
DTYPE_MAP: dict[str, T.DataType] = {
    "object": T.StringType(),
    "string": T.StringType(),
    "category": T.StringType(),
    "bool": T.BooleanType(),
    "boolean": T.BooleanType(),
    "int8": T.ByteType(),
    "int16": T.ShortType(),
    "int32": T.IntegerType(),
    "int64": T.LongType(),
    "uint8": T.ShortType(),
    "uint16": T.IntegerType(),
    "uint32": T.LongType(),
    "uint64": T.DecimalType(20, 0),
    "float16": T.FloatType(),
    "float32": T.FloatType(),
    "float64": T.DoubleType(),
    "date": T.DateType(),
}


def dtype_to_spark(dtype: str) -> T.DataType:
    """Spark type of a dtype name; families are matched by prefix or stem, text is the fallback."""
    if dtype in DTYPE_MAP:
        return DTYPE_MAP[dtype]
    lowered = dtype.lower()
    families = [
        (lowered.startswith("datetime64"), T.TimestampType()),
        (lowered.startswith("timedelta"), T.DayTimeIntervalType()),
        ("int" in lowered, T.LongType()),
        ("float" in lowered, T.DoubleType()),
    ]
    return next((spark_type for hit, spark_type in families if hit), T.StringType())


def infer_schema(dtypes: dict[str, str]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype_to_spark(dtype)) for name, dtype in dtypes.items()])


def create_table_sql(table: str, schema: T.StructType, location: str | None = None) -> str:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    tail = f" LOCATION '{location}'" if location else ""
    return f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet{tail}"


@dataclass(frozen=True)
class SourceContract:
    """What the pipeline knows about one content source."""

    name: str
    raw_table: str
    key: str
    columns: tuple[str, ...]
    warn_hours: int
    error_hours: int
    sentinel_keys: tuple[str, ...] = ("",)


# Source contracts and their freshness limits in hours.
SOURCES: dict[str, SourceContract] = {
    "reddit": SourceContract(
        "reddit", "reddit_posts", "id",
        ("id", "title", "author", "subreddit", "score", "num_comments", "url", "created_utc", "text", "loaded_at"),
        12, 24,
    ),
    "steam": SourceContract(
        "steam", "steam_games", "app_id",
        ("app_id", "name", "price", "rating", "genres", "developer", "release_date", "loaded_at"),
        48, 96,
    ),
    "imdb": SourceContract(
        "imdb", "imdb_titles", "id",
        ("id", "title", "year", "rating", "votes", "genres", "type", "url", "loaded_at"),
        72, 144, ("", "unknown"),
    ),
    "news": SourceContract(
        "news", "news_articles", "url",
        ("url", "title", "author", "source", "score", "published_at", "body", "loaded_at"),
        2, 6,
    ),
}

SOURCE_NAMES = list(SOURCES)
