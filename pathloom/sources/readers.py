"""Batch readers and streaming sources."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Streaming sources by name; file sources need a path and a schema.
STREAM_SOURCES = ("kafka", "socket", "csv", "json", "text", "parquet")
FILE_SOURCES = ("csv", "json", "text", "parquet")


def read_json(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """JSON documents that may spread over lines.

    Such files cannot be split; keep big data in JSON lines and read it as text instead.
    """
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Headerless CSV; all columns are strings unless a schema is given."""
    reader = spark.read
    return (reader.schema(schema) if schema else reader).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_stream(
    spark: SparkSession,
    source: str,
    options: Mapping[str, str] | None = None,
    path: str | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Streaming DataFrame of the named source, with the options passed through."""
    if source not in STREAM_SOURCES:
        raise ValueError(f"unknown source {source!r}, expected one of {STREAM_SOURCES}")
    options = dict(options or {})
    reader = spark.readStream.format(source)
    if source in FILE_SOURCES:
        path = path or options.pop("path", None)
        if not path:
            raise ValueError(f"the {source} source needs a path")
        if schema is None and source != "text":
            raise ValueError(f"the {source} source needs a declared schema")
    if schema is not None and source in FILE_SOURCES:
        reader = reader.schema(schema)
    reader = reader.options(**options)
    return reader.load(path) if source in FILE_SOURCES else reader.load()
