"""Declared jobs: source, processor, sink."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from pathloom.functions.types import build_schema
from pathloom.operators.extract import extract_csv, extract_json, infer_schema, load_mapping, project
from pathloom.operators.flatten import flatten_paths
from pathloom.sources.readers import read_stream
from pathloom.streaming.sinks import write_stream


@dataclass(frozen=True)
class Endpoint:
    """Source or sink: its name, the options passed through, and where files lie."""

    name: str
    options: Mapping[str, str] = field(default_factory=dict)
    path: str | None = None
    key: Sequence[str] = ()

    # Fixed values, here and in JobSpec: the keys of a declared job.
    @classmethod
    def from_dict(cls, spec: Mapping[str, Any]) -> Endpoint:
        meta = spec.get("metaData") or {}
        key = [k.strip() for k in (meta.get("key") or "").split(",") if k.strip()]
        return cls(spec["writer"], dict(spec.get("confProperties") or {}), meta.get("path"), key)


@dataclass(frozen=True)
class JobSpec:
    app_name: str
    source: Endpoint
    processor: str
    properties: Mapping[str, Any]
    sink: Endpoint
    input_schema: Sequence[Any] = ()
    spark_properties: Mapping[str, str] = field(default_factory=dict)

    @classmethod
    def from_dict(cls, spec: Mapping[str, Any]) -> JobSpec:
        processor = spec["dataProcessor"]
        return cls(
            app_name=spec["appName"],
            source=Endpoint.from_dict(spec["inputProperties"]),
            processor=processor["type"],
            properties=dict(processor.get("properties") or {}),
            sink=Endpoint.from_dict(spec["writerProperties"]),
            input_schema=list(spec.get("inputSchema") or ()),
            spark_properties=dict(spec.get("sparkProperties") or {}),
        )

    @classmethod
    def from_file(cls, path: str) -> JobSpec:
        with open(path, encoding="utf-8") as file:
            return cls.from_dict(json.load(file))


def build_session(spec: JobSpec) -> SparkSession:
    """Session with the job's Spark properties; an existing session is reused."""
    builder = SparkSession.builder.appName(spec.app_name)
    for key, value in spec.spark_properties.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Sources that hand on messages in a column, rather than typed rows.
MESSAGE_SOURCES = ("kafka", "socket", "text")


def read_source(spark: SparkSession, spec: JobSpec) -> DataFrame:
    schema = build_schema(spec.input_schema) if spec.source.name not in MESSAGE_SOURCES and spec.input_schema else None
    return read_stream(spark, spec.source.name, spec.source.options, spec.source.path, schema)


def payload_column(spec: JobSpec) -> str | None:
    """The column that holds messages: the one the processor names, or ``value`` of a source of messages. Other sources
    give typed rows, whatever their columns are called, and None."""
    named = spec.properties.get("payload")
    return named or ("value" if spec.source.name in MESSAGE_SOURCES else None)


def _json(spark: SparkSession, df: DataFrame, spec: JobSpec) -> DataFrame:
    mapping, payload = spec.properties.get("outputSchemaPath"), payload_column(spec)
    if payload is None:
        return project(df, load_mapping(spark, mapping))
    schema = infer_schema(spark, spec.properties.get("path"))
    return extract_json(df, schema, load_mapping(spark, mapping), payload)


def _csv(spark: SparkSession, df: DataFrame, spec: JobSpec) -> DataFrame:
    if not spec.input_schema:
        raise ValueError("the csv processor needs a declared input schema")
    mapping, payload = load_mapping(spark, spec.properties.get("outputSchemaPath")), payload_column(spec)
    if payload is None:
        return project(df, mapping)
    fields = spec.properties.get("payloadSchema") or spec.input_schema
    return extract_csv(df, build_schema(fields), mapping, payload)


def _paths(spark: SparkSession, df: DataFrame, spec: JobSpec) -> DataFrame:
    options = dict(spec.properties)
    options.setdefault("value", options.pop("payload", None) or "value")
    if not options.get("templates"):
        raise ValueError("the paths processor needs templates")
    templates = [t if isinstance(t, str) else tuple(t) for t in options.pop("templates")]
    return flatten_paths(df, templates, **options)


PROCESSORS: dict[str, Callable[[SparkSession, DataFrame, JobSpec], DataFrame]] = {
    "json": _json,
    "csv": _csv,
    "paths": _paths,
}


def process(spark: SparkSession, df: DataFrame, spec: JobSpec) -> DataFrame:
    """The job's processor applied to a batch or streaming DataFrame."""
    if spec.processor not in PROCESSORS:
        raise ValueError(f"unknown processor {spec.processor!r}, expected one of {tuple(PROCESSORS)}")
    return PROCESSORS[spec.processor](spark, df, spec)


def run(
    spark: SparkSession, spec: JobSpec | Mapping[str, Any], trigger: Mapping[str, object] | None = None
) -> StreamingQuery:
    """Start the job and return its running query."""
    spec = spec if isinstance(spec, JobSpec) else JobSpec.from_dict(spec)
    processed = process(spark, read_source(spark, spec), spec)
    return sink_writer(processed, spec, trigger).start()


def sink_writer(df: DataFrame, spec: JobSpec, trigger: Mapping[str, object] | None = None) -> DataStreamWriter:
    """The writer of the job's sink; for Kafka, ``metaData`` may name the columns of the key."""
    options = dict(spec.sink.options)
    if spec.sink.path:
        options.setdefault("path", spec.sink.path)
    return write_stream(df, spec.sink.name, options, trigger, spec.sink.key)
