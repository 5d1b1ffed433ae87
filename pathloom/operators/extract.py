"""Payload extraction: message text to a typed table by a list of output columns."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pathloom.functions.records import OBJECT, json_path, sql_name
from pathloom.functions.types import data_type, permissive_cast
from pathloom.sources.readers import read_csv, read_json


class OutputColumn(NamedTuple):
    name: str
    path: str
    type: str


MappingRows = Iterable[Sequence[str]]
UNREAD = "__unread"


def infer_schema(spark: SparkSession, sample_path: str | None) -> T.StructType:
    """Schema of a sample document."""
    if not sample_path:
        raise ValueError("a path to a sample document is needed to infer the message schema")
    return read_json(spark, sample_path).schema


def infer_all(df: DataFrame, value: str = "value") -> T.StructType:
    """Schema that fits all messages of a column of JSON text, bytes or variants, not just a sample.

    One pass: the schemas of messages are merged by an aggregate, and only their union comes to the driver. Fields that
    are NULL in all messages, and those whose types no one type fits, are strings; messages that are no JSON objects
    tell nothing.
    """
    data = _variant(df, value)
    merged = df.select(F.when(F.try_variant_get(data, "$", OBJECT).isNotNull(), data).alias("v")).agg(F.schema_of_variant_agg("v")).first()[0]
    if not merged.startswith("OBJECT<"):
        return T.StructType()
    plain = re.sub(r"`(?:[^`]|``)*`|\b(OBJECT|VOID|VARIANT)\b(?! *:)", lambda m: {"OBJECT": "STRUCT", "VOID": "STRING", "VARIANT": "STRING"}.get(m.group(1), m.group()), merged)
    return T._parse_datatype_string(plain)


def load_mapping(spark: SparkSession, path: str | None) -> list[OutputColumn]:
    """Output columns from headerless CSV rows ``name,path,type``.

    The rows are the columns of one table, so bringing them to the driver is bounded. A type
    that holds a comma, such as ``"decimal(10,2)"``, must be quoted.
    """
    if not path:
        raise ValueError("a path to the output columns is needed")
    return check_mapping([tuple(r) for r in read_csv(spark, path).collect()])


def check_mapping(rows: MappingRows) -> list[OutputColumn]:
    mapping = []
    for row in rows:
        if len(row) != 3:
            raise ValueError(f"expected name, path and type: {tuple(row)}")
        mapping.append(OutputColumn(*row))
    if not mapping:
        raise ValueError("no output columns")
    names = [c.name for c in mapping]
    if len(set(names)) != len(names):
        raise ValueError(f"output names used twice: {sorted({n for n in names if names.count(n) > 1})}")
    return mapping


def split_path(path: str) -> list[str]:
    """Keys of a dotted path; back-ticks keep the dots of a key, as in ``a.`b.c```."""
    keys, rest = [], path
    while rest:
        if rest.startswith("`"):
            key, found, rest = rest[1:].partition("`")
            if not found or (rest and not rest.startswith(".")):
                raise ValueError(f"unbalanced back-ticks: {path!r}")
            rest = rest[1:]
        else:
            key, _, rest = rest.partition(".")
        if not key:
            raise ValueError(f"empty key in path {path!r}")
        keys.append(key)
    if not keys:
        raise ValueError("empty path")
    return keys


def payload_text(value: str | Column = "value") -> Column:
    """Message payload, bytes or text, as text."""
    return (F.col(value) if isinstance(value, str) else value).cast("string")


def parse_json(df: DataFrame, schema: T.StructType, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """One row per message with the fields of ``schema``; what cannot be read is NULL."""
    parsed = df.select(*keep, F.from_json(payload_text(value), schema).alias("__data"))
    return parsed.select(*keep, "__data.*")


def parse_csv(
    df: DataFrame,
    schema: T.StructType,
    value: str = "value",
    keep: Sequence[str] = (),
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """As ``parse_json`` for one line of CSV per message."""
    parsed = df.select(*keep, F.from_csv(payload_text(value), _ddl(schema), dict(options or {})).alias("__data"))
    return parsed.select(*keep, "__data.*")


def project(
    df: DataFrame, mapping: MappingRows, keep: Sequence[str] = (), *, observe: Observation | str | None = None
) -> DataFrame:
    """The output columns, in order, each cast without failing; all else but ``keep`` is dropped.

    Every path is read from ``df`` as it came, so an output name may equal a source field. ``observe`` as in
    ``extract_json``.
    """
    exact = _case_sensitive(df)
    return _projected(df, keep, [_output(df.schema, c, exact) for c in check_mapping(mapping)], observe)


def extract_json(
    df: DataFrame,
    schema: T.StructType,
    mapping: MappingRows,
    value: str = "value",
    keep: Sequence[str] = (),
    *,
    observe: Observation | str | None = None,
    rejects: str | None = None,
) -> DataFrame:
    """Parse JSON messages and project them; rows out = rows in.

    Only the part of ``schema`` that ``mapping`` asks for is parsed. A column of variants is taken as it is.

    ``observe`` counts, for every output column, the values the cast could not read (not NULL before, NULL
    after), on the way and without a further pass: an ``Observation`` for a batch, a name for a stream, whose
    progress then reports the counts under it.

    ``rejects`` names a further column: the text of messages that are no JSON object or have a wanted field of
    another type, NULL for all others. ``split_rejects`` and ``write_with_rejects`` part the two.
    """
    mapping = check_mapping(mapping)
    exact = _case_sensitive(df)
    paths = [resolved_path(schema, split_path(c.path), exact) for c in mapping]
    if isinstance(df.schema[value].dataType, T.VariantType):
        outputs = [_variant_output(schema, c, p, F.col(value)) for c, p in zip(mapping, paths)]
        bad = F.try_variant_get(value, "$", OBJECT).isNull() & F.col(value).isNotNull()
        for path, output in zip(paths, outputs):
            held = F.try_variant_get(value, json_path(path), "variant") if _plain(schema, path) else F.lit(None)
            bad = bad | (held.isNotNull() & ~F.is_variant_null(held) & output.source.isNull())
        more = [] if rejects is None else [F.when(bad, payload_text(value)).alias(rejects)]
        return _projected(df, [*keep, *more], outputs, observe, [*keep, *([rejects] if rejects else [])])
    wanted = prune_schema(schema, paths)
    options = {}
    if rejects is not None:
        wanted, options = wanted.add(UNREAD, T.StringType()), {"columnNameOfCorruptRecord": UNREAD}
    parsed = df.select(*keep, F.from_json(payload_text(value), wanted, options).alias("__data"))
    return _tagged(parsed, wanted, mapping, keep, exact, observe, rejects)


def extract_csv(
    df: DataFrame,
    schema: T.StructType,
    mapping: MappingRows,
    value: str = "value",
    keep: Sequence[str] = (),
    options: Mapping[str, str] | None = None,
    *,
    observe: Observation | str | None = None,
    rejects: str | None = None,
) -> DataFrame:
    """As ``extract_json`` for CSV payloads. Rows that a source has split into typed columns are for ``project``."""
    mapping, exact, options = check_mapping(mapping), _case_sensitive(df), dict(options or {})
    wanted = schema
    if rejects is not None:
        wanted, options = T.StructType([*schema.fields, T.StructField(UNREAD, T.StringType())]), {**options, "columnNameOfCorruptRecord": UNREAD}
    parsed = df.select(*keep, F.from_csv(payload_text(value), _ddl(wanted), options).alias("__data"))
    return _tagged(parsed, wanted, mapping, keep, exact, observe, rejects)


class Extraction(NamedTuple):
    """Rows of all messages, and the texts of those that could not be read whole."""

    rows: DataFrame
    rejects: DataFrame


def split_rejects(df: DataFrame, column: str, keep: Sequence[str] = ()) -> Extraction:
    """``df`` without its column of rejected texts, and ``keep`` and that column where there is one.

    Each is planned by itself; to write both from one pass use ``write_with_rejects``.
    """
    return Extraction(df.drop(column), df.where(F.col(column).isNotNull()).select(*keep, column))


def _ddl(schema: T.StructType) -> str:
    return ",".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema)


def _variant(df: DataFrame, value: str) -> Column:
    return F.col(value) if isinstance(df.schema[value].dataType, T.VariantType) else F.try_parse_json(payload_text(value))


class _Output(NamedTuple):
    name: str
    source: Column
    result: Column


def _tagged(
    parsed: DataFrame, schema: T.StructType, mapping: list[OutputColumn], keep: Sequence[str], exact: bool, observe: Observation | str | None, rejects: str | None
) -> DataFrame:
    """The output columns of ``__data``, and its unread text as column ``rejects``."""
    outputs = [_output(schema, c, exact, F.col("__data")) for c in mapping]
    more = [] if rejects is None else [F.col("__data").getField(UNREAD).alias(rejects)]
    return _projected(parsed, [*keep, *more], outputs, observe, [*keep, *([rejects] if rejects else [])])


def _projected(df: DataFrame, first: Sequence[str | Column], outputs: list[_Output], observe: Observation | str | None, names: Sequence[str] | None = None) -> DataFrame:
    """``first`` and the outputs; with ``observe`` the values that casts lose are counted per output on the way."""
    results = [o.result.alias(o.name) for o in outputs]
    if observe is None:
        return df.select(*first, *results)
    lost = [(o.source.isNotNull() & o.result.isNull()).alias(f"l{n}") for n, o in enumerate(outputs)]
    counted = df.select(*first, *results, F.struct(*lost).alias("__lost"))
    counted = counted.observe(observe, *[F.count_if(F.col(f"__lost.l{n}")).alias(o.name) for n, o in enumerate(outputs)])
    return counted.select(*(names if names is not None else first), *[F.col(sql_name(o.name)) for o in outputs])


def prune_schema(schema: T.StructType, paths: Sequence[Sequence[str]]) -> T.StructType:
    """The fields of ``schema`` that lie on any of the paths."""

    def prune(node: T.DataType, below: list[Sequence[str]]) -> T.DataType:
        if any(not rest for rest in below):
            return node
        if isinstance(node, T.ArrayType):
            return T.ArrayType(prune(node.elementType, below), node.containsNull)
        if isinstance(node, T.MapType):
            return T.MapType(node.keyType, prune(node.valueType, [r[1:] for r in below]))
        if not isinstance(node, T.StructType):
            return node
        kept = []
        for field in node:
            rest = [path[1:] for path in below if path[0] == field.name]
            if rest:
                kept.append(T.StructField(field.name, prune(field.dataType, rest), True))
        return T.StructType(kept)

    return prune(schema, list(paths))


def path_type(schema: T.DataType, path: Sequence[str]) -> T.DataType:
    """Type found at a path; a path through an array gives an array."""
    node = schema
    for n, key in enumerate(path):
        if isinstance(node, T.ArrayType):
            return T.ArrayType(path_type(node.elementType, path[n:]))
        if isinstance(node, T.MapType):
            node = node.valueType
            continue
        if not isinstance(node, T.StructType) or key not in node.names:
            raise ValueError(f"no field {'.'.join(path)!r} in the message schema")
        node = node[key].dataType
    return node


def _case_sensitive(df: DataFrame) -> bool:
    return df.sparkSession.conf.get("spark.sql.caseSensitive").lower() == "true"


def resolved_path(schema: T.DataType, path: Sequence[str], exact: bool) -> list[str]:
    """A path with the fields' own spelling, found as the session finds columns; keys of maps stay as they are."""
    node, out = schema, []
    for key in path:
        while isinstance(node, T.ArrayType):
            node = node.elementType
        if isinstance(node, T.StructType):
            same = [n for n in node.names if n == key or not exact and n.lower() == key.lower()]
            if len(same) > 1 and key not in same:
                raise ValueError(f"{'.'.join(path)!r} may be any of {same}")
            key = key if key in same else same[0] if same else key
            node = node[key].dataType if same else None
        else:
            node = node.valueType if isinstance(node, T.MapType) else None
        out.append(key)
    return out


def _output(schema: T.StructType, column: OutputColumn, exact: bool, parent: Column | None = None) -> _Output:
    keys = resolved_path(schema, split_path(column.path), exact)
    source = path_type(schema, keys)
    if parent is None:
        parent, keys = F.col(sql_name(keys[0])), keys[1:]
    found = reduce(Column.getItem, keys, parent)
    return _Output(column.name, found, permissive_cast(found, data_type(column.type), source))


def _plain(schema: T.StructType, path: Sequence[str]) -> bool:
    """Does no array lie on the way?"""
    return not any(isinstance(path_type(schema, path[:n]), T.ArrayType) for n in range(1, len(path)))


def _variant_output(schema: T.StructType, column: OutputColumn, path: Sequence[str], value: Column) -> _Output:
    """Read from a variant: up to the first array in the schema's type, from there on as a field of all its elements."""
    at = next((n for n in range(1, len(path)) if isinstance(path_type(schema, path[:n]), T.ArrayType)), len(path))
    rest = list(path[at:])
    held = prune_schema(T.StructType([T.StructField("held", path_type(schema, path[:at]))]), [["held", *rest]])["held"].dataType
    found = reduce(Column.getItem, rest, F.try_variant_get(value, json_path(path[:at]), held.simpleString()))
    return _Output(column.name, found, permissive_cast(found, data_type(column.type), path_type(schema, path)))
