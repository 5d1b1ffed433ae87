"""Declared type names, schemas built from them, and casts that never fail a job."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The type names a job may declare.
TYPE_NAMES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "long": T.LongType(),
    "short": T.ShortType(),
    "byte": T.ByteType(),
    "date": T.DateType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
}
_DECIMAL = re.compile(r"decimal\(\s*(\d+)\s*,\s*(\d+)\s*\)")
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_TEXT_WITH_DECIMAL_TAIL = r"^\s*[+-]?[0-9]+[.][0-9]*\s*$"

FieldList = Iterable[tuple[str, str] | Mapping[str, str]]


def data_type(name: str) -> T.DataType:
    """Spark type of a declared type name; the match is case-sensitive."""
    if name in TYPE_NAMES:
        return TYPE_NAMES[name]
    decimal = _DECIMAL.fullmatch(name)
    if decimal is None:
        raise ValueError(f"unknown type name: {name!r}")
    precision, scale = map(int, decimal.groups())
    if not 1 <= precision <= 38 or scale > precision:
        raise ValueError(f"decimal out of range: {name!r}")
    return T.DecimalType(precision, scale)


def struct_field(name: str, type_name: str) -> T.StructField:
    """Nullable field of an input schema; the type name may be in any case."""
    return T.StructField(name, data_type(str(type_name).lower()), True)


def build_schema(fields: FieldList) -> T.StructType:
    """Schema from ordered ``(name, type)`` pairs or one-entry ``{name: type}`` mappings."""
    pairs = [p for f in fields for p in (f.items() if isinstance(f, Mapping) else [tuple(f)])]
    return T.StructType([struct_field(name, type_name) for name, type_name in pairs])


def permissive_cast(column: Column, target: T.DataType, source: T.DataType | None = None) -> Column:
    """Cast that turns text it cannot read into NULL, whatever the session's ANSI mode.

    Text such as ``'3.7'`` becomes 3 for the integer types. ``source`` is the type of
    ``column`` where the caller knows it; text is assumed otherwise.
    """
    if isinstance(target, _INTEGRAL) and isinstance(source or T.StringType(), T.StringType):
        column = F.when(
            column.rlike(_TEXT_WITH_DECIMAL_TAIL), F.split_part(F.trim(column), F.lit("."), F.lit(1))
        ).otherwise(column)
    return column.try_cast(target)
