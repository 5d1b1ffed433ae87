"""Plain JSON records read in Arrow batches: as path maps, or as the wanted leaves of one schema.

Plain is a valid JSON object whose leaves are texts, integers, booleans and nulls. Whatever is read here comes out as
the SQL of ``operators.pathmap`` reads it, only faster; all else gives NULL and is left to that SQL.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from pathloom.plans.templates import MARK

#: Longer texts, and records that nest deeper, are left to SQL, so that a batch of texts stays small and the limits
#: of Spark's own JSON parser hold.
MAX_BYTES, MAX_DEPTH, MAX_KEY = 1 << 16, 500, 40_000
#: Texts whose leaves are held as Python objects at a time.
PIECE = 256
PATHS = T.MapType(T.StringType(), T.StringType())
_ARROW_PATHS = pa.map_(pa.string(), pa.string())
_LINE_ENDS = re.compile("[\n\r\x85  ]")


class _Odd(ValueError):
    """The record is not plain."""


def _odd(_):
    raise _Odd


def _whole(text: str) -> str:
    if len(text) > 18 or text == "-0":
        raise _Odd
    return text


#: Of a key repeated in one object the last value counts, as in any dict.
_read = json.JSONDecoder(parse_int=_whole, parse_float=_odd, parse_constant=_odd).decode


def _text(value) -> str | None:
    if value is True or value is False:
        return "true" if value else "false"
    if type(value) is list:
        raise _Odd
    return value


def _first_of_each_path(node: dict) -> dict[str, str | None]:
    """Of leaves with one path, that under the smaller keys."""
    ends, level = [], [((), node)]
    while level:
        keys, node = level.pop()
        for key, value in node.items():
            (level if type(value) is dict else ends).append(((*keys, key), value))
    found: dict[str, str | None] = {}
    for keys, value in sorted(ends, key=lambda e: e[0]):
        found.setdefault(".".join(keys), _text(value))
    return found


def leaves(text: str | None, root: Sequence[str] = ()) -> dict[str, str | None] | None:
    """Dotted path to text of every leaf below ``root``; None for a record that is not plain, or has no leaf."""
    if text is None or "\\u" in text:
        return None
    try:
        node = _read(text)
        for key in root:
            node = node[key] if type(node) is dict and key in node else None
        if type(node) is not dict:
            return None
        top = node
        found: dict[str, str | None] = {}
        count, level, below = 0, [("", top)], []
        for _ in range(MAX_DEPTH):
            for prefix, node in level:
                for key, value in node.items():
                    if type(value) is dict:
                        below.append((f"{prefix}{key}.", value))
                    else:
                        found[prefix + key] = _text(value)
                        count += 1
            if not below:
                if len(found) < count:
                    found = _first_of_each_path(top)
                long = len(text) > MAX_KEY and any(len(path) > MAX_KEY for path in found)
                return found if found and not long else None
            level, below = below, []
    except (ValueError, RecursionError):
        pass
    return None


def _short(text: Column) -> Column:
    """The text where an Arrow batch can take it."""
    return F.when((F.octet_length(text) <= MAX_BYTES) & F.is_valid_utf8(text), text)


def _in_pieces(texts: pa.Array, work: Callable[[list], pa.Array], kind: pa.DataType) -> pa.Array:
    made = [work(texts.slice(n, PIECE).to_pylist()) for n in range(0, len(texts), PIECE)]
    return pa.concat_arrays(made) if made else pa.array([], kind)


def plain_paths(text: Column, root: Sequence[str]) -> Column:
    """``map<string,string>`` of the leaves of plain records."""
    root = tuple(root)

    def maps(texts: list) -> pa.Array:
        places, keys, values = [], [], []
        for found in (leaves(t, root) for t in texts):
            places.append(None if found is None else len(keys))
            if found is not None:
                keys += found
                values += found.values()
        offsets = pa.array([*places, len(keys)], pa.int32())
        return pa.MapArray.from_arrays(offsets, pa.array(keys, pa.string()), pa.array(values, pa.string())).cast(_ARROW_PATHS)

    @F.arrow_udf(PATHS)
    def read(texts: pa.Array) -> pa.Array:
        return _in_pieces(texts, maps, _ARROW_PATHS)

    return read(_short(text))


def plain_record(text: Column, root: Sequence[str], tree: dict, schema: T.StructType, any_ids: bool) -> Column:
    """The wanted leaves of plain records as ``schema``, instances in text order of their ids.

    ``tree`` has the keys of the wanted paths, ``MARK`` for instances and None for leaves (see ``TypedRecord``). Records
    with a null at a wanted leaf are not read, as no leaf and a null are one in the schema.
    """
    root, kind = tuple(root), to_arrow_type(schema)

    def taken(found: dict[str, str | None]) -> dict | None:
        result: dict = {}
        for path, value in found.items():
            node, at = result, tree
            parts = path.split(".")
            places = []
            for part in parts:
                if at is None:  # below a leaf
                    break
                if MARK in at:
                    if not (part if any_ids else part.isascii() and part.isdigit()):
                        break
                    places.append((part, True))
                    at = at[MARK]
                elif part in at:
                    places.append((part, False))
                    at = at[part]
                else:
                    break
            else:
                if at is not None:
                    continue
                if value is None:
                    return None
                for part, _ in places[:-1]:
                    node = node.setdefault(part, {})
                node[places[-1][0]] = value
        return result

    def ordered(node: dict, at: dict):
        if MARK in at:
            inner = at[MARK]
            return [(key, node[key] if inner is None else ordered(node[key], inner)) for key in sorted(node)]
        return {key: value if at[key] is None else ordered(value, at[key]) for key, value in node.items()}

    def record(text: str | None) -> dict | None:
        found = leaves(text, root)
        if found is None or ((not text.isascii() or "\\" in text) and any(map(_LINE_ENDS.search, found))):
            return None
        found = taken(found)
        return None if found is None else ordered(found, tree)

    @F.arrow_udf(schema)
    def read(texts: pa.Array) -> pa.Array:
        return _in_pieces(texts, lambda t: pa.array([record(x) for x in t], kind), kind)

    return read(_short(text))
