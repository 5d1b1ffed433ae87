"""Records as maps from dotted path to text."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pathloom.functions.leaves import plain_paths
from pathloom.functions.records import OBJECT, STRICT_JSON, higher_order, json_path, may_be_rewritten, trie_regex
from pathloom.plans.templates import TemplateSpec, normalise

ID_PATTERNS = {"numeric": "[0-9]+", "any": "[^.]+"}
#: Stands before the text of strings while JSON is read as string maps.
STRING_MARK = "~"
_IN_STRING = r'(?:[^"\\]++|\\.)*+'
_LEAVES = "array<struct<keys:array<string>,value:string>>"


def root_keys(root: str | Sequence[str] | None) -> tuple[str, ...]:
    """Key chain of a sub-tree: dotted text, or the keys themselves where they hold dots."""
    if not root:
        return ()
    return tuple(root.split(".")) if isinstance(root, str) else tuple(root)


def path_map(value: Column, root: str | Sequence[str] | None = None) -> Column:
    """``map<string,string>`` of every leaf of a JSON text, keyed by its dotted path.

    Objects may nest to any depth. Strings are taken as they are, numbers and booleans as text, JSON
    null as NULL and arrays as JSON text. An empty object has no leaf. Text that is no JSON object gives
    NULL. Of two equal paths (a key ``A.B`` beside ``{"A": {"B": …}}``) that under the smaller key stays,
    ``A``; of a key repeated in one object the last value counts.

    Plain records are read in Arrow batches, the others by ``sql_path_map``. As a Python function reads the batches, the
    column can stand anywhere but in a lambda.
    """
    keys = root_keys(root)
    return F.coalesce(plain_paths(value, keys), sql_path_map(value, keys))


def sql_path_map(value: Column, keys: Sequence[str] = ()) -> Column:
    """``path_map`` in SQL alone, for records of any shape."""
    top = F.try_variant_get(F.try_parse_json(value), json_path(keys), OBJECT)
    leaves = _leaves(value, F.map_entries(top), _variant_entries, lambda v: F.try_variant_get(v, "$", "string"))
    return F.coalesce(_by_path(leaves), string_path_map(value, keys))


def string_path_map(value: Column, keys: Sequence[str] = ()) -> Column:
    """The path map of JSON that a variant cannot hold (repeated keys, very large), read as nested string maps.

    One scan puts ``STRING_MARK`` before the text of every string, so that the first character of a value, as
    a string map holds it, tells a string from the object or array it may look like.
    """
    text = F.regexp_replace(value, f'"({_IN_STRING})"', f'"{STRING_MARK}$1"')
    for key in keys:
        text = F.try_element_at(F.filter(_string_entries(text), partial(_is_under, key)), F.lit(-1)).getField("value")
    leaves = _leaves(value, _string_entries(text), _string_entries, _string_text)
    return F.when(F.try_parse_json(value).isNull(), _by_path(leaves))


def _is_under(key: str, entry: Column) -> Column:
    return entry.getField("key") == key


def _let(value: Column, body: Callable[[Column], Column], result_type: str) -> Column:
    """``body(value)`` with ``value`` made once: a fold over one element."""
    return F.aggregate(F.array(value), F.lit(None).cast(result_type), lambda _, found: body(found))


def _depth(text: Column) -> Column:
    """How many braces nest in the text, outside of strings."""
    braces = F.regexp_replace(F.regexp_replace(text, f'"{_IN_STRING}"', ""), "[^{}]", "")
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def step(acc: Column, brace: Column) -> Column:
        now = acc.getField("now") + F.when(brace == "{", 1).when(brace == "}", -1).otherwise(0)
        return F.struct(now.alias("now"), F.greatest(acc.getField("most"), now).alias("most"))

    return F.aggregate(F.split(braces, ""), start, step, lambda acc: acc.getField("most"))


def _leaves(text: Column, entries: Column, inner: Callable[[Column], Column], leaf: Callable[[Column], Column]) -> Column:
    """``keys, value`` of every leaf below the entries of an object.

    A fold with two lists: nodes not looked at yet, with their entries where they are objects, and finished leaves. So
    every node is opened once, one level a step; ``inner`` gives the entries of an object, NULL for any other value.
    """

    def nodes(above: Column | None, found: Column) -> Column:
        def node(e: Column) -> Column:
            own = F.array(e.getField("key"))
            keys = own if above is None else F.concat(above, own)
            return F.struct(keys.alias("keys"), e.getField("value").alias("value"), inner(e.getField("value")).alias("inner"))

        return F.transform(found, node)

    def finished(items: Column) -> Column:
        plain = F.filter(items, lambda i: i.getField("inner").isNull())
        return F.transform(plain, lambda i: F.struct(i.getField("keys").alias("keys"), leaf(i.getField("value")).alias("value")))

    def step(acc: Column, _: Column) -> Column:
        items, done = acc.getField("items"), acc.getField("done")
        opened = F.filter(items, lambda i: i.getField("inner").isNotNull())
        below = F.flatten(F.transform(opened, lambda i: nodes(i.getField("keys"), i.getField("inner"))))
        return F.when(F.size(items) == 0, acc).otherwise(F.struct(below.alias("items"), F.concat(done, finished(items)).alias("done")))

    depth = _depth(text)
    levels = F.when(depth > 1, F.sequence(F.lit(2), depth)).otherwise(F.array().cast("array<int>"))
    start = F.struct(nodes(None, entries).alias("items"), F.array().cast(_LEAVES).alias("done"))
    return F.aggregate(levels, start, step, lambda acc: F.concat(acc.getField("done"), finished(acc.getField("items"))))


def flat_keys(df: DataFrame, value: Column, keep: Sequence[str], root: Sequence[str], name: str) -> DataFrame:
    """``keep`` and, as column ``name``, the path map of records whose keys are dotted paths.

    Many records are plain maps of texts and numbers, which a string map reads whole and fast;
    ``sql_path_map`` reads those with a leaf that a string would rewrite.
    """
    schema: T.DataType = T.MapType(T.StringType(), T.StringType())
    for key in reversed(root):
        schema = T.StructType([T.StructField(key, schema)])
    texts = reduce(Column.getField, root, F.from_json(F.col("__text"), schema, STRICT_JSON))
    rewritten = higher_order("exists", "map_values(__texts)", may_be_rewritten)
    repeated = "size(array_distinct(map_keys(__texts))) < size(__texts)"
    plain = F.expr(f"__texts IS NOT NULL AND NOT coalesce({rewritten} OR {repeated}, false)")
    return (
        df.select(*keep, value.alias("__text"))
        .select(*keep, "__text", texts.alias("__texts"))
        .select(*keep, F.when(plain, F.col("__texts")).otherwise(sql_path_map(F.col("__text"), root)).alias(name))
    )


def _variant_entries(value: Column) -> Column:
    return F.map_entries(F.try_variant_get(value, "$", OBJECT))


def _string_entries(value: Column) -> Column:
    """Entries of an object's marked text, without the marks of their keys; of a repeated key the last."""
    object_ = F.when(F.ltrim(value).startswith("{"), value)
    items = F.map_entries(F.from_json(object_, T.MapType(T.StringType(), T.StringType()), STRICT_JSON))

    def once(found: Column) -> Column:
        def placed(e: Column, n: Column) -> Column:
            return F.struct(F.substring(e.getField("key"), 2, 1 << 30).alias("key"), (-n).alias("place"), e.getField("value").alias("value"))

        return F.map_entries(_first_of_each_key(F.transform(found, placed)))

    return _let(items, once, "array<struct<key:string,value:string>>")


def _string_text(value: Column) -> Column:
    """The text of a marked leaf."""
    array = F.regexp_replace(value, f'"{STRING_MARK}({_IN_STRING})"', '"$1"')
    return F.when(value.startswith(STRING_MARK), F.substring(value, 2, 1 << 30)).when(value.startswith("["), array).otherwise(value)


def _by_path(leaves: Column) -> Column:
    def named(e: Column) -> Column:
        keys = e.getField("keys")
        return F.struct(F.array_join(keys, ".").alias("key"), keys.alias("place"), e.getField("value").alias("value"))

    return _let(F.transform(leaves, named), _first_of_each_key, "map<string,string>")


def _first_of_each_key(items: Column) -> Column:
    """A map of ``key, place, value``; of a repeated key the value of the smallest place."""
    keys = items.getField("key")
    unique = F.size(F.array_distinct(keys)) == F.size(keys)
    pair = lambda e: F.struct(e.getField("key"), e.getField("value"))

    def firsts(ordered: Column) -> Column:
        new = lambda e, n: (n == 0) | (F.get(ordered, n - 1).getField("key") != e.getField("key"))
        return F.map_from_entries(F.transform(F.filter(ordered, new), pair))

    return F.when(unique, F.map_from_entries(F.transform(items, pair))).otherwise(_let(F.sort_array(items), firsts, "map<string,string>"))


def prune_paths(
    paths: Column, templates: Iterable[TemplateSpec], ids: str = "numeric"
) -> Column:
    """The part of a path map that any of the templates asks for."""
    wanted = trie_regex(normalise(templates), ID_PATTERNS[ids])
    return F.map_filter(paths, lambda key, _: key.rlike(wanted))
