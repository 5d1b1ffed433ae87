"""Three ways to look into a nested record, written as SQL expressions.

Each reader answers the same questions about a record, so the row builder in
``operators.flatten`` is written once. All arguments and results are SQL text:

``instances(node, keys, level)``  the instances of a collection, an array of ``key, value``
``present(node, template)``       is the leaf's key there (a JSON null counts)?
``text(node, template)``          the leaf as text

An object is no leaf, but for the typed reader. SQL text instead of column objects keeps the driver's work small:
one call to Spark per expression instead of thousands.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from itertools import count

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pathloom.plans.templates import MARK, Template

OBJECT = "map<string,variant>"
UNEXPECTED = "__unexpected"
#: JSON as its standard has it: what a variant does not take, from_json must not take either.
STRICT_JSON = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
_ITEMS = "array<struct<ids:array<string>,template:int,text:string>>"
_NODE = f"struct<own:{_ITEMS},below:{_ITEMS}>"
_ENTRIES = f"array<struct<key:string,value:{_NODE}>>"
_VARIABLES = count()
_SPACE = "[ \\t\\r\\n]*"


def sql_text(value: str) -> str:
    """SQL literal of a string."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def sql_name(name: str) -> str:
    """Quoted SQL identifier."""
    return f"`{name.replace('`', '``')}`"


def fresh() -> str:
    """Name of a lambda variable that no other lambda uses."""
    return f"v{next(_VARIABLES)}"


def higher_order(function: str, array: str, body: Callable[[str], str]) -> str:
    variable = fresh()
    return f"{function}({array}, {variable} -> {body(variable)})"


def let(value: str, body: Callable[[str], str], result_type: str) -> str:
    """``body(value)`` with ``value`` evaluated once per row.

    Folding a one-element array does so without deriving the type of ``body`` for every row, as
    taking the element of a transformed array would.
    """
    unused, variable = fresh(), fresh()
    return f"aggregate(array({value}), CAST(NULL AS {result_type}), ({unused}, {variable}) -> {body(variable)})"


def json_path(keys: Iterable[str]) -> str:
    """JSON path of a chain of object keys, quoted so that any key is taken as it is."""
    path = "$"
    for key in keys:
        if '"' in key and "'" in key:
            raise ValueError(f"a key may not hold both kinds of quotes: {key!r}")
        path += f"['{key}']" if '"' in key else f'["{key}"]'
    return path


def variant_part(node: str, keys: Iterable[str], type_name: str) -> str:
    return f"try_variant_get({node}, {sql_text(json_path(keys))}, '{type_name}')"


def may_be_rewritten(text: str) -> str:
    """Might this leaf, parsed as a string, have lost its own form?

    Objects and arrays come out as text, and fractions as the nearest double.
    """
    number = sql_text("^-?[0-9]+[.][0-9]+(E-?[0-9]+)?$")
    return (
        f"(({text} < ':' AND (contains({text}, '.') AND {text} RLIKE {number} OR length({text}) > 38))"
        f" OR {text} IN ('\"Infinity\"', '\"-Infinity\"', '\"NaN\"')"
        f" OR startswith({text}, '[') OR startswith({text}, '{{'))"
    )


class TypedRecord:
    """Reads records parsed with a schema that holds just the wanted leaves, as strings.

    It takes an object for a leaf and a JSON null for no leaf, so it is only right where ``may_hold_odd`` is false
    for the record's text, or ``may_be_rewritten`` for all leaves and ``may_hold_null`` for the text.
    """

    def __init__(self, templates: Sequence[Template], root: Sequence[str]) -> None:
        self.root = tuple(root)
        self.leaves = [t.leaf[-1] for t in templates]
        tree: dict = {}
        for template in templates:
            keys = [*self.root]
            for collection in template.collections:
                keys += [*collection, MARK]
            node = tree
            for key in [*keys, *template.leaf[:-1]]:
                node = node.setdefault(key, {})
                if node is None:
                    raise ValueError(f"{template.path}: a leaf above another leaf")
            if node.setdefault(template.leaf[-1], None) is not None:
                raise ValueError(f"{template.path}: a leaf above another leaf")
        self.tree = tree
        self.schema = self._struct(tree).add(UNEXPECTED, T.StringType())

    @classmethod
    def try_build(cls, templates: Sequence[Template], root: Sequence[str]) -> TypedRecord | None:
        """None where no one schema fits all the templates."""
        try:
            return cls(list(dict.fromkeys(templates)), root)
        except ValueError:
            return None

    def _type(self, node: dict | None) -> T.DataType:
        if node is None:
            return T.StringType()
        if MARK not in node:
            return self._struct(node)
        if len(node) > 1:
            raise ValueError("a fixed key beside instances")
        return T.MapType(T.StringType(), self._type(node[MARK]))

    def _struct(self, node: dict) -> T.StructType:
        if len({key.lower() for key in node}) < len(node):
            raise ValueError("keys that differ in case only")
        return T.StructType([T.StructField(key, self._type(child)) for key, child in node.items()])

    def may_hold_null(self, text: str) -> str:
        """Might the text hold a JSON null at a wanted leaf? An escaped key may be any key."""
        null = sql_text(f'"({self._names()})"{_SPACE}:{_SPACE}null')
        return f"(contains({text}, 'null') AND ({text} RLIKE {null} OR {self._escaped_key(text)}))"

    def may_hold_odd(self, text: str) -> str:
        """Might a wanted leaf be null, an object or array, or a number that a string type would rewrite?

        One scan of the text; where it finds nothing, no leaf needs to be looked at.
        """
        odd = sql_text(f'"({self._names()})"{_SPACE}:{_SPACE}(null|[\\[{{]|-?[0-9]+[.eE]|-?[0-9]{{38}}|"-?(Infinity|NaN)")')
        return f"({text} RLIKE {odd} OR {self._escaped_key(text)})"

    def _names(self) -> str:
        return "|".join(_literal(name) for name in dict.fromkeys(self.leaves))

    def _escaped_key(self, text: str) -> str:
        """Might a key be written with escapes? Plain names can only be by their code points."""
        plain = all(c.isalnum() or c in "_-. " for name in self.leaves for c in name)
        return f"contains({text}, {sql_text(chr(92) + 'u' if plain else chr(92))})"

    def repeats(self, parsed: str) -> str:
        """Is any instance there twice?"""

        def tests(node: str, tree: dict) -> list[str]:
            found = []
            for key, child in tree.items():
                if key == MARK:
                    found.append(f"size(array_distinct(map_keys({node}))) < size({node})")
                    if tests("", child):
                        found.append(higher_order("exists", f"map_values({node})", lambda v: " OR ".join(tests(v, child))))
                elif child is not None:
                    found += tests(f"{node}.{sql_name(key)}", child)
            return found

        return " OR ".join(f"coalesce({test}, false)" for test in tests(parsed, self.tree)) or "false"

    def parse(self, value: Column) -> Column:
        return F.from_json(value, self.schema, {**STRICT_JSON, "columnNameOfCorruptRecord": UNEXPECTED})

    def node(self, parsed: str) -> str:
        return self._field(parsed, self.root)

    def _field(self, node: str, keys: Iterable[str]) -> str:
        return ".".join([node, *map(sql_name, keys)])

    def instances(self, node: str, keys: Sequence[str], level: int) -> str:
        return f"map_entries({self._field(node, keys)})"

    def present(self, node: str, template: Template) -> str:
        return f"{self._field(node, template.leaf)} IS NOT NULL"

    def text(self, node: str, template: Template) -> str:
        return self._field(node, template.leaf)


class VariantRecord:
    """Reads records held as variants; bears any shape and keeps the type of each value."""

    def __init__(self, root: Sequence[str]) -> None:
        self.root = tuple(root)

    def node(self, parsed: str) -> str:
        return variant_part(parsed, self.root, "variant") if self.root else parsed

    def instances(self, node: str, keys: Sequence[str], level: int) -> str:
        return f"map_entries({variant_part(node, keys, OBJECT)})"

    def present(self, node: str, template: Template) -> str:
        leaf = variant_part(node, template.leaf, "variant")
        return f"({leaf} IS NOT NULL AND {variant_part(node, template.leaf, OBJECT)} IS NULL)"

    def text(self, node: str, template: Template) -> str:
        text = variant_part(node, template.leaf, "string")
        object_ = variant_part(node, template.leaf, OBJECT)
        return f"CASE WHEN NOT startswith({text}, '{{') OR {object_} IS NULL THEN {text} END"


class PathRecord:
    """Reads records held as an array of ``(ids, template, text)``, made from a path map.

    Wanted keys are found by one walk of the trie of the templates. Sorting by ids puts the leaves of an instance side by side, so a record is taken apart
    instance by instance instead of searching the whole map for every value.
    """

    def __init__(self, templates: Sequence[Template], id_pattern: str) -> None:
        self.numbers = {t.path: n for n, t in enumerate(templates)}
        self.id_pattern = id_pattern
        self.templates = templates

    def node(self, path_map: str) -> str:
        """Root node of a path map."""
        wanted = sql_text(trie_regex(self.templates, self.id_pattern))
        pruned = higher_order("filter", f"map_entries({path_map})", lambda e: f"{e}.key RLIKE {wanted}")
        of_each = lambda items: ", ".join(self._matches(items, t) for t in self.templates)
        items = let(pruned, lambda leaves: f"sort_array(flatten(array({of_each(leaves)})))", _ITEMS)
        return let(items, lambda i: self._split(i, 0), _NODE)

    def _matches(self, leaves: str, template: Template) -> str:
        at, ids = 0, []
        item = fresh()
        for collection in template.collections:
            at += len(collection) + 1
            ids.append(f"split_part({item}.key, '.', {at})")
        number = self.numbers[template.path]
        matching = higher_order("filter", leaves, lambda e: self._is_of(f"{e}.key", template))
        names = f"CAST(array({', '.join(ids)}) AS array<string>)"
        return (
            f"transform({matching}, {item} -> "
            f"named_struct('ids', {names}, 'template', {number}, 'text', {item}.value))"
        )

    def _is_of(self, key: str, template: Template) -> str:
        """Does a key that some template stands for belong to this one? Mostly its end tells."""
        end = "." + ".".join(template.leaf)
        if sum(t.path.endswith(end) for t in self.templates) == 1:
            return f"endswith({key}, {sql_text(end)})"
        return f"{key} RLIKE {sql_text(template_regex(template, self.id_pattern))}"

    def _split(self, items: str, level: int) -> str:
        own = higher_order("filter", items, lambda i: f"size({i}.ids) = {level}")
        below = higher_order("filter", items, lambda i: f"size({i}.ids) > {level}")
        return f"named_struct('own', {own}, 'below', {below})"

    def instances(self, node: str, keys: Sequence[str], level: int) -> str:
        def cut(items: str) -> str:
            starts = higher_order(
                "filter",
                f"sequence(1, size({items}))",
                lambda at: f"{at} = 1 OR {items}[{at} - 1].ids[{level}] <> {items}[{at} - 2].ids[{level}]",
            )
            return let(starts, lambda marks: f"transform({marks}, {piece(items, marks)})", _ENTRIES)

        def piece(items: str, marks: str) -> str:
            at, n = fresh(), fresh()
            end = f"coalesce(get({marks}, {n} + 1), size({items}) + 1)"
            inside = let(f"slice({items}, {at}, {end} - {at})", lambda i: self._split(i, level + 1), _NODE)
            return f"({at}, {n}) -> named_struct('key', {items}[{at} - 1].ids[{level}], 'value', {inside})"

        return f"CASE WHEN size({node}.below) > 0 THEN {cut(f'{node}.below')} END"

    def _found(self, node: str, template: Template) -> str:
        number = self.numbers[template.path]
        return higher_order("filter", f"{node}.own", lambda i: f"{i}.template = {number}")

    def present(self, node: str, template: Template) -> str:
        return f"size({self._found(node, template)}) > 0"

    def text(self, node: str, template: Template) -> str:
        return f"get({self._found(node, template)}, 0).text"


def template_regex(template: Template, id_pattern: str) -> str:
    """Whole-string regex of the paths a template stands for."""
    parts = [id_pattern if p == MARK else _literal(p) for p in template.path.split(".")]
    return "^" + "[.]".join(parts) + "$"


def trie_regex(templates: Iterable[Template], id_pattern: str) -> str:
    """As ``template_regex`` for any of the templates, as a trie: parts that several begin with are matched once."""
    trie: dict = {}
    for template in templates:
        node = trie
        for part in template.path.split("."):
            node = node.setdefault(part, {})
        node[None] = {}

    def ways_from(node: dict, first: bool) -> str:
        ways = []
        for part, child in node.items():
            if part is None:  # a template ends here
                ways.append("")
            else:
                ways.append(("" if first else "[.]") + (id_pattern if part == MARK else _literal(part)) + ways_from(child, False))
        return ways[0] if len(ways) == 1 else f"(?:{'|'.join(ways)})"

    return f"^{ways_from(trie, True)}$"


def _literal(text: str) -> str:
    return "".join(c if c.isalnum() or c in "_ " else f"\\{c}" if c in "^\\[]&" else f"[{c}]" for c in text)
