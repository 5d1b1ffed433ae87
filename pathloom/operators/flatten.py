"""Wildcard-path flattening: one row per instance of a nested collection.

Everything is one expression over the record's own text followed by one ``inline``: no
shuffle, no state, one scan and one parse, the same on batch and streaming DataFrames.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pathloom.functions.leaves import plain_record
from pathloom.functions.records import (
    UNEXPECTED,
    PathRecord,
    TypedRecord,
    VariantRecord,
    higher_order,
    let,
    may_be_rewritten,
    sql_name,
    sql_text,
)
from pathloom.operators.pathmap import ID_PATTERNS, flat_keys, root_keys, sql_path_map, string_path_map
from pathloom.plans.templates import RowGroup, Template, TemplateSpec, id_columns, plan_groups

SPINES = ("driver", "any")
STRATEGIES = ("auto", "variant", "path_map")
LAYOUTS = ("nested", "flat")
#: Column of a row group's number, and how many instances of others a record may be given.
GROUP, MAX_INSTANCES = "__group", 10_000
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


def flatten_paths(
    df: DataFrame,
    templates: Iterable[TemplateSpec],
    value: str = "value",
    *,
    keep: Sequence[str] = (),
    root: str | Sequence[str] | None = None,
    mode: str = "ancestors",
    spine: str = "driver",
    ids: str = "numeric",
    id_names: Mapping[str, str] | None = None,
    layout: str = "nested",
    strategy: str = "auto",
    ordered: bool = False,
    position: str | None = None,
    keep_absent: bool = False,
    max_instances: int = MAX_INSTANCES,
) -> DataFrame:
    """Turn records into rows, one per instance, for all row groups of the templates together.

    Columns: ``keep``, one id column per collection, one column per template alias; all but
    ``keep`` are strings, and columns a row has nothing for are NULL.

    The rows of a record and group are the instances of the innermost collection that hold the
    *driver*, the first template found there (``spine="driver"``), or any template
    (``spine="any"``). Records without an innermost match fall back to the next collection
    outwards. A group without a collection gives one row per record, whatever the record holds.

    ``root`` is the sub-tree to start from, ``ids`` says which instance names count
    (``"numeric"`` or ``"any"``), ``id_names`` renames id columns, ``layout="flat"`` reads
    records whose keys already are dotted paths, and ``ordered`` puts the rows of each record
    and group in text order of their ids; ``position`` names a column with the place of a row in its record, from 0.

    ``strategy`` never changes the result. ``"auto"`` parses into a schema of the wanted leaves
    and reads only records that do not fit it, or may lose by it, as variants; ``"variant"``
    does so with all; ``"path_map"`` goes through ``path_map`` and so also finds keys that hold
    dots themselves.

    ``keep_absent`` gives every record, for each group, also the instances that only rows of other records
    have: with their ids and the leaves outside any collection, all else NULL. It takes a first pass over
    the table, so it is refused on streams, and more than ``max_instances`` instances of a group raise an
    error, as they would multiply the rows.
    """
    options = _Options(value, tuple(keep), root, spine, ids, id_names, layout, strategy, ordered, position)
    groups = plan_groups(templates, mode)
    if keep_absent:
        return _with_absent(df, groups, options, max_instances)
    return _flatten(df, groups, options)


class GroupTables(Sequence[DataFrame]):
    """The row groups of a table of records, a DataFrame each, with just its own columns.

    A group taken by itself is planned by itself and parses its own leaves only. To have several at once, ``union``
    and ``store`` plan one scan and one parse for all: one generator makes the rows of all groups with the number
    of their group.
    """

    def __init__(self, df: DataFrame, groups: list[RowGroup], options: _Options) -> None:
        self._df, self._groups, self._options = df, groups, options
        self._names = id_columns(groups, options.id_names)

    def __len__(self) -> int:
        return len(self._groups)

    def __getitem__(self, n):
        return [self[i] for i in range(len(self))[n]] if isinstance(n, slice) else _flatten(self._df, [self._groups[n]], self._options)

    def columns(self, n: int) -> list[str]:
        """Columns of group ``n``."""
        return [*self._options.keep, *self._names[n], *sorted(t.alias for t in self._groups[n].templates)]

    def tagged(self, tag: str = GROUP) -> DataFrame:
        """The rows of all groups with the number of their group in column ``tag``; all columns but ``keep`` that a group lacks are NULL."""
        return _flatten(self._df, self._groups, self._options, tag=tag)

    def union(self, wanted: Iterable[int] | None = None) -> DataFrame:
        """The rows of all, or of the wanted, groups with the columns of any of them, from one scan."""
        chosen = sorted(set(range(len(self)) if wanted is None else wanted))
        return _flatten(self._df, [self._groups[n] for n in chosen], self._options)

    def store(self, path: str, mode: str = "errorifexists") -> list[DataFrame]:
        """Writes all groups as Parquet below ``path``, a folder each, from one scan; returns them as read from there.

        A task holds a file open for each group, so that it need not sort its rows by group, which would take memory
        for all of them.
        """
        if self._df.isStreaming:
            raise ValueError("a stream is written by a sink; partition it by the column of tagged()")
        rows = self.tagged()
        conf = self._df.sparkSession.conf
        files = conf.get(OPEN_FILES)
        conf.set(OPEN_FILES, max(int(files), len(self)))
        try:
            rows.write.partitionBy(GROUP).mode(mode).parquet(path)
        finally:
            conf.set(OPEN_FILES, files)
        stored = self._df.sparkSession.read.schema(rows.schema).parquet(path)
        return [stored.where(F.col(GROUP) == n).select(*map(_quoted, self.columns(n))) for n in range(len(self))]


def flatten_groups(
    df: DataFrame, templates: Iterable[TemplateSpec], value: str = "value", *, mode: str = "ancestors", **options
) -> GroupTables:
    """As ``flatten_paths``, but a DataFrame with just its own columns for each row group (see ``GroupTables``)."""
    return GroupTables(df, plan_groups(templates, mode), _Options(value, **options))


@dataclass(frozen=True)
class _Options:
    value: str = "value"
    keep: Sequence[str] = ()
    root: str | Sequence[str] | None = None
    spine: str = "driver"
    ids: str = "numeric"
    id_names: Mapping[str, str] | None = None
    layout: str = "nested"
    strategy: str = "auto"
    ordered: bool = False
    position: str | None = None

    def __post_init__(self) -> None:
        for given, allowed in ((self.spine, SPINES), (self.ids, ID_PATTERNS), (self.layout, LAYOUTS), (self.strategy, STRATEGIES)):
            if given not in allowed:
                raise ValueError(f"{given!r} is none of {tuple(allowed)}")


def _quoted(name: str) -> Column:
    return F.col(sql_name(name))


def _flatten(df: DataFrame, groups: list[RowGroup], options: _Options, tag: str | None = None) -> DataFrame:
    return _spread(*_rows(df, groups, options, tag), options)


def _spread(df: DataFrame, rows: str, options: _Options) -> DataFrame:
    """A row for each element of ``rows``, an array as SQL text.

    The array is made by the generator itself. A projection of its own for it would be merged by the optimizer with those
    below, and the plan would hold their expressions once for each use.
    """
    if options.position is None:
        return df.select(*options.keep, F.expr(f"inline({rows})"))
    placed = df.select(*options.keep, F.expr(f"posexplode({rows})").alias("__place", "__row"))
    return placed.select(*options.keep, "__row.*", F.col("__place").alias(options.position))


def _with_absent(df: DataFrame, groups: list[RowGroup], options: _Options, most: int) -> DataFrame:
    """The rows of every record and, for instances that only other records have, rows without values.

    The first pass tells the distinct instances of each group, at most `most`; as one row of arrays they join the
    records of the second pass.
    """
    if df.isStreaming:
        raise ValueError("keep_absent needs the whole table and so no stream")
    names = id_columns(groups, options.id_names)
    deep = [n for n, ids in enumerate(names) if ids]
    spark = df.sparkSession
    whole = {n: " AND ".join(f"{sql_name(c)} IS NOT NULL" for c in names[n]) for n in deep}
    place = {n: f"concat_ws('.', {', '.join(map(sql_name, names[n]))})" for n in deep}  # no id holds a dot
    instances = spark.createDataFrame([(None,)], "__none int")
    if deep:
        case = lambda of: "CASE " + " ".join(f"WHEN {GROUP} = {n} THEN {of[n]}" for n in deep) + " END"
        rows = _flatten(df, groups, options, tag=GROUP).where(F.expr(case(whole)))
        found = rows.select(GROUP, F.expr(case(place)).alias("place")).distinct()
        held = {n: [] for n in deep}
        for number, text in found.limit((most + 1) * len(deep)).collect():
            held[number].append(text)
        many = [n for n in deep if len(held[n]) > most]
        if many:
            raise ValueError(f"row groups {many} have more than {most} instances; raise max_instances to keep absent ones")
        schema = T.StructType([T.StructField(f"__places{n}", T.ArrayType(T.StringType()), False) for n in deep])
        instances = spark.createDataFrame([tuple(sorted(held[n]) for n in deep)], schema)
    found, rows = _rows(df, groups, options, GROUP, bare=True)
    table = found.select(*options.keep, F.expr(f"explode(array({rows}))").alias("__rows"))  # a generator, as in _spread
    columns = [c for c in table.schema["__rows"].dataType.elementType.names if c != GROUP]
    parts = [higher_order("filter", "__rows", lambda r: f"{r}.{GROUP} >= 0")]
    for n in deep:
        own = higher_order("transform", higher_order("filter", "__rows", lambda r: f"{r}.{GROUP} = {n}"), lambda r: "concat_ws('.', " + ", ".join(f"{r}.{sql_name(c)}" for c in names[n]) + ")")
        scalars = {t.alias for t in groups[n].templates if not t.depth}
        bare = f"get({higher_order('filter', '__rows', lambda r: f'{r}.{GROUP} = {-1 - n}')}, 0)"

        def absent(place: str, n: int = n, scalars: set[str] = scalars) -> str:
            def value(c: str) -> str:
                if c in names[n]:
                    return f"split_part({place}, '.', {names[n].index(c) + 1})"
                return f"__bare{n}.{sql_name(c)}" if c in scalars else "CAST(NULL AS STRING)"

            return f"named_struct({sql_text(GROUP)}, {n}, " + ", ".join(f"{sql_text(c)}, {value(c)}" for c in columns) + ")"

        table = table.withColumn(f"__bare{n}", F.expr(bare))
        parts.append(higher_order("transform", f"array_except(__places{n}, {own})", absent))
    joined = table.crossJoin(F.broadcast(instances))
    every = f"concat({', '.join(parts)})"
    every = f"sort_array({every})" if options.ordered else every
    placed = [] if options.position is None else [options.position]
    return _spread(joined, every, options).select(*map(_quoted, [*options.keep, *columns, *placed]))


def _rows(df: DataFrame, groups: list[RowGroup], options: _Options, tag: str | None = None, bare: bool = False) -> tuple[DataFrame, str]:
    """The records taken apart, and the array of a record's rows as SQL text over them; with ``tag`` each has the number of its
    group there, and with ``bare`` every group with instances has one more row (-1 - its number) of leaves outside any collection."""
    value, keep, root = options.value, options.keep, options.root
    spine, ids, id_names, layout, strategy, ordered = options.spine, options.ids, options.id_names, options.layout, options.strategy, options.ordered
    names = id_columns(groups, id_names)
    columns = list(
        dict.fromkeys(
            [c for group in names for c in group]
            + sorted(t.alias for g in groups for t in g.templates)
        )
    )
    taken = set(columns) & {*keep, options.position}
    if taken:
        raise ValueError(f"kept columns or the position clash with flattened ones: {sorted(taken)}")
    build = _RowBuilder(groups, names, columns, spine == "any", ID_PATTERNS[ids], ordered, tag, bare)
    text, keys = F.col(value).cast("string"), root_keys(root)
    if layout == "flat" or strategy == "path_map":
        every = [t for g in groups for t in g.templates]
        plain = TypedRecord.try_build(every, ())
        df = df.select(*keep, text.alias("__text"))
        if plain is not None:
            wanted = T.StructType(plain.schema.fields[:-1])  # without the column of what does not fit
            read = plain_record(F.col("__text"), keys, plain.tree, wanted, ids == "any")
            df = df.select(*keep, "__text", read.alias("__plain"))
            df = df.select(*keep, "__plain", F.when(F.col("__plain").isNull(), F.col("__text")).alias("__text"))
        held = [c for c in df.columns if c != "__text"]
        if layout == "flat":
            paths = flat_keys(df, F.col("__text"), held, keys, "__paths")
        else:
            paths = df.select(*held, sql_path_map(F.col("__text"), keys).alias("__paths"))
        readers = [PathRecord(g.templates, ID_PATTERNS[ids]) for g in groups]
        nodes = [f"__node{n}" for n in range(len(groups))]
        rows = build.rows(readers, nodes)
        if plain is not None:
            rows = f"CASE WHEN __plain IS NOT NULL THEN {build.record_rows(plain, '__plain')} ELSE {rows} END"
        return paths.select(*held, *[F.expr(r.node("__paths")).alias(n) for r, n in zip(readers, nodes)]), rows
    variant = VariantRecord(keys)
    strings = [PathRecord(g.templates, ID_PATTERNS[ids]) for g in groups]

    def finished(parsed: DataFrame, otherwise: str) -> tuple[DataFrame, str]:
        """Rows from ``__variant``; from ``__strings`` where no variant could hold a record; else ``otherwise``."""
        nodes = [f"__node{n}" for n in range(len(groups))]
        split = [F.expr(f"CASE WHEN __strings IS NOT NULL THEN {r.node('__strings')} END").alias(n) for r, n in zip(strings, nodes)]
        rows = (
            f"CASE WHEN __strings IS NOT NULL THEN {build.rows(strings, nodes)}"
            f" WHEN __variant IS NOT NULL THEN {build.record_rows(variant, '__variant')} ELSE {otherwise} END"
        )
        return parsed.select("*", *split), rows

    typed = None
    if strategy == "auto":
        typed = TypedRecord.try_build([t for g in groups for t in g.templates], keys)
    if typed is None:
        parsed = df.select(*keep, text.alias("__text")).select(*keep, "__text", F.try_parse_json("__text").alias("__variant"))
        unread = F.when(F.col("__variant").isNull(), string_path_map(F.col("__text"), keys))
        return finished(parsed.select("*", unread.alias("__strings")), build.record_rows(variant, "__variant"))
    # The parse gets a projection of its own. Row building takes the parsed record as a whole, or
    # the optimizer would add another projection just to pick the fields apart.
    parsed = df.select(*keep, text.alias("__text")).select(
        *keep, "__text", typed.parse(F.col("__text")).alias("__typed")
    )
    aliases = dict.fromkeys(t.alias for g in groups for t in g.templates)

    def is_rewritten(row: str) -> str:
        return " OR ".join(may_be_rewritten(f"{row}.{sql_name(alias)}") for alias in aliases)

    odd = f"({typed.may_hold_null('__text')} OR {higher_order('exists', '__rows', is_rewritten)})"
    doubts = [f"__typed.{UNEXPECTED} IS NOT NULL", f"({typed.may_hold_odd('__text')} AND {odd})", typed.repeats("__typed")]
    parsed = parsed.select("*", F.expr(build.record_rows(typed, "__typed")).alias("__rows"))
    parsed = parsed.select(*keep, "__text", "__rows", F.expr(" OR ".join(doubts)).alias("__doubtful"))
    parsed = parsed.select("*", F.when(F.col("__doubtful"), F.try_parse_json("__text")).alias("__variant"))
    unread = F.when(F.col("__doubtful") & F.col("__variant").isNull(), string_path_map(F.col("__text"), keys))
    return finished(parsed.select("*", unread.alias("__strings")), "__rows")


class _RowBuilder:
    """Builds the array of a record's rows, as SQL text."""

    def __init__(
        self,
        groups: list[RowGroup],
        names: list[list[str]],
        columns: list[str],
        any_spine: bool,
        id_pattern: str,
        ordered: bool,
        tag: str | None = None,
        bare: bool = False,
    ) -> None:
        self.tag, self.bare = tag, bare
        self.groups = groups
        self.names = names
        self.columns = columns
        self.any_spine = any_spine
        self.id_regex = sql_text(f"^{id_pattern}$")
        self.ordered = ordered
        fields = ([f"{sql_name(tag)}:int"] if tag else []) + [f"{sql_name(c)}:string" for c in columns]
        self.row_type = f"array<struct<{','.join(fields)}>>"
        self.no_rows = f"CAST(array() AS {self.row_type})"

    def record_rows(self, reader, parsed: str) -> str:
        return self.rows([reader] * len(self.groups), [reader.node(parsed)] * len(self.groups))

    def rows(self, readers: list, nodes: list[str]) -> str:
        """The rows of all groups in one array, each group read with its own reader and node."""
        parts = [self._group(*args) for args in zip(readers, nodes, self.groups, self.names)]
        if self.bare:
            for n, (reader, node, group) in enumerate(zip(readers, nodes, self.groups)):
                if group.depth:
                    parts.append(f"array({self._row(reader, group, self.names[n], [node], [], -1 - n)})")
        return parts[0] if len(parts) == 1 else f"flatten(array({', '.join(parts)}))"

    def _group(self, reader, root: str, group: RowGroup, names: list[str]) -> str:
        if not group.depth:
            return f"array({self._row(reader, group, names, [root], [])})"
        spines = [
            (level, chosen)
            for level in range(group.depth, 0, -1)
            for chosen in self._spines(group.at_depth(level))
        ]
        level_rows = partial(self._level_rows, reader, group, names, root)
        # Nearly always the first spine is there, so try it without a search of its own.
        (level, chosen), *others = spines
        rows = level_rows(level, partial(self._holds, reader, chosen))
        if others:
            other_rows = self._other_rows(reader, root, group, others, level_rows)
            rows = let(rows, lambda r: f"CASE WHEN size({r}) > 0 THEN {r} ELSE {other_rows} END", self.row_type)
        rows = f"coalesce({rows}, {self.no_rows})"
        return f"sort_array({rows})" if self.ordered else rows

    def _other_rows(self, reader, root: str, group: RowGroup, spines, level_rows) -> str:
        """Rows of the first spine with a match; each level's rows are written out only once."""
        choice = "CASE"
        for number, (level, chosen) in enumerate(spines):
            found = self._any_instance(reader, group, root, level, partial(self._holds, reader, chosen))
            choice += f" WHEN {found} THEN {number}"

        def rows(choice: str) -> str:
            result = "CASE"
            for level in sorted({level for level, _ in spines}, reverse=True):
                held = [(n, chosen) for n, (at, chosen) in enumerate(spines) if at == level]

                def is_wanted(node: str, held=held) -> str:
                    tests = [f"WHEN {n} THEN {self._holds(reader, chosen, node)}" for n, chosen in held]
                    return f"CASE {choice} {' '.join(tests)} END"

                wanted = level_rows(level, is_wanted)
                result += f" WHEN {choice} BETWEEN {held[0][0]} AND {held[-1][0]} THEN {wanted}"
            return f"{result} ELSE {self.no_rows} END"

        return let(f"{choice} END", rows, self.row_type)

    def _spines(self, templates: Sequence[Template]) -> list[list[Template]]:
        if self.any_spine:
            return [list(templates)] if templates else []
        return [[t] for t in templates]

    def _holds(self, reader, chosen: list[Template], node: str) -> str:
        return "(" + " OR ".join(reader.present(node, t) for t in chosen) + ")"

    def _is_instance(self, entry: str) -> str:
        return f"{entry}.key RLIKE {self.id_regex}"

    def _any_instance(self, reader, group: RowGroup, node: str, level: int, test, at: int = 0) -> str:
        """Is there an instance at ``level`` that passes the test?"""

        def holds(entry: str) -> str:
            body = f"{entry}.value"
            inner = test(body) if at == level - 1 else self._any_instance(reader, group, body, level, test, at + 1)
            return f"{self._is_instance(entry)} AND {inner}"

        return higher_order("exists", reader.instances(node, group.collections[at], at), holds)

    def _level_rows(self, reader, group: RowGroup, names: list[str], root: str, level: int, test) -> str:
        """One row per instance at ``level`` that passes the test."""

        def descend(nodes: list[str], ids: list[str]) -> str:
            at = len(ids)
            last = at == level - 1

            def below(entry: str) -> str:
                path = [*nodes, f"{entry}.value"], [*ids, f"{entry}.key"]
                return self._row(reader, group, names, *path) if last else descend(*path)

            def is_wanted(entry: str) -> str:
                wanted = self._is_instance(entry)
                return f"{wanted} AND {test(f'{entry}.value')}" if last else wanted

            entries = higher_order("filter", reader.instances(nodes[-1], group.collections[at], at), is_wanted)
            rows = higher_order("transform", entries, below)
            return rows if last else f"flatten({higher_order('filter', rows, '{} IS NOT NULL'.format)})"

        return descend([root], [])

    def _row(self, reader, group: RowGroup, names: list[str], nodes: list[str], ids: list[str], number: int | None = None) -> str:
        filled = dict(zip(names, ids))
        for template in group.templates:
            if template.depth < len(nodes):
                filled[template.alias] = reader.text(nodes[template.depth], template)
        fields = [f"{sql_text(c)}, {filled.get(c, 'CAST(NULL AS STRING)')}" for c in self.columns]
        if self.tag:
            fields.insert(0, f"{sql_text(self.tag)}, {self.groups.index(group) if number is None else number}")
        return f"named_struct({', '.join(fields)})"
