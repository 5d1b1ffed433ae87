"""Wildcard templates and the row groups they form.

A template such as ``Device.Pool.{i}.Client.{i}.Active`` names a leaf below every instance of
one or more collections. This module works on template text only; it never sees data.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from itertools import groupby

MARK = "{i}"
MODES = ("ancestors", "siblings")

TemplateSpec = str | tuple[str, str]


@dataclass(frozen=True)
class Template:
    """One wanted leaf. ``collections`` are key paths, each relative to the instance above it."""

    path: str
    alias: str
    collections: tuple[tuple[str, ...], ...]
    leaf: tuple[str, ...]

    @property
    def depth(self) -> int:
        return len(self.collections)

    @property
    def root(self) -> str:
        return ".".join(self.path.split(".")[:2])

    @property
    def parts(self) -> int:
        return len(self.path.split("."))


@dataclass(frozen=True)
class RowGroup:
    """Templates that share their rows: one row per instance of the innermost collection."""

    root: str
    templates: tuple[Template, ...]

    @property
    def collections(self) -> tuple[tuple[str, ...], ...]:
        return max((t.collections for t in self.templates), key=len)

    @property
    def depth(self) -> int:
        return len(self.collections)

    def at_depth(self, depth: int) -> list[Template]:
        return [t for t in self.templates if t.depth == depth]

    def collection_path(self, level: int) -> str:
        """Full template of the ``level``-th collection, such as ``Device.Pool.{i}.Client``."""
        return f".{MARK}.".join(".".join(keys) for keys in self.collections[:level])


def parse_template(spec: TemplateSpec) -> Template:
    path, alias = (spec, spec.rsplit(".", 1)[-1]) if isinstance(spec, str) else spec
    runs: list[tuple[str, ...]] = []
    keys: list[str] = []
    for part in path.split("."):
        if not part:
            raise ValueError(f"empty part in template {path!r}")
        if part != MARK:
            keys.append(part)
        elif keys:
            runs.append(tuple(keys))
            keys = []
        else:
            raise ValueError(f"{MARK} needs a collection name before it: {path!r}")
    return Template(path, alias, tuple(runs), tuple(keys))


def normalise(specs: Iterable[TemplateSpec]) -> list[Template]:
    """Templates in path order, without those that name an instance instead of a leaf."""
    templates = sorted((parse_template(s) for s in specs), key=lambda t: (t.path, t.alias))
    templates = [t for t in templates if t.leaf]
    paths = [t.path for t in templates]
    if len(set(paths)) != len(paths):
        raise ValueError(f"repeated templates: {sorted({p for p in paths if paths.count(p) > 1})}")
    if not templates:
        raise ValueError("no template names a leaf")
    return templates


def plan_groups(specs: Iterable[TemplateSpec], mode: str = "ancestors") -> list[RowGroup]:
    """Split templates into row groups.

    ``ancestors`` gives every innermost collection the columns of all collections around it;
    ``siblings`` only groups leaves of the same collection. Leaves outside any collection
    join each group of their root (first two path parts).
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}: {mode!r}")
    groups = []
    for root, members in groupby(
        sorted(normalise(specs), key=lambda t: t.root), key=lambda t: t.root
    ):
        size = (lambda t: t.depth) if mode == "ancestors" else (lambda t: t.parts)
        members = sorted(members, key=size, reverse=True)
        scalars = [t for t in members if not t.depth]
        placed: set[Template] = set()
        for seed in members:
            if seed in placed:
                continue
            lowest = 1 if mode == "ancestors" else seed.depth
            shared = [
                t
                for level in range(seed.depth, lowest - 1, -1)
                for t in members
                if level and t.collections == seed.collections[:level]
            ]
            chosen = dict.fromkeys([seed, *scalars, *shared])
            placed.update(chosen)
            groups.append(RowGroup(root, tuple(chosen)))
    return groups


def id_columns(groups: Iterable[RowGroup], names: Mapping[str, str] | None = None) -> list[list[str]]:
    """Instance-id column names of each group, outermost first.

    A column is called after its collection unless ``names`` maps the collection's path
    (``Device.Pool.{i}.Client``) to another name.
    """
    names = names or {}
    result = []
    for group in groups:
        paths = [group.collection_path(n) for n in range(1, group.depth + 1)]
        columns = [names.get(p, p.rsplit(".", 1)[-1]) for p in paths]
        aliases = [t.alias for t in group.templates]
        clash = {c for c in columns + aliases if (columns + aliases).count(c) > 1}
        if clash:
            raise ValueError(f"column names used twice in the rows of {group.root}: {sorted(clash)}")
        result.append(columns)
    return result
