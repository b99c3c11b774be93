"""Declarative descriptions of entities, lookups and cross-system mappings.

Specs hold names and small column builders only; the operators turn them into
DataFrame plans.  A builder is a zero-argument callable so that specs can be
declared at import time, before a session exists.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column
from pyspark.sql.types import StructType

ColumnBuilder = Callable[[], Column]


def ddl_names(ddl: str) -> tuple[str, ...]:
    """Column names of a DDL string, without needing a session."""
    return tuple(part.split()[0] for part in re.split(r",\s*(?![^()]*\))", ddl.strip()))


@dataclass(frozen=True)
class Lookup:
    """A many:1 left join that adds columns of another table.

    ``on`` pairs (base column, lookup column).  ``columns`` maps the output name
    to a lookup column or a builder over the lookup's columns.  ``where`` holds
    (column, value) literals that belong to the join condition: they filter the
    lookup side, so unmatched base rows stay.  ``pick`` names the column whose
    lowest value decides which row survives when the lookup has several rows per
    key; ``None`` keeps them all, and the join may then fan out.
    """

    source: str
    on: tuple[tuple[str, str], ...]
    columns: dict[str, str | ColumnBuilder]
    where: tuple[tuple[str, object], ...] = ()
    pick: str | None = None


@dataclass(frozen=True)
class EntitySpec:
    """One denormalised entity: base columns, lookups, computed columns, key.

    ``aliases`` are other names under which sources offer a column.
    """

    name: str
    source: str
    key: str
    ddl: str
    lookups: tuple[Lookup, ...] = ()
    computed: dict[str, ColumnBuilder] = field(default_factory=dict)
    renamed: dict[str, str] = field(default_factory=dict)
    aliases: dict[str, tuple[str, ...]] = field(default_factory=dict)
    require_key: bool = True
    blank_key_is_missing: bool = False
    distinct: bool = False
    order_by: tuple[str, ...] = ()

    @property
    def base(self) -> tuple[str, ...]:
        return ddl_names(self.ddl)

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)

    @property
    def columns(self) -> tuple[str, ...]:
        looked_up = tuple(name for lk in self.lookups for name in lk.columns)
        return self.base + tuple(self.renamed) + looked_up + tuple(self.computed)


def find_column(
    name: str, columns: Iterable[str], aliases: Mapping[str, Iterable[str]] | None = None
) -> str | None:
    """The column a name or one of its aliases stands for; case does not matter."""
    actual = {c.lower(): c for c in columns}
    for known in (name, *(aliases or {}).get(name, ())):
        if known.lower() in actual:
            return actual[known.lower()]
    return None


@dataclass(frozen=True)
class FieldMap:
    """One legacy column feeding one target property.

    ``refers`` names the object type whose legacy id the column holds: the target has its own id there.
    """

    legacy: str
    target: str
    required: bool = False
    transform: str | None = None
    default: str | None = None
    aliases: tuple[str, ...] = ()
    refers: str | None = None


@dataclass(frozen=True)
class ObjectMap:
    """How a legacy entity corresponds to a target object."""

    object_type: str
    legacy_entity: str
    legacy_id: str
    target_id: str
    crosswalk: str
    fields: tuple[FieldMap, ...]
    required: tuple[str, ...] = ()

    @property
    def target_columns(self) -> tuple[str, ...]:
        """Every property to read from the target, sorted, each once."""
        names = {f.target for f in self.fields} | set(self.required) | {self.target_id, self.crosswalk}
        return tuple(sorted(names))

    @property
    def legacy_columns(self) -> tuple[str, ...]:
        """Distinct legacy columns in declaration order."""
        return tuple(dict.fromkeys(f.legacy for f in self.fields))

    @property
    def links(self) -> tuple[FieldMap, ...]:
        """Fields that hold the id of another object."""
        return tuple(f for f in self.fields if f.refers)

    def with_crosswalk(self, column: str) -> "ObjectMap":
        """The same mapping for a target that keeps legacy ids in ``column``."""
        required = tuple(column if c == self.crosswalk else c for c in self.required)
        return replace(self, crosswalk=column, required=required)


@dataclass(frozen=True)
class Relationship:
    """``child.column`` refers to ``parent.key`` (optionally for one kind only)."""

    child: str
    column: str
    parent: str
    key: str
    kind: tuple[str, object] | None = None
