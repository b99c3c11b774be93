"""Joins found in the graph of declared relationships.

Tables are nodes and relationships are edges from child to parent, so every join on a path is many to one and adds no
rows. A column is named by the table it is in and reached over the shortest path from the base; where two paths are
equally short, a role has to name one by its link columns. Paths that share a beginning share its joins.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crmweave.operators.lookup import left_lookup
from crmweave.operators.project import Tables
from crmweave.specs import Relationship

Path = tuple[Relationship, ...]


def shortest_paths(base: str, goal: str, relationships: Sequence[Relationship]) -> list[Path]:
    """All shortest ways from a table to another, by breadth; cycles end where a table was reached before."""
    level: list[Path] = [()]
    reached = {base}
    while level:
        longer = [
            (*path, r) for path in level for r in relationships
            if r.child == (path[-1].parent if path else base) and r.parent not in reached
        ]
        if found := [path for path in longer if path[-1].parent == goal]:
            return found
        reached |= {path[-1].parent for path in longer}
        level = longer
    return []


def shortest_path(base: str, goal: str, relationships: Sequence[Relationship]) -> Path:
    found = shortest_paths(base, goal, relationships)
    if not found:
        raise ValueError(f"no relationship from {base!r} to {goal!r}")
    if len(found) > 1:
        ways = "; ".join(", ".join(r.column for r in path) for path in found)
        raise ValueError(f"several ways from {base!r} to {goal!r}, name one as a role: {ways}")
    return found[0]


def named_path(base: str, columns: Sequence[str], goal: str | None, relationships: Sequence[Relationship]) -> Path:
    """The way along link columns. A column that links to several tables is settled by the next one or by ``goal``."""
    paths: list[Path] = [()]
    for column in columns:
        paths = [
            (*path, r) for path in paths for r in relationships
            if r.child == (path[-1].parent if path else base) and r.column == column
        ]
    paths = [path for path in paths if goal is None or path[-1].parent == goal]
    if len(paths) != 1:
        raise ValueError(f"{', '.join(columns)} name {len(paths)} ways from {base!r}")
    return paths[0]


def auto_join(
    tables: Tables,
    base: str,
    columns: Sequence[str],
    relationships: Sequence[Relationship],
    roles: Mapping[str, Sequence[str] | tuple[Sequence[str], str]] | None = None,
) -> DataFrame:
    """Project columns of the base table and, as ``table.column`` or ``role.column``, of tables that it leads to.

    ``roles`` maps a name to the link columns from the base on, or to these and the table they lead to.  Every step is
    joined once and brings only what is asked for and the links that further steps need.  The result calls such
    columns ``table_column``.
    """
    paths: dict[str, Path] = {}
    wanted: dict[Path, list[str]] = {}
    for name in columns:
        owner, dot, column = name.partition(".")
        if not dot:
            continue
        if owner not in paths:
            given = (roles or {}).get(owner)
            if given is None:
                paths[owner] = shortest_path(base, owner, relationships)
            else:
                links, goal = given if len(given) == 2 and not isinstance(given[0], str) else (given, None)
                paths[owner] = named_path(base, list(links), goal, relationships)
        wanted.setdefault(paths[owner], []).append(column)

    steps = sorted({path[:i] for path in wanted for i in range(1, len(path) + 1)}, key=len)
    number = {step: i for i, step in enumerate(steps)}

    def held(path: Path, column: str) -> str:
        """What a column is called on the way; the base keeps its names."""
        return f"__{number[path]}_{column}" if path else column

    df = tables[base]
    for step in steps:
        link = step[-1]
        needed = {c for c in wanted.get(step, ())}
        for further in steps:
            if further[:-1] == step:
                needed.add(further[-1].column)
                needed |= {further[-1].kind[0]} if further[-1].kind else set()
        on = [(held(step[:-1], link.column), link.key)]
        parent = tables[link.parent]
        if link.kind:
            # The kind is a part of the key: the child is joined on its own columns.
            parent = parent.withColumn("__kind", F.lit(link.kind[1]))
            on.append((held(step[:-1], link.kind[0]), "__kind"))
        df = left_lookup(df, parent, on, {held(step, c): c for c in sorted(needed)})

    def final(name: str):
        owner, dot, column = name.partition(".")
        return F.col(held(paths[owner], column)).alias(f"{owner}_{column}") if dot else F.col(name)

    return df.select(*(final(c) for c in columns))
