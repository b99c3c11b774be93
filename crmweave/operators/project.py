"""Projection and filtering of entities described by a spec."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import replace
from datetime import datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crmweave.functions.keys import canonical_key
from crmweave.functions.columns import is_filled
from crmweave.functions.dates import literal_time
from crmweave.functions.payload import legacy_column
from crmweave.functions.stages import COMPANY_KIND, PERSON_KIND
from crmweave.operators.contact import pick_primary
from crmweave.operators.lookup import left_lookup
from crmweave.specs import EntitySpec, Lookup, ObjectMap, find_column

Tables = Mapping[str, DataFrame]


def filter_rows(df: DataFrame, condition: Column | str | None) -> DataFrame:
    """Filter by a column or an expression; a leading AND or WHERE is dropped."""
    if condition is None:
        return df
    if isinstance(condition, str):
        condition = F.expr(re.sub(r"^\s*(AND|WHERE)\s+", "", condition, flags=re.IGNORECASE))
    return df.where(condition)


def ordered(df: DataFrame, order_by: Sequence[str], nulls_first_desc: bool = True) -> DataFrame:
    """Sort by names; ``-name`` is descending.

    NULL counts as the highest value, or as the lowest if ``nulls_first_desc`` is off.
    """

    def key(name: str) -> Column:
        column = F.col(name.removeprefix("-"))
        if name.startswith("-"):
            return column.desc_nulls_first() if nulls_first_desc else column.desc_nulls_last()
        return column.asc_nulls_last() if nulls_first_desc else column.asc_nulls_first()

    return df.orderBy(*(key(n) for n in order_by)) if order_by else df


def first_rows(df: DataFrame, limit: int | None, order_by: Sequence[str]) -> DataFrame:
    """The first rows in a stated order; ``None`` keeps all, ``0`` none."""
    if limit is None:
        return df
    return ordered(df, order_by).limit(limit)


def add_lookup(
    df: DataFrame,
    tables: Tables,
    lookup: Lookup,
    fan_out: bool = False,
    aliases: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Join one lookup; with ``pick`` it is reduced to one row per key beforehand."""
    right = tables[lookup.source]
    for name, value in lookup.where:
        right = right.where(F.col(name) == F.lit(value))
    if lookup.pick and not fan_out:
        right = pick_primary(right, [k for _, k in lookup.on], lookup.pick)
    columns: dict[str, Column | str] = {}
    for out, source in lookup.columns.items():
        found = find_column(source, right.columns, aliases) if isinstance(source, str) else source()
        if found is not None:
            columns[out] = found
    on = [(find_column(b, df.columns, aliases) or b, key) for b, key in lookup.on]
    return left_lookup(df, right, on, columns)


def project_entity(
    tables: Tables,
    spec: EntitySpec,
    condition: Column | str | None = None,
    limit: int | None = None,
    missing: str = "null",
    fan_out: bool = False,
    distinct: bool | None = None,
) -> DataFrame:
    """Base, denormalised and computed columns of one entity.

    ``missing`` says what becomes of declared base columns the source lacks:
    ``"null"`` types them as NULL, ``"skip"`` leaves them out, ``"error"`` raises.
    Only the columns named by the spec are read from each source.
    """
    source = tables[spec.source]
    found = {c: find_column(c, source.columns, spec.aliases) for c in spec.base}
    absent = [c for c in spec.base if found[c] is None]
    if absent and missing == "error":
        raise ValueError(f"{spec.name} lacks {absent}")

    df = source
    if spec.require_key:
        df = df.where(is_filled(spec.key) if spec.blank_key_is_missing else F.col(spec.key).isNotNull())
    early = _resolves(df, condition)
    if early:
        df = filter_rows(df, condition)
    wants_distinct = spec.distinct if distinct is None else distinct
    # Many:1 lookups keep the rows, so a limit can be taken before joining.
    limit_first = early and not fan_out and not wants_distinct
    if limit_first:
        df = first_rows(df, limit, [spec.key])

    looked_up: list[str] = []
    df, lookups = _make_room(df, spec, {c for c in found.values() if c})
    for lookup in lookups:
        df = add_lookup(df, tables, lookup, fan_out, spec.aliases)
        looked_up += [c for c in lookup.columns if c in df.columns]
    if not early:
        df = filter_rows(df, condition)

    out: list[Column] = []
    for name in spec.base:
        if found[name] is not None:
            out.append(F.col(found[name]).alias(name))
        elif missing == "null":
            out.append(F.lit(None).cast(spec.schema[name].dataType).alias(name))
    out += [
        F.col(c).alias(name) for name, c in spec.renamed.items() if find_column(c, source.columns)
    ]
    out += [F.col(name) for name in looked_up]
    out += [build().alias(name) for name, build in spec.computed.items()]
    df = df.select(*out)
    if wants_distinct:
        df = df.distinct()
    return df if limit_first else first_rows(df, limit, [spec.key])


def _make_room(df: DataFrame, spec: EntitySpec, base: set[str]) -> tuple[DataFrame, list[Lookup]]:
    """Drop source columns named like columns the lookups bring.

    A table extracted earlier already has the names of its company, say.  A key among
    the dropped columns is kept under another name.
    """
    brought = {name.lower() for lookup in spec.lookups for name in lookup.columns}
    dropped = [c for c in df.columns if c.lower() in brought and c not in base]
    if not dropped:
        return df, list(spec.lookups)
    lookups = []
    for lookup in spec.lookups:
        on = []
        for name, key in lookup.on:
            column = find_column(name, df.columns, spec.aliases)
            if column in dropped:
                df = df.withColumn(f"__{column}", F.col(column))
                column = f"__{column}"
            on.append((column or name, key))
        lookups.append(replace(lookup, on=tuple(on)))
    return df.drop(*dropped), lookups


def _resolves(df: DataFrame, condition: Column | str | None) -> bool:
    """Whether a condition needs columns of this frame only (nothing is run)."""
    try:
        filter_rows(df, condition).schema
    except AnalysisException:
        return False
    return True


def scan_target(
    table: DataFrame,
    spec: EntitySpec,
    limit: int | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Target rows that carry a crosswalk id: projection, filter, order, limit.

    Without a limit no sort is made, since row order means nothing in a stored table.
    """
    wanted = [c for c in (columns or spec.base) if c in table.columns]
    order = [n for n in spec.order_by if n.lstrip("-") in table.columns]
    df = table.where(F.col(spec.key).isNotNull())
    return first_rows(df, limit, order).select(*wanted)


def select_properties(table: DataFrame, mapping: ObjectMap, required_only: bool = False) -> DataFrame:
    names = mapping.required if required_only else mapping.target_columns
    return table.select(*(c for c in names if c in table.columns))


def rename_to_target(legacy: DataFrame, mapping: ObjectMap) -> DataFrame:
    """Legacy id plus every mapped column under its target name; 1:n is allowed."""
    out = [F.col(mapping.legacy_id).alias("legacy_id")]
    for field in mapping.fields:
        name = legacy_column(field, legacy.columns)
        if name is not None:
            out.append(F.col(name).alias(field.target))
    return legacy.select(*out)


def any_crosswalk(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with at least one crosswalk id."""
    return df.where(reduce(lambda a, b: a | b, (F.col(c).isNotNull() for c in columns)))


def of_kind(df: DataFrame, column: str, kind: int) -> DataFrame:
    """Rows of a shared link table that belong to one entity kind."""
    return df.where(F.col(column) == F.lit(kind))


def top_by(df: DataFrame, measure: str, key: str, k: int) -> DataFrame:
    """The k rows with the largest measure, ties by key."""
    return df.orderBy(F.col(measure).desc_nulls_last(), F.col(key)).limit(k)


def sample_records(df: DataFrame, key: str, n: int = 3) -> DataFrame:
    """The first n rows as JSON documents."""
    return df.orderBy(key).limit(n).select(F.to_json(F.struct("*")).alias("record"))


def stamp_provenance(
    df: DataFrame, extracted_at: datetime | str, source: str, record_count: bool = False
) -> DataFrame:
    """Add extraction time and source, and on request the number of records."""
    stamped = df.withColumns(
        {"bronze_extracted_at": literal_time(extracted_at), "bronze_source_file": F.lit(source)}
    )
    if record_count:
        total = df.agg(F.count("*").alias("n")).scalar()
        stamped = stamped.withColumn("_record_count", total)
    return stamped


def party_lookup(company: DataFrame, person: DataFrame) -> DataFrame:
    """Companies and persons under one (kind, id) key.

    A polymorphic link then needs one join, and so one shuffle of the links, where
    one left join per kind would need two.
    """
    names = ("Comp_Name", "Comp_WebSite", "Pers_FirstName", "Pers_LastName")

    def party(df: DataFrame, kind: int, key: str) -> DataFrame:
        columns = [
            F.col(n).alias(n) if n in df.columns else F.lit(None).cast("string").alias(n)
            for n in names
        ]
        return df.select(
            F.lit(kind).alias("Party_Kind"), canonical_key(key).try_cast("bigint").alias("Party_Id"), *columns
        )

    return party(company, COMPANY_KIND, "Comp_CompanyId").unionByName(
        party(person, PERSON_KIND, "Pers_PersonId")
    )
