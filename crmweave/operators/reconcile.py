"""Reconciliation of a legacy entity with its counterpart in the target system."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType, DatetimeType, FractionalType, LongType, NumericType, StringType, StructField, StructType,
)

from crmweave.crm.staging import head_columns, staging_schema
from crmweave.functions.dates import literal_time
from crmweave.functions.keys import canonical_key
from crmweave.functions.payload import TRANSFORMS, Transform, legacy_column, map_of, update_map
from crmweave.operators.contact import pick_primary
from crmweave.operators.crosswalk import LINK, link_names, translate_links
from crmweave.operators.lookup import lookup_join
from crmweave.specs import FieldMap, ObjectMap

KEY = "__match_key"
FULL_CONFIDENCE = 100


def legacy_side(legacy: DataFrame, mapping: ObjectMap) -> DataFrame:
    """Legacy id, match key and each mapped column once, prefixed ``leg_``."""
    columns = {}
    for field in mapping.fields:
        found = legacy_column(field, legacy.columns)
        if found is not None:
            columns[f"leg_{field.legacy}"] = found
    return legacy.select(
        canonical_key(mapping.legacy_id).alias(KEY),
        F.col(mapping.legacy_id).alias("legacy_id"),
        *(F.col(source).alias(name) for name, source in columns.items()),
    )


def target_side(target: DataFrame, mapping: ObjectMap) -> DataFrame:
    """Target rows carrying a crosswalk id, with their properties prefixed ``tgt_``."""
    return target.where(F.col(mapping.crosswalk).isNotNull()).select(
        canonical_key(mapping.crosswalk).alias(KEY),
        F.col(mapping.target_id).alias("target_id"),
        *(F.col(c).alias(f"tgt_{c}") for c in mapping.target_columns if c in target.columns),
    )


def missing_fields(legacy: DataFrame, mapping: ObjectMap) -> list[str]:
    """Mapped legacy columns the frame does not offer under any known name."""
    return [
        f.legacy for f in mapping.fields
        if legacy_column(f, legacy.columns) is None and f.default is None
    ]


def match(legacy: DataFrame, target: DataFrame, mapping: ObjectMap, limit: int | None = None) -> DataFrame:
    """Every pair of legacy and target rows that share the crosswalk id."""
    pairs = lookup_join(
        legacy_side(legacy, mapping), target_side(target, mapping), [KEY], "inner"
    ).drop(KEY)
    return pairs if limit is None else pairs.orderBy("legacy_id", "target_id").limit(limit)


def match_direct(target: DataFrame, mapping: ObjectMap) -> DataFrame:
    """Ids of target rows that already carry a crosswalk id; no legacy rows are needed."""
    return target.where(F.col(mapping.crosswalk).isNotNull()).select(
        canonical_key(mapping.crosswalk).alias("legacy_id"), F.col(mapping.target_id).alias("target_id")
    )


def unmatched(legacy: DataFrame, target: DataFrame, mapping: ObjectMap) -> DataFrame:
    """Legacy rows whose id no target row carries."""
    keys = target.select(canonical_key(mapping.crosswalk).alias(KEY)).where(F.col(KEY).isNotNull())
    return lookup_join(legacy_side(legacy, mapping), keys, [KEY], "left_anti").drop(KEY)


def _text(value: Column) -> Column:
    return F.nullif(F.trim(value.cast("string")), F.lit(""))


def _same(left: Column, lt: DataType, right: Column, rt: DataType) -> Column:
    """Whether both sides hold the same value; blank text is NULL.

    Against a number, text counts as the number it spells; against a time, as the time it spells. Text that spells
    none is compared as text.
    """
    kinds = (lt, rt)
    if all(isinstance(t, NumericType) for t in kinds):
        form = "decimal(38,6)" if any(isinstance(t, FractionalType) for t in kinds) else "bigint"
        return left.cast(form).eqNullSafe(right.cast(form))
    as_text = _text(left).eqNullSafe(_text(right))
    for kind, form in ((NumericType, "decimal(38,6)"), (DatetimeType, "timestamp")):
        if any(isinstance(t, kind) for t in kinds) and any(isinstance(t, StringType) for t in kinds):
            return F.coalesce(_text(left).try_cast(form) == _text(right).try_cast(form), as_text)
    return as_text


def _comparable(schema: StructType, field: FieldMap) -> bool:
    return f"leg_{field.legacy}" in schema.names and f"tgt_{field.target}" in schema.names


def _differences(schema: StructType, mapping: ObjectMap) -> dict[str, Column]:
    """For each compared target property, whether its value differs from the legacy value."""
    tests = {}
    for field in mapping.fields:
        if _comparable(schema, field):
            left, right = f"leg_{field.legacy}", f"tgt_{field.target}"
            lt, rt = schema[left].dataType, schema[right].dataType
            if (link := LINK + field.target) in schema.names:
                # A link that could not be translated is reported, not compared.
                known = F.col(link).isNotNull() | canonical_key(left).isNull()
                tests[field.target] = known & ~_same(F.col(link), schema[link].dataType, F.col(right), rt)
            else:
                tests[field.target] = ~_same(F.col(left), lt, F.col(right), rt)
    return tests


def differing_fields(schema: StructType, mapping: ObjectMap) -> Column:
    """Names of target properties whose value differs from the legacy value."""
    tests = _differences(schema, mapping)
    if not tests:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*(F.when(differs, F.lit(name)) for name, differs in tests.items())))


def reconcile(
    legacy: DataFrame,
    target: DataFrame,
    mapping: ObjectMap,
    mark_conflicts: bool = True,
    transforms: Mapping[str, Transform] = TRANSFORMS,
    crosswalks: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """One row per legacy row: status, confidence, conflicts, update payload.

    Where several target rows carry one crosswalk id, the lowest target id counts.
    With ``mark_conflicts=False`` every row found in the target is ``matched``.
    ``crosswalks`` (object type -> ``crosswalk_of``) translate links to other objects, which are then compared and
    written as target ids; without a crosswalk of its type, a link is taken as it stands.
    """
    right = pick_primary(target_side(target, mapping).where(F.col(KEY).isNotNull()), [KEY], "target_id")
    joined = lookup_join(translate_links(legacy_side(legacy, mapping), mapping, crosswalks or {}), right, [KEY], "left")
    translated = {name: F.col(LINK + name) for name in link_names(joined.columns, mapping, crosswalks or {})}
    found = F.col("target_id").isNotNull()
    conflicts = F.when(found, differing_fields(joined.schema, mapping)).otherwise(
        F.array().cast("array<string>")
    )
    status = F.when(~found, F.lit("new"))
    if mark_conflicts:
        # Not by the list of names: counts of statuses then need no list.
        differs = reduce(or_, _differences(joined.schema, mapping).values(), F.lit(False))
        status = status.when(differs, F.lit("conflict"))
    numeric_id = F.col(KEY).try_cast("bigint")
    return joined.withColumn("conflict_fields", conflicts).select(
        numeric_id.alias("legacy_id"),
        F.col(KEY).alias("legacy_key"),
        F.col("target_id"),
        *(F.col(c) for c in joined.columns if c.startswith(("leg_", "tgt_", LINK))),
        update_map(joined.schema, mapping, transforms, prefix="leg_", replaced=translated).alias("properties_to_update"),
        F.col("conflict_fields"),
        # An id that is no number cannot be staged; the row is kept and reported.
        F.when(numeric_id.isNull(), F.lit("error"))
        .otherwise(status.otherwise(F.lit("matched")))
        .alias("reconciliation_status"),
        F.when(found, F.lit(FULL_CONFIDENCE)).cast("decimal(5,2)").alias("match_confidence"),
    )


def conflicts(reconciled: DataFrame) -> DataFrame:
    """One row per (legacy id, target id, differing property)."""
    return reconciled.where(F.size("conflict_fields") > 0).select(
        "legacy_id", "target_id", F.explode("conflict_fields").alias("property")
    )


def _legacy_properties(schema: StructType) -> Column:
    names = [c for c in schema.names if c.startswith("leg_")]
    return map_of([(c.removeprefix("leg_"), F.col(c).cast("string")) for c in names], Column.isNotNull)


def to_staging(
    reconciled: DataFrame,
    object_type: str,
    as_of: datetime | str,
    notes: str | None = None,
    target: str = "target",
) -> DataFrame:
    """Reconciled rows in the fixed schema of the object's staging table.

    The columns for target values hold what the target has, not what the payload
    would write there, so that a reader can compare both sides.
    """
    schema = staging_schema(object_type, target)
    legacy_key, target_key = schema.names[0], schema.names[1]
    values: dict[str, Column] = {legacy_key: F.col("legacy_id"), target_key: F.col("target_id")}
    for name, side, source in head_columns(object_type, target):
        column = f"{side}_{source}"
        values[name] = F.col(column) if column in reconciled.columns else F.lit(None)
    now = literal_time(as_of)
    values |= {
        "legacy_properties": _legacy_properties(reconciled.schema),
        "properties_to_update": F.col("properties_to_update"),
        "reconciliation_status": F.col("reconciliation_status"),
        "match_confidence": F.col("match_confidence"),
        "notes": F.lit(notes),
        "created_at": now,
        "last_updated": now,
    }
    return reconciled.where(F.col("reconciliation_status") != "error").select(
        *(_stored(values[f.name], f).alias(f.name) for f in schema.fields)
    )


def _stored(value: Column, field: StructField) -> Column:
    """Association ids may arrive as text; one that is no number is stored as NULL."""
    if isinstance(field.dataType, LongType):
        return value.try_cast(field.dataType)
    return value.cast(field.dataType)


def rejected(reconciled: DataFrame) -> DataFrame:
    """Rows that cannot be staged, as their id is no number: the legacy properties as JSON."""
    return reconciled.where(F.col("reconciliation_status") == "error").select(
        "legacy_key", F.to_json(_legacy_properties(reconciled.schema)).alias("legacy_properties")
    )


def run_stats(reconciled: DataFrame, object_type: str) -> DataFrame:
    """One row: how many legacy rows there were and what became of them."""
    status = F.col("reconciliation_status")

    def number(value: str) -> Column:
        return F.count(F.when(status == value, 1))

    return reconciled.agg(
        F.count("*").alias("total"),
        number("matched").alias("matched"),
        number("new").alias("unmatched"),
        number("conflict").alias("conflicts"),
        number("error").alias("errors"),
    ).select(
        F.lit(object_type).alias("object_type"),
        "total", "matched", "unmatched", "conflicts", "errors",
    )


def update_export(
    staged: DataFrame, target_key: str, statuses: Sequence[str] = ("matched", "conflict")
) -> DataFrame:
    """Rows to update in the target, with the payload as JSON; those that differ are the ones that need it."""
    return staged.where(
        F.col("reconciliation_status").isin(*statuses) & F.col(target_key).isNotNull()
    ).select(target_key, F.to_json("properties_to_update").alias("properties_to_update"))


def create_export(staged: DataFrame, columns: list[str]) -> DataFrame:
    """Rows to create in the target, with the legacy properties as JSON."""
    return staged.where(F.col("reconciliation_status") == "new").select(
        *columns, F.to_json("legacy_properties").alias("legacy_properties")
    )


def status_stats(staged: DataFrame) -> DataFrame:
    return staged.groupBy("reconciliation_status").agg(
        F.count("*").alias("n"), F.avg("match_confidence").alias("avg_confidence")
    )
