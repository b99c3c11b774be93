"""Update payloads: mapped, non-empty legacy values as a string map or JSON."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

from crmweave.functions.columns import is_filled
from crmweave.specs import FieldMap, ObjectMap, find_column

Transform = Callable[[Column], Column]

# Named per-field transformations; callers may pass their own registry instead.
TRANSFORMS: dict[str, Transform] = {"trim": F.trim, "lower": F.lower, "upper": F.upper}


def legacy_column(field: FieldMap, available: list[str]) -> str | None:
    """Column of the frame holding a field, under its own name or an alias."""
    return find_column(field.legacy, available, {field.legacy: field.aliases})


def legacy_value(
    field: FieldMap,
    schema: StructType,
    transforms: Mapping[str, Transform] = TRANSFORMS,
    prefix: str = "",
) -> Column | None:
    """The field's value with transformation and default applied; None if absent.

    NaN is missing data, exactly like NULL.
    """
    name = legacy_column(field, [n.removeprefix(prefix) for n in schema.names if n.startswith(prefix)])
    if name is None:
        return F.lit(field.default) if field.default is not None else None
    value = F.col(f"`{prefix}{name}`")
    if isinstance(schema[prefix + name].dataType, (DoubleType, FloatType)):
        value = F.when(~F.isnan(value), value)
    if field.transform:
        value = transforms[field.transform](value)
    if field.default is not None:
        value = F.coalesce(F.nullif(value.cast("string"), F.lit("")), F.lit(field.default))
    return value


def map_of(entries: Sequence[tuple[str, Column]], keep: Callable[[Column], Column]) -> Column:
    """map<string,string> of the named text values that ``keep`` holds for.

    Entries are chosen before they enter the map, by plain conditions: a filter over a finished map would run a function
    on each entry of each row, outside of generated code.
    """
    if len({name for name, _ in entries}) < len(entries):
        raise ValueError("a map cannot have two entries of one name")
    none = F.create_map().cast("map<string,string>")
    return F.map_concat(none, *(F.when(keep(v), F.create_map(F.lit(name), v)).otherwise(none) for name, v in entries))


def update_map(
    schema: StructType,
    mapping: ObjectMap,
    transforms: Mapping[str, Transform] = TRANSFORMS,
    prefix: str = "",
    replaced: Mapping[str, Column] | None = None,
) -> Column:
    """map<string,string> of target property -> legacy value; empty values are left out.

    ``replaced`` gives properties a value of their own instead of the legacy one.
    """
    entries = []
    for field in mapping.fields:
        value = (replaced or {}).get(field.target)
        if value is None:
            value = legacy_value(field, schema, transforms, prefix)
        if value is not None:
            entries.append((field.target, value.cast("string")))
    return map_of(entries, is_filled)


def payload_rows(df: DataFrame, key: str, payload: str) -> DataFrame:
    """One row per (key, property, value) of a JSON payload column."""
    parsed = F.from_json(F.col(payload), "map<string,string>")
    return df.select(F.col(key), F.explode(parsed).alias("property", "value"))


def map_rows(df: DataFrame, column: str, *more: Column | str) -> DataFrame:
    """``more`` and (property, value) of each entry of a map column.

    For a plain ``explode`` of a column Spark infers that the map is not empty and makes it a second time to check that.
    """
    return df.select(*more, F.explode_outer(column).alias("property", "value")).where(F.col("property").isNotNull())
