"""Keys that must compare equal across systems."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from crmweave.functions.columns import as_column


def canonical_key(value: Column | str) -> Column:
    """Key as text: trimmed, without the ``.0`` left by a float round trip; blank is NULL.

    A floating number is written out in full: as text it would be in powers of ten from ten millions on.
    """
    value = as_column(value)
    kind = F.typeof(value)
    plain = F.regexp_replace(value.try_cast("decimal(38,6)").cast("string"), r"\.?0+$", "")
    # The type is known when the query is planned, so only one branch is left in it.
    text = F.when(kind.isin("double", "float"), F.coalesce(plain, value.cast("string"))).otherwise(value.cast("string"))
    key = F.nullif(F.regexp_replace(F.trim(text), r"\.0$", ""), F.lit(""))
    return F.when(kind.isin("tinyint", "smallint", "int", "bigint"), value.cast("string")).otherwise(key)
