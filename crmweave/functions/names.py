"""Column names: normalising them and finding the column that is meant."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


# A word is a run of capitals before another word, a word with or without a first capital, or a number.
WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[^\W\dA-Z_]+|\d+")


def snake_name(name: str) -> str:
    """``[Case_CaseId]`` -> ``case_id``: the words of a name, without a table prefix that the next word repeats.

    A number stays with the word before it.
    """
    words: list[str] = []
    for part in re.split(r"[^\w]+|_", name):
        own: list[str] = []
        for word in WORD.findall(part):
            if own and word.isdigit():
                own[-1] += word
            else:
                own.append(word.lower())
        words += own
    return "_".join(words[1:] if len(words) > 1 and words[0] == words[1] else words)


def with_snake_names(df: DataFrame) -> DataFrame:
    names = [snake_name(c) for c in df.columns]
    clash = {n for n in names if names.count(n) > 1}
    if clash:
        raise ValueError(f"columns share a normalised name: {sorted(clash)}")
    return df.toDF(*names)


def _squeezed(name: str) -> str:
    return name.replace("_", "").lower()


def _without_prefix(name: str) -> str:
    return name.partition("_")[2] or name


def resolve_column(wanted: str, columns: Iterable[str]) -> str | None:
    """The actual column meant by ``wanted``, or None.

    Rules from strict to loose; the first one with a hit decides.  Names are short
    lists known to the driver, so this never touches data.
    """
    columns = list(columns)
    title = "_".join(part.capitalize() for part in wanted.split("_"))
    rules = (
        lambda c: c == wanted,
        lambda c: c == title,
        lambda c: c.lower() == wanted.lower(),
        lambda c: _squeezed(c) == _squeezed(wanted),
        lambda c: snake_name(c) == wanted.lower(),
        lambda c: snake_name(_without_prefix(c)) == wanted.lower(),
    )
    for rule in rules:
        for column in columns:
            if rule(column):
                return column
    return None


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Project onto a schema by resolved names; missing columns become typed NULLs."""
    selected = []
    for field in schema.fields:
        found = resolve_column(field.name, df.columns)
        source = F.col(f"`{found}`") if found else F.lit(None)
        selected.append(source.cast(field.dataType).alias(field.name))
    return df.select(*selected)
