"""Text expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from crmweave.functions.columns import as_column

# Symbol-font characters and their plain equivalents.
SYMBOLS = {"\uf02d": "-", "\uf0a7": "*"}
# Fixed value: shape of a usable e-mail address.
EMAIL_PATTERN = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"


def without_symbols(value: Column | str) -> Column:
    # Plain replacement searches bytes; a translation would rebuild every text.
    value = as_column(value)
    for symbol, plain in SYMBOLS.items():
        value = F.replace(value, F.lit(symbol), F.lit(plain))
    return value


def sanitize(df: DataFrame) -> DataFrame:
    """Replace symbol-font characters in every string column, in one projection."""
    return df.select(
        *(
            without_symbols(f"`{f.name}`").alias(f.name)
            if isinstance(f.dataType, StringType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        )
    )


def joined(*parts: Column | str, sep: str = " ") -> Column:
    """Concatenate with a separator, NULL counting as an empty string.

    Differs from ``concat`` (NULL wins) and from ``concat_ws`` (the separator of a
    missing part disappears).
    """
    pieces: list[Column] = []
    for i, part in enumerate(parts):
        if i:
            pieces.append(F.lit(sep))
        pieces.append(F.coalesce(as_column(part).cast("string"), F.lit("")))
    return F.concat(*pieces)


def contains_ci(value: Column | str, text: str) -> Column:
    """Case-insensitive substring test; ``%`` and ``_`` in the text are literal."""
    return F.lower(as_column(value)).contains(text.lower())


def email_valid(value: Column | str) -> Column:
    return F.coalesce(as_column(value).rlike(EMAIL_PATTERN), F.lit(False))


def escaped(df: DataFrame) -> DataFrame:
    """Text columns with backslashes doubled and line breaks as ``\\n`` and ``\\r``, so that a value has one line."""
    return _text_columns(df, lambda c: F.replace(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r")))


def unescaped(df: DataFrame) -> DataFrame:
    """The values that ``escaped`` was given."""
    # A doubled backslash is set aside as a character that no text holds (U+FFFF is not one).
    aside = F.lit("\uffff")

    def undo(c: Column) -> Column:
        c = F.replace(c, F.lit("\\\\"), aside)
        c = F.replace(F.replace(c, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))
        return F.replace(c, aside, F.lit("\\"))

    return _text_columns(df, undo)


def _text_columns(df: DataFrame, change: Callable[[Column], Column]) -> DataFrame:
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return df.select(*(change(F.col(f"`{c}`")).alias(c) if c in text else F.col(f"`{c}`") for c in df.columns))
