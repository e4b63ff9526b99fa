"""Column expressions for tolerant cleaning. All are JVM-side built-ins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aval import config as c

#: What counts as a number in text: optional sign, decimals, exponent, surrounding blanks.
#: It rejects forms that Spark's own cast accepts ('1d', 'inf', hexadecimal).
NUMBER_PATTERN = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
BLANKS = " \t\n\r\f\x0b"


def col(name: str) -> Column:
    """Reference a column whatever characters its name contains."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_fractional(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.DoubleType, T.FloatType))


def is_numeric(dtype: T.DataType) -> bool:
    """Numbers and booleans count as numeric, as they do in the source data model."""
    return isinstance(dtype, (T.NumericType, T.BooleanType))


def strip(value: Column) -> Column:
    """Trim every kind of blank, not only spaces."""
    return F.btrim(value, F.lit(BLANKS))


def without_nan(value: Column, dtype: T.DataType) -> Column:
    """NULL is the only missing value: NaN becomes NULL."""
    return F.when(~F.isnan(value), value) if is_fractional(dtype) else value


def nan_to_null(df: DataFrame) -> DataFrame:
    """Apply :func:`without_nan` to every fractional column; a no-op projection otherwise."""
    if not any(is_fractional(f.dataType) for f in df.schema):
        return df
    return df.select(
        *[without_nan(col(f.name), f.dataType).alias(f.name) for f in df.schema]
    )


def number_from_text(value: Column) -> Column:
    """A text as a double, NULL when it is not a number."""
    return F.when(value.rlike(NUMBER_PATTERN), strip(value).try_cast("double"))


def yes_from_text(value: Column) -> Column:
    """A text as 1 when it is one of the accepted words, otherwise (or missing) 0."""
    return F.when(F.lower(strip(value)).isin(*c.YES_WORDS), 1).otherwise(0)


def tolerant_number(df: DataFrame, name: str) -> Column:
    """``name`` as a double; anything that is not a number becomes NULL."""
    dtype = df.schema[name].dataType
    value = col(name)
    if isinstance(dtype, T.StringType):
        return number_from_text(value)
    if isinstance(dtype, T.BooleanType):
        return value.cast("int").cast("double")
    if isinstance(dtype, T.NumericType):
        return without_nan(value.cast("double"), T.DoubleType())
    return F.lit(None).cast("double")


def between_or_null(value: Column, low: float, high: float) -> Column:
    """Keep values inside the inclusive bounds, NULL otherwise."""
    return F.when(value.between(low, high), value)


def yes_no(df: DataFrame, name: str) -> Column:
    """Yes/no to 1/0. Missing is 0; a number is truncated and deliberately not clamped."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.StringType):
        return yes_from_text(col(name))
    number = without_nan(col(name), dtype)
    return F.coalesce(number.try_cast("int"), F.lit(0))


def equals_word(value: Column, word: str) -> Column:
    """1 when the text, trimmed and lower-cased, is ``word``; 0 otherwise and when missing."""
    return F.when(F.lower(strip(value.cast("string"))) == word, 1).otherwise(0)


def normalise_null_tokens(df: DataFrame, tokens: tuple[str, ...] = c.NULL_TOKENS) -> DataFrame:
    """Turn the usual textual spellings of "missing" into NULL in every string column."""
    return df.select(
        *[
            F.when(~col(f.name).isin(*tokens), col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else col(f.name)
            for f in df.schema
        ]
    )


def display_missing(df: DataFrame, text: str = c.MISSING_TEXT) -> DataFrame:
    """Every column as text, with missing shown as ``text``."""
    return nan_to_null(df).select(
        *[F.coalesce(col(n).cast("string"), F.lit(text)).alias(n) for n in df.columns]
    )
