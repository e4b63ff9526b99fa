"""Cleaning of the three sources: normalise, convert, de-duplicate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aval import config as c
from aval.functions.values import (
    between_or_null,
    col,
    equals_word,
    strip,
    tolerant_number,
    yes_no,
)
from aval.operators.quality import require_columns
from aval.sources.order import with_sequence

_FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.NullType)


def drop_identical(df: DataFrame, ignore: tuple[str, ...] = (c.SEQ,)) -> DataFrame:
    """Drop repeated rows. Copies collapse map-side and the shuffle hashes whole rows, so
    neither a heavily copied row nor a heavy id makes one task large."""
    return df.drop(*ignore).distinct()


def first_identical(df: DataFrame, order: str = c.SEQ) -> DataFrame:
    """``drop_identical`` with the smallest ``order`` of the copies of each row."""
    return df.groupBy(*[col(n) for n in df.columns if n != order]).agg(F.min(order).alias(order))


def keep_first(df: DataFrame, keys: list[str], order: str | Column = c.SEQ) -> DataFrame:
    """One row per key: the one with the smallest ``order``. Missing keys count as one value.

    An aggregation with map-side combine, not a window: each task sends one row per key.
    Fixed-width columns are picked one by one so the hash aggregate stays in place; a struct
    is used as soon as a variable-width column is present.
    """
    position = F.col(order) if isinstance(order, str) else order
    values = [n for n in df.columns if n not in keys and n != order]
    grouped = df.groupBy(*[col(k) for k in keys])
    if not values:
        return df.select(*[col(k) for k in keys]).distinct()
    if all(isinstance(df.schema[n].dataType, _FIXED_WIDTH) for n in values):
        picked = grouped.agg(*[F.min_by(col(n), position).alias(n) for n in values])
    else:
        picked = grouped.agg(F.min_by(F.struct(*[col(n) for n in values]), position).alias("_r"))
        picked = picked.select(*[col(k) for k in keys], "_r.*")
    return picked.select(*[col(n) for n in df.columns if n != order])


def normalise_profile(df: DataFrame, config: c.CleaningConfig | None = None) -> DataFrame:
    """Profile values in clean form; rows are kept, one for one."""
    config = config or c.CleaningConfig()
    require_columns(df, c.PROFILE_SOURCE)
    typed = df.withColumns({
        c.AGE: tolerant_number(df, c.AGE),
        c.INCOME: tolerant_number(df, c.INCOME),
        c.SENIORITY: tolerant_number(df, c.SENIORITY),
        c.HOUSING: equals_word(col(c.HOUSING), c.OWNED_HOUSING),
    })
    # A second step, so that the text is parsed once and not once per comparison.
    return typed.withColumn(
        c.AGE, between_or_null(col(c.AGE), config.min_age, config.max_age)
    )


def normalise_bureau(df: DataFrame) -> DataFrame:
    """Bureau values in clean form; a missing id stays missing."""
    require_columns(df, c.BUREAU_SOURCE)
    return df.withColumns({
        c.ID: F.regexp_replace(col(c.ID).cast("string"), c.BUREAU_ID_PREFIX, c.HOME_ID_PREFIX),
        c.SCORE: tolerant_number(df, c.SCORE),
        c.CREDITS: tolerant_number(df, c.CREDITS),
        c.DELINQUENCY: yes_no(df, c.DELINQUENCY),
    })


def normalise_history(df: DataFrame, config: c.CleaningConfig | None = None) -> DataFrame:
    """History amounts as numbers in the home currency; missing currency is the home one.

    Currencies other than the two known ones are neither converted nor flagged.
    """
    config = config or c.CleaningConfig()
    require_columns(df, c.HISTORY_SOURCE)
    currency = F.coalesce(col(c.CURRENCY).cast("string"), F.lit(c.HOME_CURRENCY))
    foreign = F.upper(strip(currency)) == c.FOREIGN_CURRENCY
    rate = float(config.usd_rate)
    amount, balance = tolerant_number(df, c.AMOUNT), tolerant_number(df, c.BALANCE)
    return df.withColumns({
        c.AMOUNT: F.when(foreign, amount * rate).otherwise(amount),
        c.BALANCE: F.when(foreign, balance * rate).otherwise(balance),
        c.FREQUENCY: tolerant_number(df, c.FREQUENCY),
        c.CURRENCY: F.when(foreign, F.lit(c.HOME_CURRENCY)).otherwise(currency),
    })


def clean_profile(df: DataFrame, config: c.CleaningConfig | None = None) -> DataFrame:
    """One clean row per client. Keeping the first row of each id also removes identical rows."""
    return keep_first(normalise_profile(with_sequence(df), config), [c.ID])


def clean_bureau(df: DataFrame) -> DataFrame:
    """One clean row per client."""
    return keep_first(normalise_bureau(with_sequence(df)), [c.ID])


def clean_history(df: DataFrame, config: c.CleaningConfig | None = None,
                  keep_sequence: bool = False) -> DataFrame:
    """Clean transactions without identical rows; a client may keep several.

    ``keep_sequence`` keeps the place of the first copy, which tells the first value of columns
    beyond the contract.
    """
    if keep_sequence:
        return first_identical(normalise_history(with_sequence(df), config))
    return drop_identical(normalise_history(df, config))
