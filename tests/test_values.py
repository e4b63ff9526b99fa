from aval.functions.values import (
    display_missing, nan_to_null, normalise_null_tokens, tolerant_number, yes_no,
)


def one(df, expression):
    return [r[0] for r in df.select(expression.alias("v")).collect()]


def test_tolerant_number_accepts_numbers_only(spark):
    texts = [" 12 ", "1e3", "\t-7.\n", ".5", "1d", "1_000", "abc", "", "inf", "nan", None, "0x1A", "+3",
             "1e400"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    assert one(df, tolerant_number(df, "t")) == [
        12.0, 1000.0, -7.0, 0.5, None, None, None, None, None, None, None, None, 3.0, float("inf")]


def test_tolerant_number_on_typed_columns(spark):
    df = spark.createDataFrame([(float("nan"), 3, True), (1.5, None, False)],
                               "d double, i int, b boolean").coalesce(1)
    assert one(df, tolerant_number(df, "d")) == [None, 1.5]
    assert one(df, tolerant_number(df, "i")) == [3.0, None]
    assert one(df, tolerant_number(df, "b")) == [1.0, 0.0]


def test_yes_no_text_and_numbers(spark):
    texts = ["SI", " Sí ", "1", "TRUE", "no", "1.0", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    assert one(df, yes_no(df, "t")) == [1, 1, 1, 1, 0, 0, 0, 0]
    numbers = spark.createDataFrame([(2.9,), (0.0,), (float("nan"),), (None,)], "t double").coalesce(1)
    assert one(numbers, yes_no(numbers, "t")) == [2, 0, 0, 0]  # truncated, not clamped
    flags = spark.createDataFrame([(True,), (False,)], "t boolean").coalesce(1)
    assert one(flags, yes_no(flags, "t")) == [1, 0]


def test_null_tokens_and_display(spark):
    df = spark.createDataFrame([("NA", 1.0), ("ND", float("nan")), ("x", None)], "t string, d double")
    rows = {tuple(r) for r in normalise_null_tokens(nan_to_null(df)).collect()}
    assert rows == {(None, 1.0), ("ND", None), ("x", None)}
    shown = {tuple(r) for r in display_missing(df).collect()}
    assert shown == {("NA", "1.0"), ("ND", "ND"), ("x", "ND")}
