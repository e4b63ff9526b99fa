import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from aval.functions.statistics import exact_medians, modes, value_counts, values_at_ranks

values = st.lists(st.one_of(st.sampled_from([0.0, 1.0, 1.0, 1.0, 2.5]),
                            st.floats(-1e6, 1e6, allow_nan=False)), min_size=1, max_size=60)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values)
def test_bracket_search_equals_sorting(spark, data):
    df = spark.createDataFrame([(v,) for v in data] + [(None,)], "v double").repartition(3)
    ranks = sorted({0, len(data) // 2, len(data) - 1})
    found = values_at_ranks(df, [("v", r, len(data)) for r in ranks], direct_rows=3)
    assert found == [sorted(data)[r] for r in ranks]


@pytest.mark.parametrize("limit", [1, 50, 3_000, 1_000_000])
def test_medians_are_the_same_on_both_paths(spark, limit):
    df = spark.range(2001).selectExpr(
        "id * id * 1.0D as skewed", "if(id < 1500, 7.0D, id * 1.0D) as heavy",
        "if(id % 2 = 0, null, id * 1.0D) as gaps", "nanvl(if(id = 0, 0D/1D, id * 1.0D), null) as plain")
    counts = df.selectExpr("count(skewed) skewed", "count(heavy) heavy", "count(gaps) gaps",
                           "count(plain) plain").first().asDict()
    found = exact_medians(df, counts, direct_rows=limit)
    pdf = df.toPandas()
    assert found == {n: statistics.median(pdf[n].dropna()) for n in counts}


def test_even_count_interpolates(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "v double")
    assert exact_medians(df, {"v": 4}, 1) == exact_medians(df, {"v": 4}) == {"v": 2.5}


def test_mode_takes_the_smallest_on_a_tie(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "y"), ("b", None), ("a", "y"), (None, "x")],
                               "t string, u string")
    found = {r["columna"]: (r["moda"], r["categorias"]) for r in modes(value_counts(df, ["t", "u"])).collect()}
    assert found == {"t": ("a", 2), "u": ("x", 2)}
