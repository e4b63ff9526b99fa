import pytest

from aval import config as c
from aval.errors import MissingColumnsError, UnknownSourceError, ValidationError
from aval.operators import cleaning as cl
from aval.operators import quality as q

PROFILE = "_seq long, ID_Cliente string, Edad string, Ingreso_Declarado string, " \
          "Antiguedad_Laboral string, Tipo_Vivienda string"
HISTORY = "ID_Cliente string, Monto_Transaccion double, Moneda string, " \
          "Saldo_Promedio_Mensual double, Frecuencia_Deposito int"
BUREAU = "_seq long, ID_Cliente string, Score_Buro double, Creditos_Activos double, " \
         "Mantiene_Morosidad_Previa string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def profile(spark):
    return spark.createDataFrame([
        (3, "A", "70", "10", "1", " Propia\t"), (1, "A", "71", "5", None, "renta"),
        (2, "B", "18", "abc", "2", None), (4, "B", "18", "abc", "2", None),
        (5, None, "17", "1", "1", "propia"), (6, None, "30", "1", "1", "propia"),
    ], PROFILE).repartition(3)


def test_profile_keeps_first_row_and_nulls_bad_values(profile):
    assert rows(cl.clean_profile(profile)) == sorted([
        ("A", None, 5.0, None, 0), ("B", 18.0, None, 2.0, 0), (None, None, 1.0, 1.0, 1)], key=repr)


def test_bureau_prefix_delinquency_and_missing_id(spark):
    df = spark.createDataFrame([
        (1, "CLIENTE_7", 1.0, 1.0, "SI"), (2, "cliente_7", 9.0, 9.0, "no"), (3, "xCLIENTE_7", 2.0, 2.0, None),
        (4, None, 3.0, 3.0, "1")], BUREAU)
    assert rows(cl.clean_bureau(df)) == sorted([
        ("CLI-7", 1.0, 1.0, 1), ("xCLIENTE_7", 2.0, 2.0, 0), (None, 3.0, 3.0, 1)], key=repr)


def test_history_converts_then_removes_identical_rows(spark):
    df = spark.createDataFrame([
        ("A", 100.0, " usd ", 10.0, 1), ("A", 1500.0, "MXN", 150.0, 1), ("A", 1500.0, None, 150.0, 1),
        ("A", 5.0, "EUR", float("nan"), 0), ("A", None, "USD", None, 2)], HISTORY)
    assert rows(cl.clean_history(df)) == sorted([
        ("A", 1500.0, "MXN", 150.0, 1.0), ("A", 5.0, "EUR", None, 0.0), ("A", None, "MXN", None, 2.0)],
        key=repr)
    doubled = cl.clean_history(df, c.CleaningConfig(usd_rate=20))
    assert (("A", 2000.0, "MXN", 200.0, 1.0)) in rows(doubled)


def test_keep_first_is_independent_of_partitioning(spark):
    df = spark.range(5000).selectExpr("id % 37 as k", "cast(id as string) as v", "5000 - id as _seq")
    few = rows(cl.keep_first(df.repartition(1), ["k"]))
    many = rows(cl.keep_first(df.repartition(16, "v"), ["k"]))
    assert few == many and len(few) == 37


def test_columns_are_required_in_contract_order(spark):
    df = spark.createDataFrame([("A", "1")], "ID_Cliente string, Edad string")
    with pytest.raises(MissingColumnsError, match="Ingreso_Declarado, Antiguedad_Laboral, Tipo_Vivienda"):
        cl.clean_profile(df)


def test_quality_report_counts(profile):
    report = q.quality_report(profile, c.PROFILE_SOURCE)
    row = report.frame.first()
    assert (row["rows"], row["duplicates"], row["repeated_ids"], row["atypical_ages"]) == (6, 1, 3, 2)
    assert row["valid_structure"] and row["missing"]["Tipo_Vivienda"] == 2
    table = {r["columna"]: r["faltantes"] for r in report.by_column().collect()}
    assert table == {"ID_Cliente": 2, "Edad": 0, "Ingreso_Declarado": 0, "Antiguedad_Laboral": 1,
                     "Tipo_Vivienda": 2}


def test_quality_report_with_absent_and_extra_columns(spark):
    df = spark.createDataFrame([(1.0, "x"), (float("nan"), "x"), (None, "x")], "Edad double, otro string")
    row = q.quality_report(df, c.PROFILE_SOURCE).frame.first()
    assert row["missing_columns"] == ["ID_Cliente", "Ingreso_Declarado", "Antiguedad_Laboral",
                                      "Tipo_Vivienda"]
    assert row["extra_columns"] == ["otro"] and row["repeated_ids"] is None
    assert row["missing"]["Edad"] == 2 and row["duplicates"] == 1  # NaN and NULL are one "missing"
    assert not row["valid_structure"]


def test_quality_of_an_empty_source(spark):
    row = q.quality_report(spark.createDataFrame([], HISTORY), c.HISTORY_SOURCE).frame.first()
    assert row["rows"] == 0 and row["duplicates"] == 0 and row["missing"]["Moneda"] == 0


def test_comparison_drops_what_does_not_apply(spark, profile):
    before = q.quality_report(profile, c.PROFILE_SOURCE)
    after = q.quality_report(cl.clean_profile(profile), c.PROFILE_SOURCE)
    table = {r["indicador"]: (r["antes"], r["después"]) for r in q.compare_quality(before, after).collect()}
    assert table["Filas"] == (6, 3) and table["Edades atípicas"] == (2, 0)
    assert table["Faltantes: Edad"] == (0, 2) and "Faltantes: _seq" not in table
    history = spark.createDataFrame([("A", 1.0, "MXN", 1.0, 1)], HISTORY)
    other = q.quality_report(history, c.HISTORY_SOURCE)
    assert "IDs repetidos" not in {r["indicador"] for r in q.compare_quality(other, other).collect()}
    with pytest.raises(ValidationError):
        q.compare_quality(before, other)
    with pytest.raises(UnknownSourceError):
        q.quality_report(history, "otra")
