import pytest
from pyspark.sql import functions as F

from aval import config as c
from aval.errors import PreparationError, RuleColumnsError
from aval.operators import aggregate as ag
from aval.operators import merge as mg
from aval.operators import target as tg
from aval.plans import pipeline as pl
from aval.sources import derived as dv


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def sources(spark):
    profile = spark.createDataFrame(
        [("A", 30.0, 0), ("B", 70.0, 1), (None, 40.0, 1)], "ID_Cliente string, Edad double, Tipo_Vivienda int")
    history = spark.createDataFrame(
        [("A", 1.0), ("A", 0.0), ("H", 2.0), (None, 3.0), (None, 4.0)],
        "ID_Cliente string, Frecuencia_Deposito double")
    bureau = spark.createDataFrame(
        [("A", 700.0, 0), ("B", 700.0, 0), ("X", 650.0, 0), (None, 610.0, 0)],
        "ID_Cliente string, Score_Buro double, Mantiene_Morosidad_Previa int")
    return profile, history, bureau


def test_merge_keeps_everyone_and_matches_missing_keys(sources):
    merged = mg.merge_sources(*sources)
    assert merged.columns == ["ID_Cliente", "Edad", "Tipo_Vivienda", "Frecuencia_Deposito", "Score_Buro",
                              "Mantiene_Morosidad_Previa", "credito_aprobado"]
    assert rows(merged) == sorted([
        ("A", 30.0, 0, 1.0, 700.0, 0, 0), ("A", 30.0, 0, 0.0, 700.0, 0, 0),
        ("B", 70.0, 1, None, 700.0, 0, 0), ("H", None, None, 2.0, None, None, 0),
        ("X", None, None, None, 650.0, 0, 0), (None, 40.0, 1, 3.0, 610.0, 0, 0),
        (None, 40.0, 1, 4.0, 610.0, 0, 0)], key=repr)


def test_merge_multiplies_like_a_full_outer_join(spark):
    left = spark.createDataFrame([("A", 1), ("A", 2)], "ID_Cliente string, p int")
    mid = spark.createDataFrame([("A", 10), ("A", 20)], "ID_Cliente string, h int")
    right = spark.createDataFrame([("A", 100), ("A", 200)], "ID_Cliente string, b int")
    assert mg.merge_sources(left, mid, right).count() == 8


RULE = "ID_Cliente string, Edad double, Score_Buro double, Mantiene_Morosidad_Previa int, " \
       "Frecuencia_Deposito double"


def test_rule_edges(spark):
    df = spark.createDataFrame([
        ("ok", 69.0, 601.0, 0, 0.0), ("ok", 69.0, 601.0, 0, 1.0),     # any deposit is enough
        ("age", 70.0, 700.0, 0, 1.0), ("score", 30.0, 600.0, 0, 1.0), ("late", 30.0, 700.0, 1, 1.0),
        ("two", 30.0, 700.0, 2, 1.0), ("none", 30.0, 700.0, 0, 0.0), ("gap", None, 700.0, 0, 1.0),
        ("mixed", 30.0, 700.0, 0, 1.0), ("mixed", 30.0, 500.0, 0, 1.0),  # every row must comply
        (None, 30.0, 700.0, 0, 1.0)], RULE)
    labels = {(r["ID_Cliente"], r["credito_aprobado"]) for r in tg.label_approval(df).collect()}
    assert labels == {("ok", 1), ("age", 0), ("score", 0), ("late", 0), ("two", 0), ("none", 0),
                      ("gap", 0), ("mixed", 0), (None, 0)}
    relaxed = tg.label_approval(df, c.ApprovalRule(max_age=70, score_above=599))
    assert {r["ID_Cliente"] for r in relaxed.collect() if r["credito_aprobado"]} == {"ok", "age", "score"}


def test_rule_on_text_and_empty_tables(spark):
    text = spark.createDataFrame([("a", "30", "x", "0", "1")],
                                 "ID_Cliente string, Edad string, Score_Buro string, "
                                 "Mantiene_Morosidad_Previa string, Frecuencia_Deposito string")
    assert tg.label_approval(text).first()["credito_aprobado"] == 0
    empty = tg.label_approval(spark.createDataFrame([], RULE))
    assert empty.count() == 0 and dict(empty.dtypes)["credito_aprobado"] == "int"
    with pytest.raises(RuleColumnsError, match="Edad, Score_Buro"):
        tg.label_approval(text.drop("Edad", "Score_Buro"))


def test_summary_always_has_both_classes(spark):
    df = spark.createDataFrame([("a", 0), ("a", 0), ("b", 0)], "ID_Cliente string, credito_aprobado int")
    assert rows(tg.approval_summary(df)) == [(0, 2), (1, 0)]


def test_rejection_reasons_in_order(spark):
    df = spark.createDataFrame(
        [("a", None, None, None, None), ("b", 30.0, 700.0, 0, 1.0), ("c", 30.0, 700.0, 0, 0.0)],
        "ID_Cliente string, Edad double, Score_Buro double, Mantiene_Morosidad_Previa int, "
        "Frecuencia_Deposito_Max double")
    found = {r["ID_Cliente"]: r["motivos"] for r in tg.rejection_reasons(df).collect()}
    assert [m.split()[0] for m in found["a"]] == ["edad", "score", "tiene", "sin"]
    assert found["b"] == [] and found["c"] == ["sin depósitos registrados"]


def test_aggregate_by_client(spark):
    df = spark.createDataFrame([
        ("a", None, "MXN", 2.0, 1, None, 3), ("a", None, "MXN", None, None, "x", 1),
        ("b", 5.0, "MXN", None, None, None, 2), ("b", 2.0, "MXN", None, None, "z", 4), (None, 1.0, "MXN", 1.0, 1, "q", 5)],
        "ID_Cliente string, Monto_Transaccion double, Moneda string, Saldo_Promedio_Mensual double, "
        "Frecuencia_Deposito int, otro string, _seq int")
    result = ag.aggregate_by_client(df, order="_seq")
    assert result.columns == ["ID_Cliente", "Monto_Total", "Saldo_Promedio_Mensual",
                              "Frecuencia_Deposito_Max", "Num_Transacciones", "otro"]
    assert rows(result) == [("a", None, 2.0, 1, 1, "x"), ("b", 7.0, None, None, 0, "z")]
    with pytest.raises(PreparationError):
        ag.aggregate_by_client(df.drop("ID_Cliente"))


def test_short_and_long_way_agree(spark, sf_dir):
    sources = dv.raw_sources(spark, sf_dir)
    short = pl.client_rows(*sources)
    long = pl.client_rows_from_combined(pl.combined_table(*sources))

    def rounded(df):
        return sorted(repr([round(v, 4) if isinstance(v, float) else v for v in r])
                      for r in df.select(*short.columns).collect())

    assert rounded(short) == rounded(long)
    labels = rows(pl.client_labels(*sources))
    assert labels == rows(short.select(c.ID, c.TARGET))


def test_class_distribution_and_correlations(spark):
    df = spark.createDataFrame(
        [(1, 1.0, 5.0, 1, 7.0), (2, 2.0, 5.0, 1, None), (3, 3.0, 5.0, 0, None), (4, float("nan"), 5.0, 0, 7.0)],
        "ID_Cliente int, x double, k double, credito_aprobado int, partial double")
    dist = {r["codigo"]: r for r in ag.class_distribution(df).collect()}
    assert dist[0]["clientes"] == 2 and dist[1]["proporcion"] == 0.5 and not dist[0]["desbalanceada"]
    matrix = {(r[0], r[1]): r[2] for r in ag.correlation_matrix(df).collect()}
    assert set(matrix) == {(a, b) for a in ("x", "credito_aprobado") for b in ("x", "credito_aprobado")}
    assert abs(matrix[("x", "credito_aprobado")] - -0.8660254037844387) < 1e-12
    target = ag.correlation_with_target(df).first()
    assert target["moderada"] and not target["positiva"] and not target["nula"]


def test_correlation_of_a_pair_constant_on_shared_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (5.0, None)], "a double, b double")
    matrix = {(r[0], r[1]): r[2] for r in ag.correlation_matrix(df).collect()}
    assert matrix[("a", "b")] is None and matrix[("a", "a")] == 1.0


def test_heavy_client_is_whole(spark):
    """One client holding most transactions gets every row back, once."""
    history = spark.range(20_000).selectExpr(
        "case when id % 3 = 0 then 'A' else concat('C', id) end as ID_Cliente",
        "cast(id as double) as Frecuencia_Deposito")
    profile = spark.createDataFrame([("A", 30.0), ("Z", 31.0)], "ID_Cliente string, Edad double")
    bureau = spark.createDataFrame([("A", 700.0, 0)],
                                   "ID_Cliente string, Score_Buro double, Mantiene_Morosidad_Previa int")
    merged = tg.label_approval(mg.merge_sources(profile, history, bureau))
    counts = {r[0]: r[1] for r in merged.groupBy("credito_aprobado").count().collect()}
    assert counts == {1: 6667, 0: 20_000 - 6667 + 1}


def test_extra_columns_reach_the_client_table(spark):
    profile = spark.createDataFrame(
        [(2, "a", "30", "1", "1", "propia", "norte"), (1, "a", "31", "1", "1", "propia", "sur")],
        "_seq long, ID_Cliente string, Edad string, Ingreso_Declarado string, Antiguedad_Laboral string, "
        "Tipo_Vivienda string, zona string")
    history = spark.createDataFrame(
        [("a", 5.0, "MXN", 1.0, 2, 7)], "ID_Cliente string, Monto_Transaccion double, Moneda string, "
        "Saldo_Promedio_Mensual double, Frecuencia_Deposito int, canal int")
    bureau = spark.createDataFrame(
        [(1, "CLIENTE_a", 1.0, 1.0, "no", 0.5)], "_seq long, ID_Cliente string, Score_Buro double, "
        "Creditos_Activos double, Mantiene_Morosidad_Previa string, mora double")
    bureau = bureau.withColumn("ID_Cliente", bureau["ID_Cliente"].substr(9, 1))
    short = pl.client_rows(profile, history, bureau)
    assert [n for n in short.columns if n in ("zona", "canal", "mora")] == ["zona", "canal", "mora"]
    row = short.first()
    assert (row["zona"], row["canal"], row["mora"], row["Edad"]) == ("sur", 7, 0.5, 31.0)
    long = pl.client_rows_from_combined(pl.combined_table(profile, history, bureau))
    assert rows(long.select(*short.columns)) == rows(short)


def test_large_lookups_are_not_broadcast(spark):
    from aval.errors import PreparationError
    from aval.operators.merge import attach_by_key

    rows = spark.range(20).withColumnRenamed("id", "k")
    assert attach_by_key(rows, rows.selectExpr("k", "k AS v"), "k", few_keys=True).count() == 20
    with pytest.raises(PreparationError, match="few_keys"):
        attach_by_key(rows, rows.selectExpr("k", "k AS v"), "k", few_keys=True, max_keys=19)


def test_correlations_equal_numpy_with_missing_values(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 5)) + [0, 1e6, -5, 0, 3]
    x[:, 3] = x[:, 0] * 2 + rng.normal(size=300)
    x[rng.random(x.shape) < 0.3] = np.nan
    rows = [tuple(None if np.isnan(v) and i % 2 else float(v) for v in r) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double").repartition(7)
    got = {(r[0], r[1]): r[2] for r in ag.correlation_matrix(df).collect()}
    assert len(got) == 25
    for i, a in enumerate("abcde"):
        for j, b in enumerate("abcde"):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            assert abs(got[a, b] - np.corrcoef(x[both, i], x[both, j])[0, 1]) < 1e-9


def test_correlations_of_a_thousand_columns(spark, tmp_path):
    """One row of sums per column and task; the rows that leave a task do not follow its input."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.parquet as pq

    x = np.random.default_rng(1).normal(size=(400, 1_000))
    pq.write_table(pa.table({f"c{i}": x[:, i] for i in range(1_000)}), tmp_path / "wide.parquet")
    got = ag.correlation_matrix(spark.read.parquet(str(tmp_path)))
    wanted = np.corrcoef(x[:, 3], x[:, 700])[0, 1]
    pair = (F.col("variable_1") == "c700") & (F.col("variable_2") == "c3")
    found = got.agg(F.count("*"), F.count_if(F.col("r").isNull()), F.max(F.when(pair, F.col("r")))).first()
    assert found[0] == 1_000_000 and found[1] == 0 and abs(found[2] - wanted) < 1e-9
