"""Physical plans: what must and must not appear where data is large."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from aval.operators import metrics as mt
from aval.plans import pipeline as pl
from aval.sources import derived as dv

SQL_QUERIES = [n for n in sorted(entry.oracle_sql()) if not n.startswith("silhouette_euclid")
               and n != "silhouette_mean"]


@pytest.fixture
def no_small_broadcasts(spark):
    """Plan as for tables above the broadcast limit."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in SQL_QUERIES if n in (
    "approval_summary", "labelled_table", "merge_sources", "approval_label", "client_table",
    "quality_report_profile", "clean_history", "keep_first_event", "correlation_lineitem",
    "stratified_split", "kfold_assign", "prepare_clients", "auc_exact", "roc_points",
    "document_clients", "nearest_centre")])
def test_no_python_no_pairs_no_single_task_window(spark, sf_dir, no_small_broadcasts, name):
    text = plan(entry.queries()[name](spark, sf_dir))
    for operator in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text
    for window in re.findall(r"Window \[.*", text):
        assert "specifiedwindow" not in window or re.search(r"windowspecdefinition\((?!\w+#\d+L? (ASC|DESC))", window)


def exchanges(df):
    return len(re.findall(r"Exchange hashpartitioning", plan(df)))


def test_number_of_shuffles(spark, sf_dir, no_small_broadcasts):
    sources = dv.raw_sources(spark, sf_dir)
    assert exchanges(pl.client_labels(*sources)) == 1
    assert exchanges(pl.client_rows(*sources)) == 2
    clients = spark.createDataFrame([("a", 1, 0.5, 1)], "ID_Cliente string, x int, y double, credito_aprobado int")
    assert exchanges(clients.withColumn("z", F.lit(1))) == 0


def test_labels_read_only_their_columns(spark, sf_dir):
    text = plan(pl.client_labels(*dv.raw_sources(spark, sf_dir)))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert any(s.startswith("o_orderkey:bigint,o_custkey:bigint") and "o_totalprice" not in s for s in schemas)
    assert not any("c_acctbal" in s or "c_mktsegment" in s for s in schemas)


def test_merge_reuses_its_shuffles_and_splits_a_heavy_client(spark, no_small_broadcasts):
    """The same exchanges serve both parts, and AQE splits the client that owns most rows."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        from aval.operators.cleaning import clean_history
        from aval.operators.merge import merge_sources

        history = clean_history(spark.range(200_000, numPartitions=8).selectExpr(
            "if(id % 3 = 0, 'HOT', concat('C', id % 5000)) as ID_Cliente", "id * 1.0D as Monto_Transaccion",
            "'MXN' as Moneda", "id * 0.5D as Saldo_Promedio_Mensual", "1.0D as Frecuencia_Deposito"))
        people = spark.range(5000).selectExpr("concat('C', id) as ID_Cliente", "30.0D as Edad").union(
            spark.createDataFrame([("HOT", 40.0)], "ID_Cliente string, Edad double"))
        bureau = people.select("ID_Cliente", F.lit(700.0).alias("Score_Buro"))
        merged = merge_sources(people, history, bureau)
        rows = merged.collect()
        assert len(rows) == 200_000 and sum(r["Edad"] == 40.0 for r in rows) == 66_667
        text = plan(merged)
        assert "ReusedExchange" in text or "ReusedQueryStage" in text
        assert "skew=true" in text
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_ranking_windows_are_partitioned_by_bucket(spark, sf_dir, no_small_broadcasts):
    scored = entry._scored_orders(spark, sf_dir)
    text = plan(mt.auc(scored))
    assert re.search(r"Window .*windowspecdefinition\(m#\d+, b#\d+, s#\d+", text)
