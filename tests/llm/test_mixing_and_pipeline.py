import os

import brute
import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from aval.llm import decontaminate, language_id, mixing, pii, quality_rules, simhash, substring_dedup, toxicity
from aval.llm.oracle import ORACLES
from aval.llm.words import word_count
from aval.session import shared_folder


def columns(rows):
    return sorted((tuple(sorted(r.items(), key=lambda kv: kv[0])) for r in rows), key=repr)


@pytest.mark.parametrize("rows_per_range", [10_000, 3])
def test_mix_equals_sql(spark, docs, rows_per_range):
    table = docs.union(docs.limit(4)).union(docs.withColumn("doc_id", F.lit(None).cast("long")))
    mixed = mixing.mix_sources(table, word_count(F.col("text")), rows_per_range=rows_per_range)
    got = mixed.select("doc_id", "size", "source_size", "target", "taken").toPandas()
    con = duckdb.connect()
    con.register("documents", table.select("doc_id", "text", "source").toPandas())
    want = con.execute(ORACLES["op7_mixing"]).df()
    key = list(got.columns)
    left, right = (sorted(map(repr, f[key].astype(float).fillna(-1).values.tolist())) for f in (got, want))
    assert left == right
    assert set(docs.columns) <= set(mixed.columns)


@pytest.mark.parametrize("rows_per_range", [10_000, 50])
def test_mix_of_a_hot_id_equals_sql(spark, rows_per_range):
    # Most rows have no id and few sizes, so the cut falls into a group of equal rows.
    table = spark.range(900).selectExpr(
        "if(id % 3 = 0, id, null) as doc_id", "if(id % 2 = 0, 'a', null) as source",
        "repeat('w ', cast(id % 5 as int)) as text", "id as other")
    mixed = mixing.mix_sources(table, word_count(F.col("text")), rows_per_range=rows_per_range)
    got = mixed.select("doc_id", "size", "source_size", "target", "taken").toPandas()
    con = duckdb.connect()
    con.register("documents", table.drop("other").toPandas())
    want = con.execute(ORACLES["op7_mixing"]).df()
    left, right = (sorted(map(repr, f[list(got.columns)].astype(float).fillna(-1).values.tolist()))
                   for f in (got, want))
    assert left == right
    again = mixing.mix_sources(table.repartition(7), word_count(F.col("text")), rows_per_range=rows_per_range)
    assert columns(r.asDict() for r in again.collect()) == columns(r.asDict() for r in mixed.collect())


def test_clashing_names_are_carried_or_replaced(spark, docs):
    odd = docs.withColumns({n: F.lit(1) for n in (
        "_mix", "_mix_key", "mix_source", "_removed", "_row", "row", "place", "_range", "edge", "hash")})
    mixed = mixing.mix_sources(odd, word_count(F.col("text")))
    assert set(mixed.columns) == {*odd.columns, *mixing.RESULTS} and mixed.count() == odd.count()
    assert mixed.where("_mix <> 1 or _mix_key <> 1 or row <> 1 or edge <> 1").count() == 0
    cut = substring_dedup.remove_repeated(odd)
    assert set(cut.columns) == {*odd.columns, "n_words", "n_removed", "kept_text"}
    assert cut.where("_removed <> 1").count() == 0
    marked = simhash.fingerprints(odd, odd.columns).withColumns({"component_id": F.lit("x"), "root": F.lit("y")})
    found = simhash.near_duplicates(marked, root="root")
    assert sorted(found.columns) == sorted(marked.columns) and dict(found.dtypes)["component_id"] == "bigint"


def test_mix_edges(spark, empty):
    assert mixing.mix_sources(empty, word_count(F.col("text"))).count() == 0
    zero = spark.createDataFrame([(1, "a", 0), (2, None, None)], "doc_id long, source string, n int")
    assert [r.taken for r in mixing.mix_sources(zero, F.col("n")).collect()] == [0, 0]


def test_operators_on_empty_tables(spark, empty, tmp_path):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert simhash.near_duplicates(simhash.fingerprints(empty, ["doc_id"])).count() == 0
    assert substring_dedup.remove_repeated(empty).count() == 0
    assert quality_rules.text_statistics(empty, ["doc_id"]).count() == 0
    assert pii.pseudonymise(empty, "k").count() == 0
    assert decontaminate.find_items(empty, bench, empty.columns).count() == 0
    assert toxicity.learn_toxicity(empty, labels, F.lit(True)).weights == {}
    assert language_id.learn_languages(empty).langs == []


def test_stages_keep_columns_and_clean_documents(spark, docs, tmp_path):
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "line of text line of text")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    repeated = docs.union(docs.limit(3)).union(
        docs.limit(1).withColumn("doc_id", F.lit(None).cast("long")).withColumn("text", F.lit("lonely words without an id")))
    clashing = {n: F.lit(1) for n in ("_mix_key", "_row", "_fp", "_toxicity", "_matches", "_least", "_root")}
    repeated.withColumns(clashing).write.parquet(f"{tmp_path}/documents.parquet")
    rows = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert set(rows.columns) < set(corpus_pipeline.mix(spark, rows, "").columns)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, rows, str(tmp_path))
        assert kept.schema == rows.schema, name
        assert kept.where("_row <> 1 or _toxicity <> 1 or _matches <> 1 or _fp <> 1").count() == 0, name
    ids = [r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, rows, "").collect()]
    all_rows = [(r.doc_id, brute.fingerprint(r.text)) for r in rows.collect()]
    assert sorted(map(repr, ids)) == sorted(map(repr, set(brute.components(all_rows))))
    left = {r.doc_id for r in corpus_pipeline.drop_contaminated(spark, rows, str(tmp_path)).collect()}
    assert 10 not in left and {1, 2, 7, 8} <= left
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.where("taken <= 0 or taken > 2 * size").count() == 0 and out.count() > 3
    empty_dir = f"{tmp_path}/empty"
    for name in ("labels", "benchmark", "documents"):
        spark.read.parquet(f"{tmp_path}/{name}.parquet").limit(0).write.parquet(f"{empty_dir}/{name}.parquet")
    assert corpus_pipeline.run(spark, empty_dir).count() == 0


def test_a_run_leaves_its_result_only_and_takes_a_key(spark, tmp_path):
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "not in any text")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame(
        [(n, f"born on 1980-02-{10 + n} as number {n} of {n * n} people", "s") for n in range(9)],
        "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    before = set(os.listdir(shared_folder(spark)))
    texts = {}
    for key in ("one", "two", "one"):
        out = corpus_pipeline.run(spark, str(tmp_path), key)
        texts.setdefault(key, []).append(sorted((r.doc_id, r.text) for r in out.collect()))
    left = set(os.listdir(shared_folder(spark))) - before
    assert sorted(name.rsplit("-", 1)[0] for name in left) == ["stage-5"] * 3
    assert texts["one"][0] == texts["one"][1] != texts["two"][0]
    assert spark.conf.get("spark.aval.pseudonymKey", None) is None


def test_classes_without_an_id_or_with_one_id_keep_a_row_each(spark):
    one, two, three = ("alpha beta gamma delta epsilon", "red green blue black white grey", "just some other words")
    table = spark.createDataFrame(
        [(None, one), (None, two), (None, two), (5, one + " zeta"), (5, three), (9, three)], "doc_id long, text string")
    marked = simhash.fingerprints(table, ["doc_id", "text"])
    classes = simhash.near_duplicates(marked, root="root").collect()
    assert {(r.text, r.doc_id): r.component_id for r in classes} == {
        (one, None): None, (two, None): None, (one + " zeta", 5): 5, (three, 5): 5, (three, 9): 5}
    assert len({r.root for r in classes}) == 4 == len({(r.text, r.root) for r in classes})
    kept = corpus_pipeline.drop_near_duplicates(spark, table, "").collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == [
        (0, one), (0, two), (5, one + " zeta"), (5, three)]


def test_near_duplicates_are_dropped_without_a_shuffle_of_texts(spark):
    """What stays is joined as bits: a broadcast where the row numbers themselves were too many for one."""
    rows = [(n, " ".join(f"w{(n * 7919 + i * i * 31) % 9973}" for i in range(30))) for n in range(3_000)]
    docs = spark.createDataFrame(rows + rows[:500], "doc_id long, text string").repartition(3)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "8k")
    try:
        kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
        ids = [r.doc_id for r in kept.collect()]
        plan = kept._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    found = simhash.near_duplicates(simhash.fingerprints(docs, ["doc_id"])).toPandas()
    assert sorted(ids) == sorted(set(found["component_id"]))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
