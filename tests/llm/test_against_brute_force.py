import random

import brute
import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from aval.llm import decontaminate, quality_rules, simhash, substring_dedup
from aval.llm.oracle import ORACLES


def test_quality_counts(docs, texts):
    rows = quality_rules.text_statistics(docs, ["doc_id"]).collect()
    got = {r.doc_id: tuple(r[1:6]) for r in rows}
    short = [(i, t) for i, t in texts if len(t or "") < 10_000]
    assert {i: got[i] for i, _ in short} == {i: brute.quality_counts(t) for i, t in short}
    assert got[8][0] == 60_000 and got[8][4] == 60_000


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from("ab"), max_size=40), st.sampled_from([" ", "\n", "\t "]))
def test_repeated_windows_of_small_alphabets(words, gap):
    text = gap.join(words)
    assert quality_rules._statistics(text, 5)[:5] == brute.quality_counts(text)


def test_fingerprints_and_components(spark, docs, texts):
    more = [(100 + i, t) for i, t in texts] + [(None, "three words only"), (None, "quite alone here now ok")]
    table = spark.createDataFrame(texts + more + texts[:3], "doc_id long, text string")
    marked = simhash.fingerprints(table, ["doc_id"])
    rows = simhash.near_duplicates(marked).collect()
    want = [(i, brute.fingerprint(t)) for i, t in texts + more + texts[:3]]
    expected = sorted(
        (repr(i), f, repr(c)) for (i, f), c in zip(want, brute.components(want)))
    assert sorted((repr(r.doc_id), r.fp % 2**64, repr(r.component_id)) for r in rows) == expected


@pytest.mark.parametrize("group_rows", [1 << 18, 40])
def test_close_fingerprints_in_small_tiles(spark, group_rows):
    random.seed(5)
    base = [random.getrandbits(64) for _ in range(30)]
    values = {b ^ sum(1 << random.randrange(64) for _ in range(random.randrange(6))) for b in base * 8}
    rows = [(n, v) for n, v in enumerate(sorted(values))]
    signed = [(n, v - 2**64 if v >= 2**63 else v) for n, v in rows]
    table = spark.createDataFrame(signed, "doc_id long, fp long")
    links = simhash.fingerprint_links(table.select("fp"), 4, tile_rows=4, group_rows=group_rows)
    from aval.llm.components import connected_components

    assert links.where("bit_count(a ^ b) > 4").count() == 0
    joined = {r.node: r.root for r in connected_components(links).collect()}
    classes = {}
    for (n, _), c in zip(rows, brute.components(rows)):
        classes.setdefault(c, set()).add(joined.get(signed[n][1], signed[n][1]))
    assert all(len(c) == 1 for c in classes.values())
    assert len({next(iter(c)) for c in classes.values()}) == len(classes)


def test_tiles_are_dealt_once_per_group_in_reach(spark):
    shuffled = []
    for rows in (2_000, 20_000):
        table = spark.range(rows).select(F.xxhash64("id").alias("fp"))
        dealt = simhash.dealt_tiles(table, 4, tile_rows=64)
        held = dealt.agg(F.sum(F.size("fps")), F.max(F.size("fps"))).first()
        assert held[1] < 150
        shuffled.append(held[0] / rows)
    assert max(shuffled) <= 9 and abs(shuffled[0] - shuffled[1]) < 0.2


def test_a_side_compared_with_itself_meets_each_pair_once():
    chain = np.array([(1 << n) - 1 for n in range(0, 64, 3)] * 2, np.uint64)
    for rows, columns in ((256, 4096), (2, 3)):
        links = simhash.linked(np.unique(chain), None, 4, rows, columns)
        assert len(links) == 21 and all((a ^ b).bit_count() <= 4 for a, b in links)
        assert len(simhash.linked(np.unique(chain)[:9], np.unique(chain)[9:], 4, rows, columns)) == 1


@pytest.mark.parametrize("shard_passages", [64, 1])
def test_substring_dedup(spark, docs, texts, shard_passages):
    random.seed(3)
    few = ["x", "yy", "z"]
    made = [(200 + i, " ".join(random.choice(few[: 1 + i % 3]) for _ in range(n)))
            for i, n in enumerate([19, 20, 21, 45, 90, 33, 60, 20, 41])]
    table = spark.createDataFrame(texts + made, "doc_id long, text string")
    got = substring_dedup.remove_repeated(table, shard_passages=shard_passages)
    rows = sorted(tuple(r) for r in got.select("doc_id", "n_words", "n_removed", "kept_text").collect())
    assert rows == brute.remove_repeated(texts + made)
    con = duckdb.connect()
    con.register("documents", table.toPandas())
    hashed = got.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256)).collect()
    assert sorted(con.execute(ORACLES["op8_substring_dedup"]).fetchall()) == sorted(map(tuple, hashed))


def test_rows_with_one_id_are_at_one_place(spark):
    text = " ".join(f"w{i}" for i in range(25))
    table = spark.createDataFrame([(1, text), (1, text), (None, text)], "doc_id long, text string")
    got = {(r.doc_id, r.n_removed) for r in substring_dedup.remove_repeated(table).collect()}
    assert got == {(1, 25), (None, 0)}


@pytest.mark.parametrize("shard_passages", [64, 1])
def test_repeated_and_missing_ids(spark, shard_passages):
    random.seed(11)
    common = [f"c{i}" for i in range(70)]
    rows = []
    for n in range(60):
        at, size = random.randrange(40), random.randrange(20, 31)
        before = [f"b{n}_{i}" for i in range(random.randrange(4))]
        rows.append((random.choice([None, None, 7, 7, 3, 100 + n]),
                     " ".join(before + common[at : at + size] + [f"e{n}"] + common[:25])))
    table = spark.createDataFrame(rows + rows[:5], "doc_id long, text string").withColumn("_row", F.lit(1))
    got = substring_dedup.remove_repeated(table, shard_passages=shard_passages)
    assert got.columns == ["doc_id", "text", "_row", "n_words", "n_removed", "kept_text"]
    assert sorted((repr(r.doc_id), r.text, r.n_removed, r.kept_text) for r in got.collect()) == sorted(
        (repr(i), t, n, k) for (i, t), (n, k) in brute.remove_repeated_by_place(rows + rows[:5]))


def test_passages_of_other_rows_with_the_id_are_not_gathered(spark, monkeypatch):
    def lengths(window, schema):
        def run(batches):
            for batch in batches:
                sizes = [len(x or []) for x in batch.column("_removed").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("text"), pa.array(sizes, pa.int64()),
                     pa.array(sizes, pa.int64()), pa.array([""] * len(sizes))], schema.fieldNames())

        return run

    monkeypatch.setattr(substring_dedup, "_apply", lengths)
    shared = [f"s{i}" for i in range(30)]
    rows = [(None, " ".join([f"y{n}_{i}" for i in range(n)] + shared)) for n in range(40)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    sizes = [r.n_removed for r in substring_dedup.remove_repeated(table).collect()]
    assert len(sizes) == 40 and 0 < max(sizes) <= 11  # a text has 11 repeated windows


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abc"), min_size=1, max_size=80), st.lists(st.sampled_from("abc"), max_size=80))
def test_bit_parallel_distance(pattern, text):
    assert decontaminate.best_distance(pattern, text) == brute.edit_distance(pattern, text)


@pytest.mark.parametrize("block_items", [100, 2])
def test_items_with_edits_are_found(spark, block_items):
    random.seed(9)
    items = [(n, " ".join(f"q{random.randrange(50)}" for _ in range(size))) for n, size in enumerate([15, 30, 50])]
    def edited(text, edits):
        words = text.split()
        for _ in range(edits):
            at = random.randrange(len(words))
            words[at : at + 1] = random.choice([[], ["new"], [words[at], "more"]])
        return " ".join(words).upper().replace(" ", ", ")
    rows = [(10 * n + e, f"before it {edited(t, e)} after it") for n, t in items for e in range(8)]
    table = spark.createDataFrame(rows + [(99, None), (98, "nothing here")] + rows[:2], "doc_id long, text string")
    bench = spark.createDataFrame(items + items[:1] + [(7, None), (8, ""), (9, "before it")], "item_id long, text string")
    got = {r.doc_id: {m.item_id: m.distance for m in r.matches}
           for r in decontaminate.find_items(table, bench, ["doc_id"], block_items=block_items).collect()}
    for doc, text in rows:
        want = {}
        for n, item in [*items, (9, "before it")]:
            words = decontaminate.normalised(item)
            distance = brute.edit_distance(words, decontaminate.normalised(text))
            if distance <= len(words) // 10:
                want[n] = distance
        assert got[doc] == want
    assert got[98] == got[99] == {} and len(got) == len(rows) + 2
    assert decontaminate.find_items(table, bench, table.columns, block_items=block_items).count() == len(rows) + 4


@pytest.mark.parametrize("block_items", [1, 1_000])
def test_short_items_and_clashing_names(spark, block_items):
    """Items under five words, also without spaces, occur unchanged or not at all."""
    rows = [(1, "The answer is forty two, he said."), (2, "the answer is forty-one"), (3, "今天天气很好,我们去公园"),
            (4, "今天天氣很好"), (5, None), (6, "Yes"), (7, "yesterday"), (8, "... !!")]
    table = spark.createDataFrame(
        [(i, t, "a", "b", i) for i, t in rows],
        "doc_id long, text string, _hit_text string, _hit_items string, matches long")
    bench = spark.createDataFrame(
        [(10, "forty two"), (11, "天气很好"), (12, "yes!"), (13, ""), (14, "?!"), (15, "is forty")],
        "item_id long, text string")
    found = decontaminate.find_items(table, bench, table.columns, block_items=block_items).collect()
    got = {r["doc_id"]: [(m["item_id"], m["distance"]) for m in r["matches"]] for r in found}
    assert got == {1: [(10, 0), (15, 0)], 2: [(15, 0)], 3: [(11, 0)], 4: [], 5: [], 6: [(12, 0)], 7: [], 8: []}
    assert all((r["_hit_text"], r["_hit_items"]) == ("a", "b") for r in found)


def test_blocks_are_bounded_by_characters(spark):
    bench = spark.createDataFrame([(i, f"item number {i} " * 10) for i in range(20)], "item_id long, text string")
    blocks = list(decontaminate._blocks(bench, 1_000, 500, 1))
    assert len(blocks) > 5 and sum(map(len, blocks)) == 20
