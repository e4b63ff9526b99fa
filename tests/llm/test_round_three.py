"""Fill-in-middle, hard negatives and BPE against plain versions, the library and round trips."""

import hashlib
import re

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from aval.llm import bpe, fill_in_middle, hard_negatives
from aval.llm.queries import bpe_query

PATH = public_tokenizers.path("word_bpe_49k.json")
TRICKY = [
    (20, "has <P> inside"), (21, "<|endoftext|>Hi<|startoftext|> it's '' 'RE don’t"), (22, "x" * 5_000),
    (23, "ΑΣ ςσ İI ǅ ﬁ Å é ́a 漢字かな ١٢ ௧   \x1c\x85 𝔘𐍈"), (24, "abcABC123!?*" * 900),
    (24, "the same id"), (None, "no id"), (None, None), (25, "12 345\r\n\t"), (26, "՘꟎Ᲊ new letters"),
    (27, "lowlowerlowest " * 50 + "zqxj" * 400),
]


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


@pytest.fixture(scope="module")
def table(spark, texts):
    rows = [(i, t, "en", i, "y", i) for i, t in [*texts, *TRICKY, *TRICKY[:2]]]
    return spark.createDataFrame(
        rows, "doc_id long, text string, form string, n long, output_sha256 string, row long")


# --- Fill in the middle --------------------------------------------------------------------


def plain_fim(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    h = sha(f"1:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    one, two = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:one], units[one:two], units[two:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("chunk", [1, 7, 4096])
def test_fim_digests_equal_the_plain_version(spark, table, chunk):
    rule = fill_in_middle.FillInMiddle(chunk_units=chunk)
    rows = table.where("length(text) < 6000 OR text IS NULL") if chunk == 1 else table
    got = fill_in_middle.digests(fill_in_middle.fim_pieces(rows, ["doc_id", "text"], rule), rule).collect()
    assert len(got) == rows.count()
    for r in got:
        n, form, prefix, middle, output = plain_fim(r["doc_id"], r["text"])
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"]) == (n, form, prefix, middle)
        assert r["output_sha256"] == sha(output)
        assert r["restored_sha256"] == sha(r["text"] or "")
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_fim_texts_and_the_other_columns(spark, table):
    got = fill_in_middle.output_texts(
        fill_in_middle.fim_pieces(table, table.columns, fill_in_middle.FillInMiddle(chunk_units=50)))
    assert got.columns == ["doc_id", "text", "output_sha256", "row", "n", "form", "prefix_chars",
                           "middle_chars", "output"]
    rows = got.collect()
    assert all(r["output"] == plain_fim(r["doc_id"], r["text"])[4] and r["output_sha256"] == "y" for r in rows)
    assert len(rows) == table.count()


def test_fim_pieces_stay_small_and_empty_tables_give_none(spark, table):
    rule = fill_in_middle.FillInMiddle(chunk_units=10)
    pieces = fill_in_middle.fim_pieces(table.where("doc_id = 8"), ["doc_id"], rule)
    assert pieces.agg(F.max(F.length("piece"))).first()[0] <= 100
    none = fill_in_middle.fim_pieces(table.limit(0), ["doc_id"])
    assert none.count() == 0 and fill_in_middle.digests(none).count() == 0
    assert fill_in_middle.output_texts(none).count() == 0


def test_fim_shuffles_once(spark, table):
    plan = fill_in_middle.digests(
        fill_in_middle.fim_pieces(table, ["doc_id"]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort ") == 2


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.characters(codec="utf-8")))
def test_unit_starts_follow_the_pattern(text):
    assert fill_in_middle.unit_starts(text).tolist() == [
        m.start() for m in re.finditer(r"[A-Za-z]+|[^A-Za-z]", text)]


# --- Hard negatives ------------------------------------------------------------------------


def plain_mine(rows, is_anchor, k=5):
    """Rows (id, label, vector of integers); ids may repeat, so results are listed by row."""
    def key(s, i):
        return -s, rows[i][0] is not None, rows[i][0] or 0, i

    out = []
    for a, (anchor, label, v) in enumerate(rows):
        if not is_anchor(anchor):
            continue
        scores = {i: sum(x * y for x, y in zip(v, w)) for i, (_, _, w) in enumerate(rows)
                  if i != a and len(w) == len(v)}
        near = sorted((key(s, i) for i, s in scores.items() if rows[i][1] == label))[:k]
        for p, *_, i in near:
            ok = sorted(key(s, j) for j, s in scores.items()
                        if rows[j][1] != label and -80 * p <= 100 * s <= -100 * p)[:k]
            out += [(anchor, rows[i][0], rank, rows[j][0], -p, -q) for rank, (q, *_, j) in enumerate(ok, 1)]
    return sorted(out, key=repr)


def mined(spark, rows, **options):
    table = spark.createDataFrame(rows, "vec_id long, label int, v array<double>")
    vectors = hard_negatives.clean_vectors(table, F.col("vec_id"), F.col("label"), F.col("v"))
    got = hard_negatives.mine_hard_negatives(vectors, F.col("vec_id") % 10 == 0, **options)
    return sorted(map(tuple, got.collect()), key=repr)


def random_rows(n, d, labels, seed, scale=0.1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, d)) * scale
    label = rng.integers(0, labels, n)
    return [(i, int(g), (centres[g] * 0.6 + rng.normal(size=d) * scale).tolist())
            for i, g in enumerate(label)]


@pytest.mark.parametrize("shards", [dict(), dict(shard_rows=100), dict(least_rows=10)])
def test_mining_equals_the_plain_version(spark, shards):
    rows = random_rows(900, 6, 4, 7)
    rows += [(5_000 + i, 9, [0.3] * 6) for i in range(300)]  # a hot vector, all ties
    want = plain_mine([(i, g, [int(np.floor(256 * x)) for x in v]) for i, g, v in rows],
                      lambda i: i % 10 == 0)
    assert len(want) > 200
    assert mined(spark, rows, **shards) == want


def test_mining_defines_nulls_repeats_and_lengths(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(10, 1, [1.0, 0.5]), (1, 1, [1.0, 0.25]), (2, 2, [0.9, 0.5]), (2, 2, [0.9, 0.5]), (3, 2, [1.0, 0.3]),
            (20, 1, [1.0, 0.5]), (20, 1, [1.0, 0.5]), (30, 3, [-1.0, 0.0]), (31, 3, [1.0, 0.0]),
            (40, 4, []), (41, 4, []), (42, 5, []), (50, 6, [1.0]), (51, 6, [2.0]), (52, 7, [1.75])]
    left_out = [(60, None, [1.0, 1.0]), (61, 2, None), (62, 2, [1.0, None]), (63, 2, [nan, 1.0]),
                (64, 2, [1.0, inf]), (None, None, None)]
    unnamed = [(None, 2, [0.95, 0.5])]
    whole = [(i, g, [int(np.floor(256 * x)) for x in v]) for i, g, v in rows + unnamed]
    got = mined(spark, rows + left_out + unnamed)
    want = plain_mine(whole, lambda i: i is not None and i % 10 == 0)
    assert got == want and any(r[3] is None for r in got) and any(r[4] == 0 for r in got)
    assert mined(spark, []) == []
    assert mined(spark, [(10, 1, [1.0])]) == []


def test_mining_large_components_is_exact(spark):
    rng = np.random.default_rng(3)
    rows = [(i, i % 3, [float(x) for x in rng.integers(-2_000_000, 2_000_000, 4)]) for i in range(60)]
    want = plain_mine([(i, g, [int(256 * x) for x in v]) for i, g, v in rows], lambda i: i % 10 == 0)
    assert mined(spark, rows) == want


def test_the_queue_prunes():
    rng = np.random.default_rng(1)
    points = rng.integers(-100, 100, (20_000, 3))
    tree = hard_negatives.RTree(
        np.arange(20_000), list(range(20_000)), np.repeat([0, 1], 10_000), points)
    seen = []

    class Counting(np.ndarray):
        def __getitem__(self, item):
            if isinstance(item, slice):
                seen.append(item)
            return super().__getitem__(item)

    tree.floats = tree.floats.view(Counting)
    query = np.array([50, -80, 20])
    (found,) = tree.search(query, -1, 0, False, [(-1e18, 1e18)], 5)
    scores = points[10_000:] @ query
    want = sorted((-int(s), i + 10_000) for i, s in enumerate(scores))[:5]
    assert [(s, i) for s, _, i, _ in found] == want
    assert len(seen) < 10  # of 157 leaves


# --- BPE -----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def pairs():
    with open(PATH, "rb") as file:
        return bpe.BytePairs(file.read())


def test_bpe_equals_the_library(spark, table, library):
    encoded = bpe.encode_texts(table, PATH, [*table.columns])
    rows = bpe.decode_ids(encoded, PATH, encoded.columns).collect()
    assert len(rows) == table.count()
    for r in rows:
        want = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert np.frombuffer(bytes(r["ids"]), "<u4").tolist() == want and r["n_tokens"] == len(want)
        assert r["decoded"] == library.decode(want, skip_special_tokens=False)
        assert r["output_sha256"] == "y"


def test_bpe_query_equals_the_library_on_all_documents(spark, sf_dir, library):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = bpe_query(spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == sha(np.array(ids, "<u4").tobytes())
        assert r["decoded_sha256"] == sha(library.decode(ids, skip_special_tokens=False))


def test_bpe_empty_table_and_missing_ids(spark, table):
    none = bpe.encode_texts(table.limit(0), PATH, ["doc_id"])
    assert none.count() == 0 and bpe.decode_ids(none, PATH, ["doc_id"]).count() == 0
    odd = spark.createDataFrame([(1, None), (2, b""), (3, np.array([0, 70_000], "<u4").tobytes())],
                                "doc_id long, ids binary")
    assert [r["decoded"] for r in bpe.decode_ids(odd, PATH, ["doc_id"]).orderBy("doc_id").collect()] == [
        "", "", "!"]


@settings(max_examples=600, deadline=None)
@given(st.lists(st.one_of(
    st.text(alphabet="abcdehilnorstu' ", max_size=40), st.text(alphabet="an", max_size=30),
    st.text(alphabet=st.characters(codec="utf-8"), max_size=12), st.sampled_from([" ", "<|endoftext|>", "'s", "hahaha"]),
), max_size=8).map("".join))
def test_bpe_equals_the_library_on_any_text(pairs, library, text):
    (ids,) = pairs.encode([text])
    assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_verification_accepts_what_merging_gives_and_nothing_else(pairs):
    """Every pair of neighbours of exact merging is compatible; words that fail are merged exactly."""
    words = ["".join(w) for w in np.random.default_rng(5).choice(list("abcdeinorst"), (3_000, 9))]
    merged = [pairs.merge(w) for w in words]
    assert pairs.encode_words(words) == merged
    proposed = [pairs.propose(w) for w in words]
    right = sum(p == m for p, m in zip(proposed, merged))
    assert 0 < right < len(words)
    for p, m in zip(proposed, merged):
        good = pairs.compatible(np.array(p[:-1], np.int64), np.array(p[1:], np.int64)).all()
        assert good == (p == m)


def test_unsupported_vocabularies_are_refused(pairs):
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as file, pytest.raises(ValueError):
        bpe.BytePairs(file.read())


def test_short_and_long_words_merge_alike(pairs):
    for size in (1, 2, 9, 60):
        for word in np.random.default_rng(size).choice(list("anhelo"), (300, size)):
            tokens = pairs.ids_of("".join(word))
            assert pairs._merge_short(list(tokens)) == pairs._merge_long(list(tokens))


def test_latin_characters_are_cut_as_the_library_cuts_them(pairs):
    assert all(pairs._alike(chr(i)) for i in range(0x300))
