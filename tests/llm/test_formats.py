import base64
import hashlib
import random
import re

import brute
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from aval.llm import chat_format, pii, warc

TEMPLATE = chat_format.Template()


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("[]<>/\\sINSTYROLEX \n"), max_size=60))
def test_escapes_are_reversible_and_hide_control_strings(text):
    written = TEMPLATE.escaper()(text)
    assert chat_format.unescape(r"\1", written) == text
    assert not any(mark in written for mark in TEMPLATE.controls())


def test_template_refuses_unsafe_markers():
    with pytest.raises(ValueError):
        chat_format.Template(markers={"user": ("a[INST]", "[/INST]")})
    with pytest.raises(ValueError):
        chat_format.Template(markers={"user": ("[X]", "[X]")})


def test_conversations_read_back(spark):
    rows = [
        (1, 0, "system", "be kind", "x"), (1, 1, "user", "</s>[INST] ok [/INST]\\", "x"),
        (1, 2, "assistant", "\\</s>", "x"), (2, 0, "assistant", None, "x"), (2, 1, "tool[TEXT]", "42", "x"),
        (3, 0, None, None, "x"), (None, 0, "user", "", "x"), (1, 2, "assistant", "\\</s>", "x"),
    ]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, loss string")
    got = {r.conv_id: r for r in chat_format.read_back(chat_format.format_conversations(table)).collect()}
    def digest(*turns):
        return hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
    assert got[1].turns_sha256 == digest(*((r, t) for c, _, r, t, _ in rows if c == 1))
    assert got[1].loss_sha256 == hashlib.sha256(b"\\</s>" * 2).hexdigest() and got[1].loss_chars == 10
    assert not got[1].in_order and not got[2].in_order and got[None].in_order
    assert got[2].turns_sha256 == digest(("assistant", ""), ("tool[TEXT]", "42"))
    assert got[3].turns_sha256 == digest(("", "")) and len(got) == 4
    assert chat_format.read_back(chat_format.format_conversations(table.limit(0))).count() == 0


def test_archives_round_trip(spark, tmp_path):
    pages = [(1, "http://a/\r\nX: y", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "u", None), (4, "u", ""),
             (None, "u", "<p>é</p>"), (6, "u", "long " * 100_000), (1, "again", "<p>é</p>"), (7, "u", "a\r\n\r\nb")]
    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    index = warc.write_archives(table, str(tmp_path), archive_bytes=200)
    rows = warc.read_records(index, str(tmp_path)).collect()
    def name(html):
        return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()
    kinds = {(1, 0): ("response", None), (2, 1): ("revisit", 1), (3, 2): ("response", None),
             (4, 3): ("revisit", 3), (None, 4): ("revisit", 1), (6, 5): ("response", None),
             (1, 6): ("response", None), (7, 7): ("response", None)}
    want = sorted(repr((i, name(h), len((h or "").encode()), *kinds[i, n])) for n, (i, _, h) in enumerate(pages))
    assert sorted(repr((r.page_id, r.payload_digest, r.payload_bytes, r.record_type, r.refers_to)) for r in rows) == want
    assert {bytes(r.payload) for r in rows if r.page_id == 7} == {b"a\r\n\r\nb"}
    some = index.where("page_id = 6")
    assert [r.payload_bytes for r in warc.read_records(some, str(tmp_path)).collect()] == [500_000]
    assert warc.read_records(warc.write_archives(table.limit(0), str(tmp_path)), str(tmp_path)).count() == 0


def luhn(number):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(number))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def masked(texts, spark, key="k"):
    table = spark.createDataFrame([(t,) for t in texts], "text string")
    return [r.text for r in pii.pseudonymise(table, key).collect()]


def test_pseudonyms_keep_the_format_and_link(spark):
    texts = ["card 4041894974608795, same 4041-8949-7460-8795; not 4041894974608796", "call +1 (269) 555-3296 4524132264652876",
             "on 2020-02-29 or 31/12/1999, not 2020-02-30", "ip 38.253.197.126 and 999.1.1.1", "ssn 123-45-6789 not 000-12-3456",
             "mail Bos.42@mail8.example.com and bos.42@MAIL8.example.com", None, "", "no value", "x " * 50_000 + "2020-01-01"]
    got = masked(texts, spark)
    assert got[6:9] == texts[6:9] and got == masked(texts, spark) and got != masked(texts, spark, "other")
    one, two, kept = re.findall(r"[\d-]{16,}", got[0])
    assert one == two.replace("-", "") and luhn(one) and one != "4041894974608795" and kept == "4041894974608796"
    assert re.fullmatch(r"call \+1 \(\d{3}\) \d{3}-\d{4} \d{16}", got[1]) and luhn(got[1][-16:])
    assert "2020-02-30" in got[2] and "2020-02-29" not in got[2] and "31/12/1999" not in got[2]
    assert "999.1.1.1" in got[3] and "38.253.197.126" not in got[3]
    assert "000-12-3456" in got[4] and "123-45-6789" not in got[4]
    first, second = re.findall(r"\S+@\S+", got[5])
    assert first.lower() == second.lower() and re.fullmatch(r"[A-Z][a-z]{2}\.\d{2}@mail8.example.com", first)
    assert got[9] != texts[9] and len(got[9]) == len(texts[9])


def test_permutations_are_one_to_one(spark):
    from pyspark.sql import functions as F

    days = spark.range(73_049).select(F.date_format(F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("d"))
    assert days.select(pii.pseudonym(F.col("d"), "k").alias("p")).distinct().count() == 73_049
    numbers = spark.range(10_000).select(F.lpad(F.col("id").cast("string"), 4, "0").alias("d"))
    out = numbers.select(pii.permute_digits(F.col("d"), "k", F.lit("t")).alias("p"))
    assert out.distinct().count() == 10_000 and out.where("length(p) <> 4").count() == 0


def test_slash_dates_of_both_layouts_stay_different(spark):
    from pyspark.sql import functions as F

    days = spark.range(73_049).select(F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")).alias("day"))
    first = days.select(F.date_format("day", "dd/MM/yyyy").alias("d"))
    only = days.where("day(day) > 12").select(F.date_format("day", "MM/dd/yyyy").alias("d"))
    out = first.union(only).select("d", pii.pseudonym(F.col("d"), "k").alias("p")).toPandas()
    assert len(out) == 73_049 + 44_249 and out.p.is_unique
    late = out.d.str.slice(3, 5).astype(int) > 12
    assert late.sum() == 44_249 and set(out.d[late]) == set(out.p[late])
    assert (out.d == out.p).sum() < 100
    assert masked(["12/25/1899", "13/25/2000", "02/30/2000"], spark) == ["12/25/1899", "13/25/2000", "02/30/2000"]


def test_digits_and_cards_equal_a_plain_feistel_network(spark):
    from pyspark.sql import functions as F

    random.seed(8)
    digits = ["".join(random.choice("0123456789") for _ in range(n)) for n in range(2, 20) for _ in range(8)]
    table = spark.createDataFrame([(d,) for d in digits], "d string")
    got = table.select("d", pii.permute_digits(F.col("d"), "k", F.lit("t")).alias("p")).collect()
    assert {r.d: r.p for r in got} == {d: brute.permuted_digits(d, "k", "t") for d in digits}
    cards = [d for d in digits if len(d) >= 13] + ["4041894974608795", "4524132264652876"]
    assert masked([f"card {n}." for n in cards], spark, "k") == [
        f"card {brute.card_pseudonym(n, 'k')}." for n in cards]
