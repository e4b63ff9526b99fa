import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as entry
from aval import config as c
from aval.errors import MissingPathError, ParseError, SourceNotFoundError, UnsupportedFormatError
from aval.operators.cleaning import keep_first
from aval.sources import files
from aval.sources.applicants import flatten_applicants, read_applicants
from aval.sources.order import numbered, with_place, with_sequence


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_csv_is_text_with_nulls(spark, tmp_path):
    path = tmp_path / "perfil.CSV"
    path.write_text('ID_Cliente,Edad,Nota\nA,35,"uno, ""dos"""\nB,N/A,ND\nC,,nan\n')
    df = files.load_source(spark, str(path))
    assert rows(df) == [("A", "35", 'uno, "dos"'), ("B", None, "ND"), ("C", None, None)]


def test_loading_errors_in_order(spark, tmp_path):
    with pytest.raises(MissingPathError):
        files.load_source(spark, "")
    with pytest.raises(SourceNotFoundError):
        files.load_source(spark, str(tmp_path / "nada.txt"))
    (tmp_path / "datos.txt").write_text("x")
    with pytest.raises(UnsupportedFormatError, match="csv, json, jsonl, parquet, xlsx"):
        files.load_source(spark, str(tmp_path / "datos.txt"))


def test_malformed_csv(spark, tmp_path):
    path = tmp_path / "malo.csv"
    path.write_text("a,b\n1,2\n3,4,5\n")
    with pytest.raises(ParseError):
        files.check_readable(files.load_source(spark, str(path)), str(path))
    with pytest.raises(ParseError):  # noticed whichever columns are read
        files.check_readable(files.load_source(spark, str(path)).select("a"), str(path))
    schema = spark.createDataFrame([], "a string, b string").schema
    good, bad = files.read_csv_quarantine(spark, str(path), schema)
    assert rows(good) == [("1", "2")] and rows(bad) == [("3", "4", "3,4,5")]


def test_short_csv_lines_lack_values(spark, tmp_path):
    path = tmp_path / "corto.csv"
    path.write_text('a,b,c\n1,2\n"x, y",,4\n7,8,9\n')
    df = files.load_source(spark, str(path))
    assert rows(df) == sorted([("1", "2", None), ("x, y", None, "4"), ("7", "8", "9")], key=repr)
    assert df.count() == 3 and rows(df.select("b")) == sorted([("2",), (None,), ("8",)], key=repr)


def test_json_list_and_lines(spark, tmp_path):
    (tmp_path / "h.json").write_text('[{"ID_Cliente": "A", "x": 1.5}, {"ID_Cliente": "B", "x": null}]')
    assert rows(files.load_source(spark, str(tmp_path / "h.json"))) == [("A", 1.5), ("B", None)]
    (tmp_path / "l.json").write_text('{"ID_Cliente": "A", "x": 2}\n{"ID_Cliente": "B"}\n')
    assert rows(files.load_source(spark, str(tmp_path / "l.json"), lines=True)) == [("A", 2), ("B", None)]
    (tmp_path / "malo.json").write_text('[{"ID_Cliente": ')
    with pytest.raises(ParseError):
        files.check_readable(files.load_source(spark, str(tmp_path / "malo.json")), "malo.json")


MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'


def workbook(path, sheet, shared=""):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {MAIN} xmlns:r="http://schemas.openxmlformats.org/'
                   'officeDocument/2006/relationships"><sheets><sheet name="b" sheetId="2" r:id="rId7"/>'
                   '<sheet name="a" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/'
                   'package/2006/relationships"><Relationship Id="rId1" Target="worksheets/otra.xml"/>'
                   '<Relationship Id="rId7" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {MAIN}><sheetData>{sheet}</sheetData></worksheet>")
        if shared:
            z.writestr("xl/sharedStrings.xml", f"<sst {MAIN}>{shared}</sst>")


def test_every_row_of_a_sheet_is_read(spark, tmp_path):
    from aval.sources import workbook as wb

    rows = "".join(f'<row><c t="inlineStr"><is><t>c{i}</t></is></c><c><v>{i}</v></c></row>' for i in range(25))
    workbook(tmp_path / "1.xlsx", '<row><c t="inlineStr"><is><t>a</t></is></c>'
             '<c t="inlineStr"><is><t>b</t></is></c></row>' + rows)
    content = (tmp_path / "1.xlsx").read_bytes()
    assert [r[0] for r in wb.sheet_rows(content)] == ["a"] + [f"c{i}" for i in range(25)]
    got = files.load_source(spark, str(tmp_path / "1.xlsx")).collect()
    assert sorted((r.a, r.b) for r in got) == sorted((f"c{i}", str(i)) for i in range(25))


def test_folder_of_workbooks(spark, tmp_path):
    folder = tmp_path / "buro"
    folder.mkdir()
    workbook(folder / "1.xlsx",
             '<row><c r="A1" t="s"><v>0</v></c><c r="B1" t="inlineStr"><is><t>Score_Buro</t></is></c></row>'
             '<row><c r="A2" t="s"><v>1</v></c><c r="B2"><v>720.5</v></c></row>'
             '<row><c r="B3" t="b"><v>1</v></c></row>',
             "<si><t>ID_Cliente</t></si><si><r><t>CLIENTE_</t></r><r><t>1</t></r></si>")
    workbook(folder / "2.xlsx",
             '<row><c t="inlineStr"><is><t>ID_Cliente</t></is></c></row>'
             '<row><c t="inlineStr"><is><t>N/A</t></is></c></row>')
    df = files.load_source(spark, str(folder), fmt="xlsx")
    assert df.columns == ["ID_Cliente", "Score_Buro"]
    assert rows(df) == sorted([("CLIENTE_1", "720.5"), (None, "true"), (None, None)], key=repr)
    one = files.load_source(spark, str(folder / "1.xlsx"), schema=files.source_schema(c.BUREAU_SOURCE))
    assert one.columns == list(c.BUREAU_COLUMNS) and one.count() == 2
    (tmp_path / "malo.xlsx").write_text("no es un libro")
    with pytest.raises(ParseError):
        files.load_source(spark, str(tmp_path / "malo.xlsx"))


def test_broken_workbooks_are_put_aside(spark, tmp_path):
    folder = tmp_path / "libros"
    folder.mkdir()
    head = '<row><c t="inlineStr"><is><t>a</t></is></c><c t="inlineStr"><is><t>b</t></is></c></row>'
    for i in range(4):
        workbook(folder / f"{i}.xlsx", head + f'<row><c><v>{i}</v></c><c t="inlineStr"><is><t>NA</t></is></c></row>')
    # Broken behind three good rows: wrong index of a shared text.
    workbook(folder / "4.xlsx", head + "<row><c><v>8</v></c></row><row><c><v>9</v></c></row>"
             '<row><c t="s"><v>7</v></c></row>')
    good, bad = files.read_workbooks_quarantine(spark, str(folder))
    assert good.columns == ["a", "b"] and rows(good) == [(str(i), None) for i in range(4)]
    found = bad.collect()
    assert bad.columns == ["ruta", "fila", "motivo"] and len(found) == 1
    assert found[0].ruta.endswith("/4.xlsx") and found[0].fila == 3 and found[0].motivo.startswith("IndexError")
    (folder / "5.xlsx").write_text("no es un libro")
    good, bad = files.read_workbooks_quarantine(spark, str(folder), good.schema)
    assert good.count() == 4
    assert sorted((r.ruta[-6:], r.fila) for r in bad.collect()) == [("4.xlsx", 3), ("5.xlsx", 0)]
    with pytest.raises(ParseError):
        files.check_readable(files.load_source(spark, str(folder), fmt="xlsx", schema=good.schema), str(folder))


def test_partitions_are_written_in_files_of_similar_size(spark, tmp_path):
    # A heavy part of the rows, nine light ones, dealt over many tasks.
    df = spark.range(400_000).selectExpr(
        "id", "md5(cast(id as string)) as text", "if(id % 50 < 41, 0, id % 50 - 40) as part").repartition(24)
    size, partitions = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.shuffle.partitions"
    before = spark.conf.get(partitions)
    spark.conf.set(size, "4m")
    spark.conf.set(partitions, "200")
    try:
        files.write_table(df, str(tmp_path / "t"), partition_by=("part",))
    finally:
        spark.conf.unset(size)
        spark.conf.set(partitions, before)
    counts = {p.name: len(list(p.glob("*.parquet"))) for p in (tmp_path / "t").glob("part=*")}
    assert len(counts) == 10
    heavy = counts.pop("part=0")
    assert 2 <= heavy < 24 and set(counts.values()) == {1}
    assert spark.read.parquet(str(tmp_path / "t")).agg({"id": "sum"}).first()[0] == 400_000 * 399_999 // 2
    files.write_table(df.limit(10), str(tmp_path / "c"), "csv", ("part",))
    assert spark.read.csv(str(tmp_path / "c"), header=True).count() == 10


def test_applicant_documents(spark, tmp_path):
    path = tmp_path / "nuevos.json"
    path.write_text('[{"perfil": {"Edad": 30, "extra": 1}}, {"ID_Cliente": "X", "historial": '
                    '[{"Monto_Transaccion": 5, "Moneda": "USD"}, {"Frecuencia_Deposito": 2}]}, {"buro": null}]')
    docs = read_applicants(spark, str(path))
    profile, history, bureau = flatten_applicants(docs)
    assert [r[c.ID] for r in profile.orderBy("_seq").collect()] == ["NUEVO-001", "X", "NUEVO-003"]
    assert rows(history) == sorted([("X", "5", "USD", None, None), ("X", None, None, None, "2")], key=repr)
    assert bureau.count() == 3 and bureau.filter("Score_Buro is not null").count() == 0
    single = tmp_path / "uno.json"
    single.write_text('{"perfil": {"Edad": 30}}')
    assert read_applicants(spark, str(single)).first()[c.ID] == "NUEVO-001"


def test_positions_are_consecutive_over_partitions(spark, tmp_path):
    spark.range(100).repartition(7).write.parquet(str(tmp_path / "p"))
    scan = spark.read.parquet(str(tmp_path / "p")).repartition(1).union(spark.range(50).coalesce(3).toDF("id"))
    found = [r["n"] for r in numbered(scan, "n").select("n").collect()]
    assert sorted(found) == list(range(1, 151))


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", None)], "k string, v int")
    files.write_table(df, str(tmp_path / "csv"), "csv")
    assert rows(files.load_source(spark, str(tmp_path / "csv"), fmt="csv")) == [("a", "1"), ("b", None)]
    files.write_table(df, str(tmp_path / "pq"), partition_by=("k",))
    assert spark.read.parquet(str(tmp_path / "pq")).filter("k = 'a'").first()["v"] == 1
    with pytest.raises(UnsupportedFormatError):
        files.write_table(df, str(tmp_path / "x"), "xml")


def test_json_lines_are_recognised(spark, tmp_path):
    lines = "\n".join('{"a": %d}' % i for i in range(5))
    for name in ("x.json", "x.jsonl", "folder/part-0.json"):
        (tmp_path / "folder").mkdir(exist_ok=True)
        (tmp_path / name).write_text(lines)
        path = str(tmp_path / name) if name[0] == "x" else str(tmp_path / "folder")
        assert files.load_source(spark, path, fmt=None if name[0] == "x" else "json").count() == 5
    (tmp_path / "list.json").write_text('[\n{"a": 1},\n{"a": 2}\n]')
    assert files.load_source(spark, str(tmp_path / "list.json")).count() == 2
    (tmp_path / "many.json").write_text('{\n"a": 1}\n{\n"a": 2}')
    with pytest.raises(ParseError, match="more than one value"):
        files.load_source(spark, str(tmp_path / "many.json"))


def test_broken_documents_are_quarantined_in_batch_and_stream(spark, tmp_path):
    from aval.sources.applicants import read_applicants, read_applicants_quarantine
    from aval.streaming.applicants import read_rejected, read_stream

    source = tmp_path / "in"
    source.mkdir()
    (source / "a.json").write_text('{"ID_Cliente": "A"}\n{"ID_Cliente": \n{"perfil": {"Edad": "40"}}\n')
    good, bad = read_applicants_quarantine(spark, str(source))
    assert good.count() == 2 and [r["linea"] for r in bad.collect()] == ['{"ID_Cliente": ']
    with pytest.raises(Exception):
        read_applicants(spark, str(source)).collect()
    counts = {}
    for name, read in (("good", read_stream), ("rejected", read_rejected)):
        query = read(spark, str(source)).writeStream.format("memory").queryName(name).trigger(
            availableNow=True).start()
        query.awaitTermination(60)
        counts[name] = spark.table(name).count()
    assert counts == {"good": 1, "rejected": 2}


# --- Files read by splits ------------------------------------------------------------------


def in_splits(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)


@pytest.fixture
def splits(spark):
    before = {k: spark.conf.get(k) for k in (
        "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield lambda size: in_splits(spark, size)
    for k, v in before.items():
        spark.conf.set(k, v)


NOTES = ['plain', 'quote " and }', '} {[ ]', 'back\\slash\\', '\\"', '\\\\"}', 'é漢 ', '', 'line\nbreak\n', '"', ',']


@pytest.mark.parametrize("size, indent", [(900, None), (1 << 27, 2)])
def test_json_lists_are_read_by_splits(spark, tmp_path, splits, size, indent):
    records = [{"id": i, "note": NOTES[i % len(NOTES)], "in": {"x": [i, {"y": "}"}], "z": {}}} for i in range(60)]
    (tmp_path / "a.json").write_text(json.dumps(records[:45], indent=indent, ensure_ascii=False))
    (tmp_path / "b.json").write_text("﻿ \n" + json.dumps(records[45:59], indent=indent) + "\n\n")
    (tmp_path / "c.json").write_text(json.dumps(records[59], indent=indent))
    (tmp_path / "d.json").write_text(" [ ] ")
    splits(size)
    schema = "id long, note string, in struct<x: array<string>, z: struct<q: string>>"
    rows = numbered(files.read_json(
        spark, str(tmp_path), T.StructType.fromDDL(schema), lines=False, place=True), "n").orderBy("n").collect()
    assert [(r["n"], r["id"], r["note"]) for r in rows] == [
        (i + 1, i, records[i]["note"]) for i in range(60)]
    assert all(r["in"]["x"][1] == '{"y":"}"}' for r in rows)
    inferred = files.read_json(spark, str(tmp_path), lines=False)
    assert inferred.columns == ["id", "in", "note"] and inferred.count() == 60


@pytest.mark.parametrize("text", [
    '[{"a": 1}', '{"a": 1', '[{"a": 1}] x', '[{"a": 1} {"a": 2}]', '[1, {"a": 2}]', '{"a": 1} {"a": 2}',
    '[{"a": "x}]', '[{"a": 1},]'])
def test_broken_json_is_an_error(spark, tmp_path, text):
    (tmp_path / "x.json").write_text(text)
    with pytest.raises(ParseError):
        files.check_readable(files.load_source(spark, str(tmp_path / "x.json"), lines=False,
                                               schema=T.StructType.fromDDL("a long")), "x")


def test_json_elements_are_put_aside(spark, tmp_path, splits):
    (tmp_path / "x.json").write_text('[{"a": 1}, 5, {"a": 2}, {"a": {}}, {"a": 3}] rest')
    splits(30)
    good, bad = files.read_json_quarantine(
        spark, str(tmp_path), T.StructType.fromDDL("a long"), lines=False)
    assert rows(good) == [(1,), (3,)]
    assert sorted(r["linea"] for r in bad.collect()) == [', 5, {"a": 2}', '] rest', '{"a": {}}']


@pytest.mark.parametrize("size, end", [(150, "\n"), (1 << 27, "\r\n")])
def test_quoted_line_breaks_are_read_by_splits(spark, tmp_path, splits, size, end):
    notes = [n.replace(" ", "") for n in NOTES]
    quoted = [(i, notes[i % len(notes)]) for i in range(50)]
    for name, part in (("a", quoted[:40]), ("b", quoted[40:])):
        lines = ["id,note", *(f'{i},"' + n.replace('"', '""') + '"' for i, n in part)]
        (tmp_path / f"{name}.csv").write_bytes((end.join(lines) + (end if name == "a" else "")).encode())
    splits(size)
    got = numbered(files.load_source(spark, str(tmp_path), fmt="csv", multiline=True, place=True), "n")
    assert [tuple(r) for r in got.select("n", "id", "note").orderBy("n").collect()] == [
        (i + 1, str(i), n or None) for i, n in quoted]


def test_an_open_quote_and_a_long_row_are_errors(spark, tmp_path):
    for name, text in (("open", 'a,b\n1,"x\n2,y\n'), ("long", 'a,b\n1,2\n3,"4\n",5\n')):
        (tmp_path / f"{name}.csv").write_text(text)
        with pytest.raises(ParseError):
            files.check_readable(files.load_source(
                spark, str(tmp_path / f"{name}.csv"), multiline=True), name)


def test_first_rows_and_numbers_do_not_follow_the_splits(spark, tmp_path, splits):
    """Spark reads the larger file first; the order of the files stays that of their names."""
    def lines(first, n):
        return "id,age\n" + "".join(f"C{i % 5},{first + i}\n" for i in range(n))

    (tmp_path / "a.csv").write_text(lines(20, 8))
    (tmp_path / "b.csv").write_text(lines(40, 400))
    docs = tmp_path / "docs"
    docs.mkdir()
    (docs / "a.jsonl").write_text('{"perfil": {"Edad": 1}}\n{"perfil": {"Edad": 2}}\n')
    (docs / "b.jsonl").write_text("".join(f'{{"perfil": {{"Edad": {i}}}}}\n' for i in range(3, 90)))
    for size in (300, 1_500, 1 << 27):
        splits(size)
        read = files.load_source(spark, str(tmp_path / "*.csv"), fmt="csv", sequence=True)
        assert rows(keep_first(read, ["id"]).select("id", "age")) == [(f"C{i}", str(20 + i)) for i in range(5)]
        plain = with_sequence(files.load_source(spark, str(tmp_path / "*.csv"), fmt="csv"))
        assert rows(keep_first(plain, ["id"]).select("id", "age")) == [(f"C{i}", str(20 + i)) for i in range(5)]
        got = read_applicants(spark, str(docs), lines=True).orderBy("_seq").collect()
        assert [r[c.ID] for r in got] == [f"NUEVO-{i:03d}" for i in range(1, 90)]
        assert [r["perfil"]["Edad"] for r in got] == [str(i) for i in range(1, 90)]


def test_numbering_many_splits_and_filtered_rows(spark, tmp_path, splits):
    (tmp_path / "a.csv").write_text("x\n" + "".join(f"{i}\n" for i in range(2_000)))
    splits(200)  # about fifty
    got = numbered(with_place(files.load_source(spark, str(tmp_path), fmt="csv")), "n")
    assert [r["x"] for r in got.orderBy("n").collect()] == [str(i) for i in range(2_000)]
    filtered = numbered(with_place(files.load_source(spark, str(tmp_path), fmt="csv")).where("x % 3 = 0"), "n")
    assert [r["n"] for r in filtered.orderBy("n").collect()] == list(range(1, 668))


def test_lists_are_written_in_more_files_as_rows_grow(spark):
    rows = spark.range(1_000).select(F.col("id").alias("k"), F.concat(F.lit("a}, {\"["), F.col("id")).alias("t"))
    path = entry._write_lists(spark, rows, 2, "k", file_rows=100)
    assert len([n for n in os.listdir(path) if n.startswith("part-")]) == 10
    read = numbered(files.load_source(spark, path, schema=rows.schema, place=True), "n").collect()
    assert sorted((r.n, r.k, r.t) for r in read) == [(i + 1, i, f'a}}, {{"[{i}') for i in range(1_000)]
