import io
import zipfile

import pytest
from pyspark.sql import functions as F

from tabularium.operators.extract import WORDS_DDL, pages_of
from tabularium.sinks import tables as sink
from tabularium.sources import files, html
from tabularium.sources.tables import catalogued
from tabularium.streaming import state


def packed(members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in members.items():
            z.writestr(name, text)
    return out.getvalue()


def workbook():
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    return packed(
        {
            "xl/workbook.xml": f'<workbook {ns} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="S" sheetId="1" r:id="rId1"/></sheets></workbook>',
            "xl/_rels/workbook.xml.rels": '<Relationships xmlns="x"><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>',
            "xl/sharedStrings.xml": f"<sst {ns}><si><t>name</t></si><si><t>code</t></si><si><r><t>Ro</t></r><r><t>ma</t></r></si></sst>",
            "xl/worksheets/sheet1.xml": f'<worksheet {ns}><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c></row><row r="2"><c r="A2" t="s"><v>2</v></c><c r="B2"><v>7</v></c></row></sheetData></worksheet>',
        }
    )


def document():
    w = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    cell = lambda t: f"<w:tc><w:p><w:r><w:t>{t}</w:t></w:r></w:p></w:tc>"
    return packed({"word/document.xml": f'<w:document xmlns:w="{w}"><w:body><w:tbl><w:tr>{cell("name")}{cell("code")}</w:tr><w:tr>{cell("Roma")}{cell("7")}</w:tr></w:tbl></w:body></w:document>'})


PAGE = '<html><a href="/a.pdf#x"> An <b>edition</b></a><a href="next">next</a><a href="https://other.example/z">out</a><a href="mailto:x">m</a><table><tr><th>name</th><th>code</th></tr><tr><td>Ro\nma</td><td>7</td></tr></table></html>'


def test_parsers_give_records_or_an_error(spark):
    given = spark.createDataFrame([("a.xlsx", bytearray(workbook()), "workbook"), ("b.docx", bytearray(document()), "document_tables"), ("c.html", bytearray(PAGE.replace("\n", "").encode()), "html_tables"), ("d.xlsx", bytearray(b"no"), "workbook"), ("e", bytearray(b""), "unknown")], "path string, content binary, which string")
    got = files.parsed_files(given, "which").collect()
    assert all(r["record"] == {"name": "Roma", "code": "7"} for r in got if r["path"] in ("a.xlsx", "b.docx", "c.html"))
    assert {r["path"] for r in got if r["error"]} == {"d.xlsx", "e"}
    with pytest.raises(ValueError):
        files.parser("workbook")(lambda *a: iter(()))
    assert files.archive_members(packed({"x.csv": "1", "y.txt": ""}), ".csv") == ("x.csv", b"1")
    with pytest.raises(ValueError):
        files.archive_members(packed({}), ".csv")


def test_links_tables_and_frontier(spark):
    assert html.links(PAGE, "https://h.example/p", frozenset({"h.example"})) == [("https://h.example/a.pdf", "An edition", "document"), ("https://h.example/next", "next", "page"), ("https://other.example/z", "out", "external")]
    pages = spark.createDataFrame([("https://h.example/p", PAGE), ("https://h.example/next", '<a href="/deep">d</a>'), ("https://h.example/deep", '<a href="/deeper">d</a>')], "url string, html string")
    seeds = spark.createDataFrame([("https://h.example/p",)], "address string")
    found = {r["address"].rsplit("/", 1)[1]: r["depth"] for r in html.frontier(pages, seeds, frozenset({"h.example"}), 2).collect()}
    assert found == {"p": 0, "a.pdf": 1, "next": 1, "deep": 2}


INDEX = """<table><tr><th>Provincia<th>Titolo<th>Link</tr>
<tr><td>Alba <b>Longa</b></td><td>The White  List</td><td>see <a href="/alba">here</a> or <a href="/b">there</a></td></tr>
<tr><td>Nested</td><td>white list<table><tr><td>in <a href='x.pdf'>x</a></table></td><td><a href="http://o.example/">out</a></td></tr>
<tr><td>None</td><td>White list</td><td>no link</td></tr><tr><td></td><td>white list</td><td><a href="/e">e</a></td></tr></table>"""


def test_cells_keep_their_links(spark):
    inner, outer = html.cells(INDEX)
    assert inner == [[html.Cell("in x", (html.Link("x.pdf", "x"),))]]
    assert outer[1] == [html.Cell("Alba Longa", ()), html.Cell("The White List", ()), html.Cell("see here or there", (html.Link("/alba", "here"), html.Link("/b", "there")))]
    assert [r[0].text for r in outer] == ["Provincia", "Alba Longa", "Nested", "None", ""] and outer[2][1].text == "white list"
    rows = html.index_rows(spark.createDataFrame([("https://h.example/i", INDEX), ("https://h.example/n", None)], "url string, html string"), "url", "html")
    got = {tuple(r) for r in html.index_entries(rows, 0, 1, 2, "white list", "provincia").collect()}
    assert got == {("https://h.example/i", "Alba Longa", "The White List", "https://h.example/alba"), ("https://h.example/i", "Nested", "white list", "http://o.example/")}
    assert html.cells("") == html.cells("<td>x</td>") == [] and html.tables("<table><td>a<tr><td>b") == [[["a"], ["b"]]]


def test_link_filters():
    page = '<a href="/p/a/lista.pdf">List</a><a href="/p/a/contatti">Contacts</a><a href="/p/b/list">List of b</a><a href="/p/a/list2#x">list<a href="mailto:x">list</a>'
    found = html.links(page, "https://h.example/p/a/", frozenset({"h.example"}), wanted="list", unwanted="contact", scope="/p/[^/]+/")
    assert found == [("https://h.example/p/a/lista.pdf", "List", "document"), ("https://h.example/p/a/list2", "list", "page")]


def test_delimited_lines_objects_and_geocodes(spark, tmp_path):
    (tmp_path / "t.csv").write_text("﻿A;B;C\n1;x;\n2;y;z\n", encoding="utf-8")
    assert [tuple(r) for r in files.delimited(spark, str(tmp_path / "t.csv"), ["B", "A"]).collect()] == [("x", "1"), ("y", "2")]
    with pytest.raises(ValueError, match="D"):
        files.delimited(spark, str(tmp_path / "t.csv"), ["D"])
    (tmp_path / "t.jsonl").write_text('{"a":1}\n{broken\n')
    assert sorted(r["a"] or 0 for r in files.json_lines(spark, str(tmp_path / "t.jsonl"), "a int").cache().collect()) == [0, 1]
    found = files.objects(spark, str(tmp_path / "t.csv"))
    manifest = sink.manifest(found).select("sha256", "byte_size")
    assert files.verified(found, manifest).first()["state"] == "verified"
    assert files.verified(found, manifest.withColumn("byte_size", F.lit(1))).first()["state"] == "damaged"
    assert files.verified(found, manifest.withColumn("sha256", F.lit("x"))).first()["state"] == "missing"
    payload = '{"features":[{"geometry":{"coordinates":[9.1,45.4]},"properties":{"geocoding":{"label":" ","name":"N","town":"T","country_code":"it"}}}]}'
    got = files.geocode_candidates(spark.createDataFrame([(1, payload), (2, "{"), (3, None)], "id int, p string"), "p").collect()
    assert [tuple(r) for r in got] == [(1, 1, "N", 45.4, 9.1, None, "T", "IT")]
    members = spark.createDataFrame([("b", "2", "y"), ("b", "1", "x")], "b string, l string, h string")
    assert files.bundle_digest(members, ["b"], "l", "h").first()["digest"] == spark.range(1).select(F.concat(F.lit("bundle:"), F.sha2(F.lit("xy"), 256))).first()[0]


def test_words_of_layout_pages(spark):
    xml = '<doc><page width="1"><word xMin="1" yMin="2" xMax="3" yMax="4">A &amp; B</word></page><page><word xMin="5" yMin="6" xMax="7" yMax="8">C</word></page></doc>'
    got = spark.createDataFrame([("d", xml)], "doc string, content string").mapInPandas(pages_of, WORDS_DDL).collect()
    assert [tuple(r) for r in got] == [("d", 1, 1.0, 2.0, 3.0, 4.0, "A & B"), ("d", 2, 5.0, 6.0, 7.0, 8.0, "C")]


def test_csv_guard_and_appends(spark, tmp_path):
    rows = spark.createDataFrame([("=1+1", ["a", " ", "b"], 1), ('q"x', [], 2), (None, None, 3)], "t string, l array<string>, n int")
    sink.write_csv(rows, str(tmp_path / "csv"), ["n"])
    back = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "csv")).orderBy("n").collect()
    assert [(r["t"], r["l"]) for r in back] == [("'=1+1", "a · b"), ('q"x', None), (None, None)]
    table = str(tmp_path / "table")
    data = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert (sink.append_once(data, table, ["k"]), sink.append_once(data, table, ["k"])) == (2, 0)
    with pytest.raises(ValueError, match="other content"):
        sink.append_once(spark.createDataFrame([(1, "c")], "k int, v string"), table, ["k"])
    assert sink.payload(data, "k").first()["payload"] == '{"k":1,"v":"a"}'


def test_streams(spark, tmp_path):
    source = tmp_path / "in"
    checks = spark.createDataFrame([("u", "2020-01-01 00:00:00", "h"), ("u", "2020-01-01 01:00:00", None), ("u", "2020-01-01 02:00:00", "g"), ("w", "2020-01-02 00:00:00", "h")], "key string, at string, digest string").withColumn("at", F.to_timestamp("at"))
    checks.write.parquet(str(source))
    stream = lambda: spark.readStream.schema(checks.schema).parquet(str(source))
    q = state.resource_state(stream()).writeStream.format("memory").queryName("resources").outputMode("update").option("checkpointLocation", str(tmp_path / "c1")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert {(r["key"], r["checks"], r["changes"], r["digest"]) for r in spark.table("resources").collect()} == {("u", 3, 2, "g"), ("w", 1, 1, "h")}
    state.append_batches(stream(), str(tmp_path / "out"), ["key", "at"], str(tmp_path / "c2")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4
    q = state.windowed_counts(stream(), "at", ["key"], "1 hour", "1 day").writeStream.format("memory").queryName("windows").outputMode("complete").option("checkpointLocation", str(tmp_path / "c3")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("windows").count() == 4
    for _ in range(2):
        state.recounted_batches(stream(), str(tmp_path / "counts"), "at", ["key"], "1 hour", str(tmp_path / "c4")).awaitTermination()
    counted = state.recounted(spark, str(tmp_path / "counts"), ["key"])
    assert counted.count() == 4 and counted.agg(F.sum("n")).first()[0] == spark.table("windows").agg(F.sum("n")).first()[0]


def test_bundles_of_members_and_catalog(spark):
    found = spark.createDataFrame([("h1", bytearray(b"1")), ("h2", bytearray(b"2")), ("h1", bytearray(b"1"))], "sha256 string, content binary")
    pinned = spark.createDataFrame([("a", "x", "h1"), ("a", "y", "h2"), ("b", "x", "h1"), ("b", "y", "h9")], "bundle string, label string, sha256 string")
    whole, lacking = files.bundle_members(found, pinned, ["bundle"])
    assert {(r["bundle"], r["label"], bytes(r["content"])) for r in whole.collect()} == {("a", "x", b"1"), ("a", "y", b"2")} and [tuple(r) for r in lacking.collect()] == [("b", "y", "h9")]
    spark.range(5).createOrReplaceTempView("five")
    rows, columns = catalogued(spark, "five", ["id"], 2)
    assert [r["id"] for r in rows.collect()] == [0, 1] and [tuple(r) for r in columns.collect()] == [(0, "id", "bigint", False)]
    with pytest.raises(ValueError, match="nowhere"):
        catalogued(spark, "nowhere")
