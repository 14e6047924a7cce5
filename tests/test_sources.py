import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from quernstone.sources import curated, formats, polite, readers, sinks


def test_paged_json_stops_at_the_short_page(spark, tmp_path):
    for k, n in ((1, 3), (2, 3), (3, 1), (4, 3)):
        (tmp_path / f"page-{k}.json").write_text(json.dumps({"records": [{"name": f"{k}/{i}"} for i in range(n)]}))
    got = readers.paged_json(spark, str(tmp_path), page_size=3).select("page", F.get_json_object("record", "$.name").alias("n")).collect()
    assert sorted(r.n for r in got) == ["1/0", "1/1", "1/2", "2/0", "2/1", "2/2", "3/0"]


def test_csv_in_zip(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "r.zip", "w") as z:
        z.writestr("register.csv", "﻿Number,Name,Easting\nA1,\"x, y\",100\nA2,z,bad\n".encode())
    got = readers.csv_in_zip(spark, str(tmp_path / "r.zip"), "Number string, Name string, Easting double, Missing string").collect()
    assert [tuple(r) for r in got] == [("A1", "x, y", 100.0, None), ("A2", "z", None, None)]


def workbook(path, rows):
    cell = lambda ref, v: f'<c r="{ref}" t="inlineStr"><is><t>{v}</t></is></c>' if isinstance(v, str) else f'<c r="{ref}" s="{v[1]}"><v>{v[0]}</v></c>' if isinstance(v, tuple) else f'<c r="{ref}"><v>{v}</v></c>'
    body = "".join(f'<row r="{r}">' + "".join(cell(f"{chr(65 + c)}{r}", v) for c, v in enumerate(row) if v is not None) + "</row>" for r, row in enumerate(rows, 1))
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns}><sheets><sheet name="S" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="x"><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/styles.xml", f'<styleSheet {ns}><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {ns}><sheetData>{body}</sheetData></worksheet>")


def test_workbooks(spark, tmp_path):
    workbook(tmp_path / "p.xlsx", [["Ptno", "Title", "Value", "Site1", "Site2", "Latitude"], ["12871423.0", "Hall", 0.0, "A", ".", 51.5], [None, "blank"], ["7", ".", 5.0, None, "B", (45000, 1)]])
    rows = readers.workbooks(spark, str(tmp_path / "p.xlsx"))
    got = readers.projects(rows).orderBy("external_ref").collect()
    assert [(r.external_ref, r.title, r.value_gbp, r.address, r.latitude) for r in got] == [("12871423", "Hall", None, "A", 51.5), ("7", None, 5.0, "B", None)]
    assert json.loads(got[1].raw_metadata)["Latitude"] == "2023-03-15"
    reg = readers.register_rows(rows, 1, {"Title": "title"}).orderBy("excel_row").collect()
    assert [(r.excel_row, r.title) for r in reg] == [(2, "Hall"), (3, "blank"), (4, ".")]


def test_series(spark):
    df = spark.createDataFrame([("Newport / Casnewydd", 2015, "5"), ("Newport", 2014, "4")], "local_authority string, year int, total_kwh string")
    assert sorted(tuple(r) for r in readers.annual_series(df).collect()) == [("Newport", 2014, 4.0), ("Newport", 2015, 5.0)]
    with pytest.raises(Exception, match="a year twice"):
        readers.annual_series(df.union(df)).collect()


def test_snapshots(spark):
    s = spark.createDataFrame([(1, 1, "k", 5, 200, '{"records":[{"name":"a","x":null}]}'), (2, 1, "k", 6, 500, ""), (3, 1, "j", 4, 200, '{"records":[{"name":"a","x":"full"},{"name":"b","x":"1"}]}')], "id int, source_id int, key string, fetched_at int, status_code int, body string")
    assert sorted(r.id for r in readers.cached_response(s).collect()) == [1, 3]
    want = spark.createDataFrame([(1, "k"), (1, "new")], "source_id int, key string")
    assert [r.key for r in readers.pending_requests(want, s).collect()] == ["new"]
    assert sorted(tuple(r) for r in readers.replayed(s.where("status_code = 200"), "struct<name: string, x: string>").collect()) == [("a", "full"), ("b", "1")]


def test_points(spark):
    body = json.dumps({"elements": [{"type": "node", "id": 1, "lat": 1.0, "lon": 2.0, "tags": {"plant:source": "gas"}}, {"type": "way", "id": 2, "center": {"lat": 3.0, "lon": 4.0}}, {"type": "way", "id": 3}]})
    got = readers.overpass_points(spark.createDataFrame([(body,)], "body string"))
    assert sorted((r.id, r.lat, r.lon) for r in got.collect()) == [("node/1", 1.0, 2.0), ("way/2", 3.0, 4.0)]
    assert spark.range(1).select(readers.gps_column(F.lit("'-1.5, 52.25")).alias("p")).first().p == (52.25, -1.5)
    f = json.loads(sinks.geojson(got.where("id = 'node/1'"), ["id"]).first().value)
    assert f["geometry"]["coordinates"] == [2.0, 1.0] and f["properties"]["id"] == "node/1"
    assert json.loads("".join(sinks.geojson_document(sinks.geojson(got, ["id"]))))["type"] == "FeatureCollection"
    assert "&lt;b&gt;" in sinks.kml(got.withColumn("n", F.lit("<b>")), "id", "n").first().value


def test_document_lists(spark):
    html = '<table><tr><th>Date</th><th>Type</th><th>Link</th></tr><tr><td>1 Jan</td><td>Plan</td><td><a href="/viewer/1">v</a> <a href="/files/a.pdf">d</a></td></tr></table><a  href =/get?file=My%20Doc.pdf>x</a>'
    df = spark.createDataFrame([(1, html)], "page_id int, html string")
    r = readers.document_table(df).first()
    assert r.cells["Type"] == "Plan" and r.href == "/files/a.pdf"
    assert {x.name for x in readers.document_links(df).collect()} == {"1", "a.pdf", "My Doc.pdf"}


def test_groups_none_is_not_empty(spark):
    df = spark.createDataFrame([(1, '{"groups":[{"name":"g","documents":[{"title":"t","url":"u"}]}]}'), (2, "OK"), (3, '{"groups":[]}')], "id int, body string")
    assert sorted((r.id, r.document is None) for r in readers.flattened_groups(df).collect()) == [(1, False), (2, True)]


def test_inbox(spark, tmp_path):
    for name, text in (("a.txt", "one"), ("b.txt", "one"), ("c.txt", "two")):
        (tmp_path / name).write_text(text)
    known = spark.createDataFrame([("3fc4ccfe745870e2c0d99f71f30ff0656c8dedd41cc1d7d3d376b0dbe685e2f3",)], "content_sha256 string")
    got = readers.new_files(spark, str(tmp_path), known).collect()
    assert [r.path.rpartition("/")[2] for r in got] == ["a.txt"]


def test_polite_client():
    answers = [(429, {"Retry-After": "7"}, b""), (503, {}, b""), (200, {}, b"ok")]
    waits = []
    client = polite.PoliteClient(lambda url: answers.pop(0), sleep=waits.append)
    assert client.get("http://h/x") == b"ok" and waits == [1.0, 7.0, 14.0] and client.delays["h"] == 1.5
    with pytest.raises(polite.GaveUp) as e:
        polite.PoliteClient(lambda url: (429, {"Retry-After": "999"}, b""), sleep=waits.append).get("http://h/x")
    assert e.value.wait == 999
    assert polite.fetch_shards([("b", "1"), ("a", "2"), ("a", "3")]) == [("a", ["2", "3"]), ("b", ["1"])]


def zipped(**members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, body in members.items():
            z.writestr(name.replace("__", "/").replace("_dot_", "."), body)
    return out.getvalue()


DOCX = zipped(word__document_dot_xml="<w:p>One &amp; two</w:p><w:p>Three</w:p>")
MAIL = b"From: a@x\nTo: b@x\nDate: Mon, 1 Jan 2024 00:00:00 +0000\nSubject: Hi\n\nBody text\n"


@pytest.mark.parametrize(
    ("data", "name", "kind"),
    [(b"%PDF-1.4", "x", "pdf"), (DOCX, "x.zip", "docx"), (zipped(a="b"), "", "zip"), (MAIL, "m", "eml"), (b"\xff\xfe" + "<html>".encode("utf-16-le"), "", "html"), (b"a,b", "x.CSV", "csv"), (b"text", "", "text"), (b"\x00\x01\x02", "x.txt", "unknown"), (b"", "", "unknown"), (b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1" + "WordDocument".encode("utf-16-le"), "x.msg", "doc"), (b"GIF89a", "", "image")],
)
def test_sniff(data, name, kind):
    assert formats.sniff(data, name) == kind


def test_loading(spark):
    assert formats.load(DOCX)[:2] == ("docx", ["One & two\nThree"])
    assert "Body text" in formats.load(MAIL)[1][0]
    assert formats.load(b"{\\rtf1{\\fonttbl x}Caf\\'e9\\par two}")[1] == ["Café\ntwo"]
    assert formats.load(b"%PDF-1.4")[2] == "unsupported"
    assert formats.load(zipped(a_dot_txt="inner", b_dot_zip=zipped(c="no")))[1] == ["inner"]
    assert formats.decoded("é".encode("latin-1")) == "é" and formats.decoded(b"\xef\xbb\xbfx") == "x"
    assert formats.sections(["a" * 2000, "", "b" * 2000, "c"]) == ["a" * 2000, "b" * 2000 + "\nc"]
    df = spark.createDataFrame([("ok.txt", bytearray(b"hello")), ("bad.docx", bytearray(b"PK\x03\x04broken"))], "path string, content binary")
    got = {r.path: (r.format, r.status) for r in formats.extracted(df).collect()}
    assert got == {"ok.txt": ("text", None), "bad.docx": ("unknown", "unsupported")}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a|b"), (2, "=x"), (3, "y z")], "id int, t string").coalesce(1)
    parts = list(sinks.markdown_parts(df, 7))
    assert len(parts) == 3 and all(p.startswith("| id | t |") for p in parts) and "a\\|b" in parts[0]
    assert sinks.split_text("h\naa\nbb\ncc\n", 8) == ["h\naa\nbb\n", "h\ncc\n"]
    assert [r.t for r in sinks.guarded(df).orderBy("id").collect()] == ["a|b", "'=x", "y z"]
    sinks.csv_bundle(df, "id", str(tmp_path / "out"))
    assert (tmp_path / "out" / "id=1").is_dir()
    m = sinks.manifests(spark.createDataFrame([("k", 2, "b"), ("k", 1, "a")], "k string, o int, v string"), "k", "o").first()
    assert [x["v"] for x in json.loads(m.manifest)] == ["a", "b"]
    assert sinks.column_changes(["a", "b"], ["b", "c"]) == [("delete", "a"), ("insert", "c")]
    assert sinks.typed_by_first_value(spark.sql("select cast(null as string) a, 1L b, 1.5D c")) == {"a": "string", "b": "bigint", "c": "double"}
    files = spark.createDataFrame([("a", "text", 999, "h1"), ("b", "text", 5, "h1"), ("c", "image", 1, "h2"), ("d", "doc", 1, "h3")], "path string, format string, bytes long, sha256 string")
    assert {r.path: r.action for r in sinks.file_actions(files, 100).collect()} == {"a": "split", "b": "drop", "c": "drop", "d": "convert"}


def test_spool(spark, tmp_path):
    path = str(tmp_path / "spool")
    sinks.spool(spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string").coalesce(1), path)
    next((tmp_path / "spool").glob("part-*.json")).open("a").write('{"id": 3, "v": "tor')
    for crc in (tmp_path / "spool").glob(".*.crc"):
        crc.unlink()
    stored = spark.createDataFrame([(1,)], "id int")
    assert [(r.id, r.v) for r in sinks.drained(spark, path, "id int, v string", stored, ["id"]).collect()] == [(2, "b")]


def test_workbook_written_and_read(spark, tmp_path):
    rows = [(1, "a|b", 1.5, True, '=HYPERLINK("http://x","y")'), (2, "=1+1", None, False, "-x"), (3, "é <&> \x01z", 2.0, None, None)]
    df = spark.createDataFrame(rows, "id int, t string, v double, b boolean, link string").coalesce(1)
    path = str(tmp_path / "out.xlsx")
    names = sinks.write_workbook({"sites": df, "empty": df.limit(0)}, path, {"id": "the number"}, sheet_rows=2)
    assert names == ["sites", "sites 2", "empty", "data dictionary"]
    got = {}
    for r in readers.workbooks(spark, path).collect():
        got.setdefault(r.sheet, []).append(r.cells)
    assert got["sites"][0] == ["id", "t", "v", "b", "link"] and got["empty"] == [["id", "t", "v", "b", "link"]]
    assert got["sites"][1][:3] == ["1", "a|b", "1.5"] and got["sites"][2][1] == "'=1+1"
    assert got["sites 2"][1][:2] == ["3", "é <&> z"] and got["data dictionary"][1] == ["id", "the number"]
    with zipfile.ZipFile(path) as z:
        assert b"<f>HYPERLINK(" in z.read("xl/worksheets/sheet1.xml")
    assert sinks._letters(0) == "A" and sinks._letters(25) == "Z" and sinks._letters(26) == "AA" and sinks._letters(702) == "AAA"


def test_versions_are_appended(spark, tmp_path):
    path = str(tmp_path / "versions")
    for v in ("a", "b"):
        sinks.append_version(spark.createDataFrame([(1, v)], "id int, v string"), path)
    got = spark.read.parquet(path)
    assert sorted(r.v for r in got.collect()) == ["a", "b"] and got.where("inserted_at is null").count() == 0


def test_jdbc_tables(spark):
    url, driver = "jdbc:derby:memory:store;create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    df = spark.createDataFrame([(k, f"n{k}", k * 1.5) for k in range(20)], "id int, name string, v double")
    df.coalesce(1).write.format("jdbc").option("url", url).option("driver", driver).option("dbtable", "records").mode("overwrite").save()
    whole = curated.jdbc_table(spark, url, "records", driver)
    assert whole.count() == 20 and whole.where("id > 15").select("name").count() == 4
    parts = curated.jdbc_table(spark, url, "records", driver, partition=("ID", 0, 20, 4))
    assert parts.rdd.getNumPartitions() == 4 and sorted(r[0] for r in parts.select("id").collect()) == list(range(20))


def test_yaml_lists(spark, tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "claims.yaml").write_text("claims:\n- name: ' A '\n  value: 12\n  as_at: 2024-05-03\n  refs: [x, 2]\n  attrs: {k: 1}\n- name: B\nempty:\n")
    ddl = "name string, value double, as_at string, refs array<string>, attrs map<string,string>"
    got = curated.yaml_rows(spark, str(tmp_path / "claims.yaml"), "claims", ddl).collect()
    assert [tuple(r) for r in got] == [(0, "A", 12.0, "2024-05-03", ["x", "2"], {"k": "1"}), (1, "B", None, None, None, None)]
    assert curated.yaml_rows(spark, str(tmp_path / "claims.yaml"), "empty", "name string").count() == 0
    assert curated.yaml_rows(spark, str(tmp_path / "none.yaml"), "claims", ddl).count() == 0


def test_links_in_attributes(spark):
    html = """<ul><li><a href='/doc/1' title="One">view</a><li><button class=x data-url="/doc/2" data-name="Two">b</button><a href="/doc/1">again</a> <a href="/doc/3"> Three </a>"""
    got = readers.data_links(spark.createDataFrame([(1, html)], "page_id int, html string")).collect()
    assert sorted((r.href, r.name) for r in got) == [("/doc/1", "One"), ("/doc/2", "Two"), ("/doc/3", "Three")]


def test_project_pages_without_a_known_applicant(spark):
    html = "<p>Name of applicant: Somebody Ltd New Nuclear Power Station of 3,260 MW and 3260MW Project information"
    r = readers.project_pages(spark.createDataFrame([(1, html), (2, None)], "page_id int, html string")).orderBy("page_id").first()
    assert r.description is None and r.description_raw.endswith("3260MW") and r.capacities == ["3260 MW"]
