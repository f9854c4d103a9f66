import io
import json
import zipfile

import pytest

from folium import sources as src
from folium.sinks import bundle_manifest, bundle_pages, write_jsonl
from folium.sources.files import safe_member
from folium.sources.providers import Canned, Echo, ask
from folium.streaming.progress import read_events, stage_status, stream_status


def zipped(**files):
    b = io.BytesIO()
    with zipfile.ZipFile(b, "w") as z:
        for k, v in files.items():
            z.writestr(k.replace("__", "/"), v)
    return b.getvalue()


def test_jsonl(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"a": 1, "b": "x"}\n\n{"a": 2}\n')
    assert [tuple(r) for r in src.read_jsonl(spark, str(tmp_path / "a.jsonl"), "a long, b string").collect()] == [(1, "x"), (2, None)]
    (tmp_path / "b.jsonl").write_text('{"a": 1}\nnot json\n[1]\n{"a": 3}\n')
    assert [r.a for r in src.read_jsonl(spark, str(tmp_path / "b.jsonl"), "a long", lenient=True).collect()] == [1, 3]
    with pytest.raises(Exception):
        src.read_jsonl(spark, str(tmp_path / "b.jsonl"), "a long").collect()
    (tmp_path / "c.json").write_text(json.dumps([{"a": 1}, {"a": 2}]))
    assert src.read_json_any(spark, str(tmp_path / "c.json"), "a long").count() == 2
    write_jsonl(spark.createDataFrame([(3, None), (1, "x")], "a long, b string"), str(tmp_path / "out"), ["a"])
    lines = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*")))
    assert [json.loads(x) for x in lines.splitlines()] == [{"a": 1, "b": "x"}, {"a": 3, "b": None}]


def test_folders(spark, tmp_path):
    for n in ("page10.png", "page9.png", "cover.png", "x.txt"):
        (tmp_path / n).write_bytes(b"1")
    assert [r.image.rsplit("/", 1)[-1] for r in src.image_manifest(spark, str(tmp_path)).orderBy("page").collect()] == ["page9.png", "page10.png", "cover.png"]
    assert {r.kind for r in src.folder_members(spark, str(tmp_path)).collect()} == {"image", "text"}
    t = tmp_path / "t"
    t.mkdir()
    (t / "b.txt").write_text("two\nlines")
    (t / "a.txt").write_text("one")
    assert [(r.page, r.text) for r in src.text_pages(spark, str(t), 5).orderBy("page").collect()] == [(5, "one"), (6, "two\nlines")]
    h = tmp_path / "h"
    h.mkdir()
    (h / "a.html").write_text("<h1>A</h1><p>b</p>")
    assert src.html_pages(spark, str(h)).first().text == "A\nb"


def test_zip(spark, tmp_path):
    (tmp_path / "a.zip").write_bytes(zipped(**{"a.txt": "x", "d__b.txt": "y"}))
    (tmp_path / "b.zip").write_bytes(b"broken")
    rows = src.unzip_members(src.binary_files(spark, str(tmp_path), "*.zip")).orderBy("archive", "member_no").collect()
    assert [(r.member_id, r.member_path, r.outcome) for r in rows] == [("member-001", "a.txt", "ok"), ("member-002", "d/b.txt", "ok"), (None, None, "unreadable")]
    assert safe_member("../x") is None and safe_member("/etc/x") is None and safe_member("a/./b") == "a/b"


def test_mail(spark, tmp_path):
    one = "From: A <a@x.org>\nTo: b@x.org\nSubject: Hi\nMessage-ID: <1@x>\n\nFirst.\n\nSecond.\n"
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "a.mbox").write_text(f"From a@x.org Mon\n{one}\n>From here on\n\nFrom b@x.org Tue\nSubject: Two\nContent-Type: text/html\n\n<p>Hello</p>\n")
    rows = src.read_mbox(spark, str(tmp_path / "m")).orderBy("message_no").collect()
    assert [(r.message_no, r.subject, r.sender) for r in rows] == [(1, "Hi", ["a@x.org"]), (2, "Two", [])]
    assert rows[0].body.endswith("From here on") and rows[0].element_ids[:2] == ["m0001-e0001", "m0001-e0002"] and rows[1].body == "Hello"
    (tmp_path / "e").mkdir()
    (tmp_path / "e" / "a.eml").write_text(one)
    assert src.read_eml(spark, str(tmp_path / "e")).first().recipients == ["b@x.org"]


def test_office(spark, tmp_path):
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    doc = f'<w:document {w}><w:body><w:p><w:pPr><w:pStyle w:val="Heading1"/></w:pPr><w:r><w:t>Head</w:t></w:r></w:p><w:p><w:r><w:t>Body</w:t></w:r></w:p></w:body></w:document>'
    (tmp_path / "a.docx").write_bytes(zipped(**{"word__document.xml": doc}))
    (tmp_path / "b.docx").write_bytes(b"no zip")
    sheet = '<worksheet><sheetData><row><c t="s"><v>0</v></c><c><v>5</v></c></row></sheetData></worksheet>'
    (tmp_path / "a.xlsx").write_bytes(zipped(**{"xl__workbook.xml": '<workbook><sheets><sheet name="S"/></sheets></workbook>', "xl__sharedStrings.xml": "<sst><si><t>Name</t></si></sst>", "xl__worksheets__sheet1.xml": sheet}))
    slide = '<p:sld xmlns:p="p" xmlns:a="a"><p:sp><p:nvSpPr><p:nvPr><p:ph type="title"/></p:nvPr></p:nvSpPr><p:txBody><a:p><a:r><a:t>T</a:t></a:r></a:p></p:txBody></p:sp></p:sld>'
    (tmp_path / "a.pptx").write_bytes(zipped(**{"ppt__slides__slide1.xml": slide}))
    opf = '<package><metadata><title>Book</title></metadata><manifest><item id="c" href="c.xhtml"/></manifest><spine><itemref idref="c"/></spine></package>'
    (tmp_path / "a.epub").write_bytes(zipped(**{"META-INF__container.xml": '<container><rootfile full-path="o/p.opf"/></container>', "o__p.opf": opf, "o__c.xhtml": "<body><h1>One</h1><p>Text</p></body>"}))
    got = {k: [(r.element_type, r.text) for r in src.read_office(spark, str(tmp_path), k).orderBy("path", "seq").collect()] for k in ("docx", "xlsx", "pptx", "epub")}
    assert got == {"docx": [("Title", "Head"), ("NarrativeText", "Body"), ("Unreadable", None)], "xlsx": [("Table", "Name\t5")], "pptx": [("Title", "T")], "epub": [("MetadataTitle", "Book"), ("Title", "One"), ("NarrativeText", "Text")]}


def test_providers(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "i long, p string")
    assert [r.answer for r in ask(df, "i", "p", Echo()).orderBy("request_id").collect()] == ["a", None]
    assert {r.answer for r in ask(df, "i", "p", Canned({}, "none")).collect()} == {"none"}


def test_bundle(spark):
    rows = [("r", "e1", 1, 1, "heading", "A & B"), ("r", "e1", 1, 2, "list_item", "x"), ("r", "e1", 1, 3, "list_item", "y"), ("r", "e1", 1, 4, "paragraph", " "), ("r", "e1", 1, 5, "paragraph", "z"), ("r", "e2", 2, 1, "paragraph", "q")]
    pages = bundle_pages(spark.createDataFrame(rows, "run_id string, entry_id string, entry_order long, block_order long, kind string, text string"))
    html = {r.entry_id: r for r in pages.collect()}["e1"]
    assert html.html.split("\n")[1:3] == ['<ul><li id="blk-e1-0002">x</li>', '<li id="blk-e1-0003">y</li></ul>'] and html.block_ids[-1] == "blk-e1-0005" and "A &amp; B" in html.html
    m = bundle_manifest(pages).first()
    assert m.reading_order == ["e1", "e2"] and m.entries[0].next_entry_id == "e2" and m.entries[0].prev_entry_id is None


def test_progress(spark, tmp_path):
    ev = [(1, "r", "s", "running", "a"), (2, "r", "s", "done", "b"), (3, "r", "s", "warning", "c"), (4, "r", "t", "warning", "d")]
    cols = "seq long, run_id string, stage string, status string, message string"
    want = {("s", "done", "c", 3), ("t", "running", "d", 1)}
    assert {(r.stage, r.status, r.message, r.events) for r in stage_status(spark.createDataFrame(ev, cols)).collect()} == want
    for i in (0, 2):
        spark.createDataFrame(ev[i : i + 2], cols).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    got = {}

    def keep(df, _):
        got.update({r.stage: (r.stage, r.status, r.message, r.events) for r in df.collect()})

    q = stream_status(read_events(spark, str(tmp_path / "in"))).writeStream.foreachBatch(keep).outputMode("update").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    assert set(got.values()) == want
