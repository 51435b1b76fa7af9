import io
import os
import zipfile

from pyspark.sql import functions as F

from ferret.operators import ingest
from ferret.plans import catalog
from tests.conftest import SF_MID


def _codec():
    def docx_text(blob):
        import io
        import re
        import zipfile
        with zipfile.ZipFile(io.BytesIO(blob)) as z:
            xml = z.read("word/document.xml").decode()
        return "".join("".join(re.findall(r"<w:t[^>]*>([^<]*)", p)) + "\n" for p in re.findall(r"<w:p\b.*?</w:p>", xml, re.S))
    return docx_text


docx_text = _codec()


def _docx(paragraphs):
    ns = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    body = "".join(f'<w:p><w:r><w:t>{p}</w:t></w:r></w:p>' for p in paragraphs)
    xml = f'<?xml version="1.0"?><w:document xmlns:w="{ns}"><w:body>{body}</w:body></w:document>'
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("word/document.xml", xml)
    return buf.getvalue()


def test_report_counts_on_manifest(spark):
    r = catalog.QUERIES["conversion_report"](spark, SF_MID).first()
    assert (r.success, r.fail, r.unsure, r.skip) == (0, 250, 375, 375)
    r = catalog.QUERIES["conversion_report_substring"](spark, SF_MID).first()
    assert (r.success, r.fail, r.unsure, r.skip) == (0, 250, 500, 250)


def test_output_names_pinned(spark):
    rows = {r.file_name: r.out_name for r in catalog.QUERIES["output_naming"](spark, SF_MID).collect()}
    assert rows["d0.html"] == "d0 (HTML).txt"
    assert rows["d0.C"] == "d0 (C).txt"
    assert rows["d0.c"] == "d0 (C) (1).txt"


def test_substring_type_match_quirk(spark):
    names = spark.createDataFrame([("a",), ("b.j",), ("c.c",), ("d.txt",)], "name string")
    got = {r.name: r.handler for r in ingest.classify(names, "name", types=(".css", ".js", ".p", ".py"),
                                                         type_match="substring").collect()}
    assert got == {"a": "plain", "b.j": "plain", "c.c": "plain", "d.txt": "skip"}


def test_naming_skips_existing_names(spark):
    files = spark.createDataFrame([("a.c", "x"), ("a.C", "y"), ("b.md", "z")], "name string, text string")
    conv = ingest.convert(ingest.classify(files, "name"), "name", "text", text_input=True)
    existing = spark.createDataFrame([("a (C).txt",), ("a (C) (2).txt",)], "out_name string")
    got = {r.name: r.out_name for r in ingest.name_outputs(conv, "name", existing).collect()}
    assert got == {"a.C": "a (C) (1).txt", "a.c": "a (C) (3).txt", "b.md": "b (MD).txt"}


def test_ingest_files_with_codecs(spark, tmp_path):
    d = tmp_path / "src"
    d.mkdir()
    (d / "r.docx").write_bytes(_docx(["First para", "Second license line"]))
    (d / "broken.docx").write_bytes(b"not a zip")
    (d / "p.pdf").write_bytes(b"%PDF-1.4")
    (d / "w.html").write_bytes(b"<p>one</p>\r\n<p>two\xff</p>\r")
    (d / "notes.txt").write_bytes(b"skip me\n")
    out = ingest.ingest_files(spark, str(d), codecs={".docx": docx_text})
    rows = {r.name: r for r in out.collect()}
    assert rows["r.docx"].status == "success" and rows["r.docx"].text == "First para\nSecond license line\n"
    assert rows["r.docx"].out_name.endswith("r (DOCX).txt")
    assert rows["broken.docx"].status == "fail" and rows["broken.docx"].message.startswith("XX BadZipFile")
    assert rows["p.pdf"].status == "fail" and "No converter for .pdf" in rows["p.pdf"].message
    assert rows["w.html"].status == "unsure" and rows["w.html"].text == "<p>one</p>\n<p>two�</p>\n"
    assert rows["notes.txt"].status == "skip" and rows["notes.txt"].message == "%% Skipped notes.txt"
    rep = ingest.report(out).first()
    assert (rep.success, rep.fail, rep.unsure, rep.skip) == (1, 2, 1, 1)
    sink = str(tmp_path / "texts")
    ingest.write_texts(out, sink)
    assert spark.read.parquet(sink).count() == 2


def test_convert_then_search_files(spark, tmp_path):
    from ferret.operators.exact import exact_search_texts
    from ferret.operators.fuzzy import fuzzy_search
    from ferret.functions.text import lines_of
    d = tmp_path / "inbox"
    d.mkdir()
    (d / "a.md").write_bytes(b"# Title\r\nThis LICENSE applies\r\n")
    (d / "b.py").write_bytes(b"# the licence text\n")
    (d / "c.zip").write_bytes(b"PK license")
    (d / "r.docx").write_bytes(_docx(["see the license file"]))
    sink = str(tmp_path / "texts")
    ingest.write_texts(ingest.ingest_files(spark, str(d), codecs={".docx": docx_text}), sink)
    texts = spark.read.parquet(sink)
    hits = sorted((r.out_name, r.line_no, r.line) for r in
                  exact_search_texts(texts, "license", ["out_name"], "text").collect())
    assert hits == [("a (MD).txt", 2, "This LICENSE applies"), ("r (DOCX).txt", 1, "see the license file")]
    from tests.brute import fuzzy_hits
    close = sorted((r.out_name, r.line_no, r.matched_token) for r in
                   fuzzy_search(lines_of(texts, ["out_name"], "text"), "license", ["out_name"]).collect())
    want = sorted((r.out_name, h[0], h[2]) for r in texts.collect() for h in fuzzy_hits(r.text, "license", 0.85))
    assert close == want and ("b (PY).txt", 1, "licence") in close


def test_oversized_files_keep_status_and_text(spark, tmp_path):
    d = tmp_path / "big"
    d.mkdir()
    (d / "huge.md").write_bytes(b"x" * 5000)
    (d / "small.md").write_bytes(b"fine\n")
    (d / "huge.bin").write_bytes(b"y" * 5000)
    rows = {r.name: r for r in ingest.ingest_files(spark, str(d), max_file_bytes=1000).collect()}
    assert rows["small.md"].status == "unsure" and rows["small.md"].text == "fine\n"
    assert rows["huge.md"].status == "unsure" and rows["huge.md"].text == "x" * 5000  # one line is never cut
    assert rows["huge.md"].out_name == "huge (MD).txt"
    assert rows["huge.bin"].status == "skip"


def test_plain_lines_equal_whole_text_conversion(spark, tmp_path):
    from ferret.functions.text import lines_of
    d = tmp_path / "plain"
    d.mkdir()
    (d / "a.md").write_bytes(b"one\r\ntwo\rthree\n")
    (d / "a.MD").write_bytes(b"upper\n")
    (d / "b.c").write_bytes("".join(f"line {i}\n" for i in range(3000)).encode())
    (d / "c.C").write_bytes(b"x\ny")
    (d / "skip.bin").write_bytes(b"\x00\x01")
    (d / "r.docx").write_bytes(b"not converted here")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(8 * 1024))  # b.c takes the split path
    try:
        got = sorted(tuple(r) for r in ingest.convert_plain_lines(spark, str(d)).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    whole = ingest.ingest_files(spark, str(d)).filter("status = 'unsure'")
    want = sorted(tuple(r) for r in lines_of(whole, ["out_name"], "text").collect())
    assert got == want and len(got) == 3 + 3000 + 2  # a.MD is skipped: types are case-sensitive


def test_names_of_different_heads_do_not_meet(spark):
    types = (".c", ".C", ".1")
    files = spark.createDataFrame([("a.c", "x"), ("a.C", "y"), ("a (C).1", "z")], "name string, text string")
    conv = ingest.convert(ingest.classify(files, "name", types), "name", "text", text_input=True)
    got = {r.name: r.out_name for r in ingest.name_outputs(conv, "name").collect()}
    assert len(set(got.values())) == 3 and got["a (C).1"] == "a (C) (1).txt"


def test_naming_reads_no_text(spark):
    from tests.conftest import SF_SMALL
    plan = catalog.QUERIES["convert_then_search"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    # one scan reads the texts to search, the other only what names are made of
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan and "ReadSchema: struct<doc_id:bigint>" in plan
