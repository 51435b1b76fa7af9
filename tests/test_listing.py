"""Folders as on disk: hidden names, empty files, directories; long files as chunks."""

import pytest

from ferret.operators import ingest
from ferret.sources import files
from ferret.sources.files import read_binary, read_chunks, read_lines, text_lines
from ferret.sources.listing import file_pieces, glob_regex, list_folder

NAMES = {"a.txt": b"one\ntwo", ".x.txt": b"hidden license\r\nmore\n", "_x.c": b"int x;\n", "_p=1.md": b"shown\n", ".empty.md": b"",
         "empty.c": b"", "my%20file +é.txt": b"odd name\n", "skip.zip": b"zip"}


@pytest.fixture
def folder(tmp_path):
    d = tmp_path / "in [1]"
    d.mkdir()
    for n, b in NAMES.items():
        (d / n).write_bytes(b)
    (d / "d").mkdir()
    (d / "d" / "deep.txt").write_text("deeper\n")
    (d / ".git").mkdir()
    return d


def _glob(path):
    return str(path).replace("[", "\\[").replace("]", "\\]")  # a path is a glob to Spark's readers


def test_listing_has_every_entry(spark, folder):
    rows = {r.name: r for r in list_folder(spark, str(folder)).collect()}
    assert set(rows) == {*NAMES, "d", ".git"}
    assert {n for n, r in rows.items() if r.is_dir} == {"d", ".git"}
    assert all(rows[n].length == len(b) and rows[n].path == f"file:{folder}/{n}" for n, b in NAMES.items())
    assert {n for n, r in rows.items() if r.hidden} == {".x.txt", "_x.c", ".empty.md", ".git"}
    two = list_folder(spark, str(folder), str(folder / "d"))
    assert two.count() == 11 and two.rdd.getNumPartitions() == 2
    with pytest.raises(Exception, match="none"):
        list_folder(spark, str(folder / "none")).collect()


def test_inventory_knows_directories(spark, folder):
    rows = ingest.inventory(list_folder(spark, str(folder)), "name", is_dir_col="is_dir").collect()
    classes = {r.name: r.type_class for r in rows}
    assert classes["d"] == "directory" and classes[".x.txt"] == "text" and classes["_x.c"] == "extra" and classes["skip.zip"] == "other"
    assert [r.name for r in sorted(rows, key=lambda r: r["rank"])] == sorted(classes, key=lambda n: (n.lower(), n))


@pytest.fixture
def plain_folder(tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    for n, b in NAMES.items():
        (d / n).write_bytes(b)
    (d / "d").mkdir()
    return d


def test_hidden_and_empty_files_are_searched_and_converted(spark, plain_folder):
    lines = {(r.file, r.line_no, r.line, r.path) for r in read_lines(spark, str(plain_folder)).collect()}
    want = [("a.txt", 1, "one"), ("a.txt", 2, "two"), (".x.txt", 1, "hidden license"), (".x.txt", 2, "more"),
            ("my%20file +é.txt", 1, "odd name")]
    assert lines == {(*w, f"file:{plain_folder}/{w[0]}") for w in want}
    assert {r.name: bytes(r.content) for r in read_binary(spark, str(plain_folder)).collect()} == NAMES
    out = {r.name: r for r in ingest.ingest_files(spark, str(plain_folder)).collect()}
    assert out["_x.c"].out_name == "_x (C).txt" and out["_x.c"].text == "int x;\n"
    assert out[".empty.md"].out_name == ".empty (MD).txt" and out[".empty.md"].text == "" == out["empty.c"].text
    assert out["skip.zip"].status == "skip" and out["skip.zip"].text is None and len(out) == len(NAMES)


def test_hidden_files_with_bad_bytes(spark, tmp_path):
    (tmp_path / ".bad.txt").write_bytes(b"ok\nbad \xff\n")
    (tmp_path / "_bom.txt").write_bytes(b"\xef\xbb\xbffirst\n")
    rows = lambda mode: {(r.file, r.line) for r in read_lines(spark, str(tmp_path), mode=mode).collect()}
    assert rows("PERMISSIVE") == {(".bad.txt", "ok"), (".bad.txt", "bad �"), ("_bom.txt", "first")}
    assert rows("DROPMALFORMED") == {("_bom.txt", "first")}
    with pytest.raises(Exception):
        rows("FAILFAST")


LONG = {
    "plain.c": b"".join(b"line %d of it\n" % i for i in range(3000)),
    "open.c": b"".join(b"line %d\r\n" % i for i in range(2000)) + b"no end",
    "bom.c": b"\xef\xbb\xbf" + b"x\n" * 4000,
    "bom_open.c": b"\xef\xbb\xbf" + b"x\n" * 4000 + b"y",
    "blank.c": b"\n" * 9000,
    "mixed.c": b"a\rb\r\nc\xff\xc3\n" * 900 + b"\r",
    "one.c": "é".encode() * 6000 + b"\n" + b"z" * 9000,
    "_hidden.c": b"".join(b"hidden %d\r\n" % i for i in range(2000)) + b"\xff",
}


def _whole(b):
    return b.decode("utf-8", "replace").replace("\r\n", "\n").replace("\r", "\n")


def test_chunks_together_are_the_text(spark, tmp_path):
    d, c = tmp_path / "long", tmp_path / "out"
    d.mkdir()
    for n, b in {**LONG, "small.c": b"tiny\n"}.items():
        (d / n).write_bytes(b)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        got = {}
        for r in read_chunks(spark, str(d), over=100, chunk_bytes=3000).collect():
            got.setdefault(r.path.split("/")[-1], {})[r.chunk_no] = r
        assert set(got) == set(LONG)
        for n, b in LONG.items():
            rows = [got[n][k] for k in range(len(got[n]))]
            assert "".join(r.text for r in rows) == _whole(b), n
            assert [r.first_line for r in rows] == [1 + "".join(x.text for x in rows[:k]).count("\n") for k in range(len(rows))]
            assert all(r.text.endswith("\n") for r in rows[:-1]) and (len(rows) > 1 or n == "one.c")
        # converted with a small row limit, written, and searched: nothing is lost
        out = ingest.ingest_files(spark, str(d), max_file_bytes=3000)
        ingest.write_texts(out, str(c))
        assert ingest.report(out).first().asDict() == {"success": 0, "fail": 0, "unsure": 9, "skip": 0}
        assert ingest.removal_manifest(out).count() == 9
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    table = spark.read.parquet(str(c))
    lines = sorted((r.out_name, r.line_no, r.line) for r in text_lines(table, ["out_name"]).collect())
    want = []
    for n, b in {**LONG, "small.c": b"tiny\n"}.items():
        parts = _whole(b).split("\n")
        want += [(n[:-2] + " (C).txt", i, t) for i, t in enumerate(parts[:-1] if parts[-1] == "" else parts, 1)]
    assert lines == sorted(want)


def test_codec_files_over_the_limit_fail_and_skipped_bodies_stay_unread(spark, tmp_path):
    (tmp_path / "big.docx").write_bytes(b"d" * 2000)
    (tmp_path / "ok.docx").write_bytes(b"d" * 20)
    (tmp_path / "big.zip").write_bytes(b"z" * 2000)
    out = {r.name: r for r in ingest.ingest_files(spark, str(tmp_path), {".docx": lambda b: b.decode() + "!"}, max_file_bytes=100).collect()}
    assert out["ok.docx"].status == "success" and out["ok.docx"].text == "d" * 20 + "!"
    assert out["big.docx"].status == "fail" and "2000 bytes" in out["big.docx"].message and out["big.docx"].out_name is None
    assert out["big.zip"].status == "skip" and out["big.zip"].message == "%% Skipped big.zip"


def test_pieces_of_whole_lines(spark, tmp_path):
    p = tmp_path / "f"
    p.write_bytes(b"aaaa\nb\n\n" + b"c" * 50 + b"\nlast")
    rows = spark.createDataFrame([(f"file:{p}", p.stat().st_size)], "path string, length long")
    for size in (1, 3, 5, 8, 60, 1000):
        got = sorted((r.start, bytes(r.content)) for r in file_pieces(rows, size).collect())
        assert b"".join(b for _, b in got) == p.read_bytes(), size
        assert all(b.endswith(b"\n") for _, b in got[:-1])


def test_globs():
    import re
    for glob, yes, no in (("*.txt", ["a.txt", ".txt"], ["a.TXT", "a.txt.c"]), ("?[a-c]{x,yz}", ["1bx", "ècyz"], ["1dx", "1bz"]),
                          ("a\\*[!b]", ["a*c"], ["axc", "a*b"]), ("{a,b}.c++", ["a.c++"], ["a.cc"])):
        assert all(re.match(glob_regex(glob), n) for n in yes) and not any(re.match(glob_regex(glob), n) for n in no)
    assert files.plain_path is not None
