import os

import pytest

from ferret.operators.exact import exact_search
from ferret.sources.files import read_binary, read_lines, read_texts, read_type_list
from ferret.operators import ingest

CORPUS = {
    "a.txt": b"Hello world\nsecond\r\nthird\rfourth\n\n",
    "nonl.txt": b"x\ny",
    "empty.txt": b"",
    "odd.txt": "a b\x0bc\x0cd\x85e\x1cf\n".encode(),
    "bom.txt": b"\xef\xbb\xbfhello\n",
    "bad.txt": b"ok\nbad \xff\xfe byte\n",
    "UP.TXT": b"upper suffix\n",
    ".hid.txt": b"hidden\n",
    "_und.txt": b"underscore\n",
}


@pytest.fixture(scope="module")
def corpus(tmp_path_factory):
    d = tmp_path_factory.mktemp("corpus")
    for name, data in CORPUS.items():
        (d / name).write_bytes(data)
    (d / "sub").mkdir()
    (d / "sub" / "s.txt").write_bytes(b"nested\n")
    return str(d)


def _by_file(rows):
    out = {}
    for r in rows:
        out.setdefault(r.file, []).append((r.line_no, r.line))
    return {k: sorted(v) for k, v in out.items()}


def test_line_scan_rules(spark, corpus):
    got = _by_file(read_lines(spark, corpus).collect())
    assert got["a.txt"] == [(1, "Hello world"), (2, "second"), (3, "third"), (4, "fourth"), (5, "")]
    assert got["nonl.txt"] == [(1, "x"), (2, "y")]
    assert "empty.txt" not in got
    # U+2028, \x0b, \x0c, U+0085, \x1c are not line breaks for the searcher
    assert got["odd.txt"] == [(1, "a b\x0bc\x0cd\x85e\x1cf")]
    # the BOM is dropped by the line reader (documented divergence)
    assert got["bom.txt"] == [(1, "hello")]
    assert got["bad.txt"] == [(1, "ok"), (2, "bad �� byte")]
    # suffix is case-sensitive, no recursion; names that Spark's readers hide count like others
    assert got[".hid.txt"] == [(1, "hidden")] and got["_und.txt"] == [(1, "underscore")]
    for name in ("UP.TXT", "s.txt"):
        assert name not in got


def test_utf8_modes(spark, corpus):
    dropped = _by_file(read_lines(spark, corpus, mode="DROPMALFORMED").collect())
    assert "bad.txt" not in dropped and "a.txt" in dropped
    with pytest.raises(Exception):
        read_lines(spark, corpus, mode="FAILFAST").collect()


def test_numbering_across_splits(spark, tmp_path):
    d = tmp_path / "big"
    d.mkdir()
    (d / "b1.txt").write_text("".join(f"line {i} of the first file\n" for i in range(1, 20001)))
    (d / "b2.txt").write_text("".join(f"line {i} second\n" for i in range(1, 5001)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(64 * 1024))
    try:
        lines = read_lines(spark, str(d))
        assert spark.read.text(str(d)).rdd.getNumPartitions() >= 8
        rows = lines.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(rows) == 25000
    for r in rows:
        assert r.line.split()[1] == str(r.line_no)


def test_search_over_files(spark, corpus):
    hits = exact_search(read_lines(spark, corpus), "WORLD", ["file"]).collect()
    assert [(h.file, h.line_no, h.line) for h in hits] == [("a.txt", 1, "Hello world")]


def test_whole_text_reader_keeps_bom(spark, corpus):
    rows = {r.file: r.text for r in read_texts(spark, corpus).collect()}
    assert rows["bom.txt"] == "﻿hello\n"


def test_type_list_file(spark, tmp_path):
    p = tmp_path / "types.conf"
    p.write_text("# types\n\n" + "\n".join(" ".join(ingest.DEFAULT_TYPES[i:i + 8]) for i in range(0, 40, 8)) + "\n")
    got = [r.ext for r in read_type_list(spark, str(p)).collect()]
    assert tuple(got) == ingest.DEFAULT_TYPES
    assert ingest.DEFAULT_TYPES[:3] == (".css", ".sass", ".html") and len(ingest.DEFAULT_TYPES) == 40


def test_binary_listing_prunes_content(spark, corpus):
    df = read_binary(spark, corpus, with_content=False)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1].split("\n")[0]
    names = {r.name for r in df.collect()}
    assert {"a.txt", "empty.txt"} <= names  # zero-byte files come from a listing


def test_bad_byte_in_a_later_split_drops_the_whole_file(spark, tmp_path):
    d = tmp_path / "split_bad"
    d.mkdir()
    good = "".join(f"row {i} of a long file\n" for i in range(1, 8001)).encode()
    (d / "big.txt").write_bytes(good + b"tail \xff here\n")
    (d / "ok.txt").write_bytes(b"fine\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(32 * 1024))
    try:
        kept = {r.file for r in read_lines(spark, str(d), mode="DROPMALFORMED").collect()}
        rows = read_lines(spark, str(d)).filter("file = 'big.txt'").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert kept == {"ok.txt"}
    assert len(rows) == 8001
    last = max(rows, key=lambda r: r.line_no)
    assert (last.line_no, last.line) == (8001, "tail � here")


def test_whole_file_and_split_paths_agree(spark, corpus):
    for mode in ("PERMISSIVE", "DROPMALFORMED"):
        whole = sorted(tuple(r) for r in read_lines(spark, corpus, mode=mode, whole_file_bytes=1 << 30).collect())
        split = sorted(tuple(r) for r in read_lines(spark, corpus, mode=mode, whole_file_bytes=-1).collect())
        assert whole == split and len(whole) > 5, mode


ODD = ("my file.c", "a%20b.c", "c#d.c", "e+f.c", "größe.c")


def test_names_as_on_disk(spark, tmp_path):
    from ferret.sources.files import read_texts
    from ferret.streaming.watch import stream_lines
    for i, n in enumerate(ODD):
        (tmp_path / n).write_text(f"line of {i}\n")
    for df in (read_lines(spark, str(tmp_path), glob="*.c"), read_texts(spark, str(tmp_path), glob="*.c")):
        assert {r.file for r in df.collect()} == set(ODD)
        assert {r.path for r in df.collect()} == {f"file:{tmp_path}/{n}" for n in ODD}
    assert {r.name for r in read_binary(spark, str(tmp_path)).collect()} == set(ODD)
    got = {r.out_name: r.line for r in ingest.convert_plain_lines(spark, str(tmp_path)).collect()}
    assert got == {n[:-2] + " (C).txt": f"line of {i}" for i, n in enumerate(ODD)}
    q = (stream_lines(spark, str(tmp_path), glob="*.c").writeStream.format("memory").queryName("odd_names")
         .trigger(availableNow=True).start())
    q.awaitTermination(120)
    assert {r.file for r in spark.table("odd_names").collect()} == set(ODD)


def test_large_file_keeps_all_lines_when_splits_change(spark, tmp_path):
    (tmp_path / "a.txt").write_text("".join(f"n {i}\n" for i in range(1, 40_001)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(16 << 10))
        lines = read_lines(spark, str(tmp_path))
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(40 << 10))  # another layout before the action
        rows = lines.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(rows) == 40_000 and all(r.line == f"n {r.line_no}" for r in rows)


def test_zero_byte_sources_are_converted(spark, tmp_path):
    (tmp_path / "empty.md").write_bytes(b"")
    (tmp_path / "full.md").write_bytes(b"x\n")
    rows = {r.name: r for r in ingest.ingest_files(spark, str(tmp_path)).collect()}
    assert rows["empty.md"].status == "unsure" and rows["empty.md"].text == "" and rows["empty.md"].out_name == "empty (MD).txt"
    assert ingest.report(ingest.ingest_files(spark, str(tmp_path))).first().unsure == 2
