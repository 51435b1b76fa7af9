from ferret.operators.search import search
from ferret.sources.files import read_lines
from ferret.streaming.watch import search_stream, start_search_stream


def _rows(df):
    return sorted((r.file, r.line_no, r.line, r.method, r.matched_token) for r in df.collect())


def test_stream_equals_batch(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.txt").write_text("The license is here\nnothing\nLicensed work\n")
    (src / "b.txt").write_text("no match\r\nmore license text\r\n")
    (src / "c.txt").write_bytes(b"\xef\xbb\xbflicense on the first line\n")
    for method in ("exact", "fuzzy"):
        name = f"mem_{method}"
        q = (search_stream(spark, str(src), "license", method).writeStream.format("memory")
             .queryName(name).outputMode("append").trigger(availableNow=True).start())
        q.awaitTermination(120)
        got = _rows(spark.table(name))
        want = _rows(search(read_lines(spark, str(src)), "license", ["file"], method))
        assert got == want and len(got) >= 2


def test_stream_to_parquet_sink(spark, tmp_path):
    src = tmp_path / "in2"
    src.mkdir()
    (src / "c.txt").write_text("alpha\nbeta license\n")
    sink = str(tmp_path / "hits")
    q = start_search_stream(spark, str(src), "LICENSE", sink, str(tmp_path / "ckpt"), available_now=True)
    q.awaitTermination(120)
    rows = spark.read.parquet(sink).collect()
    assert [(r.file, r.line_no, r.line) for r in rows] == [("c.txt", 2, "beta license")]


def test_restart_in_a_new_application_finds_new_files(tmp_path):
    import subprocess
    import sys
    src, sink, ckpt = tmp_path / "in3", tmp_path / "out3", tmp_path / "ckpt3"
    src.mkdir()
    program = """
import sys
from ferret.session import local_session
from ferret.streaming.watch import start_search_stream
spark = local_session(2, 2)
start_search_stream(spark, sys.argv[1], "license", sys.argv[2], sys.argv[3], available_now=True).awaitTermination(120)
print("HITS", sorted(r.file for r in spark.read.parquet(sys.argv[2]).collect()))
"""
    for n, want in (("f1.txt", ["f1.txt"]), ("f2.txt", ["f1.txt", "f2.txt"])):
        (src / n).write_text("a license line\n")
        out = subprocess.run([sys.executable, "-c", program, str(src), str(sink), str(ckpt)], capture_output=True, text=True,
                             timeout=200)
        assert f"HITS {want}" in out.stdout, out.stderr[-2000:]


QUERIES = [("1", "license"), ("2", "a"), ("3", "more")]


def test_many_queries_on_a_stream_equal_batch_after_a_restart(spark, tmp_path):
    from ferret.operators import multi
    from ferret.streaming.watch import start_many_search_stream
    src = tmp_path / "many"
    src.mkdir()
    queries = spark.createDataFrame(QUERIES, "query_id string, query string")
    files = {"a [1].txt": "A license here\nnothing\n", "b{x}.txt": "more license text\r\nand more\r\n", "big.txt": "some licence\nnone\n" * 400}
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")  # big.txt takes several splits
    try:
        for name, text in files.items():
            (src / name).write_text(text)
            for fuzzy in (False, True):
                where = str(tmp_path / f"hits{fuzzy}")
                start_many_search_stream(spark, str(src), queries, where, str(tmp_path / f"ckpt{fuzzy}"), fuzzy,
                                         available_now=True).awaitTermination(180)
        lines = read_lines(spark, str(src)).select("file", "line_no", "line")
        for fuzzy, search_many in ((False, multi.exact_search_many), (True, multi.fuzzy_search_many)):
            got = spark.read.parquet(str(tmp_path / f"hits{fuzzy}")).drop("batch")
            want = search_many(lines, queries, ["file"])
            assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect())) != []
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_names_on_a_stream_stay_taken_after_a_restart(spark, tmp_path):
    from ferret.operators import ingest
    from ferret.streaming.naming import start_naming_stream
    src, sink, ckpt = str(tmp_path / "src"), str(tmp_path / "names"), str(tmp_path / "ckpt")
    taken = spark.createDataFrame([("b (C).txt",), ("b (C) (2).txt",)], "out_name string")
    schema = "name string, status string"
    names = {}
    for batch in (["a.c", "b.c", "z.zip"], ["a.C", "b.C", "a (C).c"], ["a.c", "b.c", "c.c"]):  # the third repeats two sources
        spark.createDataFrame([(n, "skip" if n.endswith("zip") else "unsure") for n in batch], schema).write.mode("append").parquet(src)
        stream = ingest.classify(spark.readStream.schema(schema).parquet(src), "name").select("name", "head", "label", "status")
        start_naming_stream(stream, sink, ckpt, existing=taken, available_now=True).awaitTermination(180)
        for r in spark.read.parquet(sink).collect():
            assert names.setdefault(r.name, r.out_name) == r.out_name  # one name for good
    assert names == {"a.c": "a (C).txt", "a.C": "a (C) (1).txt", "b.c": "b (C) (1).txt", "b.C": "b (C) (3).txt",
                     "a (C).c": "a (C) (C).txt", "c.c": "c (C).txt"}
    assert len(set(names.values())) == len(names)
