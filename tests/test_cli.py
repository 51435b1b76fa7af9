from ferret.cli import main


def test_convert_then_search_from_the_command_line(spark, tmp_path, capsys):
    src = tmp_path / "inbox"
    src.mkdir()
    (src / "a.md").write_bytes(b"one license\nlicence two\n")
    (src / "b.log").write_bytes(b"nothing\n")
    (src / "c.zip").write_bytes(b"license")
    conv = str(tmp_path / "conv")
    main(["convert", "--src", str(src), "--out", conv], spark=spark)
    assert capsys.readouterr().out.strip() == "success=0\tfail=0\tunsure=2\tskip=1"
    hits = str(tmp_path / "hits")
    main(["search", "--table", conv, "--key", "out_name", "--query", "License", "--query", "zzz",
          "--out", hits], spark=spark)
    assert capsys.readouterr().out.strip().splitlines() == ["1\tLicense", "0\tzzz"]
    rows = spark.read.parquet(hits).collect()
    assert [(r.out_name, r.line_no, r.line) for r in rows] == [("a (MD).txt", 1, "one license")]
    fz = str(tmp_path / "fz")
    main(["search", "--dir", str(src), "--query", "license", "--fuzzy", "--out", fz], spark=spark)
    assert capsys.readouterr().out.strip() == "0\tlicense"  # no .txt files in the folder


def test_search_folder(spark, tmp_path, capsys):
    d = tmp_path / "c"
    d.mkdir()
    (d / "x.txt").write_text("The licence\nfoo\n")
    qf = tmp_path / "q.txt"
    qf.write_text("license\n")
    out = str(tmp_path / "h")
    main(["search", "--dir", str(d), "--queries-file", str(qf), "--fuzzy", "--out", out], spark=spark)
    assert capsys.readouterr().out.strip() == "1\tlicense"
    r = spark.read.parquet(out).first()
    assert (r.file, r.line_no, r.matched_token) == ("x.txt", 1, "licence")


def test_convert_with_lines(spark, tmp_path, capsys):
    src = tmp_path / "in3"
    src.mkdir()
    (src / "n.md").write_bytes(b"alpha\r\nbeta\n")
    out = str(tmp_path / "c3")
    main(["convert", "--src", str(src), "--out", out, "--lines", "--verbose"], spark=spark)
    assert capsys.readouterr().out.strip() == "unsure\t1"
    rows = sorted(tuple(r) for r in spark.read.parquet(out + "_lines").collect())
    assert rows == [("n (MD).txt", 1, "alpha"), ("n (MD).txt", 2, "beta")]
