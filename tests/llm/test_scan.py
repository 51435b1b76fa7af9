import random
import re
import zlib

import numpy as np
import pytest

from ferret.llm import decontaminate, html_extract, licenses, packing, quality_rules, queries
from ferret.llm.common import table
from tests.conftest import SF_MID
from tests.llm.conftest import words


def test_alignment_by_full_table():
    rnd = random.Random(5)
    for _ in range(60):
        a = np.array([rnd.randrange(6) for _ in range(rnd.randrange(1, 12))], np.uint64)
        b = np.array([rnd.randrange(6) for _ in range(rnd.randrange(0, 20))], np.uint64)
        h = np.zeros((len(a) + 1, len(b) + 1))
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                h[i, j] = max(0, h[i - 1, j - 1] + (1 if a[i - 1] == b[j - 1] else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
        score, start, end = decontaminate.align(a, b)
        assert score == h.max() and 0 <= start <= end <= len(b)


def _leaky(spark):
    rnd = random.Random(1)
    items = [(k, " ".join(f"q{rnd.randrange(400)}" for _ in range(rnd.randrange(15, 60)))) for k in range(30)]
    rows, want = [], set()
    for i in range(120):
        w = [f"q{rnd.randrange(4000)}" for _ in range(rnd.randrange(20, 200))]
        if i % 2:
            k, t = rnd.choice(items)
            copy = [x if rnd.random() > 0.15 else rnd.choice(["", f"z{rnd.randrange(99)}", x + f" y{rnd.randrange(99)}"])
                    for x in t.split()]
            at = rnd.randrange(len(w) + 1)
            w[at:at] = copy
            want.add((i, k))
        rows.append((i, " ".join(w).upper() if i % 4 == 1 else ", ".join(w)))
    return (spark.createDataFrame(rows, "doc_id long, text string"),
            spark.createDataFrame(items, "item_id long, text string"), want)


def test_edited_copies_are_found(spark):
    docs, items, want = _leaky(spark)
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, items).collect()}
    assert len(got & want) >= 0.98 * len(want) and not got - want


def test_item_blocks_give_the_same(spark, monkeypatch):
    docs, items, _ = _leaky(spark)
    once = sorted(map(tuple, decontaminate.leaks(docs, items).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 500)
    assert sorted(map(tuple, decontaminate.leaks(docs, items).collect())) == once


@pytest.mark.parametrize("copies", [10, 11, 1000])
def test_shortened_copies_are_found_however_many(spark, copies):
    item = [f"q{i}" for i in range(40)]
    rows = [(i, " ".join([f"a{i}"] * 5 + item[:28] + [f"b{i}"] * 5)) for i in range(copies)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    got = [tuple(r) for r in decontaminate.leaks(docs, items).collect()]
    assert sorted(got) == [(i, 1, 28, 0.7, 5, 33) for i in range(copies)]


def test_exact_passages_on_the_table(spark):
    items = {r.item_id: re.findall(r"\w+", r.text.lower()) for r in table(spark, SF_MID, "benchmark").collect()}
    want = set()
    for r in table(spark, SF_MID, "documents").collect():
        t = " ".join(["", *re.findall(r"\w+", r.text.lower()), ""])
        want |= {(r.doc_id, k) for k, w in items.items() if f" {' '.join(w)} " in t}
    got = {(r.doc_id, r.item_id) for r in queries.op1_decontamination(spark, SF_MID).collect()}
    assert want and want <= got and len(got) <= len(want) * 1.1 + 2


def test_license_notices_on_the_table(spark):
    rows = queries.op3_license_scan(spark, SF_MID).collect()
    lines = [(r.doc_id, k + 1) for r in table(spark, SF_MID, "documents").collect()
             for k, x in enumerate(r.text.split("\n")) if "icense" in x]
    assert sorted((r.doc_id, r.line) for r in rows) == sorted(lines) and lines


@pytest.mark.parametrize("text, want", [
    ("Licensed under the Apache License, Version 2.0.", "Apache-2.0 short"),
    ("Some words. This work is licensed under the GNU General Public License, version 3.", "GPL-3.0 short"),
    ("This work is licensed under the GNU Lesser General Public License, version 3.", "LGPL-3.0 short"),
    ("Licensed under CC BY-SA 4.0.", "CC-BY-SA-4.0"),
    (licenses.TEMPLATES["MIT"].replace(", to any person", ",\nto any person"), "MIT"),
    (licenses.TEMPLATES["ISC"], "ISC"),
    ("Licensed under the Apache License, Version 1.1.", None),
    ("The driving license was lost near the public domain.", None),
])
def test_license_wording(text, want):
    got = licenses.Scanner(licenses.TEMPLATES).scan("First line.\n" + text)
    assert [g[0] for g in got] == ([want] if want else [])


@pytest.mark.parametrize("text, want", [
    ("The dataset, the scripts and the trained model weights described in this report are all released under the MIT License.",
     [("MIT short", 1)]),
    ("Released under the\nMIT License.", [("MIT short", 1)]),
    ("To the extent possible under law, the\nauthor has waived all copyright\nand related or neighboring rights to this work.",
     [("CC0-1.0", 1)]),
    ("word " * 200 + "licensed under CC BY 4.0", [("CC-BY-4.0", 1)]),
])
def test_license_late_or_wrapped(text, want):
    assert [g[:2] for g in licenses.Scanner(licenses.TEMPLATES).scan(text)] == want


def test_license_every_notice_of_a_line():
    text = "Released under the MIT License. Licensed under CC BY 4.0. Licensed under CC BY 4.0. No license. " \
           "Licensed under the BSD 3-Clause License."
    got = licenses.Scanner(licenses.TEMPLATES).scan(text)
    assert [g[0] for g in got] == ["MIT short", "CC-BY-4.0", "CC-BY-4.0", "BSD-3-Clause short"]
    assert [text[g[-2]:g[-1]] + "." for g in got] == [licenses.TEMPLATES[g[0]] for g in got]


PAGE = """<html><head><title>T</title><script>if (a<b) "</p>"</script><style>p{}</style></head><body>
<header><h2>Site name</h2></header><nav><ul><li><a href=x>Home</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
%s<aside>See also</aside><form>Mail <input name=a></form><div id="comments"><p>Nice post</p></div><footer>&copy; us</footer></body></html>"""


def test_html_with_and_without_article():
    body = "<h1>Tit&amp;le</h1><p>One <b>bo</b>ld&nbsp;word &lt;x&gt;<br>two<p>Three<div class='ad'>Buy!</div><p>four</p>"
    want = "Tit&le One bold word <x> two Three four"
    assert html_extract.main_text(PAGE % f"<article>{body}</article>") == want
    long = "<p>" + "plain words of the story go on and on " * 4 + "</p>"
    text = html_extract.main_text(PAGE % f"<div><h1>Head of it</h1>{long}<p>short</p>{long}</div>")
    assert text.startswith("Head of it plain words") and "short" in text and "cookies" not in text and "Nice" not in text
    for page in (None, "", "<", "<p", "<!-- open", "no markup", "<script>x"):
        html_extract.main_text(page)


def test_html_keeps_all_runs_and_text_under_odd_classes():
    long, links = "<p>" + "plain words of the story go on and on " * 4 + "</p>", "<p><a href=x>See this</a></p>" * 5
    text = html_extract.main_text(f"<h1>Title</h1><p>By me</p><p>Lead</p><p>More</p><p>So</p>{long}{links}<p>Second part.</p>{long}")
    assert text.startswith("Title By me Lead More So plain") and "Second part. plain" in text
    for page in (f"<div class='content has-sidebar'>{long}</div>",
                 f"<main><article class='post hentry tag-python'>{long}</article></main>",
                 f"<div class='site sidebar'>{long}<div class='sidebar'>Aside</div></div>"):
        assert html_extract.main_text(page) == ("plain words of the story go on and on " * 4).strip()


def test_pages_query(spark):
    import html as H
    rows = {r.page_id: r for r in queries.op5_html_extraction(spark, SF_MID).collect()}
    for p in table(spark, SF_MID, "pages").collect():
        inner = re.search(r"<article>(.*?)(?:</article>|$)", p.html, re.S)[1]
        want = " ".join(H.unescape(re.sub(r"<(?:/?p|/?h1|br)>", " ", inner).replace("<b>", "")).split())
        assert rows[p.page_id].text == want and rows[p.page_id].n_chars == len(want)


def _check_packing(rows, capacity=2048):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        end = 0
        for at, n in sorted(places):
            assert at == end
            end += n
        assert end <= capacity
    return len(by), -(-sum(r.length for r in rows) // capacity)


def test_packing_query(spark):
    import public_tokenizers as P
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    rows = queries.op8_best_fit_packing(spark, SF_MID).collect()
    got = {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows}
    want = {}
    for d in table(spark, SF_MID, "documents").collect():
        ids = np.array(tok.encode(d.text, add_special_tokens=False).ids + [0], "<u4")
        want.update({(d.doc_id, k // 2048): (k, len(ids[k:k + 2048]), zlib.crc32(ids[k:k + 2048].tobytes()))
                     for k in range(0, len(ids), 2048)})
    assert got == want and len(rows) == len(got)
    used, bound = _check_packing(rows)
    assert used <= 1.03 * bound + 1


@pytest.mark.parametrize("sizes", [[1] * 500, [1024] * 41, [1025] * 9 + [1023] * 9, [700] * 30 + [5] * 300, [2047], []])
def test_packing_ties(spark, sizes, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 40)
    items = spark.createDataFrame(list(enumerate(sizes)), "uid long, length long")
    rows = packing.pack(items).join(items, "uid").collect()
    assert len(rows) == len(sizes)
    if sizes:
        used, bound = _check_packing(rows)
        assert used <= max(bound + 1, sum(s > 1024 for s in sizes), -(-sum(s > 682 for s in sizes) // 2))


def test_packing_with_hundreds_of_hot_sizes(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 2)
    items = spark.createDataFrame([(5 * s + k, s) for s in range(1, 1001) for k in range(5)], "uid long, length long")
    rows = packing.pack(items).join(items, "uid").collect()
    used, bound = _check_packing(rows)
    assert len({r.uid for r in rows}) == len(rows) == 5000 and used <= 1.03 * bound + 1


def test_scans_odd_rows(spark, odd, empty):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "a b"), (None, "x y z"), (4, " ".join(f"alpha{i}" for i in range(30))),
                                   (4, " ".join(f"alpha{i}" for i in range(30)))], "item_id long, text string")
    found = decontaminate.leaks(odd, items).collect()
    assert {r.doc_id for r in found} == {1, 2, 7, None} and {r.item_id for r in found} == {4}
    assert decontaminate.leaks(empty, items).collect() == [] and decontaminate.leaks(odd, items.where("false")).collect() == []
    assert len(licenses.licenses(odd).collect()) == odd.count() and licenses.licenses(empty).collect() == []
    judged = {r.doc_id: r for r in quality_rules.judged(odd).collect()}
    assert judged[3].n_words == 0 and not judged[3].kept and judged[1].n_words == 70 and judged[1].kept
    assert judged[11].n_repeat_words == 60 and judged[11].base_failed and judged[6].n_words == 60_000
    assert quality_rules.judged(odd).where("kept").count() == sum(r.kept for r in quality_rules.judged(odd).collect())
    assert quality_rules.judged(empty).collect() == []
    rows = packing.pack_documents(odd).collect()
    _check_packing(rows)
    assert sum(r.length == 1 for r in rows) >= 4 and packing.pack_documents(empty).collect() == []
    pages = spark.createDataFrame([(1, None, None), (None, "u", "<p>x"), (1, None, None)], "page_id long, url string, html string")
    assert sorted(r.n_chars for r in html_extract.extracted(pages).collect()) == [0, 0, 1]
    assert html_extract.extracted(pages.where("false")).collect() == []


def test_rule_order_does_not_change_verdicts(spark):
    docs = table(spark, SF_MID, "documents")
    one = sorted(map(tuple, quality_rules.judged(docs).collect()))
    back = dict(reversed(list(quality_rules.rules().items())))
    assert sorted(map(tuple, quality_rules.judged(docs, back).collect())) == one
    assert all(len(words(r.text)) for r in docs.limit(5).collect())


def _encoded(texts, **options):
    import pyarrow as pa
    from ferret.llm.common import texts_of
    words = packing._Words(None, 0, **options)
    out = []
    for i in range(0, len(texts), 500):
        part = texts[i:i + 500]
        ids, first = words.encode(*texts_of(pa.array(part, pa.string())))
        out += [ids[a:z].tolist() for a, z in zip(first[:-1], first[1:])]
    return out


def _plain(texts):
    import public_tokenizers
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return [[*tok.encode(t or "", add_special_tokens=False).ids, 0] for t in texts]


def test_ids_of_every_letter_before_a_mark():
    letters = [chr(c) for c in range(0x80, 0x20000) if chr(c).isalpha()]
    every = letters[::37] + [c for c in letters if c.lower() != c and len(c.lower()) > 1] + [
        chr(c) for c in (0x130, *range(0x958, 0x960), 0x9DC, 0x9DD, 0x9DF, 0xFB1D, 0xFB2A, 0x1E9E, 0x3A3, 0x345, 0x2126, 0x212A)]
    texts = [f"{c}{m} x{c}{m}\ty{c}" for c in every for m in ".,"]
    assert _encoded(texts) == _plain(texts)


def test_ids_of_special_tokens_and_mixed_scripts():
    import random
    rnd = random.Random(9)
    parts = ["<|endoftext|>", "<|startoftext|>", "ALİ", "KALDİ", "बड़", "हड़", "don't", "'re", "É", "é", "ß", "ﬁ", "Ω", "한국", "가",
             "日本", "12", "٣", "_", "<|", "|>", "...", ",", ".", "!?", " ", " ", "\x1c", "\x85", "🙂", "a", "The", "‍", "İ", "x" * 40]
    texts = ["a <|endoftext|> b", "x<|startoftext|>y", "<|ENDOFTEXT|>.", "ALİ. KALDİ, बड़, हड़.", None, "", " \n", " "]
    texts += ["".join(rnd.choice(parts) + rnd.choice(["", "", " ", "\n", ".", ","]) for _ in range(rnd.randrange(1, 30))) for _ in range(1500)]
    want = _plain(texts)
    assert _encoded(texts) == want
    assert _encoded(texts, memo=50, places=8) == want  # words displaced and forgotten
