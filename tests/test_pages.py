"""Page drafts, segments, gluing and rendering."""

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quire.functions import pages
from quire.operators import segments

CASES = [
    ("以下是將圖片轉換為文字的結果：\n設 x 為得分。\n$x=60$\n(分註: 1M+1A)", [("math", "x=60")], ["將圖片"]),
    ("\\frac{a}{b}=1", [("math", "\\frac{a}{b}=1")], []),
    ("| 步驟 | 分 |\n| --- | --- |\n| 設 $x=1$<br>所以 $y=2$ | 1M |", [("math", "x=1"), ("math", "y=2"), ("mark_note", "1M")], ["|", "<br", "---"]),
    ("\\begin{itemize}\n\\item 1M\n\\end{itemize}\n\\begin{align*}\n&4a + 5b - 7 = 8b \\\\\n&b = \\frac{4a-7}{3}\n\\end{align*}", [("mark_note", "1M"), ("math", "4a + 5b - 7 = 8b"), ("math", "b = \\frac{4a-7}{3}")], ["\\item", "align"]),
    ("$\\begin{tabular}{c}\\hline $x=300$ & 1M \\\\\\hline\\end{tabular}$", [("math", "x=300"), ("mark_note", "1M")], ["tabular", "hline"]),
    ("$=250(1+20\\%)=\\$300$", [("math", "=250(1+20\\%)=\\$300")], []),
    ("$x=1$\n$\\frac{-}{-}$", [("math", "x=1")], ["frac"]),
    ("$\\frac{正方形性質}{-}$\n$\\frac{-}{-}$\n$x=1$\n", [("math", "x=1")], ["\\frac"]),
    ("```markdown\n解\n$$\\frac{a}{b}=1$\n$x=2$$\n```\n", [("prose", "解"), ("math", "\\frac{a}{b}=1"), ("math", "x=2")], ["```", "$$", "markdown"]),
    ("$\\begin{table}[h]$\n$\\begin{tabular}{|c|c|c|}$$\\hline$$解 & 分 & 備註 \\$$\\hline$6. (a) 該書的售價 &$x=300$& 1M\\\\$$\\hline$$\\end{tabular}$\n$\\end{table}$", [("math", "x=300"), ("mark_note", "1M"), ("prose", "解")], ["tabular", "hline", "table"]),
    ("\\[ x \\le 2 \\] 和 \\(y_1\\)", [("math", "x \\le 2"), ("math", "y_1"), ("prose", "和")], ["\\[", "\\("]),
    ("$\\text{甲}+\\text{，}\\caption{t}$", [("prose", "甲"), ("prose", "+")], ["text", "caption"]),
    ("正文\n\\end{document}\n更多", [("prose", "正文"), ("prose", "更多")], ["document"]),
]


@pytest.mark.parametrize("draft,wanted,never", CASES)
def test_segments(draft, wanted, never):
    got = [(k, t) for k, t, _ in pages.page_segments(draft)]
    for w in wanted:
        assert w in got, got
    for n in never:
        assert not any(n in t for _, t in got), got


def test_cjk_after_math():
    got = [(k, t) for k, t, _ in pages.page_segments("$\\triangle BGE$是一直角三角形。$")]
    assert got[0] == ("math", "\\triangle BGE") and got[1][0] == "prose" and not any("$" in t for _, t in got)


def test_versions_and_options():
    got = pages.page_segments("<<<nup:v0>>>\nQ16 left stem\n<<<nup:v1>>>\nQ19 right stem")
    assert got == [("prose", "Q16 left stem", "v0"), ("prose", "Q19 right stem", "v1")]
    assert [t for _, t, _ in pages.page_segments("A.\n-1\n。\nB.\n2\n。")] == ["A. -1。", "B. 2。"]


def test_glue_on_columns(spark):
    rows = [(1, ["A.", "-1", "。", "B.", "2", "。"]), (2, []), (3, ["12.", "x"]), (4, ["Long text here", "another text"])]
    df = spark.createDataFrame(rows, "id int, parts array<string>")
    got = {r[0]: r[1] for r in df.select("id", segments.glue("parts")).collect()}
    assert got == {1: "A. -1。\n\nB. 2。", 2: "", 3: "12.\n\nx", 4: "Long text here\n\nanother text"}


@given(st.lists(st.sampled_from(["A.", "b)", "-1", "。", "12.", "text", "a longer text of words", "x", "2", ", ,", "C. open"]), min_size=1, max_size=8))
def test_glue_rule_is_total(parts):
    out = [parts[0]]
    for p in parts[1:]:
        assert pages.glued(out[-1], p) in (True, False)


@given(st.text(alphabet="ab$\\{}&|x=1M。中 \n^_frac<br>", max_size=60))
def test_no_dollar_in_prose(draft):
    for kind, text, _ in pages.page_segments(draft):
        assert text.strip() and kind in ("prose", "math", "mark_note")


def test_render_and_page_ir(spark):
    df = spark.createDataFrame([("d", 0, "以下\n$x=1$\n1M"), ("d", 1, ""), ("e", 0, "\\feac{1}{6}=x")], "doc string, page_index int, draft string")
    found = segments.check_segments(segments.segment(df, ["doc"]))
    assert {(r.doc, r.kind, r.integrity, r.text) for r in found.collect()} == {("d", "prose", "ok", "以下"), ("d", "math", "ok", "x=1"), ("d", "mark_note", "ok", "1M"), ("e", "math", "repaired", "\\frac{1}{6}=x")}
    assert {r.doc: r.text for r in segments.render_documents(found, ["doc"]).collect()} == {"d": "以下\n$x=1$\n(分註: 1M)", "e": "$\\frac{1}{6}=x$"}
    ir = segments.page_ir(found, ["doc"]).where("doc = 'd'").select(F.get_json_object("page_ir", "$.pages[0].segments[1].text")).first()[0]
    assert ir == "x=1"


def test_polish_keeps_marks(spark):
    df = spark.createDataFrame([(1, "<<<nup:v0>>>\n\nleft\n\n<<<nup:v1>>>\n\nright")], "id int, draft string")
    assert segments.polish(df, ["id"], str.upper).first().draft == "<<<nup:v0>>>\n\nLEFT\n\n<<<nup:v1>>>\n\nRIGHT"


def test_stitch(spark):
    rows = [(1, 0, "A.", "v0"), (1, 1, "-4", "v0"), (1, 2, "。", "v0"), (1, 3, "  ", "v1"), (1, 4, "A longer stem, too long to go on with an option before it", "v1")]
    df = spark.createDataFrame(rows, "page int, `order` int, raw_text string, version_id string")
    assert segments.stitch(df, ["page"]).first().draft == "<<<nup:v0>>>\n\nA. -4。 <<<nup:v1>>>\n\nA longer stem, too long to go on with an option before it"  # marks take part in gluing


@given(st.lists(st.sampled_from(["A.", "b)", "-1", "。", "12.", "text", "a longer text of words", "x", "2", ", ,", "C. open", " ", ""]), max_size=10))
def test_glue_joins_by_the_rule(parts):
    out = []
    for p in (x.strip() for x in parts):
        if out and not p:
            continue
        if out and pages.glued(out[-1], p):
            out[-1] = out[-1].rstrip() + ("" if pages.punctuation_alone(p) else " ") + p
        else:
            out.append(p)
    assert pages.glue(parts) == "\n\n".join(x.strip() for x in out)


def test_document_segments(spark, tmp_path):
    """The query over whole texts against the page functions, text by text."""
    from collections import Counter

    from quire.plans import registry

    texts = [c[0] for c in CASES] + ["a$$$ b&&& c,*** d\\\\ e", "", None]
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.page_index, r.kind, r.version_id): (r.n, r.chars) for r in registry.QUERIES["document_segments"](spark, str(tmp_path)).where("integrity = 'ok'").collect()}
    n, chars = Counter(), Counter()
    for i, t in enumerate(texts):
        draft = f"<<<nup:v{i % 2}>>>\n{t}\n$x_{i}={i % 7}$\n{i % 3 + 1}M+1A" if t is not None else ""
        for kind, text, version in pages.page_segments(draft):
            n[i % 5, kind, version] += 1
            chars[i % 5, kind, version] += len(text)
    assert got == {k: (n[k], chars[k]) for k in n}


def test_polished_documents(spark):
    df = spark.createDataFrame([(1, "<<<nup:v0>>>\n\nleft\n\n<<<nup:v1>>>\n\nright"), (2, "alone"), (3, "cut")], "id int, draft string")
    model = lambda p: "nothing" if p == "left" else f"<<<TXT>>>\n{p}!<|x|>\n<<<TEX>>>\n\\documentclass{{a}}\\begin{{document}}{p} a/b" + ("" if p == "cut" else "\\end{document}")
    got = {r.id: r for r in segments.polish_documents(df, ["id"], model).collect()}
    assert got[1].txt == "<<<nup:v0>>>\n\nleft\n\n<<<nup:v1>>>\n\nright!" and got[1].warnings == ["polish parse fail; draft wrapped"]
    assert "<<<nup:v1>>>\n\nright a/b" in got[1].tex and got[1].tex.count("documentclass") == 1
    assert got[2].tex == "\\documentclass{a}\\begin{document}alone a/b\\end{document}" and got[3].warnings == ["polish truncated; draft kept"]
