"""Whole runs with stand-ins for models."""

import json

from quire.operators import seams
from quire.plans import pipeline
from tests.test_dataset import GOOD, chat, row


def test_documents(spark):
    blocks = spark.createDataFrame([("d", 1, 0, 0.0, 50.0, 10.0, 60.0, "$x=1分$", None), ("d", 1, 1, 0.0, 0.0, 10.0, 9.0, "A title of words", None)], "doc string, page int, `order` int, x1 double, y1 double, x2 double, y2 double, raw_text string, version_id string")
    drafts = pipeline.arrange(blocks, ["doc"]).withColumnRenamed("page", "page_index")
    assert drafts.first().draft == "A title of words\n\n$x=1分$"
    figures = spark.createDataFrame([("d", "p001_b009", 1, "a curve")], "doc string, source_block_id string, figure_no int, text string")
    page = spark.createDataFrame([("d", "p009_b000", 9, 0)], "doc string, block_id string, page int, `order` int")
    out = pipeline.documents(drafts, ["doc"], figures=figures, blocks=page)
    file = out["files"].first()
    assert file.text.startswith("A title of words\n") and file.text.endswith("(圖: a curve)") and "\\begin{document}" in file.tex
    assert [s["kind"] for s in json.loads(file.page_ir)["pages"][0]["segments"]][-1] == "figure"
    assert out["warnings"].count() <= 1


def test_from_images(spark):
    pages = spark.createDataFrame([("d", 1, bytearray(b"x"))], "doc string, page int, content binary")
    find = lambda: lambda data: [("formula", 0.0, 0.0, 9.0, 9.0, 1.0)]
    out = pipeline.from_images(pages, ["doc"], find, {"math": lambda: lambda data: "\\feac{1}{2}=y"}, seams.Settings())
    assert [(r.kind, r.integrity, r.text) for r in out["segments"].collect()] == [("math", "repaired", "\\frac{1}{2}=y")]


def test_curate(spark):
    out = pipeline.curate(chat(spark, [row(1), row(2, status="rejected"), row(3, answer="")]))
    assert (out["train"].count(), out["rejected"].count(), out["remain"].count(), out["merged"].count()) == (1, 1, 1, 1)


def test_ingest(spark):
    manifests = spark.createDataFrame([(json.dumps(GOOD),)], "manifest string")
    disk = spark.createDataFrame([("job-1", "d.txt", "0" * 64)], "job_id string, path string, sha256 string")
    irs = spark.createDataFrame([], "doc_id string, pages array<struct<page_index:int,segments:array<struct<kind:string,text:string,crop_relpath:string>>>>")
    texts = spark.createDataFrame([("d", "all of it"), ("other", "no job")], "doc_id string, text string")
    model = lambda t: [[1.0, 2.0]] * len(t)
    empty = pipeline.vectors.points(pipeline.vectors.embed(pipeline.vectors.ingest_segments(irs, texts.limit(0)), model, 2), "j")
    once = pipeline.ingest(manifests, disk, irs, texts, empty, model, 2)
    assert [(r.doc_id, r.segment_id, r.job_id) for r in once.collect()] == [("d", "p0_all", "job-1")]
    assert pipeline.ingest(manifests, disk, irs, texts, once, model, 2, again=True).count() == 1


def test_compile(tmp_path):
    assert not pipeline.usable_tex(str(tmp_path / "a.tex"))
    (tmp_path / "a.tex").write_text("x")
    assert pipeline.usable_tex(str(tmp_path / "a.tex")) and pipeline.compile_tex(str(tmp_path / "a.tex"))[0] != 0
