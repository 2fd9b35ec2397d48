"""Chat rows, subparts, manifests, points, runs, files and streams."""

import json
import uuid

import pytest

from quire.operators import dataset, manifest, runs, seams, vectors
from quire.schemas import CHAT
from quire.sources import readers, sinks
from quire.streaming import jobs


def row(i, status="approved", user="What is the answer here?", answer="It is 4.", lang=None, qid="7", page=1, **more):
    messages = [{"role": "system", "content": "s"}, {"role": "user", "content": user}, {"role": "assistant", "content": answer}]
    return {"row_no": i, "id": f"r{i}", "status": status, "language": lang, "notes": None, "has_figure": False, "figure_description": None, "source": {"pdf": "e.pdf", "page": page, "question_id": qid, "image": "", "lang": None}, "messages": messages} | more


def chat(spark, rows):
    return spark.createDataFrame(rows, f"row_no long, {CHAT}")


def test_promotion(spark):
    df = chat(spark, [row(1), row(2, answer="[待補解答]"), row(3, answer=" "), row(4, status="rejected"), row(5, status="extract_failed"), row(6, status=None), row(7, messages=[{"role": "user", "content": "x"}]), row(8, lang="en")])
    got = {r.row_no: r.disposition for r in dataset.disposition(df).collect()}
    assert got == {1: "promoted", 2: "remain", 3: "remain", 4: "rejected", 5: "remain", 6: "remain", 7: "remain", 8: "promoted"}
    train = dataset.promote(df)["train"].collect()
    assert sorted(r.messages[0].content == dataset.SYSTEM for r in train) == [False, True]
    assert {(r.bucket, r.n, r.open) for r in dataset.status_counts(df).collect()} == {("approved", 5, 3), ("extract_failed", 1, 0), ("pending", 2, 0)}
    errors = {(r.row_no, r.error) for r in dataset.all_errors(df).collect()}
    assert (7, "#7: 需要 messages 陣列，且至少含 user + assistant") in errors and (3, "#3 message[2]: content 不可為空") in errors


def test_split_eval(spark):
    df = spark.range(995).withColumnRenamed("id", "k")
    out = dataset.split_eval(df, "k")
    assert out.where("is_eval").count() == 99 and out.count() == 995
    assert dataset.split_eval(spark.range(3).toDF("k"), "k").where("is_eval").count() == 1


def test_question_ids(spark):
    ids = ["4(a)", "4（A）", "(c)", "7", "x9", "", None]
    df = spark.createDataFrame([(i, q) for i, q in enumerate(ids)], "i int, q string")
    assert [tuple(r.p) for r in df.select("i", dataset.parse_question_id("q").alias("p")).orderBy("i").collect()] == [("4", "a"), ("4", "a"), (None, "c"), ("7", None), ("x9", None), (None, None), (None, None)]


def test_merge_subparts(spark):
    rows = [row(1, user="first", qid="4(a)"), row(2, user="second", qid="(b)", figure_description="f", has_figure=True), row(3, user="third", qid="4(c)", figure_description="f"), row(4, qid="5"), row(5, qid="(a)", page=2), row(6, qid="")]
    out = dataset.merge_subparts(chat(spark, rows)).orderBy("row_no").collect()
    assert [(r.row_no, r.merged) for r in out] == [(1, 3), (4, 1), (5, 1), (6, 1)]
    question = next(m.content for m in out[0].messages if m.role == "user")
    assert (out[0].id, question, out[0].figure_description, out[0].notes, out[0].has_figure) == ("e_p001_q4", "(a) first\n\n(b) second\n\n(c) third", "f", "merged 3 subparts", True)
    assert out[0].source.question_id == "4" and out[0].status is not None and out[1].source.question_id == "5"
    # A row without an id parts what stands before it from what follows.
    rows = [row(1, user="first", qid="4(a)", page=1234), row(2, qid="", page=1234), row(3, qid="(b)", page=1234), row(4, qid="(c)", page=1234), row(5, qid="5", page=1234), row(6, qid="(a)", page=1234)]
    out = dataset.merge_subparts(chat(spark, rows)).orderBy("row_no").collect()
    assert [(r.row_no, r.merged) for r in out] == [(1, 1), (2, 1), (3, 1), (4, 1), (5, 2)] and out[4].id == "e_p1234_q5"


def test_question_blocks(spark):
    df = chat(spark, [row(1, user="\\(x\\) is what?", has_figure=True, figure_description="fig"), row(2, user="short"), row(3, user="")])
    out = dataset.question_blocks(df).collect()
    assert len(out) == 1 and out[0].block == "% id=r1  page=1  exam_q=7  has_figure=True\n題目：\n$x$ is what?\n\n[圖] fig\n"
    assert dataset.question_blocks(df, True).count() == 2
    whole = [r.content for r in sinks.question_document(dataset.question_blocks(df)).orderBy("part", "at").collect()]
    assert whole[0] == "% questions: 1\n" and whole[-1] == "% END" and len(whole) == 3


GOOD = {"done_schema": 1, "job_id": "job-1", "doc_id": "d", "created_at": "t", "source_pdf": "a.pdf", "artifacts": [{"path": "d.txt", "sha256": "0" * 64}], "ocr_pipeline_version": "1"}
BAD = [({"x": 1}, "unknown fields: x"), ({"done_schema": 2}, "done_schema must be 1"), ({"job_id": "!"}, "bad job_id"), ({"doc_id": "e" * 129}, "bad doc_id"), ({"created_at": " "}, "bad created_at"), ({"source_pdf": "a/b"}, "source_pdf must be a basename"), ({"artifacts": []}, "artifacts must be a non-empty list"), ({"artifacts": [{"path": "../d.txt", "sha256": "0" * 64}]}, "unsafe artifact path"), ({"artifacts": GOOD["artifacts"] * 2}, "duplicate artifact path"), ({"artifacts": [{"path": "d.txt", "sha256": "Z"}]}, "bad sha256"), ({"artifacts": [{"path": "e.txt", "sha256": "0" * 64}]}, "missing text artifact")]


def test_manifest(spark):
    df = spark.createDataFrame([(i, json.dumps(GOOD | x)) for i, (x, _) in enumerate([({}, ""), *BAD])], "i int, manifest string")
    got = {r.i: r.e for r in df.select("i", manifest.errors("manifest").alias("e")).collect()}
    assert got[0] == []
    for i, (_, said) in enumerate(BAD, 1):
        assert said in got[i], (i, got[i])
    one = df.where("i = 0")
    same = spark.createDataFrame([("job-1", "d.txt", "0" * 64)], "job_id string, path string, sha256 string")
    assert manifest.valid(one, same).count() == 1
    assert manifest.valid(one, same.union(spark.createDataFrame([("job-1", "figures/f.png", "1" * 64)]))).count() == 0
    assert manifest.against_disk(manifest.artifacts(one), same.where("false")).first().problem == "missing"


def test_points(spark):
    df = spark.createDataFrame([("d", 3, "p3_s1")], "doc_id string, page int, segment_id string")
    key = f"d|3|p3_s1|{vectors.MODEL}|{vectors.VERSION}"
    assert df.select(vectors.point_id("doc_id", "page", "segment_id")).first()[0] == str(uuid.uuid5(uuid.UUID(vectors.NAMESPACE), key))
    h = spark.createDataFrame([("Ａ① \r\nb",), ("A1\nb",)], "t string").select(vectors.content_hash("t")).distinct().count()
    assert h == 1
    irs = spark.createDataFrame([("a", [(0, [("prose", " x ", None), ("math", "", None), ("figure", "f", "c.png")])])], "doc_id string, pages array<struct<page_index:int,segments:array<struct<kind:string,text:string,crop_relpath:string>>>>")
    texts = spark.createDataFrame([("a", "t"), ("b", "whole")], "doc_id string, text string")
    rows = vectors.ingest_segments(irs, texts)
    assert {(r.segment_id, r.text, r.crop_path) for r in rows.collect()} == {("p0_s0", "x", None), ("p0_s2", "f", "c.png"), ("p0_all", "whole", None)}
    points = vectors.points(vectors.embed(rows, lambda t: [[float(len(x))] * 4 for x in t], 4), "j")
    once = vectors.upsert(points.limit(0), points)
    assert once.count() == vectors.upsert(once, points).count() == vectors.reindex(once, points).count() == 3
    with pytest.raises(Exception, match="components"):
        vectors.embed(rows, lambda t: [[1.0]] * len(t), 4).collect()


def test_runs(spark):
    def step(doc):
        if doc == "bad":
            raise SystemExit(3)

    out = runs.run_batch(spark, ["bad", "good"], [("stage", lambda d: None), ("publish", step)])
    assert [(r.doc_id, r.stage, r.ok) for r in out.collect()] == [("bad", "publish", False), ("good", "publish", True)] and runs.exit_code(out) == 1
    assert runs.run_batch(spark, ["bad", "good"], [("publish", step)], True).count() == 1
    assert runs.warning_line(["a" * 100, "b" * 100, "c" * 100]) == f"{'a' * 100}; {'b' * 100}; +1 more" and runs.warning_line([]) is None
    with pytest.raises(ValueError):
        runs.preflight(False, True, True, "k")


def test_seams(spark):
    with pytest.raises(seams.EngineError):
        seams.Settings(layout="other")
    assert seams.Settings.of({"ocr": {"layout": "surya"}}).layout == "surya"
    assert seams.pick_stop_ids([], 5) == [5] and seams.flatten_lines([{"rec_texts": ["a"]}, ("b", 0.9)]) == ["a", "b"]
    pages = spark.createDataFrame([("d", 1, bytearray(b"x"))], "doc string, page int, content binary")
    find = lambda: lambda data: [("text", 0.0, 50.0, 9.0, 60.0, 1.0), ("title", 0.0, 0.0, 9.0, 9.0, 1.0), ("figure", 0.0, 99.0, 9.0, 109.0, 1.0)]
    out = seams.drafts_of(pages, ["doc", "page"], find, {"text": lambda: lambda data: "Some longer words"}, seams.Settings())
    assert out.first().draft == "Some longer words\n\nSome longer words"
    figures = spark.createDataFrame([(1, bytearray(b"a")), (2, bytearray(b""))], "i int, crop binary")
    assert [(r.caption, r.error) for r in seams.caption_figures(figures, lambda: lambda d: bytes(d).decode()).orderBy("i").collect()] == [("a", None), (None, "empty caption")]


def test_files_and_stream(spark, tmp_path):
    out = tmp_path / "out"
    out.mkdir()
    (out / "d.txt").write_text("text")
    staged = sinks.stage_job("d", str(out), str(tmp_path / "stage"))
    job = sinks.publish("d", str(staged), str(tmp_path), "job-1", "2026-01-01", "1")
    with pytest.raises(FileExistsError):
        sinks.publish("d", str(staged), str(tmp_path), "job-1", "2026-01-01", "1")
    m = readers.manifests(spark, str(job / "DONE.json"))
    assert m.select(manifest.errors("manifest").alias("e")).first().e == []
    seen = []
    q = jobs.ingest(jobs.arriving(spark, str(tmp_path / "jobs")), lambda df, _: seen.extend(r.manifest for r in df.collect()), str(tmp_path / "check"))
    q.awaitTermination(60)
    assert len(seen) == 1
    (tmp_path / "r.jsonl").write_text('{"id": "a"}\n\n{"id": "b"}\n')
    assert readers.json_lines(spark, str(tmp_path / "r.jsonl"), strict=True).count() == 2
    (tmp_path / "bad.jsonl").write_text('{"id": "a"}\n{oops\n')
    with pytest.raises(Exception, match=":2: no JSON"):
        readers.json_lines(spark, str(tmp_path / "bad.jsonl"), strict=True).collect()
    (tmp_path / "c.yaml").write_text("a:\n  b: 1 # note\n  c: \"x\"\nd: true\n")
    assert readers.config(str(tmp_path / "c.yaml")) == {"a": {"b": 1, "c": "x"}, "d": True} and readers.config(None) == {}
    (tmp_path / "page_002.png").write_bytes(b"x")
    assert [r.page for r in readers.images(spark, str(tmp_path)).collect()] == [2]
    rows = spark.createDataFrame([("a/b.txt", "x")], "name string, content string")
    assert sinks.write_files(rows, str(tmp_path / "w")).first().size == 1 and (tmp_path / "w/a/b.txt").read_text() == "x"
    (tmp_path / "ids.txt").write_text("# no\n x \n\ny\n")
    assert sorted(r[0] for r in readers.document_ids(spark, "x, z", str(tmp_path / "ids.txt")).collect()) == ["x", "x", "y", "z"]
    pdf = tmp_path / "a.pdf"
    pdf.write_bytes(b"123")
    assert readers.pdf_pages(spark, str(tmp_path), lambda data, dpi: [bytes([c]) for c in data], limit=2).count() == 2


def test_layout_file(spark, tmp_path):
    block = {"block_id": "p001_b000", "block_type": "text", "bbox": [0, 50, 10, 60], "order": 0}
    (tmp_path / "layout.json").write_text(json.dumps({"version": 1, "source": "s", "pages": [{"page": 1, "image_path": "p.png", "blocks": [block, block | {"block_id": "p001_b001", "bbox": [0, 0, 10, 10], "order": 1}]}]}))
    rows = readers.layout(spark, str(tmp_path / "layout.json")).orderBy("order").collect()
    assert [r.block_id for r in rows] == ["p001_b001", "p001_b000"]
    back = json.loads(sinks.layout_json(readers.layout(spark, str(tmp_path / "layout.json")), ["source"]).first().layout)
    assert back["version"] == 1 and len(back["pages"][0]["blocks"]) == 2
    (tmp_path / "old.json").write_text(json.dumps({"version": 2, "source": "s", "pages": []}))
    with pytest.raises(Exception, match="version 1"):
        readers.layout(spark, str(tmp_path / "old.json")).collect()


def test_registry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0 and set(e.oracle_sql()) <= set(e.queries())


def test_manifest_paths_and_schema(spark):
    import copy

    def wrong(change):
        m = copy.deepcopy(GOOD)
        m.update(change)
        return spark.createDataFrame([(json.dumps(m),)], "manifest string").select(manifest.errors("manifest").alias("e")).first().e

    item = lambda path: {"artifacts": [GOOD["artifacts"][0], {"path": path, "sha256": "0" * 64}]}
    assert wrong(item("\\etc")) == ["unsafe artifact path"] and wrong(item("a\\b")) == [] and wrong({}) == []
    assert wrong({"done_schema": "1"}) == ["done_schema must be 1"] and wrong({"done_schema": None}) == ["done_schema must be 1"]


def test_lines_that_are_no_json(spark, tmp_path):
    (tmp_path / "bad.jsonl").write_text('{"id": "a"}\n{oops\n')
    with pytest.raises(Exception, match="(?i)malformed|reading file"):
        readers.json_lines(spark, str(tmp_path / "bad.jsonl")).collect()


def test_numbered_lines_over_splits(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"".join(b"line %d\r\n" % i if i % 3 else b"\n" for i in range(1, 5001)))
    (tmp_path / "b.txt").write_text("one")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = readers.numbered_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    a = sorted((r.line_no, r.line) for r in rows if r.file.endswith("a.txt"))
    assert a == [(i, f"line {i}" if i % 3 else "") for i in range(1, 5001)] and [(r.line_no, r.line) for r in rows if r.file.endswith("b.txt")] == [(1, "one")]


def test_page_limit_counts_pages(spark):
    pages = spark.createDataFrame([("d", 5), ("d", 6), ("d", 7), ("e", 1)], "doc string, page int")
    assert sorted(map(tuple, seams.layout_limit(pages, 2, ["doc", "page"]).collect())) == [("d", 5), ("d", 6), ("e", 1)]
    assert seams.layout_limit(pages, 0, ["doc", "page"]).count() == 4


def test_failing_pages_and_blocks(spark):
    pages = spark.createDataFrame([("d", 1, bytearray(b"x")), ("d", 2, bytearray(b"!"))], "doc string, page int, content binary")

    def find(data):
        if bytes(data) == b"!":
            raise RuntimeError("blurred")
        return [("text", 0.0, 0.0, 9.0, 9.0, 1.0)]

    assert {(r.page, r.error) for r in seams.scan(pages, lambda: find, ["doc", "page"]).collect()} == {(1, None), (2, "RuntimeError: blurred")}
    assert [r.page for r in seams.detect(pages, lambda: find, "mineru", ["doc", "page"]).collect()] == [1]
    blocks = spark.createDataFrame([(1, "text", False, bytearray(b"a")), (2, "text", False, bytearray(b"")), (3, "math", False, bytearray(b"m")), (4, "none", True, bytearray(b"a"))], "i int, route string, skipped boolean, crop binary")

    def fails(data):
        raise OSError("no memory")

    engines = {"math": lambda: fails, "text": lambda: lambda d: bytes(d).decode()}
    got = {r.i: (r.raw_text, r.error) for r in seams.read_blocks(blocks, engines, isolate=True).collect()}
    assert got == {1: ("a", None), 2: ("", "empty text"), 3: ("", "OSError: no memory"), 4: ("", None)}
    with pytest.raises(Exception, match="no memory"):
        seams.read_blocks(blocks, engines).collect()
    with pytest.raises(Exception, match="no engine for text"):
        seams.read_blocks(blocks, {"math": engines["math"]}).collect()


def test_from_panels_to_drafts(spark):
    wide = [255] * (64 * 40)
    for y in range(40):  # two columns of ink, a gap between them
        for x in [*range(4, 28), *range(36, 60)]:
            wide[y * 64 + x] = 0
    pages = spark.createDataFrame([("d", 1, bytearray(b"p"), 64, 40, wide)], "doc string, page int, content binary, width int, height int, pixels array<int>")
    cut = lambda data, box: data + f"|{box[0]},{box[2]}".encode()
    find = lambda: lambda data: [("text", 1.0, 1.0, 9.0, 9.0, 1.0)]
    seen = {"text": lambda: lambda data: "read at " + bytes(data).decode().split("|")[-1] + " of the page"}
    out = seams.drafts_of(pages, ["doc", "page"], find, seen, seams.Settings(panels=True, panel_threshold=0.5), cut).first().draft
    assert out.count("read at") == 2 and "<<<nup:v0>>>" in out and "<<<nup:v1>>>" in out
    assert out.index("<<<nup:v0>>>") < out.index("read at 0,11") < out.index("<<<nup:v1>>>")
    plain = seams.drafts_of(pages, ["doc", "page"], find, seen, seams.Settings(), cut).first().draft
    assert plain == "read at 0,11 of the page"


def test_labels_by_page(spark):
    panels = spark.createDataFrame([(1, "v0"), (2, "v0")], "page int, version_id string")
    drafts = spark.createDataFrame([(1, "v0", "這是一段中文的文字內容"), (2, "v0", "some plain english words")], "page int, version_id string, draft string")
    from quire.operators import layout

    assert sorted((r.page, r.semantic) for r in layout.label_panels(panels, drafts).collect()) == [(1, "zh"), (2, "en")]


def test_appended_texts(spark, tmp_path):
    path = str(tmp_path / "txt")
    for texts in ([("d", 1, "one"), ("d", 2, "")], [("d", 1, "two & more"), ("e", 1, "other")]):
        sinks.append_to_text(spark, spark.createDataFrame(texts, "doc_id string, page int, text string"), path)
    got = {r.doc_id: r for r in sinks.accumulated(spark, path).collect()}
    assert got["d"].txt == "one\n\ntwo & more" and "two \\& more" in got["d"].tex and got["e"].txt == "other"
    assert sinks.append_text("a", "b") == "a\n\nb" and sinks.append_text("", "b") == "b" and sinks.append_text("a", "") == "a"
    assert sinks.output_paths("s") == ("output/s.txt", "output/s.tex") and sinks.output_paths("s", "o", "x.txt", "y/{source}.t") == ("o/s.txt", "y/s.t")
    example = spark.createDataFrame([("a",)], "id string")
    assert sinks.bootstrap(spark, example, str(tmp_path / "train")) and not sinks.bootstrap(spark, example.limit(0), str(tmp_path / "train"))
    assert spark.read.json(str(tmp_path / "train")).count() == 1
    blocks = spark.createDataFrame([(2, "second"), (1, "first\nline")], "row_no int, block string")
    sinks.write_text(sinks.question_document(blocks), str(tmp_path / "doc"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "doc").glob("part-*")))
    assert text == "% questions: 2\n\nfirst\nline\nsecond\n% END\n"
    decisions = spark.createDataFrame([(3, "one", 1.0, 0.75, True, [])], "page_index int, `class` string, confidence double, threshold double, fallback boolean, panels array<struct<version_id:string>>")
    sinks.write_panels(decisions, str(tmp_path / "nup"))
    assert json.loads(spark.read.text(str(tmp_path / "nup")).first().value)["class"] == "one"
    assert runs.success_lines("/a/d.tex", ["w", " w ", ""]) == ["TEX: /a/d.tex", "Next: edit <=10m, then latexmk -xelatex d.tex", "WARN: w"] and "Stage3" in runs.notes()["preflight"]


def test_collection(spark):
    name = "points_of_a_test"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    try:
        assert vectors.ensure_collection(spark, name) and not vectors.ensure_collection(spark, name)
        assert vectors.collection_info(spark, name) == {"dim": "768", "metric": "cosine"} and "vector" in spark.table(name).columns
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_nearest_vectors(spark, monkeypatch):
    import numpy as np

    rng = np.random.default_rng(0)
    data = rng.normal(size=(120, 5)).round(1)
    rows = [(i, v.tolist()) for i, v in enumerate(data)] + [(200, data[3].tolist()), (201, [0.0] * 5), (202, None), (203, [1.0, None, 0.0, 0.0, 0.0]), (204, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "id long, vector array<float>")
    monkeypatch.setattr(vectors, "TILE", 16)
    got = {}
    for r in vectors.top_k(df.where("id % 20 = 0"), df, 7).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.id)
    whole = {i: np.array(v, np.float32).astype(float) for i, v in rows if v and None not in v and len(v) == 5 and any(v)}
    for q in (i for i in whole if i % 20 == 0):
        score = {i: round(float(whole[q] @ v / np.sqrt((whole[q] @ whole[q]) * (v @ v))), 12) for i, v in whole.items() if i != q}
        assert got[q] == sorted(score, key=lambda i: (-score[i], i))[:7]
    assert set(got) == {i for i in whole if i % 20 == 0}
    assert vectors.top_k(df.limit(0), df.limit(0), 3).count() == 0


def test_split_scores_by_the_rule(spark):
    """Scores of places by plain sums over the window and what lies to its sides."""
    import random

    from quire.functions import geometry

    def mean(x, lo, hi):
        part = x[max(0, lo) : max(hi, lo + 1)]
        return sum(part) / len(part) if part else None

    def score(x, f):
        n = len(x)
        mid, half = round(f * (n - 1)), max(1, int(n * 0.04 / 2))
        sides = [mean(x, int((f - 0.35) * n), int((f - 0.08) * n)), mean(x, int((f + 0.08) * n), int((f + 0.35) * n))]
        if any(s is None or s < 0.008 for s in sides):
            return 0.0
        flank = sum(sides) / 2
        return min(1.0, max(0.0, abs(mean(x, mid - half, mid + half) - flank) / flank))

    rng = random.Random(4)
    cases = [[rng.random() for _ in range(n)] for n in (5, 15, 16, 40, 100, 333)] + [[0.0] * 50, [0.5] * 24 + [0.0] * 4 + [0.5] * 24]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(cases)], "i int, x array<double>")
    for r in df.select("i", "x", geometry.split_of("x").alias("s")).collect():
        best, at, f = 0.0, 0.5, 0.38
        while len(r.x) >= 16 and f <= 0.62 + 1e-9:
            if score(r.x, f) > best:
                best, at = score(r.x, f), f
            f += 0.01
        assert abs(r.s.score - best) < 1e-9 and abs(r.s.split - at) < 1e-9, r.i
