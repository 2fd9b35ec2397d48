"""Reading order, labels, panels and splits."""

import numpy as np

from quire.functions import geometry
from quire.operators import layout

TWO = "R0 220 15 400 40; L1 10 100 180 130; R1 220 105 400 135; L0 10 10 180 40; L2 10 200 180 230; R2 220 205 400 235; L3 10 300 180 330; R3 220 305 400 335"


def blocks(spark, text):
    rows = [(1, i, n, *map(float, b)) for i, (n, *b) in enumerate(x.split() for x in text.split("; "))]
    return spark.createDataFrame(rows, "page int, `order` int, id string, x1 double, y1 double, x2 double, y2 double")


def test_reading_order(spark):
    out = layout.reading_order(blocks(spark, TWO), ["page"]).orderBy("order").collect()
    assert [r.id for r in out] == ["L0", "L1", "L2", "L3", "R0", "R1", "R2", "R3"] and {r.reading_order for r in out} == {"column_major"}
    out = layout.reading_order(blocks(spark, "a 10 200 400 240; b 10 20 400 60; c 10 100 400 140"), ["page"]).orderBy("order").collect()
    assert [r.id for r in out] == ["b", "c", "a"] and {r.reading_order for r in out} == {"row_major"}


def test_labels_and_routes(spark):
    df = spark.createDataFrame([("Section-Header",), (None,), ("plain text",)], "label string")
    assert [tuple(r) for r in df.select(*[layout.block_type("label", d) for d in layout.LABELS]).collect()] == [("title", "title", "other"), ("other", "other", "other"), ("other", "text", "text")]
    kinds = spark.createDataFrame([(k,) for k in ("formula", "text", "table", "figure", "other")], "block_type string")
    assert [(r.route, r.skipped, r.skip_reason) for r in layout.route(kinds).collect()] == [("math", False, None), ("text", False, None), ("table", False, None), ("figure", True, "skip_figures"), ("none", True, None)]


def page(w, h, boxes):
    out = np.full((h, w), 255)
    for x1, y1, x2, y2 in boxes:
        out[y1 : y2 + 1, x1 : x2 + 1] = 0
    return out


def test_panel_classes():
    kind, sure, _ = geometry.classify(page(200, 200, [(10, 10, 85, 190), (115, 10, 190, 190)]))
    assert kind == "2_lr" and sure >= 0.75
    assert geometry.classify(page(200, 200, [(40, 10, 160, 190)]))[0] != "2_lr"
    kind, sure, _ = geometry.classify(page(200, 200, [(10, 10, 84, 84), (115, 10, 189, 84), (10, 115, 84, 189), (115, 115, 189, 189)]))
    assert kind == "4_2x2" and sure >= 0.75


def test_panels(spark):
    pixels = page(200, 200, [(10, 10, 85, 190), (115, 10, 190, 190)]).ravel().tolist()
    df = spark.createDataFrame([(1, 200, 200, pixels)], "page int, width int, height int, pixels array<int>")
    r = layout.decide_panels(df).first()
    assert not r.fallback and [p.version_id for p in r.panels] == ["v0", "v1"]
    assert layout.decide_panels(df, enabled=False).first().fallback
    assert layout.decide_panels(df, threshold=1.1).first().panels == []


def test_merge_panels(spark):
    schema = "page int, version_id string, `order` int, bbox struct<x1:double,y1:double,x2:double,y2:double>, panel struct<x1:double,y1:double,x2:double,y2:double>, page_width double, page_height double"
    box = (10.0, 10.0, 30.0, 30.0)
    df = spark.createDataFrame([(1, "v1", 0, box, (0.5, 0.0, 1.0, 1.0), 200.0, 100.0), (1, "v0", 0, box, (0.0, 0.0, 0.5, 1.0), 200.0, 100.0)], schema)
    out = layout.merge_panels(df, ["page"]).orderBy("order").collect()
    assert [(r.block_id, r.bbox.x1, r.order) for r in out] == [("p001_v0_b000", 10.0, 0), ("p001_v1_b000", 110.0, 1)]


def test_boxes(spark):
    from pyspark.sql import functions as F

    b = geometry.box(*[F.lit(float(x)) for x in (-5, 3.7, 500, 3.9)])
    r = spark.range(1).select(geometry.whole(geometry.clamp(b, F.lit(100), F.lit(50))).alias("w"), geometry.crop_box(b, F.lit(100), F.lit(50)).alias("c"), geometry.pixel_budget(F.lit(200), F.lit(100), 5000).alias("p")).first()
    assert tuple(r.w) == (0, 3, 100, 4) and tuple(r.c) == (0, 1, 100, 6) and tuple(r.p) == (100, 50)
    names = spark.createDataFrame([("a/page_012.png",), ("x.png",)], "n string")
    assert [r[0] for r in names.select(layout.page_number("n")).collect()] == [12, 0]


def test_detections_and_fallback(spark):
    found = spark.createDataFrame([(1, 0, "text", [0.0, 0.0, 1.0]), (1, 1, "title", [0.0, 0.0, 1.0, 1.0])], "page int, index int, label string, bbox array<double>")
    assert layout.detections(found, "mineru", ["page"]).first().block_id == "p001_b000" and layout.detections(found, "surya", ["page"]).first().block_id == "p001_b001"
    pages = spark.createDataFrame([(1, 10, 20), (2, 10, 20)], "page int, width int, height int")
    assert [r.page for r in layout.whole_page_blocks(pages, found, ["page"]).collect()] == [2]
