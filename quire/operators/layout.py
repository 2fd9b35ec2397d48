"""Layout blocks: labels, routes, reading order and pages of several panels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry
from ..functions.text import col

# detectors' labels and the types they stand for; any other is "other".
LABELS = {
    "surya": {
        "text": "text",
        "sectionheader": "title",
        "title": "title",
        "listgroup": "list",
        "list": "list",
        "equation": "equation",
        "formula": "formula",
        "table": "table",
        "figure": "figure",
        "picture": "figure",
        "caption": "text",
        "footnote": "text",
        "pageheader": "other",
        "pagefooter": "other",
        "code": "text",
        "form": "other",
        "tableofcontents": "other",
        "chemicalblock": "other",
        "diagram": "figure",
        "bibliography": "text",
        "blankpage": "other",
    },
    "doclayout": {
        "formula": "formula",
        "isolateformula": "formula",
        "equation": "equation",
        "inlineformula": "equation",
        "title": "title",
        "sectionheader": "title",
        "table": "table",
        "plaintext": "text",
        "text": "text",
    },
    "mineru": {
        "text": "text",
        "plain_text": "text",
        "paragraph_title": "title",
        "doc_title": "title",
        "title": "title",
        "table": "table",
        "table_caption": "other",
        "inline_formula": "equation",
        "display_formula": "formula",
        "formula": "formula",
        "equation": "equation",
        "image": "figure",
        "figure": "figure",
        "picture": "figure",
        "chart": "figure",
        "diagram": "figure",
        "figure_caption": "other",
        "image_caption": "other",
        "chart_caption": "other",
    },
}
ROUTES = {"formula": "math", "equation": "math", "text": "text", "title": "text", "list": "text", "table": "table", "figure": "figure"}

# Fixed values of the two-column gate.
LEAST_BLOCKS, LEAST_SIDE, GAP, NARROW, CENTRES = 8, 3, 0.03, 0.45, 0.25


def lookup(key: Column, pairs: dict[str, str], default: str) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv]), key), F.lit(default))


def block_type(label: Column | str, detector: str) -> Column:
    """The common type of a detector's label."""
    low = F.lower(F.coalesce(col(label), F.lit("")))
    key = F.replace(low, F.lit(" "), F.lit("_")) if detector == "mineru" else F.regexp_replace(low, "[^a-z]", "")
    return lookup(key, LABELS[detector], "other")


def detections(found: DataFrame, detector: str, keys: list[str], index: str = "index") -> DataFrame:
    """Detections as blocks with ids. One detector numbers what it keeps, the others number what they saw. A predicted
    position, if there is one, is the order; ids go by the number all the same."""
    kept = found.where(F.size("bbox") == 4)
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(index)) - 1 if detector != "surya" else F.col(index).cast("int")
    kept = kept.withColumn("order", number).withColumn("block_id", F.format_string("p%03d_b%03d", F.col("page").cast("long"), F.col("order").cast("long"))).withColumn("block_type", block_type("label", detector))
    return kept.withColumn("order", F.coalesce(F.col("position").cast("int"), "order")).drop("position") if "position" in found.columns else kept


def merge_order(blocks: DataFrame, predicted: DataFrame, keys: list[str], index: str = "index") -> DataFrame:
    """Blocks with the order that a second model predicted for the block of that index on their page, where it did.
    predicted: (keys, index, position)."""
    told = predicted.groupBy(*keys, index).agg(F.min("position").alias("_position"))
    return blocks.join(told, [*keys, index], "left").withColumn("order", F.coalesce(F.col("_position").cast("int"), F.col("order"))).drop("_position")


def whole_page_blocks(pages: DataFrame, blocks: DataFrame, keys: list[str]) -> DataFrame:
    """A block of the whole page for each page without any."""
    bare = pages.join(blocks.select(*keys).distinct(), keys, "left_anti")
    return bare.select(*keys, F.lit("b000").alias("block_id"), F.lit("text").alias("block_type"), F.lit("FullPageFallback").alias("label"), geometry.box(F.lit(0.0), F.lit(0.0), F.col("width").cast("double"), F.col("height").cast("double")).alias("bbox"))


def route(blocks: DataFrame, kind: str = "block_type") -> DataFrame:
    """Blocks with the engine that reads them, and what is skipped and why."""
    to = lookup(F.col(kind), ROUTES, "none")
    skip = to.isin("figure", "none")
    return blocks.withColumn("route", to).withColumn("skipped", skip).withColumn("skip_reason", F.when(to == "figure", "skip_figures"))


def reading_order(blocks: DataFrame, keys: list[str], index: str = "order") -> DataFrame:
    """Blocks with order and reading_order: two columns one after the other where the page has two."""
    page = Window.partitionBy(*keys)
    x1, x2 = F.col("x1"), F.col("x2")
    left, right = F.min("x1").over(page), F.max("x2").over(page)
    rows = blocks.withColumn("_width", right - left).withColumn("_mid", left + (right - left) / 2)
    rows = rows.withColumn("_centre", (x1 + x2) / 2).withColumn("_narrow", x2 - x1 < NARROW * F.col("_width"))
    rows = rows.withColumn("_n", F.count(F.lit(1)).over(page)).withColumn("_few", F.count_if("_narrow").over(page) < LEAST_BLOCKS)
    counts = F.col("_few") | F.col("_narrow")
    on_left, on_right = counts & (F.col("_centre") < F.col("_mid")), counts & (F.col("_centre") >= F.col("_mid"))
    of = lambda f, side, c: f(F.when(side, c)).over(page)
    one = F.lit(1)
    gate = (F.col("_n") >= LEAST_BLOCKS) & (F.col("_width") > 1) & (of(F.count, on_left, one) >= LEAST_SIDE) & (of(F.count, on_right, one) >= LEAST_SIDE)
    gate &= (of(F.min, on_right, x1) - of(F.max, on_left, x2) >= GAP * F.col("_width")) & (of(F.avg, on_right, F.col("_centre")) - of(F.avg, on_left, F.col("_centre")) >= CENTRES * F.col("_width"))
    rows = rows.withColumn("_two", F.coalesce(gate, F.lit(False)))
    side = F.when(F.col("_two") & (F.col("_centre") >= F.col("_mid")), 1).otherwise(0)
    number = F.row_number().over(page.orderBy(side, "y1", "x1", index)) - 1
    out = rows.withColumn("_order", number).withColumn("reading_order", F.when(F.col("_two"), "column_major").otherwise("row_major"))
    return out.withColumn(index, F.col("_order")).drop("_width", "_mid", "_centre", "_narrow", "_n", "_few", "_two", "_order")


def page_number(name: Column | str, count: Column | None = None) -> Column:
    """The first number in a file's stem; else 0, or a count that callers give."""
    stem = F.regexp_replace(F.regexp_replace(col(name), r"\A.*/", ""), r"(?<=.)\.[^.]*\z", "")
    return F.coalesce(F.regexp_extract(stem, r"(\d+)", 1).try_cast("int"), F.lit(0) if count is None else count)


def match_images(pages: DataFrame, images: DataFrame) -> DataFrame:
    """Pages with the image of their image's file name, where there is one; of equal names the last path counts."""
    name = lambda c: F.substring_index(c, "/", -1)
    known = images.groupBy(name("path").alias("_name")).agg(F.max("path").alias("_found"))
    return pages.withColumn("_name", name("image_path")).join(known, "_name", "left").withColumn("image_path", F.coalesce("_found", "image_path")).drop("_name", "_found")


def decide_panels(pages: DataFrame, threshold: float = 0.75, enabled: bool = True) -> DataFrame:
    """Pages with class, confidence, split, fallback and panels. pages: with width, height and gray pixels."""
    if not enabled:
        return pages.withColumn("class", F.lit("one")).withColumn("confidence", F.lit(1.0)).withColumn("split", F.lit(0.5)).withColumn("fallback", F.lit(True)).withColumn("panels", F.array().cast(geometry.two_type()))
    told = pages.withColumn("_c", geometry.page_class("pixels", "width", "height")).select("*", "_c.*").drop("_c")
    back = F.col("class").isin("one", "uncertain") | (F.col("confidence") < threshold)
    return told.withColumn("fallback", back).withColumn("panels", F.when(back, F.array().cast(geometry.two_type())).otherwise(geometry.panel_boxes("class", F.lit(0.0), F.col("split"))))


def merge_panels(blocks: DataFrame, keys: list[str], version: str = "version_id", order: str = "order", last: list[str] | None = None) -> DataFrame:
    """Blocks of panels as blocks of their page: boxes moved, panels one after the other, ids anew.
    blocks: with bbox, panel (its box in shares), page_width, page_height, version and order; equal orders go by the columns
    ``last``, or else by all that can be ordered. Each block has one number in its panel; its page's is that and the
    number of blocks in the panels before."""
    ties = last or [f"`{c}`" for c, t in blocks.dtypes if not t.startswith(("map", "variant")) and c not in (*keys, version, order)]
    own = F.row_number().over(Window.partitionBy(*keys, version).orderBy(order, *ties)) - 1
    moved = blocks.withColumn("bbox", geometry.remap(F.col("bbox"), F.col("panel"), F.col("page_width"), F.col("page_height"))).withColumn("_own", own)
    # Blocks of panels before a block's: all up to its panel's last, less its panel's own.
    panel = Window.partitionBy(*keys, version)
    upto = F.count(F.lit(1)).over(Window.partitionBy(*keys).orderBy(version).rangeBetween(Window.unboundedPreceding, Window.currentRow))
    number = upto - F.count(F.lit(1)).over(panel) + F.col("_own")
    named = F.format_string("p%03d_%s_b%03d", F.col("page").cast("long"), F.col(version), F.col("_own").cast("long"))
    return moved.withColumn("_order", number).withColumn(order, F.col("_order")).withColumn("block_id", named).drop("_order", "_own")


def label_panels(panels: DataFrame, drafts: DataFrame, keys: tuple[str, ...] = ("page", "version_id")) -> DataFrame:
    """Panels with the language that their draft seems to have; drafts: (page, version_id, draft). Keys that one
    side doesn't have don't count."""
    from ..functions.text import guess_language

    on = [k for k in keys if k in panels.columns and k in drafts.columns]
    return panels.join(drafts.select(*on, "draft"), on, "left").withColumn("semantic", guess_language(F.coalesce("draft", F.lit("")))).drop("draft")
