"""From blocks to a page's draft, from drafts to segments, and back to text."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import latex, pages
from ..functions.text import col, document_body, parse_polish, strip, strip_model_junk, truthy, wrap_document
from ..session import spread

ROWS, SIGNS = 4096, 1 << 20  # segments and their signs in a batch, beyond those of its last draft


def glue(parts: Column | str) -> Column:
    """An array of fragments as one text: fragments of one option joined, others parted by blank lines."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(pages.glue, na_action="ignore")

    return run(col(parts))


def version_marks(blocks: DataFrame, keys: list[str], order: str = "order", text: str = "raw_text", version: str = "version_id") -> DataFrame:
    """Blocks with text, and a mark for those whose version isn't the last one's."""
    rows = blocks.where(strip(F.coalesce(F.col(text), F.lit(""))) != "").withColumn(text, strip(text))
    named = F.when(F.col(version) != "", F.col(version))
    before = F.last(named, ignorenulls=True).over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("mark", F.when(named.isNotNull() & ~named.eqNullSafe(before), F.format_string("<<<nup:%s>>>", named)))


def stitch(blocks: DataFrame, keys: list[str], order: str = "order", text: str = "raw_text", version: str = "version_id") -> DataFrame:
    """(keys, draft): a page's blocks in order, with version marks, glued."""
    marked = version_marks(blocks, keys, order, text, version)
    found = marked.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col(order), F.array_compact(F.array("mark", text)).alias("parts")))).alias("x"))
    return found.select(*keys, glue(F.flatten(F.transform("x", lambda x: x["parts"]))).alias("draft"))


def document_draft(drafts: DataFrame, keys: list[str], page: str = "page_index", text: str = "draft") -> DataFrame:
    """(keys, draft): page drafts of a document by blank lines, blank ones too."""
    found = drafts.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(page, F.coalesce(F.col(text), F.lit("")).alias("t")))).alias("x"))
    return found.select(*keys, F.array_join(F.transform("x", lambda x: x["t"]), "\n\n").alias("draft"))


def segment(drafts: DataFrame, keys: list[str], page: str = "page_index", text: str = "draft") -> DataFrame:
    """(keys, page, pos, kind, text, source_block_id, version_id): segments of page drafts."""
    shape = drafts.select(*keys, page).schema.simpleString()[7:-1] + ",pos int,kind string,text string,version_id string"

    out = drafts.select(*keys, page, text).mapInArrow(segment_batches, shape)
    return out.withColumn("source_block_id", F.format_string("p%d_stitched", F.col(page).cast("long")))


def segment_batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of drafts, the last column, behind the other columns. A batch of drafts becomes batches of a bounded size."""
    for b in parts:
        *named, drafts = b.columns
        at, pos, said, size = [], [], [], 0

        def out() -> pa.RecordBatch:
            kinds, texts, versions = zip(*said, strict=True)  # noqa: B023
            there = pa.array(at, pa.int64())  # noqa: B023
            made = [pa.array(pos, pa.int32()), *(pa.array(x, pa.string()) for x in (kinds, texts, versions))]  # noqa: B023
            return pa.RecordBatch.from_arrays([*(c.take(there) for c in named), *made], [*b.schema.names[:-1], "pos", "kind", "text", "version_id"])  # noqa: B023

        for i, draft in enumerate(drafts):
            found = pages.page_segments(draft.as_py() or "")
            at += [i] * len(found)
            pos += range(len(found))
            said += found
            size += sum(len(s[1]) for s in found)
            if len(said) >= ROWS or size >= SIGNS:
                yield out()
                at, pos, said, size = [], [], [], 0
        if said:
            yield out()


def linear_lines(c: Column | str) -> Column:
    @F.pandas_udf("array<string>")
    def run(s: pd.Series) -> pd.Series:
        return s.fillna("").map(pages.linear_lines)

    return run(col(c))


def merge_options(segments: Column | str) -> Column:
    """An array of (kind, text, …) with the pieces of answer options joined."""

    @F.pandas_udf("array<struct<kind:string,text:string,version_id:string>>")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: [dict(zip(("kind", "text", "version_id"), t, strict=True)) for t in pages.merge_options((y["kind"], y["text"], y["version_id"]) for y in x)])

    return run(F.transform(col(segments), lambda x: F.struct(x["kind"].alias("kind"), x["text"].alias("text"), x["version_id"].alias("version_id"))))


def check_segments(segments: DataFrame) -> DataFrame:
    """Segments with integrity and, for formulas, the repaired text and warnings."""
    math = F.col("kind") == "math"
    checked = segments.withColumn("check", F.when(math, latex.integrity("text")))
    return checked.withColumn("text", F.coalesce("check.body", "text")).withColumn("integrity", F.coalesce("check.status", F.lit("ok"))).withColumn("warnings", F.coalesce("check.warnings", F.array().cast("array<string>"))).drop("check")


def rendered(kind: Column | str = "kind", text: Column | str = "text") -> Column:
    """A segment's line; null for a formula of nothing."""
    body = strip(F.regexp_replace(F.regexp_replace(strip(text), r"\\\$", "\ue000"), r"\$", ""))
    body = F.replace(body, F.lit("\ue000"), F.lit("\\$"))
    k = col(kind)
    return F.when(k == "math", F.when(body != "", F.concat(F.lit("$"), body, F.lit("$")))).when(k == "mark_note", F.concat(F.lit("(分註: "), col(text), F.lit(")"))).when(k == "figure", F.concat(F.lit("(圖: "), col(text), F.lit(")"))).otherwise(col(text))


def render_pages(segments: DataFrame, keys: list[str], page: str = "page_index", pos: str = "pos") -> DataFrame:
    """(keys, page, text): a page's segments, a line each."""
    found = segments.withColumn("line", rendered()).groupBy(*keys, page).agg(F.array_sort(F.collect_list(F.struct(F.col(pos), F.col("line")))).alias("x"))
    return found.select(*keys, page, F.array_join(F.array_compact(F.transform("x", lambda x: x["line"])), "\n").alias("text"))


def render_documents(segments: DataFrame, keys: list[str], page: str = "page_index", pos: str = "pos") -> DataFrame:
    """(keys, text): pages that aren't blank, parted by blank lines."""
    found = render_pages(segments, keys, page, pos).where(strip("text") != "").groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(page, "text"))).alias("x"))
    return found.select(*keys, F.array_join(F.transform("x", lambda x: x["text"]), "\n\n").alias("text"))


def append_figures(segments: DataFrame, figures: DataFrame, blocks: DataFrame, keys: list[str]) -> DataFrame:
    """Segments with each page's figures behind them. A figure's page is its block's (of equal ids the last
    block's), or the number that its id begins with."""
    page_of = blocks.groupBy(*keys, "block_id").agg(F.max_by("page", "order").alias("block_page"))
    placed = figures.withColumnRenamed("source_block_id", "block_id").join(page_of, [*keys, "block_id"], "left")
    number = F.regexp_extract("block_id", r"^p(\d+)_", 1).try_cast("int")
    placed = placed.withColumn("page_index", F.coalesce("block_page", number)).withColumnRenamed("block_id", "source_block_id")
    last = segments.groupBy(*keys, "page_index").agg(F.max("pos").alias("last"))
    order = F.row_number().over(Window.partitionBy(*keys, "page_index").orderBy("figure_no"))
    placed = placed.join(last, [*keys, "page_index"], "left").withColumn("pos", (F.coalesce("last", F.lit(-1)) + order).cast("int")).withColumn("kind", F.lit("figure"))
    return segments.unionByName(placed.select(*[c for c in segments.columns if c in placed.columns]), allowMissingColumns=True)


def page_ir(segments: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, page_ir): each document's pages and segments as one JSON text."""
    fields = [F.coalesce(F.col(c), F.lit(d)).alias(c) if d is not None else F.col(c) for c, d in (("kind", None), ("text", None), ("source_block_id", None), ("integrity", "ok"), ("version_id", None)) if c in segments.columns]
    by_page = segments.groupBy(*keys, "page_index").agg(F.array_sort(F.collect_list(F.struct("pos", F.struct(*fields).alias("s")))).alias("x"))
    by_page = by_page.select(*keys, F.struct("page_index", F.transform("x", lambda x: x["s"]).alias("segments")).alias("p"))
    return by_page.groupBy(*keys).agg(F.to_json(F.struct(F.array_sort(F.collect_list("p"), lambda a, b: a["page_index"].cast("int") - b["page_index"].cast("int")).alias("pages"))).alias("page_ir"))


def polish(drafts: DataFrame, keys: list[str], model: Callable[[str], str], text: str = "draft") -> DataFrame:
    """(keys, draft): each stretch between version marks through a model, marks put back in their places."""
    said = stretches(drafts, keys, text).withColumn("said", F.when(F.col("mark"), F.col("piece")).otherwise(latex.text_udf(model)("piece")))
    found = said.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("pos", strip("said").alias("t")))).alias("x"))
    return found.select(*keys, F.array_join(F.transform("x", lambda x: x["t"]), "\n\n").alias("draft"))


def stretches(drafts: DataFrame, keys: list[str], text: str = "draft") -> DataFrame:
    """(keys, pos, piece, mark): a draft's version marks and what stands between them, blank stretches left out."""
    cut = r"(<<<nup:[\w\-]+>>>)"
    pieces = drafts.select(*keys, F.posexplode(F.split(F.regexp_replace(text, cut, "\ue003$1\ue003"), "\ue003")).alias("pos", "piece")).where(strip("piece") != "")
    return pieces.withColumn("mark", F.col("piece").rlike(rf"\A{cut}\z"))


def polish_documents(drafts: DataFrame, keys: list[str], model: Callable[[str], str], text: str = "draft") -> DataFrame:
    """(keys, txt, tex, warnings): drafts through a model whose replies hold a text and a LaTeX document. Each stretch between
    version marks is a call of its own, marks stay in their places, and the bodies of all make one document. A reply
    that can't be read leaves its draft, with a warning; so does a document cut short."""
    said = stretches(spread(drafts, *keys), keys, text).withColumn("piece", strip("piece")).withColumn("reply", latex.text_udf(model)(F.when(~F.col("mark"), F.col("piece"))))
    p = said.withColumn("p", F.when(~F.col("mark"), parse_polish("reply", "piece")))
    p = p.withColumn("txt", F.when(F.col("mark"), F.col("piece")).otherwise(strip_model_junk("p.txt"))).withColumn("tex", latex.sanitize_tex("p.tex"))
    short = F.contains("tex", F.lit("\\documentclass")) & ~F.contains("tex", F.lit("\\end{document}"))
    p = p.withColumn("warnings", F.array_compact(F.array(F.col("p.warning"), F.when(short, "polish truncated; draft kept"))))
    p = p.withColumn("body", F.when(F.col("mark"), F.col("piece")).otherwise(F.coalesce(truthy(document_body("tex")), strip("txt"))))
    # The whole documents are read once more, so these are dealt to all tasks too, not by their bytes.
    p = spread(p.select(*keys, "pos", "mark", strip("txt").alias("txt"), "tex", "body", "warnings"), *keys)
    found = p.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("pos", "mark", "txt", "tex", "body", "warnings"))).alias("x"))
    join = lambda c: F.array_join(F.transform("x", lambda y: y[c]), "\n\n")
    alone = ~F.exists("x", lambda y: y["mark"])
    whole = F.when(alone, F.get("x", F.lit(0))["tex"]).otherwise(latex.sanitize_tex(wrap_document(join("body"))))
    return found.select(*keys, join("txt").alias("txt"), whole.alias("tex"), F.flatten(F.transform("x", lambda y: y["warnings"])).alias("warnings"))
