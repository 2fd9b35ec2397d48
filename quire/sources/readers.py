"""Sources: files as tables, with a position column where order counts."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import strip
from ..operators.layout import page_number, reading_order
from ..schemas import CHAT, LAYOUT, MANIFEST, NUP, PAGE_IR

IMAGES = "*.{png,jpg,jpeg,webp,PNG,JPG,JPEG,WEBP}"


def images(spark: SparkSession, folder: str) -> DataFrame:
    """(path, page, content) of a folder's images, the page being the first number in the name. An empty folder is
    an error."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", IMAGES).load(folder)
    if found.isEmpty():
        raise FileNotFoundError(f"no images in {folder}")
    return found.select("path", page_number("path").alias("page"), "content")


def pdf_pages(spark: SparkSession, files: str, render: Callable[[bytes, int], list[bytes]], dpi: int = 200, limit: int = 0) -> DataFrame:
    """(path, page, content): pages of PDF files, rendered by a function that callers give, 1 the first."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in parts:
            for path, data in zip(df["path"], df["content"], strict=True):
                pages = render(data, dpi)[: limit or None]
                yield pd.DataFrame({"path": [path] * len(pages), "page": range(1, len(pages) + 1), "content": pages})

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(files).select("path", "content").mapInPandas(run, "path string, page int, content binary")


def cached_pages(spark: SparkSession, folder: str, make: Callable[[], DataFrame], overwrite: bool = False) -> DataFrame:
    """The page images of a folder if there are any, else those that make gives."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/page_*.png")
    there = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return images(spark, folder) if there and not overwrite else make()


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, line) with 1-based numbers, LF or CRLF ending lines. Files are read in splits: tasks number
    the lines of their split, and what splits before it in the file hold is added."""
    lines = spark.read.text(path, lineSep="\n").select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("seq"), F.regexp_replace("value", r"\r\z", "").alias("line"))
    blocks = lines.groupBy("file", "at").agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("first"))
    # One row for each split of each file, each file's on their own.
    before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = blocks.select("file", "at", "first", before.alias("before"))
    return lines.join(blocks, ["file", "at"]).select("file", (F.col("seq") - F.col("first") + F.col("before") + 1).cast("int").alias("line_no"), "line")


def json_lines(spark: SparkSession, path: str, schema: str = CHAT, strict: bool = False) -> DataFrame:
    """Rows of JSON lines, blank ones left out. A line that is no JSON is an error; strict: with its file and number."""
    if not strict:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    lines = numbered_lines(spark, path).where(strip("line") != "")
    bad = F.raise_error(F.concat("file", F.lit(":"), F.col("line_no").cast("string"), F.lit(": no JSON")))
    checked = F.when(F.try_parse_json("line").isNull(), bad.cast("string")).otherwise(F.col("line"))
    return lines.select("file", "line_no", F.from_json(checked, schema).alias("r")).select("file", "line_no", "r.*")


def layout(spark: SparkSession, path: str) -> DataFrame:
    """Blocks of layout files in reading order, with their page's image; version 1 and a page at least."""
    docs = spark.read.option("multiLine", True).schema(LAYOUT).json(path)
    fail = F.when((F.col("version") != 1) | F.coalesce(F.size("pages") < 1, F.lit(True)), F.raise_error(F.lit("a layout file has version 1 and a page at least")).cast("boolean")).otherwise(True)
    blocks = docs.where(fail).select("source", F.explode("pages").alias("p")).select("source", "p.page", "p.image_path", F.posexplode("p.blocks").alias("pos", "b"))
    flat = blocks.select("source", "page", "image_path", "b.block_id", "b.block_type", F.col("b.bbox")[0].alias("x1"), F.col("b.bbox")[1].alias("y1"), F.col("b.bbox")[2].alias("x2"), F.col("b.bbox")[3].alias("y2"), F.coalesce("b.order", "pos").alias("order"), "b.crop_path", F.coalesce("b.raw_text", F.lit("")).alias("raw_text"), F.coalesce("b.latex", F.lit("")).alias("latex"), "b.meta")
    return reading_order(flat, ["source", "page"])


def panels(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).schema(NUP).json(path)


def page_irs(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, pages) of page files named after their documents."""
    read = spark.read.option("multiLine", True).schema(PAGE_IR).json(path)
    return read.select(F.regexp_extract(F.input_file_name(), r"([^/]+)\.pageir\.json$", 1).alias("doc_id"), "pages")


def manifests(spark: SparkSession, path: str) -> DataFrame:
    """(file, manifest, fields) with the text as it is, for checks of unknown fields."""
    raw = spark.read.text(path, wholetext=True)
    return raw.select(F.input_file_name().alias("file"), F.col("value").alias("manifest"), F.from_json("value", MANIFEST).alias("fields"))


def files_with_hash(spark: SparkSession, folder: str) -> DataFrame:
    """(path, sha256) of all files under a folder."""
    read = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return read.select("path", F.sha2("content", 256).alias("sha256"))


def document_ids(spark: SparkSession, flag: str = "", path: str | None = None) -> DataFrame:
    """(doc_id) of a list with commas and of a file's lines, without blanks and comments; repeated ones stay."""
    ids = spark.range(1).select(F.explode(F.split(F.lit(flag), ",")).alias("doc_id"))
    if path:
        ids = ids.union(spark.read.text(path).select("value"))
    return ids.select(strip("doc_id").alias("doc_id")).where("doc_id <> '' and not startswith(doc_id, '#')")


def config(path: str | None) -> dict:
    """Settings of a YAML file, none without one. Reads what settings need: nested keys with scalar values."""
    if not path or not Path(path).exists():
        return {}
    out: dict = {}
    stack = [(-1, out)]
    for line in Path(path).read_text(encoding="utf-8").splitlines():
        bare = line.split(" #", 1)[0].rstrip()
        if not bare.strip() or bare.lstrip().startswith("#") or ":" not in bare:
            continue
        depth = len(bare) - len(bare.lstrip())
        key, _, value = bare.strip().partition(":")
        while stack[-1][0] >= depth:
            stack.pop()
        if value.strip():
            stack[-1][1][key] = scalar(value.strip())
        else:
            stack[-1][1][key] = {}
            stack.append((depth, stack[-1][1][key]))
    return out


def scalar(text: str) -> object:
    if text[:1] in "\"'" and text[-1:] == text[:1]:
        return text[1:-1]
    if text.lower() in ("true", "false"):
        return text.lower() == "true"
    for kind in (int, float):
        try:
            return kind(text)
        except ValueError:
            pass
    return None if text in ("null", "~") else text
