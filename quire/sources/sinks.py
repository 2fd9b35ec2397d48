"""Sinks: text and JSON files by document, staged and published jobs, tables that grow."""

from __future__ import annotations

import hashlib
import json
import re
import shutil
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import latex_document
from ..operators.manifest import NAME


def write_files(rows: DataFrame, folder: str, name: str = "name", content: str = "content") -> DataFrame:
    """(name, size): each row as a file of a folder that all executors see, written aside and renamed, so that a
    task that runs twice leaves one whole file."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in parts:
            done = []
            for n, c in zip(df["n"], df["c"], strict=True):
                path = Path(folder, n)
                path.parent.mkdir(parents=True, exist_ok=True)
                aside = path.with_name(f".{path.name}.{id(c)}")
                aside.write_bytes(bytes(c))
                aside.replace(path)
                done.append((n, len(c)))
            yield pd.DataFrame(done, columns=["name", "size"])

    binary = F.col(content) if dict(rows.dtypes)[content] == "binary" else F.encode(content, "UTF-8")
    return rows.select(F.col(name).alias("n"), binary.alias("c")).mapInPandas(run, "name string, size bigint")


def layout_json(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, layout): blocks as one JSON text a source, version 1."""
    block = F.struct("order", F.struct("block_id", "block_type", F.array("x1", "y1", "x2", "y2").alias("bbox"), "order", "raw_text").alias("b"))
    pages = blocks.groupBy(*keys, "page", "image_path").agg(F.array_sort(F.collect_list(block)).alias("x"))
    pages = pages.select(*keys, F.struct("page", F.struct("page", "image_path", F.transform("x", lambda x: x["b"]).alias("blocks")).alias("p")).alias("p"))
    found = pages.groupBy(*keys).agg(F.array_sort(F.collect_list("p"), lambda a, b: a["page"] - b["page"]).alias("p"))
    return found.select(*keys, F.to_json(F.struct(F.lit(1).alias("version"), *keys, F.transform("p", lambda p: p["p"]).alias("pages"))).alias("layout"))


def panels_json() -> Column:
    """A page's panel decision as JSON text."""
    return F.to_json(F.struct("page_index", "class", "confidence", "threshold", "fallback", "panels"))


def question_document(blocks: DataFrame, order: str = "row_no") -> DataFrame:
    """(part, at, content): a LaTeX text of all blocks as rows to write in the order of part and at: a head with their number,
    the blocks, and a mark at the end. No row holds more than one block."""
    n = blocks.agg(F.concat(F.lit("% questions: "), F.count(F.lit(1)).cast("string"), F.lit("\n")).alias("content"))
    none = F.lit(None).cast(dict(blocks.dtypes)[order])
    end = blocks.sparkSession.range(1).select(F.lit(2).alias("part"), none.alias("at"), F.lit("% END").alias("content"))
    body = blocks.select(F.lit(1).alias("part"), F.col(order).alias("at"), F.col("block").alias("content"))
    return n.select(F.lit(0).alias("part"), none.alias("at"), "content").unionByName(body).unionByName(end)


def write_text(parts: DataFrame, folder: str) -> None:
    """Rows of ``question_document`` as text files whose names sort in the order of the text."""
    parts.orderBy("part", "at").select("content").write.mode("overwrite").text(folder)


def append_to_text(spark: SparkSession, rows: DataFrame, path: str) -> None:
    """Texts (doc_id, page, text) behind those of earlier runs; rows without text leave nothing."""
    run = 0 if not folder_has(spark, path) else (spark.read.parquet(path).agg(F.max("run")).first()[0] or 0) + 1
    rows.where(F.coalesce("text", F.lit("")) != "").select("doc_id", F.lit(run).alias("run"), "page", "text").write.mode("append").parquet(path)


def accumulated(spark: SparkSession, path: str, lang: str = "zh") -> DataFrame:
    """(doc_id, txt, tex): all texts that were appended, blank lines between them, and the document rebuilt from the whole."""
    found = spark.read.parquet(path).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("run", "page", "text"))).alias("x"))
    whole = found.select("doc_id", F.array_join(F.transform("x", lambda x: x["text"]), "\n\n").alias("txt"))
    return whole.withColumn("tex", latex_document("txt", F.lit(lang), F.col("doc_id")))


def folder_has(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def output_paths(source: str, folder: str = "output", txt: str = "output/{source}.txt", tex: str = "output/{source}.tex") -> tuple[str, str]:
    """Where a document's files go: templates that name the source, else the folder with its name."""
    return tuple(t.format(source=source) if "{source}" in t else f"{folder}/{source}.{end}" for t, end in ((txt, "txt"), (tex, "tex")))


def bootstrap(spark: SparkSession, example: DataFrame, train: str) -> bool:
    """Training rows from an example, only where there are none; tells whether they were made."""
    if folder_has(spark, train):
        return False
    example.write.json(train)
    return True


def write_panels(decisions: DataFrame, folder: str) -> None:
    """Panel decisions of pages as JSON, by page."""
    decisions.select("page_index", panels_json().alias("value")).repartition("page_index").write.mode("overwrite").partitionBy("page_index").text(folder)


def append_text(old: str, new: str) -> str:
    """Texts with a blank line between them if both have something."""
    return old + ("\n\n" if old and new else "") + new


def append_rows(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


def stage_job(doc_id: str, output: str, staging: str) -> Path:
    """A document's files in a fresh folder: the text has to be there, others come along if they are."""
    source, target = Path(output), Path(staging)
    text = source / f"{doc_id}.txt"
    if not text.is_file():
        raise FileNotFoundError(text)
    shutil.rmtree(target, ignore_errors=True)
    target.mkdir(parents=True)
    for f in (text, source / f"{doc_id}.tex", source / f"{doc_id}.pageir.json"):
        if f.is_file():
            shutil.copy2(f, target / f.name)
    for f in sorted((source / doc_id / "figures").glob("*.png")):
        (target / "figures").mkdir(exist_ok=True)
        shutil.copy2(f, target / "figures" / f.name)
    return target


def sha256(path: Path) -> str:
    with path.open("rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def publish(doc_id: str, source: str, share: str, job_id: str, created_at: str, version: str, source_pdf: str | None = None) -> Path:
    """A staged folder as a job: copied aside, hashed twice, named by a manifest and moved in one step."""
    if not re.fullmatch(NAME, job_id):
        raise ValueError(f"bad job id {job_id}")
    final, aside = Path(share, "jobs", job_id), Path(share, "jobs", ".incoming", job_id)
    if final.exists():
        raise FileExistsError(final)
    shutil.rmtree(aside, ignore_errors=True)
    shutil.copytree(source, aside)
    files = sorted(f.relative_to(aside).as_posix() for f in aside.rglob("*") if f.is_file() and f.name != "DONE.json")
    hashes = {f: sha256(aside / f) for f in files}
    if any(sha256(Path(source, f)) != h for f, h in hashes.items()):
        raise OSError("a file changed while it was copied")
    manifest = {"done_schema": 1, "job_id": job_id, "doc_id": doc_id, "created_at": created_at, "source_pdf": source_pdf, "artifacts": [{"path": f, "sha256": h} for f, h in hashes.items()], "ocr_pipeline_version": version}
    (aside / "DONE.json").write_text(json.dumps({k: v for k, v in manifest.items() if v is not None}, ensure_ascii=False, indent=2), encoding="utf-8")
    final.parent.mkdir(parents=True, exist_ok=True)
    aside.rename(final)
    return final


def demo_slice(segments: DataFrame, keys: list[str], most: int = 8, longest: int = 500, tag: str = "[demo] ") -> DataFrame:
    """The first segments of each document's first page, tagged and cut."""
    from pyspark.sql import Window

    first = F.min("page_index").over(Window.partitionBy(*keys))
    rows = segments.withColumn("_first", first).where((F.col("page_index") == F.col("_first")) & (F.col("pos") < most)).drop("_first")
    return rows.withColumn("text", F.substring(F.concat(F.lit(tag), "text"), 1, longest)).withColumn("page_index", F.lit(0))
