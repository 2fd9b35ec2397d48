"""Runs over many documents: what failed and where, warnings, timings and rates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip


def distinct_warnings(rows: DataFrame, keys: list[str], order: str = "seq", message: str = "message") -> DataFrame:
    """(keys, warnings): messages without blanks, each where it first came."""
    found = rows.withColumn(message, strip(message)).where(F.col(message) != "").groupBy(*keys, message).agg(F.min(order).alias("at"))
    listed = found.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("at", message))).alias("x"))
    return listed.select(*keys, F.transform("x", lambda x: x[message]).alias("warnings"))


def warning_line(warnings: list[str], most: int = 220) -> str | None:
    """Warnings on one line, those that don't fit counted."""
    if not warnings:
        return None
    line, shown = "", 0
    for w in warnings:
        more = f"{line}; {w}" if line else w
        if len(more) > most and shown:
            return f"{line}; +{len(warnings) - shown} more"
        line, shown = more, shown + 1
    return line[:most]


def stage_seconds(rows: DataFrame) -> DataFrame:
    """(run_id, stage, seconds)."""
    return rows.groupBy("run_id", "stage").agg(F.sum("seconds").alias("seconds"))


def run_batch(spark: SparkSession, docs: list[str], steps: list[tuple[str, Callable[[str], None]]], fail_fast: bool = False) -> DataFrame:
    """(doc_id, stage, ok, error): each document through all steps; one that fails, or exits, leaves the others
    alone unless fail_fast."""
    rows = []
    for doc in docs:
        stage, error = "", None
        for stage, step in steps:
            try:
                step(doc)
            except (Exception, SystemExit) as e:
                error = f"{type(e).__name__}: {e}"
                break
        rows.append((doc, stage, error is None, error))
        if error and fail_fast:
            break
    return spark.createDataFrame(rows, "doc_id string, stage string, ok boolean, error string")


def exit_code(status: DataFrame) -> int:
    return int(status.where("not ok").limit(1).count() > 0)


def failure_rates(traces: DataFrame, categories: list[str]) -> DataFrame:
    """(n, passed, <category>_rate …) of labelled traces."""
    return traces.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("overall") == "pass").alias("passed"), *[F.round(F.avg(F.col(c).cast("double")), 6).alias(f"{c}_rate") for c in categories])


def page_limit(pages: DataFrame, keys: list[str], most: int, page: str = "page_index") -> DataFrame:
    """Each document's first pages; 0: all."""
    from pyspark.sql import Window

    if not most:
        return pages
    return pages.withColumn("_n", F.row_number().over(Window.partitionBy(*(keys or [F.lit(0)])).orderBy(page))).where(F.col("_n") <= most).drop("_n")


def page_text(tex: str = "tex_body", txt: str = "txt", draft: str = "draft"):
    """A page's text: the polished body, else the plain text, else the draft."""
    some = lambda c: F.nullif(F.col(c), F.lit(""))
    return F.coalesce(some(tex), some(txt), some(draft), F.lit(""))


def preflight(publish: bool, ingest: bool, share_writable: bool, key: str | None) -> None:
    """What a batch needs before it starts."""
    if ingest and not publish:
        raise ValueError("ingest needs publish")
    if publish and not share_writable:
        raise ValueError("the share can't be written")
    if ingest and not key:
        raise ValueError("ingest needs a key")


def notes() -> dict[str, str]:
    """What a command line says before a run and at its last stage."""
    return {"preflight": "Note: Stage3 may take several minutes; silence is OK.", "arrange": "Stage3 arrange…"}


def success_lines(tex: str, warnings: list[str], most: int = 220) -> list[str]:
    """The last lines of a run: the document, what comes next, and the warnings, each once, on one line."""
    line = warning_line(list(dict.fromkeys(w.strip() for w in warnings if w.strip())), most)
    return [f"TEX: {tex}", f"Next: edit <=10m, then latexmk -xelatex {tex.rsplit('/', 1)[-1]}", *([f"WARN: {line}"] if line else [])]
