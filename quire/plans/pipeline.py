"""Whole runs, as functions of tables: what a command line would call."""

from __future__ import annotations

import shutil
import subprocess
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import latex, text
from ..operators import dataset, layout, manifest, runs, seams, segments, vectors


def arrange(blocks: DataFrame, keys: list[str], page: str = "page") -> DataFrame:
    """(keys, page, draft): read blocks in reading order as page drafts. blocks: with x1 … y2, raw_text, version_id."""
    return segments.stitch(layout.reading_order(blocks, [*keys, page]), [*keys, page])


def documents(drafts: DataFrame, keys: list[str], polish: Callable[[str], str] | None = None, figures: DataFrame | None = None, blocks: DataFrame | None = None) -> dict[str, DataFrame]:
    """From page drafts (keys, page_index, draft) to segments, warnings, and each document's text, LaTeX and page file."""
    if polish is not None:
        drafts = segments.polish(drafts, [*keys, "page_index"], polish)
    found = segments.check_segments(segments.segment(drafts, keys))
    warnings = found.select(*keys, F.posexplode("warnings").alias("seq", "message"))
    plain = found.drop("warnings")
    if figures is not None:
        plain = segments.append_figures(plain, figures, blocks, keys)
    texts = segments.render_documents(plain, keys)
    files = texts.withColumn("tex", latex.sanitize_tex(text.wrap_document("text"))).join(segments.page_ir(plain, keys), keys, "left")
    return {"segments": plain, "warnings": runs.distinct_warnings(warnings, keys), "files": files}


def from_images(pages: DataFrame, keys: list[str], find: Callable[[], seams.LayoutEngine], engines: dict[str, Callable[[], seams.TextEngine]], settings: seams.Settings) -> dict[str, DataFrame]:
    """From page images (keys, page, content) to documents."""
    drafts = seams.drafts_of(pages, [*keys, "page"], find, engines, settings)
    return documents(drafts.withColumnRenamed("page", "page_index"), keys)


def curate(rows: DataFrame, merge: bool = True) -> dict[str, DataFrame]:
    """A draft's training rows, rejected rows, what remains, its counts and its merged questions."""
    out = dataset.promote(rows) | {"counts": dataset.status_counts(rows), "errors": dataset.all_errors(rows)}
    return out | ({"merged": dataset.merge_subparts(rows)} if merge else {})


def ingest(manifests: DataFrame, disk: DataFrame, page_irs: DataFrame, texts: DataFrame, table: DataFrame, model: Callable[[list[str]], list[list[float]]], dim: int = vectors.DIM, again: bool = False) -> DataFrame:
    """The table with the points of valid jobs. Each document counts for its last job by name."""
    good = manifest.valid(manifests, disk)
    jobs = good.groupBy(F.get_json_object("manifest", "$.doc_id").alias("doc_id")).agg(F.max("job_id").alias("job_id"))
    rows = vectors.ingest_segments(page_irs.join(jobs, "doc_id", "left_semi"), texts.join(jobs, "doc_id", "left_semi")).join(jobs, "doc_id")
    new = vectors.points(vectors.embed(rows, model, dim), F.col("job_id"))
    return vectors.reindex(table, new) if again else vectors.upsert(table, new)


def compile_tex(path: str, timeout: int = 300) -> tuple[int, str]:
    """(return code, message) of the first LaTeX program found: 127 without one, 124 if it takes too long."""
    tool = next((t for t in ("latexmk", "xelatex", "pdflatex") if shutil.which(t)), None)
    if tool is None:
        return 127, "no LaTeX program"
    source = Path(path)
    command = [tool, *(["-xelatex"] if tool == "latexmk" else []), "-interaction=nonstopmode", "-halt-on-error", source.name]
    try:
        done = subprocess.run(command, cwd=source.parent, capture_output=True, text=True, timeout=timeout)
    except subprocess.TimeoutExpired:
        return 124, f"more than {timeout} s"
    log = source.with_suffix(".log")
    if not log.exists():
        log.write_text(done.stdout + done.stderr)
    return done.returncode, "ok" if done.returncode == 0 else done.stdout[-500:]


def usable_tex(path: str) -> bool:
    return Path(path).is_file() and Path(path).stat().st_size > 0
