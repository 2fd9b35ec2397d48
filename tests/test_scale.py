"""What larger tables need: work that grows with the input alone, over all tasks, in bounded memory."""

import sys
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from quire.functions import latex, pages
from quire.operators import segments, vectors
from quire.plans import registry

SMALLEST = "/root/testdata/sf0.001"


def calls(f, *args):
    """Calls of Python functions, built-in ones too, that a call makes."""
    n = 0

    def count(frame, event, arg):
        nonlocal n
        n += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        f(*args)
    finally:
        sys.setprofile(None)
    return n


@pytest.mark.parametrize("line", ["plain words of prose, ", "設這是一些文字，", "x = y + z \\cdot w of a longer line of words. " * 2, "$a$ is \\$5, and so on in a longer line of words. " * 2])
def test_only_marks_of_a_line_cost_calls(line):
    marks = (line * 40).count("$") + (line * 40).count("\\")
    assert calls(pages.page_segments, line * 40) <= 200 + 100 * marks


@pytest.mark.parametrize("name", ["q_segments", "line_kinds", "page_ir", "render_documents", "lines_explode"])
def test_order_pages_are_dealt_once_and_to_all_tasks(spark, name):
    t = lambda table: spark.read.parquet(f"{SMALLEST}/{table}.parquet")
    assert registry.order_drafts(t)._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert registry.order_drafts(t).rdd.getNumPartitions() >= 2 * spark.sparkContext.defaultParallelism
    # The pages' own shuffle comes first; only documents of several pages are dealt again.
    plan = registry.QUERIES[name](spark, SMALLEST)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(page#") == 1


def test_segments_go_out_in_bounded_batches():
    drafts = pa.RecordBatch.from_pydict({"doc": [f"d{i}" for i in range(3000)], "page": list(range(3000)), "draft": ["設\n$x=1$\n1M\nB.\n" + "long " * i for i in range(2999)] + [None]})
    out = list(segments.segment_batches(iter([drafts])))
    assert len(out) > 2 and all(b.num_rows <= segments.ROWS + 5 for b in out)
    assert all(sum(map(len, b["text"].to_pylist())) <= segments.SIGNS + 15000 for b in out)
    rows = [tuple(r.values()) for b in out for r in b.to_pylist()]
    assert rows == [(f"d{i}", i, n, *s) for i, d in enumerate(drafts["draft"].to_pylist()) for n, s in enumerate(pages.page_segments(d or ""))]


def test_best_of_takes_one_strip_at_a_time():
    """A pair of tiles needs little beside itself; results are those of plain sorting, ties by id."""
    rng = np.random.default_rng(5)
    points = rng.integers(-2, 3, (2048, 8)).astype(float) + 0.25
    points /= np.sqrt((points * points).sum(1, keepdims=True))
    ids = np.arange(2048) * 3
    tracemalloc.start()
    found = [list(x) for x in zip(*(np.concatenate(x) for x in zip(*vectors.best_of(ids, points, ids, points, 5), strict=True)), strict=True)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 32 << 20  # one array of all scores is 32 MB
    scores = np.round(points @ points.T, 12)
    np.fill_diagonal(scores, -np.inf)
    assert [x[:2] for x in found] == [[ids[i], ids[j]] for i in range(2048) for j in np.argsort(-scores[i], kind="stable")[:5]]


@pytest.mark.parametrize("name", ["sanitize_tex", "slash_fractions", "table_cells"])
def test_parts_are_dealt_to_all_tasks(spark, name):
    assert registry.QUERIES[name](spark, SMALLEST).rdd.getNumPartitions() >= 2 * spark.sparkContext.defaultParallelism


@pytest.mark.parametrize("f", [latex.junk_free, latex.scripts, latex.one_line_groups, latex.sanitize])
def test_signs_of_a_document_cost_no_calls(f):
    assert calls(f, "plain words, not a formula. " * 100) < 300


def test_polish_reads_drafts_in_all_tasks(spark):
    drafts = spark.createDataFrame([(i, f"<<<nup:v0>>>\nleft {i}") for i in range(64)], "id int, draft string").coalesce(1)
    assert segments.polish_documents(drafts, ["id"], str.upper).rdd.getNumPartitions() >= 2 * spark.sparkContext.defaultParallelism
