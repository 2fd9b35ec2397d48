"""Operator 8: near-duplicate vectors by an epsilon grid order join.

Unit vectors with cosine c are sqrt(2 - 2c) apart, and a projection on orthogonal axes never moves points
apart. Vectors are sorted by the cells of a grid of side epsilon on the leading principal axes. The sorted
sequence is cut into intervals, tiles and blocks with bounding boxes; pairs of intervals are halved
recursively, and halves whose boxes are provably further apart than epsilon are skipped. What is left is
compared by matrix products of tile and tile. Runs of neighbouring intervals are blocks of about ``SIDE`` tiles, and a task
gets the tiles of two blocks with the pairs to compare, so that a tile is moved once for each block it meets, not for
each tile.

Copies are joined first: a class of equal vectors goes through the join once, with its number of rows.
Tasks hand on, besides each class's number of links, only a star of each component that they see.

The axes come from a bounded sample of classes (``SAMPLE``); they decide the order alone, never a link.

Defined cases: null, zero, or vectors with null or non-finite components link with nothing, nor do vectors
of another dimension; an empty vector is a zero vector; rows with a null id take no part and come back
with a null component; rows that repeat an id and vector are links of each other like other copies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, written
from .components import components, local_labels
from .tiles import matrix, tile, usable

TILE, BLOCK, INTERVALS, AXES, SAMPLE = 2048, 128, 1024, 8, 4096
SIDE, HELD = 8, 32 << 20  # tiles of a block, and bytes that they may take


def boxes(points: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest coordinates of each size points in order."""
    at = np.arange(0, len(points), size)
    return np.minimum.reduceat(points, at), np.maximum.reduceat(points, at)


def apart(lo_a, hi_a, lo_b, hi_b) -> float:
    """The squared distance of two boxes."""
    return float((np.maximum(0, np.maximum(lo_b - hi_a, lo_a - hi_b)) ** 2).sum())


def near_pairs(a: tuple, b: tuple, far: float, same: bool) -> Iterator[tuple[int, int]]:
    """Pairs of blocks of the sequences a and b, given as (lows, highs), whose boxes are within reach. same:
    a and b are one sequence, and each pair comes once."""
    todo = [(0, len(a[0]), 0, len(b[0]))]
    while todo:
        x, y, u, v = todo.pop()
        if same and v <= x:
            continue
        if apart(a[0][x:y].min(0), a[1][x:y].max(0), b[0][u:v].min(0), b[1][u:v].max(0)) > far:
            continue
        if y - x == 1 and v - u == 1:
            if not same or x <= u:
                yield x, u
            continue
        halves = lambda s, t: [(s, t)] if t - s == 1 else [(s, (s + t) // 2), ((s + t) // 2, t)]
        todo += [(*p, *q) for p in halves(x, y) for q in halves(u, v)]


def axes_of(sample: list[list[float]]) -> dict[int, np.ndarray]:
    """The leading principal axes, as columns, for each dimension that occurs."""
    out = {}
    for dim in {len(x) for x in sample}:
        v = np.array([x for x in sample if len(x) == dim])
        v = units(v)
        _, vectors = np.linalg.eigh(np.cov(v.T).reshape(dim, dim) if len(v) > 1 else np.eye(dim))
        out[dim] = vectors[:, ::-1][:, :AXES]
    return out


def project(unit: np.ndarray, axes: dict[int, np.ndarray]) -> np.ndarray:
    own = axes.get(unit.shape[1])
    points = unit @ own if own is not None else unit[:, :AXES]
    return np.pad(points, ((0, 0), (0, AXES - points.shape[1])))


def units(data: np.ndarray) -> np.ndarray:
    data = data / np.abs(data).max(1, keepdims=True)
    return data / np.sqrt((data * data).sum(1, keepdims=True))


def join(df: DataFrame, least: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, n_links, component_id, kept) for each row."""
    far = (2 - 2 * least) * (1 + 1e-9) + 1e-12
    side = max(float(np.sqrt(far)), 1e-6)
    v = F.col(vector_col)
    good = F.col(id_col).isNotNull() & usable(v) & F.exists(v, lambda x: x != 0)
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.when(F.coalesce(good, F.lit(False)), v.cast("array<double>")).alias("vector"))
    classes = written(rows.where("vector is not null").groupBy("vector").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies")), "classes")
    n = classes.count()
    axes = axes_of([r[0] for r in classes.select("vector").orderBy(F.xxhash64("id")).limit(SAMPLE).collect()]) if n else {}

    def cells(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            lists = b.column(1)
            dims, flat = np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy()
            ends, grid = np.cumsum(dims), np.zeros((b.num_rows, AXES), np.int32)
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                grid[at] = np.floor(project(units(flat[(ends[at] - dim)[:, None] + np.arange(dim)]), axes) / side)
            yield pa.RecordBatch.from_arrays([b.column(0), lists, b.column(2), *(pa.array(grid[:, k]) for k in range(AXES))], ["id", "vector", "copies", *CELLS])

    order = [F.size("vector"), *map(F.col, CELLS), F.col("id")]
    intervals = max(1, min(INTERVALS, -(-n // TILE)))
    placed = classes.select("id", "vector", "copies").mapInArrow(cells, "id bigint, vector array<double>, copies bigint, " + ", ".join(f"{c} int" for c in CELLS))
    placed = placed.repartitionByRange(intervals, *order).sortWithinPartitions(*order)
    tiles = tile(placed, TILE, "copies")

    def summary(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            for x in b.select(["tile", "dim", "n", "ids", "data"]).to_pylist():
                _, data = matrix(x)
                points = project(units(data), axes)
                yield pa.RecordBatch.from_arrays([pa.array([y]) for y in (x["tile"], x["dim"], x["n"], x["ids"], x["data"], points.min(0).tolist(), points.max(0).tolist())], ["tile", "dim", "n", "ids", "data", "lo", "hi"])

    tiles = written(tiles.mapInArrow(summary, "tile bigint, dim bigint, n bigint, ids binary, data binary, lo array<double>, hi array<double>").withColumn("interval", F.shiftright("tile", 32)), "tiles")
    # One row for each of a bounded number of intervals.
    ends = [f(F.col(c)[k]).alias(f"{c}{k}") for f, c in ((F.min, "lo"), (F.max, "hi")) for k in range(AXES)]
    known = sorted(map(tuple, tiles.groupBy("interval").agg(*ends).collect()))
    spark = df.sparkSession
    seq = np.array([r[1:] for r in known]).reshape(-1, 2 * AXES)
    lows, highs = seq[:, :AXES], seq[:, AXES:]
    near = [(known[a][0], known[b][0]) for a, b in near_pairs((lows, highs), (lows, highs), far, True)] if known else []
    wanted = spark.createDataFrame(near, "ia bigint, ib bigint")
    heads = tiles.select("interval", "tile", "dim", "lo", "hi")
    a = heads.select(F.col("interval").alias("ia"), F.col("tile").alias("ta"), F.col("dim").alias("da"), F.col("lo").alias("la"), F.col("hi").alias("ha"))
    b = heads.select(F.col("interval").alias("ib"), F.col("tile").alias("tb"), F.col("dim").alias("db"), F.col("lo").alias("lb"), F.col("hi").alias("hb"))
    gap = lambda lo, hi: F.zip_with(lo, hi, lambda x, y: F.greatest(F.lit(0.0), x - y))
    sq = lambda arr: F.aggregate(arr, F.lit(0.0), lambda s, x: s + x * x)
    pairs = wanted.join(a, "ia").join(b, "ib").where("ta <= tb and da = db").where(sq(gap(F.col("lb"), F.col("ha"))) + sq(gap(F.col("la"), F.col("hb"))) <= far).select("ta", "tb")
    # Blocks: runs of intervals with about SIDE tiles, fewer if vectors are long.
    dim = max(axes, default=1)
    side = max(1, min(SIDE, HELD // (TILE * max(1, dim) * 8)) * intervals * TILE // max(n, intervals * TILE))
    block = lambda c: F.floor(F.shiftright(c, 32) / side)
    placed_pairs = pairs.select(block("ta").alias("ba"), block("tb").alias("bb"), "ta", "tb")
    none = F.array().cast("array<bigint>")
    needed = placed_pairs.groupBy("ba", "bb", F.col("ta").alias("tile")).agg(F.collect_list("tb").alias("with")).unionByName(placed_pairs.select("ba", "bb", F.col("tb").alias("tile"), none.alias("with")).distinct())
    needed = needed.groupBy("ba", "bb", "tile").agg(F.flatten(F.collect_list("with")).alias("with"))
    dealt = needed.join(tiles.select("tile", "n", "ids", "data"), "tile")

    def meet(ids_a: np.ndarray, data_a: np.ndarray, ids_b: np.ndarray, data_b: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """(whether a row is a link of components, u, v): links of two tiles, else (class, links)."""
        ua, ub = units(data_a), units(data_b)
        found_a, found_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        blocks: dict[int, list[int]] = {}
        for i, j in near_pairs(boxes(project(ua, axes), BLOCK), boxes(project(ub, axes), BLOCK), far, same):
            blocks.setdefault(i, []).append(j)
        for i, js in blocks.items():
            cols = np.concatenate([np.arange(j * BLOCK, min((j + 1) * BLOCK, len(ub))) for j in js])
            p, q = np.nonzero(ua[i * BLOCK : (i + 1) * BLOCK] @ ub[cols].T >= least - 1e-9)
            p, q = p + i * BLOCK, cols[q]
            if same:
                p, q = p[p < q], q[p < q]
            close = cosine(data_a[p], data_b[q]) >= least
            found_a.append(p[close])
            found_b.append(q[close])
        p, q = np.concatenate(found_a), np.concatenate(found_b)
        if not len(p):
            return None
        count_a = np.bincount(p, weights=ids_b[1][q], minlength=len(ua))
        count_b = np.bincount(q, weights=ids_a[1][p], minlength=len(ub))
        nodes, tops = local_labels(ids_a[0][p], ids_b[0][q])
        star = nodes != tops
        one = np.concatenate([ids_a[0][count_a > 0], ids_b[0][count_b > 0], nodes[star]])
        two = np.concatenate([count_a[count_a > 0], count_b[count_b > 0], tops[star]]).astype(np.int64)
        return np.arange(len(one)) >= len(one) - int(star.sum()), one, two

    def compare(rows: pa.Table) -> pa.Table:
        held = {x["tile"]: (*matrix(x), x["with"]) for x in rows.select(["tile", "n", "ids", "data", "with"]).to_pylist()}
        parts = [m for a, (ids, data, partners) in held.items() for b in partners if (m := meet(ids, data, *held[b][:2], a == b)) is not None]
        columns = [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [np.zeros(0, bool), np.zeros(0, np.int64), np.zeros(0, np.int64)]
        return pa.table({"edge": pa.array(columns[0], pa.bool_()), "u": pa.array(columns[1], pa.int64()), "v": pa.array(columns[2], pa.int64())})

    found = written(dealt.groupBy("ba", "bb").applyInArrow(compare, "edge boolean, u bigint, v bigint"), "links")
    links = found.where("not edge").groupBy(F.col("u").alias("id")).agg(F.sum("v").alias("others"))
    parts = components(found.where("edge").select("u", "v")).toDF("id", "component")
    told = classes.join(links, "id", "left").join(parts, "id", "left").select("vector", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component"))
    told = written(told, "told")
    out = rows.join(told, "vector", "left").select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    discard(classes, tiles, found)
    return out.withColumn("kept", F.col(id_col) == F.col("component_id"))


CELLS = [f"cell{k}" for k in range(AXES)]


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision, from the vectors as they are."""
    scale = lambda x: x / np.abs(x).max(1, keepdims=True) if len(x) and not 1e-100 < np.abs(x).max() < 1e100 else x
    a, b = scale(a), scale(b)
    return (a * b).sum(1) / np.sqrt((a * a).sum(1) * (b * b).sum(1))
