"""Vectors in tiles: rows of a table as matrices of a bounded size, for products of tile and tile."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))), F.lit(False))


def tile(df: DataFrame, size: int, extra: str | None = None, most: int | None = None, pack: Callable[[np.ndarray], np.ndarray] = lambda data: data) -> DataFrame:
    """(tile, dim, n, ids, data): each task's rows, in their order, in tiles of at most size vectors of one
    dimension. df: (id bigint, vector array<double>[, extra bigint]); ids and data are little-endian
    64-bit numbers, ids with extra behind them. most: bytes of doubles in a tile, but for one vector that
    is larger. pack: the data in another type of numbers."""

    def vectors(dim: int) -> int:
        return size if most is None else max(1, min(size, most // (8 * max(1, dim))))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        next_tile = TaskContext.get().partitionId() << 32
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def out(dim: int, whole: bool) -> Iterator[pa.RecordBatch]:
            nonlocal next_tile
            ids = np.concatenate([x for x, _ in held[dim]])
            data = np.concatenate([x for _, x in held[dim]])
            at, full = 0, vectors(dim)
            while at < len(ids) and (whole or len(ids) - at >= full):
                a, b = ids[at : at + full], data[at : at + full]
                yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (next_tile, dim, len(a), a.T.tobytes(), pack(b).tobytes())], ["tile", "dim", "n", "ids", "data"])
                at, next_tile = at + full, next_tile + 1
            held[dim] = [(ids[at:], data[at:])] if at < len(ids) else []

        for b in parts:
            ids = np.stack([b.column(0).to_numpy(), *([b.column(2).to_numpy()] if extra else [])], 1)
            lists = b.column(1)
            dims, flat = np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy()
            ends = np.cumsum(dims)
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                rows = flat[(ends[at] - dim)[:, None] + np.arange(dim)] if dim else np.zeros((len(at), 0))
                held.setdefault(dim, []).append((ids[at], rows))
                if sum(len(x) for x, _ in held[dim]) >= vectors(dim):
                    yield from out(dim, False)
        for dim in [*held]:
            if held[dim]:
                yield from out(dim, True)

    cols = [F.col("id").cast("bigint").alias("id"), F.col("vector").cast("array<double>").alias("vector"), *([F.col(extra).cast("bigint").alias(extra)] if extra else [])]
    return df.select(*cols).mapInArrow(run, "tile bigint, dim bigint, n bigint, ids binary, data binary")


def matrix(row: dict, side: str = "") -> tuple[np.ndarray, np.ndarray]:
    """(ids, data) of a tile's row."""
    n = row[f"{side}n"]
    return np.frombuffer(row[f"{side}ids"], np.int64).reshape(-1, n), np.frombuffer(row[f"{side}data"], np.float64).reshape(n, -1)
