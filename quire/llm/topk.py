"""Operator 3: exact top-k search by inner product of whole numbers.

Components become floor(1024 * x). Queries and shards are tiles of a bounded size. Shard tiles are dealt to
at most ``LEAVES`` leaves and query tiles to as many parts as keep a part within ``HELD`` bytes; a leaf and a
part meet in one task, so that a query tile is moved once for each leaf and a shard tile once for each part,
and nothing passes through the driver. A task holds its queries with their k best so far, and shard tiles
pass by: each is a matrix product, of which what isn't below a query's k-th best is merged into its list
(partial selection). The lists of the leaves are merged in a tree: groups of ``FAN`` leaves, then groups of
groups, till one list a query is left.

Products are exact: in single precision where no sum can pass 2**24, in double precision where none can
pass 2**53 (no part of a sum is larger than the product of the norms), else in 64-bit whole numbers.

Defined cases: null vectors, or with null or non-finite components, and null ids take no part; vectors of
another dimension aren't comparable, so they are no candidates; a repeated id is one query, of its smallest
vector, and its rows aren't its own candidates but count once each for others; components whose product
with 1024 is beyond 64-bit numbers count as the largest of these; ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written
from .tiles import tile

QUERIES, SHARD, STRIP, FAN = 2048, 4096, 256, 16  # queries and vectors of a tile; queries at a time; lists merged at a time
LEAVES, HELD, TILE_BYTES = 64, 96 << 20, 2 << 20  # groups of shard tiles; bytes of a part's queries and lists; bytes of a tile's doubles
LEAST, MOST = -(2**63), 2**63 - 1


def whole(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * 1024).cast("double"))


def packed(data: np.ndarray) -> np.ndarray:
    """Whole numbers in the narrowest type that holds them."""
    top = np.abs(data).max(initial=0)
    return data.astype(np.int16 if top < 2**15 else np.int32 if top < 2**31 else np.float64)


def matrix(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """(ids, data) of a tile's row, data as packed."""
    n, dim = row["n"], row["dim"]
    kind = {2: np.int16, 4: np.int32}.get(len(row["data"]) // max(1, n * dim), np.float64)
    return np.frombuffer(row["ids"], np.int64), np.frombuffer(row["data"], kind).reshape(n, dim)


def numbers(data: np.ndarray, kind: type) -> np.ndarray:
    top = float(2**63 - 1024)
    return data.astype(kind) if kind is not np.int64 else np.clip(data.astype(np.float64), -top, top).astype(np.int64)


def norms(data: np.ndarray) -> np.ndarray:
    """1 at least, so that a factor is no larger than a product of norms."""
    with np.errstate(over="ignore"):
        return np.maximum(1.0, np.concatenate([np.zeros(0), *(np.sqrt((data[at : at + 4096].astype(np.float64) ** 2).sum(1)) for at in range(0, len(data), 4096))]) * (1 + 1e-9))


class Lists:
    """Queries of one dimension, and the k best of each among the vectors that passed by."""

    def __init__(self, own: np.ndarray, data: np.ndarray, k: int):
        self.own, self.data, self.k, self.norm = own, data, k, norms(data)
        # Best first; places that aren't taken are worse than any vector.
        self.score, self.id = np.full((len(own), k), LEAST), np.full((len(own), k), MOST)
        self.taken = np.zeros(len(own), np.int64)

    def meet(self, ids: np.ndarray, data: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        ids, data = ids[order], data[order]
        top, views = norms(data).max(initial=1.0), {}
        for at in range(0, len(self.own), STRIP):
            here = slice(at, at + STRIP)
            bound = top * self.norm[here].max()
            kind = np.float32 if bound < 2**24 else np.float64 if bound < 2**53 else np.int64
            if kind not in views:
                views[kind] = numbers(data, kind).T
            self.merge(at, ids, numbers(self.data[here], kind) @ views[kind])

    def merge(self, at: int, ids: np.ndarray, scores: np.ndarray) -> None:
        """scores: of the queries from at on and the vectors ids, which are in order."""
        k, (rows, cols) = self.k, scores.shape
        own, edge, last = self.own[at : at + rows], self.score[at : at + rows, -1], self.id[at : at + rows, -1]
        low, high = np.searchsorted(ids, own, "left"), np.searchsorted(ids, own, "right")
        for i in np.flatnonzero(low < high):
            scores[i, low[i] : high[i]] = LEAST
        wanted = scores >= edge.astype(scores.dtype)[:, None]
        if cols > k and np.count_nonzero(wanted) > 8 * k * rows:
            wanted &= scores >= np.partition(scores, cols - k, axis=1)[:, cols - k, None]
        row, col = np.divmod(np.flatnonzero(wanted), cols)
        score, vec = scores[row, col].astype(np.int64), ids[col]
        fit = (vec != own[row]) & ((score > edge[row]) | (vec <= last[row]))
        row, score, vec = row[fit], score[fit], vec[fit]
        if not len(row):
            return
        changed, new = np.unique(row, return_counts=True)
        row = np.concatenate([np.repeat(changed, k), row])
        score, vec = np.concatenate([self.score[at + changed].ravel(), score]), np.concatenate([self.id[at + changed].ravel(), vec])
        order = np.lexsort((vec, ~score, row))
        kept = order[np.searchsorted(row[order], changed, "left")[:, None] + np.arange(k)]
        self.score[at + changed], self.id[at + changed] = score[kept], vec[kept]
        self.taken[at + changed] = np.minimum(k, self.taken[at + changed] + new)

    def told(self, leaf: int) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(self.own), 4096):
            here = slice(at, at + 4096)
            taken = self.taken[here]
            there = np.arange(self.k) < taken[:, None]
            lists = pa.StructArray.from_arrays([pa.array(~self.score[here][there]), pa.array(self.id[here][there])], ["down", "vec_id"])
            ends = np.concatenate([[0], np.cumsum(taken)]).astype(np.int32)
            out = pa.RecordBatch.from_arrays([pa.array(self.own[here]), pa.array(np.full(len(taken), leaf)), pa.ListArray.from_arrays(ends, lists)], ["query_id", "leaf", "top"])
            yield out.filter(pa.array(taken > 0))


def meetings(parts: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The lists of each cell. Rows are tiles in the order of cells, in each the queries first."""
    cell, leaf, asked, lists = None, 0, {}, {}
    for b in parts:
        for i in range(b.num_rows):
            (x,) = b.slice(i, 1).to_pylist()
            if x["cell"] != cell:
                for one in lists.values():
                    yield from one.told(leaf)
                cell, leaf, asked, lists = x["cell"], x["leaf"], {}, {}
            if not x["shard"]:
                asked.setdefault(x["dim"], []).append(matrix(x))
                continue
            if x["dim"] in asked:
                own, data = zip(*asked.pop(x["dim"]), strict=True)
                lists[x["dim"]] = Lists(np.concatenate(own), np.concatenate(data), k)
            if x["dim"] in lists:
                lists[x["dim"]].meet(*matrix(x))
    for one in lists.values():
        yield from one.told(leaf)


def search(queries: DataFrame, vectors: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score). Both inputs: (id, vector) with whole numbers as doubles."""
    spark = vectors.sparkSession
    one = queries.where("id is not null").groupBy("id").agg(F.min("vector").alias("vector"))
    asked = written(tile(one, QUERIES, most=TILE_BYTES, pack=packed), "queries")
    shards = written(tile(vectors.where("id is not null"), SHARD, most=TILE_BYTES, pack=packed), "shards")
    tiles, size = asked.agg(F.count(F.lit(1)), F.sum(F.length("data") + F.col("n") * (32 + 16 * k))).first()
    n = min(LEAVES, shards.count())
    if not n or not tiles:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    groups = min(tiles, -(-size // HELD))
    # Tiles of a task have successive numbers, so they are dealt evenly, whatever tasks there were.
    dealt = lambda count: F.pmod(F.shiftright("tile", 32) + F.col("tile").bitwiseAND(F.lit(2**32 - 1)), F.lit(count))
    every = lambda count: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(count - 1).cast("bigint")))
    sides = asked.select(dealt(groups).alias("part"), every(n).alias("leaf"), F.lit(False).alias("shard"), *asked.columns)
    sides = sides.unionByName(shards.select(every(groups).alias("part"), dealt(n).alias("leaf"), F.lit(True).alias("shard"), *shards.columns))
    cells = sides.withColumn("cell", (F.col("part") * n + F.col("leaf")).cast("int")).repartitionById(groups * n, "cell").sortWithinPartitions("cell", "shard", "tile")
    lists = cells.mapInArrow(lambda parts: meetings(parts, k), "query_id bigint, leaf bigint, top array<struct<down: bigint, vec_id: bigint>>")
    while n > 1:
        n = -(-n // FAN)
        lists = lists.groupBy("query_id", F.floor(F.col("leaf") / FAN).alias("leaf")).agg(F.slice(F.array_sort(F.flatten(F.collect_list("top"))), 1, k).alias("top"))
    # down: the complement of the score, so that the highest comes first.
    return lists.select("query_id", F.posexplode("top").alias("at", "x")).select("query_id", (F.col("at") + 1).cast("int").alias("rank"), "x.vec_id", F.bitwise_not("x.down").alias("score"))
