"""Operator 9: best-fit packing by sums of squares.

Documents become pieces of at most ``capacity`` tokens; only longer documents are cut, and then the
first piece is the shorter one. A piece goes where the sum over residual gaps of the squared number
of open sequences with that gap becomes smallest; of equal places, where the gap left is smallest.

Pieces are dealt at random to shards of about ``SHARD`` pieces, each packed on its own, longest pieces first.
Sequences that shards leave with room are opened again and their pieces dealt anew to groups of about ``SHARD * FAN``
at most, level by level while the groups become fewer; a level that saves no sequence is given up and is the last. So no task
holds more pieces than that, up to the chance spread of the deal, and the driver holds counts alone.

Defined cases: a null text is empty, so it is one piece with the end token alone; equal rows are packed
as often as they occur, null ids too; extra columns don't come along; an empty table gives an empty one.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import batches, encode_texts, encoder_for
from .common import discard, written

CAPACITY, SHARD, FAN = 2048, 20_000, 2
END = 0  # id after each document


def pieces(df: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """(id, piece, start, length, ids_crc32, deal[, ids]): tokens of each text and the end token, cut
    into pieces. deal: a number that spreads rows evenly whatever they hold."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, seen = encoder_for(path), TaskContext.get().partitionId() << 40
        tail = np.array([end], "<u4")
        for whole in parts:
            for b in batches(whole, 1):
                rows, out = [], []
                for r, ids in enumerate(encode_texts(encoder, b.column(1).to_pylist())):
                    ids = np.concatenate([ids.astype("<u4"), tail])
                    at, k = 0, 0
                    while at < len(ids):
                        n = capacity if at else (len(ids) - 1) % capacity + 1
                        data = ids[at : at + n].tobytes()
                        rows.append((r, k, at, n, zlib.crc32(data), seen))
                        out.append(data)
                        at, k, seen = at + n, k + 1, seen + 1
                r, k, at, n, crc, deal = (np.array(x, np.int64) for x in zip(*rows, strict=True)) if rows else [np.zeros(0, np.int64)] * 6
                cols = [b.column(0).take(pa.array(r)), pa.array(k.astype(np.int32)), pa.array(at), pa.array(n), pa.array(crc), pa.array(deal)]
                yield pa.RecordBatch.from_arrays(cols + [pa.array(out, pa.binary())] * keep_ids, [id_col, *PIECE, *["ids"] * keep_ids])

    kind = dict(df.dtypes)[id_col]
    return df.select(id_col, F.col(text_col).cast("string").alias(text_col)).mapInArrow(run, f"`{id_col}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, deal bigint" + ", ids binary" * keep_ids)


PIECE = ["piece", "start", "length", "ids_crc32", "deal"]


def place(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The bin of each piece, and each bin's gap. Pieces come in the order given."""
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    count = np.zeros(capacity + 1, np.int64)  # of open bins, by gap; full ones don't count
    gaps: list[int] = []
    out = np.empty(len(lengths), np.int64)
    for i, s in enumerate(lengths.tolist()):
        left = count[: capacity - s + 1]
        cost = left - count[s:]  # half the change of the sum of squares but for constants, by the gap left
        cost = 2 * cost + 2
        cost[0] = 1 - 2 * count[s]
        fresh = 2 * int(left[capacity - s]) + 1 if s < capacity else 0
        cost[count[s:] == 0] = 1 << 40
        rest = int(cost.argmin())
        if cost[rest] <= fresh and count[rest + s]:
            at = open_bins[rest + s].pop()
            count[rest + s] -= 1
        else:
            at, rest = len(gaps), capacity - s
            gaps.append(0)
        gaps[at] = rest
        if rest:
            open_bins[rest].append(at)
            count[rest] += 1
        out[i] = at
    return out, np.array(gaps, np.int64)


def place_again(lengths: np.ndarray, capacity: int, room: int) -> tuple[np.ndarray, np.ndarray]:
    """As ``place``, longest first; then bins with more room than that are opened again and their
    pieces placed anew, as long as that saves bins."""
    at, gaps = place(lengths, capacity)
    while True:
        loose = gaps[at] > room
        new, new_gaps = place(lengths[loose], capacity)
        if len(new_gaps) >= int((gaps > room).sum()):
            return at, gaps
        kept = np.cumsum(gaps <= room) - 1
        at = kept[at]
        base = int((gaps <= room).sum())
        at[loose] = base + new
        gaps = np.concatenate([gaps[gaps <= room], new_gaps])


def pack(found: DataFrame, capacity: int = CAPACITY, shard: int = SHARD, fan: int = FAN, id_col: str = "doc_id") -> DataFrame:
    """The pieces with sequence_id and offset. found: from ``pieces``; columns beyond its own come along
    only if ``ids`` is all that is added."""
    found = found.select(id_col, *PIECE, *[c for c in found.columns if c == "ids"])
    spark = found.sparkSession
    todo = written(found, "pieces")
    n, done, made = todo.count(), [], [todo]
    schema = todo.schema.simpleString()[7:-1] + ",level int,part bigint,bin bigint,offset bigint,gap bigint"

    def packed(level: int):
        def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
            rows = rows.sort_by([("length", "descending"), ("deal", "ascending")])
            length = rows["length"].to_numpy()
            at, gaps = place_again(length, capacity, room)
            order = np.argsort(at, kind="stable")
            ends = np.cumsum(length[order])
            firsts = np.r_[True, at[order][1:] != at[order][:-1]] if len(at) else np.zeros(0, bool)
            offset = np.empty(len(at), np.int64)
            base = (ends - length[order])[firsts]
            offset[order] = ends - length[order] - np.repeat(base, np.diff(np.append(np.flatnonzero(firsts), len(at))))
            for name, x in (("level", np.full(len(at), level, np.int32)), ("part", np.full(len(at), key[0].as_py())), ("bin", at), ("offset", offset), ("gap", gaps[at])):
                rows = rows.append_column(name, pa.array(x))
            return rows.drop_columns(["shard"])

        return run

    room = capacity // 64  # what a good packing leaves by chance
    parts, level, before, rest = max(1, -(-n // shard)), 0, n, None
    while True:
        todo = todo.withColumn("shard", F.pmod(F.xxhash64("deal", F.lit(level)), F.lit(parts)))
        out = written(todo.groupBy("shard").applyInArrow(packed(level), schema), f"packed{level}")
        loose = F.col("gap") > room
        first = F.col("offset") == 0
        bins, n, open_bins = out.agg(F.count_if(first), F.count_if(loose), F.count_if(first & loose)).first()
        if rest is not None and bins >= before:
            done.append(rest)
            discard(out)
            break
        made.append(out)
        fewer = -(-n // (shard * fan))
        if parts == 1 or not n or fewer >= parts:
            done.append(out)
            break
        done.append(out.where(~loose))
        rest, before = out.where(loose), open_bins
        parts, level = fewer, level + 1
        todo = rest.drop("level", "part", "bin", "offset", "gap")
    whole = done[0]
    for x in done[1:]:
        whole = whole.unionByName(x)
    number = (F.col("level").cast("bigint") * F.lit(1 << 56)) + F.col("part") * F.lit(1 << 24) + F.col("bin")
    result = whole.select(id_col, "piece", "start", "length", "ids_crc32", *[c for c in found.columns if c == "ids"], number.alias("sequence_id"), "offset")
    discard(made[0])
    return result
