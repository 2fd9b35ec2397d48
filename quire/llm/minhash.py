"""Operator 10: near-duplicate documents by ProbMinHash.

A document is the multiset of its runs of ``SHINGLE`` words. Each distinct run, weighted by how often it
occurs, is a Poisson process whose rate is its weight; its arrivals fall on random registers, and each
register keeps the run that arrives first. Runs stop as soon as their next arrival comes after all of the
document's registers are taken by earlier ones. Two documents agree in a register with the probability of
their probability Jaccard similarity, whatever their lengths.

Then:
1. documents of equal words are one class, which goes on as one document (its smallest id);
2. registers are cut into bands; classes with an equal band share a bucket;
3. in each bucket, each class is paired with the one that has most company in all its buckets, pairs are estimated by the registers and, unless
   the estimate rules them out by ``MARGIN`` standard deviations, verified by exact similarity of whole texts;
4. in buckets whose classes these links haven't all joined, classes of different components are compared in
   tiles of a bounded size, by registers and then exactly by whole texts; only links come out. So each pair
   that shares a bucket is either joined already, ruled out by registers, or compared exactly, and pairs
   of a large group are never made as rows;
5. links and classes make the groups, as connected components.

Bands leave out a pair of similarity 0.8 with a probability of 0.00005.

Defined cases: texts of fewer than ``SHINGLE`` words are one run of them all; texts without words, null and empty
ones too, are near only what is equal to them and isn't blank, so a blank text stays alone; rows of one id are
one document if their texts are equal, else each text links for itself and all of their groups are one;
rows with a null id take no part and keep a null group; extra columns don't come along.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import batches, spread
from .common import discard, written
from .components import components
from .words import mix, word_hashes

SHINGLE, LEAST = 5, 0.8
BANDS, ROWS = 25, 5
REGISTERS = BANDS * ROWS
MARGIN = 5.0
TILE, CHUNK = 1_000_000, 64  # characters of a tile; documents verified against one at a time


def shingles(counts: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, run, weight) of each distinct run of each text, sorted by text and run, from each text's number of
    words and all their hashes."""
    ends = np.cumsum(counts)
    begin = ends - counts
    runs = np.maximum(counts - SHINGLE + 1, np.minimum(counts, 1))
    of = np.repeat(np.arange(len(counts)), runs)
    at = np.arange(len(of)) - np.repeat(np.cumsum(runs) - runs, runs) + begin[of]
    h = np.zeros(len(of), np.uint64)
    for k in range(SHINGLE):
        inside = at + k < ends[of]
        h[inside] = mix(h[inside] * np.uint64(0x9E3779B97F4A7C15) + words[at[inside] + k] + np.uint64(k + 1))
    order = np.lexsort((h, of))
    of, h = of[order], h[order]
    first = np.ones(len(of), bool)
    first[1:] = (of[1:] != of[:-1]) | (h[1:] != h[:-1])
    where = np.flatnonzero(first)
    return of[where], h[where], np.diff(np.append(where, len(of)))


def uniform(h: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from hashes."""
    return ((h >> np.uint64(12)).astype(np.float64) + 0.5) / float(1 << 52)


def signatures(n: int, of: np.ndarray, run: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The registers of n documents: the hash of the run that arrives first in each. All documents go on side
    by side, an arrival of each live run in every round."""
    best = np.full(n * REGISTERS, np.inf)
    owner = np.zeros(n * REGISTERS, np.uint64)
    limit = np.full(n, np.inf)
    live, time, step = np.arange(len(of)), np.zeros(len(of)), 0
    while len(live):
        # Arrivals come in blocks, longer ones as fewer runs are left; those after a limit change nothing.
        block = int(np.clip(BLOCK // len(live), 1, 64))
        at = (np.arange(step, step + block, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[None, :]
        draw = mix(run[live][:, None] + at)
        times = time[:, None] - np.cumsum(np.log(uniform(draw)), 1) / weight[live][:, None]
        doc = of[live]
        i, k = np.nonzero(times < limit[doc][:, None])
        slot = doc[i] * REGISTERS + (mix(draw[i, k]) % np.uint64(REGISTERS)).astype(np.int64)
        when = times[i, k]
        np.minimum.at(best, slot, when)
        won = best[slot] == when
        owner[slot[won]] = run[live[i[won]]]
        touched = np.unique(doc)
        limit[touched] = best.reshape(n, REGISTERS)[touched].max(1)
        time, step = times[:, -1], step + block
        near = time < limit[doc]
        live, time = live[near], time[near]
    return owner.reshape(n, REGISTERS)


BLOCK = 1 << 16  # arrivals at a time, if runs are fewer


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """The probability Jaccard similarity of two weighted sets, each (sorted runs, weights)."""
    common, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    v, w = a[1][i].astype(float), b[1][j].astype(float)
    ratio = v / w
    order = np.argsort(ratio, kind="stable")
    v, w, ratio = v[order], w[order], ratio[order]
    # For each run: the weights, scaled to it, of runs that are relatively heavier in a, and of the others in b.
    first = np.searchsorted(ratio, ratio, "left")
    heavier = v.sum() - np.concatenate([[0], np.cumsum(v)])[first] + a[1].sum() - v.sum()
    lighter = np.concatenate([[0], np.cumsum(w)])[first] + b[1].sum() - w.sum()
    return float((1 / (heavier / v + lighter / w)).sum())


def sign(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, words, bands, registers, chars) of each row: a 128-bit hash of its words, null for a blank text; a
    hash of each band; the low byte of each register; the text's length."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            for b in batches(whole, 1):
                texts = b.column(1).to_pylist()
                n = len(texts)
                counts, words, _ = word_hashes(texts)
                of, h, weight = shingles(counts, words)
                owner = signatures(n, of, h, weight)
                has = np.bincount(of, minlength=n) > 0
                band = np.zeros((n, BANDS), np.uint64)
                for k in range(ROWS):
                    band = mix(band * np.uint64(3) + owner.reshape(n, BANDS, ROWS)[:, :, k])
                band = mix(band + np.arange(1, BANDS + 1, dtype=np.uint64))
                key = fingerprints(counts, words)
                low = (owner >> np.uint64(13)).astype(np.uint8)
                equal = [key[i].tobytes() if has[i] else b"=" + t.encode() if (t := texts[i]) and t.strip() else None for i in range(n)]
                bands = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.where(has, BANDS, 0))]).astype(np.int32)), pa.array(band[has].ravel().view(np.int64)))
                chars = np.fromiter((len(t or "") for t in texts), np.int64, n)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(equal, pa.binary()), bands, pa.array([x.tobytes() for x in low], pa.binary()), pa.array(chars)], ["id", "words", "bands", "registers", "chars"])

    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null")
    return rows.mapInArrow(run, "id bigint, words binary, bands array<bigint>, registers binary, chars bigint")


def fingerprints(counts: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Two 64-bit hashes of each text's word sequence."""
    out = np.zeros((len(counts), 2), np.uint64)
    ends = np.cumsum(counts)
    place = (np.arange(len(words)) - np.repeat(ends - counts, counts)).astype(np.uint64)
    for k, salt in enumerate((0x2545F4914F6CDD1D, 0x9E3779B97F4A7C15)):
        total = np.concatenate([[0], np.cumsum(mix(words + mix(place + np.uint64(salt))), dtype=np.uint64)]).astype(np.uint64)
        out[:, k] = mix(total[ends] - total[ends - counts] + counts.astype(np.uint64))
    return out


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated similarity from low bytes of registers."""
    return ((a == b).mean(-1) - 1 / 256) / (1 - 1 / 256)


def floor_of(least: float) -> float:
    return least - MARGIN * float(np.sqrt(least * (1 - least) / REGISTERS))


BITS = 1 << 26  # of the filter of ids: its size is bounded, and beyond it lets through more than it needs to


def only(documents: DataFrame, ids: DataFrame) -> DataFrame:
    """Documents whose id may be among ids, so that a join with them moves few others."""
    place = F.pmod(F.xxhash64(F.col(ids.columns[0])), F.lit(BITS))
    maps = ids.select(F.bitmap_bucket_number(place).alias("at"), F.bitmap_bit_position(place).alias("bit")).groupBy("at").agg(F.bitmap_construct_agg("bit").alias("bits"))
    flags = np.zeros(BITS // 8 + (1 << 12), np.uint8)
    for at, bits in maps.collect():  # at most BITS / 32768 rows of 4 KB
        flags[(at - 1) * 4096 : at * 4096] = np.frombuffer(bits, np.uint8)
    shared = documents.sparkSession.sparkContext.broadcast(flags)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            spot = b.column(2).to_numpy()
            yield b.filter(pa.array(shared.value[spot >> 3] >> (spot & 7).astype(np.uint8) & 1 == 1)).select(["id", "text"])

    spot = F.pmod(F.xxhash64("id"), F.lit(BITS))
    flat = (F.bitmap_bucket_number(spot) - 1) * 32768 + F.bitmap_bit_position(spot)
    return documents.where("id is not null").select("id", "text", flat.alias("spot")).mapInArrow(run, "id bigint, text string")


def verify(pairs: DataFrame, documents: DataFrame, least: float, tag: str) -> DataFrame:
    """Pairs (a, b) of different ids whose texts have at least that similarity. documents: (id, text).

    Each text goes to the pairs of the class a that it is in, in groups of at most ``CHUNK``, with a's text."""
    pairs = written(pairs.select("a", "b"), f"{tag}-pairs")
    documents = only(documents, pairs.select("a").union(pairs.select("b")))
    many = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("chunks"))
    dealt = pairs.join(many, "a").withColumn("chunk", F.pmod(F.xxhash64("b"), F.col("chunks")))
    members = dealt.select("a", "chunk", F.col("b").alias("id"))
    heads = dealt.select("a", "chunk").distinct().withColumn("id", F.col("a"))
    needed = members.unionByName(heads)

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        ids = rows["id"].to_numpy()
        of, h, weight = shingles(*word_hashes(rows["text"].to_pylist())[:2])
        edge = np.searchsorted(of, np.arange(len(ids) + 1))
        part = lambda i: (h[edge[i] : edge[i + 1]], weight[edge[i] : edge[i + 1]])
        a = key[0].as_py()
        heads = [part(i) for i in np.flatnonzero(ids == a)]
        close = {int(x) for i, x in enumerate(ids) if x != a and any(similarity(head, part(i)) >= least - 1e-12 for head in heads)}
        return pa.table({"u": pa.array([a] * len(close), pa.int64()), "v": pa.array(sorted(close), pa.int64())})

    found = needed.join(documents, "id").groupBy("a", "chunk").applyInArrow(run, "u bigint, v bigint")
    out = written(found, f"{tag}-links")
    discard(pairs)
    return out


def across(least: float):
    """Links between rows of different components in a pair of tiles: for what isn't of the largest component,
    each row that the registers allow is compared exactly; rows joined by a link found here count as one
    component from then on."""
    border = floor_of(least)

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        ids, component, mine = (rows[c].to_numpy() for c in ("rep", "component", "mine"))
        component = component.copy()
        low = np.frombuffer(b"".join(rows["registers"].to_pylist()), np.uint8).reshape(-1, REGISTERS)
        of, h, weight = shingles(*word_hashes(rows["text"].to_pylist())[:2])
        edge = np.searchsorted(of, np.arange(len(ids) + 1))
        _, code = np.unique(h, return_inverse=True)
        share = weight / np.maximum(np.bincount(of, weights=weight, minlength=len(ids)), 1)[of]
        even = np.maximum.reduceat(np.append(weight, 0), np.minimum(edge[:-1], len(weight))) <= 1
        size = np.diff(edge)
        mark = np.zeros(len(h) + 1)
        names, times = np.unique(component, return_counts=True)
        small = component != names[times.argmax()]
        same_tile = key[1].as_py() == key[2].as_py()
        one, two = [], []
        for i in np.flatnonzero(small):
            can = (component != component[i]) & (~small | (ids > ids[i]))
            if not same_tile:
                can &= mine != mine[i]
            j = np.flatnonzero(can)
            j = j[estimate(low[j], low[i]) >= border]
            if not len(j):
                continue
            own = slice(edge[i], edge[i + 1])
            mark[code[own]] = share[own]
            at = spread(np.arange(len(h)), edge[j], size[j])
            met = mark[code[at]]
            mark[code[own]] = 0
            owner = np.repeat(np.arange(len(j)), size[j])
            common = np.bincount(owner[met > 0], minlength=len(j))
            bound = np.bincount(owner, weights=np.minimum(met, share[at]), minlength=len(j))
            exact = common / (size[i] + size[j] - common)
            plain = even[j] & even[i]
            close = plain & (exact >= least - 1e-12)
            part = lambda k: (h[edge[k] : edge[k + 1]], weight[edge[k] : edge[k + 1]])
            for k in np.flatnonzero(~plain & (bound >= least - 1e-9)):
                close[k] = similarity(part(i), part(j[k])) >= least - 1e-12
            _, first = np.unique(component[j[close]], return_index=True)
            for k in j[close][first]:
                one.append(int(ids[i]))
                two.append(int(ids[k]))
                component[component == component[k]] = component[i]
        return pa.table({"u": pa.array(one, pa.int64()), "v": pa.array(two, pa.int64())})

    return run


def groups(df: DataFrame, least: float = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, class_id) of each row of df: the smallest id of its near-duplicate group."""
    signed = written(sign(df, id_col, text_col), "signed")
    classes = signed.where("words is not null").groupBy("words").agg(F.min("id").alias("rep"), F.min(F.struct("id", "bands", "registers", "chars")).alias("x"))
    classes = written(classes.select("words", "rep", "x.bands", "x.registers", "x.chars"), "classes")
    texts = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    buckets = classes.select("rep", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    crowded = buckets.join(shared, "bucket")
    # What many variants of one text share is mostly the text itself: it lies in the largest buckets.
    central = crowded.groupBy("rep").agg(F.sum("n").alias("central"))
    members = written(crowded.join(central, "rep"), "members")
    heads = members.groupBy("bucket").agg(F.max(F.struct("central", (-F.col("rep")).alias("down"))).alias("x")).select("bucket", (-F.col("x.down")).alias("a"))
    low = classes.select(F.col("rep").alias("id"), "registers")
    border = floor_of(least)

    def compare(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            x, y = (np.frombuffer(b"".join(b.column(k).to_pylist()), np.uint8).reshape(-1, REGISTERS) for k in (2, 3))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).filter(pa.array(estimate(x, y) >= border))

    stars = members.join(heads, "bucket").where("rep <> a").select("a", F.col("rep").alias("b")).distinct()
    stars = stars.join(low.toDF("a", "la"), "a").join(low.toDF("b", "lb"), "b").select("a", "b", "la", "lb").mapInArrow(compare, "a bigint, b bigint")
    links = verify(stars.distinct(), texts, least, "stars")
    joined = components(links)
    # Buckets whose members aren't all joined: each with its rows' texts, in tiles.
    size = classes.select("rep", "registers", "chars")
    known = members.select("bucket", "rep").join(joined.toDF("rep", "component"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    mixed = known.join(size.select("rep", "chars"), "rep").groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.ceil(F.sum("chars") / TILE).cast("bigint").alias("tiles")).where("x <> y")
    rest = written(known.join(mixed.select("bucket", "tiles"), "bucket"), "rest")
    near = only(texts, rest.select("rep")).join(rest.select(F.col("rep").alias("id")).distinct(), "id", "left_semi").withColumnRenamed("id", "rep")
    tiles = rest.join(size.select("rep", "registers"), "rep").withColumn("mine", F.pmod(F.xxhash64("rep"), F.col("tiles"))).withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tiles") - 1)))
    tiles = tiles.select("bucket", "rep", "component", "registers", "mine", F.least("mine", "other").alias("ta"), F.greatest("mine", "other").alias("tb")).join(near, "rep")
    links2 = written(tiles.groupBy("bucket", "ta", "tb").applyInArrow(across(least), "u bigint, v bigint"), "rest-links")
    discard(rest)
    joined = components(links.unionByName(links2)).toDF("rep", "component")
    told = written(classes.select("words", "rep").join(joined, "rep", "left").select("words", F.coalesce("component", "rep").alias("class_id")), "told")
    out = signed.select("id", "words").join(told, "words", "left").select(F.col("id").alias(id_col), F.coalesce("class_id", "id").alias("class_id"))
    discard(links, links2, members, classes)
    return out
