"""Operator 5: quality by importance resampling.

Two generative models of hashed n-grams (words and pairs of neighbours, runs of marks being words too) are
counted, one over rows labelled good (the target), one over all rows (raw text). A text's importance weight is
the ratio of the likelihoods that the two give to ``LENGTH`` n-grams like its own: ``LENGTH`` times the mean log ratio of its
n-grams, so that long and short texts compete alike; ``PRIOR`` n-grams of ratio 1 are counted in, which pulls the mean
of very short texts to 0. A share ``keep`` of all rows is then drawn without replacement by Gumbel top-k: the rows with the highest
sums of log weight and Gumbel noise, which comes from a hash of the id. keep is a parameter; its default is the share of good
rows among the labelled ones.

Counts, weights and the draw cover all rows. The target model is counted on at most ``SAMPLE`` rows labelled
good, the first by a hash of the id.

Defined cases: null and empty texts have no n-gram, so log weight 0, and they compete with that; rows that tie with
the last one drawn, as repeated rows do, are all drawn; null ids share one noise; without rows labelled good
all are kept; an empty table gives an empty one; columns with the names of the new ones give way.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import batches
from .common import discard, written
from .passing import add_columns
from .words import mix, per_text, word_hashes

BUCKETS, SAMPLE, SEED = 1 << 16, 20_000, 17
LENGTH, PRIOR = 64, 8  # n-grams
HIGHEST = 1 << 40


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams of each text, their buckets): each word, and each word with the one before it."""
    counts, words, _ = word_hashes(texts, marks=True)
    first = np.zeros(len(words) + 1, bool)
    first[np.concatenate([[0], np.cumsum(counts)])[:-1][counts > 0]] = True
    before = np.concatenate([[0], words[:-1]]).astype(np.uint64) if len(words) else words
    pairs = mix(before * np.uint64(3) + words)
    both = np.stack([pairs, words], 1).ravel()
    keep = np.ones(len(both), bool)
    keep[0::2] = ~first[:-1]
    return np.maximum(2 * counts - 1, 0), (both[keep] % np.uint64(BUCKETS)).astype(np.int64)


@dataclass(frozen=True)
class Model:
    ratio: np.ndarray  # log ratio of each bucket
    share: float  # of rows labelled good among the labelled ones

    def log_weight(self, texts: list[str | None]) -> np.ndarray:
        n, at = grams(texts)
        return LENGTH * per_text(n, self.ratio[at]) / (n + PRIOR)


def sampled_ids(labels: DataFrame, wanted: Column, id_col: str, most: int) -> np.ndarray:
    rows = labels.where(wanted & F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id")).orderBy(F.xxhash64("id"), "id").limit(most)
    return np.unique(np.array([r[0] for r in rows.collect()], np.int64))


def fit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    good = sampled_ids(labels, F.col(label_col) == 1, id_col, SAMPLE)
    told = labels.where(F.col(label_col).isin(0, 1)).agg(F.avg(F.col(label_col))).first()[0]
    if not len(good):
        return Model(np.zeros(BUCKETS), 1.0)

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for whole in parts:
            for b in batches(whole, 1):
                ids = b.column(0).fill_null(HIGHEST).to_numpy()
                n, at = grams(b.column(1).to_pylist())
                raw += np.bincount(at, minlength=BUCKETS)
                target += np.bincount(at[np.repeat(np.isin(ids, good), n)], minlength=BUCKETS)
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(raw[at]), pa.array(target[at])], ["bucket", "raw", "target"])

    pairs = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    counts = pairs.mapInArrow(count, "bucket bigint, raw bigint, target bigint").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    raw, target = np.ones(BUCKETS), np.ones(BUCKETS)
    for bucket, x, y in counts.collect():  # at most BUCKETS rows
        raw[bucket] += x
        target[bucket] += y
    return Model(np.log(target / target.sum()) - np.log(raw / raw.sum()), float(told))


def gumbel(id_col: str) -> Column:
    u = (F.pmod(F.xxhash64(F.col(id_col), F.lit(SEED)), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(-F.log(u))


def kth_highest(keys: DataFrame, key: str, k: int, parts: int = 4096) -> float:
    """The k-th highest of a column of doubles, exactly: counts over ever narrower ranges, of ``parts`` rows each,
    until a range has few keys."""
    if k < 1:
        return float("inf")
    lo, hi, above = *keys.agg(F.min(key), F.max(key)).first(), 0
    if lo is None:
        return float("-inf")
    while True:
        inside = keys.where(F.col(key).between(lo, hi))
        step = (hi - lo) / parts
        if step <= 0 or lo + step == lo:
            return hi if lo == hi else sorted((r[0] for r in inside.select(key).distinct().orderBy(F.desc(key)).limit(parts).collect()), reverse=True)[0]
        spot = F.least(F.floor((F.col(key) - lo) / step), F.lit(parts - 1))
        got = sorted(inside.groupBy(spot.alias("spot")).agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi")).collect(), reverse=True)
        for _, n, a, b in got:
            if above + n >= k:
                lo, hi = a, b
                break
            above += n
        else:
            return got[-1][2]
        if n <= parts:
            return sorted((r[0] for r in keys.where(F.col(key).between(lo, hi)).select(key).collect()), reverse=True)[k - above - 1]


def resample(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: float | None = None) -> DataFrame:
    """df with log_weight, gumbel_key and kept."""
    model = fit(df, labels, id_col, text_col)
    weighed = add_columns(df, text_col, {"log_weight": "double"}, lambda texts: [model.log_weight(texts)])
    weighed = weighed.withColumn("gumbel_key", F.col("log_weight") + gumbel(id_col))
    keys = written(weighed.select("gumbel_key"), "keys")
    least = kth_highest(keys, "gumbel_key", round((model.share if keep is None else keep) * keys.count()))
    discard(keys)
    return weighed.withColumn("kept", F.col("gumbel_key") >= F.lit(least))
