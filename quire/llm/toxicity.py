"""Operator 6: toxicity by compression distance.

Texts become streams of 8-byte codes, two for each word: of its first ``STEM`` letters and of the word, so that
what a match saves doesn't depend on chance spellings; compressed as letters, five-letter words save no more
than the match costs (figures in the README). Two zstandard dictionaries are trained by zstandard's own trainer
on labelled rows: one on ordinary text, one on the distinguishing words of toxic text, which are those with far more contexts
(the words to both sides) than in ordinary text; each context counts once, so that copies of one text do. The second
goes behind the first as the dictionary for toxic text; the first alone is that for ordinary text.

Windows of ``WINDOW`` words begin every ``STRIDE`` words, so that each passage of up to ``WINDOW - STRIDE`` words lies
whole in one. Each is compressed under both dictionaries; the text's distance is the most bytes
that the toxic one saves in any window. A logistic curve, fitted on training rows that the dictionaries
haven't seen, turns it into a score.

Training takes at most ``TOXIC`` and ``ORDINARY`` rows of at most ``LONGEST`` characters each and ``TOTAL`` in all, the first
by a hash of id and text; scoring takes whole texts of any length.

Defined cases: null and empty texts have distance 0; rows with a null id are never trained on and count as
held out if the remainder says so, which for them it doesn't; without training rows of both classes all
scores are 0; too little text for zstandard's trainer is a dictionary by itself; repeated rows are scored alike; columns with the
names of the new ones give way.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .passing import add_columns
from .words import mix, word_hashes

WINDOW, STRIDE, STEM = 128, 64, 4
TOXIC, ORDINARY, LONGEST, TOTAL = 2_000, 5_000, 200_000, 1 << 25
ORDINARY_BYTES, TOXIC_BYTES = 1024, 2048  # of the trained dictionaries
SAMPLE_CODES = 8  # codes of a sample that the trainer gets
SIGNIFICANT, TIMES = 15.0, 8.0  # G-statistic and ratio of shares of a typical code


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def codes_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(words of each text, (stem code, word code) of each word)."""
    counts, whole, part = word_hashes(texts, prefix=STEM)
    return counts, np.stack([mix(part + np.uint64(1)), whole], 1)


def context_of(counts: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """A hash of each word with the words to both sides."""
    word = np.concatenate([[0], codes[:, 1], [0]]).astype(np.uint64)
    first = np.zeros(len(codes) + 1, bool)
    first[np.concatenate([[0], np.cumsum(counts)])] = True
    left = np.where(first[:-1], np.uint64(0), word[:-2])
    right = np.where(first[1:], np.uint64(0), word[2:])
    return mix(left * np.uint64(3) + mix(codes[:, 1] + mix(right)))


def contexts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, int]:
    """(codes, the number of different contexts each occurs in, the number of contexts)."""
    counts, codes = codes_of(texts)
    _, at = np.unique(context_of(counts, codes), return_index=True)
    names, times = np.unique(codes[at].ravel(), return_counts=True)
    return names, times, len(at)


def typical(mine: tuple, other: tuple) -> np.ndarray:
    """Codes typical of mine, the most typical first."""
    names, k, n = mine
    at = np.minimum(np.searchsorted(other[0], names), max(0, len(other[0]) - 1))
    j = np.where(other[0][at] == names, other[1][at], 0) if len(other[0]) else np.zeros(len(names))
    m = max(other[2], 1)
    both = (k + j) / (n + m)
    with np.errstate(divide="ignore", invalid="ignore"):
        part = lambda x, size, share: np.where(x > 0, x * np.log(x / size / share), 0) + np.where(size > x, (size - x) * np.log1p(-x / size) - (size - x) * np.log1p(-share), 0)
        g = 2 * (part(k, n, both) + part(j, m, both))
    good = np.flatnonzero((g > SIGNIFICANT) & (k / n > TIMES * (j + 1) / m))
    return names[good[np.argsort(-g[good], kind="stable")]]


@dataclass(frozen=True)
class Model:
    toxic: bytes
    ordinary: bytes
    slope: float
    bias: float

    def distance(self, texts: list[str | None]) -> np.ndarray:
        toxic, ordinary = compressors(self.toxic, self.ordinary)
        counts, codes = codes_of(texts)
        data, out, at = codes.tobytes(), np.zeros(len(texts)), 0
        for i, n in enumerate(counts.tolist()):
            end = at + n * 16
            for x in range(at, max(end - (WINDOW - STRIDE) * 16, at + (n > 0)), STRIDE * 16):
                window = data[x : min(end, x + WINDOW * 16)]
                out[i] = max(out[i], len(ordinary.compress(window)) - len(toxic.compress(window)))
            at = end
        return out

    def score(self, texts: list[str | None]) -> np.ndarray:
        if not self.toxic:
            return np.zeros(len(texts))
        return 1 / (1 + np.exp(-np.clip(self.slope * self.distance(texts) + self.bias, -30, 30)))


def parameters():
    import zstandard as z

    return z.ZstdCompressionParameters(window_log=14, hash_log=13, chain_log=13, search_log=3, min_match=6, strategy=z.STRATEGY_GREEDY, write_content_size=False, write_checksum=False, write_dict_id=False)


@lru_cache(4)
def compressors(*dictionaries: bytes) -> list:
    import zstandard as z

    return [z.ZstdCompressor(dict_data=z.ZstdCompressionDict(d, dict_type=z.DICT_TYPE_RAWCONTENT), compression_params=parameters()) for d in dictionaries]


def stream(texts: list[str]) -> np.ndarray:
    """The codes of texts in order, the words of each context once."""
    counts, codes = codes_of(texts)
    _, at = np.unique(context_of(counts, codes), return_index=True)
    return codes[np.sort(at)].ravel()


def trained(codes: np.ndarray, size: int) -> bytes:
    """zstandard's dictionary of a stream, in segments of one code."""
    import zstandard as z

    data, step = codes.tobytes(), 8 * SAMPLE_CODES
    samples = [data[i : i + step] for i in range(0, len(data) - step + 1, step)]
    try:
        return z.train_dictionary(size, samples, k=8, d=8).as_bytes()
    except (z.ZstdError, ValueError):  # too few samples for the trainer
        return data[-size:]


def dictionaries(toxic: list[str], ordinary: list[str]) -> tuple[bytes, bytes]:
    """(for toxic text, for ordinary text)."""
    words = typical(contexts(toxic), contexts(ordinary))
    mine = stream(toxic)
    base = trained(stream(ordinary), ORDINARY_BYTES)
    return base + trained(mine[np.isin(mine, words)], TOXIC_BYTES), base


def train(toxic: list[str], ordinary: list[str]) -> Model:
    """The curve from one of four rows and dictionaries of the rest; then dictionaries of all rows."""
    if not toxic or not ordinary:
        return Model(b"", b"", 0.0, 0.0)
    cut = lambda rows: ([x for i, x in enumerate(rows) if i % 4 or len(rows) < 4], [x for i, x in enumerate(rows) if not i % 4 or len(rows) < 4])
    (t, t_rest), (o, o_rest) = cut(toxic), cut(ordinary)
    raw = Model(*dictionaries(t, o), 1.0, 0.0)
    x = np.concatenate([raw.distance(t_rest), raw.distance(o_rest)])
    y = np.r_[np.ones(len(t_rest)), np.zeros(len(o_rest))]
    weight = np.where(y > 0, 0.5 / max(1, len(t_rest)), 0.5 / max(1, len(o_rest))) * len(x)
    cuts = np.unique(x)
    cuts = np.append((cuts[1:] + cuts[:-1]) / 2, cuts[-1] + 1)
    # Wrongly called toxic counts as rows stand; both kinds of error together become smallest.
    errors = [(y[x >= c] == 0).sum() + (y[x < c] == 1).sum() for c in cuts]
    border = float(cuts[int(np.argmin(errors))])
    slope = logistic_slope(x - border, y, weight)
    return Model(*dictionaries(toxic, ordinary), slope, -slope * border)


def logistic_slope(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The slope of the logistic curve through 0, with a weak pull to 0.3, by bisection."""
    lo, hi = 0.02, 5.0
    for _ in range(50):
        s = math.sqrt(lo * hi)
        p = 1 / (1 + np.exp(-np.clip(s * x, -30, 30)))
        lo, hi = (s, hi) if (weight * (y - p) * x).sum() - (s - 0.3) > 0 else (lo, s)
    return s


def fit(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """A model from labelled rows that aren't held out."""
    rows = {}
    for kind, most in ((1, TOXIC), (0, ORDINARY)):
        chosen = labels.where(F.col(id_col).isNotNull() & ~held_out(id_col) & (F.col(label_col) == kind)).select(id_col).distinct().orderBy(F.xxhash64(id_col), id_col).limit(most)
        # A bounded number of ids: the join sends them to the documents.
        texts = documents.join(F.broadcast(chosen), id_col, "left_semi").where(F.length(text_col) <= LONGEST)
        texts = texts.select(F.xxhash64(id_col, text_col).alias("h"), F.col(text_col).alias("text")).orderBy("h", "text").limit(most)
        # At most ``most`` rows: their running total of characters is one short window.
        total = F.sum(F.length("text")).over(Window.orderBy("h", "text").rowsBetween(Window.unboundedPreceding, 0))
        rows[kind] = [r[0] for r in texts.withColumn("total", total).where(F.col("total") <= TOTAL).select("text").collect()]
    return train(rows[1], rows[0])


def score(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """df with score (0 to 1) and predicted (1 from 0.5 on)."""
    scored = add_columns(df, text_col, {"score": "double"}, lambda texts: [model.score(texts)])
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
