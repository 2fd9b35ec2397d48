"""Word hashes of many texts at once, by array operations on code points.

A word is a run of letters, digits and marks in lower case. Its hash is a polynomial of its code points
modulo 2**64, mixed at the end; it is the same in every process.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from .bpe import SLAB, chunks

WORD, BLANK, MARK = 1, 2, 0
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)


@lru_cache(1)
def word_classes() -> np.ndarray:
    """For each code point: of a word, white space or another mark."""
    import regex

    out = np.zeros(0x110000, np.uint8)
    points = [*range(0xD800), *range(0xE000, 0x110000)]
    text, at = "".join(map(chr, points)), np.array(points)
    for pattern, cls in ((r"[\p{L}\p{M}\p{N}_]+", WORD), (r"\s+", BLANK)):
        for m in regex.finditer(pattern, text):
            out[at[m.start() : m.end()]] = cls
    return out


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i up to n."""
    if len(_powers[0]) <= n:
        n = max(n, SLAB + SLAB // 4)
        for k, x in enumerate((BASE, INVERSE)):
            p = np.full(n + 1, x, np.uint64)
            p[0] = 1
            _powers[k] = np.cumprod(p, dtype=np.uint64)
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """A finishing step that lets each bit depend on all bits."""
    h = (h ^ h >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ h >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return h ^ h >> np.uint64(31)


def slab_words(texts: list[str], marks: bool, prefix: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words of each text, their hashes, hashes of their first prefix characters). marks: runs of other
    marks count as words too."""
    texts = [t.lower() for t in texts]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    n = len(points)
    if not n:
        return np.zeros(len(texts), np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    cls = word_classes()[points]
    edge = np.zeros(n + 1, bool)
    ends = np.cumsum(sizes)
    edge[ends] = True
    edge[0] = True
    change = edge.copy()
    change[1:n] |= cls[1:] != cls[:-1]
    at = np.flatnonzero(change)
    start, end = at[:-1], at[1:]
    keep = cls[start] != BLANK if marks else cls[start] == WORD
    start, end = start[keep], end[keep]
    up, down = powers(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((points.astype(np.uint64) + np.uint64(1)) * up[:n], dtype=np.uint64, out=total[1:])
    whole = mix((total[end] - total[start]) * down[start])
    part = mix((total[np.minimum(start + prefix, end)] - total[start]) * down[start]) if prefix else whole
    counts = np.diff(np.searchsorted(start, np.append(0, ends)))
    return counts, whole, part


def word_hashes(texts: list[str | None], marks: bool = False, prefix: int = 0, slab: int = SLAB) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``slab_words``, over any number of texts of any length, in slabs of a bounded size. Long texts are
    cut at blanks between letters, where a word begins in any case."""
    counts = np.zeros(len(texts), np.int64)
    wholes, parts, held, owner, size = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], [], [], 0

    def flush() -> None:
        n, whole, part = slab_words(held, marks, prefix)
        np.add.at(counts, np.array(owner, np.int64), n)
        wholes.append(whole)
        parts.append(part)
        held.clear()
        owner.clear()

    for i, text in enumerate(texts):
        for piece in chunks(text or "", slab):
            held.append(piece)
            owner.append(i)
            size += len(piece)
            if size >= slab:
                flush()
                size = 0
    if held:
        flush()
    return counts, np.concatenate(wholes), np.concatenate(parts)


def per_text(counts: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The sum of each text's values."""
    ends = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    edge = np.concatenate([[0], np.cumsum(counts)])
    return ends[edge[1:]] - ends[edge[:-1]]
