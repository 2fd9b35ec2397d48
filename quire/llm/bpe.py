"""Operator 1: exact byte-level BPE by backtracking, and decoding by an offset table.

A word is cut by the longest vocabulary entries an Aho-Corasick automaton finds. The cut is the
BPE result exactly if each token encodes to itself and each two neighbours are compatible, that is,
if BPE leaves the two as they are when it gets both their bytes. Where neighbours aren't
compatible, the encoder goes back: it tries the next shorter token at that place, and where none is
left, drops the token before and marks the place as dead, so that each place is tried once.

Words are found with array operations on code points over many documents at once, and each distinct
word of such a slab is encoded once.

Defined cases: a null text is the empty text; an empty text has no tokens and decodes to itself;
special strings in a text become their special token; a text of any length is encoded whole, in
slabs cut where a word surely begins; repeated rows stay repeated rows; columns other than the id
and the text don't come along, so that no name clashes.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLAB = 1 << 20  # characters
LETTER, NUMBER, SPACE, OTHER, SPECIAL = 1, 2, 3, 0, 4


@lru_cache(1)
def char_classes() -> np.ndarray:
    """For each code point: letter, number, white space or other, as the word pattern has them."""
    import regex

    out = np.zeros(0x110000, np.uint8)
    points = [*range(0xD800), *range(0xE000, 0x110000)]
    text, at = "".join(map(chr, points)), np.array(points)
    for pattern, cls in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\p{White_Space}+", SPACE)):
        for m in regex.finditer(pattern, text):
            out[at[m.start() : m.end()]] = cls
    return out


def byte_alphabet() -> dict[str, int]:
    """Printable stand-ins of bytes in byte-level vocabularies: printable Latin-1 stands for itself,
    the other bytes for the code points from 256 on, in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """A tokenizer file's vocabulary with its automaton, merges and pair-compatibility table."""

    MEMO, WORDS = 400_000, 300_000  # entries of the pair and word tables; a full one starts anew

    def __init__(self, path: str):
        import ahocorasick

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, letters = spec["model"], byte_alphabet()
        self.tokens: dict[bytes, int] = {bytes(letters[c] for c in t): i for t, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        vocab = model["vocab"]
        self.merges = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)}
        size = max([*self.tokens.values(), *self.special.values()]) + 1
        self.spelled: list[bytes] = [b""] * size
        for t, i in chain(self.tokens.items(), ((s.encode(), i) for s, i in self.special.items())):
            self.spelled[i] = t
        self.of_byte = [self.tokens[bytes([b])] for b in range(256)]
        self.lengths = np.array([len(t) for t in self.spelled], np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.lengths)])
        self.letters = np.frombuffer(b"".join(self.spelled), np.uint8)
        self.pair: dict[int, bool] = {}
        self.shorter = np.full(size, -2)
        self.spines()
        made = np.array([(new, a, b) for (a, b), (_, new) in self.merges.items()], np.int64).reshape(-1, 3)
        odd = {int(t) for t in made[~self.compute_pairs(made[:, 1], made[:, 2], inner=True), 0]}
        for t, a, b in made.tolist():  # in the order of ranks
            if a in odd or b in odd:
                odd.add(t)
        self.usable = {t: i for t, i in self.tokens.items() if i not in odd}  # BPE never makes the others
        self.automaton = ahocorasick.Automaton()
        for t, i in self.usable.items():
            self.automaton.add_word(t.decode("latin-1"), i)
        self.automaton.make_automaton()
        self.plant()
        self.forget()
        self.special_re = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None

    # -- the tables -------------------------------------------------------------------------

    def merge(self, data: bytes) -> list[int]:
        """BPE by its definition, for the few bytes of a token or two."""
        ids = [self.of_byte[b] for b in data]
        none = (1 << 60, 0)
        while len(ids) > 1:
            (rank, new), at = min((self.merges.get(p, none), i) for i, p in enumerate(zip(ids, ids[1:], strict=False)))
            if rank == none[0]:
                break
            ids[at : at + 2] = [new]
        return ids

    def spines(self) -> None:
        """For each token: the tokens at its right and left rim as merging goes on, outermost first,
        and the rank of the merge that takes each away. Also all merges, by pair."""
        parts = {new: (pair, rank) for pair, (rank, new) in self.merges.items()}
        if len(parts) < len(self.merges):
            raise ValueError("two merges make the same token; the pair table doesn't cover that")
        never = 1 << 40
        rims = []
        for side in (1, 0):
            rows: list[list[tuple[int, int]]] = []
            for t in range(len(self.spelled)):
                row, bound = [], never
                while True:
                    row.append((t, bound))
                    if t not in parts:
                        break
                    pair, bound = parts[t]
                    t = pair[side]
                rows.append(row)
            size = np.array([len(r) for r in rows])
            rims.append((size, np.cumsum(size) - size, np.array([x for r in rows for x, _ in r]), np.array([x for r in rows for _, x in r])))
        self.right, self.left = rims
        keys = np.array([a << 32 | b for a, b in self.merges])
        order = np.argsort(keys)
        self.merge_keys, self.merge_ranks = keys[order], np.array([r for r, _ in self.merges.values()])[order]

    def compute_pairs(self, a: np.ndarray, b: np.ndarray, inner: bool = False) -> np.ndarray:
        """Whether BPE leaves the stable tokens a and b apart: no merge of a right-rim token of a and a
        left-rim token of b comes before the merges that take these two away. Of equal ranks, the
        leftmost merge comes first. inner: the merge of a and b themselves doesn't count."""
        good = np.ones(len(a), bool)
        for i in range(int(self.right[0][a].max(initial=0))):
            for j in range(int(self.left[0][b].max(initial=0))):
                if inner and not i and not j:
                    continue
                at = np.flatnonzero(good & (self.right[0][a] > i) & (self.left[0][b] > j))
                if not len(at):
                    continue
                x, y = self.right[1][a[at]] + i, self.left[1][b[at]] + j
                key = self.right[2][x] << 32 | self.left[2][y]
                k = np.minimum(np.searchsorted(self.merge_keys, key), len(self.merge_keys) - 1)
                rank = self.merge_ranks[k]
                good[at[(self.merge_keys[k] == key) & (rank < self.right[3][x]) & (rank <= self.left[3][y])]] = False
        return good

    def compatible(self, codes: np.ndarray) -> np.ndarray:
        """For pairs a << 32 | b of stable tokens, from the pair-compatibility table, which grows by the
        pairs that come up."""
        found = np.fromiter(map(self.pair.get, codes.tolist(), repeat(2)), np.int8, len(codes))
        if (new := found == 2).any():
            unknown, back = np.unique(codes[new], return_inverse=True)
            good = self.compute_pairs(unknown >> 32, unknown & 0xFFFFFFFF)
            if len(self.pair) > self.MEMO:
                self.pair.clear()
            self.pair.update(zip(unknown.tolist(), good.tolist(), strict=True))
            found[new] = good[back]
        return found == 1

    SLOTS = 1 << 19

    def plant(self) -> None:
        """The automaton's tree as arrays: nodes by their first two bytes, further steps in a hash table
        with open addressing."""
        nodes: dict[bytes, int] = {}
        for t in self.usable:
            for n in range(2, len(t) + 1):
                nodes.setdefault(t[:n], len(nodes))
        self.node_token = np.full(len(nodes) + 1, -1)
        self.two = np.full(1 << 16, -1)
        steps = []
        for t, k in nodes.items():
            self.node_token[k] = self.usable.get(t, -1)
            if len(t) == 2:
                self.two[t[0] << 8 | t[1]] = k
            else:
                steps.append((nodes[t[:-1]] << 8 | t[-1], k))
        while self.SLOTS < 2 * len(steps):
            self.SLOTS *= 2
        self.step_keys, self.step_nodes = np.full(self.SLOTS, -1), np.full(self.SLOTS, -1)
        keys, to = np.array(steps, np.int64).reshape(-1, 2).T
        slot = self.slot(keys)
        while len(keys):
            free = np.flatnonzero(self.step_keys[slot] < 0)
            _, first = np.unique(slot[free], return_index=True)
            put = free[first]
            self.step_keys[slot[put]], self.step_nodes[slot[put]] = keys[put], to[put]
            rest = np.ones(len(keys), bool)
            rest[put] = False
            keys, to, slot = keys[rest], to[rest], (slot[rest] + 1) % self.SLOTS

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)).astype(np.int64) % self.SLOTS

    def longest_at(self, text: np.ndarray) -> np.ndarray:
        """The longest token that begins at each place of 16-bit units, of which those over 255 part words."""
        out = np.full(len(text), -1)
        byte = text < 256
        out[byte] = np.array(self.of_byte)[text[byte]]
        at = np.flatnonzero(byte[:-1] & byte[1:])
        node = self.two[text[at].astype(np.int64) << 8 | text[at + 1]]
        deep = 2
        while True:
            at, node = at[node >= 0], node[node >= 0]
            if not len(at):
                return out
            token = self.node_token[node]
            out[at[token >= 0]] = token[token >= 0]
            more = at + deep < len(text)
            at, node = at[more], node[more]
            more = text[at + deep] < 256
            at, node = at[more], node[more]
            key = node << 8 | text[at + deep]
            slot = self.slot(key)
            node = np.full(len(key), -1)
            left = np.arange(len(key))
            while len(left):
                held = self.step_keys[slot[left]]
                hit = held == key[left]
                node[left[hit]] = self.step_nodes[slot[left[hit]]]
                left = left[~hit & (held >= 0)]
                slot[left] = (slot[left] + 1) % self.SLOTS
            deep += 1

    def next_shorter(self, tokens: np.ndarray) -> np.ndarray:
        """Each token's longest proper prefix that is a token, or -1."""
        for a in np.unique(tokens[self.shorter[tokens] == -2]).tolist():
            t = self.spelled[a]
            self.shorter[a] = next((self.usable[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in self.usable), -1)
        return self.shorter[tokens]

    # -- encoding ---------------------------------------------------------------------------

    def backtrack(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of words, given as Latin-1 strings of their bytes, one after another, and counts. The
        words go forward and back side by side, a token each in every round."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        begin = np.cumsum(sizes + 1) - sizes - 1
        longest = self.longest_at(np.frombuffer("\u0100".join([*words, ""]).encode("utf-16-le"), np.uint16))
        dead = np.zeros(len(longest) + 1, bool)
        stack = np.full(len(longest) + 1, -1)  # tokens so far, each at the place where it ends
        at, last = begin.copy(), np.full(len(words), -1)
        token = longest[at]
        end_at = begin + sizes
        live = np.arange(len(words))
        while len(live):
            t, x, p = token[live], at[live], last[live]
            can = t >= 0
            end = x + np.where(can, self.lengths[t], 0)
            fits = can & ~dead[end]
            two = np.flatnonzero(fits & (p >= 0))
            fits[two] = self.compatible(p[two] << 32 | t[two])
            go = live[fits]
            stack[end[fits]] = t[fits]
            at[go], last[go] = end[fits], t[fits]
            token[go] = longest[end[fits]]
            less = live[can & ~fits]
            token[less] = self.next_shorter(token[less])
            back = live[~can]  # the place is dead: drop the token before and shorten it
            dead[at[back]] = True
            at[back] -= self.lengths[last[back]]
            token[back] = self.next_shorter(last[back])
            last[back] = np.where(at[back] > begin[back], stack[at[back]], -1)
            live = live[at[live] < end_at[live]]
        out = []
        live, where = np.arange(len(words)), end_at.copy()
        while len(live):  # the cuts, from their ends
            out.append(np.stack([where[live], stack[where[live]], live]))
            where[live] -= self.lengths[stack[where[live]]]
            live = live[where[live] > begin[live]]
        cuts = np.concatenate(out, 1)
        cuts = cuts[:, np.argsort(cuts[0], kind="stable")]
        return cuts[1], np.bincount(cuts[2], minlength=len(words))

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As ``backtrack``, but the cut by longest matches is taken where it is already right."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        found = np.fromiter(chain.from_iterable(self.automaton.iter_long("\u0100".join(words))), np.int64).reshape(-1, 2)
        ends, ids = found[:, 0], found[:, 1]
        of = np.searchsorted(np.cumsum(sizes + 1) - 1, ends, "right")
        same = of[1:] == of[:-1]
        bad = np.zeros(len(words), bool)
        bad[of[1:][same][~self.compatible((ids[:-1] << 32 | ids[1:])[same])]] = True
        counts = np.bincount(of, minlength=len(words))
        if not bad.any():
            return ids, counts
        redone, many = self.backtrack([words[i] for i in np.flatnonzero(bad)])
        new = counts.copy()
        new[bad] = many
        out = np.empty(int(new.sum()), np.int64)
        fill = np.repeat(bad, new)
        out[~fill] = ids[~np.repeat(bad, counts)]
        out[fill] = redone
        return out, new

    def known(self, words: list[str]) -> np.ndarray:
        """Numbers of words in the table of words met so far; new ones are encoded and go in."""
        numbers = np.fromiter(map(self.words.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(numbers < 0)
        if len(new):
            if len(self.words) > self.WORDS:
                self.forget()
                return self.known(words)
            fresh = [words[i] for i in new]
            ids, counts = self.encode_words(fresh)
            first, base = len(self.counts), len(self.flat)
            self.words.update(zip(fresh, range(first, first + len(fresh)), strict=True))
            self.begin = np.concatenate([self.begin, base + np.cumsum(counts) - counts])
            self.counts = np.concatenate([self.counts, counts])
            self.flat = np.concatenate([self.flat, ids.astype(np.uint32)])
            numbers[new] = np.arange(first, first + len(fresh))
        return numbers

    def forget(self) -> None:
        """An empty table of words, but for the special ones, which no other word can equal in it."""
        self.words: dict[str, int] = {}
        self.begin = np.arange(len(self.special), dtype=np.int64)
        self.counts = np.ones(len(self.special), np.int64)
        self.flat = np.array([*self.special.values()], np.uint32)

    def word_starts(self, points: np.ndarray, pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where words begin. pieces: where texts begin. The rules are those of the usual byte-level
        word pattern: contractions; a run of letters, of numbers or of others with the one blank
        before it; white space, of which the last goes with what follows if it is a blank."""
        n = len(points)
        cls = char_classes()[points]
        edge = np.zeros(n + 1, bool)
        edge[pieces] = True
        edge[n] = True
        special = np.zeros(0, np.int64)
        if self.special_re and (points == ord("<")).any():
            text = points.astype("<u4").tobytes().decode("utf-32-le")
            spans = [m.span() for m in self.special_re.finditer(text)]
            spans = [(a, b) for a, b in spans if not edge[a + 1 : b].any()]
            if spans:
                special = np.array([a for a, _ in spans])
                for a, b in spans:
                    cls[a:b] = SPECIAL
                    edge[a] = edge[b] = True
        start = edge.copy()
        start[1:n] |= cls[1:] != cls[:-1]
        runs = np.flatnonzero(start[:n])
        ends = np.append(runs[1:], n)
        kind = cls[runs]
        inner = (kind == SPACE) & ~edge[ends]  # white space with something after it
        a, b = runs[inner], ends[inner]
        blank = points[b - 1] == 32
        start[b[blank]] = False
        start[b - 1] = True  # a blank that goes on, or the last of a longer run
        alone = (kind == OTHER) & (ends - runs == 1) & (points[runs] == 39) & ~edge[ends]
        q = runs[alone]
        q = q[start[q]]
        if len(q):
            padded = np.append(points, [0, 0, 0])
            one, two = padded[q + 1], padded[q + 2]
            same = ~edge[np.minimum(q + 2, n)]
            short = np.isin(one, [ord(c) for c in "stmd"])
            double = same & (((two == ord("e")) & ((one == ord("r")) | (one == ord("v")))) | ((one == ord("l")) & (two == ord("l"))))
            for at, size in ((q[short], 2), (q[double], 3)):
                start[at + 1] = False
                start[at + size] = True
        return np.flatnonzero(start[:n]), special

    def encode_slab(self, texts: list[str]) -> list[np.ndarray]:
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        joined = "".join(texts)
        if not joined:
            return [np.zeros(0, np.uint32)] * len(texts)
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        firsts = np.cumsum(sizes) - sizes
        starts, special = self.word_starts(points, firsts[sizes > 0])
        width = 1 + (points >= 0x80) + (points >= 0x800).astype(np.int64) + (points >= 0x10000)
        place = np.concatenate([[0], np.cumsum(width)])
        raw = joined.encode()
        begin = place[starts]
        size = np.diff(np.append(begin, len(raw)))
        codes, words = distinct(raw, begin, size)
        numbers = self.known(words)[codes]
        if len(special):
            names = [*self.special]
            at = np.searchsorted(starts, special)
            numbers[at] = [names.index(raw[x : x + y].decode()) for x, y in zip(begin[at], size[at], strict=True)]
        lens = self.counts[numbers]
        out = spread(self.flat, self.begin[numbers], lens)
        total = np.concatenate([[0], np.cumsum(lens)])
        cut = total[np.searchsorted(starts, np.append(firsts, len(points)))]
        return [out[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        ids = ids.astype(np.int64)
        return spread(self.letters, self.offsets[ids], self.lengths[ids]).tobytes()

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


def spread(values: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The slices values[begin : begin + size], one after another."""
    ends = np.cumsum(size)
    if not len(ends) or not ends[-1]:
        return values[:0]
    return values[np.arange(ends[-1]) + np.repeat(begin - (ends - size), size)]


def distinct(raw: bytes, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, list[str]]:
    """Each word's number among the distinct words; these, as Latin-1 strings of their bytes."""
    data = np.frombuffer(raw + bytes(24), np.uint8)
    eight = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    short = size <= 23
    low = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
    b, n = begin[short], size[short]
    keys = [eight[b + 8 * k] & low[np.clip(n - 8 * k, 0, 8)] for k in range(3)]
    keys[2] |= n.astype(np.uint64) << np.uint64(56)
    h = keys[0] * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ h >> np.uint64(29) ^ keys[1]) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ h >> np.uint64(32) ^ keys[2]) * np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    code, uniques = pd.factorize(h)
    first = np.empty(len(uniques), np.int64)
    first[code[::-1]] = np.arange(len(code) - 1, -1, -1)
    if any((k != k[first][code]).any() for k in keys):  # two words of one hash
        table = np.stack(keys, 1)
        _, first, code = np.unique(table, axis=0, return_index=True, return_inverse=True)
        code = code.reshape(-1)
    codes = np.empty(len(size), np.int64)
    codes[short] = code
    at = np.flatnonzero(short)[first]
    text = raw.decode("latin-1")
    words = [text[x : x + y] for x, y in zip(begin[at].tolist(), size[at].tolist(), strict=True)]
    if not short.all():
        where = np.flatnonzero(~short)
        known: dict[str, int] = {}
        for i, x, y in zip(where.tolist(), begin[where].tolist(), size[where].tolist(), strict=True):
            w = text[x : x + y]
            k = known.setdefault(w, len(words))
            if k == len(words):
                words.append(w)
            codes[i] = k
    return codes, words


SAFE_CUT = re.compile(r"(?<=[^\W\d_]) (?=[^\W\d_])")


def chunks(text: str, size: int = SLAB) -> Iterator[str]:
    """Pieces of a long text, each beginning where a word surely begins: at the one blank between
    two letters. A stretch without such a place stays whole."""
    at = 0
    while len(text) - at > 2 * size:
        m = SAFE_CUT.search(text, at + size)
        if not m:
            break
        yield text[at : m.start()]
        at = m.start()
    yield text[at:] if at else text


def encode_texts(encoder: Encoder, texts: list[str | None], slab: int = SLAB) -> list[np.ndarray]:
    """Token ids of each text, in slabs of about that many characters."""
    out: list[np.ndarray] = []
    held: list[str] = []
    owner: list[int] = []
    got: list[list[np.ndarray]] = [[] for _ in texts]
    total = 0

    def flush() -> None:
        for i, ids in zip(owner, encoder.encode_slab(held), strict=True):
            got[i].append(ids)
        held.clear()
        owner.clear()

    for i, text in enumerate(texts):
        for part in chunks(text or "", slab):
            held.append(part)
            owner.append(i)
            total += len(part)
            if total >= slab:
                flush()
                total = 0
    flush()
    for parts in got:
        out.append(parts[0] if len(parts) == 1 else np.concatenate(parts))
    return out


@lru_cache(2)
def encoder_for(path: str) -> Encoder:
    return Encoder(path)


def batches(batch: pa.RecordBatch, text: int, size: int = 2 * SLAB) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about that many bytes of text each, so that memory stays bounded."""
    lens = np.nan_to_num(pa.compute.binary_length(batch.column(text)).to_numpy(zero_copy_only=False).astype(float))
    group = (np.cumsum(lens) // size).astype(np.int64)
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1), batch.num_rows]
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        if b > a:
            yield batch.slice(a, b - a)


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): each row's token ids as little-endian unsigned 32-bit integers in one binary value,
    a null text counting as empty. One narrow pass."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(path)
        for whole in parts:
            for b in batches(whole, 1):
                ids = encode_texts(encoder, b.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary())], [id_col, "ids"])

    kind = dict(df.dtypes)[id_col]
    return df.select(id_col, F.col(text_col).cast("string").alias(text_col)).mapInArrow(run, f"`{id_col}` {kind}, ids binary")


def decode(df: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id, ids, text): the text of each row of ``encode``. Bytes that are no UTF-8 become U+FFFD."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(path)
        for whole in parts:
            for b in batches(whole, 1):
                ids = [np.frombuffer(x or b"", "<u4") for x in b.column(1).to_pylist()]
                data = encoder.decode_bytes(np.concatenate(ids)) if ids else b""
                ends = np.cumsum([0, *(int(encoder.lengths[x].sum()) for x in ids)]).tolist()
                texts = [data[x:y].decode("utf-8", "replace") for x, y in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())], [id_col, "ids", "text"])

    kind = dict(df.dtypes)[id_col]
    return df.select(id_col, "ids").mapInArrow(run, f"`{id_col}` {kind}, ids binary, text string")


def token_count(ids: Column) -> Column:
    return (F.octet_length(ids) / 4).cast("bigint")
