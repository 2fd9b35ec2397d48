"""Tokens against the library, packing against its rules."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quire.llm import bpe, packing, queries
from quire.llm.common import tokenizer_path

tokenizers = pytest.importorskip("tokenizers")
PIECES = ["a", "the", " ", "  ", "\n", "\t", "'s", "'re", "'", "'S", "1", "23", "½", "é", "中文", "　", "\x1c", "\x85", "😀", "!", "__", "<|endoftext|>", "<", "ing", "́", "aaaaaaaa", "\x00"]


@pytest.fixture(scope="module")
def tools():
    return bpe.encoder_for(tokenizer_path()), tokenizers.Tokenizer.from_file(tokenizer_path())


@settings(max_examples=200, deadline=None)
@given(st.one_of(st.lists(st.sampled_from(PIECES), max_size=20).map("".join), st.text(max_size=60)))
def test_as_the_library(text):
    mine, theirs = bpe.encoder_for(tokenizer_path()), tokenizers.Tokenizer.from_file(tokenizer_path())
    ids = bpe.encode_texts(mine, [text])[0].tolist()
    assert ids == theirs.encode(text, add_special_tokens=False).ids
    assert mine.decode(np.array(ids, np.int64)) == theirs.decode(ids, skip_special_tokens=False)


def test_pair_table_is_the_definition(tools):
    mine, _ = tools
    rng = random.Random(3)
    tokens = sorted(mine.usable.values())
    pairs = [(rng.choice(tokens), rng.choice(tokens)) for _ in range(3000)] + [p for p in list(mine.merges)[:500]]
    pairs = [p for p in pairs if p[0] in set(mine.usable.values()) and p[1] in set(mine.usable.values())]
    a, b = np.array(pairs).T
    assert mine.compute_pairs(a, b).tolist() == [mine.merge(mine.spelled[x] + mine.spelled[y]) == [x, y] for x, y in pairs]
    assert all(mine.merge(mine.spelled[t]) == [t] for t in rng.sample(tokens, 500))


def test_long_texts_and_slabs(tools):
    mine, theirs = tools
    rng = random.Random(1)
    texts = ["".join(rng.choice(PIECES + [" word", " of"] * 5) for _ in range(3000)), "x" * 20000, "", None, "one two three " * 900]
    got = bpe.encode_texts(mine, texts, slab=500)
    assert [g.tolist() for g in got] == [theirs.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_words_of_equal_hash(monkeypatch):
    raw = b"ab cd ab efg cd"
    begin, size = np.array([0, 3, 6, 9, 13]), np.array([2, 2, 2, 3, 2])
    monkeypatch.setattr(bpe.pd, "factorize", lambda h: (np.zeros(len(h), int), h[:1]))
    codes, words = bpe.distinct(raw, begin, size)
    assert [words[c] for c in codes] == ["ab", "cd", "ab", "efg", "cd"]


def test_round_trip_query(spark, tmp_path, tools):
    _, theirs = tools
    rows = [(1, "Hello  world", 1), (2, None, 2), (3, "", 3), (None, "null id", 4), (1, "Hello  world", 1), (5, "😀".encode("utf-16", "surrogatepass").decode("utf-16") + " <|endoftext|>", 5)]
    spark.createDataFrame(rows, "doc_id long, text string, ids int").write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.op1_bpe(spark, str(tmp_path)).collect()
    want = []
    for i, t, _ in rows:
        ids = theirs.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(str, map(tuple, out))) == sorted(map(str, want))


def test_place_follows_the_rule():
    lengths = np.sort(np.random.RandomState(0).randint(1, 41, 300))[::-1]
    at, gaps = packing.place(lengths, 40)
    count, spots = [0] * 41, {}
    for i, s in enumerate(lengths.tolist()):
        def total(change):
            c = count[:]
            for g, d in change:
                if g:
                    c[g] += d
            return sum(x * x for x in c[1:])

        options = {(g, "old"): total([(g, -1), (g - s, 1)]) for g in range(s, 41) if count[g]} | {(40, "new"): total([(40 - s, 1)])}
        gap = spots.get(at[i], 40)
        kind = "old" if at[i] in spots else "new"
        assert options[gap, kind] == min(options.values())
        if kind == "old":
            count[gap] -= 1
        if gap - s:
            count[gap - s] += 1
        spots[at[i]] = gap - s
    assert [spots[i] for i in range(len(gaps))] == gaps.tolist()


@pytest.mark.parametrize("shard", [20_000, 37])
def test_pack(spark, shard):
    rng = random.Random(2)
    rows = [(i % 150 if i % 9 else None, " ".join(rng.choice(["alpha", "beta", "gamma ray"]) for _ in range(rng.choice([0, 3, 20, 90])))) for i in range(300)] + [(7, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("piece", F.lit("x")).withColumn("ids", F.lit(1)).withColumn("shard", F.lit(0))
    found = packing.pieces(df, tokenizer_path(), capacity=64)
    out = packing.pack(found, capacity=64, shard=shard).toPandas().sort_values(["sequence_id", "offset"])
    theirs = tokenizers.Tokenizer.from_file(tokenizer_path())
    want = []
    for i, t in rows:
        ids = np.array([*theirs.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        first = (len(ids) - 1) % 64 + 1
        cuts = [0, *range(first, len(ids) + 1, 64)]
        want += [(i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
    got = [(None if r.doc_id != r.doc_id else int(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in out.itertuples()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    groups = out.groupby("sequence_id")
    assert (groups.length.sum() <= 64).all() and (out.offset == groups.length.cumsum() - out.length).all()
    best = -(-out.length.sum() // 64)
    assert len(groups) <= best * 1.1 + 2
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in out.itertuples())


def test_groups_stay_bounded(spark):
    """Pieces of which no two fit together are packed level by level no further than it saves sequences."""
    n, shard = 5000, 100
    rows = spark.range(n).select(F.col("id").alias("doc_id"), F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"), (F.lit(33) + F.col("id") % 20).alias("length"), F.lit(0).cast("long").alias("ids_crc32"), F.col("id").alias("deal"))
    out = packing.pack(rows, capacity=64, shard=shard)
    groups = out.groupBy(F.shiftright("sequence_id", 24)).count().collect()
    assert out.count() == n == out.select("sequence_id").distinct().count()
    assert max(r["count"] for r in groups) <= 1.5 * shard * packing.FAN
    # Small pieces among them find their places.
    mixed = rows.withColumn("length", F.when(F.col("doc_id") % 2 == 0, F.col("length")).otherwise(F.lit(4)))
    out = packing.pack(mixed, capacity=64, shard=shard)
    assert out.select("sequence_id").distinct().count() == n // 2


def test_pack_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(packing.pieces(df, tokenizer_path())).count() == 0
