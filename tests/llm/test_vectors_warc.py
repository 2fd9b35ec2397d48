"""Top-k, grid join and components against brute force; archives against their input."""

import gzip
import io
import itertools

import numpy as np
import pytest

from quire.llm import components, gridjoin, topk, warc
from quire.llm.tiles import usable
from pyspark.sql import functions as F


def vectors(rng, n, dim=6):
    base = rng.randn(n // 3, dim)
    rows = [base[rng.randint(len(base))] + rng.randn(dim) * rng.choice([0, 0.05, 0.3]) for _ in range(n)]
    return [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(rows)]


ODD = [(1000, None), (1001, [0.0] * 6), (1002, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (1003, [float("nan")] * 6), (1004, [float("inf")] + [0.0] * 5), (1005, []), (1006, [1.0, 2.0]), (None, [1.0] * 6)]


@pytest.mark.parametrize("tile", [7, 4096])
def test_topk(spark, monkeypatch, tile):
    monkeypatch.setattr(topk, "SHARD", tile)
    monkeypatch.setattr(topk, "QUERIES", 5)
    monkeypatch.setattr(topk, "STRIP", 2)
    monkeypatch.setattr(topk, "FAN", 3)
    rows = vectors(np.random.RandomState(0), 90) + ODD + [(3, [0.5] * 6)]
    rows += [(200 + i, [0.25] * 6) for i in range(30)]  # ties
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").where(usable(F.col("embedding"))).select(F.col("vec_id").alias("id"), topk.whole(F.col("embedding")).alias("vector"))
    got = topk.search(df.where("id % 10 = 0"), df, 4).collect()
    good = [(i, np.floor(np.array(v, float) * 1024)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = set()
    for q, v in good:
        if q % 10 == 0:
            scored = sorted((-int(v @ w), i) for i, w in good if i != q and len(w) == len(v))
            want |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(scored[:4])}
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_topk_beyond_doubles_and_empty(spark):
    df = spark.createDataFrame([(0, [float(2**40 + 1), 1.0]), (1, [float(2**20 + 1), 3.0]), (2, [float(2**20), 5.0])], "id long, vector array<double>")
    got = {r.vec_id: r.score for r in topk.search(df.where("id = 0"), df).collect()}
    assert got == {1: (2**40 + 1) * (2**20 + 1) + 3, 2: (2**40 + 1) * 2**20 + 5}
    assert topk.search(df.limit(0), df.limit(0)).count() == 0


@pytest.mark.parametrize("held", [2000, 1 << 30])
def test_topk_without_broadcast(spark, monkeypatch, held):
    """Many more shard tiles than leaves, and queries in several parts: no table goes through the driver, whatever
    its estimated size. Numbers of all widths side by side, exact in each."""
    for name, value in {"SHARD": 5, "QUERIES": 4, "LEAVES": 6, "FAN": 4, "HELD": held, "TILE_BYTES": 96}.items():
        monkeypatch.setattr(topk, name, value, raising=False)
    rng = np.random.RandomState(7)
    rows = [(i, [float(rng.choice([1, 2**9, 2**20, 2**26]) * rng.randint(-9, 10) + rng.randint(-3, 4)) for _ in range(3)]) for i in range(300)]
    rows += [(400 + i, rows[0][1]) for i in range(40)] + [(600, [1.0]), (610, [2.0]), (700, []), (710, []), (720, [3.0] * 4)]
    df = spark.createDataFrame(rows, "id long, vector array<double>")
    out = topk.search(df.where("id % 10 = 0"), df, 7)
    got = [tuple(r) for r in out.collect()]
    want = set()
    for q, v in rows:
        if q % 10 == 0:
            scored = sorted((-sum(int(x) * int(y) for x, y in zip(v, w)), i) for i, w in rows if i != q and len(w) == len(v))
            want |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:7])}
    assert set(got) == want and len(got) == len(want)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "Join" not in plan


@pytest.mark.parametrize("tile,block", [(2048, 128), (9, 2)])
def test_grid_join(spark, monkeypatch, tile, block):
    monkeypatch.setattr(gridjoin, "TILE", tile)
    monkeypatch.setattr(gridjoin, "BLOCK", block)
    rows = vectors(np.random.RandomState(1), 120) + ODD[:-1] + [(500, [1.0] * 6), (501, [1.0] * 6), (502, [2.0] * 6), (503, [1e-200] * 6)]
    df = spark.createDataFrame(rows + ODD[-1:], "vec_id long, embedding array<double>").withColumn("component", F.lit("clash"))
    got = {r.vec_id: tuple(r) for r in gridjoin.join(df).collect()}
    good = {i: np.array(v, float) for i, v in rows if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    links = {i: set() for i, _ in rows}
    for a, b in itertools.combinations(good, 2):
        x, y = good[a] / np.abs(good[a]).max(), good[b] / np.abs(good[b]).max()
        if len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.9:
            links[a].add(b)
            links[b].add(a)
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        assert got[i] == (i, len(links[i]), min(seen), i == min(seen))
    assert got[None][2] is None and len(got) == len(rows) + 1
    assert gridjoin.join(df.limit(0)).count() == 0


@pytest.mark.parametrize("small", [0, 3, 10**6])
def test_components(spark, small):
    rng = np.random.RandomState(4)
    edges = [(int(a), int(b)) for a, b in rng.randint(0, 300, (200, 2))] + [(i, i + 1) for i in range(1000, 1060)] + [(2000, i) for i in range(2001, 2100)]
    parent = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((top(a), top(b)))
            parent[y] = x
    got = {r.id: r.component for r in components.components(spark.createDataFrame(edges + [(5, None)], "u long, v long"), small).collect()}
    assert got == {x: top(x) for x in parent}


PAGES = [(3, "u", "same"), (1, "http://a\nb%0A", "same"), (2, None, "same"), (4, "v", None), (5, "w", ""), (6, "x", "é" * 5000), (7, "y", "other"), (None, "n", "same"), (7, "y", "other")]


def test_warc(spark, tmp_path):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("sha", F.lit(1)).repartition(3)
    archives = warc.write(df)
    for split in (1 << 23, 64):
        got = warc.read(archives, split).collect()
        assert len(got) == len(PAGES)
        by = {}
        for r in got:
            by.setdefault(r.page_id, []).append(r)
        assert [(r.record_type, r.refers_to) for r in (by[1][0], by[2][0], by[3][0], by[None][0])] == [("response", None), ("revisit", 1), ("revisit", 1), ("revisit", 1)]
        assert [r.record_type for r in by[7]] == ["response"] * 2 and by[5][0].refers_to == 4 and by[4][0].payload_bytes == 0
        assert by[6][0].payload_bytes == 10000 and bytes(by[6][0].payload).decode() == "é" * 5000 and by[1][0].url == "http://a\nb%0A"
        assert by[2][0].payload is None and by[2][0].payload_digest == by[1][0].payload_digest == warc.digest32(b"same")
    assert warc.read(warc.write(df, least=5)).where("page_id = 2").first().record_type == "response"
    assert warc.read(warc.write(df.limit(0))).count() == 0


def test_every_byte_range_owns_its_records():
    members = [warc.record("response", i, "u", bytes([0x1F, 0x8B, 8, 0]) * (i % 7) + b"x" * i, warc.digest32(b""), i, None) for i in range(12)]
    data = b"".join(members)
    starts = [sum(map(len, members[:i])) for i in range(len(members))]
    for size in (1, 17, 100, 333):
        found = [at for a in range(0, len(data), size) for at, _, _ in warc.records(io.BytesIO(data), a, min(len(data), a + size))]
        assert found == starts
    noise = gzip.compress(b"not a record") + data[: starts[3]] + b"\x1f\x8b\x08broken" + data[starts[3] :]
    told = [*warc.records(io.BytesIO(noise), 0, len(noise))]
    assert sum(head is not None for _, head, _ in told) == len(members) and sum(head is None for _, head, _ in told) == 2


def test_damage_is_told_once():
    """A record with a broken head or body, or an archive cut short: told by exactly one range, whatever the ranges are."""
    members = [warc.record("response", i, "u", bytes(range(256)) * (i + 1), warc.digest32(b""), i, None) for i in range(6)]
    starts = [sum(map(len, members[:i])) for i in range(len(members))]
    whole = b"".join(members)
    for bad in range(6):
        for harm in ("head", "body", "cut"):
            at = starts[bad]
            if harm == "head":
                data = whole[:at] + b"\x00\x00\x00" + whole[at + 3 :]
            elif harm == "body":
                spot = at + len(members[bad]) - 6  # the checksum
                data = whole[:spot] + bytes([whole[spot] ^ 255]) + whole[spot + 1 :]
            elif bad == 5:
                data = whole[:-8]
            else:
                continue
            for size in (50, 333, 1000, len(data)):
                told = [(a, head is None) for x in range(0, len(data), size) for a, head, _ in warc.records(io.BytesIO(data), x, min(len(data), x + size))]
                assert sorted(a for a, lost in told if not lost) == starts[:bad] + starts[bad + 1 :], (bad, harm, size)
                assert [a for a, lost in told if lost] == [at], (bad, harm, size)


def test_large_record_and_report(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "x" * 3_000_000 + "é"), (2, "u", None), (3, "u", "short")], "page_id long, url string, html string").coalesce(1)
    archives = warc.write(df)
    assert {(r.page_id, r.payload_bytes) for r in warc.read(archives, 1000).collect()} == {(1, 3_000_002), (2, 0), (3, 5)}
    path = archives.first().archive.removeprefix("file://").removeprefix("file:")
    data = open(path, "rb").read()
    open(path, "wb").write(data[:-8])
    short = archives.withColumn("size", F.col("size") - 8)
    told = sorted((r.record_type, r.page_id) for r in warc.read(short, report=True).collect())
    assert [kind for kind, _ in told] == ["damaged", "response", "response"] and told[0][1] is None  # the last of the three is lost
    with pytest.raises(Exception, match="no record can be read"):
        warc.read(short).collect()
