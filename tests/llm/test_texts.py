"""Quality, toxicity, near duplicates, licenses, chat and the pipeline on small tables."""

import hashlib
import itertools
import random
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import chat, licenses, minhash, quality, queries, toxicity
from quire.llm.words import word_hashes

ODD = [(9001, None), (9002, ""), (9003, "  \n "), (9004, "!!!"), (9005, "!!!"), (None, "one two three four five six"), (9006, "word " * 30000)]


def prose(rng, n, words=None):
    words = words or [f"{a}{b}" for a in ("ta", "re", "mi", "so", "la") for b in ("n", "rd", "lek", "mon", "ster", "pin")]
    return " ".join(rng.choice(words) for _ in range(n))


def test_word_hashes():
    texts = ["The dog, the DOG!", None, "", "don't stop", "中文 字", "a" * 50, "a b " * 900]
    counts, whole, part = word_hashes(texts, prefix=2, slab=100)
    assert counts.tolist() == [4, 0, 0, 3, 2, 1, 1800]
    assert whole[0] == whole[2] and whole[1] == whole[3] and whole[0] != whole[1]
    marks, _, _ = word_hashes(["a!! b", "..."], marks=True)
    assert marks.tolist() == [3, 1]


def test_signatures_estimate_similarity():
    rng = random.Random(0)
    base = prose(rng, 400).split()
    texts = []
    for k in (0, 2, 10, 40, 100):
        w = base[:]
        for _ in range(k):
            w[rng.randrange(len(w))] = f"x{rng.random()}"
        texts.append(" ".join(w) + " again and again we say it" * 3)
    counts, words, _ = word_hashes(texts)
    of, h, weight = minhash.shingles(counts, words)
    sig = minhash.signatures(len(texts), of, h, weight)
    edge = np.searchsorted(of, np.arange(len(texts) + 1))
    sets = [(h[a:b], weight[a:b]) for a, b in zip(edge, edge[1:], strict=False)]
    for i, j in itertools.combinations(range(len(texts)), 2):
        a, b = (dict(zip(x.tolist(), y.tolist(), strict=True)) for x, y in (sets[i], sets[j]))
        want = sum(1 / sum(max(a.get(k, 0) / a[d], b.get(k, 0) / b[d]) for k in a.keys() | b.keys()) for d in a.keys() & b.keys())
        assert abs(minhash.similarity(sets[i], sets[j]) - want) < 1e-9
        assert abs((sig[i] == sig[j]).mean() - want) < 0.2


def near_groups(rows, least=0.8):
    texts = [t or "" for _, t in rows]
    counts, words, _ = word_hashes(texts)
    of, h, weight = minhash.shingles(counts, words)
    edge = np.searchsorted(of, np.arange(len(texts) + 1))
    sets = [(h[a:b], weight[a:b]) for a, b in zip(edge, edge[1:], strict=False)]
    top = list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        same = not len(sets[i][0]) and texts[i] == texts[j] and texts[i].strip()
        if same or len(sets[i][0]) and minhash.similarity(sets[i], sets[j]) >= least:
            a, b = sorted((find(i), find(j)), key=lambda x: rows[x][0])
            top[b] = a
    return {rows[i][0]: rows[find(i)][0] for i in range(len(rows))}


@pytest.mark.parametrize("tile,chunk", [(1_000_000, 64), (1500, 2)])
def test_near_duplicates(spark, monkeypatch, tile, chunk):
    monkeypatch.setattr(minhash, "TILE", tile)
    monkeypatch.setattr(minhash, "CHUNK", chunk)
    rng = random.Random(5)
    rows = []
    for g in range(12):
        base = prose(rng, rng.choice([5, 60, 200])).split()
        for _ in range(rng.choice([1, 4, 12])):
            w = base[:]
            for _ in range(rng.choice([0, 1, 3])):
                w[rng.randrange(len(w))] = rng.choice(["edit", "other", "third"])
            rows.append((len(rows), " ".join(w)))
    rows += [(500 + i, "Short text") for i in range(5)] + [(510, "short TEXT!")] + [r for r in ODD if r[0]]
    df = spark.createDataFrame(rows + [(None, "x")] + rows[:3], "doc_id long, text string").withColumn("bands", F.lit(1))
    got = [tuple(r) for r in minhash.groups(df).collect()]
    assert dict(got) == near_groups(rows) and len(got) == len(rows) + 3  # null ids take no part
    assert minhash.groups(df.limit(0)).count() == 0


def toxic_rows(rng, n):
    rows = []
    for i in range(n):
        bad = i % 5 == 0
        w = prose(rng, 120, [f"{a}{b}" for a in ("ta", "re", "mi", "so", "la", "ku", "be") for b in ("n", "rd", "lek", "mon", "ster", "pin", "val")]).split()
        for _ in range(6 * bad):
            w.insert(rng.randrange(len(w)), rng.choice(["horrid", "wretch", "vilest", "loathly"]))
        rows.append((i, " ".join(w), int(bad)))
    return rows


def test_toxicity(spark):
    rows = toxic_rows(random.Random(7), 400)
    docs = spark.createDataFrame([r[:2] for r in rows] + ODD, "doc_id long, text string").withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(1, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    out = toxicity.score(docs, model).select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted").collect()
    truth = {r[0]: r[2] for r in rows}
    held = [r for r in out if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out if r.doc_id is not None)
    assert len(out) == len(rows) + len(ODD) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) >= 0.95
    assert all(r.predicted == 0 for r in out if r.doc_id not in truth)
    # Rows that are held out teach nothing.
    other = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.fit(docs, other) == model
    blank = toxicity.fit(docs.limit(0), labels)
    assert {r.score for r in toxicity.score(docs, blank).collect()} == {0.0}


def test_toxicity_lengths():
    """Distances by plain compression of each window under the two dictionaries, which zstandard has trained."""
    import zstandard as z

    rows = toxic_rows(random.Random(3), 300)
    model = toxicity.train([t for _, t, bad in rows if bad], [t for _, t, bad in rows if not bad])
    assert model.ordinary and model.toxic.startswith(model.ordinary) and len(model.toxic) > len(model.ordinary)
    texts = [rows[0][1] + " " + rows[1][1], rows[2][1], "", None, "one", prose(random.Random(1), 700)]
    params = toxicity.parameters()
    size = lambda data, d: len(z.ZstdCompressor(dict_data=z.ZstdCompressionDict(d, dict_type=z.DICT_TYPE_RAWCONTENT), compression_params=params).compress(data))
    for text, got in zip(texts, model.distance(texts), strict=True):
        codes = toxicity.codes_of([text])[1]
        starts = [i for i in range(0, len(codes), toxicity.STRIDE) if i == 0 or i + toxicity.WINDOW - toxicity.STRIDE < len(codes)]
        windows = [codes[i : i + toxicity.WINDOW].tobytes() for i in starts]
        assert got == max([0, *(size(w, model.ordinary) - size(w, model.toxic) for w in windows)])
    assert toxicity.train(["a b"], ["c d"]).score(["a b c d"])[0] <= 1  # too little for a trainer


def test_toxicity_of_nothing(spark):
    rows = toxic_rows(random.Random(5), 60)
    model = toxicity.train([t for _, t, bad in rows if bad], [t for _, t, bad in rows if not bad])
    none = spark.createDataFrame([], "doc_id long, text string, predicted string")
    assert toxicity.score(none, model).count() == 0


def test_toxicity_windows(monkeypatch):
    """Each passage of half a window's words lies whole in some window, wherever it stands."""

    class Seen(list):
        def compress(self, window):
            self.append(window)
            return window

    for n in (0, 1, 64, 127, 128, 129, 192, 193, 1000):
        seen = Seen()
        monkeypatch.setattr(toxicity, "compressors", lambda *_: (seen, Seen()))  # noqa: B023
        text = " ".join(f"w{i}" for i in range(n))
        data = toxicity.codes_of([text])[1].tobytes()
        toxicity.Model(b"x", b"y", 1.0, 0.0).distance([text])
        assert all(len(w) <= toxicity.WINDOW * 16 for w in seen)
        half = toxicity.WINDOW // 2
        assert all(any(data[i * 16 : (i + half) * 16] in w for w in seen) for i in range(max(n - half + 1, min(n, 1))))


def test_quality(spark):
    rng = random.Random(9)
    rows = [(i, prose(rng, 60) if i % 6 else " ".join(f"{w}$$$" for w in prose(rng, 60).split()), int(bool(i % 6))) for i in range(300)]
    docs = spark.createDataFrame([r[:2] for r in rows] + ODD + [rows[1][:2]], "doc_id long, text string").withColumn("kept", F.lit(5))
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows[:150]], "doc_id long, quality int")
    out = quality.resample(docs, labels).collect()
    noise = {r[0]: ((r[1] % (1 << 52)) + 0.5) / (1 << 52) for r in docs.select("doc_id", F.xxhash64("doc_id", F.lit(quality.SEED))).collect()}
    truth = {r[0]: r[2] for r in rows}
    assert len(out) == len(docs.collect()) and all(r.kept == bool(truth[r.doc_id]) for r in out if r.doc_id in truth)
    assert {r.log_weight for r in out if r.doc_id in (9001, 9002, 9003)} == {0.0}
    # The model's counts by plain counting.
    model = quality.fit(docs, labels)
    n, at = quality.grams([r[1] for r in rows] + [t for _, t in ODD] + [rows[1][1]])
    raw = 1 + np.bincount(at, minlength=quality.BUCKETS)
    good = np.repeat([i < 150 and truth.get(i) == 1 for i in [r[0] for r in rows]] + [False] * len(ODD) + [True], n)
    target = 1 + np.bincount(at[good], minlength=quality.BUCKETS)
    assert np.allclose(model.ratio, np.log(target / target.sum()) - np.log(raw / raw.sum()))
    # Weights of whole texts, by plain sums over each text's n-grams; empty texts weigh 0.
    plain = {i: quality.LENGTH * sum(model.ratio[b] for b in quality.grams([t])[1]) / (len(quality.grams([t])[1]) + quality.PRIOR) for i, t, _ in rows}
    assert all(abs(r.log_weight - plain[r.doc_id]) < 1e-6 for r in out if r.doc_id in plain)
    # The draw is exactly the top k of weight and noise, for any share, and the noise takes part in it.
    assert model.share == np.mean([r[2] for r in rows[:150]])
    for keep in (None, 0.5, 1.0):
        told = quality.resample(docs, labels, keep=keep).collect()
        k = round((model.share if keep is None else keep) * len(told))
        least = sorted((r.log_weight - np.log(-np.log(noise[r.doc_id])) for r in told), reverse=True)[k - 1]
        assert all(r.kept == (r.gumbel_key >= least - 1e-9) for r in told)
        if keep == 0.5:
            border = sorted((r.log_weight for r in told), reverse=True)[k - 1]
            assert any(r.kept != (r.log_weight >= border) for r in told)
    assert quality.resample(docs.limit(0), labels).count() == 0
    assert {r.kept for r in quality.resample(docs, labels, keep=0.0).collect()} == {False}
    assert quality.resample(docs, labels.limit(0)).count() == len(out)


@pytest.mark.parametrize("parts", [2, 5, 4096])
def test_kth_highest(spark, parts):
    rng = random.Random(1)
    x = [rng.gauss(0, 3) for _ in range(500)] + [1.5] * 40 + [1e9, -1e9]
    df = spark.createDataFrame([(v,) for v in x], "k double")
    for k in (1, 2, 77, 300, len(x)):
        assert quality.kth_highest(df, "k", k, parts) == sorted(x, reverse=True)[k - 1]
    assert quality.kth_highest(df, "k", 0) == float("inf")


def test_licenses(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"
    rows = [
        (1, "a/LICENSE", f"The MIT License\n\n{mit}"), (2, "a/b/c/x.py", "code"), (3, "a/b/COPYING", "This work is licensed under the GNU General Public License, version 3."), (4, "a/y.py", "print()\n# Released under the BSD 3-Clause License.\nmore code here"),
        (5, "z/q.txt", None), (6, None, ""), (7, "ab/x", "not licensed, nor public"), (8, "x", "All rights reserved."), (8, "x", "All rights reserved."), (None, "w/k", "Licensed under CC BY-NC 4.0."),
    ]
    df = spark.createDataFrame(rows, "doc_id long, path string, text string").withColumn("license", F.lit("clash"))
    got = [(r.doc_id, r.path, r.license, r.origin, r.inherited_from) for r in licenses.scan(df).collect()]
    want = [(1, "a/LICENSE", "MIT", "own", None), (2, "a/b/c/x.py", "GPL-3.0", "inherited", "a/b"), (3, "a/b/COPYING", "GPL-3.0", "own", None), (4, "a/y.py", "BSD-3-Clause", "own", None), (5, "z/q.txt", "Proprietary", "inherited", ""), (6, None, None, None, None), (7, "ab/x", "Proprietary", "inherited", ""), (8, "x", "Proprietary", "own", None), (8, "x", "Proprietary", "own", None), (None, "w/k", "CC-BY-NC-4.0", "own", None)]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert licenses.scan(df.limit(0)).count() == 0


NOTICES = [
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "# This program is free software; you can redistribute it and/or\n# modify it under the terms of the GNU General Public License\n# as published by the Free Software Foundation; either version 2\n# of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("CC-BY-SA-4.0", "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/by-sa/4.0/ or send a letter to Creative Commons, PO Box 1866, Mountain View, CA 94042, USA."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("GPL-3.0", "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/>\n Everyone is permitted to copy and distribute verbatim copies\n of this license document, but changing it is not allowed."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\n3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
]


def test_license_notices(spark):
    """Notices as they are published, with all that stands behind the templates' words."""
    rows = [(i, None, text) for i, (_, text) in enumerate(NOTICES)]
    got = {r.doc_id: r.license for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, path string, text string")).collect()}
    assert got == {i: name for i, (name, _) in enumerate(NOTICES)}


def test_whole_licenses(spark):
    """Licence files of several paragraphs are recognised by their text alone, and their directories inherit."""
    files = {f.stem: f.read_text() for f in sorted((Path(licenses.__file__).parent / "licence_texts").glob("*.txt"))}
    rows = [row for name, text in files.items() for row in ((name, f"{name}/1", text.replace("year", "2024").replace("name", "A. Person", 1)), (f"{name} file", f"{name}/sub/2", "nothing of note"))]
    rows.append(("prose", "prose/1", "the work of a person that may be free, and the terms of the work, " * 50))
    rows.append(("prose file", "prose/2", "nothing of note"))
    got = {r.doc_id: (r.license, r.origin) for r in licenses.scan(spark.createDataFrame(rows, "doc_id string, path string, text string")).collect()}
    want = {name: (name, "own") for name in files} | {f"{name} file": (name, "inherited") for name in files} | {"prose": (None, None), "prose file": (None, None)}
    assert got == want


def test_pruning_loses_nothing(spark):
    """Every unit whose cosine, by plain sums, reaches the bound with a template and that has one of its words that isn't common
    passes all conditions; so does a whole licence."""
    table, unseen = licenses.weights()
    idf = {t: f for _, _, t, _, f in table}
    templates: dict = {}
    for i, _, t, w, _ in table:
        templates.setdefault(i, {})[t] = w
    rng = random.Random(0)
    units = [text.lower() for _, text in licenses.TEMPLATES]
    for _ in range(400):
        words = rng.choice(licenses.TEMPLATES)[1].lower().split()
        keep = [w for w in words if rng.random() < rng.choice([0.3, 0.6, 0.9])] + rng.choices(["the", "zebra", "of", "x-y", "software"], k=rng.randint(0, 4))
        rng.shuffle(keep)
        units.append(" ".join(keep))
    df = spark.createDataFrame([(i, u) for i, u in enumerate(units)], "i int, unit string").withColumn("terms", licenses.words("unit"))
    told = df.select("i", "terms", F.expr(licenses.hopeful("unit", licenses.needs())).alias("a"), F.expr(licenses.may_reach("terms", licenses.LEAST)).alias("b"))
    near = 0
    for r in told.collect():
        v = {t: r.terms.count(t) * idf.get(t, unseen) for t in r.terms}
        norm = sum(x * x for x in v.values()) ** 0.5 or 1
        for mine in templates.values():
            if sum(v.get(t, 0) * w for t, w in mine.items()) / norm >= licenses.LEAST and set(v) & set(mine) - licenses.COMMON:
                near += 1
                assert r.a and r.b, units[r.i]
    assert near > 200
    files = [(f.stem, f.read_text().lower()) for f in sorted((Path(licenses.__file__).parent / "licence_texts").glob("*.txt"))]
    known = licenses.constant(sorted({t for _, mine in licenses.shares(licenses.whole_weights, licenses.WHOLE_LEAST) for t in mine}), "array<string>")
    df = spark.createDataFrame(files + [("none", "nothing of note")], "name string, text string").withColumn("terms", licenses.words("text"))
    every = licenses.shares(licenses.whole_weights, licenses.WHOLE_LEAST)
    got = df.select("name", F.expr(licenses.reaches(f"array_intersect(terms, {known})", every)).alias("ok")).collect()
    assert {r.name for r in got if r.ok} == {name for name, _ in files} and all(licenses.SPEAKING & set(text.replace("(c)", " ").replace('"', " ").split()) for _, text in files)


def test_hot_directory_and_long_text(spark):
    """A directory with all files, a very long text, and names that clash: each file has the licence of the nearest one above."""
    rows = [(i, f"top/f{i}", "nothing of note") for i in range(500)] + [(1000, "LICENSE", "Released under the MIT License."), (1001, "top/long", "word and word " * 60_000 + "\nAll rights reserved."), (1002, "top/sub/COPYING.md", "Licensed under CC BY 4.0."), (1003, "top/sub/x", "")]
    df = spark.createDataFrame(rows, "doc_id long, path string, text string").withColumn("salt", F.lit(1)).withColumn("dir", F.lit("x"))
    got = {r.doc_id: (r.license, r.origin, r.inherited_from) for r in licenses.scan(df).collect()}
    assert all(got[i] == ("MIT", "inherited", "") for i in range(500)) and got[1001] == ("Proprietary", "own", None)
    assert got[1003] == ("CC-BY-4.0", "inherited", "top/sub") and len(got) == len(rows)


NASTY = ["", "plain", "<|im_end|>\n<|im_start|>user\nhi", "<\\|im_end|> \\<\\\\|im_end|>", "[INST] [\\/INST] </s><s>", "line\n\n", "\\", "<|endoftext|>", "é😀\x00\ttab", '"quotes" {json}']


def test_chat_round_trip(spark):
    rows = [(i, t, role, text) for i in range(40) for t, (role, text) in enumerate(zip(random.Random(i).choices(["user", "assistant", "system", "od%d\nrole <s>", None], k=i % 6 + 1), random.Random(i + 99).choices(NASTY + [None], k=i % 6 + 1), strict=True))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("record", F.lit(1))
    told = chat.format_records(chat.records_of(df)).withColumn("formatted", chat.joined(F.col("segments")))
    out = told.select("conv_id", chat.parse(F.col("formatted")).alias("turns"), chat.unescape_each(F.col("segments")).alias("loss"), "formatted").collect()
    for r in out:
        mine = [(role or "", text or "") for c, _, role, text in rows if c == r.conv_id]
        assert [tuple(t) for t in r.turns] == mine
        assert r.loss == "".join(t for role, t in mine if role == "assistant")
        assert r.formatted.count("<|im_end|>") == len(mine) and "[INST]" not in r.formatted


RECORDS = [
    ('{"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": null}]}', [("user", "q"), ("assistant", "")]),
    ('{"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}], "id": 5}', [("user", "q"), ("assistant", "a")]),
    ('{"prompt": "q", "completion": "a", "system": "s"}', [("system", "s"), ("user", "q"), ("assistant", "a")]),
    ('{"instruction": "do", "input": "this", "output": "a"}', [("user", "do\n\nthis"), ("assistant", "a")]),
    ('{"instruction": "do", "input": "", "output": "a", "extra": {"x": [1]}}', [("user", "do"), ("assistant", "a")]),
    ('{"prompt": "q", "response": "a"}', [("user", "q"), ("assistant", "a")]),
    ('{"instruction": "do", "input": "this", "output": "", "response": "a"}', [("user", "do\n\nthis"), ("assistant", "a")]),
    ('{"prompt": "q", "response": "a", "instruction": ""}', [("user", "q"), ("assistant", "a")]),
    ('{"prompt": "q", "response": "a", "instruction": "be kind"}', [("system", "be kind"), ("user", "q"), ("assistant", "a")]),
    ('{"conversations": [{"from": "human", "value": "q \\" {x: [1]} \\\\"}], "messages": []}', [("user", 'q " {x: [1]} \\')]),
    ('{"messages": [{"role": "user", "content": [{"type": "text", "text": "one"}, {"type": "text", "text": " two"}]}]}', [("user", "one two")]),
    ('{"prompt": "{\\"messages\\": []}", "completion": ""}', [("user", '{"messages": []}'), ("assistant", "")]),
    ('{"unknown": 1}', []), ("[1]", []), ("oops", []), (None, []), ('{"messages": []}', []),
]


def test_layouts(spark):
    df = spark.createDataFrame([(i, r) for i, (r, _) in enumerate(RECORDS)], "conv_id long, record string")
    got = {r.conv_id: [tuple(t) for t in r.t] for r in df.select("conv_id", chat.canonical(F.col("record")).alias("t")).collect()}
    assert got == {i: want for i, (_, want) in enumerate(RECORDS)}


def test_paths_are_the_records_own(spark):
    """Paths by a plain walk over the parsed record; what no mapping takes is reported by a null layout."""
    import json

    def walk(x, at=""):
        if isinstance(x, dict):
            return set().union(*(walk(v, f"{at}.{k}" if at else k) for k, v in x.items())) if x else set()
        if isinstance(x, list):
            return set().union(*(walk(v, at + "[]") for v in x)) if x else set()
        return {at} if x is not None else set()

    records = [r for r, _ in RECORDS] + ['{"a": {"b": [{"c": 1, "d": [true]}, {"c": 2}], "e f": {"g": "x:, {]"}}, "h": [[1, 2], [3]], "i": null, "j": {}}', '{ "k" : "v" , "l" : [ "m" , "" ] }']
    df = spark.createDataFrame([(i, r) for i, r in enumerate(records)], "conv_id long, record string").withColumn("layout", F.lit("clash"))
    got = {r.conv_id: r.p for r in df.select("conv_id", chat.paths(F.col("record")).alias("p")).collect()}
    for i, r in enumerate(records):
        try:
            parsed = json.loads(r) if r is not None else None
        except ValueError:
            parsed = None
        assert got[i] == (sorted(walk(parsed)) if isinstance(parsed, dict) else None), r
    told = {r.conv_id: r.layout for r in chat.format_records(df).collect()}
    assert all((told[i] is None) == (not turns) for i, (_, turns) in enumerate(RECORDS))
    assert chat.format_records(df.limit(0)).count() == 0


def test_chat_long_turn(spark):
    """A turn of more characters than the reader of JSON allows by itself comes back with its neighbours."""
    long = F.repeat(F.lit("x"), 20_100_000)
    rows = spark.range(1).select(F.explode(F.array(F.struct(F.lit(0).alias("turn"), F.lit("user").alias("role"), F.lit("short").alias("text")), F.struct(F.lit(1).alias("turn"), F.lit("tool").alias("role"), long.alias("text")))).alias("x")).select(F.lit(1).alias("conv_id"), "x.*")
    turns = chat.records_of(rows).select(chat.canonical(F.col("record")).alias("t"))
    assert [tuple(r) for r in turns.select(F.explode(F.transform("t", lambda x: F.struct(x["role"], F.length(x["text"])))).alias("x")).select("x.*").collect()] == [("user", 5), ("tool", 20_100_000)]


def test_chat_query(spark, tmp_path):
    rows = [(4, 1, "assistant", "b"), (4, 0, "user", None), (4, 1, "assistant", "a"), (None, 0, "user", "x")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in queries.op7_chat(spark, str(tmp_path)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert (got[4].n_turns, got[4].turns_sha256, got[4].loss_chars, got[4].loss_sha256) == (3, sha("user\n\nassistant\na\nassistant\nb\n"), 2, sha("ab"))
    said = "</s>[INST] ok [/INST]"
    assert (got[-1].n_turns, got[-1].turns_sha256, got[-1].loss_sha256) == (2, sha(f"user\n{said}\nassistant\n{said}\n"), sha(said)) and set(got) == {4, -1, None}


def test_pipeline(spark, tmp_path):
    import corpus_pipeline as p

    rng = random.Random(11)
    rows = [(i, t, "en", "s", len(t), bad) for i, t, bad in toxic_rows(rng, 150)]
    junk = [(1000 + i, " ".join(f"{w}$$$" for w in prose(rng, 60).split()), "en", "s", 1, 0) for i in range(30)]
    copies = [(2000 + i, rows[5 * i + 1][1] + ("" if i % 2 else " end"), "en", "s", 1, 0) for i in range(20)]
    rows = rows + junk + copies
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([r[:5] for r in rows] + [(None, "left alone here", "en", "s", 1)], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(r[0], int(r[0] < 1000 or r[0] >= 2000), r[5]) for r in rows], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = []
    for k, (_, stage) in enumerate(p.STAGES[:-1]):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        kept.append({r.doc_id for r in docs.collect()})
    assert not kept[0] & {r[0] for r in junk} and {r[0] for r in rows if r[5] == 0} - {r[0] for r in junk} <= kept[0] | {None}
    assert len({r[0] for r in rows if r[5]} & kept[1]) <= 3 and len(kept[0] - kept[1] - {r[0] for r in rows if r[5]}) <= 1
    clean = [(r[0], r[1]) for r in rows if r[0] in kept[1]]
    assert kept[2] - {None} == set(near_groups(clean).values()) and None in kept[2]
    packed = p.run(spark, str(tmp_path))
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == kept[2]
