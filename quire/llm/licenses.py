"""Operator 2: license scans, in DataFrame operations only.

Texts are cut into units: sentences, lines, and paragraphs between blank lines. A unit's TF-IDF vector is
compared by cosine with those of license templates; its best template of at least ``LEAST`` is its license, and
a file's is that of its best unit. Common words alone make no match: one of the words in common has to be another. Inverse document frequencies are the templates'; any other word counts as one
that no template has. Vectors are kept sparse, as rows of (unit, term).

Only texts, and then units, that have rare terms enough of some template are scored: enough is what it takes to reach
``LEAST`` if all of the template's common words were there too, so nothing is lost. Rare terms are found in one pass
over a text; all words are found in the few units left alone, which are written to the shared folder.

Beside that, a whole text is compared with the whole texts in ``licence_texts``, with weights of their own; from
``WHOLE_LEAST`` on this is a match like a unit's. This takes place for texts with one of the words ``SPEAKING``. The bound is high, since legal texts share most of their words. The
SQL leaves this match out.

A licence file is one named like one, or one whose whole text is near a template. Files without a license of
their own inherit from the nearest directory above that holds a licence file: each distinct directory is
joined with its ancestors' licences once, files then with their directory, dealt to ``SALTS`` keys each, so that a
directory with very many files isn't one task's.

A file with the opening of the BSD licences has the 3-clause one if it has its third clause too.

Defined cases: null and empty texts have no license of their own; a null path is in no directory; of equal
scores the name that sorts first wins, of several licence files of a directory that of the highest score, then
of the smallest path; repeated rows and ids come back as they are, rows with equal ids and paths sharing
their best license; extra columns don't come along.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from collections.abc import Callable
from functools import lru_cache
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, written

LEAST, WHOLE_LEAST, SALTS = 0.65, 0.9, 16

# Names and wording of public licences and their notices.
TEMPLATES = [
    ("AGPL-3.0", "GNU Affero General Public License, version 3, 19 November 2007"),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-NC-ND-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("CC0-1.0", "CC0 1.0 Universal"),
    ("GPL-2.0", "GNU General Public License, version 2, June 1991"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "GNU General Public License, version 3, 29 June 2007"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-2.1", "GNU Lesser General Public License, version 2.1, February 1999"),
    ("LGPL-2.1", "This library is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "GNU Lesser General Public License, version 3, 29 June 2007"),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Proprietary", "All rights reserved."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
]
#: Licences whose notice begins with the other's: a file with templates of both has the longer one.
LONGER = {"BSD-2-Clause": "BSD-3-Clause"}
LICENCE_FILE = r"(?i)(^|/)(un)?(licen[cs]e|copying|copyright)([.-][^/]*)?$"
TERM = r"[\p{L}\p{N}]+(?:[.-][\p{L}\p{N}]+)*"
TERM_PY = r"[^\W_]+(?:[.-][^\W_]+)*"
UNITS = (r"(?<=[.!?;:])\s+|\n", r"\n", r"\n\s*\n")


#: A whole text is compared with whole licences if it has one of these words; each of these licences has.
SPEAKING = {"copyright", "license", "permission", "software"}
#: Words of any text: the last to count as rare, since most texts have them. They don't change any score.
COMMON = set("a and any are as at be but by can copy do each file files for form free from had has have he her his i if in into is it its list may mean met must no nor not of on one or our person see so such that the their they this to under us use used v was we were which will with without work all you your".split())


Weights = tuple[list[tuple[int, str, str, float, float]], float]


def weights_of(templates: list[tuple[str, str]]) -> Weights:
    """(template, license, term, weight, inverse document frequency) with each template's weights of length one, and
    the inverse document frequency of a word in no template."""
    terms = [Counter(re.findall(TERM_PY, text.lower())) for _, text in templates]
    n = len(terms)
    spread = Counter(t for c in terms for t in c)
    idf = {t: math.log((1 + n) / (1 + k)) + 1 for t, k in spread.items()}
    out = []
    for i, c in enumerate(terms):
        norm = math.sqrt(sum((k * idf[t]) ** 2 for t, k in c.items()))
        out += [(i, templates[i][0], t, k * idf[t] / norm, idf[t]) for t, k in sorted(c.items())]
    return out, math.log(1 + n) + 1


def weights() -> Weights:
    return weights_of(TEMPLATES)


@lru_cache(1)
def whole_weights() -> Weights:
    """The same of whole licences."""
    return weights_of([(f.stem, f.read_text("utf-8")) for f in sorted((Path(__file__).parent / "licence_texts").glob("*.txt"))])


Needs = list[tuple[float, dict[str, float]]]


def needs(least: float = LEAST, of: Callable[[], Weights] = weights) -> Needs:
    """For each template the squared weights of its rare terms, and how much of them a unit has to have to reach least if all
    of the template's common words are there; at least one rare term in any case."""
    templates: dict[int, dict[str, float]] = {}
    for i, _, t, w, _ in of()[0]:
        templates.setdefault(i, {})[t] = w * w
    split = [({t: w for t, w in mine.items() if t not in COMMON}, sum(w for t, w in mine.items() if t in COMMON)) for mine in templates.values()]
    return [(max(least * least - left, 1e-4), rare) for rare, left in split]


def pattern(terms: set[str]) -> str:
    """A regular expression of terms as whole words, by their first letters, longer ones first."""
    by: dict[str, list[str]] = {}
    for t in sorted(terms, key=lambda t: (-len(t), t)):
        by.setdefault(t[0], []).append(re.escape(t[1:]).replace("/", r"\/"))
    return r"(?<![\p{L}\p{N}])(?:" + "|".join(f"{re.escape(c)}(?:{'|'.join(x)})" for c, x in sorted(by.items())) + r")(?![\p{L}\p{N}])"


def constant(values: object, kind: str) -> str:
    """A constant array or map in Spark's SQL, as one expression however many values it has."""
    return f"from_json(r'{json.dumps(values)}', '{kind}')"


def reaches(found: str, need: Needs) -> str:
    """SQL that tells whether an array of distinct terms has terms enough of some template: one pass over it, with a sum for
    each template."""
    rows: dict[str, list[float]] = {}
    for i, (_, rare) in enumerate(need):
        for t, w in rare.items():
            rows.setdefault(t, [0.0] * len(need))[i] = w
    sums = f"aggregate({found}, array_repeat(0D, {len(need)}), (a, w) -> zip_with(a, {constant(dict(sorted(rows.items())), 'map<string,array<double>>')}[w], (p, q) -> p + q))"
    return f"exists(zip_with({sums}, {constant([least - 1e-6 for least, _ in need], 'array<double>')}, (p, q) -> p >= q), x -> x)"


def rare_terms(text: str, need: Needs) -> str:
    """SQL for the rare terms that a text has. Terms inside longer ones count as well, which lets more through, never less."""
    return f"array_distinct(regexp_extract_all({text}, r'{pattern({t for _, rare in need for t in rare})}', 0))"


def hopeful(text: str, need: Needs) -> str:
    """SQL that tells whether a text has rare terms enough of some template."""
    return f"get(transform(array({rare_terms(text, need)}), t -> size(t) > 0 AND {reaches('t', need)}), 0)"


def words(text: Column | str) -> Column:
    return F.regexp_extract_all(text, F.lit(TERM), F.lit(0))


def may_reach(terms: str, least: float) -> str:
    """SQL that tells whether a unit's cosine with any template can reach least: no more than the share of its length that
    lies in the templates' terms, where each other word counts at least once. Computed within the row, so that few
    units have their words moved. A word is counted by what is missing when it is taken out of all words."""
    table, unseen = weights()
    idf = {t: f for _, _, t, _, f in table}
    known = constant(sorted(idf), "array<string>")
    times = "(length(j) - length(replace(j, concat(' ', w, ' '), ''))) / (length(w) + 2)"
    square = f"aggregate(k, 0D, (s, w) -> s + pow({times} * {constant(dict(sorted(idf.items())), 'map<string,double>')}[w], 2))"
    bound = f"get(transform(array({square}), q -> q >= {least * least - 1e-6!r}D * (q + {unseen * unseen!r}D * (size(array_distinct({terms})) - size(k)))), 0)"
    return f"get(transform(array(concat(' ', array_join({terms}, '  '), ' ')), j -> get(transform(array(array_intersect({terms}, {known})), k -> {bound}), 0)), 0)"


def shares(of: Callable[[], Weights], least: float) -> Needs:
    """For each template the squared weights of all its terms, and their sum that a text needs to reach least."""
    templates: dict[int, dict[str, float]] = {}
    for i, _, t, w, _ in of()[0]:
        templates.setdefault(i, {})[t] = w * w
    return [(least * least, mine) for mine in templates.values()]


def scores(spots: DataFrame, least: float, of: Callable[[], Weights]) -> DataFrame:
    """(id, path, whole, license, score) of units, for each template that they are near."""
    spark = spots.sparkSession
    table, unseen = of()
    counted = spots.withColumn("term", F.explode("terms")).groupBy("id", "path", "unit", "whole", "term").agg(F.count(F.lit(1)).alias("n"))
    # Some thousands of fixed rows at most.
    known = F.broadcast(spark.createDataFrame([r[2:3] + r[4:] for r in {(0, "", t, 0, f) for _, _, t, _, f in table}], "term string, idf double"))
    templates = F.broadcast(spark.createDataFrame([(i, name, t, w) for i, name, t, w, _ in table], "template int, license string, term string, weight double"))
    # A unit that repeats in a file counts its words again, in the same proportion.
    valued = counted.join(known, "term", "left").withColumn("value", F.col("n") * F.coalesce("idf", F.lit(unseen)))
    norms = valued.groupBy("id", "path", "unit", "whole").agg(F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("norm"), F.collect_list(F.when(F.col("idf").isNotNull(), F.struct("term", "value"))).alias("terms"))
    dots = norms.select("id", "path", "unit", "whole", "norm", F.explode("terms").alias("x")).select("id", "path", "unit", "whole", "norm", "x.term", "x.value").join(templates, "term")
    scored = dots.groupBy("id", "path", "unit", "whole", "norm", "template", "license").agg(F.sum(F.col("value") * F.col("weight")).alias("dot"), F.bool_or(~F.col("term").isin(*sorted(COMMON))).alias("rare")).where("rare")
    return scored.select("id", "path", "whole", "license", F.round(F.col("dot") / F.col("norm"), 6).alias("score")).where(F.col("score") >= least)


def units(text: Column) -> Column:
    parts = [F.split(text, p) for p in UNITS]
    return F.array_distinct(F.concat(*parts))


def scan(df: DataFrame, id_col: str = "doc_id", path_col: str = "path", text_col: str = "text", least: float = LEAST) -> DataFrame:
    """(id, path, license, score, origin, inherited_from): origin is own, inherited or null."""
    files = df.select(F.col(id_col).alias("id"), F.col(path_col).cast("string").alias("path"), F.lower(F.col(text_col).cast("string")).alias("text"))
    # One pass over all texts: candidate units, and the whole text if it speaks of licences, with their words. Few are left.
    need = needs(least)
    every = shares(whole_weights, WHOLE_LEAST)
    known = constant(sorted({t for _, mine in every for t in mine}), "array<string>")
    some = files.withColumn("found", F.expr(rare_terms("text", need))).where("size(found) > 0").withColumn("units", F.when(F.expr(reaches("found", need)), units(F.col("text"))))
    near = F.expr(f"transform(filter(coalesce(units, array()), u -> {hopeful('u', need)}), u -> struct(true AS part, u AS unit))")
    entire = F.expr(f"filter(array(struct(false AS part, text AS unit)), x -> arrays_overlap(found, {constant(sorted(SPEAKING), 'array<string>')}))")
    spots = some.select("id", "path", "text", F.explode(F.concat(near, entire)).alias("x")).select("id", "path", "x.part", (F.trim("x.unit") == F.trim("text")).alias("whole"), F.xxhash64("x.unit").alias("unit"), words("x.unit").alias("terms"))
    spots = written(spots.where(F.expr(f"CASE WHEN part THEN {may_reach('terms', least)} ELSE {reaches(f'array_intersect(terms, {known})', every)} END")), "spots")
    scored = scores(spots.where("part"), least, weights).withColumn("part", F.lit(True)).unionByName(scores(spots.where("not part"), WHOLE_LEAST, whole_weights).withColumn("part", F.lit(False)))
    best = F.struct((-F.col("score")).alias("down"), "license")
    own = scored.groupBy("id", "path").agg(F.min(best).alias("x"), *[F.min(F.when(F.col("part") & (F.col("license") == n), best)).alias(n) for n in LONGER.values()], F.max("whole").alias("whole"))
    for short, long in LONGER.items():
        own = own.withColumn("x", F.when(F.col("x.license") == short, F.coalesce(F.col(f"`{long}`"), "x")).otherwise(F.col("x")))
    own = written(own.select("id", "path", F.col("x.license").alias("license"), (-F.col("x.down")).alias("score"), "whole"), "own")
    discard(spots)
    # Directories: of licence files, then of all files, each of these with all its ancestors.
    folder = F.regexp_replace("path", r"/?[^/]*$", "")
    sources = own.where(F.col("path").isNotNull() & (F.col("whole") | F.col("path").rlike(LICENCE_FILE)))
    sources = sources.select(folder.alias("up"), F.struct((-F.col("score")).alias("down"), "path", "license").alias("x")).groupBy("up").agg(F.min("x").alias("x"))
    dirs = files.where("path is not null").select(folder.alias("dir")).distinct()
    parts = F.split("dir", "/")
    above = dirs.select("dir", F.explode(F.concat(F.array(F.lit("")), F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/")))).alias("up"))
    nearest = above.distinct().join(sources, "up").groupBy("dir").agg(F.max(F.struct(F.length("up").alias("depth"), F.col("up"), F.col("x.license").alias("license"), (-F.col("x.down")).alias("score"))).alias("y"))
    nearest = nearest.select("dir", F.col("y.up").alias("up"), F.col("y.license").alias("dir_license"), F.col("y.score").alias("dir_score"))
    own = own.drop("whole").toDF("own_id", "own_path", "own_license", "own_score")
    # A directory with very many files is dealt to some keys; directories with a licence above them are few beside files.
    nearest = nearest.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    out = files.select("id", "path", folder.alias("dir"), F.pmod(F.xxhash64("id", "path"), F.lit(SALTS)).cast("int").alias("salt"))
    out = out.join(own, F.col("id").eqNullSafe(F.col("own_id")) & F.col("path").eqNullSafe(F.col("own_path")), "left").join(nearest, ["dir", "salt"], "left")
    has, gets = F.col("own_license").isNotNull(), F.col("dir_license").isNotNull()
    return out.select(F.col("id").alias(id_col), F.col("path").alias(path_col), F.coalesce("own_license", "dir_license").alias("license"), F.coalesce("own_score", "dir_score").alias("score"), F.when(has, "own").when(gets, "inherited").alias("origin"), F.when(~has & gets, F.col("up")).alias("inherited_from"))


def oracle(path: str, documents: str = "documents") -> str:
    """The same in DuckDB's SQL, for documents with paths by an expression."""
    table, unseen = weights()
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    common = ", ".join(map(quote, sorted(COMMON)))
    rows = ", ".join(f"({i}, {quote(n)}, {quote(t)}, {w!r}, {f!r})" for i, n, t, w, f in table)
    return rf"""
        WITH w(template, license, term, weight, idf) AS (VALUES {rows}),
        known AS (SELECT DISTINCT term, idf::DOUBLE AS idf FROM w),
        f AS (SELECT doc_id, {path} AS path, lower(text) AS text FROM {documents}),
        a AS (SELECT doc_id, path, text, unnest(list_distinct(list_concat(
                  string_split_regex(regexp_replace(text, '([.!?;:])\s+', '\1' || chr(10), 'g'), '\n'),
                  string_split(text, chr(10)), string_split_regex(text, '\n\s*\n')))) AS unit FROM f),
        u AS (SELECT doc_id, path, hash(unit) AS unit, trim(unit, ' ') = trim(text, ' ') AS whole,
                  regexp_extract_all(unit, '[\p{{L}}\p{{N}}]+(?:[.-][\p{{L}}\p{{N}}]+)*') AS terms FROM a),
        b AS (SELECT doc_id, path, unit, whole, unnest(terms) AS term FROM u),
        c AS (SELECT doc_id, path, unit, whole, term, count(*) AS n FROM b GROUP BY ALL),
        v AS (SELECT c.*, c.n * coalesce(idf, {unseen!r}::DOUBLE) AS value FROM c LEFT JOIN known USING (term)),
        norms AS (SELECT doc_id, path, unit, whole, sqrt(sum(value * value)) AS norm FROM v GROUP BY ALL),
        dots AS (SELECT doc_id, path, unit, whole, template, license, sum(value * weight::DOUBLE) AS dot FROM v JOIN w USING (term) GROUP BY ALL HAVING bool_or(term NOT IN ({common}))),
        s AS (SELECT doc_id, path, whole, license, round(dot / norm, 6) AS score FROM dots JOIN norms USING (doc_id, path, unit, whole)
              WHERE round(dot / norm, 6) >= {LEAST}),
        own AS (SELECT doc_id, path, first(license ORDER BY score DESC, license) AS license, max(score) AS score, bool_or(whole) AS whole FROM s GROUP BY ALL),
        src AS (SELECT regexp_replace(path, '/?[^/]*$', '') AS up, first(license ORDER BY score DESC, path) AS license, max(score) AS score
                FROM own WHERE whole OR regexp_matches(path, '{LICENCE_FILE}') GROUP BY 1),
        dirs AS (SELECT DISTINCT regexp_replace(path, '/?[^/]*$', '') AS dir FROM f),
        near AS (SELECT dir, first(up ORDER BY length(up) DESC) AS up, first(license ORDER BY length(up) DESC) AS license, first(score ORDER BY length(up) DESC) AS score
                 FROM dirs JOIN src ON up = '' OR dir = up OR starts_with(dir, up || '/') GROUP BY dir)
        SELECT f.doc_id, f.path, coalesce(own.license, near.license) AS license, coalesce(own.score, near.score) AS score,
            CASE WHEN own.license IS NOT NULL THEN 'own' WHEN near.license IS NOT NULL THEN 'inherited' END AS origin,
            CASE WHEN own.license IS NULL THEN near.up END AS inherited_from
        FROM f LEFT JOIN own ON f.doc_id = own.doc_id AND f.path = own.path LEFT JOIN near ON regexp_replace(f.path, '/?[^/]*$', '') = near.dir"""
