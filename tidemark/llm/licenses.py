"""License scans in DataFrame functions only: MinHash bands over windows, then exact containment."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import materialise

WIDTH, SHORT = 5, 3  # words of a shingle, and in templates of fewer than five words
BANDS = 16  # of one row each; see `scan` for what they miss
WINDOW = 1.5  # shingles of a window for each distinct one of its template
KEYS = 100_000  # band keys of all templates at most
TEXTS = Path(__file__).with_name("license_texts")
# Notices as licences have them.
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
]
GNU = (
    "This {thing} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} as "
    "published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version."
)
# Standard headers of source files.
HEADERS = [
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
     "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", 'Unless required by applicable law or agreed to in writing, software distributed under the License is '
     'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the '
     "License for the specific language governing permissions and limitations under the License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
     "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    *[("GPL-" + v + ".0", GNU.format(thing="program", kind="General Public License", version=v)) for v in "23"],
    *[("LGPL-" + v, GNU.format(thing="library", kind="Lesser General Public License", version=v)) for v in ("2.1", "3")],
    ("AGPL-3.0", GNU.format(thing="program", kind="Affero General Public License", version="3")),
]
# Usual phrases, whatever words come before. With at most three shingles each, all of a phrase must occur.
PHRASES = [
    *[(name, f"under {the}{title} license") for name, title in (("MIT", "MIT"), ("ISC", "ISC"), ("BSD", "BSD")) for the in ("the ", "")],
    *[(name, f"under {the}{name} license") for name in ("Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0") for the in ("the ", "")],
    ("Apache-2.0", "under the Apache License, Version 2.0"),
    ("Apache-2.0", "under the Apache License 2.0"),
    ("Apache-2.0", "under Apache License 2.0"),
    ("MPL-2.0", "Mozilla Public License, v. 2.0"),
    ("MPL-2.0", "Mozilla Public License, Version 2.0"),
    ("MPL-2.0", "Mozilla Public License 2.0"),
    *[(f"GPL-{v}.0", f"the GNU General Public License, version {v}") for v in "23"],
    *[(f"GPL-{v}.0", f"the GNU General Public License v{v}") for v in "23"],
    *[(f"GPL-{v}.0", f"under {the}GPLv{v}") for v in "23" for the in ("the ", "the GNU ")],
    ("LGPL-2.1", "GNU Lesser General Public License, version 2.1"),
    ("LGPL-3", "GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "GNU Affero General Public License, version 3"),
    ("CC-BY-NC-4.0", "under CC BY-NC 4.0"),
    ("CC-BY-4.0", "under CC BY 4.0"),
    ("CC-BY-SA-4.0", "under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International"),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International"),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International"),
]
# SPDX lines; those of the GNU licences may go on with -only or -or-later.
SPDX = [
    *("MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "MPL-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "AGPL-3.0"),
    *("CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0"),
]


def notices(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(NOTICES, "template string, notice string")


def templates(spark: SparkSession) -> DataFrame:
    """The notices, standard headers, usual phrases, SPDX lines and full texts of the usual licences."""
    lines = [(name, f"SPDX-License-Identifier: {name}") for name in SPDX] + [("LGPL-3", "SPDX-License-Identifier: LGPL-3.0")]
    texts = [(path.stem, path.read_text()) for path in sorted(TEXTS.glob("*.txt"))]
    rows = [*NOTICES, *HEADERS, *PHRASES, *lines, *texts]
    return spark.createDataFrame(rows, "template string, notice string")


def shingled(text: Column) -> Column:
    """Hashes of a text's word shingles, in order; words are runs of ASCII letters and digits, in lower case."""
    words = F.filter(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), "[^a-z0-9]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def shingles(words: str, width: int) -> Column:
    w = F.col(words)
    starts = F.when(F.size(w) >= width, F.sequence(F.lit(1), F.size(w) - width + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(*[F.element_at(w, i + k) for k in range(width)]))


def dealt(values: Column, band: int) -> Column:
    return F.transform(values, lambda h: F.struct(F.xxhash64(h, F.lit(band)).alias("least"), h.alias("h")))


def band_keys(values: Column, size: Column) -> Column:
    """A key of each band: the least of the values' hashes."""
    least = (F.array_min(dealt(values, i))["least"] for i in range(BANDS))
    return F.array(*[F.xxhash64(size, F.lit(i), key) for i, key in enumerate(least)])


def anchors(values: Column) -> Column:
    """The values that give the keys of `band_keys`. A window without any of a template's anchors agrees with it in no band."""
    return F.array(*[F.array_min(dealt(values, i))["h"] for i in range(BANDS)])


def windows_at(places: Column, size: Column, step: Column) -> Column:
    """Starts, from 1 and at every ``step``, of the windows that hold one of ``places``."""

    def around(place: Column) -> Column:
        first = F.greatest(F.lit(0), F.ceil((place - size) / step).cast("int"))
        return F.transform(F.sequence(first, F.floor((place - 1) / step).cast("int")), lambda k: k * step + 1)

    return F.array_distinct(F.flatten(F.transform(places, around)))


def scan(
    docs: DataFrame, templates: DataFrame, text: str = "text", id: str = "doc_id", percent: int = 75
) -> DataFrame:
    """(``id``, ``template``, ``start_word``, ``contained``) for each template that a row holds: where its best
    window starts, in words from 0, and the share of the template's shingles in it.

    A template (``template``, ``notice``) of m distinct shingles is sought in windows of 1.5 m shingles, at steps of
    m / 4, so that some window holds all of a stretch of up to 1.25 m. ``percent`` of the template's
    distinct shingles must occur in a window. Windows that agree with the template in one of `BANDS` MinHash
    values are compared exactly. A window that holds a share c has a similarity of at least c / (2.5 - c), and is
    missed with probability (1 - c / (2.5 - c)) ** `BANDS` at most: 0.00013 at 75 percent.

    Several notices of one template name are alternatives, and the best one counts. Templates that share most of
    their text, as versions of a licence do, are each found, with the share that tells them apart.

    Null and empty texts hold nothing. Templates of fewer than five words are compared by 3-word shingles, and those
    of fewer than three are never found. Repeated rows of an id are one. A null id is a group of its own. All of it
    runs in Spark's own functions.
    """
    # One-row generators keep the optimizer from computing an array anew wherever it is used.
    known = templates.select("template", "notice", F.explode(F.array(shingled(F.col("notice")))).alias("w"))
    t = F.when(F.size("w") >= WIDTH, shingles("w", WIDTH)).otherwise(shingles("w", SHORT))
    known = known.select(F.xxhash64("template", "notice").alias("no"), "template", F.explode(F.array(F.array_distinct(t))).alias("t"))
    known = (
        known.where(F.size("t") > 0)
        .withColumn("size", F.ceil(F.size("t") * WINDOW).cast("int"))
        .withColumn("step", F.greatest(F.lit(1), F.floor(F.size("t") / 4).cast("int")))
    )
    known = materialise(known, "license-templates")
    keyed = known.select("no", "size", "step", band_keys(F.col("t"), F.col("size")).alias("keys"), anchors(F.col("t")).alias("marks"))
    rows = keyed.distinct().limit(KEYS // BANDS + 1).collect()
    if len(rows) > KEYS // BANDS:
        raise ValueError(f"templates have more than {KEYS} band keys; scan with parts of them")
    if not rows:
        return docs.where(F.lit(False)).select(
            F.col(f"`{id}`"), F.lit("").alias("template"), F.lit(0).alias("start_word"), F.lit(0.0).alias("contained")
        )

    def literal(values: list[int]) -> Column:
        return F.array(*[F.lit(x).cast("long") for x in values])

    by_size: dict[tuple[int, int], list] = {}
    for r in rows:
        by_size.setdefault((r["size"], r["step"]), []).append(r)
    sizes = F.array(*[
        F.struct(
            F.lit(size).alias("size"), F.lit(step).alias("step"),
            literal(sorted({h for r in own for h in r["marks"]})).alias("marks"),
            literal(sorted({key for r in own for key in r["keys"]})).alias("keys"),
        )
        for (size, step), own in by_size.items()
    ])
    owners = F.array(*[F.struct(F.lit(r["no"]).cast("long").alias("no"), literal(sorted(set(r["keys"]))).alias("keys")) for r in rows])
    marks = sorted({h for r in rows for h in r["marks"]})

    def windows_of(z: Column) -> Column:
        """The windows of a size, with those of their band keys that a template has."""
        own = F.filter("places", lambda i: F.array_contains(z["marks"], F.element_at("s", i)))
        found = F.transform(
            windows_at(own, z["size"], z["step"]),
            lambda start: F.struct(
                start.alias("start"), z["size"].alias("size"),
                F.array_intersect(band_keys(F.slice("s", start, z["size"]), z["size"]), z["keys"]).alias("keys"),
            ),
        )
        return F.filter(found, lambda x: F.size(x["keys"]) > 0)

    texts = docs.select(F.col(f"`{id}`").alias("id"), shingled(F.col(f"`{text}`")).alias("w"))
    texts = texts.select("id", F.explode(F.array("w")).alias("w")).where(F.size("w") >= SHORT)
    texts = texts.select("id", F.explode(F.array(shingles("w", WIDTH), shingles("w", SHORT))).alias("s"))
    # Most texts hold no anchor, and only windows around anchors are hashed.
    texts = texts.where(F.arrays_overlap("s", literal(marks)))
    places = F.filter(F.sequence(F.lit(1), F.size("s")), lambda i: F.element_at("s", i).isin(marks))
    texts = texts.select("id", "s", F.explode(F.array(places)).alias("places"))
    hits = texts.select("id", "s", F.explode(F.flatten(F.transform(sizes, windows_of))).alias("x"))
    hits = hits.select("id", "x.start", F.slice("s", F.col("x.start"), F.col("x.size")).alias("near"), F.col("x.keys").alias("own"))
    held = F.transform(F.filter(owners, lambda o: F.arrays_overlap(o["keys"], F.col("own"))), lambda o: o["no"])
    hits = hits.select("id", "start", "near", F.explode(held).alias("no"))
    share = F.size(F.array_intersect("near", "t")) / F.size("t")
    matched = hits.join(known.select("no", "template", "t").dropDuplicates(["no"]), "no")
    matched = matched.select("id", "template", "start", share.alias("contained")).where(F.col("contained") * 100 >= percent)
    best = matched.groupBy("id", "template").agg(F.max(F.struct("contained", (-F.col("start")).alias("back"))).alias("best"))
    return best.select(
        F.col("id").alias(id), "template", (-F.col("best.back") - 1).alias("start_word"), F.col("best.contained").alias("contained")
    )
