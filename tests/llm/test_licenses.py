"""The license scan against exact containment over all windows."""

import math
import random
import re

from tidemark.llm.licenses import scan, templates

WORDS = [f"w{i}" for i in range(400)]


def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)


def found(spark, texts):
    rows = scan(docs(spark, texts), templates(spark)).collect()
    return {(r["doc_id"], r["template"]): (r["contained"], r["start_word"]) for r in rows}


def shingles(text, width):
    words = re.findall("[a-z0-9]+", (text or "").lower())
    return [tuple(words[i : i + width]) for i in range(len(words) - width + 1)]


def by_force(table, texts):
    """The best window of each text and template name, over all windows."""
    out = {}
    for name, notice in table:
        width = 5 if len(re.findall("[a-z0-9]+", notice.lower())) >= 5 else 3
        own = set(shingles(notice, width))
        m = len(own)
        for key, text in enumerate(texts):
            all_ = shingles(text, width)
            for start in range(0, len(all_), max(1, m // 4)):
                share = len(own.intersection(all_[start : start + math.ceil(1.5 * m)])) / m
                if share >= 0.75:
                    out[key, name] = max(out.get((key, name), (0, 0)), (share, -start))
    return {key: (share, -back) for key, (share, back) in out.items()}


def table_of(spark):
    return [(r["template"], r["notice"]) for r in templates(spark).collect()]


def test_copies_near_copies_and_partial_copies(spark):
    rng, texts = random.Random(5), [None, "", "Licensed under", "the mit"]
    for name, notice in table_of(spark):
        words = notice.split()
        filler = lambda: rng.choices(WORDS, k=rng.randint(0, 60))
        texts.append(" ".join(filler() + words + filler()))
        if 40 < len(words) < 300:
            # 75 percent of it, fewer, and all of it with words changed or put in, near and beyond the limit.
            for share in (0.85, 0.78, 0.7):
                at = rng.randint(0, int(len(words) * (1 - share)))
                texts.append(" ".join(filler() + words[at : at + int(len(words) * share)] + filler()))
            for rate in (0.02, 0.04, 0.05, 0.06, 0.08):
                texts.append(" ".join(filler() + [rng.choice(WORDS) if rng.random() < rate else w for w in words] + filler()))
                texts.append(" ".join(filler() + [x for w in words for x in ([w, "more"] if rng.random() < rate else [w])] + filler()))
    want = by_force(table_of(spark), texts)
    assert sum(share < 0.85 for share, _ in want.values()) > 20
    assert found(spark, texts) == want


def held_anywhere(table, texts):
    """(text, template name) where some stretch of 1.25 times the template's shingles, from any word on, holds enough."""
    out = set()
    for name, notice in table:
        width = 5 if len(re.findall("[a-z0-9]+", notice.lower())) >= 5 else 3
        own = set(shingles(notice, width))
        m = len(own)
        for key, text in enumerate(texts):
            hits = [s if s in own else None for s in shingles(text, width)]
            at = [i for i, s in enumerate(hits) if s]
            # The best stretch begins with a shingle of the template.
            if len(set(hits)) - 1 >= 0.75 * m:
                if any(len(set(hits[i : i + math.floor(1.25 * m)]) - {None}) >= 0.75 * m for i in at):
                    out.add((key, name))
    return out


def test_no_start_is_cut_by_the_grid(spark):
    rng, texts = random.Random(6), []
    for _, notice in table_of(spark):
        words = notice.split()
        if 40 < len(words) < 300:
            for rate in (0.0, 0.02, 0.04, 0.05):
                spread = [x for w in words for x in ([w, "more"] if rng.random() < rate else [w])]
                texts.append(" ".join(rng.choices(WORDS, k=rng.randint(0, 90)) + spread + rng.choices(WORDS, k=9)))
    want = held_anywhere(table_of(spark), texts)
    assert len(want) > 20
    assert want <= set(found(spark, texts))


def test_odd_rows(spark):
    mit = "Permission is hereby granted. Released under the MIT License."
    rows = [(None, mit, "x"), (None, None, "x"), (4, mit, "x"), (4, mit, "x"), (5, "", "x"), (6, "a " * 200_000 + mit, "x")]
    table = spark.createDataFrame(rows, "doc_id long, text string, template string")
    got = [(r["doc_id"], r["template"]) for r in scan(table, templates(spark)).collect()]
    # Repeated rows of an id are one, and a null id is a group of its own.
    assert sorted(got, key=str) == [(4, "MIT"), (6, "MIT"), (None, "MIT")]
    assert scan(table.where("false"), templates(spark)).collect() == []
    assert scan(table, templates(spark).where("false")).collect() == []


def test_usual_forms(spark):
    forms = {
        "Released under MIT License": "MIT",
        "Distributed under the MIT license, see LICENSE.": "MIT",
        "# SPDX-License-Identifier: MIT\nimport os": "MIT",
        "// SPDX-License-Identifier: GPL-2.0-or-later": "GPL-2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "https://www.apache.org/licenses/LICENSE-2.0 Licensed under the Apache License, Version 2.0": "Apache-2.0",
        "it is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your "
        "option) any later version": "LGPL-2.1",
    }
    got = found(spark, forms)
    for key, name in enumerate(forms.values()):
        assert (key, name) in got
    assert not any(name.startswith(("Apache", "CC")) for key, name in got if key < 4)
