"""Licence scans: a trained paragraph classifier with an unknown class, confirmed by template comparison.

A paragraph (a line with a word) is the set of its word bigrams and trigrams, in lower case; all version numbers
count as one word, and an identifier such as GPL-2.0-or-later as what stands before its version. A softmax over
licence families and "unknown" is trained on the notices below, thinned and set among other words, against
paragraphs of the corpus; one temperature, fitted on notices set aside, calibrates its probabilities. Its
vocabulary are the n-grams of the notices, so its size does not depend on the corpus, and a paragraph with none
of them is unknown. A found family is confirmed if most bigrams of one of its notices are in the paragraph.

Wrapped notices are read from runs of neighbouring paragraphs: every run that the longest notice can stand in is
judged like a paragraph, in as many lines as it has. Of a run, the words further from its first or last line break
than the longest notice is long do not count. Confirmed runs are reported with the number of their first line, the
most alike first (then the shorter, then the earlier), if they share no line with a confirmed line or run of their
family and do not lie within a reported run; a run stands for the unconfirmed findings of its family in its lines.

Scoring is one projection of built-in functions over whole texts. Null and empty texts have no paragraphs. Each
row is judged by itself: repeated rows get equal results. Ties between families go to the first by name. An
empty table trains without corpus paragraphs. Columns named like a result are replaced by it.
"""

from __future__ import annotations

import math
import random
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labtrail.llm.common import let, query, table
from labtrail.llm.labelled import text_sample

UNKNOWN = "unknown"
# Wording of common licence notices.
NOTICES = {
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in'
        " compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "bsd": (
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
        " that the following conditions are met",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
        " General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: GPL-3.0-only",
    ),
    "lgpl": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU"
        " Lesser General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ),
    "mit": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
        " associated documentation files",
        "SPDX-License-Identifier: MIT",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
}
# Ordinary sentences that speak of licences without granting one.
OTHER = (
    "Please read the terms of the license before you use this software.",
    "All rights reserved. No part of this work may be used without permission.",
    "He is licensed under state law to use the public road.",
    "The source code is subject to the following conditions and may be used free of charge.",
    "A free copy of the work was released to the public under these terms.",
)
WORDS = "([a-z0-9]+(?:[.-][a-z0-9]+)*)"
# What follows the name in an identifier with a version, and version numbers.
ENDING, VERSION = "([a-z])-[0-9][a-z0-9]*(?:[.-][a-z0-9]+)*", "[0-9]+(?:[.][0-9]+)*"
SAMPLED_PARAGRAPHS = 500
CONFIRMED = 0.6


def tokens(paragraph: str) -> list[str]:
    return re.findall(WORDS, re.sub(VERSION, "0", re.sub(ENDING, r"\1", paragraph.lower())))


def grams(words: list[str]) -> set[str]:
    return {" ".join(words[i : i + n]) for n in (2, 3) for i in range(len(words) - n + 1)}


def notice_pairs(notice: str) -> list[str]:
    return [g for g in sorted(grams(tokens(notice))) if g.count(" ") == 1]


def anchors(confirmed: float) -> list[str]:
    """Bigrams of which any text that holds a share of `confirmed` of a notice has at least one.

    Of each notice as many as can be are left out, the shortest first: those are the most common ones.
    """
    out = set()
    for of in (notice_pairs(n) for many in NOTICES.values() for n in many):
        out.update(sorted(of, key=lambda g: (len(g), g))[max(math.ceil(confirmed * len(of)) - 1, 0) :])
    return sorted(out)


@dataclass
class Classifier:
    families: list[str]  # the last one is unknown
    weights: dict[str, list[float]]
    biases: list[float]

    def probabilities(self, paragraph: str) -> dict[str, float]:
        """What the projection computes, for one paragraph."""
        total = np.array(self.biases)
        for g in sorted(grams(tokens(paragraph)) & set(self.weights)):
            total = total + self.weights[g]
        p = np.exp(total - total.max())
        return dict(zip(self.families, (p / p.sum()).tolist()))


def train(paragraphs: list[str], copies: int = 30, steps: int = 300, ridge: float = 1e-3, seed: int = 5) -> Classifier:
    """Fit on the notices and on paragraphs of the corpus, and calibrate on examples set aside."""
    chance = random.Random(seed)
    families = [*sorted(NOTICES), UNKNOWN]
    vocabulary = sorted(set().union(*(grams(tokens(n)) for many in NOTICES.values() for n in many)))
    known = set(vocabulary)
    closest = [grams(tokens(n)) for many in NOTICES.values() for n in many]
    # the corpus holds notices too: paragraphs close to one are not examples of unknown
    plain = [tokens(p) for p in paragraphs]
    plain = [w for w in plain if not any(len(g & grams(w)) > 0.3 * len(g) for g in closest)]
    around = [w for w in plain if w] or [tokens(p) for p in OTHER]
    examples: list[tuple[set[str], int]] = []
    for k, family in enumerate(families[:-1]):
        for notice in NOTICES[family]:
            words = tokens(notice)
            for copy in range(copies):
                kept = words if copy % 3 == 0 else [w for w in words if chance.random() < 0.95]
                before, after = chance.choice(around)[:20], chance.choice(around)[:20]
                examples.append((grams(kept if copy % 2 else [*before, *kept, *after]), k))
    for words in [*plain, *(tokens(p) for p in OTHER for _ in range(copies))]:
        examples.append((grams(words), len(families) - 1))
        examples.append((grams(chance.sample(words, len(words))), len(families) - 1))
    for _ in range(copies * len(families)):  # halves of two notices: words of licences, but no notice
        a, b = (tokens(chance.choice(NOTICES[chance.choice(families[:-1])])) for _ in range(2))
        examples.append((grams(a[: len(a) // 3] + b[-(len(b) // 4) :]), len(families) - 1))
    chance.shuffle(examples)
    x = np.zeros((len(examples), len(vocabulary)))
    place = {g: i for i, g in enumerate(vocabulary)}
    for i, (found, _) in enumerate(examples):
        x[i, [place[g] for g in found & known]] = 1
    y = np.array([k for _, k in examples])
    aside = np.arange(len(y)) % 5 == 0
    weights, biases = np.zeros((len(vocabulary), len(families))), np.zeros(len(families))
    goal = np.eye(len(families))[y]
    share = 1 / np.bincount(y[~aside], minlength=len(families)).clip(1)[y] / len(families)
    share[aside] = 0
    speed = [np.zeros_like(weights), np.zeros_like(biases)]
    for _ in range(steps):
        logits = x @ weights + biases
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        gap = (p / p.sum(axis=1, keepdims=True) - goal) * share[:, None]
        for value, grad, v in zip((weights, biases), (x.T @ gap + ridge * weights, gap.sum(axis=0)), speed):
            v *= 0.9
            v -= 0.5 * grad
            value += v

    def loss(heat: float) -> float:
        logits = (x[aside] @ weights + biases) * heat
        logits -= logits.max(axis=1, keepdims=True)
        return float((np.log(np.exp(logits).sum(axis=1)) - logits[np.arange(aside.sum()), y[aside]]).mean())

    heat = min((0.25 * 1.25**k for k in range(16)), key=loss)
    biases = biases * heat
    # without any n-gram of a notice a paragraph is unknown
    biases[-1] = max(biases[-1], biases[:-1].max() + 1.0)
    return Classifier(families, dict(zip(vocabulary, (weights * heat).tolist())), biases.tolist())


def sample_paragraphs(docs: DataFrame, most: int = SAMPLED_PARAGRAPHS) -> list[str]:
    """At most `most` different first paragraphs of 20 to 2,000 characters, the first by a hash."""
    lines = F.filter(F.split("text", "\n"), lambda x: (F.length(x) > 20) & (F.length(x) <= 2000))
    return text_sample(docs.select(F.get(lines, F.lit(0)).alias("text")), most)


def scan(docs: DataFrame, model: Classifier, confirmed: float = CONFIRMED, text: str = "text") -> DataFrame:
    """`docs` with n_paragraphs and `licences`: of each paragraph or run that is not unknown the number (from 0) of
    its first line, family, probability, likeness (greatest share of a notice's bigrams that it has), the number of
    its last line and whether the likeness confirms it."""
    known_pairs = sorted(g for g in model.weights if g.count(" ") == 1)
    anchor_pairs = anchors(confirmed)
    reach = max(len(tokens(n)) for many in NOTICES.values() for n in many)

    def words(line: Column) -> Column:
        named = F.regexp_replace(F.lower(line), F.lit(ENDING), F.lit("$1"))
        return F.regexp_extract_all(F.regexp_replace(named, F.lit(VERSION), F.lit("0")), F.lit(WORDS))

    def pairs(w: Column) -> Column:
        rest = F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0)))
        start = F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0)))
        return F.zip_with(start, rest, lambda a, b: F.concat(a, F.lit(" "), b))

    def triples(w: Column) -> Column:
        n = F.greatest(F.size(w) - 2, F.lit(0))
        return F.zip_with(F.slice(pairs(w), 1, n), F.slice(w, 3, n), lambda a, b: F.concat(a, F.lit(" "), b))

    table_of = F.create_map(
        *[c for g, row in model.weights.items() for c in (F.lit(g), F.array(*map(F.lit, row)))]
    )
    names = F.array(*map(F.lit, model.families))
    start = F.array(*map(F.lit, model.biases))

    def shares(own: Column, notices: tuple[str, ...]) -> Column:
        """The greatest share of a notice's bigrams."""
        out = [
            F.size(F.array_intersect(own, F.array(*map(F.lit, of)))) / float(len(of))
            for of in map(notice_pairs, notices)
            if of
        ]
        return F.greatest(*out) if len(out) > 1 else out[0]

    def judged(w: Column, first: Column, last: Column) -> Column:
        def probabilities(found: Column) -> Column:
            total = F.aggregate(found, start, lambda acc, g: F.zip_with(acc, F.element_at(table_of, g), lambda a, b: a + b))
            risen = let(total, lambda t: F.transform(t, lambda v: F.exp(v - F.array_max(t))))
            return let(risen, lambda r: F.transform(r, lambda v: v / F.aggregate(r, F.lit(0.0), lambda a, b: a + b)))

        def likeness(own: Column, family: Column) -> Column:
            out = F.lit(0.0)
            for name, notices in NOTICES.items():
                out = F.when(family == name, shares(own, notices)).otherwise(out)
            return out

        own = F.array_sort(F.array_distinct(F.concat(pairs(w), triples(w))))
        found = F.filter(own, lambda g: g.isin(list(model.weights)))
        return let(
            probabilities(found),
            lambda p: let(
                F.array_position(p, F.array_max(p)).cast("int"),
                lambda at: F.struct(
                    first.alias("paragraph"),
                    F.element_at(names, at).alias("family"),
                    F.element_at(p, at).alias("probability"),
                    likeness(pairs(w), F.element_at(names, at)).alias("likeness"),
                    last.alias("last"),
                ),
            ),
        )

    def found(told: Column) -> Column:
        return F.transform(
            F.filter(told, lambda t: t["family"] != UNKNOWN),
            lambda t: t.withField("confirmed", t["likeness"] >= confirmed),
        )

    def with_anchor(some: Column) -> Column:
        """Places of the lines in which, or at the end of which, an anchor begins."""

        def place(line: Column, at: Column) -> Column:
            after = F.coalesce(F.slice(F.get(some, at + 1)["words"], 1, 1), F.array().cast("array<string>"))
            has = F.exists(pairs(F.concat(line["words"], after)), lambda g: g.isin(anchor_pairs))
            return F.when(has, at)

        return F.array_compact(F.transform(some, place))

    def runs(some: Column, anchored: Column) -> Column:
        """Runs of lines around the anchors that a notice can stand in: numbers of the first and last, and words."""
        starts = F.array_distinct(
            F.flatten(F.transform(anchored, lambda p: F.sequence(F.greatest(p - reach, F.lit(0)), p)))
        )

        def inner(at: Column, more: Column) -> Column:
            return F.slice(some, at + 2, more - 1)

        def from_line(at: Column) -> Column:
            follow = F.least(F.lit(reach), F.size(some) - 1 - at)
            lengths = F.when(follow > 0, F.sequence(F.lit(1), follow)).otherwise(F.array().cast("array<int>"))
            fitting = F.filter(
                lengths, lambda k: F.aggregate(inner(at, k), F.lit(0), lambda n, x: n + F.size(x["words"])) < reach
            )
            return F.transform(fitting, lambda k: run(at, k))

        def run(at: Column, more: Column) -> Column:
            first, last = F.get(some, at), F.get(some, at + more)
            w = F.concat(
                F.slice(first["words"], F.greatest(F.size(first["words"]) - reach, F.lit(0)) + 1, reach),
                F.flatten(F.transform(inner(at, more), lambda x: x["words"])),
                F.slice(last["words"], 1, reach),
            )
            return F.struct(first["number"].alias("first"), last["number"].alias("last"), w.alias("words"))

        return F.flatten(F.transform(starts, from_line))

    def like_a_notice(w: Column) -> Column:
        own = F.filter(F.array_distinct(pairs(w)), lambda g: g.isin(known_pairs))
        every = tuple(n for many in NOTICES.values() for n in many)
        return let(own, lambda o: shares(o, every) >= confirmed)

    def apart(found_lines: Column, found_runs: Column) -> Column:
        """Confirmed runs, the most alike first, that repeat neither a confirmed line nor a run before."""

        def repeats(r: Column, a: Column) -> Column:
            meet = (a["paragraph"] <= r["last"]) & (a["last"] >= r["paragraph"])
            within = (a["paragraph"] <= r["paragraph"]) & (a["last"] >= r["last"])
            return within | (meet & (a["family"] == r["family"]))

        sure_lines = F.filter(found_lines, lambda t: t["confirmed"])
        sure = F.filter(found_runs, lambda r: r["confirmed"] & ~F.exists(sure_lines, lambda t: repeats(r, t)))
        order = F.transform(
            sure, lambda r: F.struct((-r["likeness"]).alias("a"), (r["last"] - r["paragraph"]).alias("b"), r.alias("run"))
        )
        return F.aggregate(
            F.transform(F.array_sort(order), lambda o: o["run"]),
            F.filter(found_runs, lambda r: F.lit(False)),
            lambda acc, r: F.when(F.exists(acc, lambda a: repeats(r, a)), acc).otherwise(F.concat(acc, F.array(r))),
        )

    own_names = ("n_paragraphs", "licences")
    kept = [c for c in docs.columns if c.lower() not in own_names]
    lines = F.filter(
        F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")
    )
    read = docs.select(
        *kept, F.transform(lines, lambda x, i: F.struct(i.alias("number"), words(x).alias("words"))).alias("__lines")
    )
    # Lines without a bigram of the notices are unknown: only the others are scored. Runs join what has words.
    met = F.filter("__lines", lambda s: F.exists(pairs(s["words"]), lambda g: g.isin(known_pairs)))
    sized = read.select(
        *kept, F.size("__lines").cast("long").alias("n_paragraphs"), met.alias("__met"),
        F.filter("__lines", lambda s: F.size(s["words"]) > 0).alias("__some"),
    )
    anchored = sized.withColumn("__anchored", with_anchor(F.col("__some")))
    near = F.filter(runs(F.col("__some"), F.col("__anchored")), lambda r: like_a_notice(r["words"]))
    scored = anchored.select(
        *kept, "n_paragraphs",
        found(F.transform("__met", lambda s: judged(s["words"], s["number"], s["number"]))).alias("__found"),
        found(F.transform(near, lambda r: judged(r["words"], r["first"], r["last"]))).alias("__runs"),
    )
    told = scored.select(*kept, "n_paragraphs", "__found", apart(F.col("__found"), F.col("__runs")).alias("__apart"))
    alone = F.filter(
        "__found",
        lambda t: t["confirmed"]
        | ~F.exists(
            "__apart",
            lambda r: (t["family"] == r["family"]) & t["paragraph"].between(r["paragraph"], r["last"]),
        ),
    )
    return told.select(*kept, "n_paragraphs", F.array_sort(F.concat(alone, "__apart")).alias("licences"))


@query("op9_license_scans")
def op9_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scanned = scan(docs, train(sample_paragraphs(docs)))
    sure = F.filter("licences", lambda t: t["confirmed"])
    return scanned.select(
        "doc_id",
        "n_paragraphs",
        F.size("licences").cast("long").alias("n_found"),
        F.size(sure).cast("long").alias("n_confirmed"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(sure, lambda t: t["family"]))), ",").alias("families"),
        F.array_join(
            F.transform(sure, lambda t: F.concat(t["paragraph"].cast("string"), F.lit(":"), t["family"])), ","
        ).alias("paragraphs"),
    )
