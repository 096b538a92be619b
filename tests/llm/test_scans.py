"""URL filters, personal data, licences and the two classifiers on small cases."""

import random
import re
import zlib
from hashlib import sha256

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from labtrail.llm import labelled, licenses, pii, quality, toxicity, urls

SF_DIR = "/root/testdata/sf0.01"


# ---------------------------------------------------------------- URLs


def _link(*targets):
    return "<html>" + "".join(f'<link rel="canonical" href="{t}">' for t in targets) + "</html>"


def test_blocks_travel_along_links(spark):
    pages = [
        (1, "http://A.com/de/x", None),  # blocked by its rule
        (2, "https://b.net/1", _link("http://a.com/de/x")),
        (3, "http://c.net/2?q=1#f", '<META http-equiv=refresh content="0; url=//b.net/1">'),
        (4, "http://d.net", _link("http://e.org/")),  # tied to an allowed URL only
        (5, "http://f.net/a/b", _link("c")),  # relative: http://f.net/a/c
        (6, "https://f.net/a/c", _link("http://x.a.com/de/y")),
        (7, None, _link("http://a.com/de/x")),
        (8, "no url", None),
        (9, "http://g.net/z", _link("http://h.org/", "http://b.com/de/")),  # allowed and blocked: allow wins
        (10, "http://www.example.org/en/15", _link("http://www.example.org/fr/")),  # its own rule wins
        (11, "http://b.net/2", ""),
        (12, "ftp://b.net?x", _link("/1")),  # http and ftp are one node: b.net/1
        (2, "https://b.net/1", _link("http://a.com/de/x")),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("rule", F.lit("mine"))
    got = {r.page_id: r for r in urls.decide(df, urls.page_links(df)).collect()}
    assert [p for p in sorted(got) if got[p].verdict == "block"] == [1, 2, 3, 5, 6, 10, 12]
    assert (got[1].host, got[1].path, got[1].rule) == ("a.com", "/de/x", "com/de/")
    assert (got[7].host, got[7].path, got[7].rule, got[8].host) == ("", "", None, "")
    assert got[10].rule == "example.org/en/1" and got[12].path == ""
    empty = df.limit(0)
    assert urls.decide(empty, urls.page_links(empty)).count() == 0


def test_targets_as_browsers_read_them(spark):
    refresh = "<meta http-equiv='refresh' content={}>"
    cases = [
        (_link("http://t.net/x?a=1&amp;b=2"), "t.net/x?a=1&b=2"),
        (_link("http://t.net/x?a=1&#38;b=2&#x26;c=&quot;&bogus;&#55296;&#x20AC;"), 't.net/x?a=1&b=2&c="&bogus;\ufffd€'),
        (_link("http://t.net/x?a=1&copy=2"), "t.net/x?a=1&copy=2"),
        (_link("../up/./y"), "p.net/a/up/y"),
        (_link("../../../../top"), "p.net/top"),
        (_link("."), "p.net/a/b/"),
        (_link(".."), "p.net/a/"),
        (_link("/..."), "p.net/..."),
        (_link("http://T.net:80/z"), "t.net/z"),
        (_link("https://t.net:443/z"), "t.net/z"),
        (_link("http://t.net:443/z"), "t.net:443/z"),
        (_link("http://t.net:/z"), "t.net/z"),
        (_link("#part"), None),
        (_link("it's"), "p.net/a/b/it's"),
        (refresh.format('"0; url=http://t.net/x?a=1&amp;b=2"'), "t.net/x?a=1&b=2"),
        (refresh.format('"0; URL=\'http://t.net/x;y=1?a=1;b=2\'"'), "t.net/x;y=1?a=1;b=2"),
        (refresh.format('"0; url=&quot;http://t.net/x;y&quot;"'), "t.net/x;y"),
        (refresh.format("0;url=http://t.net/x"), "t.net/x"),
        (refresh.format("0; url=http://t.net/x"), "t.net/x"),
        (refresh.format('"5"'), None),
    ]
    pages = spark.createDataFrame([(f"http://p.net:80/a/b/c?n={k}", c[0]) for k, c in enumerate(cases)], "url string, html string")
    got = {r.a: r.b for r in urls.page_links(pages).collect()}
    assert [got.get(f"p.net/a/b/c?n={k}") for k in range(len(cases))] == [c[1] for c in cases]
    rows = [(1, "http://b.net/x?a=1&b=2", None), (2, "http://c.net/", _link("http://b.net/x?a=1&amp;b=2")),
            (3, "http://d.net/", _link("http://c.net:80/q/..")), (4, "http://b.net/y", _link("http://a.com/x/../de/"))]
    rows += [(5, "http://e.net/", _link("http://b.net/y", "http://d.net/"))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.verdict for r in urls.decide(df, urls.page_links(df)).collect()} == {"block"}


# ---------------------------------------------------------------- personal data

PATTERNS = {
    1: r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    2: r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    3: r"[0-9]([\x20-]?[0-9])+",
    4: r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _plain_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                1: True,
                2: kind != 2 or all(int(p) <= 255 for p in m[0].split(".")),
                3: 16 <= len(digits) <= 19 and pii.luhn(digits),
                4: 8 <= len(digits) <= 15,
            }
            if good[kind]:
                out.append(pii.Span(kind, m.start(), m.end()))
    return out


def test_pattern_spans():
    chance = random.Random(3)
    texts = ["".join(chance.choices("0123456789..--++@@ab ()%\n", k=chance.randint(1, 60))) for _ in range(20_000)]
    for text in [*texts, "4980160719944918", "+1 (784) 555-8120", "a" * 100_000 + "@", "1" * 100_000]:
        if len(text) < 1000:
            assert pii.pattern_spans(text) == _plain_spans(text)
        else:
            assert pii.pattern_spans(text) == []


@pytest.fixture(scope="module")
def field():
    texts = [r[0] for r in duckdb.sql(f"SELECT text FROM '{SF_DIR.replace('0.01', '0.1')}/documents.parquet'").fetchall()]
    return pii.fit([t for t in texts if pii.MARKS.search(t) and len(t) < 3000][:1500])


def test_field_adds_what_the_patterns_miss(field):
    def added(text):
        return [(pii.LABELS[s.kind], text[s.start : s.end]) for s in field.added(text, pii.pattern_spans(text))]

    assert ("card", "4524132264652876") in added("re +1 (269) 555-3296 4524132264652876 and on")
    assert ("phone", "555-8120") in added("call +1 (784) 555-8120 now, or 555-8120 today.")
    assert added("version 4.0. of 2.0. and 3. page 12") == []
    assert added("token a8f5f167f44f4964e6c998dee827110c of 2.0.") == []


def test_field_trains_on_long_texts(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(pii, "fit", seen.append)
    long = [f"{k} call +1 (784) 555-81{k} " + "word " * 900 for k in range(10, 30)]
    df = spark.createDataFrame([(t,) for t in [*long, *long, None, "none", "z9 " * 50_000]], "text string")
    pii.train(df, texts=40, chars=120_000)
    assert sorted(seen[0]) == sorted(long)
    pii.train(df, texts=40, chars=20_000)  # as many as fit
    assert len(seen[1]) == 4 and set(seen[1]) < set(long)


def test_find(spark, field):
    rows = [
        (1, "mail ab.91@mail3.example.com or +1 (784) 555-8120"), (2, None), (3, ""), (4, "x " * 50_000),
        (5, "1.2.3.4 300.1.1.1"), (5, "1.2.3.4 300.1.1.1"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit(1))
    got = sorted(pii.find(df, field).collect())
    assert [(r.n_email, r.n_ip, r.n_card, r.n_phone) for r in got] == [
        (1, 0, 0, 1), (0,) * 4, (0,) * 4, (0,) * 4, (0, 1, 0, 0), (0, 1, 0, 0),
    ]
    assert got[0].spans == "email:5:28,phone:32:49"
    assert got[0].base_sha256 == sha256(got[0].spans.encode()).hexdigest()
    assert got[1].base_sha256 == sha256(b"").hexdigest() and got[1].spans == ""
    assert pii.find(df.limit(0), field).count() == 0


# ---------------------------------------------------------------- licences


def test_licence_scan(spark):
    model = licenses.train(["Some prose about nothing at all.", "And the other day it was not there."])
    rows = [
        (1, "Prose here.\n\nReleased under the MIT License.\nLicensed under CC BY-NC 4.0. "),
        (2, "The general public went to the state house under the new law."), (3, None), (4, ""),
        (5, "word " * 20_000 + "Licensed under the Apache License, Version 2.0."),
        (5, "word " * 20_000 + "Licensed under the Apache License, Version 2.0."),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("licences", F.lit(1))
    got = sorted(licenses.scan(df, model).drop("text").collect())
    assert [r.n_paragraphs for r in got] == [3, 1, 0, 0, 1, 1]
    assert [[(t.paragraph, t.family, t.confirmed) for t in r.licences] for r in got] == [
        [(1, "mit", True), (2, "cc-by-nc", True)], [], [], [], [(0, "apache", True)], [(0, "apache", True)],
    ]
    for k, line in ((0, rows[0][1].split("\n")[2]), (1, rows[0][1].split("\n")[3])):
        told = got[0].licences[k]
        assert told.probability == pytest.approx(max(model.probabilities(line).values()))
    assert licenses.scan(df.limit(0), model).count() == 0


WRAPPED = {
    "gpl": "# This program is free software: you can redistribute it and/or modify\n"
    "# it under the terms of the GNU General Public License as published by\n"
    "# the Free Software Foundation, either version 3 of the License, or",
    "lgpl": " * This library is free software; you can redistribute it and/or\n"
    " * modify it under the terms of the GNU Lesser General Public\n"
    " * License as published by the Free Software Foundation; either",
    "bsd": "Redistribution and use in source and binary forms, with or without\n"
    "modification, are permitted provided that the following conditions are met:",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy\r\n"
    'of this software and associated documentation files (the "Software"), to deal',
}


def test_wrapped_notices_and_identifiers(spark):
    model = licenses.train(["Some prose about nothing at all.", "And the other day it was not there."])
    prose = "The house by the river was old and nobody lived in it."
    words = re.sub("[#*]", "", WRAPPED["gpl"]).split()
    rows = [
        *((k, f"Title\n\n{text}\n{prose}", [(1, family)]) for k, (family, text) in enumerate(WRAPPED.items())),
        (10, "\n".join(words), [(0, "gpl")]),  # a word a line
        (11, "\n".join([WRAPPED["gpl"], WRAPPED["bsd"], WRAPPED["gpl"]]), [(0, "gpl"), (3, "bsd"), (5, "gpl")]),
        (12, "\n".join([prose] * 30) + "\nReleased under the MIT\nLicense.\n" + prose, [(30, "mit")]),
        (13, "Released under the MIT License.\n" + WRAPPED["mit"], [(0, "mit"), (1, "mit")]),
        (14, "w " * 5000 + WRAPPED["bsd"] + " w" * 5000, [(0, "bsd")]),
        (15, "\n".join([prose] * 5), []),
        (16, "Please read the terms of the license\nbefore you use this software.", []),
        (20, "// SPDX-License-Identifier: GPL-2.0-or-later", [(0, "gpl")]),
        (21, "// SPDX-License-Identifier: BSD-2-Clause", [(0, "bsd")]),
        (22, "/* SPDX-License-Identifier: LGPL-3.0+ */", [(0, "lgpl")]),
        (23, "SPDX-License-Identifier: MPL-1.1", [(0, "mpl")]),
        (24, "SPDX-License-Identifier: CC-BY-SA-3.0", [(0, "cc-by-sa")]),
        (25, "This work is licensed under the GNU General Public License, version 2.", [(0, "gpl")]),
        (26, "Released under the BSD 2-Clause License.", [(0, "bsd")]),
    ]
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    got = {r.doc_id: r.licences for r in licenses.scan(df, model).collect()}
    assert {d: [(t.paragraph, t.family) for t in v if t.confirmed] for d, v in got.items()} == {r[0]: r[2] for r in rows}
    # all lines of the notice, and no finding of the same family for each of them
    assert [(t.paragraph, t.last) for t in got[0] if t.family == "gpl"] == [(1, 3)]


# ---------------------------------------------------------------- classifiers


def _labelled(spark, label, folds, fold):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    truth = {r.doc_id: r[label] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    return docs, {d: y for d, y in truth.items() if zlib.crc32(str(d).encode()) % folds == fold}


def test_quality_on_held_out_rows(spark):
    docs, truth = _labelled(spark, "quality", quality.FOLDS, quality.FOLD)
    model = quality.train(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    got = {r.doc_id: r.predicted for r in quality.classify(docs, model).collect()}
    assert np.mean([got[d] == y for d, y in truth.items()]) > 0.95
    odd = [(1, None, 5.0), (2, "", 5.0), (2, "", 5.0), (None, "a " * 40_000, 5.0)]
    df = spark.createDataFrame(odd, "doc_id long, text string, score double")
    rows = quality.classify(df, model, keep_text=True).collect()
    assert len(rows) == 4 and all(0 <= r.score <= 1 for r in rows) and rows[1] == rows[2]
    assert quality.classify(df.limit(0), model).count() == 0
    same = quality.train(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r.score for r in quality.classify(df, same).collect()} == {0.5}


def test_additive_model_learns_an_interaction():
    chance = np.random.default_rng(1)
    x = chance.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x[:3000], y[:3000], rounds=10)
    assert max(model.pair, key=lambda k: np.abs(model.pair[k]).max()) == (0, 1)
    assert np.mean((model.score(x[3000:]) > 0.5) == y[3000:]) > 0.9


def _insulted(chance, n, insults):
    texts, y = [], []
    for i in range(n):
        words = ["".join(chance.choices("aeioulrstn", k=chance.randint(2, 8))) for _ in range(chance.randint(5, 80))]
        if i % 2:
            words[chance.randrange(len(words))] = chance.choice(insults)
        texts.append(" ".join(words))
        y.append(i % 2)
    return texts, np.array(y, dtype=float)


def test_toxicity_of_unseen_misspellings(spark):
    chance = random.Random(2)
    texts, y = _insulted(chance, 800, ["bozzwick", "grumpfab"])
    model = toxicity.fit(texts, y, buckets=1 << 14)
    score = toxicity.Scorer(model.lean(), float(model.biases[1] - model.biases[0]))
    more, truth = _insulted(chance, 200, ["bozzwickk", "grumpfabb", "Bozzwick!"])
    assert np.mean((score(more) >= 0.5) == truth) > 0.95
    odd = [(1, None, "p"), (2, "", "p"), (2, "", "p"), (3, "la " * 40_000 + "bozzwick", "p"), (None, "la le", "p")]
    df = spark.createDataFrame(odd, "doc_id long, text string, predicted string")
    got = toxicity.classify(df, model).collect()
    assert [r.predicted for r in got] == [0, 0, 0, 1, 0] and got[1] == got[2]
    assert toxicity.classify(df.limit(0), model).count() == 0
    labels = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert toxicity.train(df, labels).embeddings.any() == False  # noqa: E712  one class: nothing to learn


def test_grams_lie_within_words():
    ids, first = toxicity.grams(["ab", "b", "日本語x"])
    assert np.diff(np.append(first, len(ids))).tolist() == [3, 1, 9]
    alone, _ = toxicity.grams(["日本語x"])
    assert set(ids[first[2] :]) == set(alone)


def test_labelled_sample_bounds_rows(spark):
    docs = [(1, "same")] * 500 + [(2, f"text {k}") for k in range(500)] + [(3, None), (3, None), (4, "x"), (None, "y")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (4, 2)], "doc_id long, quality int")
    got = labelled.labelled_sample(df, labels, "quality", F.lit(True), 20).collect()
    assert sorted((r.doc_id, r.text or "") for r in got if r.doc_id != 2) == [(1, "same"), (3, "")]
    assert len({r.text for r in got if r.doc_id == 2}) == len(got) - 2 == 20
    assert {(r.doc_id, r["__label"]) for r in got} == {(1, 1), (2, 0), (3, 1)}


def test_toxicity_trains_beside_long_texts(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda texts, y: seen.append((texts, y)))
    rows = [(k, f"text {k} " * (2000 if k % 5 == 0 else 1)) for k in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(100)], "doc_id long, toxic int")
    toxicity.train(df, labels, chars=4_000)
    learned = {k for k in range(100) if k % 5 and zlib.crc32(str(k).encode()) % toxicity.FOLDS != toxicity.FOLD}
    assert sorted(t for t in seen[0][0]) == sorted(dict(rows)[k] for k in learned)
    toxicity.train(df.where("doc_id % 5 = 0"), labels, chars=100_000)  # long texts only: some of each class
    assert set(seen[1][1]) == {0.0, 1.0} and sum(map(len, seen[1][0])) <= 100_000
    assert labelled.within([5, 900, 7, 2000, 1], 1000) == [0, 1, 2, 4]


def test_text_sample_is_bounded_and_stable(spark):
    df = spark.createDataFrame([(t,) for t in [f"t{k % 40}" for k in range(200)] + [None]], "text string")
    some = labelled.text_sample(df, 10)
    assert len(some) == len(set(some)) == 10 and some == labelled.text_sample(df.repartition(5), 10)
    assert sorted(labelled.text_sample(df, 1000)) == sorted(f"t{k}" for k in range(40))
    assert labelled.text_sample(df.limit(0), 10) == []
