"""Spelling variants, vector codes and top-k search on small cases, against plain versions in Python."""

import hashlib
import random
import re
import zlib
from collections import Counter
from math import floor, inf, nan

import numpy as np
import pytest
from pyspark.sql import functions as F

from labtrail.llm import codes, spelling, topk

# ---------------------------------------------------------------- spelling variants


def _one_apart(a, b):
    """Whether one inserted, deleted or replaced letter makes b of a."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def _plain_variants(words, ratio=5):
    out = {}
    for w, n in words.items():
        near = [v for v in words if _one_apart(w, v)]
        best = min(near, key=lambda v: (-words[v], v), default=None)
        form = best if best is not None and words[best] >= ratio * n else None
        out[w] = [form, w, n, len(near), words[form] if form else None]
    for w, row in out.items():
        while out[row[1]][0]:
            row[1] = out[row[1]][0]
    return {w: tuple(row) for w, row in out.items()}


def _grouped(spark, words, **options):
    rows = spark.createDataFrame(list(words.items()), "word string, n long")
    got = spelling.variants(rows, **options).collect()
    assert len(got) == len({r["word"] for r in got})
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in got}


@pytest.mark.parametrize("most", [spelling.GROUP, 3])
def test_variants(spark, most):
    """Few letters and small groups, so that groups are cut as far as they can be; long words beside them."""
    chance = random.Random(most)
    words = {"".join(chance.choices("abé", k=chance.randint(6, 9))): chance.choice([5, 5, 6, 30, 200, 900]) for _ in range(500)}
    words |= {"x" * 70 + y: n for y, n in (("", 7), ("x", 40), ("y", 40), ("xy", 300))}
    words |= {"y" * 3000: 5, "y" * 1500 + "z" + "y" * 1500: 25}
    assert _grouped(spark, words, most=most) == _plain_variants(words)


def test_forms_follow_to_the_last(spark):
    words = {"abcdefg" + "h" * k: 5**k for k in range(1, 12)}
    got = _grouped(spark, words)
    assert got == _plain_variants(words)
    assert got["abcdefgh"][1] == "abcdefg" + "h" * 11


def test_more_words_than_a_lane_in_a_group(spark):
    letters = "abcdefghijklmnopqrstuvwxyzàâãäåæçèéêë"
    words = {f"word{a}{b}": 5 + (ord(a) * ord(b)) % 50 for a in letters for b in letters}
    assert _grouped(spark, words) == _plain_variants(words)
    assert _grouped(spark, words, most=40) == _plain_variants(words)


def test_words_given_twice_short_or_null(spark):
    rows = spark.createDataFrame([("abcdef", 3), ("abcdef", 4), (None, 9), ("abc", 9), ("abcdeg", 40)], "word string, n long")
    got = {r["word"]: (r["form"], r["n"]) for r in spelling.variants(rows.withColumn("Form", F.lit(1))).collect()}
    assert got == {"abcdef": ("abcdeg", 7), "abcdeg": (None, 40)}
    assert spelling.variants(rows.limit(0)).count() == 0


def test_vocabulary(spark):
    chance = random.Random(3)
    letters = "abcdefghijABÀÿ×"
    pool = ["".join(chance.choices(letters, k=chance.randint(3, 9))) for _ in range(60)]
    texts = [(i, chance.choice([" ", "-", "1", "\n"]).join(chance.choices(pool, k=60))) for i in range(60)]
    texts += [(None, pool[0] * 2000), (7, None), (8, ""), (9, "\U00010400" + pool[1]), (9, pool[1] + "ĀÀ")] + texts[:2]
    wanted = Counter()
    for doc_id, text in texts:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % spelling.TYPO == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                wanted[run] += 1
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("word", F.lit("x")).withColumn("N", F.lit(1))
    got = {r["word"]: r["n"] for r in spelling.vocabulary(docs, spelling.dropped_letter).collect()}
    assert got == {w: n for w, n in wanted.items() if n >= 5}
    assert any(len(w) > 5_000 for w in wanted)


# ---------------------------------------------------------------- vector codes

VECTORS = "vec_id long, label int, embedding array<float>"


def _usable(vector):
    return vector is not None and all(x is not None and x == x and abs(x) != inf for x in vector)


def _plain_codes(rows, entries=16, rounds=6, parts=8):
    """(vec_id, code, error) of each usable row, and the digest, every part compared with every entry."""
    kept = [(i, [floor(4096 * float(np.float32(x))) for x in v]) for i, _, v in rows if _usable(v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for _, v in kept[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            of = {}
            for _, v in kept:
                of.setdefault(nearest(cut(v, p), books[p])[1], []).append(cut(v, p))
            books[p] = [
                [sum(c) // len(of[k]) for c in zip(*of[k])] if k in of else e for k, e in enumerate(books[p])
            ]
    out = []
    for i, v in kept:
        near = [nearest(cut(v, p), books[p]) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in near), sum(d for d, _ in near)))
    return out, hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()


def _vectors(seed, many, dims=16, steps=None):
    chance = random.Random(seed)
    number = (lambda: chance.randint(-steps, steps) / 4096) if steps else (lambda: chance.gauss(0, 0.3))
    return [(i, chance.choice([None, 1, 2]), [number() for _ in range(dims)]) for i in range(many)]


@pytest.mark.parametrize("steps", [None, 2])
def test_codes(spark, steps):
    """With few different components distances tie and vectors repeat; some entries stay unused."""
    rows = _vectors(1, 150, steps=steps)
    rows += [(3, 1, rows[40][2]), (None, None, rows[5][2]), (200, 1, None), (201, 2, [nan] * 16), (202, 2, [inf] + [0.0] * 15)]
    rows += [(203, 2, [None] + [0.0] * 15)] + rows[10:14]
    df = spark.createDataFrame(rows, VECTORS).withColumn("CODE", F.lit("x")).withColumn("error", F.lit(0))
    got, books = codes.compress(df)
    assert sorted(got.columns) == ["code", "error", "label", "vec_id"]
    wanted, digest = _plain_codes(rows)
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(((r["vec_id"], r["code"], r["error"]) for r in got.collect()), key=key) == sorted(wanted, key=key)
    assert books.digest() == digest


def test_orchard_search_finds_the_nearest():
    chance = np.random.default_rng(5)
    for spread in (2, 1000):
        books = codes.Codebooks(chance.integers(-spread, spread + 1, (3, 40, 4)))
        parts = chance.integers(-spread, spread + 1, (700, 3, 4))
        best, far = books.nearest(parts)
        every = ((parts[:, :, None, :] - books.entries[None]) ** 2).sum(axis=-1)
        assert (best == every.argmin(axis=-1)).all() and (far == every.min(axis=-1)).all()


def test_codes_of_few_uneven_and_no_vectors(spark):
    rows = [(5, 1, [0.5] * 16), (2, 1, [0.25] * 16), (9, None, [1.0] * 3), (10, None, [3e9] + [0.0] * 15), (11, 1, [])]
    got, books = codes.compress(spark.createDataFrame(rows, VECTORS))
    assert books.entries.shape == (8, 2, 2)
    assert {r["vec_id"]: (r["code"], r["error"]) for r in got.collect()} == {
        2: ("00" * 8, 0), 5: ("01" * 8, 0), 9: (None, None), 10: (None, None), 11: (None, None)
    }
    # 3 components fill up to 8
    got, books = codes.compress(spark.createDataFrame([(1, 1, [0.5, 0.25, 1.0]), (2, 1, [0.5, 0.5, 1.0])], VECTORS))
    assert {r["vec_id"]: r["code"] for r in got.collect()} == {1: "00" * 8, 2: "0001" + "00" * 6}
    for rows in ([], [(1, 1, None)]):
        got, books = codes.compress(spark.createDataFrame(rows, VECTORS))
        assert books is None and got.count() == 0 and "code" in got.columns
    got, books = codes.compress(spark.createDataFrame([(1, 1, [])], VECTORS))
    assert got.first()["code"] == "00" * 8


# ---------------------------------------------------------------- top-k search


def _plain_top(rows, every=100, top=10):
    """Multiset of (query_id, rank, vec_id, score)."""
    kept = [(at, i, [floor(1024 * float(np.float32(x))) for x in v]) for at, (i, _, v) in enumerate(rows) if _usable(v)]
    out = []
    for at, i, v in kept:
        if i is None or i % every:
            continue
        scored = [
            (-sum(a * b for a, b in zip(v, w)), j is None, j or 0) for other, j, w in kept if other != at and len(w) == len(v)
        ]
        out += [(i, r, None if none else j, -s) for r, (s, none, j) in enumerate(sorted(scored)[:top], 1)]
    return Counter(out)


def _top(spark, rows, every=100, **options):
    df = spark.createDataFrame(rows, VECTORS).withColumn("row", F.lit("x")).withColumn("SCORE", F.lit(1))
    found = topk.top_k(df.repartition(5), F.col("vec_id") % every == 0, **options).collect()
    return Counter((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found)


@pytest.mark.parametrize("options", [{}, {"block": 3, "query_group": 4, "slice_rows": 20}, {"top": 3, "block": 64}])
def test_top_k(spark, options):
    """Ties by few different components, repeated ids and vectors, null ids, vectors of other lengths."""
    rows = _vectors(2, 220) + [(i + 220, lab, v) for i, lab, v in _vectors(3, 200, steps=2)]
    rows += [(i + 500, lab, v) for i, lab, v in _vectors(4, 15, dims=5)]
    rows += [(None, 1, rows[7][2]), (40, 1, rows[40][2]), (40, 1, rows[8][2]), (800, 1, [])]
    rows += [(900, 1, None), (920, 2, [nan] * 16), (940, 2, [None] * 16), (960, 2, [-inf] * 16)]
    assert _top(spark, rows, every=20, **options) == _plain_top(rows, every=20, top=options.get("top", 10))


def test_top_k_of_large_numbers(spark):
    """Sums past what floats hold exactly."""
    chance = random.Random(9)
    rows = [(i, 1, [float(chance.randint(-15_000, 15_000)) for _ in range(24)]) for i in range(120)]
    assert _top(spark, rows, every=10) == _plain_top(rows, every=10)


def test_top_k_of_one_and_no_vectors(spark):
    assert _top(spark, [(0, 1, [1.0, 2.0])]) == Counter()
    assert _top(spark, []) == Counter()
    assert _top(spark, [(0, 1, [1.0, 2.0]), (1, 1, [1e9, 0.0])]) == Counter()
    assert _top(spark, [(0, 1, [1.0, 2.0]), (1, 1, [1.0, 0.0])]) == Counter([(0, 1, 1, 1024 * 1024)])


def test_branch_and_bound_drops_candidates_early():
    """On clustered vectors later blocks are read for a small part of the candidates."""
    chance = np.random.default_rng(1)
    centres = chance.integers(-400, 400, (20, 64))
    vectors = centres[chance.integers(0, 20, 4000)] + chance.integers(-40, 40, (4000, 64))
    search = topk.Search(np.arange(3) + 10**6, vectors[:3] + 1, 10)
    sizes = []
    search._mass, mass = (lambda v: sizes.append(len(v)) or mass(v)), search._mass
    search.offer(np.arange(4000), np.arange(4000), np.zeros(4000, bool), vectors)
    for q in range(3):
        scores = vectors @ search.queries[q]
        assert (search.best[q][2] == np.sort(scores)[::-1][:10]).all()
    upright, mass_of = vectors.T.astype(float), mass(vectors).T
    left, _ = search.survivors(0, search.queries[0].astype(float), np.arange(4000), upright, mass_of, mass_of.sum(axis=0))
    assert len(left) <= 20
