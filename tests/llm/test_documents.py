"""Operators over documents on small cases, against plain versions in Python."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_text_queries import _words, brute_classes

from labtrail.llm import exact, jaccard, mixing, packing, rules
from labtrail.llm.common import components, positions

SCHEMA = "doc_id long, text string, source string"


def _docs(spark, *rows, schema=SCHEMA):
    return spark.createDataFrame(list(rows), schema)


ODD = [
    (1, "a b c d e f g h i j", "s"), (2, "a  b\tc d e f g h i j", "s"), (3, None, None), (4, "", "t"),
    (4, "", "t"), (None, "x y", "t"), (None, None, "s"), (5, " \n\t", None), (6, "long " * 3000, "s"),
]


# ---------------------------------------------------------------- rules


def _measured(text):
    words = _words(text)
    spots = defaultdict(list)
    for i in range(len(words) - 4):
        spots[tuple(words[i : i + 5])].append(i)
    covered = {i + k for at in spots.values() if len(at) > 1 for i in at for k in range(5)}
    lines = [x for x in (text or "").split("\n") if _words(x)]
    return (
        len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
        len(covered),
    )


def test_rule_measures(spark):
    chance = random.Random(4)
    texts = ["".join(chance.choice("ab  \n#|é") for _ in range(chance.randint(0, 200))) for _ in range(300)]
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [r for r in ODD if r[0] is not None]
    got = rules.judge(rules.measures(_docs(spark, *rows).withColumn("kept", F.lit("x")))).collect()
    assert len(got) == len(rows)
    for r in got:
        want = _measured(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert r.kept == (not r.base_failed and not r.failed)
    assert rules.judge(rules.measures(_docs(spark))).count() == 0


# ---------------------------------------------------------------- exact dedup


def test_fingerprints_compose():
    of = exact.Fingerprint()
    data = bytes(random.Random(1).randbytes(50_000))
    for cut in (0, 1, 4095, 4096, 12_345, len(data)):
        assert exact.combine(of(data[:cut]), of(data[cut:]), len(data) - cut) == of(data)
    for k, (prime, x) in enumerate(exact.POINTS):
        value = 0
        for b in data[:9000]:
            value = (value * x + b) % prime
        assert of(data[:9000])[k] == value


@pytest.mark.parametrize("points", [exact.POINTS, ((7, 3),)])
def test_exact_groups(spark, points):
    """With one tiny prime nearly all texts collide and are told apart by themselves."""
    chance = random.Random(2)
    rows = [(i, " ".join(chance.choices(["a", "b", "c"], k=3)), "s") for i in range(200)]
    rows += ODD + [(900, "x" * 200_000 + "y", "s"), (901, "x" * 200_000 + "z", "s"), (902, "x" * 200_000 + "y", "s")]
    docs = _docs(spark, *rows).withColumn("KEPT", F.lit(1))
    got = exact.exact_groups(docs, points=points).collect()
    assert len(got) == len(rows)
    groups = defaultdict(list)
    for d, text, _ in rows:
        groups[re.sub(r"[ \t\n\x0b\f\r]+", " ", text or "")].append(d)
    kept = Counter()
    for r in got:
        body = re.sub(r"[ \t\n\x0b\f\r]+", " ", r.text or "")
        ids = [d for d in groups[body] if d is not None]
        assert (r.keep_id, r.group_size) == (min(ids, default=None), len(groups[body]))
        kept[body] += r.kept
    assert set(kept.values()) == {1}
    assert exact.exact_groups(_docs(spark)).count() == 0


# ---------------------------------------------------------------- near duplicates


def _near_cases():
    chance = random.Random(3)
    rows = list(ODD)
    for base in range(6):
        words = [f"w{chance.randint(0, 400)}" for _ in range(120)]
        for copy in range(12):
            some = words.copy()
            for _ in range(copy % 4):
                some[chance.randrange(len(some))] = f"n{chance.randint(0, 10**6)}"
            rows.append((100 * (base + 1) + copy, " ".join(some), "s"))
    return rows


@pytest.mark.parametrize("block", [1024, 3])
def test_near_groups(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rows = _near_cases()
    got = jaccard.near_groups(_docs(spark, *rows).withColumn("class_id", F.lit("mine"))).collect()
    assert len(got) == len(rows)
    unique = {k: text for k, (_, text, _) in enumerate(rows)}
    want = brute_classes(unique)
    by_class = defaultdict(list)
    for k, (c, _) in want.items():
        by_class[c].append(rows[k][0])
    least = {c: min((d for d in ids if d is not None), default=None) for c, ids in by_class.items()}
    expected = Counter((rows[k][0], rows[k][1], least[c], n) for k, (c, n) in want.items())
    assert Counter((r.doc_id, r.text, r.class_id, r.n_links) for r in got) == expected
    assert sum(r.kept for r in got) == len(by_class)
    assert jaccard.near_groups(_docs(spark)).count() == 0


@pytest.mark.parametrize("shingles", [1 << 20, 300])
def test_clusters_of_growing_texts(spark, monkeypatch, shingles):
    """Prefixes of one text, each a few words longer: neighbours are alike, far ones are not; none is lost."""
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", shingles)
    words = [f"w{i}" for i in range(900)]
    rows = [(i, " ".join(words[:n]), "s") for i, n in enumerate(range(30, 900, 6))]
    want = brute_classes({i: text for i, text, _ in rows})
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard.near_groups(_docs(spark, *rows)).collect()}
    assert got == want


def test_blocks_meet_where_sizes_allow(spark, monkeypatch):
    """Every pair at the threshold meets exactly once, and rows go to a part of their cluster's blocks."""
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    sizes = [1, 2, 3, 4, 5, 6, 10, 12, 15, 100, 101, 124, 125, 126, 156, 157, 10_000] * 3 + list(range(200, 400))
    members = spark.createDataFrame([(7, i, n) for i, n in enumerate(sizes)], "root long, at long, n long")
    met, rows = Counter(), jaccard.in_reach(members, "root").collect()
    blocks = defaultdict(lambda: ([], []))
    for r in rows:
        blocks[r.lo, r.hi][r.side].append(r["at"])
    for (lo, hi), (left, right) in blocks.items():
        met.update((min(a, b), max(a, b)) for k, a in enumerate(left) for b in (right if lo != hi else left[k + 1 :]))
    able = {(a, b) for a in range(len(sizes)) for b in range(a + 1, len(sizes)) if 5 * min(sizes[a], sizes[b]) >= 4 * max(sizes[a], sizes[b])}
    assert able <= set(met) and set(met.values()) == {1}
    assert len(rows) < len(sizes) * len({lo for lo, _ in blocks})


def test_bayesian_pruning_keeps_what_may_reach_the_threshold():
    assert [jaccard.fewest_matches(n) for n in (16, 64)] == sorted(jaccard.fewest_matches(n) for n in (16, 64))
    chance = np.random.default_rng(1)
    left = chance.integers(0, 2**32, (50, jaccard.CHECKED), dtype=np.uint32)
    right = np.where(chance.random(left.shape) < 0.85, left, left + 1)
    i, j = jaccard.likely(left, right)
    assert set(zip(i.tolist(), j.tolist())) == {(k, k) for k in range(50)}


def test_components_of_chains_and_stars(spark):
    pairs = [(i, i + 1) for i in range(1, 60)] + [(1000, 1000 + k) for k in range(1, 50)] + [(5, 5), (70, 71), (71, 70)]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = {**{i: 1 for i in range(1, 61)}, **{1000 + k: 1000 for k in range(50)}, 70: 70, 71: 70}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_positions_of_a_hot_key(spark):
    df = spark.range(5000).selectExpr("if(id % 3 = 0, 'hot', cast(id % 7 as string)) k", "id % 11 v", "id")
    seen = defaultdict(list)
    for r in positions(df, ["k"], ["v", "id"]).collect():
        seen[r.k].append((r.position, (r.v, r.id)))
    for at in seen.values():
        at.sort()
        assert [p for p, _ in at] == list(range(len(at))) and [o for _, o in at] == sorted(o for _, o in at)


# ---------------------------------------------------------------- mixing


def _targets(sizes, limit=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    total, open_, out = sum(sizes.values()), set(sizes), {}
    while open_:
        level = (total - sum(out.values())) / sum(weight[s] for s in open_)
        over = [s for s in open_ if weight[s] * level > limit * sizes[s]]
        if not over:
            return out | {s: weight[s] * level for s in open_}
        out |= {s: limit * sizes[s] for s in over}
        open_ -= set(over)
    return out


def test_mix(spark):
    chance = random.Random(6)
    rows = [
        (i, "w " * min(2000, int(chance.expovariate(0.02)) + 1), chance.choice(["a", "a", "a", "b", "c", "d", None]))
        for i in range(1500)
    ] + [(9000 + i, None, "empty") for i in range(5)] + [(9999, "w " * 50, "tiny")] * 2
    docs = _docs(spark, *rows).withColumn("target", F.lit("mine"))
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(_words(text))
    want = _targets(dict(sizes))
    taken, largest = Counter(), Counter()
    for r in got:
        assert r.size == len(_words(r.text)) and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source]) and 0 <= r.copies <= 3
        taken[r.source] += r.size * r.copies
        largest[r.source] = max(largest[r.source], r.size)
    for source, target in want.items():
        assert abs(taken[source] - target) <= largest[source] + 1e-6
    again = mixing.mix(docs.repartition(7)).collect()
    key = lambda rs: sorted((r.doc_id, r.copies) for r in rs)
    assert key(got) == key(again)
    assert mixing.emit(mixing.mix(docs)).count() == sum(r.copies for r in got)
    assert mixing.mix(_docs(spark)).count() == 0


# ---------------------------------------------------------------- packing


def test_word_tokens_are_those_of_the_whole_text():
    tokens = packing.WordTokens(packing.tokenizer_path(), most=50)
    chance = random.Random(1)
    letters = [chr(c) for c in [*range(1, 0x250), 0x301, 0x3A3, 0x2019, 0x1E9E, 0x2028, 0x3000]] + ["a", " ", "'"] * 99
    texts = ["".join(chance.choices(letters, k=chance.randint(0, 40))) for _ in range(3000)]
    texts += ["", "I'll a's 'S <|endoftext|> b<|endoftext|>", "é" * 500, "A" * 300, "a\x1cb ½ ²3 日本語 İ"]
    for text in texts:
        want = tokens.whole.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(tokens.of(text), "<u4").tolist() == want


@pytest.mark.parametrize("seed", range(12))
def test_plan(seed):
    chance = random.Random(seed)
    capacity = chance.choice([10, 50, 4096])
    lengths = [chance.randint(1, capacity) if seed % 2 else chance.randint(capacity // 4, capacity) for _ in range(400)]
    runs, sequences, fixed = packing.plan(Counter(lengths), capacity)
    used, seen = defaultdict(list), Counter()
    for r in runs:
        for n in range(r.n):
            used[r.to + n // r.per].append((r.offset + n % r.per * r.length, r.length))
            assert r.first + n == seen[r.length]
            seen[r.length] += 1
    assert seen == Counter(lengths) and sorted(used) == list(range(sequences)) and fixed <= sequences
    for parts in used.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    bins = []  # best fit decreasing, one by one
    for length in sorted(lengths, reverse=True):
        fit = [k for k, room in enumerate(bins) if room >= length]
        if fit:
            bins[min(fit, key=bins.__getitem__)] -= length
        else:
            bins.append(capacity - length)
    assert -(-sum(lengths) // capacity) <= sequences <= len(bins)


def test_plan_fixes_dominant_pairs():
    assert packing.plan({6: 3, 4: 3}, 10)[1:] == (3, 3)
    assert packing.plan({10: 2, 7: 1, 2: 1}, 10)[1:] == (3, 3)
    assert packing.plan({}, 10) == ([], 0, 0)


def test_packed_documents(spark):
    rows = ODD + [(i, "word " * (i * 37 % 900), "s") for i in range(10, 200)]
    got = packing.pack_documents(_docs(spark, *rows).withColumn("piece", F.lit("x")), capacity=256, keep_ids=True).collect()
    whole = packing.WordTokens(packing.tokenizer_path()).whole
    want = Counter()
    for d, text, _ in rows:
        ids = whole.encode(text or "", add_special_tokens=False).ids + [1]
        for k in range(0, len(ids), 256):
            part = np.array(ids[k : k + 256], dtype="<u4")
            want[d, k // 256, k, len(part), zlib.crc32(part.tobytes()), tuple(part.tolist())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, tuple(r.ids)) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]
        assert sum(n for _, n in parts) <= 256
    assert packing.pack_documents(_docs(spark)).count() == 0
