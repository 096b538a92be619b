"""Steps of the trained models against plain versions that try everything."""

import itertools
import math

import numpy as np
import pytest

from labtrail.llm import pii, quality, toxicity

# ---------------------------------------------------------------- additive model


def _plain_tree(grad, hess, depth, ridge):
    """Leaf values of the bins: at each level the cut of greatest gain, if any gains."""
    whole = sum(grad) ** 2 / (sum(hess) + ridge)
    gain = lambda c: sum(sum(g) ** 2 / (sum(h) + ridge) for g, h in ((grad[:c], hess[:c]), (grad[c:], hess[c:])))
    cut = max(range(1, len(grad)), key=gain, default=None) if depth else None
    if cut is None or gain(cut) <= whole + 1e-9:
        return [sum(grad) / (sum(hess) + ridge)] * len(grad)
    return _plain_tree(grad[:cut], hess[:cut], depth - 1, ridge) + _plain_tree(grad[cut:], hess[cut:], depth - 1, ridge)


@pytest.mark.parametrize("seed", range(8))
def test_boosting_steps(seed):
    chance = np.random.default_rng(seed)
    grad, hess = chance.normal(size=12), chance.random(12) + 0.05
    for depth in (0, 1, 2, 3):
        assert np.allclose(quality._step(grad, hess, depth, 2.0), _plain_tree(list(grad), list(hess), depth, 2.0))
    grad, hess = chance.normal(size=(5, 4)), chance.random((5, 4)) + 0.05
    best = (-1.0, None)
    for i, j in itertools.product(range(1, 5), range(1, 4)):
        corners = [(slice(a, b), slice(c, d)) for a, b in ((0, i), (i, 5)) for c, d in ((0, j), (j, 4))]
        gain = sum(grad[s].sum() ** 2 / (hess[s].sum() + 2.0) for s in corners)
        if gain > best[0]:
            values = np.empty((5, 4))
            for s in corners:
                values[s] = grad[s].sum() / (hess[s].sum() + 2.0)
            best = (gain, values)
    values, gain = quality._quarters(grad, hess, 2.0)
    assert math.isclose(gain, best[0]) and np.allclose(values, best[1])


def test_boosted_tables_add_up():
    """The fit is its steps one after another, and a score is one look-up for each feature and pair."""
    chance = np.random.default_rng(3)
    x = np.round(chance.random((400, 3)), 1)
    y = (x[:, 0] + x[:, 1] * x[:, 2] + chance.normal(0, 0.2, 400) > 0.8).astype(float)
    model = quality.fit(x, y, rounds=2, pairs=2, pair_rounds=1, bins=6, pair_bins=3)
    total = np.full(len(y), model.intercept)
    plain = [[0.0] * (len(e) + 1) for e in model.edges]
    bins = [[sum(v >= e for e in model.edges[f]) for v in x[:, f]] for f in range(3)]
    for _ in range(2):
        for f in range(3):
            p = 1 / (1 + np.exp(-total))
            grad, hess = [0.0] * len(plain[f]), [0.0] * len(plain[f])
            for k, b in enumerate(bins[f]):
                grad[b] += y[k] - p[k]
                hess[b] += p[k] * (1 - p[k])
            step = [0.15 * v for v in _plain_tree(grad, hess, 2, 4.0)]
            plain[f] = [a + b for a, b in zip(plain[f], step)]
            total += np.array(step)[bins[f]]
    for f in range(3):
        assert np.allclose(model.single[f], plain[f])
    assert len(model.pair) == 2
    new = np.concatenate([x, [[-5.0, 9.0, 0.5], [0.3, 0.3, 0.3]]])
    for row, score in zip(new, model.score(new)):
        margin = model.intercept + sum(plain[f][sum(row[f] >= e for e in model.edges[f])] for f in range(3))
        for (f, g), values in model.pair.items():
            margin += values[sum(row[f] >= e for e in model.coarse[f]), sum(row[g] >= e for e in model.coarse[g])]
        assert math.isclose(score, 1 / (1 + math.exp(-margin)), rel_tol=1e-9)


# ---------------------------------------------------------------- skip-chain field


def _exact(field, own, known, near, far):
    """Label probabilities by going through all labellings."""
    n, labels = len(own), own.shape[1]
    out = np.zeros_like(own)
    for labelling in itertools.product(range(labels), repeat=n):
        if any(k and k != lab for k, lab in zip(known, labelling)):
            continue
        weight = sum(own[i, lab] for i, lab in enumerate(labelling) if not known[i])
        weight += sum(field.near[labelling[a], labelling[b]] for a, b in near)
        weight += sum(field.far[labelling[a], labelling[b]] for a, b in far)
        out[np.arange(n), labelling] += math.exp(weight)
    return out / out.sum(axis=1, keepdims=True)


@pytest.mark.parametrize("seed", range(6))
def test_messages_are_exact_on_trees_and_close_on_loops(seed):
    chance = np.random.default_rng(seed)
    labels = len(pii.LABELS)
    shape = lambda pairs: np.array(pairs, dtype=np.int64).reshape(-1, 2)
    symmetric = lambda m: (m + m.T) / 2
    field = pii.Field(
        np.zeros((1, labels)), symmetric(chance.normal(size=(labels, labels))), symmetric(chance.normal(size=(labels, labels)))
    )
    own = chance.normal(size=(6, labels))
    known = np.where(chance.random(6) < 0.3, chance.integers(1, labels, 6), 0)
    tree = [(int(chance.integers(k)), k) for k in range(1, 6)]
    near, far = shape(tree[:3]), shape(tree[3:])
    assert np.allclose(field.marginals(own, known, near, far), _exact(field, own, known, near, far), atol=5e-3)
    # a loop of weak ties: sum-product is no longer exact, but near
    weak = pii.Field(field.own, field.near * 0.3, field.far * 0.3)
    near, far = shape([(0, 1), (1, 2), (2, 3), (3, 4), (4, 5)]), shape([(0, 3), (2, 5)])
    assert np.allclose(weak.marginals(own, known, near, far), _exact(weak, own, known, near, far), atol=0.05)


# ---------------------------------------------------------------- subword bags


def _plain_gram_ids(word, buckets):
    body, out = f" {word.lower()} ", []
    for n in toxicity.SIZES:
        for i in range(len(body) - n + 1):
            value = 0
            for c in body[i : i + n]:
                value = (value * 0x100000001B3 + ord(c)) % 2**64
            out.append((((value + n) * 0x9E3779B97F4A7C15 % 2**64) >> 40) % buckets)
    return out


@pytest.mark.parametrize("block", [toxicity.BLOCK_GRAMS, 7])
@pytest.mark.parametrize("width", [2, 10**9])
def test_toxicity_scores_by_hand(monkeypatch, block, width):
    """Means of n-gram vectors by word, of words by stretch, through the softmax; the worst stretch counts."""
    monkeypatch.setattr(toxicity, "BLOCK_GRAMS", block)
    chance = np.random.default_rng(2)
    buckets = 97
    model = toxicity.Softmax(chance.normal(size=(buckets, 5)), chance.normal(size=(5, 2)), chance.normal(size=2))
    texts = ["one two three four five", "É a", "x", "", None, " \n\t ", "same same same", "longerword joined tail " * 5]
    got = toxicity.Scorer(model.lean(), float(model.biases[1] - model.biases[0]), width)(texts)
    for text, score in zip(texts, got):
        words = [w for w in (text or "").translate(toxicity.BLANK_TO_SPACE).split(" ") if w]
        n = -(-len(words) // width)
        stretches = [words[len(words) * k // n : len(words) * (k + 1) // n] for k in range(n)] or [[]]
        best = -1.0
        for stretch in stretches:
            vector = np.zeros(5)
            for word in stretch:
                vector += np.mean([model.embeddings[g] for g in _plain_gram_ids(word, buckets)], axis=0) / len(stretch)
            e = np.exp(vector @ model.weights + model.biases)
            best = max(best, e[1] / e.sum())
        assert math.isclose(score, best, rel_tol=1e-6)


def test_added_spans_have_no_length_of_their_own():
    """A run of words that the field is sure of is one span, however long, as long as it can be of its kind."""

    class Sure(pii.Field):
        def marginals(self, own, known, near, far, rounds=30):
            out = np.zeros((len(own), len(pii.LABELS)))
            out[:, self.kind] = 1.0
            return out

    nothing = np.zeros((len(pii.LABELS),) * 2)
    field = Sure(np.zeros((pii.N_FEATURES, len(pii.LABELS))), nothing, nothing)
    text = " ".join(f"box{i}@" for i in range(200))
    field.kind = 1
    assert [tuple(s) for s in field.added(text, [])] == [(1, 0, len(text))]
    field.kind = 4
    text = " ".join("12345" for _ in range(9))
    assert [(s.start, s.end) for s in field.added(text, [])] == [(0, 17), (18, 35), (36, 53)]


def test_messages_in_blocks(monkeypatch):
    chance = np.random.default_rng(8)
    labels = len(pii.LABELS)
    table = chance.normal(size=(labels, labels))
    field = pii.Field(np.zeros((1, labels)), table + table.T, 0.2 * (table + table.T))
    own, known = chance.normal(size=(40, labels)), np.zeros(40, dtype=np.int64)
    near = np.array([(i, i + 1) for i in range(39)])
    far = np.array([(i, i + 7) for i in range(0, 30, 3)])
    whole = field.marginals(own, known, near, far)
    monkeypatch.setattr(pii, "EDGES_AT_ONCE", 5)
    assert np.array_equal(whole, field.marginals(own, known, near, far))
