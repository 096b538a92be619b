"""Personal data: fixed patterns first, then a skip-chain conditional random field that keeps labels consistent.

The patterns find e-mail addresses, IP addresses, payment cards (Luhn) and phone numbers. All words with a
digit or an @ are the nodes of a field; those in pattern spans have their label fixed. Neighbours in the text share a potential, and so do
repeated or similar nodes however far apart: the same word, the same mailbox, the same last seven digits.
Loopy message passing spreads what the patterns are sure of over each document, and words that come out as
personal data with enough certainty are added if they can be what they are taken for (a card's check digit, a
phone number's number of digits). Pattern spans stay as they are.

The field is trained here, on a bounded sample of the texts, by pseudo-likelihood: every node's label given
those of its neighbours, a pattern's kind for words in pattern spans and "none" for others. A third of the nodes hide
their own features and a third their neighbours, so that what either says alone is learned too.

Null and empty texts have no spans. Texts are read whole; a word of any length counts once, and the nodes of a
key are tied one to the next, so work grows with the text. Each row is read by itself: repeated rows get
equal spans. Of overlapping spans of different kinds all stay. An empty table gives no rows. Columns named like a
result are replaced by it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labtrail.llm.common import query, table
from labtrail.llm.labelled import text_sample

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
CERTAIN = 0.8
EDGES_AT_ONCE = 1 << 16
AGREE = 2.0
TRAIN_TEXTS = 4_000
TRAIN_CHARS = 12_000_000

MAILBOX = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A failed start within a run of digits fails at every later digit of the run too, hence the look behind.
ADDRESS = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
MARKS = re.compile("[0-9@]")
EDGES = ".,;:!?\"'()[]<>"
BLANKS_TO_SPACE = str.maketrans("\t\n\x0b\f\r", "     ")
DIGITS = re.compile("[0-9]+")


class Span(NamedTuple):
    kind: int  # index into LABELS; 0 for a word without one
    start: int
    end: int


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def pattern_spans(text: str) -> list[Span]:
    """Leftmost matches that do not overlap, kind by kind; those that fail a kind's check are dropped."""
    out = []
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in MAILBOX:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append(Span(1, start, found.end()))
        done = found.end() if found else at + 1
        at = text.find("@", done)
    if not DIGITS.search(text):
        return out
    for m in ADDRESS.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m[0].split(".")):
            out.append(Span(2, m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(Span(3, m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= sum(map(len, DIGITS.findall(m[0]))) <= 15:
                out.append(Span(4, m.start(), m.end()))
    return out


# ---------------------------------------------------------------- the field


def nodes_of(text: str, spans: list[Span]) -> list[Span]:
    """All words with a digit or an @, each with the kind of the first pattern span that touches it."""
    taken = sorted((s.start, s.end, s.kind) for s in spans)
    plain = text.translate(BLANKS_TO_SPACE)
    out, i, open_ = [], 0, []
    mark = MARKS.search(plain)
    while mark:
        at = mark.start()
        start, end = plain.rfind(" ", 0, at) + 1, plain.find(" ", at)
        end = len(plain) if end < 0 else end
        while i < len(taken) and taken[i][0] < end:
            open_.append(taken[i])
            i += 1
        open_ = [s for s in open_ if s[1] > start]
        out.append(Span(open_[0][2] if open_ else 0, start, end))
        mark = MARKS.search(plain, end)
    return out


BUCKETS = (0, 1, 2, 3, 4, 6, 7, 9, 11, 15, 19)
N_MAKEUP = 9
N_FEATURES = 2 + len(BUCKETS) + N_MAKEUP


def features_of(body: str) -> list[int]:
    """Indices of the features that hold for a word: a bias, its number of digits, and its make-up."""
    digits = "".join(DIGITS.findall(body))
    bucket = next((k for k, most in enumerate(BUCKETS) if len(digits) <= most), len(BUCKETS))
    makeup = (
        "@" in body, body.startswith("+"), "(" in body, any(c.isalpha() for c in body), body.count(".") >= 3,
        "-" in body, "=" in body or '"' in body, len(digits) == len(body.strip(EDGES)),
        13 <= len(digits) <= 19 and luhn(digits),
    )
    return [0, 1 + bucket, *(2 + len(BUCKETS) + k for k, holds in enumerate(makeup) if holds)]


def sound(kind: int, body: str) -> bool:
    """Whether an added span can be of its kind at all."""
    digits = "".join(DIGITS.findall(body))
    if kind == 2:
        parts = DIGITS.findall(body)
        return len(parts) == 4 and all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in parts)
    if kind == 3:
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == 1 or 7 <= len(digits) <= 15


def hopeless(kind: int, body: str) -> bool:
    """Whether neither this span nor any longer one can be of the kind: it has too many numbers or digits by now."""
    if kind == 1:
        return False
    parts = DIGITS.findall(body)
    return len(parts) > 4 if kind == 2 else sum(map(len, parts)) > 19


def keys_of(body: str) -> list[str]:
    """Nodes that share one of these are tied: the word, its mailbox, its last seven digits."""
    low = body.lower().strip(EDGES)
    keys = ["w" + low]
    box = low.split("@", 1)[0]
    if len(box) > 4 and ("@" in low or not low.isdigit()):
        keys.append("m" + box)
    digits = "".join(DIGITS.findall(body))
    if len(digits) >= 7:
        keys.append("d" + digits[-7:])
    return keys


def ties_of(text: str, nodes: list[Span]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of neighbouring nodes (only blanks and edge marks between them), and of each node and the next like it."""
    near, far, last = [], set(), {}
    for k, node in enumerate(nodes):
        if k:
            gap = text[nodes[k - 1].end : node.start]
            if len(gap) < 8 and not gap.translate(BLANKS_TO_SPACE).strip(EDGES + " "):
                near.append((k - 1, k))
        for key in keys_of(text[node.start : node.end]):
            if key in last:
                far.add((last[key], k))
            last[key] = k
    shape = lambda pairs: np.array(sorted(pairs), dtype=np.int64).reshape(-1, 2)
    return shape(near), shape(far)


@dataclass
class Field:
    """Log potentials: own features (features x labels), neighbours and ties (labels x labels, symmetric)."""

    own: np.ndarray
    near: np.ndarray
    far: np.ndarray

    def marginals(
        self, own: np.ndarray, known: np.ndarray, near: np.ndarray, far: np.ndarray, rounds: int = 30
    ) -> np.ndarray:
        """Label probabilities of the nodes by loopy sum-product; `known` labels (over 0) are held fixed."""
        n = len(LABELS)
        base = own.copy()
        fixed = np.flatnonzero(known)
        base[fixed] = -50.0
        base[fixed, known[fixed]] = 0.0
        pairs = np.concatenate([near, far])
        tables, kind = np.stack([self.near, self.far]), np.repeat([0, 1], [len(near), len(far)])
        source, target = np.concatenate([pairs[:, 0], pairs[:, 1]]), np.concatenate([pairs[:, 1], pairs[:, 0]])
        kind = np.concatenate([kind, kind])
        back = np.roll(np.arange(len(source)), len(pairs))
        messages = np.zeros((len(source), n))

        def beliefs():
            out = base.copy()
            np.add.at(out, target, messages)
            return out

        for _ in range(rounds):
            believed, new = beliefs(), np.empty_like(messages)
            for at in range(0, len(source), EDGES_AT_ONCE):  # labels x labels numbers for these edges only
                some = slice(at, at + EDGES_AT_ONCE)
                sent = (believed[source[some]] - messages[back[some]])[:, :, None] + tables[kind[some]]
                high = sent.max(axis=1, keepdims=True)
                new[some] = high[:, 0] + np.log(np.exp(sent - high).sum(axis=1))
            new -= new.max(axis=1, keepdims=True)
            change = np.abs(new - messages).max(initial=0.0)
            messages = 0.5 * messages + 0.5 * new
            if change < 1e-3:
                break
        out = beliefs()
        out = np.exp(out - out.max(axis=1, keepdims=True))
        return out / out.sum(axis=1, keepdims=True)

    def added(self, text: str, spans: list[Span], certain: float = CERTAIN) -> list[Span]:
        """Spans that the patterns did not find; neighbouring words of one kind make one span, as long as it can be."""
        nodes = nodes_of(text, spans)
        known = np.array([s.kind for s in nodes], dtype=np.int64)
        if known.all():
            return []
        near, far = ties_of(text, nodes)
        own = np.array([self.own[features_of(text[s.start : s.end])].sum(axis=0) for s in nodes])
        chance = self.marginals(own, known, near, far)
        best = chance.argmax(axis=1)
        good = (known == 0) & (best > 0) & (chance.max(axis=1) >= certain)
        tied = {int(b) for _, b in near}
        out: list[Span] = []
        k = 0
        while k < len(nodes):
            step = 1
            if good[k]:  # the longest run of neighbours of one kind that can be a span
                last, kind = k, int(best[k])
                while last + 1 in tied and good[last + 1] and best[last + 1] == kind:
                    if hopeless(kind, text[nodes[k].start : nodes[last + 1].end]):
                        break
                    last += 1
                for end in range(last, k - 1, -1):
                    body = text[nodes[k].start : nodes[end].end]
                    if sound(int(best[k]), body):
                        start = nodes[k].start + len(body) - len(body.lstrip(EDGES))
                        out.append(Span(int(best[k]), start, nodes[end].end - len(body) + len(body.rstrip(EDGES))))
                        step = end - k + 1
                        break
            k += step
        return out


def fit(texts: list[str], steps: int = 200, rate: float = 0.1, ridge: float = 1e-4, seed: int = 11) -> Field:
    """Train by pseudo-likelihood on texts labelled by the patterns.

    Ties are rare in most corpora, so their potentials are drawn towards agreement (AGREE), not towards 0.
    """
    n = len(LABELS)
    own, labels, near, far = [], [], [], []
    for text in texts:
        nodes = nodes_of(text, pattern_spans(text))
        offset = len(labels)
        for node in nodes:
            row = np.zeros(N_FEATURES)
            row[features_of(text[node.start : node.end])] = 1
            own.append(row)
            labels.append(node.kind)
        for pairs, to in zip(ties_of(text, nodes), (near, far)):
            to.append(pairs + offset)
    prior = np.zeros((N_FEATURES + 2 * n, n))
    prior[N_FEATURES + n :] = AGREE * np.eye(n)
    weights = prior.copy()
    if own:
        y = np.array(labels)
        around = np.zeros((2, len(y), n))
        for k, pairs in enumerate((np.concatenate(near), np.concatenate(far))):
            for a, b in ((0, 1), (1, 0)):
                np.add.at(around[k], (pairs[:, a], y[pairs[:, b]]), 1)
        x = np.array(own)
        hidden = np.random.default_rng(seed).integers(0, 3, len(x))
        x[hidden == 1, 1:] = 0
        around[:, hidden == 2] = 0
        x = np.concatenate([x, *around], axis=1)
        goal = np.eye(n)[y]
        m, v = np.zeros_like(weights), np.zeros_like(weights)
        for t in range(1, steps + 1):
            logits = x @ weights
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            grad = x.T @ (p - goal) / len(y) + ridge * (weights - prior)
            m += 0.1 * (grad - m)
            v += 0.01 * (grad**2 - v)
            weights -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
    pair = [weights[N_FEATURES + k * n : N_FEATURES + (k + 1) * n] for k in (0, 1)]
    return Field(weights[:N_FEATURES], *((w + w.T) / 2 for w in pair))


def train(docs: DataFrame, texts: int = TRAIN_TEXTS, chars: int = TRAIN_CHARS) -> Field:
    """Fit on at most `texts` different texts that have any node, the first by a hash of the text.

    Texts of any length are taken while they fit, so that no more than `chars` characters reach the driver; only
    a text longer than that is never taken.
    """
    return fit(text_sample(docs.where(F.col("text").rlike("[0-9@]")), texts, chars))


def digest(spans: list[Span]) -> str:
    """kind:start:end of the spans by kind and place, joined by commas."""
    return ",".join(f"{LABELS[s.kind]}:{s.start}:{s.end}" for s in sorted(spans))


def find(docs: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """`docs` less the text, with n_email, n_ip, n_card, n_phone, base_sha256 (pattern spans) and spans (all)."""
    own = ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")
    columns = [c for c in docs.columns if c.lower() not in own and c != text]
    rows = docs.select(F.struct(*columns, F.lit(0).alias("__none")).alias("__row"), F.col(text).alias("__text"))
    shared = docs.sparkSession.sparkContext.broadcast(field)
    schema = rows.drop("__text").schema
    for name in own:
        schema = schema.add(name, "long" if name.startswith("n_") else "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = (0, 0, 0, 0, sha256(b"").hexdigest(), "")
        for batch in batches:
            out = []
            for body in batch.column(1):
                body = body.as_py()
                if not body or not MARKS.search(body):
                    out.append(nothing)
                    continue
                spans = pattern_spans(body)
                base = digest(spans)
                counts = [sum(s.kind == k for s in spans) for k in range(1, len(LABELS))]
                every = digest(spans + shared.value.added(body, spans))
                out.append((*counts, sha256(base.encode()).hexdigest(), every))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            made = [pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], names=["__row", *own])

    found = rows.mapInArrow(run, schema)
    return found.select(*[F.col("__row").getField(c).alias(c) for c in columns], *own)


@query("op6_personal_data")
def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return find(docs, train(docs))
