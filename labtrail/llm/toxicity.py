"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word stands for the mean of the vectors of its character n-grams, which live in a hashed table, so words
never seen share vectors with those they look like. A text is read in short stretches of words; the mean of a
stretch's word vectors goes through a linear softmax of two classes, and the text's score is that of its most
toxic stretch. Averaging over stretches instead of the whole text keeps one insult in a long text from
fading. Embeddings and softmax learn together from the labels of whole texts.

Null and empty texts have no stretch; they get the score of an empty mean, the softmax of the biases. Where
the labels hold only one class (or none) the score is the smoothed share of label 1. Each row is scored by
itself: repeated rows get equal scores. Texts of any length are scored whole, and an empty table gives no rows. Columns
named like a result are replaced by it.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labtrail.llm.common import held_out, query, table
from labtrail.llm.labelled import labelled_rows, rows_of, within

FOLDS, FOLD = 5, 0
THRESHOLD = 0.5
TRAIN_ROWS_PER_CLASS = 3_000
TRAIN_CHARS = 16_000_000
SIZES = (3, 4, 5)
BUCKETS = 1 << 18
BLOCK_GRAMS = 1 << 20
DIMENSIONS = 8
STRETCH = 2
BLANK_TO_SPACE = str.maketrans("\t\n\x0b\f\r", "     ")


def grams(words: list[str], sizes=SIZES, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of the words (each with a space at either end), and where each word's begin."""
    ids, counts = [], []
    for start in range(0, len(words), 20_000):
        some, many = _grams(words[start : start + 20_000], sizes, buckets)
        ids.append(some)
        counts.append(many)
    every = np.concatenate(counts)
    return np.concatenate(ids), np.cumsum(every) - every


def _grams(words: list[str], sizes, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams, and how many each word has.

    The words are hashed together: a window of n characters is kept if it lies within one word and its ends.
    """
    codes = np.frombuffer((" " + " ".join(words) + " ").lower().encode("utf-32-le", "surrogatepass"), "<u4")
    codes = codes.astype(np.uint64)
    spaces = np.flatnonzero(codes == 32)
    word = np.cumsum(codes == 32) - 1  # of each character; an end belongs to the word after it
    length = np.diff(spaces)  # with one of the two ends
    of, hashed = [], []
    value = np.zeros(len(codes), dtype=np.uint64)
    for n in range(1, max(sizes) + 1):
        value = value[: len(codes) - n + 1] * np.uint64(0x100000001B3) + codes[n - 1 :]
        if n not in sizes:
            continue
        start = np.arange(len(value))
        own = np.minimum(word[: len(value)], len(length) - 1)
        inside = (start + n <= spaces[own] + length[own] + 1) & (word[: len(value)] < len(length))
        of.append(own[inside])
        mixed = (value[inside] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        hashed.append((mixed >> np.uint64(40)) % np.uint64(buckets))
    of = np.concatenate(of)
    order = np.argsort(of, kind="stable")
    return np.concatenate(hashed)[order].astype(np.int32), np.bincount(of, minlength=len(words))


class Bags:
    """The n-grams of words, gone through in blocks so that no array but their ids is as long as they are."""

    def __init__(self, words: list[str], sizes=SIZES, buckets: int = BUCKETS):
        self.ids, self.first = grams(words, sizes, buckets)
        self.many = np.diff(np.append(self.first, len(self.ids)))
        self.buckets = buckets

    def blocks(self) -> Iterator[tuple[slice, np.ndarray]]:
        """The words of each block, as a slice, and their n-grams."""
        ends = np.append(self.first, len(self.ids))
        a = 0
        while a < len(self.many):
            z = max(a + 1, int(np.searchsorted(ends, ends[a] + BLOCK_GRAMS, side="right")) - 1)
            yield slice(a, z), self.ids[ends[a] : ends[z]]
            a = z

    def means(self, lean: np.ndarray) -> np.ndarray:
        """The mean of each word's n-grams."""
        out = np.empty(len(self.many))
        for words, ids in self.blocks():
            out[words] = np.add.reduceat(lean[ids], self.first[words] - self.first[words.start])
        return out / self.many

    def sums(self, by_word: np.ndarray) -> np.ndarray:
        """What each n-gram gets from its words, in equal shares of the n-grams of a word."""
        share = by_word / self.many
        out = np.zeros(self.buckets)
        for words, ids in self.blocks():
            out += np.bincount(ids, np.repeat(share[words], self.many[words]), self.buckets)
        return out


class Texts:
    """Texts as word numbers: `kinds` are the distinct words, `tokens` the texts' words one after another."""

    def __init__(self, texts: Iterable[str | None]):
        kinds: dict[str, int] = {}
        counts, tokens = array("q"), array("i")
        for text in texts:
            words = [w for w in text.translate(BLANK_TO_SPACE).split(" ") if w] if text else []
            counts.append(len(words))
            tokens.extend(kinds.setdefault(w, len(kinds)) for w in words)
        self.kinds = list(kinds)
        self.tokens = np.array(tokens, dtype=np.int32)
        self.counts = np.array(counts, dtype=np.int64)

    def stretches(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First token and number of tokens of each stretch, and first stretch of each text that has one.

        A text of n words has ceil(n / width) stretches of as equal length as can be.
        """
        n = self.counts[self.counts > 0]
        many = -(-n // width)
        first = np.concatenate([[0], np.cumsum(n)[:-1]])
        stretch = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        begin = np.repeat(first, many) + stretch * np.repeat(n, many) // np.repeat(many, many)
        size = np.diff(np.append(begin, n.sum())).astype(np.int32)
        return begin, size, np.cumsum(many) - many


@dataclass
class Softmax:
    """Embeddings (buckets x dimensions), weights (dimensions x 2) and biases (2)."""

    embeddings: np.ndarray
    weights: np.ndarray
    biases: np.ndarray

    def lean(self) -> np.ndarray:
        """What each n-gram adds to the toxic side of the softmax over the other one."""
        return self.embeddings @ (self.weights[:, 1] - self.weights[:, 0])


class Scorer:
    """Scores of texts under a model; the margins of n-grams are worked out once."""

    def __init__(self, lean: np.ndarray, bias: float, width: int = STRETCH):
        self.lean, self.bias, self.width = lean, bias, width

    def margins(self, texts: Texts) -> np.ndarray:
        """Of each text, the margin of its most toxic stretch."""
        out = np.full(len(texts.counts), self.bias)
        if len(texts.kinds):
            word = Bags(texts.kinds, buckets=len(self.lean)).means(self.lean)
            begin, size, of = texts.stretches(self.width)
            mean = np.add.reduceat(word[texts.tokens], begin) / size
            out[texts.counts > 0] += np.maximum.reduceat(mean, of)
        return out

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(Texts(texts)), -30, 30)))


def fit(
    texts: Iterable[str | None], y: np.ndarray, warm: int = 30, steps: int = 50, width: int = STRETCH, seed: int = 7,
    buckets: int = BUCKETS, dimensions: int = DIMENSIONS, hardest: float = 10.0,
) -> Softmax:
    """Full-batch gradient steps on the logistic loss of stretches, the two classes weighing alike.

    Every stretch of a text labelled 0 is one of label 0. Of a text labelled 1 it is not known which stretch
    made it so: at first all share its loss, then more and more the ones that look most toxic. The first
    `warm` steps scale the whole gradient alike, so that n-grams of many toxic texts move most and chance
    finds hardly; the rest are steps of Adam, which also learn what is rare.
    """
    random = np.random.default_rng(seed)
    share = (y.sum() + 1) / (len(y) + 2)
    model = Softmax(
        random.normal(0, 0.1, (buckets, dimensions)),
        random.normal(0, 0.3, (dimensions, 2)),
        np.array([0.0, np.log(share / (1 - share))]),
    )
    if len(np.unique(y)) < 2:
        model.embeddings[:] = 0
        return model
    model.biases[:] = 0
    read = Texts(texts)
    y = y[read.counts > 0].astype(float)
    bags = Bags(read.kinds, buckets=buckets)
    read.kinds.clear()  # only their n-grams are needed from here on
    begin, size, of = read.stretches(width)
    many = np.diff(np.append(of, len(begin)))
    text_of = np.repeat(np.arange(len(of), dtype=np.int32), many)
    clean = y[text_of] == 0
    toxic_weight, clean_weight = 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1)
    values = (model.embeddings, model.weights, model.biases)
    first_moments, second_moments = ([np.zeros_like(v) for v in values] for _ in (0, 1))

    def attention(lead: np.ndarray, heat: float) -> np.ndarray:
        """How a text's loss is shared by its stretches, given how far each is behind the leading one."""
        e = np.exp(np.clip(heat * lead, -50, 0))
        return e / np.add.reduceat(e, of)[text_of]

    for t in range(1, steps + 1):
        # forward: one number a word, a mean a stretch
        mean = np.add.reduceat(bags.means(model.lean())[read.tokens], begin) / size
        lead = mean - np.maximum.reduceat(mean, of)[text_of]
        p = 1 / (1 + np.exp(-np.clip(mean + model.biases[1] - model.biases[0], -30, 30)))
        heat = min(hardest, 1.5 * hardest * (t / steps) ** 2)
        slope = np.where(
            clean, p * clean_weight / many[text_of], attention(lead, heat) * toxic_weight * (p - 1)
        )
        if 3 * t > steps:  # the leading stretch of a clean text decides its score
            slope += np.where(clean, p * attention(lead, 2 * hardest) * clean_weight, 0)
        # backward: by words, then by their n-grams
        by_gram = bags.sums(np.bincount(read.tokens, np.repeat(slope / size, size), len(bags.many)))
        apart = model.weights[:, 1] - model.weights[:, 0]
        pull = by_gram @ model.embeddings
        grads = (
            by_gram[:, None] * apart[None, :],
            np.stack([-pull, pull], axis=1),
            np.array([-slope.sum(), slope.sum()]),
        )
        for k, (value, grad, m, v) in enumerate(zip(values, grads, first_moments, second_moments)):
            m += 0.1 * (grad - m)
            v += 0.01 * (grad**2 - v)
            if t <= warm:
                value -= (0.02 if k else min(1.0, 2 * (1 - t / steps))) * m / (np.abs(m).max() + 1e-12)
            else:
                value -= 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
    return model


def train(
    docs: DataFrame, labels: DataFrame, rows_per_class: int = TRAIN_ROWS_PER_CLASS, chars: int = TRAIN_CHARS
) -> Softmax:
    """Fit on a bounded sample of the rows that are not held out.

    At most `rows_per_class` rows of each class reach the driver, and of those in turn the whole texts that have
    half of `chars` characters together (`within`). They are chosen by their lengths, before texts are read. Of a
    longer text than that nothing is learned.
    """
    docs = docs.select("doc_id", "text")
    known = labelled_rows(docs, labels, "toxic", ~held_out(F.col("doc_id"), FOLDS, FOLD), rows_per_class)
    schema, chosen = known.schema, []
    narrow = known.orderBy(F.xxhash64("__id"), "__id", "__hash", "__size").collect()
    for value in (0, 1):
        some = [r for r in narrow if r["__label"] == value]
        chosen += [some[i] for i in within([r["__size"] for r in some], chars // 2)]
    met = rows_of(docs, docs.sparkSession.createDataFrame(chosen, schema))
    got = met.select("text", "__label", "doc_id", "__hash").orderBy("doc_id", "__hash").toArrow()
    labels = got.column("__label").to_numpy().astype(float)
    # one text after another leaves the table, which is gone before the steps begin
    texts = (text.as_py() for chunk in got.column("text").chunks for text in chunk)
    del got
    return fit(texts, labels)


def classify(docs: DataFrame, model: Softmax, threshold: float = THRESHOLD) -> DataFrame:
    """Columns of `docs` less the text, with score and predicted."""
    others = [c for c in docs.columns if c.lower() not in ("text", "score", "predicted")]
    rows = docs.select(F.struct(*others, F.lit(0).alias("__none")).alias("__row"), F.col("text"))
    # one number per n-gram bucket: a bounded broadcast
    shared = docs.sparkSession.sparkContext.broadcast((model.lean(), float(model.biases[1] - model.biases[0])))
    schema = rows.drop("text").schema.add("score", "double")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(scorer(some.column(1).to_pylist()))], names=["__row", "score"]
                )

    return rows.mapInArrow(score, schema).select(
        *[F.col("__row").getField(c).alias(c) for c in others],
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    return classify(docs, model).select(
        "doc_id", held_out(F.col("doc_id"), FOLDS, FOLD).alias("held_out"), "score", "predicted"
    )
