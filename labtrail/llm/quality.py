"""Quality classifier: a generalised additive model with pairwise interactions.

Features of the whole text are built-in functions. Each feature is cut into bins; cyclic boosting goes round
the features and adds a small step of a shallow tree to the feature's table, fitted to what all tables
together leave over. Then the pairs of features that explain most of the rest get tables of their own in the
same way. A score is the logistic of a sum of table entries, looked up for whole batches at once.

Null and empty texts have all features 0 and get a score like any other. Where the labels hold only one class
(or none) the score is the smoothed share of label 1. Each row is scored by itself: repeated rows get equal
scores. Texts of any length are read whole, and an empty table gives no rows. Columns named like a result are
replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labtrail.llm.common import held_out, query, table, words_of
from labtrail.llm.labelled import labelled_sample
from labtrail.llm.rules import STOP_WORDS

FOLDS, FOLD = 4, 2
THRESHOLD = 0.7
TRAIN_ROWS_PER_CLASS = 10_000
FEATURES = (
    "words", "word_chars", "symbols", "bars", "exclaims", "capitals", "digits", "stops", "ends", "distinct",
    "lines", "dup_lines",
)


def features(docs: DataFrame, text: str = "text", keep_text: bool = False) -> DataFrame:
    """The columns of `docs` (but the text, unless kept) as `__row`, and `__f` with the features in order."""
    body = F.coalesce(F.col(text), F.lit(""))
    counted = docs.select(
        F.struct(*[c for c in docs.columns if keep_text or c != text], F.lit(None).cast("string").alias("__none")).alias("__row"),
        words_of(body).alias("w"),
        F.filter(F.split(body, "\n"), lambda x: x != "").alias("l"),
        *(
            F.regexp_count(body, F.lit(p)).cast("double").alias(name)
            for name, p in (
                ("symbols", "[#*$%&<>]"), ("bars", r"\|"), ("exclaims", "!"), ("capitals", r"\p{Lu}"),
                ("digits", "[0-9]"), ("ends", "[.?]"),
            )
        ),
    )
    sized = counted.select(
        "__row", "symbols", "bars", "exclaims", "capitals", "digits", "ends",
        F.size("w").cast("double").alias("n"),
        F.length(F.array_join("w", "")).cast("double").alias("chars"),
        F.size(F.filter("w", lambda x: F.lower(x).isin(STOP_WORDS))).cast("double").alias("stops"),
        F.size(F.array_distinct("w")).cast("double").alias("distinct"),
        F.size("l").cast("double").alias("lines"),
        F.size(F.array_distinct("l")).cast("double").alias("kinds"),
    )
    n, chars = F.greatest("n", F.lit(1.0)), F.greatest("chars", F.lit(1.0))
    figures = (
        F.log1p("n"), F.col("chars") / n, F.col("symbols") / n, F.col("bars") / n, F.col("exclaims") / n,
        F.col("capitals") / chars, F.col("digits") / chars, F.col("stops") / n, F.col("ends") / n,
        F.col("distinct") / n, F.col("lines") / n, 1 - F.col("kinds") / F.greatest("lines", F.lit(1.0)),
    )
    return sized.select("__row", F.array(*figures).alias("__f"))


@dataclass
class Additive:
    """Tables over binned features: `single[f][bin]`, `pair[(f, g)][bin, bin]` on coarser bins."""

    edges: list[np.ndarray]
    coarse: list[np.ndarray]
    intercept: float
    single: list[np.ndarray] = field(default_factory=list)
    pair: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Scores in (0, 1) of the rows of x."""
        total = np.full(len(x), self.intercept)
        for f, values in enumerate(self.single):
            total += values[np.searchsorted(self.edges[f], x[:, f], side="right")]
        for (f, g), values in self.pair.items():
            total += values[
                np.searchsorted(self.coarse[f], x[:, f], side="right"),
                np.searchsorted(self.coarse[g], x[:, g], side="right"),
            ]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _cuts(column: np.ndarray, bins: int) -> np.ndarray:
    """Inner edges of at most `bins` bins with about equal numbers of rows."""
    edges = np.unique(np.quantile(column, np.arange(1, bins) / bins, method="higher"))
    return edges[edges > column.min()]


def _step(grad: np.ndarray, hess: np.ndarray, depth: int, ridge: float) -> np.ndarray:
    """Leaf value of each bin for a tree of up to `depth` levels over summed gradients by bin."""
    out = np.empty(len(grad))

    def grow(low: int, high: int, depth: int) -> None:
        g, h = np.cumsum(grad[low:high]), np.cumsum(hess[low:high])
        if depth and high - low > 1:
            left = g[:-1] ** 2 / (h[:-1] + ridge)
            right = (g[-1] - g[:-1]) ** 2 / (h[-1] - h[:-1] + ridge)
            at = int(np.argmax(left + right))
            if left[at] + right[at] > g[-1] ** 2 / (h[-1] + ridge) + 1e-9:
                grow(low, low + at + 1, depth - 1)
                grow(low + at + 1, high, depth - 1)
                return
        out[low:high] = g[-1] / (h[-1] + ridge)

    grow(0, len(grad), depth)
    return out


def _quarters(grad: np.ndarray, hess: np.ndarray, ridge: float) -> tuple[np.ndarray, float]:
    """Values of a tree with one cut in each of two features, and its gain: the best of all pairs of cuts."""
    g, h = grad.cumsum(0).cumsum(1), hess.cumsum(0).cumsum(1)
    if min(g.shape) < 2:
        return np.zeros_like(grad), 0.0
    a, ah = g[:-1, :-1], h[:-1, :-1]
    b, bh = g[:-1, -1:] - a, h[:-1, -1:] - ah
    c, ch = g[-1:, :-1] - a, h[-1:, :-1] - ah
    d, dh = g[-1, -1] - a - b - c, h[-1, -1] - ah - bh - ch
    gain = sum(x**2 / (y + ridge) for x, y in ((a, ah), (b, bh), (c, ch), (d, dh)))
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    out = np.empty_like(grad)
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :] = a[i, j] / (ah[i, j] + ridge), b[i, j] / (bh[i, j] + ridge)
    out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = c[i, j] / (ch[i, j] + ridge), d[i, j] / (dh[i, j] + ridge)
    return out, float(gain[i, j])


def fit(
    x: np.ndarray, y: np.ndarray, rounds: int = 60, pairs: int = 6, pair_rounds: int = 30, bins: int = 64,
    pair_bins: int = 8, rate: float = 0.15, depth: int = 2, ridge: float = 4.0,
) -> Additive:
    """Fit by cyclic boosting on rows x (one column per feature) with labels y (0 or 1)."""
    share = (y.sum() + 1) / (len(y) + 2)
    model = Additive([], [], float(np.log(share / (1 - share))))
    if len(np.unique(y)) < 2:
        return model
    model.edges = [_cuts(c, bins) for c in x.T]
    model.coarse = [_cuts(c, pair_bins) for c in x.T]
    fine = [np.searchsorted(e, c, side="right") for e, c in zip(model.edges, x.T)]
    wide = [np.searchsorted(e, c, side="right") for e, c in zip(model.coarse, x.T)]
    model.single = [np.zeros(len(e) + 1) for e in model.edges]
    total = np.full(len(y), model.intercept)

    def slopes():
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for f, at in enumerate(fine):
            grad, hess = (np.bincount(at, v, len(model.single[f])) for v in slopes())
            step = rate * _step(grad, hess, depth, ridge)
            model.single[f] += step
            total += step[at]

    def table_of(f: int, g: int, values: np.ndarray) -> np.ndarray:
        shape = len(model.coarse[f]) + 1, len(model.coarse[g]) + 1
        return np.bincount(wide[f] * shape[1] + wide[g], values, shape[0] * shape[1]).reshape(shape)

    grad, hess = slopes()
    gains = {
        (f, g): _quarters(table_of(f, g, grad), table_of(f, g, hess), ridge)[1]
        for f in range(x.shape[1])
        for g in range(f + 1, x.shape[1])
    }
    for f, g in sorted(gains, key=gains.get, reverse=True)[:pairs]:
        model.pair[f, g] = np.zeros((len(model.coarse[f]) + 1, len(model.coarse[g]) + 1))
    for _ in range(pair_rounds):
        for (f, g), values in model.pair.items():
            grad, hess = slopes()
            step = rate * _quarters(table_of(f, g, grad), table_of(f, g, hess), ridge)[0]
            values += step
            total += step[wide[f], wide[g]]
    return model


def train(docs: DataFrame, labels: DataFrame, rows_per_class: int = TRAIN_ROWS_PER_CLASS) -> Additive:
    """Fit on a bounded sample of the rows that are not held out; only their features reach the driver."""
    known = labelled_sample(
        docs.select("doc_id", "text"), labels, "quality", ~held_out(F.col("doc_id"), FOLDS, FOLD), rows_per_class
    )
    got = features(known).select("__row.doc_id", "__row.__hash", "__row.__label", "__f").orderBy("doc_id", "__hash").toArrow()
    x = np.array(got.column("__f").to_pylist(), dtype=float).reshape(-1, len(FEATURES))
    return fit(x, np.array(got.column("__label").to_pylist(), dtype=float))


def classify(docs: DataFrame, model: Additive, threshold: float = THRESHOLD, keep_text: bool = False) -> DataFrame:
    """Columns of `docs` (but the text, unless kept) with score and predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    read = features(docs, keep_text=keep_text)
    schema = read.drop("__f").schema.add("score", "double")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(shared.value.score(x))], names=["__row", "score"]
            )

    rows = read.mapInArrow(score, schema)
    others = [c for c in docs.columns if c.lower() not in ("score", "predicted") and (keep_text or c != "text")]
    return rows.select(
        *[F.col("__row").getField(c).alias(c) for c in others],
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )


@query("op10_quality_classifier")
def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    return classify(docs, model).select(
        "doc_id", held_out(F.col("doc_id"), FOLDS, FOLD).alias("held_out"), "score", "predicted"
    )
