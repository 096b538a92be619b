"""Bounded samples to fit a classifier on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def text_sample(texts: DataFrame, most: int, chars: int | None = None) -> list[str]:
    """At most `most` different texts of a column `text`, the first by a hash; the same on every run.

    Only hashes are sorted out first, so a task hands on `most` numbers and not that many texts. With `chars`
    the texts have that many characters together at most (`within`), chosen by their lengths.
    """
    if chars is not None:
        sized = texts.where(F.col("text").isNotNull()).select(
            "text", F.xxhash64("text").alias("hash"), F.length("text").alias("size")
        )
        narrow = sized.where(F.col("size") <= chars).select("hash", "size").distinct().orderBy("hash", "size").limit(most)
        schema, rows = narrow.schema, narrow.collect()
        chosen = texts.sparkSession.createDataFrame([rows[i] for i in within([r["size"] for r in rows], chars)], schema)
        met = sized.join(F.broadcast(chosen), ["hash", "size"]).groupBy("hash", "size").agg(F.min("text").alias("text"))
        return [r["text"] for r in met.orderBy("hash", "size").collect()]
    hashed = texts.where(F.col("text").isNotNull()).select("text", F.xxhash64("text").alias("hash"))
    first = hashed.select("hash").distinct().orderBy("hash").limit(most)
    last = first.agg(F.max("hash")).first()[0]
    if last is None:
        return []
    chosen = hashed.where(F.col("hash") <= last).groupBy("hash").agg(F.min("text").alias("text"))
    return [r["text"] for r in chosen.orderBy("hash").collect()]


def within(sizes: list[int], budget: int) -> list[int]:
    """Places of the sizes, in order, that fit into the budget together.

    One after another is taken while it fits; what does not fit is passed over and ends nothing. Sizes over a
    hundredth of the budget wait until the others have been seen, the smallest first, so that a few of them
    cannot use it up while smaller ones are there. Only a size over the whole budget never fits.
    """
    waiting = sorted((i for i, n in enumerate(sizes) if n > budget // 100), key=lambda i: (sizes[i], i))
    out = []
    for i in [*(i for i, n in enumerate(sizes) if n <= budget // 100), *waiting]:
        if sizes[i] <= budget:
            budget -= sizes[i]
            out.append(i)
    return sorted(out)


def labelled_rows(
    docs: DataFrame, labels: DataFrame, label: str, train: Column, rows_per_class: int, doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """At most `rows_per_class` labelled rows of `docs` of each class: `__id`, `__hash` and `__size` of the text, `__label`.

    The first by a hash of the id are taken, so the sample is the same on every run. `train` says of an id
    whether its label may be learned. Rows without id or with a label other than 0 and 1 are left out; an id
    labelled more than once counts with its largest label. Rows alike in id and text count once; an id with
    several texts has a row for each. The broadcast ids are bounded by the parameter, as the rows are.
    """
    known = (
        labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull() & train)
        .groupBy(F.col(doc_id).cast("long").alias("__id"))
        .agg(F.max(label).alias("__label"))
    )

    def first(rows: DataFrame, value: int, *order: str) -> DataFrame:
        return rows.where(F.col("__label") == value).orderBy(F.xxhash64("__id"), "__id", *order).limit(rows_per_class)

    ids = first(known, 0).union(first(known, 1))
    rows = (
        docs.select(F.col(doc_id).cast("long").alias("__id"), F.col(text).alias("__text"))
        .join(F.broadcast(ids), "__id")
        .select("__id", F.xxhash64("__text").alias("__hash"), F.coalesce(F.length("__text"), F.lit(0)).alias("__size"), "__label")
        .distinct()
    )
    return first(rows, 0, "__hash", "__size").union(first(rows, 1, "__hash", "__size"))


def rows_of(docs: DataFrame, chosen: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of `docs` for each of the chosen rows of `labelled_rows`, with `__hash` and `__label`."""
    same = (docs[doc_id].cast("long") == F.col("__id")) & (F.xxhash64(docs[text]) == F.col("__hash"))
    met = docs.join(F.broadcast(chosen), same & (F.coalesce(F.length(docs[text]), F.lit(0)) == F.col("__size")))
    return met.dropDuplicates(["__id", "__hash", "__size"]).drop("__id", "__size")


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, train: Column, rows_per_class: int, doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """`docs` of at most `rows_per_class` labelled rows of each class, with the label as `__label`: `labelled_rows`."""
    return rows_of(docs, labelled_rows(docs, labels, label, train, rows_per_class, doc_id, text), doc_id, text)
