"""Five stages that turn `documents` into packed training sequences.

Each stage takes what the one before kept, all of it, and hands on documents with the columns of the table; the
last one returns the packed pieces. No stage can be written in SQL as a whole, so there is none for run().

Columns besides doc_id, text and source go through the first four stages unchanged, whatever their names: the operators
see them under other names, so none is taken for a result or replaced by one. Null and empty texts are scored
like any other, are copies of one another, and, where they pass, take no words of the mix and one token in a sequence.
Null ids and sources are kept as such. Of repeated rows, and of rows alike in text, one stays, the one with the
least id. Texts of any length are read whole. An empty table gives empty results at every stage; then, or without
labels of both classes, the classifier's score is the share of good labels, smoothed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labtrail.llm import exact, jaccard, mixing, packing, quality
from labtrail.llm.common import query, staged, table

READ = ("doc_id", "text", "source")


def aside(docs: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """`docs` with the columns that no stage reads under names of their own, and what gives them theirs back."""
    names = {c: c if c in READ else f"__given{i}" for i, c in enumerate(docs.columns)}
    renamed = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    return renamed, lambda out: out.select(*[F.col(n).alias(c) for c, n in names.items()])


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier does not reject."""
    docs, back = aside(docs)
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return back(quality.classify(docs, model, keep_text=True).where("predicted = 1"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts."""
    docs, back = aside(docs)
    return back(exact.exact_groups(docs).where("kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    docs, back = aside(docs)
    return back(jaccard.near_groups(docs).where("kept"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    docs, back = aside(docs)
    return back(mixing.emit(mixing.mix(docs)))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences with their places."""
    return packing.pack_documents(docs.select("doc_id", "text"))


STAGES = [
    ("quality classifier", keep_good),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack_sequences),
]
ORACLE_SQL = None


@query("pipeline", ORACLE_SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
