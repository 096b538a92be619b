"""Mixing sources to target weights by systematic sampling.

Each source has a target size: its share of the total by weight, at most `limit` times its own size, what is
cut off being shared out again by weight. Within a source every document is expected target / size times.
The documents stand in order of size (then id); the running sum of expected copies plus one random offset of
the source crosses an integer for each copy that is emitted. A document gets the floor or the ceiling of its
expected copies, and because neighbours are alike in size, the words taken differ from the target by less
than the largest document of the source. The offset comes from the seed and the source's name, so reruns
agree.

A null source is a source of its own, the last one. Null and empty texts have size 0; a source without words
has target 0 and gets no copies. Documents alike in size and id (repeated rows) are interchangeable. Columns
named like a result are replaced by it. An empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from labtrail.llm.common import positions, query, staged, table, word_count

WEIGHTS = (1, 2, 3)
LIMIT = 3
OFFSET_BITS = 20


def offset(source: Column, seed: str) -> Column:
    """The source's random number in [0, 1): the first bits of md5(seed, source)."""
    digits = OFFSET_BITS // 4
    name = F.concat(F.lit(seed + ":"), F.coalesce(source, F.lit("")))
    return F.conv(F.substring(F.md5(name), 1, digits), 16, 10).cast("double") / float(2**OFFSET_BITS)


def targets(sizes: DataFrame, weights=WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """(source, size) rows summed to one row per source: source, source_size (long), target (double).

    With sources in order of limit * size / weight, level(i) = what is left of the total when all before i are
    cut off, per weight that is left. It rises as long as sources have to be cut off and falls from there, so
    its maximum is the common level and a source gets the lesser of limit * size and weight * level. The
    windows run over one row per source.
    """
    own = sizes.groupBy("source").agg(F.coalesce(F.sum("size"), F.lit(0)).cast("long").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weighed = own.withColumn(
        "weight", F.get(F.array(*map(F.lit, weights)), place % len(weights)).cast("double")
    ).withColumn("most", F.col("source_size") * float(limit))
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    cut, gone = (F.coalesce(F.sum(c).over(before), F.lit(0.0)) for c in ("most", "weight"))
    level = (F.sum("source_size").over(everything) - cut) / (F.sum("weight").over(everything) - gone)
    return (
        weighed.withColumn("level", level)
        .withColumn("level", F.max("level").over(everything))
        .select("source", "source_size", F.least("most", F.col("weight") * F.col("level")).alias("target"))
    )


def mix(
    docs: DataFrame, size: Column | None = None, source: str = "source", doc_id: str = "doc_id",
    text: str = "text", seed: str = "mix", weights=WEIGHTS, limit: int = LIMIT,
) -> DataFrame:
    """`docs` with size, source_size, target and copies: how many times the mix takes the row (0 to limit).

    `size` is an expression for a document's size; without one, the number of words of its text.
    """
    own = ("size", "source_size", "target", "copies")
    columns = [c for c in docs.columns if c.lower() not in own]
    sized = docs.select(
        F.struct(*columns).alias("__row"),
        F.col(source).alias("source"),
        F.col(doc_id).alias("__id"),
        F.monotonically_increasing_id().alias("__at"),
        (word_count(F.col(text)) if size is None else size.cast("long")).alias("size"),
    )
    # Written with their numbers, so that places are worked out on narrow rows and joined back.
    sized = staged(sized, "sized")
    narrow = sized.drop("__row")
    goals = staged(targets(narrow.select("source", "size"), weights, limit), "targets")
    goals = goals.withColumnRenamed("source", "__source")
    placed = positions(narrow, ["source"], ["size", "__id"], "__place")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    start = offset(F.col("source"), seed)
    copies = F.floor(start + rate * (F.col("__place") + 1)) - F.floor(start + rate * F.col("__place"))
    counted = placed.join(goals, F.col("source").eqNullSafe(F.col("__source"))).select(
        "__at", "size", "source_size", "target", copies.cast("int").alias("copies")
    )
    return sized.select("__at", "__row").join(counted, "__at").select(
        "__row.*", "size", "source_size", "target", "copies"
    )


def emit(mixed: DataFrame) -> DataFrame:
    """One row per copy; the columns of `mix` less its own."""
    columns = [c for c in mixed.columns if c not in ("size", "source_size", "target", "copies")]
    return mixed.select(*columns, F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias("__copy")).drop("__copy")


OP4_SQL = r"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), own AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight
  FROM docs GROUP BY source
), levels AS (
  SELECT source, source_size, weight, source_size * 3.0::DOUBLE AS most,
         (sum(source_size) OVER ()
          - coalesce(sum(source_size * 3) OVER before, 0))::DOUBLE
         / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM own
  WINDOW before AS (ORDER BY source_size * 3.0::DOUBLE / weight, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), goals AS (
  SELECT source, source_size, least(most, weight * max(level) OVER ()) AS target FROM levels
), placed AS (
  SELECT d.*, g.source_size, g.target,
         CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0.0::DOUBLE END AS rate,
         ('0x' || substr(md5('mix:' || coalesce(d.source, '')), 1, 5))::BIGINT / 1048576.0::DOUBLE AS start,
         row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id) - 1 AS place
  FROM docs d JOIN goals g ON g.source IS NOT DISTINCT FROM d.source
)
SELECT doc_id, size, source_size, target,
       (size * (floor(start + rate * (place + 1)) - floor(start + rate * place)))::BIGINT AS taken
FROM placed
"""


@query("op4_mixing", OP4_SQL)
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    mixed = mix(docs.select("doc_id", "source", word_count(F.col("text")).alias("words")), F.col("words"))
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken")
    )
