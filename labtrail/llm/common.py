"""Helpers the operators of this package share: queries, words, staged tables, positions, classes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# A word is a run of anything but space, tab, line feed, vertical tab, form feed and carriage return.
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
# of sessions on one machine that name no folder
_own_folders: dict[str, str] = {}
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "8m"


def query(name: str, sql: str | None = None):
    """Register a query under `name`, with the SQL it has to agree with if SQL can say it."""

    def register(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once per row, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """The words of a text in order; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANKS), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves `fold` when divided by `folds`; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == fold


# ---------------------------------------------------------------- staged tables


def shared_folder(spark: SparkSession) -> str:
    """The folder all machines share: spark.checkpoint.dir. Only a single-machine session may lack it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        application = spark.sparkContext.applicationId
        if application not in _own_folders:
            _own_folders[application] = "file://" + tempfile.mkdtemp(prefix="staged-")
        folder = _own_folders[application]
    return folder.rstrip("/")


def staged(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read from there.

    Cuts the lineage: a lost executor costs the tasks it ran, not the steps before, and rows that were dealt
    out keep their places. The files go when the application ends. During the write, rows go to Python in
    batches of few bytes, so that a task holds little of long texts at a time; the setting is put back.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(BATCH_SETTING)
    spark.conf.set(BATCH_SETTING, BATCH_BYTES)
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(BATCH_SETTING, before)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)


# ---------------------------------------------------------------- positions


def positions(df: DataFrame, key: list[str], order: list[str], name: str = "position") -> DataFrame:
    """`df` with each row's place (long, from 0) among the rows of its key, in the given order.

    Rows are dealt out by ranges of (key, order), so that a key with a third of all rows spreads over a third
    of the partitions; each partition numbers its own part of a key and adds the number of the key's rows in
    the partitions before. Nulls come first, as in any ascending sort. Rows alike in key and order take their
    places in any order.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(parts, *key, *order).withColumn("__part", F.spark_partition_id())
    dealt = staged(dealt, "positions")
    before = Window.partitionBy(*key).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    counts = (
        dealt.groupBy("__part", *key)
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    )
    counts = counts.select(F.struct(*key).alias("__key"), F.col("__part").alias("__of"), "__before")
    own = Window.partitionBy("__part", *key).orderBy(*order)
    numbered = dealt.withColumn("__place", F.row_number().over(own))
    same = (F.col("__part") == F.col("__of")) & F.struct(*key).eqNullSafe(F.col("__key"))
    return numbered.join(counts, same).select(
        *df.columns, (F.col("__before") + F.col("__place") - 1).cast("long").alias(name)
    )


# ---------------------------------------------------------------- classes


def components(links: DataFrame) -> DataFrame:
    """Connected components of `links` (columns `a`, `b`): each linked node and the least node of its component.

    Alternates two steps over the links until they stay the same. First every node points its larger
    neighbours to the least node of its neighbourhood, then its smaller ones. Both shrink to stars around
    the least nodes in a number of rounds that grows with the logarithm of the size. Each round is two
    aggregates and two joins over the links alone and is staged; only the number of links and a sum of
    their hashes reach the driver. A node with a large share of the links, as the centre of a large star has, is
    one whose rows adaptive execution splits. Returns columns `node`, `root`.
    """
    both = lambda d: d.select("a", "b").union(d.select(F.col("b").alias("a"), F.col("a").alias("b")))
    links = links.select("a", "b").where("a <> b").distinct()

    def told(edges: DataFrame, of: DataFrame) -> DataFrame:
        """`edges` with the least neighbour (`m`) that their `a` has in `of`."""
        # written, so that the join meets two plain shuffles and adaptive execution can split a star's centre
        least = staged(of.groupBy("a").agg(F.min("b").alias("m")), "least")
        return edges.join(least, "a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))

    def toward_least(edges: DataFrame) -> DataFrame:
        """Each larger neighbour of a node, and the least of the node and all its neighbours."""
        every = both(edges)
        return told(every.where("b > a"), every).where("a <> b").distinct()

    def among_smaller(edges: DataFrame) -> DataFrame:
        """Each node and its smaller neighbours, all pointing to the least of them."""
        least = edges.groupBy("a").agg(F.min("b").alias("b"))
        return told(edges, edges).union(least).where("a <> b").distinct()

    def state(edges: DataFrame):
        return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    # larger node first, from here on
    now = staged(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    was, is_ = None, state(now)
    while is_ != was and is_[0]:
        now = staged(among_smaller(toward_least(now)), "links")
        was, is_ = is_, state(now)
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.union(stars.select(F.col("root").alias("node"), "root").distinct())
