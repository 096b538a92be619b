"""N-gram Jaccard join: documents whose sets of five-word shingles are at least 0.8 alike.

1. Each text becomes the set of hashes of its runs of five words (a shorter text is one run) and MinHash values
   of that set. Equal sets fold into one representative that counts its copies; from here on only
   representatives are compared, so copies are never expanded into pairs.
2. Representatives that agree in all values of some band are candidates: 40 bands of 5 values, so a pair at
   the threshold is missed with a chance of 1e-7, a closer one with less.
3. Candidates are compared on their MinHash values, a few at a time. With a uniform prior, the chance that a
   pair with m of n values equal reaches the threshold is that of at most m successes in n + 1 tries at
   the threshold; the pair is dropped as soon as that falls below 1e-6. What is left links representatives into
   tight clusters.
4. Within each cluster every pair whose sizes allow it is verified exactly, on the shingles of the whole texts.

A bucket or cluster of any size is cut into blocks, and a task compares two blocks at a time; blocks of a cluster hold
sets alike in size and meet only where the sizes can reach the threshold. It returns links
counted per document and the ends of a spanning forest, never the pairs; what it holds in memory is two blocks.

Every row comes back with class_id, the least doc_id of its class (the documents tied by links, directly or
through others), n_links, the number of other rows that are at least 0.8 like it, copies included, and kept,
true for one row of each class, the one with the least doc_id. Texts without words (null, empty, blank) are
like nothing: class_id is their own doc_id, n_links 0, kept true. Null ids count as larger than any number; a
class without any id has class_id null. Of repeated rows one is kept. Texts of any length are read whole. An empty
table gives no rows. Columns named like a result are replaced by it.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from fractions import Fraction
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from labtrail.llm.common import components, query, staged, table
from labtrail.operators.joins import attach

WIDTH = 5
THRESHOLD = Fraction(4, 5)
BANDS, ROWS = 40, 5
CHECKED, STEP = 64, 16
TOLERANCE = 1e-6
BLOCK = 1024
BLOCK_SHINGLES = 1 << 20
CACHED_WORDS = 100_000
BLANKS_TO_SPACE = str.maketrans("\t\n\x0b\f\r", "     ")

_random = np.random.default_rng(20240229)
MULTIPLIERS = _random.integers(0, 2**31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
ADDENDS = _random.integers(0, 2**32, BANDS * ROWS, dtype=np.uint32)
PLACES = _random.integers(0, 2**63, max(WIDTH, ROWS) + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingles:
    """Sorted distinct 64-bit hashes of a text's shingles."""

    def __init__(self):
        self.words: dict[str, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = [w for w in (text or "").translate(BLANKS_TO_SPACE).split(" ") if w]
        if not words:
            return np.empty(0, dtype=np.uint64)
        known = self.words
        if len(known) > CACHED_WORDS:
            known.clear()
        new = set(words).difference(known)
        for w in new:
            known[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))
        ids = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
        n = min(WIDTH, len(ids))
        total = np.full(len(ids) - n + 1, n, dtype=np.uint64) * PLACES[WIDTH]
        for k in range(n):
            total += ids[k : len(ids) - n + 1 + k] * PLACES[k]
        return np.unique(_mixed(total))


def minhash(shingles: np.ndarray) -> np.ndarray:
    """The least value of each hash function over the shingles."""
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    best = np.full(len(MULTIPLIERS), 2**32 - 1, dtype=np.uint32)
    for start in range(0, len(low), 512):
        values = low[start : start + 512, None] * MULTIPLIERS
        values += ADDENDS
        np.minimum(best, values.min(axis=0), out=best)
    return best


def bands(values: np.ndarray) -> np.ndarray:
    """One 64-bit number for the values of each band; different bands give different numbers."""
    split = values.reshape(BANDS, ROWS).astype(np.uint64)
    total = np.arange(BANDS, dtype=np.uint64) * PLACES[ROWS]
    for k in range(ROWS):
        total += split[:, k] * PLACES[k]
    return _mixed(total).view(np.int64)


def fewest_matches(n: int, threshold: float = float(THRESHOLD), tolerance: float = TOLERANCE) -> int:
    """The fewest of n equal values with which a pair may still reach the threshold."""
    below = 0.0
    for m in range(n + 1):
        below += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        if below >= tolerance:
            return m
    return n + 1


def likely(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of the rows of two tables of values whose similarity may reach the threshold."""
    i, j = (x.ravel() for x in np.indices((len(left), len(right)), dtype=np.int32))
    matches = np.zeros(len(i), dtype=np.int32)
    for start in range(0, CHECKED, STEP):
        for k in range(start, start + STEP):
            matches += left[i, k] == right[j, k]
        keep = matches >= fewest_matches(start + STEP)
        i, j, matches = i[keep], j[keep], matches[keep]
    return i, j


def common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Numbers of shingles in common, for each of `left` with each of `right`."""
    out = np.zeros((len(left), len(right)), dtype=np.float64)
    _, number = np.unique(np.concatenate(left + right), return_inverse=True)
    sizes = [len(s) for s in left + right]
    owner = np.repeat(np.arange(len(sizes)), sizes)
    number = number.ravel()
    order = np.argsort(number, kind="stable")
    number, owner = number[order], owner[order]
    many = np.bincount(number)
    keep = many[number] > 1  # shingles of one document only are in no pair
    number, owner = number[keep], owner[keep]
    columns = np.cumsum(np.diff(number, prepend=-1) > 0) - 1
    width = 4096
    for start in range(0, int(columns[-1]) + 1 if len(columns) else 0, width):
        a, b = np.searchsorted(columns, (start, start + width))
        block = np.zeros((len(sizes), width), dtype=np.float32)
        block[owner[a:b], columns[a:b] - start] = 1
        out += block[: len(left)] @ block[len(left) :].T
    return out


def roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Of n nodes with links i-j, the least node each is tied to."""
    now = np.arange(n)
    while True:
        new = now.copy()
        np.minimum.at(new, i, now[j])
        np.minimum.at(new, j, now[i])
        new = new[new]
        if (new == now).all():
            return now
        now = new


# ---------------------------------------------------------------- blocks


def in_blocks(members: DataFrame, key: str, size: str) -> DataFrame:
    """`members` once for each pair of blocks their block is in: columns lo, hi, and side (0 for lo).

    `size` is the number of members of the key. A key of up to BLOCK members is one block, met by itself.
    """
    many = F.ceil(F.col(size) / BLOCK).cast("int")
    dealt = members.withColumn("__own", F.pmod(F.xxhash64("at"), many).cast("int")).withColumn(
        "__other", F.explode(F.sequence(F.lit(0), many - 1))
    )
    return dealt.select(
        *members.columns,
        F.least("__own", "__other").alias("lo"),
        F.greatest("__own", "__other").alias("hi"),
        (F.col("__own") > F.col("__other")).cast("int").alias("side"),
    ).repartition(F.col(key), "lo", "hi").sortWithinPartitions(key, "lo", "hi")


def in_reach(members: DataFrame, key: str) -> DataFrame:
    """`members` once for each pair of blocks that may hold pairs at the threshold: columns lo, hi, and side.

    Sets at the threshold are alike in size, so the members of a key fall into classes by size, each reaching up to
    the threshold's inverse times the one before, and a class meets itself and its two neighbours only. Classes are
    cut into blocks of bounded members and shingles. Sizes of classes come by `attach`, so a large key spreads.
    """
    ratio = float(1 / THRESHOLD)
    level = F.floor(F.log(F.col("n").cast("double")) / math.log(ratio)).cast("int")
    members = members.withColumn("__level", level)
    holds = F.greatest(F.lit(1), F.least(F.lit(2 * BLOCK), F.floor(BLOCK_SHINGLES / F.pow(F.lit(ratio), F.col("__level") + 1))))
    classes = members.groupBy(key, "__level").agg(F.count(F.lit(1)).alias("__many"))
    classes = classes.withColumn("__blocks", F.ceil(F.col("__many") / holds).cast("int"))
    row = Window.partitionBy(key).orderBy("__level")

    def beside(step: int) -> Column:
        """Blocks of the neighbouring class, none if there is no such class."""
        met = F.lag("__level", -step).over(row) == F.col("__level") + step
        return F.when(met, F.lag("__blocks", -step).over(row)).otherwise(0)

    classes = classes.withColumns({"__below": beside(-1), "__above": beside(1)})
    told = attach(members, classes, [key, "__level"], weight="__many")

    def places(step: int, blocks: str) -> Column:
        first = (F.col("__level") + step).cast("long") * 2**32
        numbers = F.sequence(F.lit(0), F.greatest(F.col(blocks) - 1, F.lit(0)))
        return F.when(F.col(blocks) > 0, F.transform(numbers, lambda b: first + b)).otherwise(F.array().cast("array<bigint>"))

    own = F.col("__level").cast("long") * 2**32 + F.pmod(F.xxhash64("at"), F.col("__blocks"))
    others = F.concat(places(-1, "__below"), places(0, "__blocks"), places(1, "__above"))
    dealt = told.withColumn("__own", own).withColumn("__other", F.explode(others))
    return dealt.select(
        *[c for c in members.columns if c != "__level"],
        F.least("__own", "__other").alias("lo"),
        F.greatest("__own", "__other").alias("hi"),
        (F.col("__own") > F.col("__other")).cast("int").alias("side"),
    )


def by_block(rows: DataFrame, key: str, run: Callable[[dict, bool], list[tuple]], schema: str, kinds) -> DataFrame:
    """`run(columns, apart)` on the rows of each pair of blocks; apart: the two blocks are different ones."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        held_key = None

        def finish():
            columns = pa.Table.from_batches(held).to_pydict()
            return run(columns, held_key[1] != held_key[2])

        out: list[tuple] = []
        names = [c.split()[0] for c in schema.split(", ")]

        def batch_of(out):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

        for batch in batches:
            keys = [batch.column(batch.schema.get_field_index(c)).to_numpy() for c in (key, "lo", "hi")]
            change = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
            edges = [0, *change.tolist(), batch.num_rows]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                this = tuple(int(k[a]) for k in keys)
                if held and this != held_key:
                    out += finish()
                    held = []
                held_key = this
                held.append(batch.slice(a, b - a))
            if len(out) > 10_000:
                yield batch_of(out)
                out = []
        if held:
            out += finish()
        if out:
            yield batch_of(out)

    return rows.mapInArrow(blocks, schema)


def _prune(columns: dict, apart: bool) -> list[tuple]:
    """Ends of a spanning forest of the likely pairs."""
    at = np.array(columns["at"], dtype=np.int64)
    values = np.frombuffer(b"".join(columns["values"]), dtype="<u4").reshape(len(at), -1)
    left, right = _sides(columns, apart)
    i, j = likely(values[left], values[right])
    root = at[roots(len(at), left[i], right[j])]
    return [(a, b) for a, b in zip(at.tolist(), root.tolist()) if a != b]


def _verify(columns: dict, apart: bool) -> list[tuple]:
    """Each document that has links: their number, and the root of its tree in the spanning forest."""
    of = Shingles()
    at = np.array(columns["at"], dtype=np.int64)
    copies = np.array(columns["copies"], dtype=np.int64)
    sets = [of(t) for t in columns["text"]]
    size = np.array([len(s) for s in sets])
    left, right = _sides(columns, apart)
    if not len(left) or not len(right):
        return []
    both = common([sets[k] for k in left], [sets[k] for k in right])
    union = size[left][:, None] + size[right][None, :] - both
    i, j = np.nonzero(THRESHOLD.denominator * both >= THRESHOLD.numerator * union)
    i, j = left[i], right[j]
    if not apart:
        i, j = i[i < j], j[i < j]
    links = np.bincount(i, copies[j], len(at)) + np.bincount(j, copies[i], len(at))
    root = at[roots(len(at), i, j)]
    return [(a, int(n), b) for a, n, b in zip(at.tolist(), links.tolist(), root.tolist()) if n]


def _sides(columns: dict, apart: bool) -> tuple[np.ndarray, np.ndarray]:
    side = np.array(columns["side"])
    return (np.flatnonzero(side == 0), np.flatnonzero(side == 1)) if apart else (np.arange(len(side)),) * 2


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    of = Shingles()
    for batch in batches:
        text = batch.column(batch.schema.get_field_index("__text"))
        sizes, marks, all_bands, values = [], [], [], []
        for body in text:
            shingles = of(body.as_py())
            sizes.append(len(shingles))
            marks.append(blake2b(shingles.tobytes(), digest_size=16).hexdigest())
            least = minhash(shingles)
            all_bands.append(bands(least) if len(shingles) else np.empty(0, dtype=np.int64))
            values.append(least[:CHECKED].astype("<u4").tobytes())
        kept = [i for i, name in enumerate(batch.schema.names) if name != "__text"]
        made = (
            pa.array(sizes, pa.int64()), pa.array(marks), pa.array(all_bands, pa.list_(pa.int64())),
            pa.array(values, pa.binary()),
        )
        yield pa.RecordBatch.from_arrays(
            [batch.column(i) for i in kept] + list(made),
            names=[batch.schema.names[i] for i in kept] + ["n", "mark", "bands", "values"],
        )


def near_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """`docs` with class_id, n_links and kept."""
    own = ("class_id", "n_links", "kept")
    columns = [c for c in docs.columns if c.lower() not in own]
    read = docs.select(
        F.struct(*columns).alias("__row"),
        F.col(doc_id).cast("long").alias("id"),
        F.monotonically_increasing_id().alias("at"),
        F.col(text).alias("__text"),
    )
    schema = read.drop("__text").schema.add("n", "long").add("mark", "string")
    schema = schema.add("bands", ArrayType(LongType())).add("values", "binary")
    rows = staged(read.mapInArrow(_sketch, schema), "sketches")

    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "at"))
    sets = rows.where("n > 0").groupBy("mark", "n").agg(first.alias("first"), F.count(F.lit(1)).alias("copies"))
    sets = staged(sets.withColumn("at", F.col("first.at")), "sets")
    heads = rows.select("at", "bands", "values").join(sets.select("at", "copies"), "at")

    # Buckets with the same members as another one tell nothing new; only the first of them stays.
    members = heads.select("at", F.explode("bands").alias("bucket"))
    buckets = (
        members.groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("size"), F.min("at").alias("least"), F.bit_xor(F.xxhash64("at")).alias("all"))
        .where("size > 1")
        .groupBy("size", "least", "all")
        .agg(F.min("bucket").alias("bucket"))
        .select("bucket", "size")
    )
    candidates = members.join(buckets, "bucket").join(heads.select("at", "values"), "at")
    pruned = by_block(
        in_blocks(candidates, "bucket", "size"), "bucket", _prune, "a bigint, b bigint", [pa.int64(), pa.int64()]
    )
    clusters = staged(components(pruned), "clusters")

    # Which blocks meet is worked out on narrow rows; the texts join them last.
    known = clusters.withColumnRenamed("node", "at").join(sets.select("at", "copies", "n"), "at")
    texts = rows.select("at", F.col("__row").getField(text).alias("text")).join(in_reach(known, "root").drop("n"), "at")
    texts = texts.repartition("root", "lo", "hi").sortWithinPartitions("root", "lo", "hi")
    verified = by_block(
        texts, "root", _verify, "node bigint, links bigint, tree bigint", [pa.int64(), pa.int64(), pa.int64()]
    )
    verified = staged(verified, "links")
    links = verified.groupBy("node").agg(F.sum("links").alias("links")).withColumnRenamed("node", "at")
    tied = components(verified.select(F.col("node").alias("a"), F.col("tree").alias("b")))
    tied = tied.withColumnRenamed("node", "at")

    told = (
        sets.join(links, "at", "left").join(tied, "at", "left").withColumn("root", F.coalesce("root", "at"))
    )
    leads = told.groupBy("root").agg(F.min("first").alias("lead"))
    told = told.join(leads, "root").select(
        F.col("mark").alias("__mark"), F.col("n").alias("__n"), "lead",
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"),
    )
    out = rows.join(told, (rows["mark"] == told["__mark"]) & (rows["n"] == told["__n"]), "left")
    return out.select(
        "__row.*",
        F.when(F.col("lead").isNull(), F.col("id")).otherwise(F.col("lead.id")).alias("class_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce(F.col("at") == F.col("lead.at"), F.lit(True)).alias("kept"),
    )


@query("op2_jaccard_join")
def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_groups(docs).select("doc_id", "class_id", "n_links")
