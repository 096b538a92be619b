"""Exact dedup: composable polynomial fingerprints, then a chunkwise comparison of what shares one.

The fingerprint of a text is its bytes read as a polynomial, taken at four points, each modulo a 31-bit prime.
It composes: of two parts of a text, f(ab) = f(a) * x^len(b) + f(b). So a text is cut into chunks whose
hashes are one matrix product, and the chunk hashes fold by length-shifted arithmetic, in any grouping.

Nulls count as empty texts and all empty texts are equal. Repeated rows (even with one doc_id) are copies of
each other: exactly one of them stays, any of those that are alike in all columns. A null doc_id counts as
larger than every number. Columns that are named like a result are replaced by it. Texts of any length are read
whole, and an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labtrail.llm.common import BLANKS, query, staged, table
from labtrail.operators.joins import attach

# Four pairs of a 31-bit prime and a point; odds of two given texts of n bytes meeting in all are (n / 2^31)^4.
POINTS = ((2147483647, 1103515245), (2147483629, 1597334677), (2147483587, 747796405), (2147483579, 1181783497))
CHUNK = 4096
COMPARED = 65536


def powers(n: int, points=POINTS) -> np.ndarray:
    """x^(n-1) .. x^0 for each point: an array of n rows."""
    out = np.ones((n, len(points)), dtype=np.uint64)
    for k, (prime, x) in enumerate(points):
        value = 1
        for i in range(n - 1, -1, -1):
            out[i, k] = value
            value = value * x % prime
    return out


def combine(left: list[int], right: list[int], right_length: int, points=POINTS) -> list[int]:
    """Fingerprint of a text from those of its two parts and the length of the second in bytes."""
    return [(a * pow(x, right_length, p) + b) % p for a, b, (p, x) in zip(left, right, points)]


class Fingerprint:
    """Fingerprints of byte strings: chunk hashes by one matrix product, folded by length-shifted arithmetic."""

    def __init__(self, points=POINTS, chunk: int = CHUNK):
        self.points, self.chunk = points, chunk
        self.primes = np.array([p for p, _ in points], dtype=np.uint64)
        # byte * power < 2^39, so a sum over 4096 bytes stays below 2^53 and doubles hold it exactly
        self.table = powers(chunk, points).astype(np.float64)
        self.shift = [pow(x, chunk, p) for p, x in points]

    def __call__(self, data: bytes) -> list[int]:
        values = [0] * len(self.points)
        step = self.chunk * 1024  # a piece of 4 MB at a time, whatever the text's length
        for start in range(0, len(data), step):
            piece = np.frombuffer(data, np.uint8, min(step, len(data) - start), start)
            whole = len(piece) // self.chunk
            if whole:
                blocks = piece[: whole * self.chunk].reshape(whole, self.chunk).astype(np.float64)
                hashes = np.asarray(blocks @ self.table, dtype=np.uint64) % self.primes
                for row in hashes.tolist():
                    values = [(v * s + h) % p for v, s, h, (p, _) in zip(values, self.shift, row, self.points)]
            rest = piece[whole * self.chunk :]
            if len(rest):
                tail = np.asarray(rest.astype(np.float64) @ self.table[self.chunk - len(rest) :], dtype=np.uint64)
                values = combine(values, (tail % self.primes).tolist(), len(rest), self.points)
        return values


def _fingerprints(points):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Fingerprint(points)
        for batch in batches:
            body = batch.column(batch.schema.get_field_index("__body"))
            marks, sizes = [], []
            for text in body:
                data = text.as_buffer()
                marks.append("-".join(f"{v:08x}" for v in of(data)) if data is not None else "")
                sizes.append(data.size if data is not None else 0)
            kept = [i for i, name in enumerate(batch.schema.names) if name != "__body"]
            names = [batch.schema.names[i] for i in kept] + ["__mark", "__bytes"]
            columns = [batch.column(i) for i in kept] + [pa.array(marks, pa.string()), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def exact_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", points=POINTS) -> DataFrame:
    """`docs` with keep_id, group_size, kept and text_sha256 (of the text with blank runs as one space)."""
    own = ("keep_id", "group_size", "kept", "text_sha256")
    columns = [c for c in docs.columns if c.lower() not in own]
    body = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), BLANKS, " ")
    # One pass over the texts. The row number is written down with the row, so a second run of a lost task
    # cannot change it afterwards.
    marked = docs.select(
        F.struct(*columns).alias("__row"),
        F.col(doc_id).cast("long").alias("__id"),
        F.sha2(body, 256).alias("__sha"),
        F.monotonically_increasing_id().alias("__at"),
        body.cast("binary").alias("__body"),
    )
    schema = marked.drop("__body").schema.add("__mark", "string").add("__bytes", "long")
    rows = staged(marked.mapInArrow(_fingerprints(points), schema), "fingerprints")

    key = ["__mark", "__bytes"]
    first = F.min(F.struct(F.col("__id").isNull().alias("no_id"), F.col("__id").alias("id"), F.col("__at").alias("at")))

    def grouped(rows: DataFrame, key: list[str]) -> DataFrame:
        """What its group tells each row, by `__at`. Only keys travel, and `attach` spreads the rows of large groups."""
        groups = rows.groupBy(*key).agg(first.alias("__first"), F.count(F.lit(1)).alias("__n"))
        weighed = groups.withColumn("__weight", F.col("__n"))
        return attach(rows.select("__at", *key), weighed, key, weight="__weight").select("__at", "__first", "__n")

    # Rows with one fingerprint are cut into chunks; each chunk's least and greatest content must agree.
    # The texts are dealt out by row number, so those of a large group lie in all tasks, whose partial aggregates
    # leave one row a chunk.
    told = staged(grouped(rows, key), "groups")
    # Both sides grow with the table: no broadcast, and texts are not sorted for the join.
    shared = told.where("__n > 1").select("__at").hint("shuffle_hash")
    again = F.regexp_replace(F.coalesce(F.col("__row").getField(text), F.lit("")), BLANKS, " ")
    chunks = (
        rows.join(shared, "__at")
        .select(*key, again.cast("binary").alias("body"))
        .select(
            *key,
            F.posexplode(
                F.transform(
                    F.sequence(F.lit(0), F.floor(F.length("body") / COMPARED).cast("int")),
                    lambda i: F.substring(F.col("body"), i * COMPARED + 1, F.lit(COMPARED)),
                )
            ).alias("chunk", "content"),
        )
    )
    unlike = (
        chunks.groupBy(*key, "chunk")
        .agg(F.min("content").alias("least"), F.max("content").alias("most"))
        .where("least <> most")
        .select(*key)
        .distinct()
    )
    unlike = staged(unlike, "collisions")
    if not unlike.isEmpty():  # different texts that share a fingerprint are told apart by the texts themselves
        met = rows.join(unlike, key, "left_semi").withColumn("__whole", again)
        sure = rows.join(unlike, key, "left_anti").select("__at")
        told = told.join(sure, "__at", "left_semi").unionByName(grouped(met, [*key, "__whole"]))
    out = rows.join(told.hint("shuffle_hash"), "__at")
    return out.select(
        "__row.*",
        F.col("__first.id").alias("keep_id"),
        F.col("__n").cast("long").alias("group_size"),
        (F.col("__at") == F.col("__first.at")).alias("kept"),
        F.col("__sha").alias("text_sha256"),
    )


OP7_SQL = r"""
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, sha256(body) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
WINDOW same AS (PARTITION BY body)
"""


@query("op7_exact_dedup", OP7_SQL)
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_groups(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
