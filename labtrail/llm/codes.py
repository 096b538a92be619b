"""Vector code compression: product codes whose nearest entries are found by Orchard search.

Vectors become whole numbers and are cut into equal parts; each part position has a codebook. The codebooks
start as the parts of the vectors with the smallest ids and are improved by rounds of assignment and averaging.

To find a part's nearest entry, every entry has a list of the others sorted by their distance from it. The
search holds the best entry so far and walks along its list; a nearer entry becomes the best one and its list
is walked from the start. Entries met before are marked and not measured again. The walk ends at the first
entry farther from the best one than twice the part's distance: by the triangle inequality it and all after it
are farther from the part than the best one. Entries at exactly twice the distance may tie and are measured.

The parts of a batch walk together, one numpy step for all of them. A round is one pass over the rows: tasks hand on
sums and counts for each entry, Spark adds them up, and the driver gets a row per entry and component, a
number that the parameters fix.

What happens in odd cases: vectors that are null or hold null or non-finite components are dropped. Fewer vectors
than entries give as many entries as there are vectors; no vector at all gives no row. Equal distances go to
the lower index, equal ids are taken in the order of their vectors, null ids last. Repeated rows each get their
code. The first vector's length counts: vectors of another length, and those whose numbers go beyond +-2^24, have
null as code and error and take no part. A length that the parts do not divide is filled up with zeros, which
changes no distance. Columns named like a result are replaced by it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labtrail.llm.common import query, staged, table
from labtrail.llm.vectors import matrix, scaled

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
STEP = 2_048


class Codebooks:
    """Entries (positions x entries x components of a part), and for each the other entries by distance."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        apart = entries[:, :, None, :] - entries[:, None, :, :]
        self.gaps = (apart * apart).sum(axis=-1)
        self.lists = np.argsort(self.gaps, axis=-1, kind="stable")

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each part (rows x positions x components) the index of its nearest entry and the squared distance."""
        rows, positions, width = parts.shape
        many = self.entries.shape[1]
        flat = parts.reshape(rows * positions, width)
        of = np.tile(np.arange(positions), rows)

        def measure(some: np.ndarray, entry: np.ndarray) -> np.ndarray:
            off = flat[some] - self.entries[of[some], entry]
            return (off * off).sum(axis=1)

        every = np.arange(len(flat))
        best = np.zeros(len(flat), dtype=np.int64)
        far = measure(every, best)
        met = np.zeros((len(flat), many), dtype=bool)
        met[:, 0] = True
        place = np.zeros(len(flat), dtype=np.int64)
        walking = every
        while len(walking):
            walking = walking[place[walking] < many]
            entry = self.lists[of[walking], best[walking], place[walking]]
            # squares: farther than twice the distance is more than four times its square
            near = self.gaps[of[walking], best[walking], entry] <= 4 * far[walking]
            walking, entry = walking[near], entry[near]
            place[walking] += 1
            new = ~met[walking, entry]
            some, entry = walking[new], entry[new]
            met[some, entry] = True
            distance = measure(some, entry)
            better = (distance < far[some]) | ((distance == far[some]) & (entry < best[some]))
            some = some[better]
            best[some], far[some], place[some] = entry[better], distance[better], 0
        return best.reshape(rows, positions), far.reshape(rows, positions)


def cut(column: pa.Array, length: int, parts: int) -> np.ndarray:
    """Vectors of that length as rows x positions x components, filled up with zeros to equal parts."""
    width = -(-length // parts)
    whole = np.zeros((len(column), parts * width), dtype=np.int64)
    whole[:, :length] = matrix(column, length)
    return whole.reshape(len(column), parts, width)


def first_entries(rows: DataFrame, vec_id: str, parts: int, entries: int) -> tuple[int, Codebooks | None]:
    """The length of the vectors and the codebooks that the smallest ids give; None if there is no vector."""
    usable = rows.where(F.col("__parts").isNotNull()).select(F.col(vec_id).alias("id"), "__parts")
    order = (F.col("id").asc_nulls_last(), F.col("__parts"))
    first = usable.orderBy(*order).limit(1).collect()
    if not first:
        return 0, None
    length = len(first[0]["__parts"])
    start = usable.where(F.size("__parts") == length).orderBy(*order).limit(entries).collect()
    column = pa.array([r["__parts"] for r in start], pa.list_(pa.int32()))
    return length, Codebooks(np.ascontiguousarray(cut(column, length, parts).transpose(1, 0, 2)))


def improved(rows: DataFrame, length: int, books: Codebooks) -> Codebooks:
    """The codebooks after one round: each entry becomes the floor of the mean of the parts nearest to it."""
    positions, entries, width = books.entries.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((positions * entries, width), dtype=np.int64)
        many = np.zeros(positions * entries, dtype=np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                parts = cut(batch.column(0).slice(at, STEP), length, positions)
                slot = (books.nearest(parts)[0] + entries * np.arange(positions)).ravel()
                np.add.at(total, slot, parts.reshape(len(slot), width))
                many += np.bincount(slot, minlength=len(many))
        used = np.flatnonzero(many)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(used, width)), pa.array(np.tile(np.arange(width), len(used))),
                pa.array(total[used].ravel()), pa.array(np.repeat(many[used], width)),
            ],
            names=["slot", "component", "total", "many"],
        )

    added = (
        rows.select("__parts")
        .mapInArrow(sums, "slot long, component long, total long, many long")
        .groupBy("slot", "component")
        .agg(F.sum("total").alias("total"), F.sum("many").alias("many"))
    )
    entries_now = books.entries.reshape(positions * entries, width).copy()
    for r in added.collect():
        entries_now[r["slot"], r["component"]] = r["total"] // r["many"]
    return Codebooks(entries_now.reshape(books.entries.shape))


def compress(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE, parts: int = PARTS,
    entries: int = ENTRIES, rounds: int = ROUNDS,
) -> tuple[DataFrame, Codebooks | None]:
    """The rows with a usable vector, less the vector, with `code` (two hex digits a part) and `error`; the codebooks."""
    if entries > 256:
        raise ValueError("a code has two hex digits for each part, so 256 entries at most")
    others = [c for c in vectors.columns if c.lower() not in (vector.lower(), "code", "error")]
    rows = staged(scaled(vectors, vector, scale).select(*others, "__parts"), "vectors")
    length, books = first_entries(rows, vec_id, parts, entries)
    none = F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")
    if books is None:
        return rows.select(*others, *none), None
    usable = F.coalesce(F.size("__parts") == length, F.lit(False))
    fit = rows.where(usable)
    for _ in range(rounds):
        books = improved(fit, length, books)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                some = batch.slice(at, STEP)
                best, far = books.nearest(cut(some.column(1), length, parts))
                text = [bytes(row).hex() for row in best.astype(np.uint8)]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(text, pa.string()), pa.array(far.sum(axis=1))], names=["__row", "code", "error"]
                )

    whole = fit.select(F.struct(*others, F.lit(0).alias("__none")).alias("__row"), "__parts")
    coded = whole.mapInArrow(code, whole.drop("__parts").schema.add("code", "string").add("error", "long"))
    coded = coded.select(*[F.col("__row").getField(c).alias(c) for c in others], "code", "error")
    return coded.unionByName(rows.where(~usable).select(*others, *none)), books


def _sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The same codebooks and codes by comparing every part with every entry."""
    ctes = [
        f"""kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v
            FROM embeddings WHERE embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""parts AS (SELECT vec_id, label, p, v[p * len(v) // {parts} + 1 : (p + 1) * len(v) // {parts}] AS x
            FROM kept, (SELECT unnest(range({parts})) AS p))""",
        f"""first AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept
            ORDER BY vec_id LIMIT {entries})""",
        "books0 AS (SELECT p, e, x AS c FROM parts JOIN first USING (vec_id))",
    ]
    for i in range(rounds + 1):
        ctes.append(
            f"""near{i} AS (SELECT vec_id, label, p, x, s[2] AS e, s[1] AS d FROM (
            SELECT vec_id, any_value(label) AS label, p, any_value(x) AS x,
            min([list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i])))::BIGINT, e]) AS s
            FROM parts JOIN books{i} USING (p) GROUP BY vec_id, p))"""
        )
        if i < rounds:
            ctes.append(
                f"""means{i} AS (SELECT p, e, list(m ORDER BY i) AS m FROM (
                SELECT p, e, i, floor(sum(x[i]) / count(*))::BIGINT AS m
                FROM (SELECT p, e, x, unnest(range(1, len(x) + 1)) AS i FROM near{i}) GROUP BY p, e, i) GROUP BY p, e)"""
            )
            ctes.append(
                f"""books{i + 1} AS MATERIALIZED (SELECT p, e, coalesce(m, c) AS c
                FROM books{i} LEFT JOIN means{i} USING (p, e))"""
            )
    return f"""WITH {", ".join(ctes)},
    coded AS (SELECT vec_id, any_value(label) AS label, string_agg(format('{{:02x}}', e), '' ORDER BY p) AS code,
        sum(d)::BIGINT AS error FROM near{rounds} GROUP BY vec_id),
    totals AS (SELECT label, sum(error)::BIGINT AS label_error FROM coded GROUP BY label),
    digest AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM books{rounds})
    SELECT vec_id, code, error, label_error, codebooks_sha256
    FROM coded JOIN totals ON coded.label IS NOT DISTINCT FROM totals.label, digest"""


@query("op12_vector_codes", _sql())
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = compress(table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding"))
    coded = staged(coded, "codes")
    # a table of its own, so that the join meets two plain shuffles and adaptive execution can split a hot label
    totals = staged(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    same = coded["label"].eqNullSafe(totals["label"])
    digest = F.lit(books.digest() if books else None).cast("string")
    return coded.join(totals, same, "left").select(
        "vec_id", "code", "error", "label_error", digest.alias("codebooks_sha256")
    )
