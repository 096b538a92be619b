"""Exact top-k search: columnar branch-and-bound over blocks of dimensions.

Vectors become whole numbers; the score of two vectors is their inner product. A batch of candidates lies in
vertical layout, one row for each dimension. A query adds up the products of one block of dimensions at a time,
beginning with the block in which it has most mass. What the dimensions left can still add lies within the product
of the lengths that query and candidate have there (their remaining mass). A candidate whose score cannot
reach the k-th best any more is out, and the rest is compacted, so later blocks are read for few candidates.
The k-th best is that of the scores found so far, or of the least scores that the candidates at hand are sure of.
Bounds are rounded outward, so no vector that belongs in the result is lost.

Queries are dealt into groups of bounded size and candidates into slices; a cell is a query group with a
slice. Queries go to each slice's cell and candidates to each group's; a task reads a cell as one sorted stream,
the queries first, and holds these, their best k, and one batch of candidates. Groups of queries beyond the first
cost a copy of the candidates each, which has to be: all queries meet all rows. A cell hands on k rows a
query, and a window over these few picks the last k.

What happens in odd cases: vectors that are null or hold null or non-finite components, and those with numbers beyond
+-2^24, take no part. Only vectors of equal length are compared. Ties go to the smaller id, null ids last. Each
row is a query or candidate of its own: a query leaves out its own row, not others with the same id, and an id on
two rows that are queries gets two lists. A query with fewer other rows gets all of them; a query without any
gets no row, as an empty table does. Columns besides id and vector play no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from labtrail.llm.common import query, staged, table
from labtrail.llm.vectors import matrix, scaled

SCALE, TOP, EVERY = 1024, 10, 100
BLOCK = 8
QUERY_GROUP = 1 << 16  # queries a task holds
SLICE = 1 << 22  # candidates a task reads
LEAST_SLICE = 1 << 10  # fewer are not worth a slice, and each slice hands on its own best of each query
CELLS = 2  # cells for each shuffle partition, at least


class Search:
    """The queries of a cell, their best candidates so far, and the search of one batch of candidates after another."""

    def __init__(self, rows: np.ndarray, queries: np.ndarray, top: int, block: int = BLOCK):
        self.rows, self.queries, self.top = rows, queries, top
        dims = queries.shape[1]
        self.blocks = [slice(at, min(at + block, dims)) for at in range(0, max(dims, 1), block)]
        self.mass = self._mass(queries)
        self.order = np.argsort(-self.mass, axis=1, kind="stable")
        self.largest = int(np.abs(queries).max(initial=0))
        none = (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool), np.zeros(0, dtype=np.int64))
        self.best = [none] * len(rows)  # ids, whether they are null, scores
        self.place = {int(row): i for i, row in enumerate(rows)}

    def _mass(self, vectors: np.ndarray) -> np.ndarray:
        """Squared length within each block of dimensions, a row for each vector."""
        squares = vectors * vectors
        return np.stack([squares[:, b].sum(axis=1) for b in self.blocks], axis=1)

    def offer(self, rows: np.ndarray, ids: np.ndarray, unnamed: np.ndarray, vectors: np.ndarray) -> None:
        """Take the best of a batch of candidates into the results."""
        dims = vectors.shape[1]
        # floats hold whole numbers up to 2^53, and their products go through BLAS
        exact = self.largest * int(np.abs(vectors).max(initial=0)) * dims < 1 << 53
        kind = np.float64 if exact else np.int64
        upright, queries = np.ascontiguousarray(vectors.T).astype(kind), self.queries.astype(kind)
        mass = np.ascontiguousarray(self._mass(vectors).T)
        whole = mass.sum(axis=0)
        own = {self.place[r]: i for i, r in enumerate(rows.tolist()) if r in self.place}
        for q in range(len(queries)):
            alive = np.arange(len(rows))
            if q in own:
                alive = np.delete(alive, own[q])
            alive, scores = self.survivors(q, queries[q], alive, upright, mass, whole)
            if len(alive):
                self.keep(q, ids[alive], unnamed[alive], scores.astype(np.int64))

    def survivors(self, q, one, alive, upright, mass, whole) -> tuple[np.ndarray, np.ndarray]:
        """Candidates that may be among the best k, and their whole scores."""
        held = self.best[q][2]
        bar = held[-1] if len(held) == self.top else -np.inf
        everyone = len(alive) == upright.shape[1]
        scores, rest, query_rest = np.zeros(len(alive), upright.dtype), whole[alive], int(self.mass[q].sum())
        slack = 1 + 1e-12 * np.sqrt(float(whole.max(initial=0)) * query_rest)
        for b in self.order[q]:
            reach = np.sqrt(rest * float(query_rest)) * (1 + 1e-9) + slack
            if len(alive) > self.top:
                sure = np.partition(scores - reach, len(alive) - self.top)[len(alive) - self.top]
                bar = max(bar, sure)
            stay = scores + reach >= bar
            if 4 * np.count_nonzero(stay) < 3 * len(alive):
                alive, scores, rest, everyone = alive[stay], scores[stay], rest[stay], False
            if not len(alive):
                break
            dims = self.blocks[b]
            scores = scores + one[dims] @ (upright[dims] if everyone else upright[dims][:, alive])
            rest = rest - mass[b][alive]
            query_rest -= int(self.mass[q, b])
        stay = scores >= bar
        return alive[stay], scores[stay]

    def keep(self, q: int, ids: np.ndarray, unnamed: np.ndarray, scores: np.ndarray) -> None:
        """The best k of those held and the new ones."""
        ids, unnamed, scores = (np.concatenate(x) for x in zip(self.best[q], (ids, unnamed, scores)))
        first = np.lexsort((ids, unnamed, -scores))[: self.top]
        self.best[q] = ids[first], unnamed[first], scores[first]


def search_cells(top: int, block: int):
    """The function that reads sorted cells and hands on the best candidates of each query within each."""

    def found(search: Search | None) -> Iterator[pa.RecordBatch]:
        if search is None or not len(search.rows):
            return
        many = [len(scores) for _, _, scores in search.best]
        ids, unnamed, scores = (np.concatenate(x) for x in zip(*search.best))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(search.rows, many)), pa.array(ids, mask=unnamed), pa.array(scores)],
            names=["row", "vec_id", "score"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, waiting, search = None, [], None
        for batch in batches:
            cell, dims, candidate = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            ends = np.flatnonzero((np.diff(cell) != 0) | (np.diff(dims) != 0) | (np.diff(candidate) != 0)) + 1
            for a, z in zip([0, *ends], [*ends, len(cell)]):
                if z == a:
                    continue
                if now != (cell[a], dims[a]):
                    yield from found(search)
                    now, waiting, search = (cell[a], dims[a]), [], None
                some = batch.slice(a, z - a)
                rows, vectors = some.column(3).to_numpy(), matrix(some.column(5), dims[a])
                if not candidate[a]:
                    waiting.append((rows, vectors))
                    continue
                if search is None and waiting:
                    search = Search(*(np.concatenate(x) for x in zip(*waiting)), top, block)
                if search is not None:
                    ids = some.column(4)
                    search.offer(
                        rows, ids.fill_null(0).to_numpy(zero_copy_only=False),
                        ids.is_null().to_numpy(zero_copy_only=False), vectors,
                    )
        yield from found(search)

    return run


def top_k(
    vectors: DataFrame, queries: Column, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE, top: int = TOP,
    block: int = BLOCK, query_group: int = QUERY_GROUP, slice_rows: int = SLICE,
) -> DataFrame:
    """`query_id`, `rank` (from 1), `vec_id`, `score`: the best `top` rows for each row that `queries` is true of."""
    spark = vectors.sparkSession
    rows = scaled(vectors, vector, scale).where(F.col("__parts").isNotNull())
    rows = rows.select(
        F.col(vec_id).cast("long").alias("id"), F.coalesce(queries, F.lit(False)).alias("asked"), F.col("__parts").alias("parts")
    )
    rows = staged(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    many, asked = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("asked").cast("long")), F.lit(0))).first()
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = max(1, -(-asked // query_group))
    worth = min(-(-CELLS * partitions // groups), -(-many // LEAST_SLICE))
    slices = max(1, worth, -(-many // slice_rows))

    def dealt(some: DataFrame, own: int, others: int, cell) -> DataFrame:
        """Rows in the cells of their own share with each of the other's shares."""
        # numbers within a partition follow each other, so this deals them out evenly
        some = some.withColumn("own", F.col("row") % own)
        return some.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(others - 1)))).withColumn(
            "cell", cell(F.col("own"), F.col("other").cast("long"))
        )

    asking = dealt(rows.where("asked"), groups, slices, lambda g, s: g * slices + s).withColumn("candidate", F.lit(False))
    given = dealt(rows, slices, groups, lambda s, g: g * slices + s).withColumn("candidate", F.lit(True))
    cells = asking.union(given).select(
        "cell", F.size("parts").alias("dims"), "candidate", "row", "id", "parts"
    )
    cells = cells.repartition(partitions, "cell").sortWithinPartitions("cell", "dims", "candidate")
    found = cells.mapInArrow(search_cells(top, block), "row long, vec_id long, score long")
    best = Window.partitionBy("row").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    names = rows.where("asked").select("row", F.col("id").alias("query_id"))
    return ranked.join(names, "row").select("query_id", "rank", "vec_id", "score")


SQL = f"""
WITH kept AS (SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
    FROM kept q JOIN kept c ON q.vec_id <> c.vec_id WHERE q.vec_id % {EVERY} = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {TOP}
"""


@query("op13_top_k", SQL)
def op13_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY == 0)
