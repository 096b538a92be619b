"""Vectors as whole numbers: what the code compression and the top-k search read."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Components this large or smaller leave room for exact sums of products in 64 bits.
LARGEST = 1 << 24


def scaled(vectors: DataFrame, vector: str, scale: int, name: str = "__parts") -> DataFrame:
    """`vectors` with floor(scale * x) of each component as array<int>, rows without a usable vector left out.

    A vector that is null or holds a null or a component that is not finite is not usable. In a vector with a
    number beyond +-2^24 no sum would be sure to fit into a long: it is kept, with null as its array.
    """
    whole = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * scale))
    fits = F.forall(whole, lambda x: (x >= -LARGEST) & (x <= LARGEST))
    kept = vectors.where(F.col(vector).isNotNull() & F.forall(F.col(vector), finite))
    return kept.withColumn("__whole", whole).withColumn(
        name, F.when(fits, F.transform("__whole", lambda x: x.cast("int")))
    ).drop("__whole")


def finite(x: Column) -> Column:
    x = x.cast("double")
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of an array column, all of the same length, as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width).astype(np.int64)
