"""Joining information to result rows without fan-out and without hot tasks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows that are told already go to this many times as many places as there are shuffle partitions.
FINENESS = 4


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that a lookup lists more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def unique_lookup(df: DataFrame, keys: Sequence[str], on_duplicate: str = "first") -> DataFrame:
    """At most one row per key, null keys dropped, so that a left join keeps the number of rows.

    `first` keeps one row of a key, the same whatever the input order: the greatest, so that filled values
    win over nulls. `error` raises with some of the repeated keys (one job).
    """
    known = df.dropna(subset=list(keys))
    if on_duplicate == "error":
        repeated = duplicate_keys(known, keys).limit(5).collect()
        if repeated:
            raise ValueError(f"lookup has several rows for the same {list(keys)}: {repeated}")
        return known
    values = [c for c in df.columns if c not in keys]
    if not values:
        return known.select(*keys).distinct()
    kept = F.max(F.struct(*[F.col(f"`{c}`") for c in values])).alias("_kept")
    return known.groupBy(*keys).agg(kept).select(*keys, "_kept.*")


def _row_hash(rows: DataFrame) -> Column:
    """A hash of the whole row; maps cannot be hashed and are left out."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in rows.schema if "map<" not in f.dataType.simpleString()])


def attach(
    rows: DataFrame,
    info: DataFrame,
    on: Sequence[str],
    weight: str | None = None,
    only: Column | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Left-join `info` (at most one row per key) to `rows` when neither side is known to be small.

    Of all keys but the largest few, as many as there are shuffle partitions, each holds less than an even
    share of the rows and meets its information by hash. Those largest are hot: their rows are spread by a hash of the
    row. With `weight` their information is broadcast and their rows have been told by then; else it is copied to the
    places their rows go to, which are as many as follow from the key's own count, some for each shuffle partition in
    all. What is broadcast is a row for each shuffle partition at most.
    This holds too when the rows already lie together by the key.

    weight: a column of `info` that counts the rows behind each key, when `info` covers all of them and is a plain
            aggregate of them. The hot keys and the others then come out of one aggregate, whose shuffle Spark makes once.
    counts: else the keys of `rows` with their count `_n`, where that is at hand for less than all of `info` costs.
            Without either the keys of `rows` are counted, which combines before its shuffle.
    only:   rows that need the information; the others get nulls and are spread too.
    """
    on = list(on)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = F.lit(True) if only is None else F.coalesce(only, F.lit(False))
    has_key = reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in on])
    # in the words Spark itself would use for the join below, so that it adds nothing there: `told` and `hot` stay alike
    info = info.where(has_key)
    values = [c for c in info.columns if c not in on and c != weight]
    names = {c: f"_hot_{i}" for i, c in enumerate(values)}
    spread = F.lit(FINENESS * parts)
    if weight:
        hot = info.orderBy(F.desc(weight), *on).limit(parts)
        hot = hot.select(*on, spread.alias("_places"), *[F.col(f"`{c}`").alias(h) for c, h in names.items()])
    else:
        if counts is None:
            counts = rows.where(wanted).groupBy(*on).agg(F.count("*").alias("_n"))
        largest = counts.where(has_key).orderBy(F.desc("_n"), *on).limit(parts)
        places = F.ceil(spread * F.col("_n") / F.sum("_n").over(Window.partitionBy())).cast("int")
        hot = largest.select(*on, F.greatest(places, F.lit(1)).alias("_places"))

    known = F.col("_places").isNotNull()
    aside = -1 - F.pmod(_row_hash(rows), F.coalesce("_places", spread))
    place = F.when(~has_key | ~wanted | known, aside).otherwise(F.lit(0).cast("long"))
    dealt = rows.join(F.broadcast(hot), on, "left").withColumn("_place", place)

    # Keys without anything to tell need not travel. The weight is asked for here too, so that this aggregate is the
    # same as that of the hot keys.
    says = reduce(lambda a, b: a | b, [F.col(f"`{c}`").isNotNull() for c in values])
    told = info.where(says & (F.col(f"`{weight}`") > 0) if weight else says)
    plain = [F.col(f"`{c}`") for c in values]
    if weight:
        # Always 0, but no literal: Spark would take that for a filter and join by the other keys alone. Nor can it be
        # null: a check for nulls would be pushed below the aggregate here and not for the hot keys, and all be done twice.
        zero = F.xxhash64(*on).bitwiseAND(F.lit(0))
        told = told.select(*on, *plain, zero.alias("_place"))
    else:
        each = F.when(known, F.sequence(-F.col("_places"), F.lit(-1))).otherwise(F.array(F.lit(0))).cast("array<long>")
        told = told.join(F.broadcast(hot), on, "left").select(*on, *plain, F.explode(each).alias("_place"))
    joined = dealt.join(told, [*on, "_place"], "left")
    if weight:
        outcome = [F.when(known & wanted, F.col(h)).otherwise(F.col(f"`{c}`")).alias(c) for c, h in names.items()]
    else:
        outcome = [F.when(wanted, F.col(f"`{c}`")).alias(c) for c in values]
    return joined.select(*[F.col(f"`{c}`") for c in rows.columns], *outcome)


def lookup_join(
    rows: DataFrame, lookup: DataFrame, on: Sequence[str], on_duplicate: str = "first"
) -> DataFrame:
    """Left-join a lookup, one row per key at most.

    No hint: Spark broadcasts a lookup whose size in bytes allows it. For a lookup that grows with the rows, whose
    keys may be hot, use `attach`: adaptive execution does not split a join whose one side is an aggregate by
    the join's key, as the unique lookup is.
    """
    return rows.join(unique_lookup(lookup, on, on_duplicate), list(on), "left")
