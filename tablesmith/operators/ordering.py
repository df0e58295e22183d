"""Exact order statistics without a single-task sort.

``Window.orderBy`` over a whole table, or over one group that holds a third of it, moves
those rows into one task. Here the data is first collapsed to distinct values with counts,
range-partitioned on (keys, value) so that a large group spans many partitions, and the
partitions are stitched together with one offset per partition and key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from tablesmith.session import durable

# The built-in exact percentile keeps one map entry per distinct value of a group. Up to
# this many entries it is used; beyond it the range-partitioned form takes over.
DISTINCT_LIMIT = 200_000


def cumulative(df: DataFrame, keys: Sequence[str], order: Sequence[str], weight: str,
               before: str = "before", total: str = "total") -> DataFrame:
    """Add the weight of all rows that sort earlier within the keys, and the key's total.

    The partition number is read back from a checkpoint, so every later use sees the same
    assignment even when tasks are retried. The number of ranges is
    spark.sql.shuffle.partitions, merged by adaptive execution where they are small.
    """
    ranged = durable(df.repartitionByRange(*keys, *order).withColumn("_part", F.spark_partition_id()))
    inside = (Window.partitionBy("_part", *keys).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, -1))
    # at most one row per partition and key: a window over one key sees <= parts rows
    pieces = ranged.groupBy("_part", *keys).agg(F.sum(weight).alias("_weight"))
    anchor = list(keys) or [F.lit(0)]
    earlier = (Window.partitionBy(*anchor).orderBy("_part")
               .rowsBetween(Window.unboundedPreceding, -1))
    offsets = pieces.select(
        "_part", *keys,
        F.coalesce(F.sum("_weight").over(earlier), F.lit(0)).alias("_offset"),
        F.sum("_weight").over(Window.partitionBy(*anchor)).alias(total))
    return (ranged
            .withColumn("_inside", F.coalesce(F.sum(weight).over(inside), F.lit(0)))
            .join(offsets, ["_part", *keys])
            .withColumn(before, F.col("_inside") + F.col("_offset"))
            .drop("_part", "_inside", "_offset"))


def positions(df: DataFrame, keys: Sequence[str], order: Sequence[str],
              position: str = "position", total: str = "total") -> DataFrame:
    """0-based position of every row within its keys; ``order`` must be unique per key."""
    return (cumulative(df.withColumn("_one", F.lit(1).cast("long")), keys, order, "_one",
                       position, total).drop("_one"))


def _rank_pick(spread: DataFrame, keys: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Interpolated quantiles out of distinct values with counts and cumulative counts."""
    outputs = []
    for i, q in enumerate(probs):
        rank = (F.col("_total") - 1) * F.lit(q)
        low, high = F.floor(rank), F.ceil(rank)

        def covers(p):
            return (F.col("_before") <= p) & (p < F.col("_before") + F.col("_n"))

        left = F.max(F.when(covers(low), F.col("_v")))
        right = F.max(F.when(covers(high), F.col("_v")))
        outputs.append((left + (right - left) * F.max(rank - low)).alias(f"_q{i}"))
    return spread.groupBy(*keys).agg(F.array(*outputs).alias("_q"))


def quantiles(df: DataFrame, keys: Sequence[str], wanted: Mapping[str, tuple[str, float]],
              distinct_limit: int = DISTINCT_LIMIT, size: str | None = None) -> DataFrame:
    """Exact linearly interpolated quantiles per group: ``{output: (column, q)}``.

    ``size`` adds the row count of each group under that name. Nulls in values and rows
    with a null key are ignored.

    Rows collapse to distinct values with counts first, combined on the map side, so that
    neither a task nor a shuffle sees repeated values. One sketch pass then decides per
    column: groups of few distinct values go to the built-in weighted percentile, others
    are range-partitioned by value. Both are exact.
    """
    slots = {column: f"_v{i}" for i, column in enumerate(dict.fromkeys(c for c, _ in wanted.values()))}
    probs = sorted({float(q) for _, q in wanted.values()})
    rows = df.select(*keys, *[F.col(c).cast("double").alias(s) for c, s in slots.items()])
    for key in keys:
        rows = rows.where(F.col(key).isNotNull())
    widest = (rows.groupBy(*keys)
              .agg(*[F.approx_count_distinct(s, 0.02).alias(s) for s in slots.values()])
              .agg(*[F.max(s).alias(s) for s in slots.values()]).first())
    large = [s for s in slots.values() if (widest[s] or 0) > distinct_limit]
    small = [s for s in slots.values() if s not in large]
    named = [*keys, "_c"]

    def counts(chosen: Sequence[str]) -> DataFrame:
        long = rows.select(*keys, *chosen).unpivot(list(keys), list(chosen), "_c", "_v")
        return long.groupBy(*named, "_v").agg(F.count(F.lit(1)).alias("_n"))

    parts = []
    if small:
        exact = F.percentile("_v", F.array(*map(F.lit, probs)), F.col("_n"))
        parts.append(counts(small).groupBy(*named).agg(exact.alias("_q"), F.sum("_n").alias("_rows")))
    if large:
        present = counts(large).where(F.col("_v").isNotNull())
        parts.append(_rank_pick(cumulative(present, named, ["_v"], "_n", "_before", "_total"), named, probs))
    long = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    counted = [F.max("_rows").alias(size)] if size and not large else []
    result = long.groupBy(*keys).agg(*counted, *[
        F.max(F.when(F.col("_c") == slots[c], F.col("_q")[probs.index(float(q))])).alias(output)
        for output, (c, q) in wanted.items()])
    if not size or counted:
        return result
    if not keys:
        return result.withColumn(size, F.lit(rows.count())).select(size, *wanted)
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(size))
    return sizes.join(result, list(keys), "left").select(*keys, size, *wanted)


def medians(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str],
            distinct_limit: int = DISTINCT_LIMIT) -> DataFrame:
    """Exact medians per group: ``{output: column}``."""
    return quantiles(df, keys, {o: (c, 0.5) for o, c in columns.items()}, distinct_limit)


def modes(df: DataFrame, keys: Sequence[str], column: str, output: str) -> DataFrame:
    """Most frequent non-null value per group, the smallest one on ties.

    Counted first, so no task holds a group's values; then the least (-count, value) pair,
    which combines before the shuffle and needs no join back.
    """
    counts = (df.where(F.col(column).isNotNull()).groupBy(*keys, column)
              .agg(F.count(F.lit(1)).alias("_n")))
    best = F.min(F.struct((-F.col("_n")).alias("n"), F.col(column).alias("v")))
    return counts.groupBy(*keys).agg(best["v"].alias(output))
