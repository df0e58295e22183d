"""Filling gaps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tablesmith.functions.numeric import to_half
from tablesmith.functions.seeded import uniform_int
from tablesmith.operators.fitted import constant, learn
from tablesmith.operators.ordering import medians, modes, quantiles
from tablesmith.operators.relational import attach


def fill_constant(df: DataFrame, values: Mapping) -> DataFrame:
    return df.na.fill(dict(values))


def fill_median(df: DataFrame, names: Sequence[str], scope: str = "train", split: str = "split",
                train: str = "train") -> DataFrame:
    """Column medians, learnt on train, on all rows, or per split."""
    fitted = learn(df, lambda rows, keys: medians(rows, keys, {n: n for n in names}), scope, split, train)
    return df.withColumns({n: F.coalesce(F.col(n).cast("double"), constant(fitted, n, split))
                           for n in names})


def fill_mode(df: DataFrame, column: str, scope: str = "train", split: str = "split",
              train: str = "train") -> DataFrame:
    """Most frequent value (smallest on ties)."""
    fitted = learn(df, lambda rows, keys: modes(rows, keys, column, "mode"), scope, split, train)
    return df.withColumn(column, F.coalesce(F.col(column), constant(fitted, "mode", split)))


def fill_group_median(df: DataFrame, column: str, keys: Sequence[str], key: str,
                      rounded: bool = False) -> DataFrame:
    """Median of the row's own group, over all rows given.

    Add the split column to ``keys`` for a per-split fill. Rows with a null group key and
    groups without any value stay null. ``rounded`` moves the median to the nearest 0.5.
    """
    groups = quantiles(df, keys, {"_median": (column, 0.5)}, size="_size")
    if rounded:
        groups = groups.withColumn("_median", to_half(F.col("_median")))
    filled = F.coalesce(F.col(column).cast("double"), F.col("_median"))
    return attach(df, groups, keys, "_size", [key]).withColumn(column, filled).drop("_median")


def cohort_median(df: DataFrame, column: str, cohort: Column) -> float | None:
    """Median over the rows picked by a predicate."""
    return medians(df.where(cohort), [], {"m": column}).first().m


def fill_cohort_median(df: DataFrame, column: str, cohort: Column) -> DataFrame:
    middle = cohort_median(df, column, cohort)
    return df.withColumn(column, F.coalesce(F.col(column).cast("double"), F.lit(middle).cast("double")))


def fill_random_band(df: DataFrame, column: str, key: str, scope: str = "per_split",
                     split: str = "split", seed: int = 0) -> DataFrame:
    """Seeded integer in [mean - std, mean + std) for each null, drawn from the row's key."""
    def band(rows, keys):
        return rows.groupBy(*keys).agg(F.avg(column).alias("mean"), F.stddev_samp(column).alias("std"))

    fitted = learn(df, band, scope, split)
    mean, std = constant(fitted, "mean", split), constant(fitted, "std", split)
    drawn = uniform_int(F.col(key), mean - std, mean + std, seed)
    return df.withColumn(column, F.coalesce(F.col(column).cast("double"), drawn.cast("double")))
