"""Grouped statistics, correlations and the tables behind the usual plots."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from tablesmith.operators.ordering import medians, modes, quantiles
from tablesmith.operators.relational import attach


def global_stats(df: DataFrame, column: str) -> DataFrame:
    """mean, std (n-1), null count, median and mode of one column, as one row."""
    basics = df.agg(F.avg(column).alias("mean"), F.stddev_samp(column).alias("std"),
                    F.count_if(F.col(column).isNull()).alias("n_null"))
    return basics.select(
        "*", medians(df, [], {"median": column}).scalar().alias("median"),
        modes(df, [], column, "mode").scalar().alias("mode"))


def target_rate(df: DataFrame, category: str, label: str, output: str = "rate") -> DataFrame:
    """Mean of the label per category, best first."""
    return (df.where(F.col(category).isNotNull()).groupBy(category)
            .agg(F.avg(label).alias(output)).orderBy(F.col(output).desc(), category))


def crosstab(df: DataFrame, rows: str, columns: str, values: Sequence) -> DataFrame:
    """Contingency table; the column values are given, so no pass is spent finding them."""
    return (df.groupBy(rows).pivot(columns, list(values)).agg(F.count(F.lit(1))).na.fill(0))


def drilldown(df: DataFrame, levels: Sequence[str], label: str) -> DataFrame:
    """Size, positives and rate of every nested segment, from the whole table downwards."""
    return (df.rollup(*levels)
            .agg(F.grouping_id().alias("_open"), F.count(F.lit(1)).alias("n"),
                 F.sum(label).cast("long").alias("positives"), F.avg(label).alias("rate"))
            .withColumn("depth", F.lit(len(levels)) - F.bit_count("_open"))
            .drop("_open"))


def correlations(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair, each over the rows where both are present.

    One aggregate computes all pairs; the result is the full symmetric long matrix.
    """
    both = [(a, b) for a, b in combinations(names, 2)]

    def pearson(a: str, b: str) -> Column:
        # null instead of an error where one side does not vary
        x = F.when(F.col(b).isNotNull(), F.col(a).cast("double"))
        y = F.when(F.col(a).isNotNull(), F.col(b).cast("double"))
        return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))

    wide = df.agg(*[pearson(a, b).alias(f"{a}|{b}") for a, b in both],
                  *[F.when(F.stddev_samp(a) > 0, F.lit(1.0)).alias(f"{a}|{a}") for a in names])
    cells = F.array(*[
        F.struct(F.lit(x).alias("feature_1"), F.lit(y).alias("feature_2"),
                 F.col(f"`{a}|{b}`").alias("correlation"))
        for a, b in [*both, *[(n, n) for n in names]]
        for x, y in dict.fromkeys([(a, b), (b, a)])])
    return wide.select(F.explode(cells).alias("cell")).select("cell.*")


def correlations_with(df: DataFrame, column: str, names: Sequence[str],
                      absolute: bool = False) -> DataFrame:
    """Correlations of one column with all, strongest first."""
    found = correlations(df, names).where(F.col("feature_1") == column)
    if absolute:
        found = found.withColumn("correlation", F.abs("correlation"))
    return found.orderBy(F.col("correlation").desc(), "feature_2")


def boxplot(df: DataFrame, group: str, column: str, whisker: float = 1.5) -> DataFrame:
    """Quartiles, whisker ends (last value within 1.5 IQR), mean and outlier count."""
    rows = df.where(F.col(column).isNotNull() & F.col(group).isNotNull())
    cuts = quantiles(rows, [group], {"q1": (column, .25), "q2": (column, .5), "q3": (column, .75)}, size="_size")
    # fences are attached per distinct value, after map-side counting, not per row
    counts = rows.groupBy(group, column).agg(F.count(F.lit(1)).alias("_n"))
    fenced = attach(counts, cuts, [group], "_size", [column])
    reach = (F.col("q3") - F.col("q1")) * whisker
    value = F.col(column).cast("double")
    inside = (value >= F.col("q1") - reach) & (value <= F.col("q3") + reach)
    return fenced.groupBy(group, "q1", "q2", "q3").agg(
        F.min(F.when(inside, value)).alias("whisker_low"),
        F.max(F.when(inside, value)).alias("whisker_high"),
        (F.sum(value * F.col("_n")) / F.sum("_n")).alias("mean"),
        F.sum(F.when(inside, 0).otherwise(F.col("_n"))).cast("long").alias("n_outliers"))


def histogram(df: DataFrame, column: str, group: str, bins: int = 10) -> DataFrame:
    """Equal-width counts per group over the column's whole range; the last bin is closed."""
    rows = df.where(F.col(column).isNotNull())
    edge = rows.agg(F.min(column).cast("double").alias("lo"),
                    F.max(column).cast("double").alias("hi")).first()
    if edge.lo is None:
        return rows.groupBy(F.lit(0).alias("bin"), group).agg(F.count(F.lit(1)).alias("n"))
    width = (edge.hi - edge.lo) / bins or 1.0
    code = F.least(F.floor((F.col(column).cast("double") - edge.lo) / width), F.lit(bins - 1))
    return rows.groupBy(code.cast("int").alias("bin"), group).agg(F.count(F.lit(1)).alias("n"))


def mean_interval(df: DataFrame, keys: Sequence[str], label: str, z: float = 1.96) -> DataFrame:
    """Mean per category with a normal 95 % interval."""
    half = F.lit(z) * F.coalesce(F.stddev_samp(label), F.lit(0.0)) / F.sqrt(F.count(label))
    return df.groupBy(*keys).agg(F.count(label).alias("n"), F.avg(label).alias("mean"),
                                 (F.avg(label) - half).alias("low"), (F.avg(label) + half).alias("high"))


def kernel_density(df: DataFrame, group: str, column: str, points: int = 25) -> DataFrame:
    """Gaussian density per group on an even grid, bandwidth n^(-1/5) * std per group.

    The grid is a row of aggregates, so rows are read once and never multiplied. Groups are
    attached to their bandwidth per distinct value, after map-side counting. A group without
    spread has no bandwidth and a null density; no values give an empty result.
    """
    rows = df.where(F.col(column).isNotNull() & F.col(group).isNotNull())
    value = F.col(column).cast("double")
    edge = rows.agg(F.min(value).alias("lo"), F.max(value).alias("hi")).first()
    low, step = (edge.lo, (edge.hi - edge.lo) / max(1, points - 1)) if edge.lo is not None else (0.0, 0.0)
    width = rows.groupBy(group).agg(
        (F.pow(F.count(F.lit(1)), F.lit(-0.2)) * F.stddev_samp(value)).alias("_h"),
        F.count(F.lit(1)).alias("_rows"), F.count(F.lit(1)).alias("_size"))
    counts = rows.groupBy(group, value.alias("_x")).agg(F.count(F.lit(1)).alias("_n"))
    marks = [low + step * i for i in range(points)]
    scale = math.sqrt(2.0 * math.pi)

    def height(mark: float) -> Column:
        far = F.try_divide(F.lit(mark) - F.col("_x"), F.col("_h"))
        return F.sum(F.exp(far * far * -0.5) * F.col("_n"))

    heights = attach(counts, width, [group], "_size", ["_x"]).groupBy(group, "_h", "_rows").agg(
        F.array(*[height(m) for m in marks]).alias("_all"))
    return heights.select(group, F.posexplode("_all").alias("point", "_sum"), "_h", "_rows").select(
        group, "point", (F.lit(low) + F.lit(step) * F.col("point")).alias("x"),
        F.try_divide(F.col("_sum"), F.col("_rows") * F.col("_h") * scale).alias("density"))


def row_mean(names: Sequence[str]) -> Column:
    """Mean of the non-null values across columns of a row."""
    total = sum((F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in names), F.lit(0.0))
    present = sum((F.col(c).isNotNull().cast("int") for c in names), F.lit(0))
    return total / F.nullif(present, F.lit(0))


def with_mean_row(df: DataFrame, name: str, label: str = "mean") -> DataFrame:
    """The table plus one row with the mean of every other column."""
    rest = [c for c in df.columns if c != name]
    return df.unionByName(df.agg(*[F.avg(c).alias(c) for c in rest]).withColumn(name, F.lit(label)))
