"""What is in a table: columns, sizes, nulls, summaries, distinct values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tablesmith.functions.seeded import scramble
from tablesmith.operators.ordering import quantiles


def _long(df: DataFrame, ids: Sequence[str], name: str, value: str) -> DataFrame:
    """One row per (ids, column) out of a wide row of like-typed values."""
    return df.unpivot(list(ids), [c for c in df.columns if c not in ids], name, value)


def columns(df: DataFrame) -> DataFrame:
    """Name, type and non-null count of every column, from one scan."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
    types = F.create_map(*[F.lit(x) for n, t in df.dtypes for x in (n, t)])
    return _long(counts, [], "column_name", "non_null").select(
        "column_name", types[F.col("column_name")].alias("column_type"), "non_null")


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns)).cast("long"))


def head(df: DataFrame, key: str, n: int = 3) -> DataFrame:
    """First n rows by key: a per-partition top-n, then a merge of n rows each."""
    return df.orderBy(key).limit(n)


def tail(df: DataFrame, key: str, n: int = 3) -> DataFrame:
    return df.orderBy(F.col(key).desc()).limit(n)


def sample(df: DataFrame, key: str, n: int = 10, seed: int = 0) -> DataFrame:
    """n rows drawn without replacement by key hash, repeatable."""
    return df.orderBy(scramble(F.col(key), seed), key).limit(n)


def nulls(df: DataFrame, split: str | None = None) -> DataFrame:
    """Per split and column: null count, row count, fraction."""
    keys = [split] if split else []
    names = [c for c in df.columns if c not in keys]
    wide = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"),
                                 *[F.count_if(F.col(c).isNull()).alias(c) for c in names])
    return _long(wide, [*keys, "_rows"], "column_name", "n_null").select(
        *keys, "column_name", "n_null", F.col("_rows").alias("n_rows"),
        F.try_divide(F.col("n_null"), F.col("_rows")).alias("null_fraction"))


def rows_with_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def missing_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Required columns that still hold nulls; an empty result is the pass signal."""
    return nulls(df.select(*required)).where(F.col("n_null") > 0).select("column_name", "n_null")


def assert_no_nulls(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """``df`` itself, or an error naming the columns that still hold nulls."""
    left = missing_columns(df, required).collect()
    if left:
        raise ValueError("nulls left: " + ", ".join(f"{r.column_name}={r.n_null}" for r in left))
    return df


def describe_numeric(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """count, mean, std (n-1), min, quartiles and max; one row per column."""
    marks = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    basics = df.agg(*[
        F.struct(F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
                 F.min(F.col(c).cast("double")).alias("min_value"),
                 F.max(F.col(c).cast("double")).alias("max_value")).alias(c) for c in names])
    cuts = quantiles(df, [], {f"{c}|{m}": (c, q) for c in names for m, q in marks.items()})
    cuts = cuts.select(*[F.struct(*[F.col(f"`{c}|{m}`").alias(m) for m in marks]).alias(c)
                         for c in names])
    left = _long(basics, [], "column_name", "s").select("column_name", "s.*")
    right = _long(cuts, [], "column_name", "s").select("column_name", "s.*")
    return left.join(right, "column_name")


def describe_categorical(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """count, number of distinct values, most frequent value and its frequency."""
    pairs = _long(df.select(*[F.col(c).cast("string").alias(c) for c in names]), [],
                  "column_name", "value").where(F.col("value").isNotNull())
    counts = pairs.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("n"), F.col("value").alias("v")))
    return (counts.groupBy("column_name")
            .agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_unique"), best.alias("_best"))
            .select("column_name", "n", "n_unique", F.col("_best.v").alias("top_value"),
                    (-F.col("_best.n")).alias("top_count")))


def unique_values(df: DataFrame, names: Sequence[str], ceiling: int = 5) -> DataFrame:
    """Distinct values (null counts as one) of columns that have at most ``ceiling``.

    Columns above the ceiling get a null list; their values are never gathered.
    """
    pairs = _long(df.select(*[F.col(c).cast("string").alias(c) for c in names]), [],
                  "column_name", "value").distinct()
    counts = pairs.groupBy("column_name").agg(F.count(F.lit(1)).alias("n_unique"))
    few = counts.where(F.col("n_unique") <= ceiling)
    lists = (pairs.join(few.select("column_name"), "column_name", "left_semi")
             .groupBy("column_name").agg(F.sort_array(F.collect_list("value")).alias("_values")))
    return counts.join(lists, "column_name", "left").select(
        "column_name", "n_unique", (F.col("n_unique") > ceiling).cast("int").alias("over_ceiling"),
        F.concat_ws(",", "_values").alias("value_list"))


def value_counts(df: DataFrame, column: str, normalize: bool = False) -> DataFrame:
    """Rows per non-null value, most frequent first; optionally as a share."""
    counts = (df.where(F.col(column).isNotNull()).groupBy(column)
              .agg(F.count(F.lit(1)).alias("n")))
    if normalize:
        total = df.agg(F.count(column).alias("n")).scalar()
        counts = counts.withColumn("share", F.col("n") / total)
    return counts.orderBy(F.col("n").desc(), column)


def distinct_count(df: DataFrame, names: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct non-null values per column; a sketch when ``approximate``."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return _long(df.agg(*[count(c).alias(c) for c in names]), [], "column_name", "n_unique")
