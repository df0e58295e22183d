"""Right-closed bands: equal width, equal frequency, hand-chosen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tablesmith.operators.fitted import Fitted, learn, per_split
from tablesmith.operators.ordering import quantiles


def band(x: Column, edges: Sequence[float]) -> Column:
    """Number of inner edges below x: 0 up to the first edge inclusive; null stays null."""
    chain = F.when(x.isNull(), F.lit(None).cast("int"))
    for code, edge in enumerate(edges):
        chain = chain.when(x <= F.lit(float(edge)), F.lit(code))
    return chain.otherwise(F.lit(len(edges)))


def interval(x: Column, edges: Sequence[float]) -> Column:
    """struct(lo, hi) of the (lo, hi] band that holds x, for edges with both outer ends."""
    chain = F.when(x.isNull(), F.lit(None))
    for lo, hi in zip(edges[:-2], edges[1:-1]):
        chain = chain.when(x <= F.lit(float(hi)),
                           F.struct(F.lit(float(lo)).alias("lo"), F.lit(float(hi)).alias("hi")))
    lo, hi = edges[-2:]
    return chain.otherwise(F.struct(F.lit(float(lo)).alias("lo"), F.lit(float(hi)).alias("hi")))


def width_edges(low: float, high: float, n: int) -> list[float]:
    """Edges of n equal bands; the first is lowered by 0.1 % of the range.

    When all values are equal both ends move apart by 0.1 % of the value (0.001 at zero).
    """
    if low == high:
        step_out = 0.001 * abs(low) if low else 0.001
        low, high = low - step_out, high + step_out
        return [low + (high - low) * i / n for i in range(n + 1)]
    edges = [low + (high - low) * i / n for i in range(n + 1)]
    edges[0] -= (high - low) * 0.001
    return edges


def learn_width(df: DataFrame, column: str, n: int, scope: str = "per_split", split: str = "split") -> Fitted:
    def ends(rows, keys):
        value = F.col(column).cast("double")
        return rows.groupBy(*keys).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))

    fitted = learn(df, ends, scope, split)
    return {s: {"edges": None if v["lo"] is None else width_edges(v["lo"], v["hi"], n)}
            for s, v in fitted.items()}


def learn_quantile(df: DataFrame, column: str, n: int, scope: str = "per_split",
                   split: str = "split") -> Fitted:
    """Equal-frequency edges by exact interpolated quantiles; repeated edges are an error."""
    wanted = {f"e{i}": (column, i / n) for i in range(n + 1)}
    fitted = learn(df, lambda rows, keys: quantiles(rows, keys, wanted), scope, split)
    result = {}
    for s, v in fitted.items():
        edges = [v[f"e{i}"] for i in range(n + 1)]
        if None not in edges and len(set(edges)) < len(edges):
            raise ValueError(f"quantile edges of {column} are not unique: {edges}")
        result[s] = {"edges": None if None in edges else edges}
    return result


def apply_edges(column: str, fitted: Fitted, split: str = "split") -> Column:
    """Band code of a column under learnt edges (the lowest value is in band 0)."""
    return per_split(fitted, lambda v: band(F.col(column), v["edges"][1:-1]) if v["edges"]
                     else F.lit(None).cast("int"), split)


def equal_width(df: DataFrame, column: str, n: int, output: str, scope: str = "per_split",
                split: str = "split") -> DataFrame:
    return df.withColumn(output, apply_edges(column, learn_width(df, column, n, scope, split), split))


def equal_frequency(df: DataFrame, column: str, n: int, output: str, scope: str = "per_split",
                    split: str = "split") -> DataFrame:
    return df.withColumn(output, apply_edges(column, learn_quantile(df, column, n, scope, split), split))
