"""Exact k nearest neighbours by equi-joins on grid cells.

Equal vectors are collapsed first: of the rows that share one vector only the k smallest
ids can ever be neighbours, and equal queries have equal answers. Distinct vectors fall
into cells of a grid over the two widest-spread features. A query looks at its own cell and
the eight around it, which hold every point within one cell width; if k of them lie within
that width the answer is final. Queries that found too few go on with wider cells, until
the cells span the data. No pair outside neighbouring cells is ever formed.
"""

from __future__ import annotations

import math

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from tablesmith.models.base import width_of
from tablesmith.operators.relational import attach
from tablesmith.session import durable

# The first grid is the coarsest whose fullest cell holds at most this many distinct vectors.
CELL_LIMIT = 128


def _top(df: DataFrame, by: str, order: list, k: int) -> DataFrame:
    """First k rows per group; Spark keeps k per group and task before it shuffles."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(by).orderBy(*order)))
    return ranked.where(F.col("_rank") <= k).drop("_rank")


class NearestNeighbours:
    def __init__(self, k: int = 5, weights: str = "uniform", key: str = "id", cell_limit: int = CELL_LIMIT):
        self.k, self.weights, self.key, self.cell_limit = k, weights, key, cell_limit

    def fit(self, df: DataFrame) -> _Neighbours:
        width = width_of(df)
        rows = df.select(F.col(self.key).alias("_id"), "label", vector_to_array("features").alias("_v"))
        nearest = _top(rows, "_v", ["_id"], self.k)
        points = durable(nearest.groupBy("_v").agg(
            F.array_sort(F.collect_list(F.struct("_id", "label"))).alias("_members")))
        spread = points.agg(
            F.count(F.lit(1)).alias("n"),
            *[f(F.col("_v")[i]).alias(f"{name}{i}") for i in range(width)
              for name, f in (("lo", F.min), ("hi", F.max), ("sd", F.stddev_pop))]).first()
        axes = sorted(range(width), key=lambda i: -(spread[f"sd{i}"] or 0.0))[:2]
        low = [spread[f"lo{i}"] for i in axes]
        span = max(spread[f"hi{i}"] - spread[f"lo{i}"] for i in axes)
        model = _Neighbours(self, points, width, axes, low, span or 1.0)
        if spread.n > self.cell_limit:
            # halving at least until an even spread would fit; skew may need more
            model.size /= 2.0 ** max(0, math.floor(math.log2(math.sqrt(spread.n / self.cell_limit))))
            while model.size > model.span * 1e-9 and model.fullest_cell(model.size) > self.cell_limit:
                model.size /= 2.0
        return model


class _Neighbours:
    def __init__(self, owner: NearestNeighbours, points: DataFrame, width, axes, low, span):
        self.k, self.weights, self.key = owner.k, owner.weights, owner.key
        self.width = width
        self.points, self.axes, self.low, self.span, self.size = points, axes, low, span, span

    def _cell(self, size: float) -> list[Column]:
        return [F.floor((F.col("_v")[a] - F.lit(lo)) / F.lit(size)) for a, lo in zip(self.axes, self.low)]

    def fullest_cell(self, size: float) -> int:
        return (self.points.groupBy(*self._cell(size)).count().agg(F.max("count")).first()[0])

    def _round(self, queries: DataFrame, size: float, last: bool) -> DataFrame:
        """(query vector, up to k neighbours with distance) found at one cell width."""
        cells = [f"_c{i}" for i in range(len(self.axes))]
        placed = self.points.withColumns(dict(zip(cells, self._cell(size)))).withColumnRenamed("_v", "_p")
        around = queries.withColumns(dict(zip(cells, self._cell(size))))
        if last:
            # one cell spans the data, and queries outside it are looked up from its rim
            edge = F.lit(int(self.span // size)).cast("long")
            around = around.withColumns({c: F.least(F.greatest(F.col(c), F.lit(0).cast("long")), edge) for c in cells})
        for c in cells:
            around = around.withColumn(c, F.explode(F.array(F.col(c) - 1, F.col(c), F.col(c) + 1)))
        gap = F.lit(0.0)
        for i in range(self.width):
            gap = gap + (F.col("_v")[i] - F.col("_p")[i]) * (F.col("_v")[i] - F.col("_p")[i])
        near = around.join(placed, cells).withColumn("_d", gap)
        if not last:
            # a hair inside one cell width, so rounding cannot reach past the neighbouring cells
            near = near.where(F.col("_d") <= (size * (1 - 1e-9)) ** 2)
        near = near.select("_v", "_d", F.inline("_members"))
        return (_top(near, "_v", ["_d", "_id"], self.k).groupBy("_v")
                .agg(F.collect_list(F.struct("_d", "label")).alias("_near")))

    def transform(self, df: DataFrame) -> DataFrame:
        rows = df.withColumn("_v", vector_to_array("features"))
        sizes = durable(rows.groupBy("_v").agg(F.count(F.lit(1)).alias("_rows")))
        waiting, done, size = sizes.select("_v"), [], self.size
        n_all = waiting.count()
        while True:
            last = size >= self.span
            found = durable(self._round(waiting, size, last))
            final = found if last else found.where(F.size("_near") == self.k)
            done.append(final)
            if last:
                break
            waiting = durable(waiting.join(final.select("_v"), "_v", "left_anti"))
            n_waiting = waiting.count()
            if not n_waiting:
                break
            # wider cells for fewer queries: each round forms about as many pairs as the first
            size *= max(2.0, math.sqrt(n_all / n_waiting))
        answers = done[0]
        for part in done[1:]:
            answers = answers.unionByName(part)
        touching = F.exists("_near", lambda n: n["_d"] == 0)
        if self.weights == "distance":
            def weight(n):
                return (F.when(touching, (n["_d"] == 0).cast("double"))
                        .otherwise(F.lit(1.0) / F.nullif(F.sqrt(n["_d"]), F.lit(0.0))))
        else:
            def weight(n):
                return F.lit(1.0)
        mass = F.aggregate("_near", F.lit(0.0), lambda t, n: t + weight(n))
        ones = F.aggregate("_near", F.lit(0.0), lambda t, n: t + weight(n) * n["label"])
        answers = answers.select("_v", (ones / mass).alias("p1"))
        groups = answers.join(sizes, "_v")
        return (attach(rows, groups, ["_v"], "_rows", [self.key]).drop("_v")
                .withColumn("prediction", (F.col("p1") > 0.5).cast("double")))
