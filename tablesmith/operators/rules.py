"""Hand-written rule models and baselines, as one expression each."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tablesmith.functions.seeded import uniform


def _two_branches(sex: Column, female, male, pclass: Column, port: Column, fare: Column,
                  lucky_male: Column) -> Column:
    poor = (pclass == 3) & (port == "S") & (fare > 8)
    return (F.when((sex == female) & poor, 0).when(sex == female, 1)
            .when((sex == male) & lucky_male, 1).otherwise(0))


def rule_tree(sex: Column, pclass: Column, port: Column, fare: Column, title: Column) -> Column:
    """Women survive unless third class from S with a fare above 8; boys survive."""
    return _two_branches(sex, "female", "male", pclass, port, fare, title == "Master")


def rule_tree_coded(sex: Column, pclass: Column, port: Column, fare: Column, title_code: Column) -> Column:
    """The same tree over coded titles, where 3 marks a boy."""
    return _two_branches(sex, "female", "male", pclass, port, fare, title_code == 3)


def gender_rule(sex: Column, positive: str = "female") -> Column:
    return F.when(sex == positive, 1).otherwise(0)


def coin_flip(key: Column, seed: int = 0) -> Column:
    """1 where the key's uniform number is above one half."""
    return (uniform(key, seed) > 0.5).cast("int")


def _values(tree, columns: dict[str, np.ndarray]) -> np.ndarray:
    """``functions.numeric.expression`` on arrays; a missing value (NaN) stays missing, ``max`` and ``min`` skip it."""
    if isinstance(tree, str):
        return columns[tree]
    if isinstance(tree, (int, float)):
        return np.float64(tree)
    name, *arguments = tree
    a, *rest = (_values(argument, columns) for argument in arguments)
    if name == "div":
        return np.where(rest[0] == 0, 1.0, a / np.where(rest[0] == 0, 1.0, rest[0]))
    plain = {"add": np.add, "sub": np.subtract, "mul": np.multiply, "cos": np.cos, "sin": np.sin, "tanh": np.tanh, "max": np.fmax,
             "min": np.fmin}
    return plain[name](a, *rest)


def _columns_of(tree) -> set[str]:
    if isinstance(tree, tuple):
        return set().union(*map(_columns_of, tree[1:]))
    return {tree} if isinstance(tree, str) else set()


def population_fitness(df: DataFrame, candidates: Sequence, label: str) -> DataFrame:
    """Accuracy of every candidate expression from one scan, one row per candidate.

    Candidates are nested tuples over columns and constants; a missing result or label is a miss.
    A population is hundreds of expressions, too much for one generated method, so they
    are evaluated on the arrays of a batch; a task sends one pair of numbers per candidate.
    """
    names = sorted(set().union(*map(_columns_of, candidates)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits, rows = np.zeros(len(candidates)), 0
        for batch in batches:
            values = {n: batch.column(n).to_numpy(zero_copy_only=False).astype(np.float64) for n in batch.schema.names}
            rows += batch.num_rows
            with np.errstate(all="ignore"):
                for i, c in enumerate(candidates):
                    guess = np.round(1.0 - 1.0 / (1.0 + np.exp(-_values(c, values))))
                    hits[i] += np.count_nonzero(guess == values["_truth"])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(hits), dtype=np.int32)), pa.array(hits),
                                          pa.array(np.full(len(hits), float(rows)))], ["candidate", "hits", "n"])

    inputs = [F.col(n).cast("double").alias(n) for n in names]
    return (df.select(*inputs, F.col(label).cast("double").alias("_truth"))
            .mapInArrow(run, "candidate int, hits double, n double").groupBy("candidate")
            .agg((F.sum("hits") / F.nullif(F.sum("n"), F.lit(0.0))).alias("fitness")))


def fitness_summary(fitness: DataFrame) -> DataFrame:
    return fitness.agg(F.avg("fitness").alias("avg"), F.stddev_pop("fitness").alias("std"),
                       F.min("fitness").alias("min"), F.max("fitness").alias("max"))
