"""What a classifier is here, and the helpers every layer above uses.

An estimator has ``fit(df) -> model``; a model has ``transform(df)`` that adds a
``prediction`` column (0.0 / 1.0) and, if it can, a probability of class 1. Spark ML
estimators qualify as they are; the closed-form and iterative ones in this package follow
the same two methods.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tablesmith.session import shared_folder


def feature_columns(width: int) -> list[Column]:
    values = vector_to_array("features")
    return [values[i] for i in range(width)]


def width_of(df: DataFrame) -> int:
    """Length of the feature vectors, from column metadata or one row."""
    attributes = df.schema["features"].metadata.get("ml_attr", {})
    if "num_attrs" in attributes:
        return attributes["num_attrs"]
    return len(df.select("features").first()[0])


def predict(model, df: DataFrame, prediction: str, probability: str | None = None,
            ranking: str | None = None) -> DataFrame:
    """``df`` plus the model's 0/1 label and, where it has one, its class-1 probability.

    Models without probabilities give null. ``ranking`` is a score for curves: the probability,
    or else the margin of class 1, or else the label.
    """
    scored = model.transform(df)
    outputs = [F.col("prediction").alias(prediction)]
    if ranking:
        if "p1" in scored.columns:
            rank = F.col("p1")
        elif "probability" in scored.columns:
            rank = vector_to_array("probability")[1]
        elif "margin" in scored.columns:
            rank = F.col("margin")
        elif "rawPrediction" in scored.columns:
            rank = vector_to_array("rawPrediction")[1]
        else:
            rank = F.col("prediction")
        outputs.append(rank.alias(ranking))
    if probability:
        if "p1" in scored.columns:
            chance = F.col("p1")
        elif "probability" in scored.columns:
            chance = vector_to_array("probability")[1]
        else:
            chance = F.lit(None).cast("double")
        outputs.append(chance.alias(probability))
    return scored.select(*[c for c in df.columns if c not in (prediction, probability, ranking)], *outputs)


def side_by_side_fits(jobs: Iterable[Callable], parallelism: int = 4) -> list:
    """Run independent fits from a few driver threads; each fit is itself a set of Spark jobs."""
    jobs = list(jobs)
    if len(jobs) <= 1 or parallelism <= 1:
        return [job() for job in jobs]
    # a worker thread of an outer call has no active session of its own
    session = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    with ThreadPool(min(parallelism, len(jobs))) as pool:
        return pool.map(inheritable_thread_target(session)(lambda job: job()), jobs)


def fit_many(estimator, df: DataFrame, subsets: Sequence[Column], parallelism: int = 4) -> list:
    """One model per subset of the rows, in shared passes where the estimator has such a method."""
    if hasattr(estimator, "fit_many"):
        return estimator.fit_many(df, subsets)
    return side_by_side_fits([lambda s=s: estimator.fit(df.where(s)) for s in subsets], parallelism)


def score(model, df: DataFrame) -> float:
    """Share of rows whose prediction equals the label."""
    hit = (F.col("prediction") == F.col("label")).cast("double")
    return model.transform(df).agg(F.avg(hit)).first()[0]


class Pinned:
    """An estimator bound to its parameters, with the fit / predict / score of a wrapper.

    ``build`` makes a fresh estimator, so every fold gets a new model.
    """

    def __init__(self, name: str, build: Callable, **params):
        self.name, self.build, self.params = name, build, params

    def with_params(self, **params) -> Pinned:
        return Pinned(self.name, self.build, **{**self.params, **params})

    def fit(self, df: DataFrame):
        # boosted models cut their lineage only if a checkpoint folder is set
        shared_folder(df.sparkSession)
        return self.build(**self.params).fit(df)

    def fit_many(self, df: DataFrame, subsets: Sequence[Column], parallelism: int = 4) -> list:
        """One model per subset of the rows: in shared passes where the estimator can, else side by side."""
        shared_folder(df.sparkSession)
        return fit_many(self.build(**self.params), df, subsets, parallelism)

    def fit_score(self, df: DataFrame):
        model = self.fit(df)
        return model, score(model, df)

    def __repr__(self) -> str:
        inside = ", ".join(f"{k}={v}" for k, v in sorted(self.params.items()))
        return f"{self.name}({inside})"
