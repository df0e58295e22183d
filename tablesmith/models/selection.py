"""Comparing, tuning and pruning models over repeated random splits."""

from __future__ import annotations

import statistics
import time
from collections.abc import Mapping, Sequence
from itertools import product

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorSlicer
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tablesmith.models.base import Pinned, fit_many, predict, side_by_side_fits, width_of
from tablesmith.operators.splits import shuffle_roles
from tablesmith.session import cached

METRICS = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("parameters", T.StringType()),
    T.StructField("train_mean", T.DoubleType()), T.StructField("test_mean", T.DoubleType()),
    T.StructField("test_3std", T.DoubleType()), T.StructField("test_min", T.DoubleType()),
    T.StructField("fit_seconds", T.DoubleType())])


def draws(df: DataFrame, key: str = "id", n: int = 10, test_size: float = 0.3, train_size: float = 0.6,
          seed: int = 0) -> list[Column]:
    """Role columns of the repeated shuffle splits every comparison uses."""
    return shuffle_roles(df.select(key), key, n, test_size, train_size, seed)


def _auc(scored: DataFrame) -> float:
    """Exact area under the curve (no down-sampling of thresholds)."""
    return BinaryClassificationEvaluator(rawPredictionCol="_chance", labelCol="label", numBins=0).evaluate(scored)


def _model_scores(model, df: DataFrame, role: Column, scoring: str) -> tuple[float, float]:
    """(train score, test score) of a model on one split."""
    rows = df.withColumn("_role", role)
    scored = predict(model, rows.where(F.col("_role") != "unused"), "_guess", ranking="_chance")
    if scoring == "roc_auc":
        scored = scored.select("_role", "label", "_chance")
        return _auc(scored.where(F.col("_role") == "train")), _auc(scored.where(F.col("_role") == "test"))
    hit = F.avg((F.col("_guess") == F.col("label")).cast("double"))
    found = {r[0]: r[1] for r in scored.groupBy("_role").agg(hit).collect()}
    return found["train"], found["test"]


def _draw_scores(estimator, df: DataFrame, roles: Sequence[Column], scoring: str, parallelism: int
                 ) -> list[tuple[float, float, float]]:
    """(train score, test score, fit seconds) of every split; the splits share passes where the estimator can."""
    start = time.perf_counter()
    models = fit_many(estimator, df, [r == "train" for r in roles], parallelism)
    seconds = (time.perf_counter() - start) / max(len(roles), 1)
    found = side_by_side_fits([lambda m=m, r=r: _model_scores(m, df, r, scoring) for m, r in zip(models, roles)], parallelism)
    return [(*f, seconds) for f in found]


def _summary(name: str, estimator, splits: Sequence[tuple[float, float, float]]) -> dict:
    train, test, seconds = zip(*splits)
    return {"name": name, "parameters": repr(estimator) if isinstance(estimator, Pinned) else type(estimator).__name__,
            "train_mean": statistics.fmean(train), "test_mean": statistics.fmean(test),
            "test_3std": 3 * statistics.pstdev(test), "test_min": min(test), "fit_seconds": statistics.fmean(seconds)}


def cross_validate(candidates: Mapping[str, object], df: DataFrame, roles: Sequence[Column],
                   scoring: str = "accuracy", parallelism: int = 4) -> list[dict]:
    """Scores of every candidate over every split, fitted a few at a time."""
    with cached(df):
        jobs = [lambda e=e: _draw_scores(e, df, roles, scoring, parallelism) for e in candidates.values()]
        found = side_by_side_fits(jobs, parallelism)
    return [_summary(name, e, splits) for (name, e), splits in zip(candidates.items(), found)]


def metric_table(df: DataFrame, summaries: Sequence[dict]) -> DataFrame:
    """Summaries as a table, best mean test score first."""
    rows = [tuple(s[f.name] for f in METRICS.fields) for s in summaries]
    return df.sparkSession.createDataFrame(rows, METRICS).orderBy(F.col("test_mean").desc(), "name")


def compare(candidates: Mapping[str, object], train: DataFrame, test: DataFrame, roles: Sequence[Column],
            parallelism: int = 4) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(metric table, predictions on train, predictions on test), one column per model."""
    summaries = cross_validate(candidates, train, roles, parallelism=parallelism)
    with cached(train):
        models = side_by_side_fits([lambda e=e: e.fit(train) for e in candidates.values()], parallelism)
    on_train, on_test = train, test
    for name, model in zip(candidates, models):
        on_train, on_test = predict(model, on_train, name), predict(model, on_test, name)
    return metric_table(train, summaries), on_train.drop("features"), on_test.drop("features")


def grid(**choices: Sequence) -> list[dict]:
    """Every combination of the given values."""
    return [dict(zip(choices, values)) for values in product(*choices.values())]


def grid_search(base: Pinned, combinations: Sequence[dict], df: DataFrame, roles: Sequence[Column],
                scoring: str = "roc_auc", parallelism: int = 4) -> tuple[Pinned, list[dict]]:
    """Best combination by mean test score (the first on ties) and all summaries."""
    candidates = {str(i): base.with_params(**c) for i, c in enumerate(combinations)}
    summaries = cross_validate(candidates, df, roles, scoring, parallelism)
    best = max(range(len(summaries)), key=lambda i: (summaries[i]["test_mean"], -i))
    return candidates[str(best)], summaries


class Tuned:
    """A grid search as an estimator: searching again inside every fit gives nested validation."""

    def __init__(self, base: Pinned, combinations: Sequence[dict], key: str = "id", n_draws: int = 10,
                 seed: int = 100, parallelism: int = 4):
        self.base, self.combinations, self.key = base, combinations, key
        self.n_draws, self.seed, self.parallelism = n_draws, seed, parallelism

    def fit(self, df: DataFrame):
        best, _ = grid_search(self.base, self.combinations, df, draws(df, self.key, self.n_draws, seed=self.seed),
                              parallelism=self.parallelism)
        return best.fit(df)


def _sliced(df: DataFrame, kept: Sequence[int]) -> DataFrame:
    slicer = VectorSlicer(inputCol="features", outputCol="_kept", indices=list(kept))
    return slicer.transform(df).drop("features").withColumnRenamed("_kept", "features")


def _weakest(model, kept: Sequence[int]) -> int:
    values = list(model.featureImportances.toArray())
    return kept[min(range(len(kept)), key=lambda i: (values[i], i))]


def eliminate_features(estimator, df: DataFrame, roles: Sequence[Column], parallelism: int = 4
                       ) -> tuple[list[int], dict[int, float]]:
    """Recursive elimination: (indices of the best subset, mean test score per subset size).

    Every split drops its least important feature until one is left and scores each size;
    the size with the best mean score (the smaller on ties) is then reached on all rows.
    """
    width = width_of(df)

    def path(role: Column) -> dict[int, float]:
        kept, scores = list(range(width)), {}
        rows = df.withColumn("_role", role)
        while kept:
            part = _sliced(rows, kept)
            model = estimator.fit(part.where(F.col("_role") == "train"))
            hit = F.avg((F.col("prediction") == F.col("label")).cast("double"))
            scores[len(kept)] = model.transform(part.where(F.col("_role") == "test")).agg(hit).first()[0]
            kept.remove(_weakest(model, kept))
        return scores

    with cached(df):
        paths = side_by_side_fits([lambda r=r: path(r) for r in roles], parallelism)
        means = {n: statistics.fmean(p[n] for p in paths) for n in range(1, width + 1)}
        best = min(means, key=lambda n: (-means[n], n))
        kept = list(range(width))
        while len(kept) > best:
            kept.remove(_weakest(estimator.fit(_sliced(df, kept)), kept))
    return kept, means
