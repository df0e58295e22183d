"""Models whose parameters are sums over the rows: one aggregate, one small solve.

Fitting is a single grouped aggregate (one row per class comes back); scoring is a Column
expression, so predictions stay inside generated code.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations_with_replacement

import numpy as np
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from tablesmith.models.base import feature_columns, width_of

# Up to this width all covariances are one row of aggregates; above it, a matrix per class.
MAX_WIDTH = 64


def _total(terms: Sequence[Column]) -> Column:
    result = F.lit(0.0)
    for term in terms:
        result = result + term
    return result


class _LogScores:
    """Predicts the class with the larger log score, the smaller label on ties."""

    def __init__(self, scores: dict[float, Column]):
        self.scores = scores

    def transform(self, df: DataFrame) -> DataFrame:
        labels = sorted(self.scores)
        out = df.withColumns({f"_s{i}": self.scores[c] for i, c in enumerate(labels)})
        top = F.greatest(*[F.col(f"_s{i}") for i in range(len(labels))]) if len(labels) > 1 else F.col("_s0")
        chosen = F.coalesce(*[F.when(F.col(f"_s{i}") == top, F.lit(c)) for i, c in enumerate(labels)])
        mass = _total([F.exp(F.col(f"_s{i}") - top) for i in range(len(labels))])
        one = labels.index(1.0) if 1.0 in labels else None
        chance = F.lit(0.0) if one is None else F.exp(F.col(f"_s{one}") - top) / mass
        return (out.withColumns({"prediction": chosen, "p1": chance})
                .drop(*[f"_s{i}" for i in range(len(labels))]))


class GaussianNB:
    """Normal features per class; variances are padded by 1e-9 of the largest one."""

    def __init__(self, padding: float = 1e-9):
        self.padding = padding

    def fit(self, df: DataFrame) -> _LogScores:
        xs = feature_columns(width_of(df))
        rows = df.rollup("label").agg(
            F.count(F.lit(1)).alias("n"), *[F.avg(x).alias(f"m{i}") for i, x in enumerate(xs)],
            *[F.var_pop(x).alias(f"v{i}") for i, x in enumerate(xs)]).collect()
        whole = next(r for r in rows if r.label is None)
        pad = self.padding * max(whole[f"v{i}"] for i in range(len(xs)))
        scores = {}
        for r in (r for r in rows if r.label is not None):
            terms = []
            for i, x in enumerate(xs):
                v = r[f"v{i}"] + pad
                terms.append(F.lit(-0.5 * math.log(2 * math.pi * v)) - (x - r[f"m{i}"]) * (x - r[f"m{i}"]) / (2 * v))
            scores[r.label] = _total(terms) + math.log(r.n / whole.n)
        return _LogScores(scores)


class BernoulliNB:
    """Features above the threshold count as present; additive smoothing."""

    def __init__(self, alpha: float = 1.0, threshold: float = 0.0):
        self.alpha, self.threshold = alpha, threshold

    def fit(self, df: DataFrame) -> _LogScores:
        on = [x > self.threshold for x in feature_columns(width_of(df))]
        rows = df.groupBy("label").agg(
            F.count(F.lit(1)).alias("n"), *[F.count_if(x).alias(f"c{i}") for i, x in enumerate(on)]).collect()
        whole = sum(r.n for r in rows)
        scores = {}
        for r in rows:
            terms = []
            for i, x in enumerate(on):
                p = (r[f"c{i}"] + self.alpha) / (r.n + 2 * self.alpha)
                terms.append(F.when(x, math.log(p)).otherwise(math.log(1 - p)))
            scores[r.label] = _total(terms) + math.log(r.n / whole)
        return _LogScores(scores)


def _moments(df: DataFrame) -> dict[float, tuple[int, np.ndarray, np.ndarray]]:
    """{label: (rows, mean vector, population covariance)} from one grouped aggregate."""
    width = width_of(df)
    if width > MAX_WIDTH:
        return _wide_moments(df)
    xs = feature_columns(width)
    pairs = list(combinations_with_replacement(range(width), 2))
    rows = df.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.avg(x) for x in xs]).alias("mean"),
        F.array(*[F.covar_pop(xs[i], xs[j]) for i, j in pairs]).alias("cov")).collect()
    found = {}
    for r in rows:
        cov = np.zeros((width, width))
        for (i, j), value in zip(pairs, r.cov):
            cov[i, j] = cov[j, i] = value
        found[r.label] = (r.n, np.array(r.mean), cov)
    return found


def _wide_moments(df: DataFrame) -> dict[float, tuple[int, np.ndarray, np.ndarray]]:
    """The same for wide vectors: per class a correlation matrix, scaled by the deviations."""
    wanted = Summarizer.metrics("count", "mean", "variance").summary(F.col("features")).alias("s")
    found = {}
    for r in df.groupBy("label").agg(wanted).collect():
        n, spread = r.s["count"], np.sqrt(np.maximum(r.s["variance"].toArray(), 0.0) * (r.s["count"] - 1) / r.s["count"])
        cov = np.zeros((len(spread), len(spread)))
        if n > 1:
            rows = df.where(F.col("label").eqNullSafe(F.lit(r.label)))
            related = np.nan_to_num(Correlation.corr(rows, "features").first()[0].toArray())
            np.fill_diagonal(related, 1.0)
            cov = related * np.outer(spread, spread)
        found[r.label] = (n, r.s["mean"].toArray(), cov)
    return found


def _affine(weights: Sequence[float], intercept: float) -> Column:
    xs = feature_columns(len(weights))
    return _total([x * float(w) for x, w in zip(xs, weights)]) + float(intercept)


def _quadratic(matrix: np.ndarray, mean: np.ndarray) -> Column:
    centred = [x - float(m) for x, m in zip(feature_columns(len(mean)), mean)]
    return _total([centred[i] * centred[j] * float(matrix[i, j] * (1 if i == j else 2))
                   for i, j in combinations_with_replacement(range(len(mean)), 2)])


class LinearDiscriminant:
    """Classes share one covariance, pooled over classes."""

    def fit(self, df: DataFrame) -> _LogScores:
        parts = _moments(df)
        total = sum(n for n, _, _ in parts.values())
        pooled = sum(n * cov for n, _, cov in parts.values()) / max(1, total - len(parts))
        inverse = np.linalg.pinv(pooled, hermitian=True)
        scores = {}
        for label, (n, mean, _) in parts.items():
            weights = inverse @ mean
            scores[label] = _affine(weights, -0.5 * mean @ weights + math.log(n / total))
        return _LogScores(scores)


class QuadraticDiscriminant:
    """One covariance per class; directions without variance are left out."""

    def __init__(self, tolerance: float = 1e-12):
        self.tolerance = tolerance

    def fit(self, df: DataFrame) -> _LogScores:
        parts = _moments(df)
        total = sum(n for n, _, _ in parts.values())
        scores = {}
        for label, (n, mean, cov) in parts.items():
            values, vectors = np.linalg.eigh(cov * n / max(1, n - 1))
            keep = values > self.tolerance * max(values.max(), 1e-300)
            inverse = (vectors[:, keep] / values[keep]) @ vectors[:, keep].T
            log_det = float(np.log(values[keep]).sum())
            scores[label] = _quadratic(inverse, mean) * -0.5 + (math.log(n / total) - 0.5 * log_det)
        return _LogScores(scores)


class _SignModel:
    def __init__(self, weights, intercept, alpha=None):
        self.weights, self.intercept, self.alpha = list(map(float, weights)), float(intercept), alpha

    def transform(self, df: DataFrame) -> DataFrame:
        margin = _affine(self.weights, self.intercept)
        return df.withColumn("margin", margin).withColumn("prediction", (F.col("margin") > 0).cast("double"))


class RidgeClassifier:
    """Least squares on -1 / +1 with an L2 penalty chosen by leave-one-out error.

    The normal equations come from one aggregate. Leaving one row out has a closed form,
    (y - prediction) / (1 - leverage), so each penalty costs one aggregate, not n fits.
    """

    def __init__(self, alphas: Sequence[float] = (0.1, 1.0, 10.0)):
        self.alphas = alphas

    def fit(self, df: DataFrame) -> _SignModel:
        parts = _moments(df)
        total = sum(n for n, _, _ in parts.values())
        mean = sum(n * m for n, m, _ in parts.values()) / total
        scatter = sum(n * (cov + np.outer(m - mean, m - mean)) for n, m, cov in parts.values())
        signs = {label: 1.0 if label == 1.0 else -1.0 for label in parts}
        y_mean = sum(n * signs[label] for label, (n, _, _) in parts.items()) / total
        cross = sum(n * (signs[label] - y_mean) * (m - mean) for label, (n, m, _) in parts.items())
        target = F.when(F.col("label") == 1.0, 1.0).otherwise(-1.0)
        fits, errors = [], []
        for alpha in self.alphas:
            inverse = np.linalg.inv(scatter + alpha * np.eye(len(mean)))
            weights = inverse @ cross
            intercept = y_mean - mean @ weights
            leverage = _quadratic(inverse, mean) + 1.0 / total
            # a row of leverage 1 decides its own prediction and has no error left out
            left_out = F.try_divide(target - _affine(weights, intercept), 1.0 - leverage)
            fits.append(_SignModel(weights, intercept, alpha))
            errors.append(F.avg(left_out * left_out).alias(f"e{len(errors)}"))
        losses = df.agg(*errors).first()
        return fits[min(range(len(fits)), key=lambda i: losses[i])]
