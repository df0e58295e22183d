"""Trees, forests, boosting: Spark's own tree, and the learners of ``histogram``."""

from __future__ import annotations

from pyspark.ml.classification import DecisionTreeClassifier

from tablesmith.models.histogram import AdaBoost, Bagging, Boosting, ExtraTrees, RandomForest

__all__ = ["AdaBoost", "Bagging", "Boosting", "ExtraTrees", "RandomForest", "boosted_stacker", "decision_tree", "gradient_boosting",
           "random_forest"]

# Trees of the reference grow until pure; Spark's deepest tree has 30 levels.
DEEPEST = 30


def decision_tree(criterion: str = "gini", max_depth: int | None = None, min_leaf: int = 1,
                  seed: int = 0) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(impurity=criterion, maxDepth=DEEPEST if max_depth is None else max_depth,
                                  minInstancesPerNode=min_leaf, maxBins=256, seed=seed)


def random_forest(n_trees: int = 500, max_depth: int | None = None, min_leaf: int = 1, criterion: str = "gini",
                  features: str | int | float = "sqrt", key: str = "id", seed: int = 0) -> RandomForest:
    return RandomForest(n_trees, DEEPEST if max_depth is None else max_depth, min_leaf, criterion, features, key, seed)


def gradient_boosting(n_rounds: int = 500, max_depth: int = 5, min_leaf: int = 2, rate: float = 0.1, key: str = "id",
                      seed: int = 0) -> Boosting:
    """Boosted regression trees of the gradient with Newton steps in the leaves."""
    return Boosting(n_rounds, max_depth, rate, min_leaf, key=key, seed=seed)


def boosted_stacker(n_rounds: int = 2000, max_depth: int = 4, rate: float = 0.1, min_child: float = 2, min_gain: float = 0.9,
                    row_share: float = 0.8, column_share: float = 0.8, l2: float = 1.0, key: str = "id",
                    seed: int = 0) -> Boosting:
    """The second-layer model: second-order boosting, rows and columns drawn per tree."""
    return Boosting(n_rounds, max_depth, rate, min_child, row_share, column_share, l2, min_gain, second_order=True, key=key,
                    seed=seed)
