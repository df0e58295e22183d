"""The named models with their published parameters, and the search grids.

Every function takes overrides, so a caller can shorten the long ones.
"""

from __future__ import annotations

from tablesmith.models import closed_form, linear, neighbours, trees
from tablesmith.models.base import Pinned
from tablesmith.models.selection import grid

# The first-layer models' parameters.
RANDOM_FOREST = {"n_trees": 500, "min_leaf": 1, "features": "sqrt"}
EXTRA_TREES = {"n_trees": 500, "max_depth": 8, "min_leaf": 2}
ADABOOST = {"n_rounds": 500, "rate": 1.0}
GRADIENT_BOOSTING = {"n_rounds": 500, "max_depth": 5, "min_leaf": 2, "rate": 0.1}
POLYNOMIAL_SVC = {"degree": 4, "C": 0.025}
BAGGING = {"n_trees": 400, "feature_share": 0.5}
NEIGHBOURS = {"k": 7, "weights": "distance"}
STACKER = {"n_rounds": 2000, "max_depth": 4, "min_child": 2, "min_gain": 0.9, "row_share": 0.8, "column_share": 0.8}

# The choices the searches run over.
N_ESTIMATORS = [10, 50, 100, 300]
RATIOS = [.1, .25, .5, .75, 1.0]
RATES = [.01, .03, .05, .1, .25]
DEPTHS = [2, 4, 6, 8, 10, None]
CRITERIA = ["gini", "entropy"]


def random_forest(**over) -> Pinned:
    return Pinned("random_forest", trees.random_forest, **{**RANDOM_FOREST, **over})


def extra_trees(**over) -> Pinned:
    return Pinned("extra_trees", trees.ExtraTrees, **{**EXTRA_TREES, **over})


def adaboost(**over) -> Pinned:
    return Pinned("adaboost", trees.AdaBoost, **{**ADABOOST, **over})


def gradient_boosting(**over) -> Pinned:
    return Pinned("gradient_boosting", trees.gradient_boosting, **{**GRADIENT_BOOSTING, **over})


def polynomial_svc(**over) -> Pinned:
    return Pinned("polynomial_svc", linear.polynomial_svc, **{**POLYNOMIAL_SVC, **over})


def bagging(**over) -> Pinned:
    return Pinned("bagging", trees.Bagging, **{**BAGGING, **over})


def neighbours_model(**over) -> Pinned:
    return Pinned("neighbours", neighbours.NearestNeighbours, **{**NEIGHBOURS, **over})


def stacker(**over) -> Pinned:
    return Pinned("boosted_stacker", trees.boosted_stacker, **{**STACKER, **over})


def decision_tree(**over) -> Pinned:
    return Pinned("decision_tree", trees.decision_tree, **over)


def logistic(**over) -> Pinned:
    return Pinned("logistic", linear.Logistic, **over)


def first_layer(fifth: str = "svc", **over) -> dict[str, Pinned]:
    """Five base models; the fifth is the polynomial SVM or logistic regression.

    ``over`` maps a model's short name to parameter overrides.
    """
    models = {"et": extra_trees, "rf": random_forest, "ada": adaboost, "gb": gradient_boosting,
              **({"svc": polynomial_svc} if fifth == "svc" else {"lg": logistic})}
    return {name: build(**over.get(name, {})) for name, build in models.items()}


def second_layer(**over) -> dict[str, Pinned]:
    """The middle layer of three: bagging takes the forest's place."""
    models = {"et": extra_trees, "bg": bagging, "ada": adaboost, "gb": gradient_boosting, "svc": polynomial_svc}
    return {name: build(**over.get(name, {})) for name, build in models.items()}


def comparison_models(key: str = "id", n_trees: int = 100, n_rounds: int = 50) -> dict[str, Pinned]:
    """The models of the comparison table that have a distributed form."""
    return {
        "AdaBoost": Pinned("AdaBoost", trees.AdaBoost, n_rounds=n_rounds),
        "Bagging": Pinned("Bagging", trees.Bagging, n_trees=10, key=key),
        "ExtraTrees": Pinned("ExtraTrees", trees.ExtraTrees, n_trees=n_trees, max_depth=None, min_leaf=1),
        "GradientBoosting": Pinned("GradientBoosting", trees.gradient_boosting, n_rounds=n_rounds, max_depth=3,
                                   min_leaf=1),
        "RandomForest": Pinned("RandomForest", trees.random_forest, n_trees=n_trees),
        "LogisticCV": Pinned("LogisticCV", linear.LogisticCV, key=key),
        "PassiveAggressive": Pinned("PassiveAggressive", linear.PassiveAggressive),
        "RidgeCV": Pinned("RidgeCV", closed_form.RidgeClassifier),
        "SGD": Pinned("SGD", linear.SubgradientLinear, loss="hinge"),
        "Perceptron": Pinned("Perceptron", linear.SubgradientLinear, loss="perceptron"),
        "BernoulliNB": Pinned("BernoulliNB", closed_form.BernoulliNB),
        "GaussianNB": Pinned("GaussianNB", closed_form.GaussianNB),
        "Neighbours": Pinned("Neighbours", neighbours.NearestNeighbours, k=5, key=key),
        "PolynomialSVC": Pinned("PolynomialSVC", linear.polynomial_svc, degree=3, C=1.0),
        "LinearSVC": Pinned("LinearSVC", linear.hinge_svc),
        "DecisionTree": Pinned("DecisionTree", trees.decision_tree),
        "ExtraTree": Pinned("ExtraTree", trees.ExtraTrees, n_trees=1, max_depth=None, min_leaf=1),
        "LinearDiscriminant": Pinned("LinearDiscriminant", closed_form.LinearDiscriminant),
        "QuadraticDiscriminant": Pinned("QuadraticDiscriminant", closed_form.QuadraticDiscriminant),
        "Boosted": Pinned("Boosted", trees.boosted_stacker, n_rounds=n_rounds, max_depth=3, min_child=1, min_gain=0.0, row_share=1.0,
                          column_share=1.0, key=key),
    }


def search_grids() -> dict[str, list[dict]]:
    """Combinations tried per voting model, by the names of ``comparison_models``."""
    return {
        "AdaBoost": grid(n_rounds=N_ESTIMATORS, rate=RATES),
        "Bagging": grid(n_trees=N_ESTIMATORS, row_share=RATIOS),
        "ExtraTrees": grid(n_trees=N_ESTIMATORS, criterion=CRITERIA, max_depth=DEPTHS),
        "GradientBoosting": grid(rate=[.05], n_rounds=[300], max_depth=DEPTHS),
        "RandomForest": grid(n_trees=N_ESTIMATORS, criterion=CRITERIA, max_depth=DEPTHS),
        "LogisticCV": grid(fit_intercept=[True, False]),
        "BernoulliNB": grid(alpha=RATIOS),
        "GaussianNB": [{}],
        "Neighbours": grid(k=[1, 2, 3, 4, 5, 6, 7], weights=["uniform", "distance"]),
        "PolynomialSVC": grid(C=[1, 2, 3, 4, 5]),
        "Boosted": grid(rate=RATES, max_depth=[1, 2, 4, 6, 8, 10], n_rounds=N_ESTIMATORS),
        "DecisionTree": grid(criterion=CRITERIA, max_depth=DEPTHS),
    }
