"""Classifiers on documents: labelled ones train, unlabelled ones are predicted."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tablesmith.functions.text import n_chars
from tablesmith.models import closed_form, inspect, linear, neighbours, trees, zoo
from tablesmith.models.base import Pinned, predict
from tablesmith.operators import encode
from tablesmith.session import durable
from workloads.base import query, r6, table

FEATURES = ["n_chars", "n_words", "digit_share", "upper_share", "lang_code", "source_code"]


def documents(spark, sf) -> DataFrame:
    """One row per document: numbers read from the whole text, label null where unknown.

    Texts are read once; the small numeric table is written out, as every fit scans it many
    times.
    """
    text = F.col("text")
    length = n_chars(text).cast("double")
    rows = table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), "lang", length.alias("n_chars"),
        (length - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1).alias("n_words"),
        ((length - F.length(F.regexp_replace(text, "[0-9]+", ""))) / length).alias("digit_share"),
        ((length - F.length(F.regexp_replace(text, "[A-Z]+", ""))) / length).alias("upper_share"),
        F.regexp_replace("source", "[^0-9]", "").cast("int").alias("source_code"))
    labels = table(spark, sf, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("quality"))
    rows = durable(rows.join(labels, "id", "left"))
    rows = encode.label_codes(rows, {"lang": "lang_code"}, "id", by=())
    return encode.assemble(rows, FEATURES, "id", "quality")


def train_test(spark, sf) -> tuple[DataFrame, DataFrame]:
    rows = documents(spark, sf)
    return rows.where(F.col("label").isNotNull()), rows.where(F.col("label").isNull()).drop("label")


# Opens every document query in SQL.
D = """WITH d AS (SELECT documents.doc_id AS id, CAST(quality AS DOUBLE) AS label,
  CAST(length(text) AS DOUBLE) AS f0,
  CAST(length(text) - length(replace(text, ' ', '')) + 1 AS DOUBLE) AS f1,
  length(regexp_replace(text, '[^0-9]', '', 'g')) / CAST(length(text) AS DOUBLE) AS f2,
  length(regexp_replace(text, '[^A-Z]', '', 'g')) / CAST(length(text) AS DOUBLE) AS f3,
  CAST(dense_rank() OVER (ORDER BY lang) - 1 AS DOUBLE) AS f4,
  CAST(regexp_replace(source, '[^0-9]', '', 'g') AS DOUBLE) AS f5
  FROM documents LEFT JOIN labels USING (doc_id))"""
FS = [f"f{i}" for i in range(6)]


def gaussian_sql(rows: str, train: str, on: str) -> str:
    """CTEs scoring ``rows`` by models fitted on ``train`` (a table with group column g)."""
    terms = " + ".join(
        f"(-0.5 * ln(2 * pi() * (v_{f} + pad)) - ({rows}.{f} - m_{f}) * ({rows}.{f} - m_{f}) / (2 * (v_{f} + pad)))"
        for f in FS)
    return f"""st AS (SELECT g, label AS c, count(*) AS n, {', '.join(f'avg({f}) AS m_{f}, var_pop({f}) AS v_{f}' for f in FS)}
  FROM {train} GROUP BY g, label),
wh AS (SELECT g, count(*) AS total, 1e-9 * greatest({', '.join(f'var_pop({f})' for f in FS)}) AS pad
  FROM {train} GROUP BY g),
sc AS (SELECT {rows}.id, st.g, c, ln(n / CAST(total AS DOUBLE)) + {terms} AS s
  FROM {rows} JOIN st ON {on} JOIN wh ON wh.g = st.g),
pr AS (SELECT id, g, CAST(arg_min(c, (-s, c)) AS INTEGER) AS prediction,
  1 / (1 + exp(max(s) FILTER (c = 0) - max(s) FILTER (c = 1))) AS p1 FROM sc GROUP BY id, g)"""


def fitted(spark, sf, estimator, probability: bool = False) -> DataFrame:
    """Predictions of one estimator for the unlabelled documents."""
    train, test = train_test(spark, sf)
    scored = predict(estimator.fit(train), test, "prediction", "p1" if probability else None)
    outputs = [F.col("prediction").cast("int").alias("prediction")]
    if probability:
        outputs.append(r6("p1").alias("p1"))
    return scored.select("id", *outputs)


@query("model_gaussian_nb", D + ", t AS (SELECT *, 0 AS g FROM d WHERE label IS NOT NULL), x AS (SELECT * FROM d "
       "WHERE label IS NULL), " + gaussian_sql("x", "t", "true") + " SELECT id, prediction, round(p1, 6) AS p1 FROM pr")
def model_gaussian_nb(spark, sf):
    return fitted(spark, sf, closed_form.GaussianNB(), probability=True)


def bernoulli_sql(rows: str, train: str, on: str, tag: str = "b") -> str:
    """The same for present / absent features; CTE names carry ``tag``."""
    terms = " + ".join(f"CASE WHEN {rows}.{f} > 0 THEN ln((c_{f} + 1) / CAST(n + 2 AS DOUBLE))"
                       f" ELSE ln(1 - (c_{f} + 1) / CAST(n + 2 AS DOUBLE)) END" for f in FS)
    return f"""st{tag} AS (SELECT g, label AS c, count(*) AS n,
  {', '.join(f'count(*) FILTER ({f} > 0) AS c_{f}' for f in FS)} FROM {train} GROUP BY g, label),
wh{tag} AS (SELECT g, count(*) AS total FROM {train} GROUP BY g),
sc{tag} AS (SELECT {rows}.id, st{tag}.g, c, ln(n / CAST(total AS DOUBLE)) + {terms} AS s
  FROM {rows} JOIN st{tag} ON {on.replace('st.', f'st{tag}.')} JOIN wh{tag} ON wh{tag}.g = st{tag}.g),
pr{tag} AS (SELECT id, g, CAST(arg_min(c, (-s, c)) AS INTEGER) AS prediction,
  1 / (1 + exp(max(s) FILTER (c = 0) - max(s) FILTER (c = 1))) AS p1 FROM sc{tag} GROUP BY id, g)"""


ALL_LABELLED = ", t AS (SELECT *, 0 AS g FROM d WHERE label IS NOT NULL)"


@query("model_bernoulli_nb", D + ALL_LABELLED + ", x AS (SELECT * FROM d WHERE label IS NULL), "
       + bernoulli_sql("x", "t", "true") + " SELECT id, prediction, round(p1, 6) AS p1 FROM prb")
def model_bernoulli_nb(spark, sf):
    return fitted(spark, sf, closed_form.BernoulliNB(), probability=True)


def neighbour_sql(k: int, weighted: bool) -> str:
    gap = " + ".join(f"(x.{f} - t.{f}) * (x.{f} - t.{f})" for f in FS)
    weight = ("CASE WHEN closest = 0 THEN CAST(g = 0 AS DOUBLE) ELSE 1 / sqrt(g) END" if weighted
              else "CAST(1 AS DOUBLE)")
    return f""", near AS (SELECT x.id, t.label, {gap} AS g, row_number() OVER (PARTITION BY x.id
  ORDER BY {gap}, t.id) AS rn FROM d x JOIN d t ON x.label IS NULL AND t.label IS NOT NULL),
w AS (SELECT *, min(g) OVER (PARTITION BY id) AS closest FROM near WHERE rn <= {k}),
v AS (SELECT id, label, {weight} AS w FROM w)
SELECT id, CAST(sum(w * label) / sum(w) > 0.5 AS INTEGER) AS prediction, round(sum(w * label) / sum(w), 6) AS p1
  FROM v GROUP BY id"""


@query("model_knn", D + neighbour_sql(5, False))
def model_knn(spark, sf):
    return fitted(spark, sf, neighbours.NearestNeighbours(5), probability=True)


@query("model_knn_distance", D + neighbour_sql(7, True))
def model_knn_distance(spark, sf):
    return fitted(spark, sf, zoo.neighbours_model(), probability=True)


@query("model_decision_tree")
def model_decision_tree(spark, sf):
    return fitted(spark, sf, trees.decision_tree())


@query("model_random_forest")
def model_random_forest(spark, sf):
    return fitted(spark, sf, zoo.random_forest())


@query("model_extra_trees")
def model_extra_trees(spark, sf):
    return fitted(spark, sf, zoo.extra_trees())


@query("model_bagging")
def model_bagging(spark, sf):
    return fitted(spark, sf, zoo.bagging())


@query("model_adaboost")
def model_adaboost(spark, sf):
    return fitted(spark, sf, zoo.adaboost())


@query("model_gradient_boosting")
def model_gradient_boosting(spark, sf):
    return fitted(spark, sf, zoo.gradient_boosting())


@query("model_boosted_stacker")
def model_boosted_stacker(spark, sf):
    return fitted(spark, sf, zoo.stacker())


@query("model_logistic")
def model_logistic(spark, sf):
    return fitted(spark, sf, zoo.logistic())


@query("model_logistic_cv")
def model_logistic_cv(spark, sf):
    return fitted(spark, sf, linear.LogisticCV())


@query("model_linear_svc")
def model_linear_svc(spark, sf):
    return fitted(spark, sf, linear.hinge_svc())


@query("model_poly_svc")
def model_poly_svc(spark, sf):
    return fitted(spark, sf, zoo.polynomial_svc())


@query("model_sgd_linear")
def model_sgd_linear(spark, sf):
    return fitted(spark, sf, linear.SubgradientLinear("hinge"))


@query("model_perceptron")
def model_perceptron(spark, sf):
    return fitted(spark, sf, linear.SubgradientLinear("perceptron"))


@query("model_passive_aggressive")
def model_passive_aggressive(spark, sf):
    return fitted(spark, sf, linear.PassiveAggressive())


@query("model_ridge")
def model_ridge(spark, sf):
    return fitted(spark, sf, closed_form.RidgeClassifier())


@query("model_lda")
def model_lda(spark, sf):
    return fitted(spark, sf, closed_form.LinearDiscriminant(), probability=True)


@query("model_qda")
def model_qda(spark, sf):
    return fitted(spark, sf, closed_form.QuadraticDiscriminant(), probability=True)


@query("model_fit_score", D + ALL_LABELLED + ", " + gaussian_sql("d", "t", "true") + """
SELECT d.id, prediction, (SELECT round(avg(CAST(p.prediction = e.label AS INTEGER)), 6) FROM pr p JOIN d e USING (id)
  WHERE e.label IS NOT NULL) AS train_score FROM pr JOIN d USING (id) WHERE label IS NULL""")
def model_fit_score(spark, sf):
    """Fit and score one wrapped model; the score is attached to its predictions."""
    train, test = train_test(spark, sf)
    model, accuracy = Pinned("gaussian_nb", closed_form.GaussianNB).fit_score(train)
    return predict(model, test, "prediction").select(
        "id", F.col("prediction").cast("int").alias("prediction"), F.lit(round(accuracy, 6)).alias("train_score"))


_IMPORTANCES: dict[tuple, DataFrame] = {}


def _importances(spark, sf) -> DataFrame:
    """The table of one session's full models, made once for both queries that show it."""
    own = spark.sparkContext.applicationId, sf
    if own in _IMPORTANCES:
        return _IMPORTANCES[own]
    train, _ = train_test(spark, sf)
    builds = {"rf": zoo.random_forest(), "et": zoo.extra_trees(), "ada": zoo.adaboost(), "gb": zoo.gradient_boosting()}
    _IMPORTANCES[own] = inspect.importances(spark, {n: b.fit(train) for n, b in builds.items()}, FEATURES)
    return _IMPORTANCES[own]


@query("model_feature_importance")
def model_feature_importance(spark, sf):
    return _importances(spark, sf)


@query("sink_importances")
def sink_importances(spark, sf):
    from tablesmith.sources import files
    from workloads.io_queries import _fresh
    found = _importances(spark, sf)
    path = _fresh(spark)
    files.write_csv(found, path)
    return files.read_csv(spark, path, found.schema)


@query("model_tree_table")
def model_tree_table(spark, sf):
    train, _ = train_test(spark, sf)
    return inspect.tree_table(trees.decision_tree().fit(train), spark, FEATURES)


