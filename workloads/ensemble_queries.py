"""Out-of-fold predictions, stacking, voting, comparison and search."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablesmith.functions.seeded import uniform
from tablesmith.models import closed_form, ensemble, selection, trees, zoo
from tablesmith.models.base import Pinned, predict
from tablesmith.operators import rules
from tablesmith.operators.encode import assemble
from tablesmith.operators.stats import correlations
from workloads.base import M, manifest, query, r6, rounded, scramble_sql, uniform_sql
from workloads.model_queries import D, FEATURES, bernoulli_sql, gaussian_sql, train_test


FOLDS = D + """, f AS (SELECT *, ntile(5) OVER (ORDER BY id) - 1 AS fold FROM d
  WHERE label IS NOT NULL), t AS (SELECT f.*, k.g FROM f JOIN range(5) AS k(g) ON f.fold <> k.g),
x AS (SELECT * FROM f UNION ALL BY NAME SELECT * FROM d WHERE label IS NULL), """
OWN_FOLD = "(x.fold IS NULL OR x.fold = st.g)"


@query("ens_oof_predictions", FOLDS + gaussian_sql("x", "t", OWN_FOLD) + """
SELECT id, CASE WHEN any_value(fold) IS NULL THEN 'test' ELSE 'train' END AS part,
  round(avg(prediction), 6) AS prediction FROM pr JOIN x USING (id) GROUP BY id""")
def ens_oof_predictions(spark, sf):
    train, test = train_test(spark, sf)
    oof_train, oof_test = ensemble.out_of_fold({"nb": closed_form.GaussianNB()}, train, test)
    return (oof_train.select("id", F.lit("train").alias("part"), r6("nb").alias("prediction"))
            .unionByName(oof_test.select("id", F.lit("test").alias("part"), r6("nb").alias("prediction"))))


# Out-of-fold columns of the first layer, kept for the queries that start from them.
_OUT_OF_FOLD: dict[tuple, tuple] = {}


def _first_layer(spark, sf, fifth="svc"):
    """(train rows, out-of-fold train, out-of-fold test) of the five base models at published size.

    The tables lie in the shared folder; a session computes the four common models once, and every
    stack reads them.
    """
    models = zoo.first_layer(fifth)
    *common, last = models
    found = []
    for names in (common, [last]):
        own = spark.sparkContext.applicationId, sf, *names
        if own not in _OUT_OF_FOLD:
            train, test = train_test(spark, sf)
            _OUT_OF_FOLD[own] = train, *ensemble.out_of_fold({n: models[n] for n in names}, train, test, k=5)
        found.append(_OUT_OF_FOLD[own])
    (train, *four), (_, *one) = found
    return train, *[a.join(b.select("id", last), "id") for a, b in zip(four, one)]


@query("ens_first_layer")
def ens_first_layer(spark, sf):
    """Train accuracy of each base model next to its out-of-fold accuracy."""
    models = zoo.first_layer()
    train, oof_train, _ = _first_layer(spark, sf)
    scores = ensemble.train_scores(models, train)
    hits = oof_train.agg(*[F.avg((F.col(n) == F.col("label")).cast("double")).alias(n) for n in models])
    known = F.create_map(*[F.lit(x) for n, s in scores.items() for x in (n, float(s))])
    return (hits.unpivot([], list(models), "model", "oof_accuracy")
            .withColumn("train_accuracy", known[F.col("model")]))


@query("ens_stack_features", FOLDS + gaussian_sql("x", "t", OWN_FOLD) + ", " + bernoulli_sql("x", "t", OWN_FOLD) + """,
a AS (SELECT id, round(avg(prediction), 6) AS nb FROM pr GROUP BY id),
b AS (SELECT id, round(avg(prediction), 6) AS bnb FROM prb GROUP BY id) SELECT id, nb, bnb FROM a JOIN b USING (id)""")
def ens_stack_features(spark, sf):
    """The next layer's input: one out-of-fold column per base model, train and test rows."""
    train, test = train_test(spark, sf)
    base = {"nb": closed_form.GaussianNB(), "bnb": closed_form.BernoulliNB()}
    oof_train, oof_test = ensemble.out_of_fold(base, train, test, k=5)
    return rounded(oof_train.select("id", *base).unionByName(oof_test.select("id", *base)), *base)


def _stacked(spark, sf, layers, final, fifth="svc"):
    """The given layers and final model on top of the first layer's columns."""
    _, train, test = _first_layer(spark, sf, fifth)
    names = list(zoo.first_layer(fifth))
    result, accuracy = ensemble.stack(layers, final, assemble(train, names, "id", "label"), assemble(test, names, "id"), k=5)
    return result.withColumn("train_accuracy", F.lit(round(accuracy, 6)))


@query("ens_stack_two_layers")
def ens_stack_two_layers(spark, sf):
    """Five base models, boosted stacker."""
    return _stacked(spark, sf, [], zoo.stacker())


@query("ens_stack_two_layers_tree")
def ens_stack_two_layers_tree(spark, sf):
    """The variant with logistic regression as fifth model and a tree on top."""
    return _stacked(spark, sf, [], zoo.decision_tree(), "logistic")


@query("ens_stack_three_layers")
def ens_stack_three_layers(spark, sf):
    return _stacked(spark, sf, [zoo.second_layer()], zoo.stacker())


def _votes(spark, sf):
    """Four fixed base models on the manifest, with labels and probabilities."""
    rows = manifest(spark, sf)
    return rows.select(
        "id", rules.gender_rule(F.col("sex")).alias("l1"), rules.coin_flip(F.col("id"), 3).alias("l2"),
        F.when(F.col("pclass") == 1, 1).otherwise(0).alias("l3"), F.when(F.col("fare") > 80, 1).otherwise(0).alias("l4"),
        uniform(F.col("id"), 1).alias("p1"), uniform(F.col("id"), 2).alias("p2"),
        F.when(F.col("sex") == "female", 0.75).otherwise(0.25).alias("p3"))


VOTES = M + f""", v AS (SELECT id, CAST(sex = 'female' AS INTEGER) AS l1, CAST({uniform_sql('id', 3)} > 0.5 AS INTEGER) AS l2,
  CAST(pclass = 1 AS INTEGER) AS l3, CASE WHEN fare > 80 THEN 1 ELSE 0 END AS l4, {uniform_sql('id', 1)} AS p1,
  {uniform_sql('id', 2)} AS p2, CASE WHEN sex = 'female' THEN 0.75 ELSE 0.25 END AS p3 FROM m)"""


LABELS = ["l1", "l2", "l3", "l4"]


def _vote_corr(a: str, b: str) -> str:
    value = "CAST(max(1) AS DOUBLE)" if a == b else f"round(corr({a}, {b}), 6)"
    return f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, {value} AS correlation FROM v"


@query("agg_prediction_corr", VOTES + " " + " UNION ALL ".join(_vote_corr(a, b) for a in LABELS for b in LABELS))
def agg_prediction_corr(spark, sf):
    return rounded(correlations(_votes(spark, sf), LABELS), "correlation")


@query("ens_vote_hard", VOTES + " SELECT id, CAST(l1 + l2 + l3 + l4 > 2 AS INTEGER) AS vote FROM v")
def ens_vote_hard(spark, sf):
    return _votes(spark, sf).select("id", ensemble.hard_vote(["l1", "l2", "l3", "l4"]).alias("vote"))


@query("ens_vote_soft", VOTES + " SELECT id, CAST((p1 + p2 + p3) / 3 > 0.5 AS INTEGER) AS vote FROM v")
def ens_vote_soft(spark, sf):
    return _votes(spark, sf).select("id", ensemble.soft_vote(["p1", "p2", "p3"]).alias("vote"))


@query("ens_vote_mean_round", VOTES + """ SELECT id,
  CAST(round_even((l1 + l2 + l3 + l4) / CAST(4 AS DOUBLE), 0) AS INTEGER) AS vote FROM v""")
def ens_vote_mean_round(spark, sf):
    return _votes(spark, sf).select("id", ensemble.mean_vote(["l1", "l2", "l3", "l4"]).alias("vote"))


def _metrics(table):
    """Metric tables without the wall-clock column, which is never the same twice."""
    return table.drop("fit_seconds")


def draw_role_sql(draw: int) -> str:
    rank = f"row_number() OVER (ORDER BY {scramble_sql('id', draw)}, id)"
    n_test, n_train = "ceil(0.3 * count(*) OVER ())", "floor(0.6 * count(*) OVER ())"
    return (f"SELECT *, {draw} AS g, CASE WHEN {rank} <= {n_test} THEN 'test' WHEN {rank} <= {n_test} + {n_train} "
            "THEN 'train' ELSE 'unused' END AS role FROM d WHERE label IS NOT NULL")


@query("sel_cross_validate", D + ", y AS (" + " UNION ALL ".join(draw_role_sql(i) for i in range(10)) + "),"
       " t AS (SELECT * FROM y WHERE role = 'train'), x AS (SELECT * FROM y WHERE role <> 'unused'), "
       + gaussian_sql("x", "t", "x.g = st.g") + """,
a AS (SELECT x.g, role, avg(CAST(prediction = label AS INTEGER)) AS hit FROM pr JOIN x ON x.id = pr.id AND x.g = pr.g
  GROUP BY x.g, role)
SELECT 'nb' AS name, 'gaussian_nb()' AS parameters, round(avg(hit) FILTER (role = 'train'), 6) AS train_mean,
  round(avg(hit) FILTER (role = 'test'), 6) AS test_mean, round(3 * stddev_pop(hit) FILTER (role = 'test'), 6) AS test_3std,
  round(min(hit) FILTER (role = 'test'), 6) AS test_min FROM a""")
def sel_cross_validate(spark, sf):
    train, _ = train_test(spark, sf)
    candidates = {"nb": Pinned("gaussian_nb", closed_form.GaussianNB)}
    found = selection.cross_validate(candidates, train, selection.draws(train))
    return rounded(_metrics(selection.metric_table(train, found)), "train_mean", "test_mean", "test_3std", "test_min")


@query("sel_model_compare")
def sel_model_compare(spark, sf):
    """Closed-form and linear models plus a tree; the full list is in ``zoo.comparison_models``."""
    train, test = train_test(spark, sf)
    everyone = zoo.comparison_models(n_trees=5, n_rounds=2)
    some = {n: everyone[n] for n in ("BernoulliNB", "GaussianNB", "LinearDiscriminant", "QuadraticDiscriminant",
                                     "RidgeCV", "DecisionTree", "ExtraTrees")}
    found, _, _ = selection.compare(some, train, test, selection.draws(train, n=2))
    return _metrics(found)


TREE = Pinned("decision_tree", trees.decision_tree)


@query("sel_grid_search")
def sel_grid_search(spark, sf):
    train, _ = train_test(spark, sf)
    grid = selection.grid(criterion=zoo.CRITERIA, max_depth=zoo.DEPTHS)
    best, found = selection.grid_search(TREE, grid, train, selection.draws(train))
    return _metrics(selection.metric_table(train, found)).withColumn("best", F.col("parameters") == repr(best))


@query("sel_nested_cv")
def sel_nested_cv(spark, sf):
    train, _ = train_test(spark, sf)
    search = selection.Tuned(TREE, selection.grid(max_depth=[2, 4]), n_draws=2)
    found = selection.cross_validate({"tuned_tree": search}, train, selection.draws(train, n=2))
    return _metrics(selection.metric_table(train, found))


def _tuned(spark, sf, train):
    """One short grid per voting model; the best parameters are written back."""
    everyone = zoo.comparison_models(n_trees=5, n_rounds=2)
    grids = {"ExtraTrees": selection.grid(max_depth=[2, 4]), "BernoulliNB": selection.grid(alpha=zoo.RATIOS[2:4]),
             "GaussianNB": [{}], "DecisionTree": selection.grid(criterion=zoo.CRITERIA, max_depth=[2])}
    roles = selection.draws(train, n=2)
    return {n: selection.grid_search(everyone[n], g, train, roles) for n, g in grids.items()}


@query("sel_grid_per_model")
def sel_grid_per_model(spark, sf):
    train, _ = train_test(spark, sf)
    rows = [(n, repr(best), max(s["test_mean"] for s in found)) for n, (best, found) in
            _tuned(spark, sf, train).items()]
    return spark.createDataFrame(rows, "model string, best string, test_auc double")


@query("sel_tuned_voting")
def sel_tuned_voting(spark, sf):
    train, test = train_test(spark, sf)
    best = {n: b for n, (b, _) in _tuned(spark, sf, train).items()}
    out = test
    for mode in ("hard", "soft"):
        out = predict(ensemble.Voting(best, mode).fit(train), out, mode)
    return out.select("id", F.col("hard").cast("int").alias("hard"), F.col("soft").cast("int").alias("soft"))


@query("sel_rfe_cv")
def sel_rfe_cv(spark, sf):
    train, _ = train_test(spark, sf)
    kept, means = selection.eliminate_features(trees.decision_tree(max_depth=4), train, selection.draws(train))
    rows = [(n, float(m), n == len(kept)) for n, m in means.items()]
    names = ",".join(FEATURES[i] for i in kept)
    return (spark.createDataFrame(rows, "n_features int, test_mean double, chosen boolean")
            .withColumn("features", F.when(F.col("chosen"), names)))


