"""Models against brute force and sanity bounds; ensembles against hand-worked cases."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tablesmith.models import closed_form, ensemble, inspect, linear, neighbours, selection, trees, zoo
from tablesmith.models.base import Pinned, predict, score
from tablesmith.operators.encode import assemble
from tablesmith.session import durable


@pytest.fixture(scope="module")
def data(spark):
    """Two overlapping clusters, with repeated and tied vectors."""
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 240)
    x = np.round(rng.normal(size=(240, 3)) + y[:, None] * np.array([1.5, 0.5, 0.0]), 1)
    x[:40] = x[0]
    rows = [(i, float(y[i]), *map(float, x[i])) for i in range(240)]
    df = spark.createDataFrame(rows, "id long, y double, a double, b double, c double")
    return assemble(df, ["a", "b", "c"], "id", "y").persist(), x, y


def brute_knn(x, y, queries, k, weighted=False):
    out = []
    for q in queries:
        d = np.zeros(len(x))
        for j in range(x.shape[1]):
            d = d + (q[j] - x[:, j]) ** 2
        near = np.lexsort((np.arange(len(x)), d))[:k]
        w = np.ones(k)
        if weighted:
            w = (d[near] == 0).astype(float) if (d[near] == 0).any() else 1 / np.sqrt(d[near])
        out.append((w * y[near]).sum() / w.sum())
    return np.array(out)


@pytest.mark.parametrize("weights,limit", [("uniform", 500), ("uniform", 2), ("distance", 8), ("distance", 2)])
def test_neighbours_match_brute_force(spark, data, weights, limit):
    df, x, y = data
    queries = np.vstack([x[:60], [[50.0, 0.0, 0.0], [-9.0, -9.0, 3.0], [0.05, 0.05, 0.05]]])
    q = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(
        spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(queries)], "id long, a double, b double, c double"))
    model = neighbours.NearestNeighbours(5, weights, cell_limit=limit).fit(df)
    got = model.transform(q).orderBy("id").toPandas().p1.to_numpy()
    assert got == pytest.approx(brute_knn(x, y, queries, 5, weights == "distance"))


def test_gaussian_nb_matches_numpy(data):
    df, x, y = data
    got = closed_form.GaussianNB().fit(df).transform(df).orderBy("id").toPandas()
    pad = 1e-9 * x.var(axis=0).max()
    logs = []
    for c in (0, 1):
        part = x[y == c]
        v = part.var(axis=0) + pad
        logs.append(np.log(len(part) / len(x)) + (-0.5 * np.log(2 * np.pi * v) - (x - part.mean(axis=0)) ** 2 / (2 * v)).sum(axis=1))
    assert got.p1.to_numpy() == pytest.approx(1 / (1 + np.exp(logs[0] - logs[1])))
    assert (got.prediction == (logs[1] > logs[0])).all()


def test_ridge_picks_penalty_by_leave_one_out(data):
    df, x, y = data
    model = closed_form.RidgeClassifier((0.1, 1.0, 10.0)).fit(df)
    target, losses = np.where(y == 1, 1.0, -1.0), []
    for alpha in (0.1, 1.0, 10.0):
        xc, yc = x - x.mean(axis=0), target - target.mean()
        inverse = np.linalg.inv(xc.T @ xc + alpha * np.eye(3))
        leverage = np.einsum("ij,jk,ik->i", xc, inverse, xc) + 1 / len(x)
        losses.append((((yc - xc @ (inverse @ xc.T @ yc)) / (1 - leverage)) ** 2).mean())
    assert model.alpha == (0.1, 1.0, 10.0)[int(np.argmin(losses))]


def test_discriminants_match_numpy(data):
    df, x, y = data
    means = [x[y == c].mean(axis=0) for c in (0, 1)]
    pooled = sum((x[y == c] - means[c]).T @ (x[y == c] - means[c]) for c in (0, 1)) / (len(x) - 2)
    w = np.linalg.solve(pooled, means[1] - means[0])
    odds = x @ w - 0.5 * (means[1] + means[0]) @ w + np.log((y == 1).sum() / (y == 0).sum())
    got = closed_form.LinearDiscriminant().fit(df).transform(df).orderBy("id").toPandas()
    assert got.p1.to_numpy() == pytest.approx(1 / (1 + np.exp(-odds)), abs=1e-9)
    assert score(closed_form.QuadraticDiscriminant().fit(df), df) > 0.6


@pytest.mark.parametrize("estimator", [
    linear.Logistic, lambda: linear.SubgradientLinear("hinge"), lambda: linear.SubgradientLinear("perceptron", epochs=10),
    lambda: linear.PassiveAggressive(epochs=3), linear.hinge_svc, lambda: linear.polynomial_svc(degree=2, max_iter=5),
    closed_form.BernoulliNB, lambda: trees.ExtraTrees(n_trees=10), lambda: trees.AdaBoost(n_rounds=4, write_every=2),
    lambda: trees.Bagging(n_trees=3, max_depth=4), lambda: trees.random_forest(5, 5), lambda: trees.decision_tree(max_depth=4),
    lambda: trees.gradient_boosting(3, 3), lambda: linear.LogisticCV((0.1, 1.0), k=2, max_iter=5)])
def test_models_beat_the_majority_share(data, estimator):
    df, _, y = data
    assert score(estimator().fit(df), df) >= max(y.mean(), 1 - y.mean()) - 0.02


def test_bernoulli_counts(spark):
    df = assemble(spark.createDataFrame([(0, 0.0, 0.0), (1, 0.0, 0.0), (2, 1.0, 2.0), (3, 1.0, 0.0)], "id long, y double, a double"),
                  ["a"], "id", "y")
    got = closed_form.BernoulliNB().fit(df).transform(df).orderBy("id").toPandas()
    # class 0: P(a>0) = 1/4, class 1: P(a>0) = 2/4
    assert got.p1.to_numpy() == pytest.approx([2 / 5, 2 / 5, 2 / 3, 2 / 5])


def test_votes(spark):
    df = spark.createDataFrame([(1, 0, 1, 0), (1, 1, 1, 0), (0, 0, 0, 1)], "a int, b int, c int, d int")
    names = ["a", "b", "c", "d"]
    got = df.select(ensemble.hard_vote(names), ensemble.mean_vote(names)).collect()
    assert [tuple(r) for r in got] == [(0, 0), (1, 1), (0, 0)]
    soft = spark.createDataFrame([(0.9, 0.2, None), (0.5, 0.5, None), (0.6, 0.1, 0.9)], "a double, b double, c double")
    assert [r[0] for r in soft.select(ensemble.soft_vote(["a", "b", "c"])).collect()] == [1, 0, 1]


def test_out_of_fold_uses_only_other_folds(spark, data):
    df, x, y = data
    class Mean:
        """Predicts the share of positives it saw, so leaks show up as numbers."""
        def fit(self, rows):
            self.value = rows.agg(F.avg("label")).first()[0]
            value = self.value
            class Model:
                def transform(self, rows):
                    return rows.withColumn("prediction", F.lit(value))
            return Model()
    train, test = ensemble.out_of_fold({"m": Mean()}, df, df.drop("label"), k=5)
    got = train.orderBy("id").toPandas()
    for fold in range(5):
        outside = np.delete(y, np.arange(fold * 48, fold * 48 + 48))
        assert got[got.fold == fold].m.to_numpy() == pytest.approx(outside.mean())
    shares = [np.delete(y, np.arange(f * 48, f * 48 + 48)).mean() for f in range(5)]
    assert test.first().m == pytest.approx(np.mean(shares))


def test_stack_two_layers(data):
    df, _, y = data
    layer = {"nb": closed_form.GaussianNB(), "lda": closed_form.LinearDiscriminant()}
    result, accuracy = ensemble.stack([layer, layer], trees.decision_tree(max_depth=3), df, df.drop("label"), k=2)
    assert result.count() == 240 and result.select("prediction").distinct().count() <= 2
    assert accuracy >= max(y.mean(), 1 - y.mean())


def test_selection(data):
    df, _, _ = data
    roles = selection.draws(df, n=2)
    tree = Pinned("tree", trees.decision_tree)
    best, found = selection.grid_search(tree, selection.grid(max_depth=[1, 3]), df, roles)
    assert best.params["max_depth"] in (1, 3) and len(found) == 2
    assert all(0.5 <= s["test_mean"] <= 1 and s["test_3std"] >= 0 for s in found)
    table, on_train, on_test = selection.compare({"nb": closed_form.GaussianNB(), "tree": tree.with_params(max_depth=2)},
                                                 df, df.drop("label"), roles)
    assert table.count() == 2 and {"nb", "tree"} <= set(on_test.columns) and on_train.count() == 240
    kept, means = selection.eliminate_features(trees.decision_tree(max_depth=2), df, roles)
    assert set(means) == {1, 2, 3} and 0 in kept


def test_voting_estimator_skips_models_without_probability(data):
    df, _, _ = data
    model = ensemble.Voting({"nb": closed_form.GaussianNB(), "ridge": closed_form.RidgeClassifier()}, "soft").fit(df)
    soft = model.transform(df).orderBy("id").toPandas()
    alone = predict(closed_form.GaussianNB().fit(df), df, "l", "p").orderBy("id").toPandas()
    assert soft.p1.to_numpy() == pytest.approx(alone.p.to_numpy())


def test_tree_table_counts_add_up(spark, data):
    df, _, y = data
    nodes = inspect.tree_table(trees.decision_tree(max_depth=3).fit(df), spark, ["a", "b", "c"]).toPandas()
    root = nodes[nodes.parent.isna()].iloc[0]
    assert (root.n_class_0, root.n_class_1) == ((y == 0).sum(), (y == 1).sum())
    for _, node in nodes[nodes.feature.notna()].iterrows():
        assert nodes[nodes.parent == node.id].n_rows.sum() == node.n_rows
    assert len(nodes) == nodes.parent.notna().sum() + 1


def test_importances_have_a_mean_row(spark, data):
    df, _, _ = data
    got = inspect.importances(spark, {"tree": trees.decision_tree(max_depth=3).fit(df),
                                      "ada": trees.AdaBoost(n_rounds=2).fit(df)}, ["a", "b", "c"]).toPandas().set_index("model")
    assert got.loc["mean"].to_numpy() == pytest.approx(got.loc[["tree", "ada"]].mean().to_numpy())
    assert got.loc["tree"].sum() == pytest.approx(1.0)


def test_zoo_defaults_are_the_published_ones():
    first = zoo.first_layer()
    assert list(first) == ["et", "rf", "ada", "gb", "svc"]
    assert first["rf"].params["n_trees"] == 500 and first["gb"].params["max_depth"] == 5
    assert "lg" in zoo.first_layer("logistic") and "bg" in zoo.second_layer()
    assert len(zoo.search_grids()["DecisionTree"]) == 12


def test_online_models_do_not_depend_on_partitions(spark):
    """The same rows in any layout give the same weights."""
    import numpy as np
    rng = np.random.default_rng(1)
    from pyspark.ml.linalg import Vectors
    rows = [(i, Vectors.dense(x), float(x[0] - x[1] > 0.2)) for i, x in enumerate(rng.normal(size=(300, 3)))]
    df = spark.createDataFrame(rows, ["id", "features", "label"])
    for build in (linear.PassiveAggressive, linear.SubgradientLinear):
        one, many = build().fit(df.coalesce(1)), build().fit(df.repartition(7))
        assert np.allclose(one.weights, many.weights) and one.transform(df).where("prediction = label").count() > 270


def test_wide_moments_equal_narrow_ones(spark, monkeypatch):
    import numpy as np
    from pyspark.ml.linalg import Vectors
    rng = np.random.default_rng(2)
    rows = [(i, Vectors.dense([*x, 1.0]), float(i % 3 == 0)) for i, x in enumerate(rng.normal(size=(200, 4)))]
    df = spark.createDataFrame(rows, ["id", "features", "label"])
    narrow = closed_form._moments(df)
    monkeypatch.setattr(closed_form, "MAX_WIDTH", 2)
    wide = closed_form._moments(df)
    assert all(narrow[k][0] == wide[k][0] and np.allclose(narrow[k][1], wide[k][1]) and np.allclose(narrow[k][2], wide[k][2])
               for k in narrow)


def test_curves_use_margins(spark):
    from pyspark.ml.linalg import Vectors
    from tablesmith.models import base
    df = spark.createDataFrame([(i, Vectors.dense([float(i), 1.0]), float(i > 6)) for i in range(20)], ["id", "features", "label"])
    for build in (linear.HingeSvc(), closed_form.RidgeClassifier()):
        ranks = base.predict(build.fit(df), df, "p", ranking="r").select("r").distinct().count()
        assert ranks > 10


def test_polynomial_svc_passes_over_a_small_table_are_one_task(spark, monkeypatch):
    rows = [(i, float(i % 7 > 2), float(i % 7), float(i % 5)) for i in range(160)]
    df = assemble(durable(spark.createDataFrame(rows, "id long, y double, a double, b double").repartition(8)), ["a", "b"], "id", "y")
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    model = linear.polynomial_svc(2, 1.0, 20).fit(df)
    jobs = [tracker.getJobInfo(j) for j in set(tracker.getJobIdsForGroup(None)) - before]
    wide = [j for j in jobs if j and any((s := tracker.getStageInfo(i)) and s.numTasks > 1 for i in j.stageIds)]
    assert len(jobs) > 10 and len(wide) <= 3      # the count alone reads all partitions
    assert score(model, df) == 1.0
    monkeypatch.setattr(linear, "PARTITION_BYTES", 160 * 5 * 8 // 4)
    assert linear.in_few_parts(df, 160, 5).rdd.getNumPartitions() == 4
    assert linear.in_few_parts(df, 10 ** 6, 5).rdd.getNumPartitions() == 8
