"""Histogram learners against plain numpy learners on the same rows and draws."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablesmith.functions.seeded import scramble
from tablesmith.models import ensemble, histogram, selection, trees
from tablesmith.models.base import Pinned, score
from tablesmith.operators.encode import assemble
from tablesmith.operators.splits import bootstrap_weight


@pytest.fixture(scope="module")
def data(spark):
    """Three overlapping features with ties, one of them useless, in several partitions."""
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 260)
    x = np.round(rng.normal(size=(260, 4)) + y[:, None] * np.array([1.2, 0.6, 0.0, 0.3]), 1)
    x[:, 3] = np.floor(x[:, 3])
    rows = [(1000 + 7 * i, float(y[i]), *map(float, x[i])) for i in range(260)]
    df = spark.createDataFrame(rows, "id long, y double, a double, b double, c double, d double").repartition(3)
    return assemble(df, ["a", "b", "c", "d"], "id", "y").persist(), np.array([r[0] for r in rows]), x, y.astype(float)


@pytest.fixture
def many_blocks(monkeypatch):
    monkeypatch.setattr(histogram, "BLOCK_ROWS", 40)
    monkeypatch.setattr(histogram, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(histogram, "SLICE_CELLS", 100)


def predicted(model, df, column="p1"):
    return model.transform(df).orderBy("id").toPandas()[column].to_numpy()


def cuts_of(x):
    return [np.unique(v)[:-1] + np.diff(np.unique(v)) / 2 for v in x.T]


def test_draws_equal_the_column_functions(spark):
    keys = np.array([0, 1, -5, 2 ** 40 + 3, -2 ** 62, 2 ** 63 - 1, 77])
    df = spark.createDataFrame([(i, int(k)) for i, k in enumerate(keys)], "i long, k long").orderBy("i")
    for seed in (0, 5, 2 ** 31 + 9):
        assert df.select(scramble(F.col("k"), seed).alias("s")).toPandas().s.tolist() == histogram.scrambled(keys, seed).tolist()
    assert df.select(bootstrap_weight(F.col("k"), 3).alias("s")).toPandas().s.tolist() == histogram.poisson_weights(keys, 3).tolist()


def plain_adaboost(x, y, rounds, rate=1.0):
    """SAMME of gini stumps, one exhaustive search a round: (feature, cut, left, right, alpha)."""
    w, out = np.ones(len(y)), []
    for _ in range(rounds):
        best = None
        for f, cuts in enumerate(cuts_of(x)):
            for c in cuts:
                left = x[:, f] <= c
                loss = 0.0
                for side in (left, ~left):
                    p = (w * y)[side].sum() / w[side].sum()
                    loss += w[side].sum() * 2 * p * (1 - p)
                loss = round(loss / w.sum(), 12)
                if best is None or loss < best[0]:
                    best = loss, f, c, left
        _, f, c, left = best
        answers = [float((w * y)[s].sum() > (w * (1 - y))[s].sum()) for s in (left, ~left)]
        wrong = np.where(left, *answers) != y
        error = (w * wrong).sum() / w.sum()
        if error >= 0.5 or error <= 1e-12:
            break
        alpha = rate * math.log((1 - error) / error)
        w = w * np.where(wrong, math.exp(alpha), 1.0) / w.sum()
        out.append((f, c, *answers, alpha))
    return out


@pytest.mark.parametrize("rounds,write_every", [(30, 7), (30, 100)])
def test_adaboost_equals_plain(data, many_blocks, rounds, write_every):
    df, _, x, y = data
    model = histogram.AdaBoost(rounds, write_every=write_every).fit(df)
    want = plain_adaboost(x, y, rounds)
    got = [(s.feature, t, s.left, s.right, s.alpha) for s, t in zip(model.stumps, model.thresholds)]
    assert [g[:4] for g in got] == [pytest.approx(w[:4]) for w in want]
    assert [g[4] for g in got] == pytest.approx([w[4] for w in want])
    assert sum(model.featureImportances) == pytest.approx(1.0)


def test_adaboost_equals_plain_on_documents(spark, sf):
    from workloads.model_queries import train_test
    train, _ = train_test(spark, sf)
    rows = train.orderBy("id").toPandas()
    x, y = np.stack([v.toArray() for v in rows.features]), rows.label.to_numpy()
    model = histogram.AdaBoost(60).fit(train)
    want = plain_adaboost(x, y, 60)
    assert [(s.feature, t) for s, t in zip(model.stumps, model.thresholds)] == [pytest.approx(w[:2]) for w in want]


def test_adaboost_degenerate_rows(spark):
    same = assemble(spark.createDataFrame([(i, float(i % 3 == 0), 1.0) for i in range(9)], "id long, y double, a double"),
                    ["a"], "id", "y")
    model = histogram.AdaBoost(5).fit(same)
    assert {r.prediction for r in model.transform(same).collect()} == {0.0}
    clear = assemble(spark.createDataFrame([(i, float(i > 4), float(i)) for i in range(9)], "id long, y double, a double"),
                     ["a"], "id", "y")
    model = histogram.AdaBoost(5).fit(clear)
    assert len(model.stumps) == 1 and score(model, clear) == 1.0


def plain_tree(x, y, w, features, min_leaf=1, depth=30):
    """Nested (feature, cut, left, right) or the share of class 1."""
    n = w.sum()
    share = (w * y).sum() / n
    if share in (0.0, 1.0) or depth == 0:
        return share
    best = None
    for f in features:
        values = np.unique(x[w > 0][:, f])
        for v in values[:-1]:
            left = x[:, f] <= v
            if w[left].sum() < min_leaf or w[~left].sum() < min_leaf:
                continue
            loss = 0.0
            for side in (left, ~left):
                p = (w * y)[side].sum() / w[side].sum()
                loss += w[side].sum() * 2 * p * (1 - p)
            gain = round(2 * share * (1 - share) - loss / n, 12)
            if best is None or gain > best[0]:
                best = gain, f, v, left
    if best is None:
        return share
    _, f, v, left = best
    return f, v, *[plain_tree(x[s], y[s], w[s], features, min_leaf, depth - 1) for s in (left, ~left)]


def answer(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


@pytest.mark.parametrize("options", [{"n_trees": 9, "feature_share": 0.5}, {"n_trees": 4, "max_depth": 3, "min_leaf": 6, "row_share": 0.5}])
def test_bagging_equals_single_trees(data, many_blocks, options):
    df, ids, x, y = data
    bags = histogram.Bagging(**options, seed=4)
    got = predicted(bags.fit(df), df)
    weights, features = bags.weights(ids), bags.features_of(4)
    single = [plain_tree(x, y, weights[:, b].astype(float), features[b], options.get("min_leaf", 1), options.get("max_depth", 60))
              for b in range(options["n_trees"])]
    assert got == pytest.approx([np.mean([answer(t, r) for t in single]) for r in x])


def test_bagging_jobs_grow_with_depth_not_with_trees(spark, data):
    df = data[0]
    made = []
    for n in (5, 60):
        before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
        histogram.Bagging(n, max_depth=4).fit(df)
        made.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - before)
    assert made[1] <= made[0] + 3


def test_extra_trees_draw_cuts_in_every_node(data, many_blocks):
    df, _, x, y = data
    model = histogram.ExtraTrees(30, max_depth=6, min_leaf=2, seed=1).fit(df)
    t = model.trees
    rows = {i: np.arange(len(x)) for i in range(30)}
    for node in range(len(t.feature)):
        mine = rows[node]
        assert t.counts[node].tolist() == [(y[mine] == 0).sum(), (y[mine] == 1).sum()]
        if t.feature[node] >= 0:
            values = x[mine, t.feature[node]]
            assert values.min() <= t.cut[node] < values.max()
            left = values <= t.cut[node]
            assert min(left.sum(), (~left).sum()) >= 2
            rows[t.left[node]], rows[t.left[node] + 1] = mine[left], mine[~left]
    inner = t.feature >= 0
    assert len(np.unique(t.cut[inner])) > 0.9 * inner.sum()   # no pool of cuts that nodes share
    assert predicted(model.prefix(7), df) == pytest.approx(predicted(histogram.ExtraTrees(7, max_depth=6, min_leaf=2, seed=1).fit(df), df))
    assert score(model, df) > 0.7


def plain_boosting(b, ids, x, y):
    """Margins after all rounds, one exhaustive search a node."""
    codes = np.stack([np.searchsorted(c, v) for c, v in zip(cuts_of(x), x.T)], 1)
    share = y.mean()
    margin = np.zeros(len(y)) if b.second_order else np.full(len(y), math.log(share / (1 - share)))
    l2 = b.l2 if b.second_order else 0.0
    for step in range(b.n_rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        drawn = histogram.uniforms(ids, b.seed + 7919 * step) < b.row_share
        used, add = b.columns_of(step, x.shape[1]), np.zeros(len(y))
        todo = [(np.ones(len(y), bool), 0)]
        while todo:
            mask, depth = todo.pop()
            inside = mask & drawn
            weight = h if b.second_order else np.ones(len(y))

            def part(m):
                return g[m].sum() ** 2 / (weight[m].sum() + l2)
            best = None
            for f in used if depth < b.max_depth else []:
                for c in np.unique(codes[inside, f])[:-1]:
                    left, right = inside & (codes[:, f] <= c), inside & (codes[:, f] > c)
                    if weight[left].sum() >= b.min_child and weight[right].sum() >= b.min_child:
                        gain = round((part(left) + part(right) - part(inside)) / 2, 10)
                        if best is None or gain > best[0]:
                            best = gain, f, c
            if best and best[0] > 0 and best[0] >= b.min_gain:
                todo += [(mask & (codes[:, best[1]] <= best[2]), depth + 1), (mask & (codes[:, best[1]] > best[2]), depth + 1)]
            else:
                add[mask] = b.rate * g[inside].sum() / max(h[inside].sum() + l2, 1e-12)
        margin += add
    return 1 / (1 + np.exp(-margin))


@pytest.mark.parametrize("build", [lambda: trees.gradient_boosting(6, 3), lambda: trees.boosted_stacker(8, 3, rate=0.3, min_gain=0.9),
                                   lambda: trees.boosted_stacker(5, 4, min_child=0.5, min_gain=0.0, row_share=1.0, column_share=0.5)])
def test_boosting_equals_plain(data, many_blocks, build):
    df, ids, x, y = data
    booster = build()
    booster.write_every = 3
    model = booster.fit(df)
    assert predicted(model, df) == pytest.approx(plain_boosting(booster, ids, x, y))
    assert predicted(model.prefix(3), df) == pytest.approx(
        plain_boosting(histogram.Boosting(**{**vars(booster), "n_rounds": 3}), ids, x, y))


def test_min_gain_and_depth_bind(data):
    df = data[0]
    greedy, strict = (trees.boosted_stacker(4, 4, min_gain=g).fit(df) for g in (0.0, 5.0))
    assert sum(len(t.feature) for t in strict.trees) < sum(len(t.feature) for t in greedy.trees)
    assert all(g == 0.0 or g >= 5.0 for t in strict.trees for g in t.gain)


@pytest.mark.parametrize("build", [lambda: trees.boosted_stacker(12, 3, min_gain=0.1), lambda: trees.gradient_boosting(5, 2),
                                   lambda: trees.AdaBoost(6)])
def test_collapsed_counts_give_the_same_model(spark, build, monkeypatch):
    rng = np.random.default_rng(8)
    votes = rng.integers(0, 2, (300, 3))
    label = (votes.sum(1) + rng.normal(size=300) > 1.5).astype(float)
    df = assemble(spark.createDataFrame([(i, float(label[i]), *map(float, votes[i])) for i in range(300)],
                                        "id long, y double, a double, b double, c double"), ["a", "b", "c"], "id", "y")
    subsets = [F.lit(True), F.col("id") % 3 != 1]
    counted = build().fit_many(df, subsets)
    monkeypatch.setattr(histogram, "COLLAPSED", 0)
    for a, b in zip(counted, build().fit_many(df, subsets)):
        assert predicted(a, df) == pytest.approx(predicted(b, df), abs=1e-9)


@pytest.mark.parametrize("build", [lambda: trees.AdaBoost(5), lambda: trees.Bagging(6, 0.5), lambda: trees.ExtraTrees(6, 4),
                                   lambda: trees.gradient_boosting(3, 2), lambda: trees.boosted_stacker(3, 2, min_gain=0.0)])
def test_subsets_share_passes_and_equal_single_fits(data, build):
    df = data[0]
    subsets = [F.col("id") % 5 != 0, F.col("id") % 2 == 0]
    shared = build().fit_many(df, subsets)
    for model, subset in zip(shared, subsets):
        own = df.where(subset)  # cuts lie between the values of all rows, so rows outside may fall on the other side
        assert predicted(model, own) == pytest.approx(predicted(build().fit(own), own))


def test_out_of_fold_and_draws_use_shared_fits(data):
    df = data[0]
    base = {"ada": Pinned("ada", trees.AdaBoost, n_rounds=3), "bag": Pinned("bag", trees.Bagging, n_trees=3)}
    train, test = ensemble.out_of_fold(base, df, df.drop("label"), k=3)
    assert train.count() == test.count() == 260 and {"ada", "bag"} <= set(train.columns)
    found = selection.cross_validate(base, df, selection.draws(df, n=3))
    assert [f["name"] for f in found] == ["ada", "bag"] and all(0.4 < f["test_mean"] <= 1 for f in found)


FORESTS = [lambda: trees.Bagging(6, 0.5), lambda: trees.Bagging(5, max_depth=3, min_leaf=4, row_share=0.7, criterion="entropy"),
           lambda: trees.random_forest(6), lambda: trees.ExtraTrees(6, 5), lambda: trees.ExtraTrees(4, None, 1, features=2)]


def shape(model, v=0):
    """Nodes of the trees of a forest as nested tuples, whatever their order."""
    t = model.trees

    def at(node):
        here = tuple(t.counts[node].tolist())
        if t.feature[node] < 0:
            return here
        return int(t.feature[node]), round(float(t.cut[node]), 9), here, at(t.left[node]), at(t.left[node] + 1)
    return [at(root) for root in range(t.n)]


@pytest.mark.parametrize("build", FORESTS)
def test_trees_grown_in_a_task_are_those_grown_by_jobs(data, build, monkeypatch):
    df = data[0]
    subsets = [F.lit(True), F.col("id") % 3 != 0, F.col("id") < 1200]
    whole = build().fit_many(df, subsets)
    monkeypatch.setattr(histogram, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(histogram, "BLOCK_ROWS", 40)
    for a, b in zip(whole, build().fit_many(df, subsets)):
        assert shape(a) == shape(b)
        assert a.featureImportances == pytest.approx(b.featureImportances)
        assert predicted(a, df) == pytest.approx(predicted(b, df))


@pytest.mark.parametrize("build", [lambda n: trees.Bagging(n, max_depth=2 * n), lambda n: trees.random_forest(n, 2 * n),
                                   lambda n: trees.ExtraTrees(n, n)])
def test_small_forests_take_as_many_jobs_at_any_depth(spark, data, build):
    made = []
    for n in (2, 12):
        before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
        build(n).fit(data[0])
        made.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - before)
    assert made[1] == made[0]


def test_forest_of_all_features_equals_single_trees(data):
    df, ids, x, y = data
    forest = trees.random_forest(7, features="all", seed=4)
    got = predicted(forest.fit(df), df)
    single = [plain_tree(x, y, forest.weights(ids)[:, b].astype(float), range(4)) for b in range(7)]
    assert got == pytest.approx([np.mean([answer(t, r) for t in single]) for r in x])


def test_forest_draws_features_in_every_node(data):
    df = data[0]
    assert [histogram.RandomForest(features=f).n_features(6) for f in ("sqrt", "log2", "onethird", "all", 4, 0.3, 9)] == [3, 3, 2, 6, 4, 2, 6]
    model = trees.random_forest(40, features=1, seed=2).fit(df)
    used = model.trees.feature[:40]
    assert set(used[used >= 0]) == {0, 1, 2, 3}     # one feature a root, another from tree to tree
    first = [int(f) for f in model.trees.feature if f >= 0]
    assert len(set(first)) == 4 and score(trees.random_forest(60).fit(df), df) > 0.9
    again = trees.random_forest(40, features=1, seed=2).fit(df.repartition(5))
    assert shape(model) == shape(again)             # draws follow the keys, not the partitions
