"""Operators on hand-made frames, distributed forms against plain Python."""

import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablesmith.operators import (binning, encode, impute, metrics, ordering, profile, relational, rules, splits,
                                  stats)
from tablesmith.plans import recipes

GROUPS = [(1, 1, None), (1, 1, None), (1, 2, 3.0), (1, 2, 5.0), (1, 2, None), (2, 1, 7.0), (None, 1, None), (None, 1, 9.0)]


def groups(spark):
    return spark.createDataFrame([(i, *g) for i, g in enumerate(GROUPS)], "id long, a int, b int, x double")


def skewed(spark, n=4000):
    """One group holds most rows, one value of it a third of them."""
    return spark.range(n).select(
        "id", F.when(F.col("id") % 10 < 7, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 37).cast("string"))).alias("g"),
        F.when(F.col("id") % 3 == 0, 5.0).otherwise((F.col("id") * 7919 % 1009) / 4.0).alias("x"))


@pytest.mark.parametrize("limit", [ordering.DISTINCT_LIMIT, 0])
def test_quantiles_both_forms_are_exact(spark, limit):
    df = skewed(spark)
    data = df.toPandas()
    got = ordering.quantiles(df, ["g"], {"q1": ("x", .25), "q2": ("x", .5), "q9": ("x", .9), "i": ("id", .5)},
                             distinct_limit=limit).toPandas().set_index("g")
    for g, part in data.groupby("g"):
        for name, q in (("q1", .25), ("q2", .5), ("q9", .9)):
            assert got.loc[g, name] == pytest.approx(np.quantile(part.x, q))
        assert got.loc[g, "i"] == pytest.approx(np.median(part.id))
    whole = ordering.quantiles(df, [], {"m": ("x", .5), "e": ("x", 1.0), "i": ("id", .25)}, distinct_limit=limit).first()
    assert tuple(whole) == pytest.approx((np.median(data.x), data.x.max(), np.quantile(data.id, .25)))


def test_quantiles_ignore_nulls_and_null_keys(spark):
    for limit in (ordering.DISTINCT_LIMIT, 0):
        got = {(r.a, r.b): r.m for r in
               ordering.medians(groups(spark), ["a", "b"], {"m": "x"}, distinct_limit=limit).collect()}
        assert got[(1, 2)] == 4.0 and got[(2, 1)] == 7.0 and (None, 1) not in got
        assert got.get((1, 1)) is None


def test_cumulative_matches_sorted_sum(spark):
    df = skewed(spark).groupBy("g", "x").agg(F.count(F.lit(1)).alias("n"))
    got = ordering.cumulative(df, ["g"], ["x"], "n").toPandas().sort_values(["g", "x"])
    for _, part in got.groupby("g"):
        assert list(part.before) == [0, *np.cumsum(part.n)[:-1]]
        assert set(part.total) == {part.n.sum()}


def test_modes_take_smallest_on_ties(spark):
    df = spark.createDataFrame([("t", "b"), ("t", "a"), ("t", "b"), ("t", "a"), ("u", None), ("u", "z")], "s string, v string")
    assert {r.s: r.m for r in ordering.modes(df, ["s"], "v", "m").collect()} == {"t": "a", "u": "z"}
    assert ordering.modes(df, [], "v", "m").first().m == "a"


@pytest.mark.parametrize("limit", [relational.BROADCAST_BYTES, 0])
def test_attach_small_and_hot_cold_forms_agree(spark, limit):
    df = skewed(spark).withColumn("g", F.when(F.col("id") % 11 == 0, None).otherwise(F.col("g")))
    sizes = relational.group_sizes(df, ["g"], "_size").withColumn("n", F.col("_size"))
    got = relational.attach(df, sizes, ["g"], "_size", ["id"], broadcast_bytes=limit).toPandas()
    expected = got.groupby("g").id.transform("count")
    assert len(got) == 4000
    assert got.n.isna().sum() == got.g.isna().sum()
    known = got.g.notna()
    assert (got.n[known] == expected[known]).all()


def test_hot_groups_leave_the_shuffle_key(spark):
    df = skewed(spark)
    sizes = relational.group_sizes(df, ["g"], "_size").withColumn("n", F.col("_size"))
    plan = relational.attach(df, sizes, ["g"], "_size", ["id"], broadcast_bytes=0)._jdf.queryExecution().toString()
    assert "_spread" in plan and "xxhash64" in plan


def test_group_median_fill(spark):
    filled = {r.id: r.x for r in impute.fill_group_median(groups(spark), "x", ["a", "b"], "id").collect()}
    # a group without any value stays null, and so does a row whose key is null
    assert filled == {0: None, 1: None, 2: 3.0, 3: 5.0, 4: 4.0, 5: 7.0, 6: None, 7: 9.0}


def test_assert_no_nulls_names_columns(spark):
    with pytest.raises(ValueError, match="x=4"):
        profile.assert_no_nulls(groups(spark), ["id", "x"])
    assert profile.assert_no_nulls(groups(spark), ["id", "b"]) is not None


def codes(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


def test_fixed_bands_are_right_closed(spark):
    edges = recipes.AGE_EDGES_FINE
    assert codes(spark, [5.0, 5.001, 25.0, 65.0, 65.001, None, -1.0], lambda x: binning.band(x, edges)) == [
        0, 1, 1, 5, 6, None, 0]
    got = codes(spark, [7.91, 7.911, 31.0, 31.1], lambda x: binning.band(x, recipes.FARE_EDGES))
    assert got == [0, 1, 2, 3]
    spans = codes(spark, [5.0, 5.1, 80.0], lambda x: binning.interval(x, [0, 5, 10, 80]))
    assert [(s.lo, s.hi) for s in spans] == [(0.0, 5.0), (5.0, 10.0), (10.0, 80.0)]


def test_in_place_band_writes_equal_one_chain(spark):
    """Codes at or below the first edge can never be picked up again by a later rule."""
    for edges in (recipes.AGE_EDGES, recipes.FARE_EDGES, recipes.FARE_EDGES_WIDE):
        assert len(edges) <= edges[0]
    assert len(recipes.AGE_EDGES_FINE) - 1 <= recipes.AGE_EDGES_FINE[0]


def test_equal_width_edges():
    assert binning.width_edges(0, 10, 5) == [-0.01, 2.0, 4.0, 6.0, 8.0, 10.0]
    low, *_, high = binning.width_edges(4, 4, 2)
    assert low == pytest.approx(3.996) and high == pytest.approx(4.004)
    assert binning.width_edges(0, 0, 2)[0] == -0.001


def test_quantile_bins(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 1.0, 2.0, 5.0, 10.0, None)], "x double")
    fitted = binning.learn_quantile(df, "x", 4, "union")
    assert fitted[None]["edges"] == [0, 1, 2, 5, 10]
    got = df.select("x", binning.apply_edges("x", fitted).alias("b")).collect()
    assert {r.x: r.b for r in got} == {0: 0, 1: 0, 2: 1, 5: 2, 10: 3, None: None}
    tied = spark.createDataFrame([(1.0,)] * 9 + [(2.0,)], "x double")
    with pytest.raises(ValueError, match="not unique"):
        binning.learn_quantile(tied, "x", 4, "union")


@pytest.mark.parametrize("limit", [encode.LITERAL_LEVELS, 0])
def test_label_codes_per_split(spark, limit):
    df = spark.createDataFrame([(1, "train", "b"), (2, "train", "a"), (3, "test", "b"), (4, "train", None), (5, "train", "c")],
                               "id long, split string, v string")
    got = {r.id: r.c for r in encode.label_codes(df, {"v": "c"}, "id", literal_limit=limit).collect()}
    assert got == {1: 1, 2: 0, 3: 0, 4: None, 5: 2}


def test_dummies_same_columns_for_every_split(spark):
    df = spark.createDataFrame([("train", "a", 1), ("train", None, 2), ("test", "c", 3)], "split string, v string, n int")
    got = encode.dummies(df, ["v"])
    assert got.columns == ["split", "n", "v_a", "v_c"]
    assert [tuple(r)[2:] for r in got.orderBy("n").collect()] == [(1, 0), (0, 0), (0, 1)]
    assert encode.dummies(df, ["v"], numbered=True, keep=True).columns == ["split", "v", "n", "v_1", "v_2"]
    with pytest.raises(ValueError, match="levels"):
        encode.levels(df, ["v"], max_levels=1)


def test_one_hot_vectors_have_a_place_per_level(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None), (4, "c")], "id long, v string")
    got = encode.one_hot_vectors(df, ["v"], "id").orderBy("id").collect()
    assert [list(r.v_vector.toArray()) for r in got] == [[0, 1, 0], [1, 0, 0], [0, 0, 0], [0, 0, 1]]


def test_min_max_constant_becomes_zero(spark):
    df = spark.createDataFrame([(1.0, 4.0), (3.0, 4.0)], "a double, b double")
    assert [tuple(r) for r in encode.min_max(df, ["a", "b"]).orderBy("a").collect()] == [(0.0, 0.0), (1.0, 0.0)]


def test_fill_scopes(spark):
    df = spark.createDataFrame([(1, "train", 1.0), (2, "train", 3.0), (3, "test", 10.0), (4, "test", None), (5, "train", None)],
                               "id long, split string, x double")
    def at(scope):
        got = {r.id: r.x for r in impute.fill_median(df, ["x"], scope).collect()}
        return got[4], got[5]
    assert at("train") == (2.0, 2.0)
    assert at("per_split") == (10.0, 2.0)
    assert at("union") == (3.0, 3.0)


def test_random_fill_is_repeatable_and_in_band(spark):
    df = spark.range(500).select(F.col("id"), F.lit("train").alias("split"),
                                 F.when(F.col("id") % 2 == 0, (F.col("id") % 60).cast("double")).alias("x"))
    a = impute.fill_random_band(df, "x", "id").repartition(7).orderBy("id").toPandas().x
    b = impute.fill_random_band(df.repartition(3), "x", "id").orderBy("id").toPandas().x
    assert (a == b).all()
    known = a[::2]
    low, high = int(known.mean() - known.std()), int(known.mean() + known.std())
    assert a[1::2].between(low, high - 1).all()


def test_union_fills_missing_columns_in_order(spark):
    a = spark.createDataFrame([(1, "x")], "b int, z string")
    c = spark.createDataFrame([(2, 0.5)], "b int, a double")
    got = relational.union_sorted(a, c)
    assert got.columns == ["a", "b", "z"] and got.count() == 2
    train, test = relational.split_back(got.withColumn("split", F.lit("test")), "split", "a")
    assert train.count() == 0 and "a" not in test.columns


def test_fold_sizes(spark):
    got = splits.contiguous_fold(spark.range(1000, 1891), "id", 5)
    assert [r[1] for r in got.groupBy("fold").count().orderBy("fold").collect()] == [179, 178, 178, 178, 178]
    assert got.where("fold = 0").agg(F.max("id")).first()[0] == 1178


def test_shuffle_split_has_exact_sizes_and_independent_draws(spark):
    df = spark.range(891)
    got = splits.shuffle_split(df, "id", draws=3).toPandas()
    for i in range(3):
        assert got[f"draw_{i}"].value_counts().to_dict() == {"test": 268, "train": 534, "unused": 89}
    assert (got.draw_0 != got.draw_1).any()
    assert splits.holdout(df, "id").groupBy("part").count().orderBy("part").collect()[0][1] == 223


def test_boundaries_survive_a_missed_window(spark, monkeypatch):
    expected = splits._boundaries(spark.range(500), "id", [0], [150], 500)
    monkeypatch.setattr(splits.math, "sqrt", lambda x: -1.0)
    assert splits._boundaries(spark.range(500), "id", [0], [150], 500) == expected


def test_bootstrap_weights_look_poisson(spark):
    row = spark.range(20000).select(splits.bootstrap_weight(F.col("id"), 4).alias("w")).agg(
        F.avg("w"), F.var_samp("w"), F.avg((F.col("w") == 0).cast("int"))).first()
    assert row[0] == pytest.approx(1.0, abs=0.05) and row[1] == pytest.approx(1.0, abs=0.06)
    assert row[2] == pytest.approx(0.3679, abs=0.02)


def test_auc_with_ties_and_single_class(spark):
    df = spark.createDataFrame([(1, .9), (0, .9), (1, .5), (0, .1), (0, .5), (1, .7)], "y int, s double")
    positive, negative = [.9, .5, .7], [.9, .1, .5]
    expected = statistics.fmean((p > n) + 0.5 * (p == n) for p in positive for n in negative)
    assert metrics.roc_auc(df, "s", "y").first().auc == pytest.approx(expected)
    assert metrics.roc_auc(df.where("y = 1"), "s", "y").first().auc is None


def test_report_divides_by_zero_to_zero(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (1, 0)], "y int, p int")
    got = {r["class"]: r for r in metrics.classification_report(df, "p", "y").collect()}
    assert got["1"].precision == 0.0 and got["1"].recall == 0.0 and got["1"].f1 == 0.0
    assert got["0"].precision == pytest.approx(1 / 3) and got["accuracy"].f1 == pytest.approx(1 / 3)


def test_correlation_skips_null_pairs_and_constants(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, None, 5.0), (None, 1.0, 5.0)],
                               "a double, b double, c double")
    got = {(r.feature_1, r.feature_2): r.correlation for r in stats.correlations(df, ["a", "b", "c"]).collect()}
    assert got[("a", "b")] == pytest.approx(1.0) and got[("a", "c")] is None and got[("c", "c")] is None
    assert got[("a", "a")] == 1.0 and len(got) == 9


def test_unmatched_predictions_are_reported(spark):
    p = spark.createDataFrame([(1, 0), (2, 1)], "id long, pred int")
    s = spark.createDataFrame([(2, 1), (3, 0)], "id long, sol int")
    got = {r.id: r.status for r in relational.align_predictions(p, s, "id").collect()}
    assert got == {1: "no_solution", 2: "matched", 3: "no_prediction"}


# Passengers 892-901 of the test file and the rule tree's answers for them.
PASSENGERS = [
    (892, 3, "Kelly, Mr. James", "male", 7.8292, "Q", 0),
    (893, 3, "Wilkes, Mrs. James (Ellen Needs)", "female", 7.0, "S", 1),
    (894, 2, "Myles, Mr. Thomas Francis", "male", 9.6875, "Q", 0),
    (895, 3, "Wirz, Mr. Albert", "male", 8.6625, "S", 0),
    (896, 3, "Hirvonen, Mrs. Alexander (Helga E Lindqvist)", "female", 12.2875, "S", 0),
    (897, 3, "Svensson, Mr. Johan Cervin", "male", 9.225, "S", 0),
    (898, 3, "Connolly, Miss. Kate", "female", 7.6292, "Q", 1),
    (899, 2, "Caldwell, Mr. Albert Francis", "male", 29.0, "S", 0),
    (900, 3, "Abrahim, Mrs. Joseph (Sophie Halaut Easu)", "female", 7.2292, "C", 1),
    (901, 3, "Davies, Mr. John Samuel", "male", 24.15, "S", 0),
    (956, 1, "Ryerson, Master. John Borie", "male", 262.375, "C", 1),
]


def test_rule_tree_golden(spark):
    from tablesmith.functions.text import between
    df = spark.createDataFrame(PASSENGERS, "id long, c int, n string, s string, f double, p string, y int")
    got = df.select("y", rules.rule_tree(F.col("s"), F.col("c"), F.col("p"), F.col("f"),
                                         between(F.col("n"), ", ", ".")).alias("r")).collect()
    assert all(r.y == r.r for r in got)


def test_csv_keeps_doubled_quotes(spark, tmp_path):
    from tablesmith.sources import files
    path = tmp_path / "in.csv"
    path.write_text('PassengerId,Pclass,Name,Sex,Age,SibSp,Parch,Ticket,Fare,Cabin,Embarked\n'
                    '1,3,"O""Dwyer, Miss. Ellen ""Nellie""",female,,0,0,330959,7.8792,,Q\n')
    row = files.read_csv(spark, str(path), files.PASSENGER_SCHEMA).first()
    assert row.Name == 'O"Dwyer, Miss. Ellen "Nellie"' and row.Age is None and row.Cabin is None


def test_draws_are_independent(spark):
    """Ten 30 % test sets overlap like independent ones; bag weights do not vary together."""
    n = 20000
    got = splits.shuffle_split(spark.range(n), "id", draws=10).select(
        *[(F.col(f"draw_{i}") == "test").cast("int").alias(f"t{i}") for i in range(10)])
    pairs = [(i, j) for i in range(10) for j in range(i)]
    row = got.agg(*[F.sum(F.col(f"t{i}") * F.col(f"t{j}")) for i, j in pairs]).first()
    assert all(abs(x - 0.09 * n) < 5 * (0.3 * 0.7 * n ** 0.5) for x in row)
    bags = spark.range(n).select(*[splits.bootstrap_weight(F.col("id"), i).alias(f"b{i}") for i in range(5)])
    row = bags.agg(*[F.covar_pop(f"b{i}", f"b{j}") for i in range(5) for j in range(i)]).first()
    assert all(abs(x) < 5 / n ** 0.5 for x in row)


def test_draws_use_all_bits_of_the_key(spark):
    from tablesmith.functions.seeded import uniform
    keys = spark.range(2000).select(*[uniform(F.col("id") + F.lit(shift), 1).alias(f"u{i}")
                                      for i, shift in enumerate((0, 2 ** 31, 2 ** 62, -(2 ** 63)))])
    row = keys.agg(*[F.corr("u0", f"u{i}") for i in (1, 2, 3)]).first()
    assert all(abs(x) < 0.1 for x in row)


@pytest.mark.parametrize("kind, values", [
    ("int", [10, 2, 1, -5]), ("bigint", [2 ** 40, 3, -1]), ("float", [0.1, 10.5, 2.25, float("nan")]), ("double", [10.0, 2.0, -1.5]),
    ("decimal(10,2)", ["10.00", "2.00", "1.50"]), ("date", ["2024-01-10", "2024-01-02"]), ("boolean", [True, False]),
    ("timestamp", ["2024-01-10 00:00:00", "2024-01-02 10:00:00.5"]), ("string", ["b", "a", "é", "Z", ""])])
def test_codes_and_dummies_of_every_type(spark, kind, values):
    source = spark.createDataFrame([(i, str(v)) for i, v in enumerate(values)] + [(99, None)], "id long, v string")
    df = source.withColumn("v", F.col("v").cast(kind)).withColumn("other", F.col("id"))
    near = {r.id: r.c for r in encode.label_codes(df, {"v": "c"}, "id", by=()).collect()}
    far = {r.id: r.c for r in encode.label_codes(df, {"v": "c"}, "id", by=(), literal_limit=1).collect()}
    ranks = {r.id: r.k for r in df.where("v IS NOT NULL").selectExpr("id", "dense_rank() OVER (ORDER BY v) - 1 AS k").collect()}
    assert near == far == {**ranks, 99: None}
    flags = encode.dummies(df.select("id", "v"), ["v"], numbered=True).collect()
    assert all(sum(r[1:]) == (r.id != 99) and (r.id == 99 or r[1 + ranks[r.id]] == 1) for r in flags)


def test_one_wide_column_does_not_change_the_others(spark):
    df = spark.range(200).select("id", (F.col("id") % 3).cast("decimal(10,1)").alias("a"), F.col("id").cast("string").alias("b"))
    got = encode.label_codes(df, {"a": "ca", "b": "cb"}, "id", by=()).collect()
    assert all(r.ca == r.id % 3 for r in got) and {r.cb for r in got} == set(range(200))


def test_degenerate_statistics(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 1.0), ("b", 3.0)], "g string, x double")
    rows = stats.kernel_density(df, "g", "x", points=5).collect()
    assert all((r.density is None) == (r.g == "a") for r in rows) and len(rows) == 10
    assert stats.kernel_density(df.limit(0), "g", "x").count() == 0
    assert [r.null_fraction for r in profile.nulls(df.limit(0)).collect()] == [None, None]
    got = ordering.quantiles(spark.range(1000), [], {"m": ("id", 0.5)}, distinct_limit=10, size="n").first()
    assert (got.m, got.n) == (499.5, 1000)


def test_attach_salts_hot_groups_with_wide_values(spark):
    df = skewed(spark).withColumn("g", F.when(F.col("id") % 11 == 0, None).otherwise(F.col("g")))
    sizes = df.where("g IS NOT NULL").groupBy("g").agg(F.count(F.lit(1)).alias("_n")).withColumn(
        "wide", F.array_repeat(F.length("g"), 50)).withColumn("n", F.col("_n"))
    got = relational.attach(df, sizes, ["g"], "_n", ["id"], broadcast_bytes=0)
    want = df.toPandas().g.value_counts()
    rows = got.toPandas()
    assert got.columns == ["id", "g", "x", "wide", "n"] and len(rows) == 4000 and rows.id.is_unique
    for g, part in rows.groupby("g", dropna=False):
        if isinstance(g, str):
            assert set(part.n) == {want[g]} and all(list(w) == [len(g)] * 50 for w in part.wide)
        else:
            assert part.n.isna().all()


def test_table_bytes_measures_every_type(spark):
    from pyspark.ml.linalg import Vectors
    df = spark.createDataFrame([(1, "abc", bytearray(b"x" * 9), [1] * 100, {"k": "v" * 100}, Vectors.dense([0.5] * 100))],
                               ["a", "s", "b", "l", "m", "v"])
    n, size = relational.table_bytes(df)
    assert n == 1 and (size["a"], size["s"], size["b"]) == (16, 3, 9)
    assert min(size["l"], size["v"]) >= 800 and size["m"] >= 101


def test_population_fitness_equals_column_expressions(spark):
    """The batch form gives what each expression gives as a column, missing values included."""
    import random
    from tablesmith.functions.numeric import expression, reversed_logistic
    from workloads.rule_queries import candidate
    rows = [(float(i % 4), None if i % 5 == 0 else i % 3, float(i % 7) - 3, None if i % 11 == 0 else i % 2) for i in range(80)]
    df = spark.createDataFrame(rows, "pclass double, sibsp int, parch double, y int").repartition(3)
    population = [candidate(random.Random(i), 3) for i in range(40)] + [("div", "parch", "sibsp"), ("max", "sibsp", -1.0), "parch"]
    got = {r.candidate: r.fitness for r in rules.population_fitness(df, population, "y").collect()}
    hits = [F.avg(F.coalesce((reversed_logistic(expression(c)) == F.col("y")).cast("double"), F.lit(0.0))).alias(str(i))
            for i, c in enumerate(population)]
    assert got == pytest.approx({int(k): v for k, v in df.agg(*hits).first().asDict().items()})


@pytest.mark.parametrize("limit", [64, 1])
def test_label_codes_of_zeros(spark, limit):
    """Both zeros are one level, as literals and as a join."""
    df = spark.createDataFrame([(1, 0.0), (2, -0.0), (3, 2.5), (4, float("nan")), (5, None)], "id long, x double")
    got = encode.label_codes(df, {"x": "c"}, "id", by=(), literal_limit=limit)
    assert {r.id: r.c for r in got.collect()} == {1: 0, 2: 0, 3: 1, 4: 2, 5: None}
