"""Aggregations, plot tables, metrics and window-style operators."""

from __future__ import annotations

from itertools import product

from pyspark.sql import functions as F

from tablesmith.functions.numeric import half_even
from tablesmith.operators import encode, impute, metrics, ordering, relational, rules, splits, stats
from workloads.base import M, manifest, query, r6, rounded, table


@query("agg_global_stats", M + """ SELECT round(avg(age), 6) AS mean, round(stddev_samp(age), 6) AS std,
  count(*) - count(age) AS n_null, round(median(age), 6) AS median,
  (SELECT age FROM m WHERE age IS NOT NULL GROUP BY age ORDER BY count(*) DESC, age LIMIT 1) AS mode FROM m""")
def agg_global_stats(spark, sf):
    return rounded(stats.global_stats(manifest(spark, sf), "age"), "mean", "std", "median", "mode")


@query("agg_group_median", """SELECT l_returnflag, l_linestatus, l_linenumber,
  round(median(l_extendedprice), 6) AS price, round(median(l_quantity), 6) AS quantity
  FROM lineitem GROUP BY ALL""")
def agg_group_median(spark, sf):
    keys = ["l_returnflag", "l_linestatus", "l_linenumber"]
    return rounded(ordering.medians(table(spark, sf, "lineitem"), keys,
                                    {"price": "l_extendedprice", "quantity": "l_quantity"}), "price", "quantity")


@query("agg_filtered_median", M + """ SELECT round(median(fare), 6) AS fare FROM m
  WHERE pclass = 3 AND parch = 0 AND sex = 'male' AND sibsp = 0""")
def agg_filtered_median(spark, sf):
    cohort = manifest(spark, sf).where(relational.matches(pclass=3, parch=0, sex="male", sibsp=0))
    return rounded(ordering.medians(cohort, [], {"fare": "fare"}), "fare")


@query("agg_target_rate", """SELECT o_orderpriority, round(avg(CAST(o_orderstatus = 'F' AS INTEGER)), 6) AS rate
  FROM orders GROUP BY o_orderpriority""")
def agg_target_rate(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderpriority",
                                             (F.col("o_orderstatus") == "F").cast("int").alias("label"))
    return rounded(stats.target_rate(rows, "o_orderpriority", "label"), "rate")


@query("agg_crosstab", """SELECT l_returnflag, count(*) FILTER (l_linestatus = 'F') AS "F",
  count(*) FILTER (l_linestatus = 'O') AS "O" FROM lineitem GROUP BY l_returnflag""")
def agg_crosstab(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus")
    return stats.crosstab(rows, "l_returnflag", "l_linestatus", ["F", "O"])


@query("agg_segment_drilldown", M + """ SELECT sex, pclass, port, count(*) AS n,
  CAST(sum(truth) AS BIGINT) AS positives, round(avg(truth), 6) AS rate,
  CAST(3 - grouping(sex) - grouping(pclass) - grouping(port) AS INTEGER) AS depth
  FROM m GROUP BY ROLLUP (sex, pclass, port)""")
def agg_segment_drilldown(spark, sf):
    return rounded(stats.drilldown(manifest(spark, sf), ["sex", "pclass", "port"], "truth"), "rate")


NUMERIC = ["truth", "pclass", "age", "sibsp", "parch", "fare"]


def _corr(a: str, b: str) -> str:
    return "CAST(max(1) AS DOUBLE)" if a == b else f"round(corr({a}, {b}), 6)"


@query("agg_corr_matrix", M + " " + " UNION ALL ".join(
    f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, {_corr(a, b)} AS correlation FROM m"
    for a, b in product(NUMERIC, NUMERIC)))
def agg_corr_matrix(spark, sf):
    return rounded(stats.correlations(manifest(spark, sf), NUMERIC), "correlation")


@query("agg_corr_with", M + " " + " UNION ALL ".join(
    f"SELECT 'age' AS feature_1, '{b}' AS feature_2, abs({_corr('age', b)}) AS correlation FROM m"
    for b in NUMERIC))
def agg_corr_with(spark, sf):
    return rounded(stats.correlations_with(manifest(spark, sf), "age", NUMERIC, absolute=True), "correlation")


@query("agg_boxplot_stats", """WITH q AS (SELECT l_linenumber, quantile_cont(l_extendedprice, 0.25) AS q1,
  median(l_extendedprice) AS q2, quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem GROUP BY 1),
j AS (SELECT *, l_extendedprice >= q1 - 1.5 * (q3 - q1) AND l_extendedprice <= q3 + 1.5 * (q3 - q1) AS inside
  FROM lineitem JOIN q USING (l_linenumber))
SELECT l_linenumber, round(q1, 6) AS q1, round(q2, 6) AS q2, round(q3, 6) AS q3,
  min(l_extendedprice) FILTER (inside) AS whisker_low, max(l_extendedprice) FILTER (inside) AS whisker_high,
  round(avg(l_extendedprice), 6) AS mean, count(*) FILTER (NOT inside) AS n_outliers FROM j GROUP BY ALL""")
def agg_boxplot_stats(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_linenumber", "l_extendedprice")
    return rounded(stats.boxplot(rows, "l_linenumber", "l_extendedprice"), "q1", "q2", "q3", "mean")


@query("agg_histogram", M + """, e AS (SELECT min(age) AS lo, max(age) AS hi FROM m)
SELECT CAST(least(floor((age - lo) / ((hi - lo) / 10)), 9) AS INTEGER) AS bin, truth, count(*) AS n
  FROM m, e WHERE age IS NOT NULL GROUP BY ALL""")
def agg_histogram(spark, sf):
    return stats.histogram(manifest(spark, sf), "age", "truth", 10)


@query("agg_mean_ci", M + """ SELECT sex, pclass, count(truth) AS n, round(avg(truth), 6) AS mean,
  round(avg(truth) - 1.96 * stddev_samp(truth) / sqrt(count(truth)), 6) AS low,
  round(avg(truth) + 1.96 * stddev_samp(truth) / sqrt(count(truth)), 6) AS high FROM m GROUP BY sex, pclass""")
def agg_mean_ci(spark, sf):
    return rounded(stats.mean_interval(manifest(spark, sf), ["sex", "pclass"], "truth"), "mean", "low", "high")


@query("agg_kde", M + """, e AS (SELECT min(age) AS lo, (max(age) - min(age)) / 24 AS step FROM m),
h AS (SELECT truth, pow(count(*), -0.2) * stddev_samp(age) AS h, count(*) AS n FROM m
  WHERE age IS NOT NULL GROUP BY truth),
v AS (SELECT truth, age, count(*) AS k FROM m WHERE age IS NOT NULL GROUP BY truth, age)
SELECT truth, CAST(point AS INTEGER) AS point, round(lo + step * point, 6) AS x,
  round(sum(k * exp(-0.5 * pow((lo + step * point - age) / h, 2))) / (n * h * sqrt(2 * pi())), 6) AS density
  FROM v JOIN h USING (truth), e, range(25) AS r(point) GROUP BY truth, point, lo, step, n, h""")
def agg_kde(spark, sf):
    return rounded(stats.kernel_density(manifest(spark, sf), "truth", "age", 25), "x", "density")


@query("agg_row_mean", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  round((l_quantity + l_discount + l_tax) / 3, 6) AS mean FROM lineitem""")
def agg_row_mean(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        r6(stats.row_mean(["l_quantity", "l_discount", "l_tax"])).alias("mean"))


@query("agg_column_mean_row", """WITH t AS (SELECT p_type, avg(p_size) AS size, avg(p_retailprice) AS price
  FROM part GROUP BY p_type) SELECT p_type, round(size, 6) AS size, round(price, 6) AS price FROM t
  UNION ALL SELECT 'mean', round(avg(size), 6), round(avg(price), 6) FROM t""")
def agg_column_mean_row(spark, sf):
    per_type = table(spark, sf, "part").groupBy("p_type").agg(F.avg("p_size").alias("size"),
                                                              F.avg("p_retailprice").alias("price"))
    return rounded(stats.with_mean_row(per_type, "p_type"), "size", "price")


def _scored(spark, sf):
    return manifest(spark, sf).select("id", "truth", "fare", rules.gender_rule(F.col("sex")).alias("pred"))


@query("agg_accuracy", M + """ SELECT round(avg(CAST((sex = 'female') = (truth = 1) AS INTEGER)), 6) AS accuracy,
  round(100 * avg(CAST((sex = 'female') = (truth = 1) AS INTEGER)), 2) AS percent, count(*) AS n FROM m""")
def agg_accuracy(spark, sf):
    return rounded(metrics.accuracy(_scored(spark, sf), "pred", "truth"), "accuracy")


@query("agg_confusion_matrix", M + """ SELECT truth, CAST(sex = 'female' AS INTEGER) AS pred, count(*) AS n
  FROM m GROUP BY ALL""")
def agg_confusion_matrix(spark, sf):
    return metrics.confusion(_scored(spark, sf), "pred", "truth")


@query("agg_classification_report", M + """, s AS (SELECT truth, CAST(sex = 'female' AS INTEGER) AS pred FROM m),
c AS (SELECT c, count(*) FILTER (truth = c) AS support, count(*) FILTER (pred = c) AS claimed,
  count(*) FILTER (pred = c AND truth = c) AS hits FROM s, (VALUES (0), (1)) v(c) GROUP BY c),
f AS (SELECT c, support, hits, hits / CAST(claimed AS DOUBLE) AS p, hits / CAST(support AS DOUBLE) AS r FROM c),
g AS (SELECT *, 2 * p * r / (p + r) AS f FROM f)
SELECT CAST(c AS VARCHAR) AS class, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1,
  support FROM g
UNION ALL SELECT 'accuracy', round(sum(hits) / sum(support), 6), round(sum(hits) / sum(support), 6),
  round(sum(hits) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM g
UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), CAST(sum(support) AS BIGINT)
  FROM g
UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6),
  round(sum(r * support) / sum(support), 6), round(sum(f * support) / sum(support), 6),
  CAST(sum(support) AS BIGINT) FROM g""")
def agg_classification_report(spark, sf):
    return rounded(metrics.classification_report(_scored(spark, sf), "pred", "truth"),
                   "precision", "recall", "f1")


@query("agg_roc_auc", """WITH s AS (SELECT l_quantity AS score, CAST(l_returnflag = 'R' AS INTEGER) AS y
  FROM lineitem), r AS (SELECT y, rank() OVER (ORDER BY score)
  + (count(*) OVER (PARTITION BY score) - 1) / CAST(2 AS DOUBLE) AS k FROM s),
t AS (SELECT sum(k) FILTER (y = 1) AS r, count(*) FILTER (y = 1) AS p, count(*) FILTER (y = 0) AS n FROM r)
SELECT round((r - p * (p + 1) / CAST(2 AS DOUBLE)) / (CAST(p AS DOUBLE) * n), 6) AS auc, p AS n_positive,
  n AS n_negative FROM t""")
def agg_roc_auc(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_quantity", (F.col("l_returnflag") == "R").cast("int").alias("y"))
    return rounded(metrics.roc_auc(rows, "l_quantity", "y"), "auc")


@query("win_group_count", M + """ SELECT id, CASE WHEN cabin IS NOT NULL
  THEN count(*) OVER (PARTITION BY split, cabin) END AS cabin_count,
  count(*) OVER (PARTITION BY split, ticket) AS ticket_count FROM m""")
def win_group_count(spark, sf):
    rows = manifest(spark, sf).select("id", "split", "cabin", "ticket")
    counted = relational.attach_group_count(rows, ["split", "cabin"], "cabin_count", "id")
    counted = relational.attach_group_count(counted, ["split", "ticket"], "ticket_count", "id", source=rows)
    return counted.select("id", "cabin_count", "ticket_count")


@query("win_group_median_fill", M + """ SELECT id, round(coalesce(age, median(age)
  OVER (PARTITION BY sex, pclass)), 6) AS age FROM m""")
def win_group_median_fill(spark, sf):
    rows = manifest(spark, sf).select("id", "sex", "pclass", "age")
    return rounded(impute.fill_group_median(rows, "age", ["sex", "pclass"], "id").select("id", "age"), "age")


@query("win_label_codes", M + """ SELECT id, CASE WHEN cabin IS NOT NULL THEN CAST(dense_rank() OVER
  (PARTITION BY split, cabin IS NULL ORDER BY cabin) - 1 AS INTEGER) END AS code FROM m""")
def win_label_codes(spark, sf):
    rows = manifest(spark, sf).select("id", "split", "cabin")
    return encode.label_codes(rows, {"cabin": "code"}, "id", ["split"]).select("id", "code")


@query("win_contiguous_folds", "SELECT o_orderkey, CAST(ntile(7) OVER (ORDER BY o_orderkey) - 1 AS INTEGER) AS fold"
                               " FROM orders")
def win_contiguous_folds(spark, sf):
    return splits.contiguous_fold(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 7)


@query("win_row_number_top1", """SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER
  (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def win_row_number_top1(spark, sf):
    """Best row per key as a max over a struct, which combines before the shuffle."""
    best = F.max_by(F.struct("o_orderkey", "o_totalprice"), F.struct("o_totalprice", -F.col("o_orderkey")))
    return (table(spark, sf, "orders").groupBy("o_custkey").agg(best.alias("b"))
            .select("o_custkey", "b.o_orderkey", "b.o_totalprice"))
