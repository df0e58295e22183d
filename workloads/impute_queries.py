"""Imputation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablesmith.operators import impute, profile, relational
from workloads.base import M, manifest, query, rounded, uniform_sql

BAND_SQL = (", b AS (SELECT split, avg(age) - stddev_samp(age) AS lo, avg(age) + stddev_samp(age) AS hi"
            " FROM m GROUP BY split)")
RANDOM_AGE_SQL = ("CAST(trunc(lo) AS BIGINT) + CAST(floor(" + uniform_sql("id")
                  + " * (CAST(trunc(hi) AS BIGINT) - CAST(trunc(lo) AS BIGINT))) AS BIGINT)")


@query("impute_constant", M + " SELECT id, coalesce(port, 'S') AS port, coalesce(cabin, '0') AS cabin FROM m")
def impute_constant(spark, sf):
    return impute.fill_constant(manifest(spark, sf).select("id", "port", "cabin"), {"port": "S", "cabin": "0"})


@query("impute_global_median", M + """ SELECT id, split,
  round(coalesce(age, median(age) OVER (PARTITION BY split)), 6) AS age,
  round(coalesce(fare, median(fare) OVER (PARTITION BY split)), 6) AS fare FROM m""")
def impute_global_median(spark, sf):
    rows = manifest(spark, sf).select("id", "split", "age", "fare")
    return rounded(impute.fill_median(rows, ["age", "fare"], "per_split"), "age", "fare")


@query("impute_from_train", M + """ SELECT id, split, round(coalesce(fare,
  (SELECT median(fare) FROM m WHERE split = 'train')), 6) AS fare FROM m""")
def impute_from_train(spark, sf):
    return rounded(impute.fill_median(manifest(spark, sf).select("id", "split", "fare"), ["fare"], "train"), "fare")


@query("impute_mode", M + """, c AS (SELECT split, port, count(*) AS n FROM m WHERE port IS NOT NULL GROUP BY ALL),
t AS (SELECT port FROM c WHERE split = 'train' ORDER BY n DESC, port LIMIT 1)
SELECT id, split, coalesce(port, (SELECT port FROM t)) AS port FROM m""")
def impute_mode(spark, sf):
    return impute.fill_mode(manifest(spark, sf).select("id", "split", "port"), "port", "train")


@query("impute_group_median", M + """ SELECT id, round(coalesce(age, median(age)
  OVER (PARTITION BY sibsp, pclass)), 6) AS age FROM m""")
def impute_group_median(spark, sf):
    rows = manifest(spark, sf).select("id", "sibsp", "pclass", "age")
    return rounded(impute.fill_group_median(rows, "age", ["sibsp", "pclass"], "id").select("id", "age"), "age")


@query("impute_group_median_rounded", M + """, g AS (SELECT *, median(age) OVER (PARTITION BY split, sex, pclass)
  AS v FROM m) SELECT id, CAST(trunc(coalesce(age, CAST(trunc(v / CAST(0.5 AS DOUBLE) + 0.5) AS BIGINT)
  * CAST(0.5 AS DOUBLE))) AS INTEGER) AS age FROM g""")
def impute_group_median_rounded(spark, sf):
    rows = manifest(spark, sf).select("id", "split", "sex", "pclass", "age")
    filled = impute.fill_group_median(rows, "age", ["split", "sex", "pclass"], "id", rounded=True)
    return filled.select("id", F.col("age").cast("int").alias("age"))


@query("impute_cohort_median", M + """ SELECT id, round(coalesce(fare, (SELECT median(fare) FROM m
  WHERE pclass = 3 AND parch = 0 AND sex = 'male' AND sibsp = 0)), 6) AS fare FROM m""")
def impute_cohort_median(spark, sf):
    cohort = relational.matches(pclass=3, parch=0, sex="male", sibsp=0)
    return rounded(impute.fill_cohort_median(manifest(spark, sf), "fare", cohort).select("id", "fare"), "fare")


@query("impute_group_lookup", M + """, g AS (SELECT pclass, parch, sibsp, median(fare) AS v FROM m GROUP BY ALL)
SELECT id, round(coalesce(fare, (SELECT v FROM g WHERE pclass = 3 AND parch = 0 AND sibsp = 0)), 6) AS fare FROM m""")
def impute_group_lookup(spark, sf):
    """One group's median: the filter goes before the aggregate, so only that group is read."""
    group = relational.matches(pclass=3, parch=0, sibsp=0)
    return rounded(impute.fill_cohort_median(manifest(spark, sf), "fare", group).select("id", "fare"), "fare")


@query("impute_random_band", M + BAND_SQL + f""" SELECT id, split,
  coalesce(age, CAST({RANDOM_AGE_SQL} AS DOUBLE)) AS age FROM m JOIN b USING (split)""")
def impute_random_band(spark, sf):
    return impute.fill_random_band(manifest(spark, sf).select("id", "split", "age"), "age", "id")


@query("assert_no_nulls", M + """ SELECT 'cabin' AS column_name, count(*) - count(cabin) AS n_null FROM m""")
def assert_no_nulls(spark, sf):
    """After filling age, fare and port only the cabin column still has gaps."""
    rows = manifest(spark, sf)
    filled = impute.fill_median(rows, ["age", "fare"], "per_split")
    filled = impute.fill_mode(filled, "port", "train")
    return profile.missing_columns(filled, ["age", "fare", "port", "cabin"])
