"""Profiling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablesmith.operators import profile
from workloads.base import M, manifest, query, r6, rounded, scramble_sql, table

TYPES = {"id": "bigint", "split": "string", "survived": "int", "truth": "int", "pclass": "int",
         "name": "string", "sex": "string", "age": "double", "sibsp": "int", "parch": "int",
         "ticket": "string", "fare": "double", "cabin": "string", "port": "string"}


@query("profile_columns", M + " " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{t}' AS column_type, count({c}) AS non_null FROM m"
    for c, t in TYPES.items()))
def profile_columns(spark, sf):
    return profile.columns(manifest(spark, sf))


@query("profile_shape", "SELECT count(*) AS n_rows, CAST(11 AS BIGINT) AS n_columns FROM lineitem")
def profile_shape(spark, sf):
    return profile.shape(table(spark, sf, "lineitem"))


@query("head_rows", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 3")
def head_rows(spark, sf):
    return profile.head(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice"),
                        "o_orderkey", 3)


@query("tail_rows", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey DESC LIMIT 3")
def tail_rows(spark, sf):
    return profile.tail(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice"),
                        "o_orderkey", 3)


@query("sample_rows", f"""SELECT o_orderkey, o_custkey FROM orders
  ORDER BY {scramble_sql('o_orderkey')}, o_orderkey LIMIT 10""")
def sample_rows(spark, sf):
    return profile.sample(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", 10)


@query("null_profile", M + " " + " UNION ALL ".join(
    f"""SELECT split, '{c}' AS column_name, count(*) - count({c}) AS n_null, count(*) AS n_rows,
      round((count(*) - count({c})) / CAST(count(*) AS DOUBLE), 6) AS null_fraction FROM m GROUP BY split"""
    for c in TYPES if c != "split"))
def null_profile(spark, sf):
    return rounded(profile.nulls(manifest(spark, sf), "split"), "null_fraction")


@query("null_rows", M + " SELECT id, name, fare FROM m WHERE port IS NULL")
def null_rows(spark, sf):
    return profile.rows_with_null(manifest(spark, sf), "port").select("id", "name", "fare")


NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_linenumber"]


@query("describe_numeric", " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 6) AS mean,
      round(stddev_samp({c}), 6) AS std, CAST(min({c}) AS DOUBLE) AS min_value,
      round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS q25,
      round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS q50,
      round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS q75,
      CAST(max({c}) AS DOUBLE) AS max_value FROM lineitem""" for c in NUMBERS))
def describe_numeric(spark, sf):
    return rounded(profile.describe_numeric(table(spark, sf, "lineitem"), NUMBERS),
                   "mean", "std", "q25", "q50", "q75")


TEXTS = ["sex", "ticket", "cabin", "port"]


@query("describe_categorical", M + ", c AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {c} AS v, count(*) AS k FROM m WHERE {c} IS NOT NULL GROUP BY {c}"
    for c in TEXTS) + """), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY k DESC, v) AS rn FROM c)
SELECT column_name, CAST(sum(k) AS BIGINT) AS n, count(*) AS n_unique,
  max(CASE WHEN rn = 1 THEN v END) AS top_value, max(k) AS top_count FROM ranked GROUP BY column_name""")
def describe_categorical(spark, sf):
    return profile.describe_categorical(manifest(spark, sf), TEXTS)


UNIQUE = ["split", "sex", "pclass", "port", "ticket", "sibsp"]


@query("unique_values", M + " " + " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count(*) AS n_unique, CAST(count(*) > 5 AS INTEGER) AS over_ceiling,
      CASE WHEN count(*) > 5 THEN '' ELSE string_agg(v, ',' ORDER BY v) END AS value_list
      FROM (SELECT DISTINCT CAST({c} AS VARCHAR) AS v FROM m)""" for c in UNIQUE))
def unique_values(spark, sf):
    return profile.unique_values(manifest(spark, sf), UNIQUE, 5)


@query("value_counts", """SELECT c_mktsegment, count(*) AS n,
  round(count(*) / CAST((SELECT count(*) FROM customer) AS DOUBLE), 6) AS share
  FROM customer GROUP BY c_mktsegment""")
def value_counts(spark, sf):
    return rounded(profile.value_counts(table(spark, sf, "customer"), "c_mktsegment", normalize=True), "share")


@query("distinct_count", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_unique FROM part"
    for c in ("p_brand", "p_type", "p_size", "p_name")))
def distinct_count(spark, sf):
    return profile.distinct_count(table(spark, sf, "part"), ["p_brand", "p_type", "p_size", "p_name"])
