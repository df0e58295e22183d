"""Folds, draws and bootstrap weights."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablesmith.operators import splits
from workloads.base import query, scramble_sql, table, uniform_sql


@query("split_kfold", """SELECT fold, count(*) AS n_test, (SELECT count(*) FROM orders) - count(*) AS n_train,
  min(o_orderkey) AS first_key, max(o_orderkey) AS last_key
  FROM (SELECT o_orderkey, CAST(ntile(5) OVER (ORDER BY o_orderkey) - 1 AS INTEGER) AS fold FROM orders) GROUP BY fold""")
def split_kfold(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey")
    everything = rows.agg(F.count(F.lit(1))).scalar()
    return (splits.contiguous_fold(rows, "o_orderkey", 5).groupBy("fold")
            .agg(F.count(F.lit(1)).alias("n_test"), F.min("o_orderkey").alias("first_key"),
                 F.max("o_orderkey").alias("last_key"))
            .withColumn("n_train", everything - F.col("n_test")))


def role_sql(draw: int, test: float, train: float) -> str:
    order = f"ORDER BY {scramble_sql('o_orderkey', draw)}, o_orderkey"
    rank = f"row_number() OVER ({order})"
    n_test = f"ceil({test} * count(*) OVER ())"
    n_train = f"floor({train} * count(*) OVER ())"
    return (f"CASE WHEN {rank} <= {n_test} THEN 'test' WHEN {rank} <= {n_test} + {n_train} THEN 'train' "
            "ELSE 'unused' END")


@query("split_shuffle_repeated", "SELECT o_orderkey, " + ", ".join(
    f"{role_sql(i, 0.3, 0.6)} AS draw_{i}" for i in range(10)) + " FROM orders")
def split_shuffle_repeated(spark, sf):
    return splits.shuffle_split(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 10)


@query("split_holdout", f"SELECT o_orderkey, {role_sql(0, 0.25, 0.75)} AS part FROM orders")
def split_holdout(spark, sf):
    return splits.holdout(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 0.25)


def poisson_sql(u: str) -> str:
    steps = splits.poisson_steps()
    arms = [f"WHEN u < {total!r} THEN {count}" for count, total in enumerate(steps)]
    return f"(SELECT CASE {' '.join(arms)} ELSE {len(steps)} END FROM (SELECT {u} AS u))"


@query("split_bootstrap", "SELECT o_orderkey, " + ", ".join(
    f"{poisson_sql(uniform_sql('o_orderkey', i))} AS bag_{i}" for i in range(3)) + " FROM orders")
def split_bootstrap(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", *[
        splits.bootstrap_weight(F.col("o_orderkey"), i).alias(f"bag_{i}") for i in range(3)])
