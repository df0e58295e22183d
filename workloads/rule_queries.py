"""Rule models, baselines and scoring."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from tablesmith.functions.text import between
from tablesmith.operators import metrics, relational, rules
from workloads.base import M, manifest, query, r6, rounded, uniform_sql

RULE_SQL = """CASE WHEN sex = 'female' AND pclass = 3 AND port = 'S' AND fare > 8 THEN 0
  WHEN sex = 'female' THEN 1 WHEN sex = 'male' AND {boy} THEN 1 ELSE 0 END"""
SPLIT_TITLE = "CASE WHEN contains(name, ', ') THEN split_part(split_part(name, ', ', 2), '.', 1) END"
BOY = f"({SPLIT_TITLE}) = 'Master'"


def predicted(spark, sf):
    rows = manifest(spark, sf)
    return rows.select("id", "split", "truth", rules.rule_tree(
        F.col("sex"), F.col("pclass"), F.col("port"), F.col("fare"), between(F.col("name"), ", ", ".")).alias("pred"))


@query("rule_tree", M + f" SELECT id, {RULE_SQL.format(boy=BOY)} AS pred FROM m")
def rule_tree(spark, sf):
    return predicted(spark, sf).select("id", "pred")


@query("rule_tree_coded", M + f""", t AS (SELECT *, CASE WHEN ({SPLIT_TITLE}) = 'Master' THEN 3 ELSE 0 END AS code FROM m)
SELECT id, {RULE_SQL.format(boy='code = 3')} AS pred FROM t""")
def rule_tree_coded(spark, sf):
    code = F.when(between(F.col("name"), ", ", ".") == "Master", 3).otherwise(0)
    return manifest(spark, sf).select("id", rules.rule_tree_coded(
        F.col("sex"), F.col("pclass"), F.col("port"), F.col("fare"), code).alias("pred"))


@query("rule_gender_baseline", M + " SELECT id, CAST(sex = 'female' AS INTEGER) AS pred FROM m")
def rule_gender_baseline(spark, sf):
    return manifest(spark, sf).select("id", rules.gender_rule(F.col("sex")).alias("pred"))


@query("rule_coin_flip", M + f""", p AS (SELECT truth, CAST({uniform_sql('id')} > 0.5 AS INTEGER) AS pred FROM m)
SELECT round(avg(CAST(truth = pred AS INTEGER)), 6) AS accuracy, CAST(sum(pred) AS BIGINT) AS heads FROM p""")
def rule_coin_flip(spark, sf):
    rows = manifest(spark, sf).select("truth", rules.coin_flip(F.col("id")).alias("pred"))
    return rows.agg(r6(F.avg((F.col("truth") == F.col("pred")).cast("double"))).alias("accuracy"),
                    F.sum("pred").alias("heads"))


# Operators of candidate expressions with their SQL; division by zero gives 1.
SHAPES = {"add": "({0} + {1})", "sub": "({0} - {1})", "mul": "({0} * {1})", "div": "(CASE WHEN {1} = 0 THEN 1 ELSE {0} / {1} END)",
          "max": "greatest({0}, {1})", "min": "least({0}, {1})", "sin": "sin({0})", "cos": "cos({0})", "tanh": "tanh({0})"}
POPULATION = 300


def candidate(draw: random.Random, depth: int):
    """A random expression over the numeric columns."""
    if depth == 0 or draw.random() < 0.15:
        return draw.choice(["pclass", "sibsp", "parch", round(draw.uniform(-2, 2), 2)])
    name = draw.choice(list(SHAPES))
    return name, *[candidate(draw, depth - 1) for _ in range(2 if "{1}" in SHAPES[name] else 1)]


def candidate_sql(c) -> str:
    if isinstance(c, tuple):
        return SHAPES[c[0]].format(*map(candidate_sql, c[1:]))
    return f"CAST({c} AS DOUBLE)"


CANDIDATES = [candidate(random.Random(i), 1 + i % 3) for i in range(POPULATION)]


@query("rule_population_fitness", M + ", f AS (" + " UNION ALL ".join(
    f"""SELECT CAST({i} AS INTEGER) AS candidate, avg(coalesce(CAST(round_even(1 - 1 / (1 + exp(-{candidate_sql(c)})), 0) = truth
      AS INTEGER), 0)) AS fitness FROM m""" for i, c in enumerate(CANDIDATES)) + """)
SELECT candidate, round(fitness, 6) AS fitness, round(avg(fitness) OVER (), 6) AS population_avg,
  round(stddev_pop(fitness) OVER (), 6) AS population_std, round(min(fitness) OVER (), 6) AS population_min,
  round(max(fitness) OVER (), 6) AS population_max FROM f""")
def rule_population_fitness(spark, sf):
    """A whole population in one scan, next to the population's own statistics."""
    fitness = rules.population_fitness(manifest(spark, sf), CANDIDATES, "truth")
    summary = rules.fitness_summary(fitness)
    whole = summary.select(*[F.col(c).alias(f"population_{c}") for c in summary.columns])
    return rounded(fitness.join(F.broadcast(whole)), *[c for c in ("fitness", *whole.columns)])


@query("score_submission", M + f""", p AS (SELECT id, {RULE_SQL.format(boy=BOY)} AS pred
  FROM m WHERE split = 'test'), s AS (SELECT id, truth FROM m WHERE split = 'test')
SELECT round(avg(CAST(pred = truth AS INTEGER)), 6) AS accuracy, round(100 * avg(CAST(pred = truth AS INTEGER)), 2) AS percent,
  count(*) AS n FROM p JOIN s USING (id)""")
def score_submission(spark, sf):
    rows = predicted(spark, sf).where("split = 'test'")
    aligned = relational.align_predictions(rows.select("id", "pred"), rows.select("id", "truth"), "id")
    return rounded(metrics.accuracy(aligned.where("status = 'matched'"), "pred", "truth"), "accuracy")
