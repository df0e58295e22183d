"""Projections, filters, updates, stacking and keyed joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablesmith.functions.maps import equals_flag
from tablesmith.operators import relational
from tablesmith.operators.ordering import medians
from tablesmith.plans.features import family_size
from tablesmith.plans.recipes import feature_lists
from tablesmith.operators.stats import correlations_with, target_rate
from tablesmith.operators import rules
from workloads.base import M, ROLES, manifest, query, r6, rounded, table


def _named(spark, sf):
    """The manifest under the passenger files' column names."""
    old = {"survived": "Survived", "sex": "Sex", "pclass": "Pclass", "port": "Embarked", "sibsp": "SibSp",
           "parch": "Parch", "age": "Age", "fare": "Fare"}
    size = family_size(ROLES)
    return (manifest(spark, sf).withColumn("FamilySize", size).withColumn("IsAlone", equals_flag(size, 1))
            .withColumn("Title", F.regexp_extract("name", r" ([A-Za-z]+)\.", 1)).withColumnsRenamed(old))


@query("project_feature_lists", M + """ SELECT survived AS "Survived", sex AS "Sex", pclass AS "Pclass",
  port AS "Embarked", regexp_extract(name, ' ([A-Za-z]+)\\.', 1) AS "Title", sibsp AS "SibSp",
  parch AS "Parch", age AS "Age", fare AS "Fare", sibsp + parch + 1 AS "FamilySize",
  CAST(sibsp + parch + 1 = 1 AS INTEGER) AS "IsAlone" FROM m""")
def project_feature_lists(spark, sf):
    return _named(spark, sf).select(*feature_lists()["raw_labelled"])


@query("drop_columns", "SELECT p_partkey, p_size, p_retailprice FROM part")
def drop_columns(spark, sf):
    return table(spark, sf, "part").drop("p_name", "p_brand", "p_type")


@query("filter_conjunction", M + """ SELECT count(*) AS n, round(avg(fare), 6) AS mean_fare FROM m
  WHERE pclass = 3 AND parch = 0 AND sex = 'male' AND sibsp = 0""")
def filter_conjunction(spark, sf):
    picked = manifest(spark, sf).where(relational.matches(pclass=3, parch=0, sex="male", sibsp=0))
    return picked.agg(F.count(F.lit(1)).alias("n"), r6(F.avg("fare")).alias("mean_fare"))


@query("filter_by_key", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderkey = 339")
def filter_by_key(spark, sf):
    return (table(spark, sf, "orders").where(F.col("o_orderkey") == 339)
            .select("o_orderkey", "o_totalprice", "o_orderstatus"))


@query("conditional_update", M + """ SELECT id, CASE WHEN cabin IS NULL THEN 'none' ELSE cabin END AS cabin,
  CASE WHEN fare > 100 THEN CAST(100 AS DOUBLE) ELSE fare END AS fare FROM m""")
def conditional_update(spark, sf):
    rows = manifest(spark, sf).select("id", "cabin", "fare")
    rows = relational.update_where(rows, "cabin", F.col("cabin").isNull(), "none")
    return relational.update_where(rows, "fare", F.col("fare") > 100, 100.0)


@query("cast_columns", M + """ SELECT id, CAST(trunc(age) AS INTEGER) AS age,
  CAST(trunc(fare) AS BIGINT) AS fare, CAST(pclass AS DOUBLE) AS pclass FROM m""")
def cast_columns(spark, sf):
    return relational.cast_all(manifest(spark, sf).select("id", "age", "fare", "pclass"),
                               {"age": "int", "fare": "bigint", "pclass": "double"})


@query("rename_columns", 'SELECT s_suppkey AS "PassengerId", s_acctbal AS "Sol" FROM supplier')
def rename_columns(spark, sf):
    return (table(spark, sf, "supplier").select("s_suppkey", "s_acctbal")
            .withColumnsRenamed({"s_suppkey": "PassengerId", "s_acctbal": "Sol"}))


@query("derive_family_size", M + " SELECT id, sibsp + parch + 1 AS family_size FROM m")
def derive_family_size(spark, sf):
    return manifest(spark, sf).select("id", family_size(ROLES).alias("family_size"))


@query("derive_relatives", M + " SELECT id, sibsp + parch AS relatives FROM m")
def derive_relatives(spark, sf):
    return manifest(spark, sf).select("id", (F.col("sibsp") + F.col("parch")).alias("relatives"))


@query("derive_is_alone", M + " SELECT id, CAST(sibsp + parch + 1 = 1 AS INTEGER) AS is_alone FROM m")
def derive_is_alone(spark, sf):
    return manifest(spark, sf).select("id", equals_flag(family_size(ROLES), 1).alias("is_alone"))


@query("derive_is_alone_ticket", M + """ SELECT id, CAST(sibsp + parch + 1 = 1
  AND count(*) OVER (PARTITION BY split, ticket) = 1 AS INTEGER) AS is_alone FROM m""")
def derive_is_alone_ticket(spark, sf):
    rows = manifest(spark, sf).select("id", "split", "ticket", "sibsp", "parch")
    counted = relational.attach_group_count(rows, ["split", "ticket"], "ticket_freq", "id")
    alone = (family_size(ROLES) == 1) & (F.col("ticket_freq") == 1)
    return counted.select("id", F.when(alone, 1).otherwise(0).alias("is_alone"))


@query("derive_is_married", M + """ SELECT id, CASE WHEN regexp_extract(name, ' ([A-Za-z]+)\\.', 1) = 'Mrs'
  THEN 1 ELSE 0 END AS is_married FROM m""")
def derive_is_married(spark, sf):
    """The flag itself, over a title code that can be 7 (the munging plan's never is)."""
    code = F.when(F.regexp_extract("name", r" ([A-Za-z]+)\.", 1) == "Mrs", 7).otherwise(0)
    return manifest(spark, sf).select("id", equals_flag(code, 7).alias("is_married"))


@query("derive_has_value", M + " SELECT id, CAST(cabin IS NOT NULL AS INTEGER) AS has_cabin FROM m")
def derive_has_value(spark, sf):
    return manifest(spark, sf).select("id", F.col("cabin").isNotNull().cast("int").alias("has_cabin"))


@query("derive_fare_per_person", M + """ SELECT id,
  round(fare / (SELECT avg(sibsp + parch + 1) FROM m), 6) AS fare_per_person FROM m""")
def derive_fare_per_person(spark, sf):
    rows = manifest(spark, sf)
    party = rows.agg(F.avg(family_size(ROLES))).scalar()
    return rows.select("id", r6(F.col("fare") / party).alias("fare_per_person"))


@query("union_missing_columns", """SELECT NULL AS balance, c_custkey AS key, c_name AS name,
  c_mktsegment AS segment FROM customer UNION ALL SELECT s_acctbal, s_suppkey, s_name, NULL FROM supplier""")
def union_missing_columns(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return relational.union_sorted(customers, suppliers)


@query("split_back", M + """ SELECT 'train' AS part, count(*) AS n, CAST(sum(survived) AS BIGINT) AS positives
  FROM m WHERE split = 'train' UNION ALL SELECT 'test', count(*), NULL FROM m WHERE split = 'test'""")
def split_back(spark, sf):
    train, test = relational.split_back(manifest(spark, sf), "split", "survived")
    return (train.agg(F.lit("train").alias("part"), F.count(F.lit(1)).alias("n"),
                      F.sum("survived").alias("positives"))
            .unionByName(test.agg(F.lit("test").alias("part"), F.count(F.lit(1)).alias("n")),
                         allowMissingColumns=True))


@query("join_columns_by_key", M + """ SELECT id, age, fare, CAST(sex = 'female' AS INTEGER) AS female,
  CAST(port = 'S' AS INTEGER) AS port_s FROM m""")
def join_columns_by_key(spark, sf):
    rows = manifest(spark, sf)
    return relational.side_by_side([
        rows.select("id", "age", "fare"),
        rows.select("id", (F.col("sex") == "female").cast("int").alias("female")),
        rows.select("id", (F.col("port") == "S").cast("int").alias("port_s"))], "id")


@query("join_predictions_solution", M + """, p AS (SELECT id, CAST(sex = 'female' AS INTEGER) AS pred FROM m
  WHERE split = 'test'), s AS (SELECT id, truth AS sol FROM m WHERE cabin IS NOT NULL)
SELECT id, pred, sol, CASE WHEN p.pred IS NULL THEN 'no_prediction' WHEN s.sol IS NULL THEN 'no_solution'
  ELSE 'matched' END AS status FROM p FULL JOIN s USING (id)""")
def join_predictions_solution(spark, sf):
    """Both sides lack some of the other's keys; each unmatched key is reported."""
    rows = manifest(spark, sf)
    predictions = rows.where("split = 'test'").select("id", rules.gender_rule(F.col("sex")).alias("pred"))
    solution = rows.where("cabin is not null").select("id", F.col("truth").alias("sol"))
    return relational.align_predictions(predictions, solution, "id")


@query("join_group_statistic", M + """, g AS (SELECT sex, pclass, median(age) AS v FROM m GROUP BY sex, pclass)
SELECT id, round(v, 6) AS group_median FROM m JOIN g USING (sex, pclass)""")
def join_group_statistic(spark, sf):
    rows = manifest(spark, sf).select("id", "sex", "pclass", "age")
    groups = medians(rows, ["sex", "pclass"], {"group_median": "age"}).join(
        relational.group_sizes(rows, ["sex", "pclass"], "_size"), ["sex", "pclass"])
    found = relational.attach(rows, groups, ["sex", "pclass"], "_size", ["id"])
    return rounded(found.select("id", "group_median"), "group_median")


@query("sort_desc", M + """ SELECT port, round(avg(survived), 6) AS rate FROM m WHERE split = 'train'
  AND port IS NOT NULL GROUP BY port ORDER BY rate DESC, port""")
def sort_desc(spark, sf):
    return rounded(target_rate(manifest(spark, sf).where("split = 'train'"), "port", "survived"), "rate")


@query("topk_rows", """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
  ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey LIMIT 10""")
def topk_rows(spark, sf):
    return (table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
            .orderBy(F.col("l_extendedprice").desc(), "l_orderkey", "l_linenumber", "l_partkey").limit(10))
