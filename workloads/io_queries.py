"""Scans and sinks: tables are written, read back and compared with their source."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F, types as T

from tablesmith.operators.relational import split_back
from tablesmith.operators.rules import gender_rule
from tablesmith.session import shared_folder
from tablesmith.sources import files
from workloads.base import M, manifest, query, table


def _fresh(spark) -> str:
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


@query("scan_csv", M + " SELECT id, pclass, name, sex, age, cabin FROM m")
def scan_csv(spark, sf):
    """Names hold commas and doubled quotes; they must survive the trip."""
    rows = manifest(spark, sf).select("id", "pclass", "name", "sex", "age", "cabin")
    path = _fresh(spark)
    files.write_csv(rows, path)
    return files.read_csv(spark, path, rows.schema)


@query("tag_splits", M + " SELECT id, survived, split FROM m")
def tag_splits(spark, sf):
    train, test = split_back(manifest(spark, sf).select("id", "survived", "split"), "split", "survived")
    return files.tag_splits({"train": train.drop("split"), "test": test.drop("split")}).select(
        "id", "survived", "split")


@query("sink_predictions_csv", M + """
 SELECT id AS "PassengerId", CAST(sex = 'female' AS INTEGER) AS "Survived" FROM m WHERE split = 'test'""")
def sink_predictions_csv(spark, sf):
    rows = manifest(spark, sf).where("split = 'test'").select("id", gender_rule(F.col("sex")).alias("p"))
    path = _fresh(spark)
    files.write_predictions(rows, path, "id", "p", ["PassengerId", "Survived"])
    return files.read_csv(spark, path, T.StructType([
        T.StructField("PassengerId", T.LongType()), T.StructField("Survived", T.IntegerType())]))


@query("sink_table_csv", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def sink_table_csv(spark, sf):
    rows = table(spark, sf, "part")
    path = _fresh(spark)
    files.write_csv(rows, path)
    return files.read_csv(spark, path, rows.schema)


@query("sink_table_tsv", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def sink_table_tsv(spark, sf):
    rows = table(spark, sf, "supplier")
    path = _fresh(spark)
    files.write_csv(rows, path, sep="\t")
    return files.read_csv(spark, path, rows.schema, sep="\t")
