"""Tables about fitted models."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tablesmith.operators.stats import with_mean_row
from tablesmith.session import shared_folder


def importances(spark: SparkSession, models: Mapping[str, object], names: Sequence[str]) -> DataFrame:
    """model x feature importance table with a closing mean row."""
    rows = []
    for name, model in models.items():
        values = model.featureImportances
        values = values.toArray() if hasattr(values, "toArray") else values
        rows.append((name, *[float(v) for v in values]))
    schema = T.StructType([T.StructField("model", T.StringType()),
                           *[T.StructField(n, T.DoubleType()) for n in names]])
    return with_mean_row(spark.createDataFrame(rows, schema), "model")


def tree_table(model, spark: SparkSession, names: Sequence[str], values: Sequence = (0, 1)) -> DataFrame:
    """Nodes of a decision tree: id, parent, test, impurity, rows, class counts, class.

    A saved Spark ML tree is a parquet table of nodes; it is read back and shaped.
    """
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    children = (nodes.where(F.col("leftChild") >= 0)
                .select(F.col("id").alias("parent"),
                        F.explode(F.array("leftChild", "rightChild")).alias("id")))
    feature = F.col("split.featureIndex")
    label = F.array(*[F.lit(n) for n in names])
    return nodes.join(children, "id", "left").select(
        "id", "parent",
        F.when(feature >= 0, F.try_element_at(label, feature + 1)).alias("feature"),
        F.when(feature >= 0, F.get(F.col("split.leftCategoriesOrThreshold"), F.lit(0))).alias("threshold"),
        "impurity", F.col("rawCount").alias("n_rows"),
        *[F.get("impurityStats", F.lit(i)).alias(f"n_class_{v}") for i, v in enumerate(values)],
        F.col("prediction").cast("int").alias("class"))
