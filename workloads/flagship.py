"""The flagship query: a feature plan, the rule tree and its score in one plan."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablesmith.operators import relational
from tablesmith.plans import features
from workloads.base import ROLES, manifest
from workloads.rule_queries import predicted


def flagship(spark, sf):
    """Accuracy of the rule tree by age band and family, next to the engineered features."""
    engineered = features.basic(manifest(spark, sf), ROLES, age="group_median").select("id", "age", "IsAlone")
    joined = relational.side_by_side([predicted(spark, sf), engineered], "id")
    hit = (F.col("pred") == F.col("truth")).cast("double")
    return (joined.groupBy("split", "age", "IsAlone")
            .agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(hit), 6).alias("accuracy"))
            .orderBy("split", "age", "IsAlone"))
