"""Scores of predictions against known answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tablesmith.operators.ordering import cumulative


def accuracy(df: DataFrame, prediction: str, label: str) -> DataFrame:
    """Share of rows whose prediction equals the label, and the rounded percent."""
    hit = (F.col(prediction) == F.col(label)).cast("double")
    return df.agg(F.avg(hit).alias("accuracy"), F.round(F.avg(hit) * 100, 2).alias("percent"),
                  F.count(F.lit(1)).alias("n"))


def confusion(df: DataFrame, prediction: str, label: str) -> DataFrame:
    return df.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n"))


def classification_report(df: DataFrame, prediction: str, label: str) -> DataFrame:
    """Per class precision, recall, F1 and support, then accuracy, macro and weighted rows.

    Everything after the first aggregate works on one row per (label, prediction) pair.
    """
    cells = confusion(df, prediction, label)
    sides = F.array(
        F.struct(F.col(label).alias("c"), F.lit(1).alias("t"), F.lit(0).alias("p")),
        F.struct(F.col(prediction).alias("c"), F.lit(0).alias("t"), F.lit(1).alias("p")))
    both = (cells.withColumn("hit", (F.col(label) == F.col(prediction)).cast("int"))
            .select(F.explode(sides).alias("s"), "n", "hit"))
    per = (both.groupBy(F.col("s.c").cast("string").alias("class")).agg(
        F.sum(F.col("n") * F.col("s.t")).alias("support"),
        F.sum(F.col("n") * F.col("s.p")).alias("claimed"),
        F.sum(F.col("n") * F.col("s.t") * F.col("hit")).alias("hits"))
        .withColumn("precision", F.coalesce(F.try_divide("hits", "claimed"), F.lit(0.0)))
        .withColumn("recall", F.coalesce(F.try_divide("hits", "support"), F.lit(0.0)))
        .withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"),
                                                  F.col("precision") + F.col("recall")), F.lit(0.0))))
    scores = ["precision", "recall", "f1"]
    share = F.sum("hits") / F.sum("support")

    def line(name: str, values):
        return F.struct(F.lit(name).alias("class"), *[v.alias(c) for c, v in zip(scores, values)],
                        F.sum("support").alias("support"))

    # all three summary rows come out of one pass over the per-class rows
    summary = per.agg(F.array(
        line("accuracy", [share] * 3), line("macro avg", [F.avg(c) for c in scores]),
        line("weighted avg", [F.sum(F.col(c) * F.col("support")) / F.sum("support") for c in scores])
    ).alias("lines")).select(F.inline("lines"))
    return per.select("class", *scores, "support").unionByName(summary)


def roc_auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Area under the ROC curve with tied scores at their average rank; null if one class.

    Rows collapse to one per distinct score before anything is ordered, and the ordering
    is range-partitioned, so no task sees all scores.
    """
    per = (df.where(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(score)
           .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("pos")))
    ranked = cumulative(per, [], [score], "n")
    middle = F.col("before") + (F.col("n") + 1) / 2.0
    sums = ranked.agg(F.sum(middle * F.col("pos")).alias("r"), F.sum("pos").cast("double").alias("p"),
                      F.sum("n").cast("double").alias("n"))
    negative = F.col("n") - F.col("p")
    area = F.try_divide(F.col("r") - F.col("p") * (F.col("p") + 1) / 2.0, F.col("p") * negative)
    return sums.select(area.alias("auc"), F.col("p").cast("long").alias("n_positive"),
                       negative.cast("long").alias("n_negative"))
