"""Constants learnt from a table, per split or once, and used as literals afterwards.

Learning is one aggregate whose result is one row per split (train, test). The values come
back as Python numbers, as an ML estimator's fit does, and become literals in a narrow
expression, so applying them needs no join and no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

SCOPES = ("train", "union", "per_split")
# A split column names parts of one data set (train, test, ...), not a category.
MAX_SPLITS = 32

Fitted = dict[Any, dict[str, Any]]


def learn(df: DataFrame, statistic: Callable[[DataFrame, list[str]], DataFrame], scope: str = "train",
          split: str = "split", train: str = "train") -> Fitted:
    """``{split value: {name: constant}}``; the split value is None for one shared row.

    scope ``train`` learns on the train rows and serves every row, ``union`` learns on all
    rows, ``per_split`` learns and serves each split on its own.
    """
    if scope not in SCOPES:
        raise ValueError(f"scope must be one of {SCOPES}")
    if scope == "per_split":
        rows = statistic(df.where(F.col(split).isNotNull()), [split]).limit(MAX_SPLITS + 1).collect()
        if len(rows) > MAX_SPLITS:
            raise ValueError(f"{split} has more than {MAX_SPLITS} values")
        return {r[split]: {k: v for k, v in r.asDict().items() if k != split} for r in rows}
    rows = df if scope == "union" else df.where(F.col(split) == train)
    row = statistic(rows, []).first()
    return {None: row.asDict() if row else {}}


def constant(fitted: Fitted, name: str, split: str = "split") -> Column:
    """The learnt constant that applies to a row."""
    return per_split(fitted, lambda values: F.lit(values.get(name)), split)


def per_split(fitted: Fitted, build: Callable[[dict[str, Any]], Column], split: str = "split") -> Column:
    """An expression built from the constants of the row's split."""
    if None in fitted:
        return build(fitted[None])
    chain = None
    for value, constants in sorted(fitted.items()):
        test = F.col(split) == F.lit(value)
        chain = F.when(test, build(constants)) if chain is None else chain.when(test, build(constants))
    return F.lit(None) if chain is None else chain
