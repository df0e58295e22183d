"""Number functions: rounding rules, protected division, candidate expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def half_even(x: Column) -> Column:
    """Nearest integer, halves go to the even neighbour."""
    return F.bround(x, 0)


def to_half(x: Column) -> Column:
    """Nearest multiple of 0.5 for non-negative input (halfway goes up)."""
    return (x / 0.5 + 0.5).cast("long") * F.lit(0.5)


def protected_div(left: Column, right: Column) -> Column:
    """Quotient, or 1 where the divisor is zero."""
    return F.when(right == 0, F.lit(1.0)).otherwise(left.cast("double") / F.nullif(right, F.lit(0)))


def reversed_logistic(score: Column) -> Column:
    """``round(1 - sigmoid(score))``: a negative score decides for class 1."""
    return half_even(1.0 - 1.0 / (1.0 + F.exp(-score)))


# The operations a candidate expression may use, by name.
PRIMITIVES = {
    "add": lambda a, b: a + b,
    "sub": lambda a, b: a - b,
    "mul": lambda a, b: a * b,
    "div": protected_div,
    "cos": F.cos,
    "sin": F.sin,
    "tanh": F.tanh,
    "max": F.greatest,
    "min": F.least,
}


def expression(tree) -> Column:
    """Column for a nested tuple ``(name, arg, ...)`` over column names and constants."""
    if isinstance(tree, str):
        return F.col(tree).cast("double")
    if isinstance(tree, (int, float)):
        return F.lit(float(tree))
    name, *arguments = tree
    return PRIMITIVES[name](*[expression(argument) for argument in arguments])
