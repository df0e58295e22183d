"""Folds and random splits as narrow columns.

Row sets are never materialised or shuffled: a split is a comparison of the row's key, or
of a hash of it, with a few boundaries found beforehand.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tablesmith.functions.seeded import MODULUS, scramble, uniform
from tablesmith.operators.ordering import positions


def fold_bounds(df: DataFrame, key: str, k: int) -> list:
    """Smallest key of folds 1..k-1 when keys are cut into k contiguous runs.

    The first n mod k folds have one row more. Only the key column is sorted.
    """
    ranked = positions(df.select(key), [], [key], "_position", "_rows")
    size, extra = F.floor(F.col("_rows") / k), F.pmod(F.col("_rows"), F.lit(k))
    starts = F.array(*[size * i + F.least(F.lit(i), extra) for i in range(1, k)])
    rows = ranked.where(F.array_contains(starts, F.col("_position"))).select(key).collect()
    return sorted(r[0] for r in rows)


def contiguous_fold(df: DataFrame, key: str, k: int, output: str = "fold") -> DataFrame:
    """K contiguous folds by key."""
    bounds = fold_bounds(df, key, k)
    fold = sum(((F.col(key) >= F.lit(b)).cast("int") for b in bounds), F.lit(0))
    return df.withColumn(output, fold)


def _boundaries(df: DataFrame, key: str, seeds: Sequence[int], counts: Sequence[int], n: int) -> dict:
    """(hash, key) at the given positions of the hash order, for every seed.

    A hash is uniform, so position p lies near p/n of its range. One pass counts what is
    below a narrow window around that point, a second orders only the window's rows. The
    counts prove the answer; a window that misses is widened to the whole range.
    """
    targets = [(s, c) for s in seeds for c in counts if 0 < c < n]

    def window(c: int, wide: bool) -> tuple[int, int]:
        if wide:
            return 0, MODULUS
        slack = 8 * math.sqrt(c * (1 - c / n)) / n * MODULUS + 1
        middle = c / n * MODULUS
        return max(0, int(middle - slack)), min(MODULUS, int(middle + slack) + 1)

    # one hash column per seed, computed once per row and used by all its targets
    hashed = df.select(F.col(key).alias("k"), *[scramble(F.col(key), s).alias(f"h{s}") for s in seeds])
    found, wide = {}, set()
    while targets:
        frame = {t: window(t[1], t in wide) for t in targets}
        below = hashed.agg(*[F.count_if(F.col(f"h{s}") < frame[(s, c)][0]).alias(f"b{i}")
                             for i, (s, c) in enumerate(targets)]).first()
        near = F.array(*[
            F.when((F.col(f"h{s}") >= frame[(s, c)][0]) & (F.col(f"h{s}") < frame[(s, c)][1]),
                   F.struct(F.lit(i).alias("t"), F.col(f"h{s}").alias("h")))
            for i, (s, c) in enumerate(targets)])
        rows = hashed.select("k", F.explode(F.array_compact(near)).alias("x")).select("k", "x.*")
        ranked = positions(rows, ["t"], ["h", "k"], "p", "_rows")
        wanted = F.element_at(F.array(*[F.lit(c - below[f"b{i}"]) for i, (s, c) in enumerate(targets)]),
                              F.col("t") + 1)
        for r in ranked.where(F.col("p") == wanted).collect():
            found[targets[r.t]] = (r.h, r.k)
        wide.update(t for t in targets if t not in found)
        targets = [t for t in targets if t not in found]
    return found


def shuffle_roles(df: DataFrame, key: str, draws: int, test_size: float, train_size: float,
                  seed: int = 0) -> list[Column]:
    """For each draw a Column 'test' / 'train' / 'unused' with exact set sizes.

    Sizes are ceil(test_size * n) and floor(train_size * n); rows are ordered by the hash
    of (key, draw). The columns can be used on any table that holds the key.
    """
    n = df.count()
    n_test = math.ceil(round(test_size * n, 9))
    n_train = min(n - n_test, math.floor(round(train_size * n, 9)))
    seeds = [seed + i for i in range(draws)]
    marks = _boundaries(df, key, seeds, sorted({n_test, n_test + n_train}), n)

    def under(s: int, count: int) -> Column:
        if count >= n:
            return F.lit(True)
        if count <= 0:
            return F.lit(False)
        h, k = marks[(s, count)]
        own = F.struct(scramble(F.col(key), s).alias("h"), F.col(key).alias("k"))
        return own < F.struct(F.lit(h).cast("long").alias("h"), F.lit(k).cast(df.schema[key].dataType).alias("k"))

    return [F.when(under(s, n_test), "test").when(under(s, n_test + n_train), "train").otherwise("unused")
            for s in seeds]


def shuffle_split(df: DataFrame, key: str, draws: int = 10, test_size: float = 0.3,
                  train_size: float = 0.6, seed: int = 0, prefix: str = "draw_") -> DataFrame:
    """Independent random draws, one role column per draw."""
    roles = shuffle_roles(df, key, draws, test_size, train_size, seed)
    return df.withColumns({f"{prefix}{i}": role for i, role in enumerate(roles)})


def holdout(df: DataFrame, key: str, test_size: float = 0.25, seed: int = 0, output: str = "part") -> DataFrame:
    """One train / test split of exact size."""
    return df.withColumn(output, shuffle_roles(df, key, 1, test_size, 1 - test_size, seed)[0])


def poisson_steps() -> list[float]:
    """Distribution function of Poisson(1) up to the last value that a 31-bit draw can reach."""
    mass, total, steps = math.exp(-1.0), 0.0, []
    while total < 1.0 - 0.5 / MODULUS:
        total += mass
        mass /= len(steps) + 1
        steps.append(total)
    return steps


def bootstrap_weight(key: Column, bag: int | Column, seed: int = 0) -> Column:
    """How often a row is drawn into a bag: Poisson(1), the limit of drawing n of n rows.

    Inverse distribution function of the key's hash; rows are weighted, not copied.
    """
    u = uniform(key, bag if not isinstance(bag, int) else seed + bag)
    chain, steps = None, poisson_steps()
    for count, total in enumerate(steps):
        test = u < F.lit(total)
        chain = F.when(test, count) if chain is None else chain.when(test, count)
    return chain.when(u.isNotNull(), len(steps))
