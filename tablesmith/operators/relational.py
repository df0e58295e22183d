"""Projections, stacking, keyed joins and group look-ups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tablesmith.session import durable

# A group is hot when it holds at least 1/HOT_SHARE of all rows, so there can be at most
# HOT_SHARE hot groups however large the table is.
HOT_SHARE = 1000
# Look-up tables of at most this many bytes are broadcast.
BROADCAST_BYTES = 32 * 1024 * 1024


def update_where(df: DataFrame, column: str, mask: Column, value) -> DataFrame:
    """Masked assignment; a null mask leaves the value alone."""
    new = value if isinstance(value, Column) else F.lit(value)
    return df.withColumn(column, F.when(mask, new).otherwise(F.col(column)))


def cast_all(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    return df.withColumns({name: F.col(name).cast(t) for name, t in types.items()})


def matches(**equal) -> Column:
    """Conjunction of equality tests."""
    return reduce(lambda a, b: a & b, [F.col(c) == F.lit(v) for c, v in equal.items()])


def union_sorted(first: DataFrame, second: DataFrame) -> DataFrame:
    """Stack two tables: absent columns become null, columns in alphabetical order."""
    stacked = first.unionByName(second, allowMissingColumns=True)
    return stacked.select(*sorted(stacked.columns))


def split_back(df: DataFrame, split: str, label: str) -> tuple[DataFrame, DataFrame]:
    """(train rows, test rows without the label)."""
    return (df.where(F.col(split) == "train"), df.where(F.col(split) == "test").drop(label))


def side_by_side(blocks: Sequence[DataFrame], key: str) -> DataFrame:
    """Column blocks of the same rows, matched by key instead of position."""
    return reduce(lambda a, b: a.join(b, key), blocks)


def align_predictions(predictions: DataFrame, solution: DataFrame, key: str) -> DataFrame:
    """Predictions next to the truth, plus which side each unmatched key is missing from."""
    joined = (predictions.withColumn("_p", F.lit(1))
              .join(solution.withColumn("_s", F.lit(1)), key, "full"))
    status = (F.when(F.col("_p").isNull(), "no_prediction")
              .when(F.col("_s").isNull(), "no_solution").otherwise("matched"))
    return joined.withColumn("status", status).drop("_p", "_s")


def group_sizes(df: DataFrame, keys: Sequence[str], output: str) -> DataFrame:
    """Rows per group, null keys left out, combined on the map side."""
    rows = df
    for key in keys:
        rows = rows.where(F.col(key).isNotNull())
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(output))


def table_bytes(df: DataFrame) -> tuple[int, dict]:
    """(row count, {column: total bytes}): text and binary measured, nested values and vectors by
    four times their text (a digit may stand for a long), other values taken as 16."""
    def width(name: str, kind: str) -> Column:
        if kind in ("string", "binary"):
            return F.octet_length(name)
        if kind.startswith(("array", "map", "struct", "vector", "udt", "char", "varchar", "variant")):
            return F.octet_length(F.col(name).cast("string")) * 4 + 16
        return F.lit(16)

    sizes = {n: F.coalesce(F.sum(width(n, t).cast("long")), F.lit(0)) for n, t in df.dtypes}
    row = df.agg(F.count(F.lit(1)).alias("_count"), *[e.alias(n) for n, e in sizes.items()]).first()
    return row["_count"], {n: row[n] for n in df.columns}


def attach(df: DataFrame, groups: DataFrame, keys: Sequence[str], size: str, spread_by: Sequence[str],
           broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Left-join per-group values to rows without letting a large group meet in one task.

    ``groups`` has one row per key and its row count in ``size``. It is written once to the
    shared folder and measured. Up to ``broadcast_bytes`` it is broadcast and the rows stay
    where they are. A larger one goes through an equi-join on the key and a salt. A group that
    holds at least 1/HOT_SHARE of all rows is repeated under one salt per such share, and a hash
    of ``spread_by`` picks the salt of a row; the only thing broadcast are the key hashes and salt counts
    of these groups, at most HOT_SHARE rows of two numbers. Rows with a null key match nothing
    and spread evenly.
    """
    values = [c for c in groups.columns if c not in keys and c != size]
    groups = durable(groups)
    n_groups, n_bytes = table_bytes(groups)
    if sum(n_bytes.values()) <= broadcast_bytes:
        return df.join(F.broadcast(groups.drop(size)), list(keys), "left").select(*df.columns, *values)
    n_rows = groups.agg(F.sum(size)).first()[0]
    share = F.col(size) * HOT_SHARE / F.lit(n_rows)
    groups = groups.withColumns({k: F.col(k).cast(df.schema[k].dataType) for k in keys})  # equal values, equal hashes
    name = F.xxhash64(*keys)
    marks = F.broadcast(groups.where(share >= 1).groupBy(name.alias("_name")).agg(F.max(F.ceil(share)).alias("_salts")))
    salts = F.coalesce("_salts", F.lit(1).cast("long"))
    salted = (groups.withColumn("_name", name).join(marks, "_name", "left")
              .withColumn("_spread", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)))
              .select(*keys, "_spread", F.struct(*values).alias("_found")))
    apart = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    turn = F.xxhash64(*spread_by)
    return (df.withColumn("_name", name).join(marks, "_name", "left")
            .withColumn("_spread", F.when(apart, -1 - F.pmod(turn, F.lit(1 << 40))).otherwise(F.pmod(turn, salts)))
            .join(salted, [*keys, "_spread"], "left")
            .select(*df.columns, *[F.col("_found")[v].alias(v) for v in values]))


def attach_group_count(df: DataFrame, keys: Sequence[str], output: str, key: str,
                       source: DataFrame | None = None) -> DataFrame:
    """Group size on every row (null for a null group key).

    ``source`` counts another table with the same keys, e.g. the raw input of a long plan.
    """
    rows = df if source is None else source
    sizes = group_sizes(rows, keys, "_size").withColumn(output, F.col("_size"))
    return attach(df, sizes, keys, "_size", [key])
