"""Categories to numbers, scaling, vector assembly."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from tablesmith.operators.fitted import constant, learn
from tablesmith.operators.ordering import positions
from tablesmith.operators.relational import attach, group_sizes

# Codes of at most this many levels per column travel as literals; more are joined.
LITERAL_LEVELS = 64


def _in_order(values: list) -> list:
    """Values as Spark sorts them: NaN last, text by its bytes."""
    if values and isinstance(values[0], str):
        return sorted(values, key=lambda v: v.encode("utf-8", "surrogatepass"))
    return sorted(values, key=lambda v: (v != v, v))


def _level_rows(df: DataFrame, names: Sequence[str], by: Sequence[str], cap: int | None) -> dict[str, dict | None]:
    """{column: {by values: sorted levels}}; None for a column with more than ``cap`` levels in all.

    Columns of one type share a scan and keep that type. If together they have more than
    their caps, each is looked at by itself.
    """
    rows = df
    for key in by:
        rows = rows.where(F.col(key).isNotNull())
    kinds: dict[str, list[str]] = {}
    for name, kind in df.select(*names).dtypes:
        kinds.setdefault(kind, []).append(name)

    def read(chosen: list[str]) -> list | None:
        pairs = (rows.select(*by, *chosen).unpivot(list(by), list(chosen), "_column", "_value")
                 .where(F.col("_value").isNotNull())
                 .groupBy(*by, "_column", "_value").agg(F.count(F.lit(1)).alias("_n")).drop("_n"))
        found = (pairs if cap is None else pairs.limit(cap * len(chosen) + 1)).collect()
        return None if cap is not None and len(found) > cap * len(chosen) else found

    result: dict[str, dict | None] = {n: {} for n in names}
    for group in kinds.values():
        found = read(group)
        parts = [found] if found is not None else [read([name]) for name in group]
        names_of = [group] if found is not None else [[name] for name in group]
        for chosen, part in zip(names_of, parts):
            for name in chosen:
                own = None if part is None else [r for r in part if r["_column"] == name]
                if own is None or cap is not None and len(own) > cap:
                    result[name] = None
                    continue
                levels_of: dict[tuple, list] = {}
                for *keys, _, value in own:
                    levels_of.setdefault(tuple(keys), []).append(value)
                result[name] = {k: _in_order(v) for k, v in levels_of.items()}
    return result


def _equals(df: DataFrame, name: str, value) -> Column:
    """Whether a column holds a level; the literal takes the column's own type."""
    return F.col(name).eqNullSafe(F.lit(value).cast(df.schema[name].dataType))


def label_codes(df: DataFrame, outputs: Mapping[str, str], key: str, by: Sequence[str] = ("split",),
                literal_limit: int = LITERAL_LEVELS) -> DataFrame:
    """``{column: output}``: rank of a value among the sorted distinct values of its split, from 0.

    A column of up to ``literal_limit`` levels is coded in place by literals that come back from
    one scan. The distinct values of a larger one are ranked range-partitioned and attached. Both
    keep the column's type and order, so the codes are the same.
    """
    known = _level_rows(df, list(outputs), by, literal_limit)
    columns = {}
    for column, output in outputs.items():
        if known[column] is None:
            continue
        kind, chain = df.schema[column].dataType, F.lit(None).cast("int")
        for group, values in known[column].items():
            here = [F.col(k) == F.lit(v) for k, v in zip(by, group)]
            entries = [x for i, v in enumerate(values) for x in (F.lit(v + 0.0 if isinstance(v, float) else v).cast(kind).cast("string"), F.lit(i))]
            # 0.0 and -0.0 are one value and need one text
            own = F.col(column) + F.lit(0.0).cast(kind) if kind.typeName() in ("float", "double") else F.col(column)
            code = F.try_element_at(F.create_map(*entries), own.cast("string"))
            chain = F.when(reduce(lambda a, b: a & b, here, F.lit(True)), code).otherwise(chain)
        columns[output] = chain
    coded = df.withColumns(columns) if columns else df
    for column, output in outputs.items():
        if known[column] is None:
            coded = _wide_label_codes(coded, column, output, key, by)
    return coded


def _wide_label_codes(df: DataFrame, column: str, output: str, key: str, by: Sequence[str]) -> DataFrame:
    keys = [*by, column]
    ranks = positions(group_sizes(df, keys, "_size"), by, [column], "_code", "_levels").drop("_levels")
    return (attach(df, ranks, keys, "_size", [key])
            .withColumn(output, F.col("_code").cast("int")).drop("_code"))


def levels(df: DataFrame, names: Sequence[str], max_levels: int | None = None) -> dict[str, list]:
    """Sorted distinct non-null values of each column, over all rows given.

    They become columns of a plan. ``max_levels`` per column is the caller's own guard; for many
    levels there is ``one_hot_vectors``.
    """
    known = _level_rows(df, names, (), max_levels)
    wide = [n for n in names if known[n] is None]
    if wide:
        raise ValueError(f"{wide} have more than {max_levels} levels; use one_hot_vectors")
    return {n: groups.get((), []) for n, groups in known.items()}


def dummies(df: DataFrame, names: Sequence[str], known: Mapping[str, list] | None = None,
            numbered: bool = False, keep: bool = False) -> DataFrame:
    """One 0/1 column per level; null gives all zeros.

    Columns are called ``col_value``, or ``col_1..col_n`` by sorted value when ``numbered``.
    Levels are taken over every row given, so all splits get the same columns.
    """
    known = known or levels(df, names)
    flags = [(_equals(df, n, v).cast("int").alias(f"{n}_{i if numbered else v}"))
             for n in names for i, v in enumerate(known[n], start=1)]
    rest = [c for c in df.columns if keep or c not in names]
    return df.select(*rest, *flags)


def one_hot_vectors(df: DataFrame, names: Sequence[str], key: str) -> DataFrame:
    """One sparse vector per column instead of one column per level, for any number of levels.

    ``col_vector`` has a place per sorted level over all rows given; null gives all zeros.
    """
    codes = {n: f"_{n}_code" for n in names}
    coded = label_codes(df, codes, key, by=())
    places = coded.agg(*[F.coalesce(F.max(c) + 1, F.lit(0)).alias(n) for n, c in codes.items()]).first()
    # a null takes the place after the last level, which dropLast leaves out of the vector
    coded = coded.withColumns({c: F.coalesce(F.col(c), F.lit(places[n])).cast("double") for n, c in codes.items()})
    sizes = df.sparkSession.createDataFrame(
        [tuple(float(places[n]) for n in names)], [codes[n] for n in names])
    encoder = OneHotEncoder(inputCols=list(codes.values()), outputCols=[f"{n}_vector" for n in names], dropLast=True)
    return encoder.fit(sizes).transform(coded).drop(*codes.values())


def min_max(df: DataFrame, names: Sequence[str], scope: str = "union", split: str = "split") -> DataFrame:
    """(x - min) / (max - min); a constant column becomes 0."""
    def ends(rows, keys):
        return rows.groupBy(*keys).agg(*[f(F.col(n).cast("double")).alias(f"{tag}_{n}")
                                         for n in names for tag, f in (("lo", F.min), ("hi", F.max))])

    fitted = learn(df, ends, scope, split)
    scaled = {}
    for n in names:
        lo, hi = constant(fitted, f"lo_{n}", split), constant(fitted, f"hi_{n}", split)
        shifted = F.col(n).cast("double") - lo
        scaled[n] = F.when(hi == lo, shifted).otherwise(shifted / F.nullif(hi - lo, F.lit(0.0)))
    return df.withColumns(scaled)


def collapse_rare(df: DataFrame, column: str, key: str, minimum: int = 10, other: str = "Misc",
                  by: Sequence[str] = ()) -> DataFrame:
    """Levels with fewer than ``minimum`` rows (per ``by``) become one level."""
    keys = [*by, column]
    sizes = group_sizes(df, keys, "_size").withColumn("_level_rows", F.col("_size"))
    return (attach(df, sizes, keys, "_size", [key])
            .withColumn(column, F.when(F.col("_level_rows") < minimum, F.lit(other)).otherwise(F.col(column)))
            .drop("_level_rows"))


def assemble(df: DataFrame, names: Sequence[str], key: str, label: str | None = None,
             extra: Sequence[str] = ()) -> DataFrame:
    """(key, features, label as double): the table every model is fitted on.

    A null feature fails the job, as a matrix with a missing entry would.
    """
    typed = df.select(key, *extra, *([F.col(label).cast("double").alias("label")] if label else []),
                      *[F.col(n).cast("double").alias(f"_f_{n}") for n in names])
    packer = VectorAssembler(inputCols=[f"_f_{n}" for n in names], outputCol="features",
                             handleInvalid="error")
    return packer.transform(typed).drop(*[f"_f_{n}" for n in names])
