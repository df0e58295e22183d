"""Registration, table access and the passenger-shaped view of the orders table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tablesmith.functions.seeded import HIGH_BITS, LAST_SHIFT, MODULUS, ROUNDS, SEED_STEPS
from tablesmith.plans.recipes import Roles
from tablesmith.sources.files import read_table


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register ``run(spark, sf_dir)`` under a name, with its SQL if there is an exact one."""
    def keep(run):
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = Query(run, sql)
        return run
    return keep


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_table(spark, sf, name)


def r6(column) -> Column:
    """Doubles are compared to six decimals: sums depend on the order of addition."""
    return F.round(column, 6)


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: r6(F.col(n).cast("double")) for n in names})


# Forty titles, picked by customer key; women's titles decide the sex column.
TITLES = (["Mr"] * 16 + ["Miss"] * 8 + ["Mrs"] * 6 + ["Master"] * 2
          + ["Dr", "Rev", "Col", "Major", "Mlle", "Mme", "Ms", "Countess"])
WOMEN = ["Miss", "Mrs", "Mlle", "Mme", "Ms", "Countess"]

ROLES = Roles(key="id", label="survived", split="split", pclass="pclass", name="name", sex="sex",
              age="age", sibsp="sibsp", parch="parch", ticket="ticket", fare="fare", cabin="cabin",
              port="port")


def manifest(spark: SparkSession, sf: str) -> DataFrame:
    """One row per order, in the shape of the passenger files; gaps are placed by key."""
    order, customer = F.col("o_orderkey"), F.col("o_custkey")
    titles = F.array(*[F.lit(t) for t in TITLES])
    title = F.when(order % 2000 == 7, "Jonkheer").otherwise(
        F.element_at(titles, (customer % 40).cast("int") + 1))
    priority = F.substring("o_orderpriority", 1, 1).cast("int")
    train = order % 10 < 7
    died = (F.col("o_orderstatus") == "F").cast("int")
    return (table(spark, sf, "orders")
            .withColumn("_title", title)
            .select(
                order.alias("id"),
                F.when(train, "train").otherwise("test").alias("split"),
                F.when(train, died).alias("survived"),
                died.alias("truth"),
                F.floor((priority + 1) / 2).cast("int").alias("pclass"),
                F.when(order % 89 == 0, F.concat(F.lit("Unnamed "), order.cast("string")))
                .otherwise(F.concat(F.lit("Customer "), customer.cast("string"), F.lit(", "), "_title",
                                    F.lit('. "Order" '), order.cast("string"))).alias("name"),
                F.when(F.col("_title").isin(*WOMEN), "female").otherwise("male").alias("sex"),
                F.when(order % 5 != 0, ((customer * 7 + order * 13) % 160) / 2.0).alias("age"),
                (customer % 4).cast("int").alias("sibsp"),
                (order % 3).cast("int").alias("parch"),
                F.concat(F.lit("T"), customer.cast("string")).alias("ticket"),
                F.when(order % 41 != 0, F.col("o_totalprice") / 3000.0).alias("fare"),
                F.when(order % 4 == 0, F.concat(
                    F.substring(F.lit("ABCDEFGT"), (customer % 8).cast("int") + 1, F.lit(1)),
                    (order % 100).cast("string"))).alias("cabin"),
                F.when(order % 97 == 0, None).when(customer % 7 < 4, "S").when(customer % 7 < 6, "C")
                .otherwise("Q").alias("port")))


def sql_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


# Opens every manifest query: follow with " SELECT ..." or ", more AS (...) SELECT ...".
M = f"""WITH m0 AS (
  SELECT *, CASE WHEN o_orderkey % 2000 = 7 THEN 'Jonkheer'
    ELSE ([{sql_list(TITLES)}])[CAST(o_custkey % 40 AS INTEGER) + 1] END AS t FROM orders),
m AS (
  SELECT o_orderkey AS id,
    CASE WHEN o_orderkey % 10 < 7 THEN 'train' ELSE 'test' END AS split,
    CASE WHEN o_orderkey % 10 < 7 THEN CAST(o_orderstatus = 'F' AS INTEGER) END AS survived,
    CAST(o_orderstatus = 'F' AS INTEGER) AS truth,
    CAST((CAST(substring(o_orderpriority, 1, 1) AS INTEGER) + 1) // 2 AS INTEGER) AS pclass,
    CASE WHEN o_orderkey % 89 = 0 THEN 'Unnamed ' || CAST(o_orderkey AS VARCHAR)
      ELSE 'Customer ' || CAST(o_custkey AS VARCHAR) || ', ' || t || '. "Order" '
        || CAST(o_orderkey AS VARCHAR) END AS name,
    CASE WHEN t IN ({sql_list(WOMEN)}) THEN 'female' ELSE 'male' END AS sex,
    CASE WHEN o_orderkey % 5 <> 0
      THEN CAST((o_custkey * 7 + o_orderkey * 13) % 160 AS DOUBLE) / CAST(2 AS DOUBLE) END AS age,
    CAST(o_custkey % 4 AS INTEGER) AS sibsp,
    CAST(o_orderkey % 3 AS INTEGER) AS parch,
    'T' || CAST(o_custkey AS VARCHAR) AS ticket,
    CASE WHEN o_orderkey % 41 <> 0 THEN o_totalprice / CAST(3000 AS DOUBLE) END AS fare,
    CASE WHEN o_orderkey % 4 = 0 THEN substring('ABCDEFGT', CAST(o_custkey % 8 AS INTEGER) + 1, 1)
      || CAST(o_orderkey % 100 AS VARCHAR) END AS cabin,
    CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_custkey % 7 < 4 THEN 'S'
      WHEN o_custkey % 7 < 6 THEN 'C' ELSE 'Q' END AS port
  FROM m0)"""


def scramble_sql(key: str, seed: str | int = 0) -> str:
    """SQL twin of ``tablesmith.functions.seeded.scramble``."""
    mask = MODULUS - 1
    high = f"(((({key}) >> 31) & {mask}) * {HIGH_BITS[0]} + ((({key}) >> 62) & 3) * {HIGH_BITS[1]})"
    x = f"(({key}) & {mask})"
    for i, ((shift, factor), (step, start)) in enumerate(zip(ROUNDS, SEED_STEPS)):
        own = (int(seed) % MODULUS * step + start) & mask if isinstance(seed, int) \
            else f"((CAST({seed} AS BIGINT) % {MODULUS} * {step} + {start}) & {mask})"
        x = f"(({x} + {own}{f' + ({high} & {mask})' if i == 1 else ''}) & {mask})"
        x = f"((xor({x}, {x} >> {shift}) * {factor}) & {mask})"
    return f"xor({x}, {x} >> {LAST_SHIFT})"


def uniform_sql(key: str, seed: str | int = 0) -> str:
    return f"({scramble_sql(key, seed)} / CAST({MODULUS} AS DOUBLE))"
