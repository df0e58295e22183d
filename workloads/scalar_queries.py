"""Scalar functions over text and numbers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablesmith.functions import maps, numeric, text
from tablesmith.plans import recipes as fixed
from workloads.base import M, manifest, query, r6, sql_list, table

TITLE = "regexp_extract(name, ' ([A-Za-z]+)\\.', 1)"


def case_sql(column: str, mapping: dict, otherwise: str = "NULL") -> str:
    def lit(v):
        return f"'{v}'" if isinstance(v, str) else str(v)
    arms = " ".join(f"WHEN {column} = {lit(k)} THEN {lit(v)}" for k, v in mapping.items())
    return f"CASE {arms} ELSE {otherwise} END"


def common_title_sql(title: str) -> str:
    return (f"CASE WHEN {title} IN ({sql_list(fixed.RARE_TITLES)}) THEN 'Rare' "
            f"WHEN {title} IN ('Mlle', 'Ms') THEN 'Miss' WHEN {title} = 'Mme' THEN 'Mrs' ELSE {title} END")


def contained_sql(column: str) -> str:
    arms = " ".join(f"WHEN contains({column}, '{t}') THEN '{t}'" for t in fixed.SEARCH_TITLES)
    return f"CASE {arms} END"


@query("str_extract_title", "SELECT doc_id, nullif(regexp_extract(text, ' ([A-Za-z]+)\\.', 1), '') AS title,"
                            " regexp_extract(text, ' ([A-Za-z]+)\\.', 1) AS title_or_empty FROM documents")
def str_extract_title(spark, sf):
    """Whole texts: the first word closed by a dot."""
    return table(spark, sf, "documents").select(
        "doc_id", text.word_before_dot(F.col("text")).alias("title"),
        text.word_before_dot(F.col("text"), missing="").alias("title_or_empty"))


@query("str_split_title", M + """ SELECT id, CASE WHEN contains(name, ', ')
  THEN split_part(split_part(name, ', ', 2), '.', 1) END AS title FROM m""")
def str_split_title(spark, sf):
    return manifest(spark, sf).select("id", text.between(F.col("name"), ", ", ".").alias("title"))


@query("str_first_containing", M + f" SELECT id, {contained_sql('name')} AS title FROM m")
def str_first_containing(spark, sf):
    return manifest(spark, sf).select(
        "id", text.first_contained(F.col("name"), fixed.SEARCH_TITLES).alias("title"))


@query("str_length", "SELECT doc_id, CAST(length(text) AS INTEGER) AS n_chars FROM documents")
def str_length(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.n_chars(F.col("text")).alias("n_chars"))


@query("str_first_char", M + " SELECT id, coalesce(substring(cabin, 1, 1), 'M') AS deck FROM m")
def str_first_char(spark, sf):
    return manifest(spark, sf).select("id", text.initial_or(F.col("cabin"), "M").alias("deck"))


@query("map_replace_list", M + f" SELECT id, {common_title_sql(TITLE)} AS title FROM m")
def map_replace_list(spark, sf):
    title = F.regexp_extract("name", text.TITLE_PATTERN, 1)
    return manifest(spark, sf).select("id", maps.replace_values(title, fixed.TITLE_RULES).alias("title"))


@query("map_merge_levels", M + f""" SELECT id, CASE WHEN substring(cabin, 1, 1) = 'T' THEN 'A'
  ELSE substring(cabin, 1, 1) END AS deck,
  CAST({case_sql("coalesce(substring(cabin, 1, 1), '0')", fixed.DECK_GROUPS)} AS INTEGER) AS deck_group FROM m""")
def map_merge_levels(spark, sf):
    deck = F.substring("cabin", 1, 1)
    return manifest(spark, sf).select(
        "id", maps.replace_values(deck, {"A": ["T"]}).alias("deck"),
        maps.ordinal_or_null(F.coalesce(deck, F.lit("0")), fixed.DECK_GROUPS).alias("deck_group"))


@query("map_to_ordinal_keep", M + f" SELECT id, {case_sql(TITLE, {k: str(v) for k, v in fixed.TITLE_CODES.items()}, TITLE)} AS title FROM m")
def map_to_ordinal_keep(spark, sf):
    title = F.regexp_extract("name", text.TITLE_PATTERN, 1)
    return manifest(spark, sf).select("id", maps.ordinal_or_keep(title, fixed.TITLE_CODES).alias("title"))


@query("map_to_ordinal_null", M + f""" SELECT id, CAST({case_sql(TITLE, fixed.TITLE_CODES)} AS INTEGER) AS code,
  CAST({case_sql(TITLE, fixed.TITLE_CODES, '0')} AS INTEGER) AS code_or_zero FROM m""")
def map_to_ordinal_null(spark, sf):
    title = F.regexp_extract("name", text.TITLE_PATTERN, 1)
    return manifest(spark, sf).select(
        "id", maps.ordinal_or_null(title, fixed.TITLE_CODES).alias("code"),
        maps.ordinal_or_null(title, fixed.TITLE_CODES, default=0).alias("code_or_zero"))


@query("map_other_to_zero", M + """ SELECT id, CAST(sex = 'male' AS INTEGER) AS male,
  CASE WHEN port = 'C' THEN 1 WHEN port = 'Q' THEN 2 ELSE 3 END AS port FROM m""")
def map_other_to_zero(spark, sf):
    return manifest(spark, sf).select(
        "id", maps.equals_flag(F.col("sex"), "male").alias("male"),
        maps.ordinal_or_null(F.col("port"), fixed.PORT_BY_LETTER, default=3).alias("port"))


@query("math_round_half_even", """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
  round_even(l_quantity / CAST(2 AS DOUBLE), 0) AS half FROM lineitem""")
def math_round_half_even(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", numeric.half_even(F.col("l_quantity") / 2).alias("half"))


@query("math_round_to_half", M + """ SELECT id,
  CAST(trunc(fare / CAST(0.5 AS DOUBLE) + 0.5) AS BIGINT) * CAST(0.5 AS DOUBLE) AS fare FROM m""")
def math_round_to_half(spark, sf):
    return manifest(spark, sf).select("id", numeric.to_half(F.col("fare")).alias("fare"))


@query("math_protected_div", """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CASE WHEN l_discount = 0
  THEN CAST(1 AS DOUBLE) ELSE round(l_tax / l_discount, 6) END AS ratio FROM lineitem""")
def math_protected_div(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        r6(numeric.protected_div(F.col("l_tax"), F.col("l_discount"))).alias("ratio"))


@query("math_expression_set", """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
  round(greatest(cos(l_quantity), least(sin(l_tax * l_linenumber), tanh(l_discount - 0.05))) + l_tax * 3.5, 6)
    AS value FROM lineitem""")
def math_expression_set(spark, sf):
    tree = ("add", ("max", ("cos", "l_quantity"), ("min", ("sin", ("mul", "l_tax", "l_linenumber")),
                                                   ("tanh", ("sub", "l_discount", 0.05)))),
            ("mul", "l_tax", 3.5))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", r6(numeric.expression(tree)).alias("value"))


@query("math_logistic_decision", """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
  CAST(round_even(1 - 1 / (1 + exp(-(l_quantity - 25))), 0) AS INTEGER) AS decision FROM lineitem""")
def math_logistic_decision(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        numeric.reversed_logistic(F.col("l_quantity") - 25).cast("int").alias("decision"))


@query("null_is", M + """ SELECT id, CAST(age IS NULL AS INTEGER) AS no_age,
  CAST(port IS NOT NULL AS INTEGER) AS has_port FROM m""")
def null_is(spark, sf):
    return manifest(spark, sf).select("id", F.col("age").isNull().cast("int").alias("no_age"),
                                      F.col("port").isNotNull().cast("int").alias("has_port"))
