"""Scalar semantics: titles, maps, rounding, protected division, seeded numbers."""

import math

from pyspark.sql import functions as F

from tablesmith.functions import maps, numeric, seeded, text
from tablesmith.plans import recipes


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


NAMES = ["Drew, Mrs. A", "no dot", None, "Rothes, the Countess. of Q", 'O"Dwyer, Miss. E "Nellie"', "x, Ms. Y"]


def test_title_variants_differ_on_no_match(spark):
    assert column(spark, NAMES, "string", text.word_before_dot) == ["Mrs", None, None, "Countess", "Miss", "Ms"]
    assert column(spark, NAMES[:3], "string", lambda x: text.word_before_dot(x, "")) == ["Mrs", "", None]


def test_split_title_keeps_every_word(spark):
    got = column(spark, NAMES, "string", lambda x: text.between(x, ", ", "."))
    assert got == ["Mrs", None, None, "the Countess", "Miss", "Ms"]


def test_first_contained_finds_mr_inside_mrs(spark):
    got = column(spark, NAMES, "string", lambda x: text.first_contained(x, recipes.SEARCH_TITLES))
    assert got == ["Dr", None, None, "Countess", "Miss", "Ms"]
    assert column(spark, ["Smith, Mrs. A"], "string",
                  lambda x: text.first_contained(x, recipes.SEARCH_TITLES)) == ["Mr"]


def test_merged_titles_have_no_code(spark):
    def code(x):
        return maps.ordinal_or_null(maps.replace_values(x, recipes.MERGED_TITLES), recipes.SEARCH_CODES, default=0)
    assert column(spark, ["Mrs", "Mr", "Master", "Dr", None], "string", code) == [0, 2, 3, 0, 0]


def test_rare_titles_then_spellings(spark):
    got = column(spark, ["Col", "Don", "ColDon", "Mlle", "Mme", "Mr"], "string",
                 lambda x: maps.replace_values(x, recipes.TITLE_RULES))
    assert got == ["Rare", "Rare", "ColDon", "Miss", "Mrs", "Mr"]


def test_unmapped_values_keep_null_or_fail(spark):
    codes = {"S": 0, "C": 1}
    assert column(spark, ["S", "x", None], "string", lambda x: maps.ordinal_or_keep(x, codes)) == ["0", "x", None]
    assert column(spark, ["S", "x", None], "string", lambda x: maps.ordinal_or_null(x, codes)) == [0, None, None]
    try:
        column(spark, ["x"], "string", lambda x: maps.ordinal_strict(x, codes))
    except Exception as error:
        assert "CAST_INVALID_INPUT" in str(error)
    else:
        raise AssertionError("an unknown key must fail")


def test_lookup_takes_int_and_long_keys(spark):
    assert column(spark, [1, 2, 9], "bigint", lambda x: maps.lookup(x, {1: "a", 2: "b"})) == ["a", "b", None]


def test_half_even(spark):
    assert column(spark, [0.5, 1.5, 2.5, -0.5], "double", numeric.half_even) == [0.0, 2.0, 2.0, 0.0]


def test_nearest_half(spark):
    assert column(spark, [27.24, 27.25, 0.2, None], "double", numeric.to_half) == [27.0, 27.5, 0.0, None]


def test_protected_div(spark):
    df = spark.createDataFrame([(4.0, 2.0), (4.0, 0.0), (0.0, 0.0)], "a double, b double")
    assert [r[0] for r in df.select(numeric.protected_div(F.col("a"), F.col("b"))).collect()] == [2.0, 1.0, 1.0]


def test_negative_score_decides_for_one(spark):
    assert column(spark, [-3.0, 3.0, -1000.0, 1000.0], "double", numeric.reversed_logistic) == [1.0, 0.0, 1.0, 0.0]


def test_expression_tree(spark):
    df = spark.createDataFrame([(2.0, 0.0)], "a double, b double")
    tree = ("add", ("div", "a", "b"), ("max", ("sin", "b"), -1.5))
    assert df.select(numeric.expression(tree)).first()[0] == 1.0


def test_scramble_is_a_bijection_and_spreads(spark):
    df = spark.range(20000).select(seeded.scramble(F.col("id"), 5).alias("h"), seeded.uniform(F.col("id"), 5).alias("u"))
    row = df.agg(F.count_distinct("h"), F.avg("u"), F.min("u"), F.max("u")).first()
    assert row[0] == 20000 and abs(row[1] - 0.5) < 0.01 and row[2] >= 0 and row[3] < 1
    big = spark.range(1).select(seeded.scramble(F.lit(2 ** 62), 3)).first()[0]
    assert 0 <= big < 2 ** 31


def test_uniform_int_stays_in_band(spark):
    got = spark.range(5000).select(seeded.uniform_int(F.col("id"), F.lit(15.7), F.lit(43.2)).alias("v"))
    row = got.agg(F.min("v"), F.max("v"), F.count_distinct("v")).first()
    assert tuple(row) == (15, 42, 28)
    assert not math.isnan(row[0])
