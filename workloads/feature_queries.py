"""Bins, codes, scaling and the five feature plans."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tablesmith.operators import binning, encode
from tablesmith.plans import features, recipes as fixed
from workloads.base import M, ROLES, manifest, query, rounded, sql_list, table
from workloads.impute_queries import BAND_SQL, RANDOM_AGE_SQL
from workloads.scalar_queries import TITLE, case_sql, common_title_sql, contained_sql


def band_sql(x: str, edges) -> str:
    arms = " ".join(f"WHEN {x} <= {e} THEN {i}" for i, e in enumerate(edges))
    return f"CASE WHEN {x} IS NULL THEN NULL {arms} ELSE {len(edges)} END"


def int_case(column: str, mapping: dict, otherwise: str = "NULL") -> str:
    return f"CAST({case_sql(column, mapping, otherwise)} AS INTEGER)"


def width_sql(x: str, lo: str, hi: str, n: int) -> str:
    return band_sql(x, [f"{lo} + ({hi} - {lo}) * {i} / {n}" for i in range(1, n)])


@query("bin_equal_width", f"""WITH e AS (SELECT CAST(min(p_size) AS DOUBLE) AS lo, CAST(max(p_size) AS DOUBLE) AS hi
  FROM part) SELECT p_partkey, {width_sql('p_size', 'lo', 'hi', 5)} AS band FROM part, e""")
def bin_equal_width(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", "p_size")
    return binning.equal_width(rows, "p_size", 5, "band", "union").select("p_partkey", "band")


@query("bin_quantile", """WITH e AS (SELECT quantile_cont(o_totalprice, 0.25) AS a, quantile_cont(o_totalprice, 0.5) AS b,
  quantile_cont(o_totalprice, 0.75) AS c FROM orders) SELECT o_orderkey, CASE WHEN o_totalprice <= a THEN 0
  WHEN o_totalprice <= b THEN 1 WHEN o_totalprice <= c THEN 2 ELSE 3 END AS band FROM orders, e""")
def bin_quantile(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return binning.equal_frequency(rows, "o_totalprice", 4, "band", "union").select("o_orderkey", "band")


@query("bin_fixed_edges", M + f""" SELECT id, {band_sql('age', fixed.AGE_EDGES)} AS age_band,
  {band_sql('age', fixed.AGE_EDGES_FINE)} AS age_band_fine, {band_sql('fare', fixed.FARE_EDGES)} AS fare_band,
  {band_sql('fare', fixed.FARE_EDGES_WIDE)} AS fare_band_wide FROM m""")
def bin_fixed_edges(spark, sf):
    return manifest(spark, sf).select(
        "id", binning.band(F.col("age"), fixed.AGE_EDGES).alias("age_band"),
        binning.band(F.col("age"), fixed.AGE_EDGES_FINE).alias("age_band_fine"),
        binning.band(F.col("fare"), fixed.FARE_EDGES).alias("fare_band"),
        binning.band(F.col("fare"), fixed.FARE_EDGES_WIDE).alias("fare_band_wide"))


def code_sql(column: str, split: str = "split") -> str:
    return (f"CASE WHEN {column} IS NOT NULL THEN CAST(dense_rank() OVER (PARTITION BY {split}, {column} IS NULL "
            f"ORDER BY {column}) - 1 AS INTEGER) END")


@query("encode_label_codes", M + f""" SELECT id, {code_sql('sex')} AS sex_code, {code_sql('port')} AS port_code,
  {code_sql('pclass')} AS class_code FROM m""")
def encode_label_codes(spark, sf):
    rows = manifest(spark, sf).select("id", "split", "sex", "port", "pclass")
    rows = encode.label_codes(rows, {"sex": "sex_code", "port": "port_code", "pclass": "class_code"}, "id", ["split"])
    return rows.select("id", "sex_code", "port_code", "class_code")


def flag_sql(column: str, value, name: str) -> str:
    shown = f"'{value}'" if isinstance(value, str) else value
    return f'CAST(coalesce({column} = {shown}, false) AS INTEGER) AS "{name}"'


@query("encode_dummies", M + " SELECT id, age, " + ", ".join(
    [flag_sql("port", p, f"port_{p}") for p in "CQS"]
    + [flag_sql("sex", s, f"sex_{s}") for s in ("female", "male")]) + " FROM m")
def encode_dummies(spark, sf):
    return encode.dummies(manifest(spark, sf).select("id", "age", "port", "sex"), ["port", "sex"])


@query("encode_one_hot_numbered", M + " SELECT id, port, pclass, " + ", ".join(
    [flag_sql("port", p, f"port_{i}") for i, p in enumerate("CQS", 1)]
    + [flag_sql("pclass", c, f"pclass_{c}") for c in (1, 2, 3)]) + " FROM m")
def encode_one_hot_numbered(spark, sf):
    return encode.dummies(manifest(spark, sf).select("id", "port", "pclass"), ["port", "pclass"],
                          numbered=True, keep=True)


@query("scale_min_max", """SELECT p_partkey,
  round((p_size - min(p_size) OVER ()) / CAST(max(p_size) OVER () - min(p_size) OVER () AS DOUBLE), 6) AS p_size,
  round((p_retailprice - min(p_retailprice) OVER ()) / (max(p_retailprice) OVER () - min(p_retailprice) OVER ()), 6)
    AS p_retailprice FROM part""")
def scale_min_max(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    return rounded(encode.min_max(rows, ["p_size", "p_retailprice"]), "p_size", "p_retailprice")


@query("assemble_features", """SELECT l_orderkey * 8 + l_linenumber AS id, CAST(l_returnflag = 'R' AS DOUBLE) AS label,
  l_quantity AS f1, l_discount AS f2, l_tax AS f3 FROM lineitem""")
def assemble_features(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
        (F.col("l_returnflag") == "R").cast("int").alias("returned"), "l_quantity", "l_discount", "l_tax")
    packed = encode.assemble(rows, ["l_quantity", "l_discount", "l_tax"], "id", "returned")
    values = vector_to_array("features")
    return packed.select("id", "label", *[values[i].alias(f"f{i + 1}") for i in range(3)])


@query("collapse_rare_levels", M + """, t AS (SELECT *, CASE WHEN contains(name, ', ')
  THEN split_part(split_part(name, ', ', 2), '.', 1) END AS title FROM m WHERE split = 'train')
SELECT id, CASE WHEN title IS NULL THEN NULL WHEN count(*) OVER (PARTITION BY title) < 10 THEN 'Misc'
  ELSE title END AS title FROM t""")
def collapse_rare_levels(spark, sf):
    rows = manifest(spark, sf).where("split = 'train'").select(
        "id", features.between(F.col("name"), ", ", ".").alias("title"))
    return encode.collapse_rare(rows, "title", "id", 10)


FAMILY = "sibsp + parch + 1"
MODE_PORT = """(SELECT port FROM m WHERE split = 'train' AND port IS NOT NULL
  GROUP BY port ORDER BY count(*) DESC, port LIMIT 1)"""


@query("pipe_basic", M + BAND_SQL + f""", f AS (SELECT *, nullif({TITLE}, '') AS t0,
    median(fare) OVER (PARTITION BY split) AS fare_median FROM m JOIN b USING (split)),
g AS (SELECT *, {common_title_sql('t0')} AS title, CAST(trunc(coalesce(age, {RANDOM_AGE_SQL})) AS INTEGER) AS a,
    coalesce(fare, fare_median) AS fr, coalesce(port, {MODE_PORT}) AS pt FROM f)
SELECT id, split, survived, truth, pclass, CAST(sex = 'female' AS INTEGER) AS sex,
  {band_sql('a', fixed.AGE_EDGES)} AS age, sibsp, parch, {band_sql('fr', fixed.FARE_EDGES)} AS fare,
  {int_case('pt', fixed.PORT_FROM_ZERO)} AS port, {int_case('title', fixed.TITLE_CODES)} AS "Title",
  CAST(length(name) AS INTEGER) AS "nameLen", {FAMILY} AS "FamilySize",
  CAST({FAMILY} = 1 AS INTEGER) AS "IsAlone" FROM g""")
def pipe_basic(spark, sf):
    return features.basic(manifest(spark, sf), ROLES)


ADVANCED = f""", c AS (SELECT median(fare) AS cohort FROM m
    WHERE pclass = 3 AND parch = 0 AND sibsp = 0 AND sex = 'male'),
g AS (SELECT *, coalesce(age, median(age) OVER (PARTITION BY sibsp, pclass)) AS a, coalesce(fare, cohort) AS fr,
    coalesce(port, 'S') AS pt, CASE WHEN substring(cabin, 1, 1) = 'T' THEN 'A'
      ELSE coalesce(substring(cabin, 1, 1), 'M') END AS dk, {common_title_sql(f"nullif({TITLE}, '')")} AS ti,
    count(*) OVER (PARTITION BY split, ticket) AS tf FROM m, c)"""
ADVANCED_TAIL = f"""id, split, survived, truth, pclass, {band_sql('a', fixed.AGE_EDGES_FINE)} AS age, sibsp, parch,
  {band_sql('fr', fixed.FARE_EDGES_WIDE)} AS fare, tf AS "ticketFreq", {FAMILY} AS "FamilySize",
  CAST({FAMILY} = 1 AND tf = 1 AS INTEGER) AS "IsAlone", CAST(length(name) AS INTEGER) AS "nameLen" FROM g"""


@query("pipe_advanced", M + ADVANCED + f""" SELECT CAST(sex = 'female' AS INTEGER) AS sex,
  {int_case('pt', fixed.PORT_FROM_ONE)} AS port, {int_case('dk', fixed.DECK_CODES)} AS "Deck",
  {int_case('ti', fixed.TITLE_CODES)} AS "Title", """ + ADVANCED_TAIL)
def pipe_advanced(spark, sf):
    return features.advanced(manifest(spark, sf), ROLES)


@query("pipe_advanced_one_hot", M + ADVANCED + " SELECT " + ", ".join(
    [flag_sql("dk", d, f"Deck_{d}") for d in "ABCDEFGM"] + [flag_sql("pt", p, f"port_{p}") for p in "CQS"]
    + [flag_sql("sex", s, f"sex_{s}") for s in ("female", "male")]
    + [flag_sql("ti", t, f"Title_{t}") for t in ("Master", "Miss", "Mr", "Mrs", "Rare")])
    + ", " + ADVANCED_TAIL)
def pipe_advanced_one_hot(spark, sf):
    return features.advanced(manifest(spark, sf), ROLES, one_hot=True)


@query("pipe_first_layer", M + BAND_SQL + f""", e AS (SELECT median(fare) AS med FROM m WHERE split = 'train'),
g AS (SELECT *, coalesce(fare, med) AS fr, CAST(trunc(coalesce(age, {RANDOM_AGE_SQL})) AS INTEGER) AS a,
    {common_title_sql(TITLE)} AS ti FROM m JOIN b USING (split), e),
q AS (SELECT quantile_cont(fr, 0.25) AS q1, quantile_cont(fr, 0.5) AS q2, quantile_cont(fr, 0.75) AS q3,
    CAST(min(a) AS DOUBLE) AS lo, CAST(max(a) AS DOUBLE) AS hi FROM g WHERE split = 'train')
SELECT id, split, survived, truth, pclass, CAST(sex = 'male' AS INTEGER) AS sex,
  {band_sql('a', fixed.AGE_EDGES)} AS age, parch, {band_sql('fr', fixed.FARE_EDGES)} AS fare,
  {int_case("coalesce(port, 'S')", fixed.PORT_FROM_ZERO)} AS port, CAST(length(name) AS INTEGER) AS "Name_length",
  CAST(cabin IS NOT NULL AS INTEGER) AS "Has_Cabin", {FAMILY} AS "FamilySize",
  CAST({FAMILY} = 1 AS INTEGER) AS "IsAlone", {int_case('ti', fixed.TITLE_CODES, '0')} AS "Title",
  CASE WHEN fr <= q1 THEN 0 WHEN fr <= q2 THEN 1 WHEN fr <= q3 THEN 2 ELSE 3 END AS "CategoricalFare",
  {width_sql('a', 'q.lo', 'q.hi', 5)} AS "CategoricalAge" FROM g, q""")
def pipe_first_layer(spark, sf):
    return features.first_layer(manifest(spark, sf), ROLES, bands=True)


MODE_PER_SPLIT = """(SELECT port FROM m p WHERE p.split = m.split AND port IS NOT NULL
  GROUP BY port ORDER BY count(*) DESC, port LIMIT 1)"""


@query("pipe_comparison", M + f""", k AS (SELECT split, port AS top FROM (SELECT split, port, row_number() OVER
    (PARTITION BY split ORDER BY count(*) DESC, port) AS rn FROM m WHERE port IS NOT NULL GROUP BY split, port)
    WHERE rn = 1),
g AS (SELECT m.* EXCLUDE (age, fare, port), coalesce(age, median(age) OVER (PARTITION BY split)) AS age,
    coalesce(fare, median(fare) OVER (PARTITION BY split)) AS fare, coalesce(port, top) AS port,
    CASE WHEN contains(name, ', ') THEN split_part(split_part(name, ', ', 2), '.', 1) END AS t0
  FROM m JOIN k USING (split)),
h AS (SELECT *, CAST(trunc(age) AS INTEGER) AS ia,
    CASE WHEN t0 IS NULL THEN NULL WHEN split = 'train' AND count(*) OVER (PARTITION BY split, t0) < 10
      THEN 'Misc' ELSE t0 END AS ti FROM g),
e AS (SELECT split, quantile_cont(fare, 0.25) AS q1, quantile_cont(fare, 0.5) AS q2, quantile_cont(fare, 0.75) AS q3,
    CAST(min(ia) AS DOUBLE) AS lo, CAST(max(ia) AS DOUBLE) AS hi FROM h GROUP BY split),
b AS (SELECT h.*, CASE WHEN fare <= q1 THEN 0 WHEN fare <= q2 THEN 1 WHEN fare <= q3 THEN 2 ELSE 3 END AS fb,
    {width_sql('ia', 'lo', 'hi', 5)} AS ab FROM h JOIN e USING (split))
SELECT id, split, survived, truth, pclass, name, sex, round(age, 6) AS age, sibsp, parch, ticket,
  round(fare, 6) AS fare, cabin, port, {FAMILY} AS "FamilySize", CASE WHEN {FAMILY} > 1 THEN 0 ELSE 1 END AS "IsAlone",
  ti AS "Title", fb AS "FareBin", ab AS "AgeBin", {code_sql('sex')} AS "Sex_Code",
  {code_sql('port')} AS "Embarked_Code", {code_sql('ti')} AS "Title_Code", {code_sql('ab')} AS "AgeBin_Code",
  {code_sql('fb')} AS "FareBin_Code" FROM b""")
def pipe_comparison(spark, sf):
    return rounded(features.comparison(manifest(spark, sf), ROLES), "age", "fare")


def scaled_sql(x: str) -> str:
    return (f"round(({x} - min({x}) OVER ()) / CAST(max({x}) OVER () - min({x}) OVER () AS DOUBLE), 6)")


MUNGE_TITLE = f"""CASE WHEN w IN ({sql_list(fixed.MERGED_TITLES['Miss/Mrs/Ms'])}) THEN 'Miss/Mrs/Ms'
  WHEN w IN ({sql_list(fixed.MERGED_TITLES['Dr/Military/Noble/Clergy'])}) THEN 'Dr/Military/Noble/Clergy' ELSE w END"""


@query("pipe_munge", M + f""", w AS (SELECT *, {contained_sql('name')} AS w FROM m),
t AS (SELECT *, {int_case(f'({MUNGE_TITLE})', fixed.SEARCH_CODES, '0')} AS ti FROM w),
g AS (SELECT id, split, survived, truth, pclass, ti, CAST(ti = 7 AS INTEGER) AS married,
    CASE WHEN sex = 'female' AND pclass = 3 AND port = 'S' AND fare > 8 THEN 0 WHEN sex = 'female' THEN 1
      WHEN sex = 'male' AND ti = 3 THEN 1 ELSE 0 END AS tree,
    CAST(sex = 'male' AS INTEGER) AS sx, {int_case("coalesce(substring(cabin, 1, 1), '0')", fixed.DECK_GROUPS)} AS cb,
    {int_case('port', fixed.PORT_BY_LETTER, '3')} AS pt,
    coalesce(age, median(age) OVER (PARTITION BY sex, pclass)) AS a, sibsp + parch AS rel,
    fare / (SELECT avg({FAMILY}) FROM m) AS fpp,
    coalesce(fare, (SELECT median(fare) FROM m WHERE pclass = 3 AND parch = 0 AND sibsp = 0)) AS fr,
    count(*) OVER (PARTITION BY ticket) AS tf FROM t)
SELECT id, split, survived, truth, pclass, sx AS sex, cb AS cabin, pt AS port, ti AS "Title", married AS "Is_Married",
  tree AS manual_tree, {scaled_sql('rel')} AS "Relatives", {scaled_sql('fpp')} AS "Fare_per_person",
  {scaled_sql('fr')} AS fare, {scaled_sql('a')} AS age, {scaled_sql('tf')} AS "Ticket_Frequency", """ + ", ".join(
    [flag_sql("pclass", c, f"pclass_{c}") for c in (1, 2, 3)]
    + [flag_sql("pt", c, f"port_{c}") for c in (1, 2, 3)]
    + [flag_sql("sx", c, f"sex_{i}") for i, c in enumerate((0, 1), 1)]
    + [flag_sql("cb", c, f"cabin_{i}") for i, c in enumerate((0, 1, 2, 3), 1)]
    + [flag_sql("ti", c, f"Title_{i}") for i, c in enumerate((0, 2, 3, 13), 1)]
    + [flag_sql("tree", c, f"manual_tree_{i}") for i, c in enumerate((0, 1), 1)]
    + [flag_sql("married", 0, "Is_Married_1")]) + " FROM g")
def pipe_munge(spark, sf):
    return rounded(features.munge(manifest(spark, sf), ROLES), "Relatives", "Fare_per_person", "fare", "age",
                   "Ticket_Frequency")
