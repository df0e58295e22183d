"""The five feature plans. Input: one stacked table with a split column.

Every learnt value is one small aggregate turned into literals, so a plan is a chain of
narrow expressions; only shared tickets, group medians and high-cardinality codes join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tablesmith.functions.maps import equals_flag, ordinal_or_null, ordinal_strict, replace_values
from tablesmith.functions.text import between, first_contained, initial_or, n_chars, word_before_dot
from tablesmith.operators import binning, encode, impute
from tablesmith.operators.fitted import constant, learn
from tablesmith.operators.relational import attach_group_count
from tablesmith.operators.rules import rule_tree_coded
from tablesmith.plans import recipes as fixed
from tablesmith.plans.recipes import Roles


def family_size(roles: Roles) -> Column:
    return F.col(roles.sibsp) + F.col(roles.parch) + 1


def common_title(title: Column) -> Column:
    return replace_values(title, fixed.TITLE_RULES)


def basic(df: DataFrame, roles: Roles = Roles(), age: str = "random", seed: int = 0) -> DataFrame:
    """Title, name length, sex, age and fare bands, port, family: all integers.

    ``age`` is filled per split by a seeded random band, or by the rounded median of
    (split, sex, class).
    """
    r = roles
    out = df.withColumns({
        "Title": ordinal_strict(common_title(word_before_dot(F.col(r.name))), fixed.TITLE_CODES),
        "nameLen": n_chars(F.col(r.name)),
        r.sex: ordinal_strict(F.col(r.sex), fixed.SEX_FEMALE_ONE)}).drop(r.name)
    if age == "random":
        out = impute.fill_random_band(out, r.age, r.key, "per_split", r.split, seed)
    else:
        out = impute.fill_group_median(out, r.age, [r.split, r.sex, r.pclass], r.key, rounded=True)
    out = impute.fill_median(out, [r.fare], "per_split", r.split)
    out = impute.fill_mode(out, r.port, "train", r.split)
    return out.withColumns({
        r.age: binning.band(F.col(r.age).cast("int"), fixed.AGE_EDGES),
        r.fare: binning.band(F.col(r.fare), fixed.FARE_EDGES),
        r.port: ordinal_strict(F.col(r.port), fixed.PORT_FROM_ZERO),
        "FamilySize": family_size(r),
        "IsAlone": equals_flag(family_size(r), 1)}).drop(r.cabin, r.ticket)


def advanced(df: DataFrame, roles: Roles = Roles(), one_hot: bool = False) -> DataFrame:
    """Group-median ages, cohort-median fares, decks, ticket frequency; ordinal or one-hot."""
    r = roles
    lone_poor_man = ((F.col(r.pclass) == 3) & (F.col(r.parch) == 0) & (F.col(r.sibsp) == 0)
                     & (F.col(r.sex) == "male"))
    fare = impute.cohort_median(df, r.fare, lone_poor_man)
    out = impute.fill_group_median(df, r.age, [r.sibsp, r.pclass], r.key)
    deck = replace_values(initial_or(F.col(r.cabin)), {"A": ["T"]})
    out = out.withColumns({
        r.port: F.coalesce(F.col(r.port), F.lit("S")),
        r.fare: F.coalesce(F.col(r.fare).cast("double"), F.lit(fare).cast("double")),
        "Deck": deck,
        "Title": common_title(word_before_dot(F.col(r.name)))})
    if one_hot:
        out = encode.dummies(out, ["Deck", r.port, r.sex, "Title"])
    else:
        out = out.withColumns({
            r.sex: ordinal_strict(F.col(r.sex), fixed.SEX_FEMALE_ONE),
            r.port: ordinal_strict(F.col(r.port), fixed.PORT_FROM_ONE),
            "Deck": ordinal_strict(F.col("Deck"), fixed.DECK_CODES),
            "Title": ordinal_strict(F.col("Title"), fixed.TITLE_CODES)})
    out = attach_group_count(out, [r.split, r.ticket], "ticketFreq", r.key, source=df)
    return out.withColumns({
        "FamilySize": family_size(r),
        "IsAlone": F.when((family_size(r) == 1) & (F.col("ticketFreq") == 1), 1).otherwise(0),
        r.age: binning.band(F.col(r.age), fixed.AGE_EDGES_FINE),
        r.fare: binning.band(F.col(r.fare), fixed.FARE_EDGES_WIDE),
        "nameLen": n_chars(F.col(r.name))}).drop(r.cabin, r.name, r.ticket)


def first_layer(df: DataFrame, roles: Roles = Roles(), seed: int = 0, bands: bool = False) -> DataFrame:
    """The stacking plan's own features; ``bands`` keeps the learnt age and fare bands."""
    r = roles
    title = common_title(word_before_dot(F.col(r.name), missing=""))
    out = df.withColumns({
        "Name_length": n_chars(F.col(r.name)),
        "Has_Cabin": F.col(r.cabin).isNotNull().cast("int"),
        "FamilySize": family_size(r),
        "IsAlone": equals_flag(family_size(r), 1),
        "Title": ordinal_or_null(title, fixed.TITLE_CODES, default=0),
        r.sex: ordinal_or_null(F.col(r.sex), fixed.SEX_FEMALE_ZERO),
        r.port: ordinal_or_null(F.coalesce(F.col(r.port), F.lit("S")), fixed.PORT_FROM_ZERO)})
    out = impute.fill_median(out, [r.fare], "train", r.split)
    out = impute.fill_random_band(out, r.age, r.key, "per_split", r.split, seed)
    out = out.withColumn(r.age, F.col(r.age).cast("int"))
    if bands:
        out = binning.equal_frequency(out, r.fare, 4, "CategoricalFare", "train", r.split)
        out = binning.equal_width(out, r.age, 5, "CategoricalAge", "train", r.split)
    return out.withColumns({
        r.fare: binning.band(F.col(r.fare), fixed.FARE_EDGES),
        r.age: binning.band(F.col(r.age), fixed.AGE_EDGES)}).drop(r.name, r.ticket, r.cabin, r.sibsp)


def comparison(df: DataFrame, roles: Roles = Roles(), minimum: int = 10) -> DataFrame:
    """Fill, derive, bin and label-code, everything learnt per split; rare titles on train."""
    r = roles
    out = impute.fill_median(df, [r.age, r.fare], "per_split", r.split)
    out = impute.fill_mode(out, r.port, "per_split", r.split)
    out = out.withColumns({
        "FamilySize": family_size(r),
        "IsAlone": F.when(family_size(r) > 1, 0).otherwise(1),
        "Title": between(F.col(r.name), ", ", "."),
        "_age": F.col(r.age).cast("int")})
    out = binning.equal_frequency(out, r.fare, 4, "FareBin", "per_split", r.split)
    out = binning.equal_width(out, "_age", 5, "AgeBin", "per_split", r.split).drop("_age")
    out = encode.collapse_rare(out.withColumn("_full", F.col("Title")), "Title", r.key, minimum,
                               by=[r.split])
    out = out.withColumn("Title", F.when(F.col(r.split) == "train", F.col("Title"))
                         .otherwise(F.col("_full"))).drop("_full")
    return encode.label_codes(out, {r.sex: "Sex_Code", r.port: "Embarked_Code", "Title": "Title_Code",
                                    "AgeBin": "AgeBin_Code", "FareBin": "FareBin_Code"}, r.key, [r.split])


def munge(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """Substring titles, the rule tree as a feature, min-max scaling, numbered one-hot."""
    r = roles
    title = replace_values(first_contained(F.col(r.name), fixed.SEARCH_TITLES), fixed.MERGED_TITLES)
    party = learn(df, lambda rows, keys: rows.groupBy(*keys).agg(F.avg(family_size(r)).alias("size")),
                  "union", r.split)
    fare = impute.cohort_median(df, r.fare, (F.col(r.pclass) == 3) & (F.col(r.parch) == 0)
                                & (F.col(r.sibsp) == 0))
    out = impute.fill_group_median(df, r.age, [r.sex, r.pclass], r.key)
    out = attach_group_count(out, [r.ticket], "Ticket_Frequency", r.key, source=df)
    out = out.withColumn("Title", ordinal_or_null(title, fixed.SEARCH_CODES, default=0))
    out = out.withColumns({
        "Is_Married": equals_flag(F.col("Title"), 7),
        "manual_tree": rule_tree_coded(F.col(r.sex), F.col(r.pclass), F.col(r.port), F.col(r.fare),
                                       F.col("Title")),
        "Relatives": F.col(r.sibsp) + F.col(r.parch),
        "Fare_per_person": F.col(r.fare) / constant(party, "size"),
        r.fare: F.coalesce(F.col(r.fare).cast("double"), F.lit(fare).cast("double")),
        r.sex: equals_flag(F.col(r.sex), "male"),
        r.cabin: ordinal_or_null(initial_or(F.col(r.cabin), "0"), fixed.DECK_GROUPS),
        r.port: ordinal_or_null(F.col(r.port), fixed.PORT_BY_LETTER, default=3)})
    out = out.drop(r.name, r.sibsp, r.parch, r.ticket)
    out = encode.min_max(out, ["Relatives", "Fare_per_person", r.fare, r.age, "Ticket_Frequency"], "union")
    return encode.dummies(out, [r.pclass, r.port, r.sex, r.cabin, "Title", "manual_tree", "Is_Married"],
                          numbered=True, keep=True)
