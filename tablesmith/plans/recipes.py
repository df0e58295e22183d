"""Column roles and the fixed tables the feature plans use."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Roles:
    """Which column plays which part; the defaults are the passenger files' names."""

    key: str = "PassengerId"
    label: str = "Survived"
    split: str = "split"
    pclass: str = "Pclass"
    name: str = "Name"
    sex: str = "Sex"
    age: str = "Age"
    sibsp: str = "SibSp"
    parch: str = "Parch"
    ticket: str = "Ticket"
    fare: str = "Fare"
    cabin: str = "Cabin"
    port: str = "Embarked"


# Titles that count as rare, and spellings that mean the same.
RARE_TITLES = ["Col", "Lady", "Countess", "Capt", "Dr", "Major", "Rev", "Sir", "Jonkheer", "Dona", "Don"]
TITLE_RULES = {"Rare": RARE_TITLES, "Miss": ["Mlle", "Ms"], "Mrs": ["Mme"]}

# Ordinal codes. The plans disagree on sex and port on purpose.
TITLE_CODES = {"Mr": 1, "Miss": 2, "Mrs": 3, "Master": 4, "Rare": 5}
SEX_FEMALE_ONE = {"female": 1, "male": 0}
SEX_FEMALE_ZERO = {"female": 0, "male": 1}
PORT_FROM_ZERO = {"S": 0, "C": 1, "Q": 2}
PORT_FROM_ONE = {"S": 1, "C": 2, "Q": 3}
PORT_BY_LETTER = {"C": 1, "Q": 2, "S": 3}
DECK_CODES = {"A": 1, "B": 2, "C": 3, "D": 4, "E": 5, "F": 6, "G": 7, "T": 8, "M": 0}
DECK_GROUPS = {"A": 1, "B": 1, "C": 1, "D": 2, "E": 2, "F": 3, "G": 3, "T": 3, "0": 0}

# Right-closed band edges.
AGE_EDGES = [16, 32, 48, 64]
FARE_EDGES = [7.91, 14.454, 31]
AGE_EDGES_FINE = [5, 25, 30, 35, 40, 65]
FARE_EDGES_WIDE = [15, 75, 120, 135]

# Substring search order, merged labels and codes of the munging plan. The
# search finds "Mr" inside "Mrs", and merged labels have no code, so most titles become 0.
SEARCH_TITLES = ["Dr", "Mr", "Master", "Miss", "Major", "Rev", "Mrs", "Ms", "Mlle", "Col",
                 "Capt", "Mme", "Countess", "Don", "Jonkheer"]
MERGED_TITLES = {
    "Miss/Mrs/Ms": ["Miss", "Mrs", "Ms", "Mlle", "Lady", "Mme", "the Countess", "Dona"],
    "Dr/Military/Noble/Clergy": ["Dr", "Col", "Major", "Jonkheer", "Capt", "Sir", "Don", "Rev"],
}
SEARCH_CODES = {"Dr": 1, "Mr": 2, "Master": 3, "Miss": 4, "Major": 5, "Rev": 6, "Mrs": 7, "Ms": 8,
                "Mlle": 9, "Col": 10, "Capt": 11, "Mme": 12, "Countess": 13, "Don": 14, "Jonkheer": 15}


def feature_lists(label: str = "Survived") -> dict[str, list[str]]:
    """Named column lists of the comparison plan: raw, coded, binned, each with the label."""
    raw = ["Sex", "Pclass", "Embarked", "Title", "SibSp", "Parch", "Age", "Fare", "FamilySize", "IsAlone"]
    coded = ["Sex_Code", "Pclass", "Embarked_Code", "Title_Code", "SibSp", "Parch", "Age", "Fare"]
    binned = ["Sex_Code", "Pclass", "Embarked_Code", "Title_Code", "FamilySize", "AgeBin_Code", "FareBin_Code"]
    return {"raw": raw, "coded": coded, "binned": binned, "raw_labelled": [label, *raw],
            "binned_labelled": [label, *binned]}
