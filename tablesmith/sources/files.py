"""Files in, files out.

CSV is read with an explicit schema (no inference pass over the data) and with the double
quote as its own escape, so quoted names that hold doubled quotes survive.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# Column names and types of the passenger files.
PASSENGER_SCHEMA = T.StructType([
    T.StructField("PassengerId", T.LongType()),
    T.StructField("Pclass", T.IntegerType()),
    T.StructField("Name", T.StringType()),
    T.StructField("Sex", T.StringType()),
    T.StructField("Age", T.DoubleType()),
    T.StructField("SibSp", T.IntegerType()),
    T.StructField("Parch", T.IntegerType()),
    T.StructField("Ticket", T.StringType()),
    T.StructField("Fare", T.DoubleType()),
    T.StructField("Cabin", T.StringType()),
    T.StructField("Embarked", T.StringType()),
])


def labelled_schema(label: str = "Survived") -> T.StructType:
    """The passenger schema of the labelled file: the label is its second column."""
    fields = list(PASSENGER_SCHEMA.fields)
    return T.StructType(fields[:1] + [T.StructField(label, T.IntegerType())] + fields[1:])


def read_csv(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",") -> DataFrame:
    """Headered CSV; an empty field is null."""
    return (spark.read.schema(schema).option("header", True).option("escape", '"')
            .option("sep", sep).option("enforceSchema", False).csv(path))


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One parquet table of a folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tag_splits(tables: Mapping[str, DataFrame], split: str = "split") -> DataFrame:
    """Several tables as one, each row naming its table; absent columns become null."""
    stacked = None
    for name, table in tables.items():
        tagged = table.withColumn(split, F.lit(name))
        stacked = tagged if stacked is None else stacked.unionByName(tagged, allowMissingColumns=True)
    return stacked


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """A headered folder of CSV parts, one per partition (never coalesced to one task)."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').option("sep", sep).csv(path)


def write_predictions(df: DataFrame, path: str, key: str, prediction: str,
                      names: Sequence[str] | None = None) -> None:
    """Key and 0/1 prediction with a header and nothing else."""
    key_name, prediction_name = names or (key, prediction)
    write_csv(df.select(F.col(key).alias(key_name),
                        F.col(prediction).cast("int").alias(prediction_name)), path)
