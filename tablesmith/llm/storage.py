"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablesmith.operators.relational import table_bytes
from tablesmith.session import shared_folder


# Whole texts make batches of the default row count large, once in the JVM and twice in Python.
BATCH_ROWS = 2000
BATCH_BYTES = 4 << 20
SIDE_BYTES = 32 << 20


def small_batches(df: DataFrame) -> DataFrame:
    """``df``; its session sends batches of at most the two limits to Python workers from now on."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def new_folder(spark: SparkSession, name: str) -> str:
    """An unused path below the shared folder; it is not created yet."""
    return f"{shared_folder(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back.

    Later jobs read columns of the files instead of repeating the work, whichever
    executors are lost in between.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def beside_texts(side: DataFrame) -> DataFrame:
    """A table of ids and numbers, written and hinted for a join with whole texts.

    Up to ``SIDE_BYTES`` measured bytes it goes to the texts. Beyond, both sides are partitioned by the
    key and this one is hashed, so that the texts are shuffled but need no sort.
    """
    side = saved(side, "side")
    _, sizes = table_bytes(side)
    return F.broadcast(side) if sum(sizes.values()) <= SIDE_BYTES else side.hint("shuffle_hash")
