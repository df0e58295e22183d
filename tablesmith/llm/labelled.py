"""Bounded, reproducible samples of labelled documents for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def remainder(key: Column, modulus: int) -> Column:
    """crc32 of the key's text modulo ``modulus``; null for a null key."""
    return F.crc32(key.cast("string").cast("binary")) % modulus


def sample(docs: DataFrame, labels: DataFrame, flag: str, usable: Column, limit: int, salt: int) -> DataFrame:
    """(key, text, label) of about ``limit`` labelled documents at most.

    Labels come first: rows without an id or label and ids whose labels disagree are left
    out, and the rest is thinned by a hash of the id to ``limit`` rows, which bounds the table
    that is then broadcast to the documents. Null texts are empty.
    """
    known = (labels.where(F.col("doc_id").isNotNull() & F.col(flag).isin(0, 1) & usable)
             .groupBy("doc_id").agg(F.min(flag).alias("label"), F.max(flag).alias("_other"))
             .where("label = _other").select(F.col("doc_id").alias("key"), F.col("label").cast("int").alias("label")))
    n = known.count()
    chosen = known.where(F.pmod(F.xxhash64("key", F.lit(salt)), F.lit(1_000_000)) < 1e6 * min(1.0, limit / max(n, 1)))
    return (docs.select(F.col("doc_id").alias("key"), F.coalesce("text", F.lit("")).alias("text"))
            .join(F.broadcast(chosen), "key"))
