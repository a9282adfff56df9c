"""Bounded samples of labelled documents for fitting classifiers."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus))


def training_ids(labels: DataFrame, label: str, modulus: int, held_out: int, per_class: int) -> DataFrame:
    """(doc_id, label) of at most ``per_class`` rows of each class outside the held-out fold,
    chosen by a hash of the id. A document with several labels counts as the largest."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & (fold(modulus) != held_out))
    rows = rows.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    drawn = rows.withColumn("rank", F.xxhash64("doc_id"))
    parts = [drawn.where(F.col("label") == c).orderBy("rank", "doc_id").limit(per_class) for c in (0, 1)]
    return parts[0].unionByName(parts[1]).select("doc_id", "label")


def training_texts(docs: DataFrame, ids: DataFrame, longest: int) -> pa.Table:
    """(text, label) of the sampled documents of at most ``longest`` bytes, at the driver.

    Their number is bounded by the sample; of copies under one id, one is taken.
    """
    short = docs.where(F.octet_length("text") <= longest).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    met = short.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("label").alias("label"))
    return met.orderBy("doc_id").select("text", "label").toArrow()
